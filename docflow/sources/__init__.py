"""Readers for the crawl tree, manifests, ledgers and sidecar files."""
