"""All named queries and their oracles."""

from __future__ import annotations

import importlib

MODULES = ["docflow.plans.pages", "docflow.plans.documents", "docflow.plans.events", "docflow.plans.scoring", "docflow.plans.streams", "docflow.plans.crawl"]


def _mods():
    return [importlib.import_module(m) for m in MODULES]


def queries():
    out = {}
    for m in _mods():
        out.update(m.QUERIES)
    return out


def oracle_sql():
    out = {}
    for m in _mods():
        out.update({k: v for k, v in m.SQL.items() if v})
    return out
