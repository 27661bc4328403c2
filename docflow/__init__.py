"""docflow: a Spark-native pipeline for crawled multilingual pages and short posts.

Every public function takes and returns DataFrames (or Columns); the work is
declared with the DataFrame API so Catalyst plans it and executors run it.

    functions/   Column expressions: HTML blocks, text rules, paths, similarity
    operators/   DataFrame operators: page features, status cascade, ledgers,
                 newest version, packing, translation, scoring, keywords, joins
    sources/     crawl tree, manifests, ledgers, sidecars, JSON lines, block XML
    sinks/       partitioned / bucketed tables, JSON lines, ledgers
    streaming/   file streams, idempotent micro-batch writes, window roll-ups
    flows.py     the original's loops end to end; jobs.py runs them
    plans/       the named queries over the driver tables and their oracles
"""

__all__ = ["session", "constants", "schemas", "flows", "jobs"]
