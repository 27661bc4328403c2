"""Translation step (U1) as a distributed job.

    items --status cascade--> ok items --A7--> parts (one row each)
    parts --distinct (from,to,part), with reference counts--> unique parts
    unique parts --left join--> translation memory (part, from, to -> text)
    misses --mapInPandas(translate_fn)--> new translations   [checkpointed]
    parts --join on a digest--> translated parts --A8--> translated text

Each distinct part is translated once per run, however many documents hold
it.  Part texts cross the network once, pre-aggregated, on their way to the
distinct parts; the join back is on a 256-bit digest, so documents send only
keys and digests, and adaptive execution splits a part that is in a third of
all documents.
The translate function is supplied by the caller (the original called a
web service); the default passes text through unchanged.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.constants import PART_LIMIT, STATUS_OK, STATUS_SHORT
from docflow.operators.joins import skew_join
from docflow.operators.packing import pack, reassemble

TranslateFn = Callable[[pd.DataFrame], pd.Series]


def passthrough(batch: pd.DataFrame) -> pd.Series:
    """Default translate function: the text unchanged."""
    return batch["part"]


def dictionary_translator(pairs: list[tuple[str, str, str, str]]) -> TranslateFn:
    """A translate function that replaces known terms, in list order.

    ``pairs``: (from_lang, to_lang, term, replacement), e.g. built from the
    keyword dictionary (``operators.keywords``).  It is small and bounded
    by the dictionary, so it travels inside the function."""
    table: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for f, t, a, b in pairs:
        if a:
            table.setdefault((f, t), []).append((a, b))

    def fn(batch: pd.DataFrame) -> pd.Series:
        out = []
        for f, t, p in zip(batch["from_lang"], batch["to_lang"], batch["part"]):
            for a, b in table.get((f, t), ()):
                p = p.replace(a, b)
            out.append(p)
        return pd.Series(out, index=batch.index, dtype=object)

    return fn


def _call(fn: TranslateFn, b: pd.DataFrame) -> pd.Series:
    """Translate a batch; if the function fails on it, retry part by part
    and give '' for the parts that still fail (the original's rule: a
    failed part is empty, the others go on)."""
    cols = b[["from_lang", "to_lang", "part"]]
    try:
        return fn(cols)
    except Exception:
        out = []
        for i in range(len(cols)):
            try:
                out.append(fn(cols.iloc[i:i + 1]).iloc[0])
            except Exception:
                out.append("")
        return pd.Series(out, index=b.index, dtype=object)


def _apply(fn: TranslateFn):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in it:
            if len(b) == 0:
                continue
            res = _call(fn, b)
            yield pd.DataFrame({"from_lang": b["from_lang"], "to_lang": b["to_lang"], "part": b["part"],
                                "translated": res.astype(object).where(res.notna(), ""), "n_refs": b["n_refs"]})
    return run


def with_digest(parts: DataFrame) -> DataFrame:
    return parts.withColumn("digest", F.unhex(F.sha2("part", 256)))


def translate_parts(parts: DataFrame, translate_fn: TranslateFn = passthrough,
                    memory: DataFrame | None = None, checkpoint: bool = True, memory_out: str | None = None) -> DataFrame:
    """Translate a table of parts (… from_lang, to_lang, part) and add
    ``translated`` in place of ``part``.  ``memory`` (from_lang, to_lang, part,
    translated[, batch_id]) holds earlier results, of which the first one
    written counts; only misses reach ``translate_fn``.  A failed part becomes
    '' (the original's rule).  ``memory_out``: append the new, non-empty
    translations there (Parquet by language pair), so a later run finds them
    in its memory."""
    key = ["from_lang", "to_lang", "part"]
    uniq = parts.groupBy(*key).agg(F.count(F.lit(1)).alias("n_refs"))
    if memory is not None:
        order = F.col("batch_id") if "batch_id" in memory.columns else F.lit(0)
        mem = memory.groupBy(*key).agg(F.min(F.struct(order.alias("o"), F.col("translated").alias("t"))).alias("m")) \
            .select(*key, F.col("m.t").alias("translated"))
        looked = uniq.join(mem, key, "left")
        hits = looked.filter(F.col("translated").isNotNull())
        misses = looked.filter(F.col("translated").isNull()).drop("translated")
    else:
        hits, misses = None, uniq
    new = misses.mapInPandas(_apply(translate_fn),
                             "from_lang string, to_lang string, part string, translated string, n_refs long")
    if checkpoint:
        # Translation is the costly, external step: run it once, cut lineage,
        # and keep the result on the shared checkpoint folder.
        new = new.checkpoint(eager=True)
    if memory_out:
        (new.filter(F.col("translated") != "").select(*key, "translated", F.lit(time.time_ns()).alias("batch_id")).write.mode("append")
         .partitionBy("from_lang", "to_lang").parquet(memory_out))
    done = new if hits is None else hits.select(*key, "translated", "n_refs").unionByName(new)
    done = with_digest(done).select("from_lang", "to_lang", "digest", "translated")
    return skew_join(with_digest(parts).drop("part"), done, ["from_lang", "to_lang", "digest"]).drop("digest")


def translate_items(items: DataFrame, key: str, text: str = "text", translate_fn: TranslateFn = passthrough,
                    memory: DataFrame | None = None, limit: int = PART_LIMIT, checkpoint: bool = True,
                    memory_out: str | None = None, keep=(), parts: str | None = None) -> DataFrame:
    """U1 over items that passed the status cascade.

    ``items``: key, src_lang, to_lang, status, text.  Items with status 0
    and a different language are packed, translated and put back together;
    same-language items pass unchanged; others keep their status and no
    text.  Output: key, to_lang, status (3 when the result is <= 1 char),
    n_parts, translated, and the ``keep`` columns (which must depend on the
    key only, e.g. region or site: they ride along and are grouped on for
    free).  ``parts``: a column that holds the packed text already (A7), so
    that an item with several targets is packed once, before its rows.

    The parts to translate are checkpointed, because the distinct parts and
    the join back both read them; texts that pass unchanged are not, they
    come from the items as they are."""
    todo = (F.col("status") == STATUS_OK) & (F.col("src_lang") != F.col("to_lang"))
    same = (F.col("status") == STATUS_OK) & (F.col("src_lang") == F.col("to_lang"))
    keep = list(keep)
    base = [key, *keep, "to_lang"]
    rows = items.filter(todo).select(*base, F.col("src_lang").alias("from_lang"), F.posexplode_outer(F.col(parts) if parts else pack(text, limit)).alias("part_no", "part"))
    if checkpoint:
        rows = rows.checkpoint(eager=True)
    todo_parts = rows.filter(F.col("part_no").isNotNull())
    tr = translate_parts(todo_parts, translate_fn, memory, checkpoint, memory_out)
    back = reassemble(tr.select(key, *keep, "to_lang", "part_no", F.col("translated").alias("part")),
                      [key, "to_lang", *keep]) \
        .select(key, *keep, "to_lang", "n_parts", F.col("text").alias("translated"))
    empty = rows.filter(F.col("part_no").isNull()) \
        .select(*base, F.lit(0).cast("long").alias("n_parts"), F.lit("").alias("translated"))
    same_rows = items.filter(same).select(*base, F.lit(None).cast("long").alias("n_parts"), F.col(text).alias("translated"))
    ok = back.unionByName(empty).unionByName(same_rows).withColumn(
        "status", F.when(F.length("translated") <= 1, F.lit(STATUS_SHORT)).otherwise(F.lit(STATUS_OK)))
    rest = items.filter(~F.coalesce(todo | same, F.lit(False))) \
        .select(*base, "status", F.lit(None).cast("long").alias("n_parts"), F.lit(None).cast("string").alias("translated"))
    cols = [key, "to_lang", "status", "n_parts", "translated", *keep]
    return ok.select(*cols).unionByName(rest.select(*cols))


def translate_posts(posts: DataFrame, key: str, text: str, lang: str, to_lang: str,
                    translate_fn: TranslateFn = passthrough, routes=None,
                    checkpoint: bool = True) -> DataFrame:
    """Short-post flow: empty text -> status 1; no route for the post's
    language -> 9; else URLs and hashtags guarded (X8), the newline runs at
    both ends kept aside (X9), the whole post translated as one part (no
    packing) and the newline runs put back once."""
    from docflow.functions.text import guard_tags, leading_newlines, trailing_newlines
    from docflow.operators.routing import normalize_lang, route_supported
    df = posts.select(key, F.col(text).alias("_text"), normalize_lang(lang).alias("from_lang")) \
        .withColumn("to_lang", F.lit(to_lang))
    status = (F.when(F.coalesce(F.length("_text"), F.lit(0)) == 0, F.lit(1))
              .when(F.col("from_lang").isNull() | ~route_supported("from_lang", "to_lang", routes), F.lit(9))
              .otherwise(F.lit(STATUS_OK)))
    df = df.withColumn("status", status)
    g = guard_tags("_text")
    ok = (df.filter(F.col("status") == STATUS_OK)
          .withColumn("_lead", leading_newlines(g)).withColumn("_trail", trailing_newlines(g))
          .withColumn("part", F.regexp_replace(F.regexp_replace(g, r"\A\n+", ""), r"\n+\z", ""))
          .withColumn("part_no", F.lit(0)))
    same = ok.filter(F.col("from_lang") == F.col("to_lang")).withColumn("translated", F.col("part"))
    other = ok.filter(F.col("from_lang") != F.col("to_lang"))
    tr = translate_parts(other.select(key, "from_lang", "to_lang", "part", "_lead", "_trail", "status"),
                         translate_fn, None, checkpoint)
    cols = [key, "to_lang", "status", "_lead", "_trail", "translated"]
    done = same.select(*cols).unionByName(tr.select(*cols)).withColumn(
        "translated", F.concat("_lead", "translated", "_trail")).drop("_lead", "_trail")
    rest = df.filter(F.col("status") != STATUS_OK).select(key, "to_lang", "status",
                                                          F.lit(None).cast("string").alias("translated"))
    return done.unionByName(rest)


def post_text(html) -> "F.Column":
    """X3 for a post page: the text of its first <p> ('' when there is none
    or it is empty, which the post flow records as status 1)."""
    from docflow.functions import html as H
    return H.first_text(H.blocks(html), "p", need_text=False)
