"""URL filter: host and path rules, then a character language-model ratio.

A rule fits its host and every subdomain of it when the URL's path starts with
the rule's path; the longest fitting rule decides.  URLs without a rule are
judged by two smoothed variable-order Markov models of characters, one
trained on the URLs that rules accept and one on those they reject: the
log-likelihood difference per character against a threshold that is
calibrated on the ruled URLs (best balanced accuracy over a histogram).

n-gram counts cover every ruled URL (pre-aggregated in each task) and are all
used: every distinct n-gram of the URLs is scored once, by joins with the
table of counts.  Tasks hold the scores of the ``head`` most frequent n-grams;
the others of a URL get theirs by a join.

Defined cases: null URLs and URLs without ``://`` have empty host and path and
fit no rule; if no URL is accepted or none rejected there is no model and
``default`` is returned; ties of equally long rules go to the later one; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import materialize, opened, share

ORDER = 5            # characters of context at most
HEAD = 100_000       # scores of n-grams sent to the tasks; the others are joined
BINS = 400           # histogram bins of the calibration
FLUSH = 200_000      # counts held in a task before they are handed on
START = "\x02"


def host(url: Column) -> Column:
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null; ``rules``
    are (verdict, host, path)."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(text: str, order: int = ORDER):
    """All n-grams ending at each character, of 1 to order + 1 characters."""
    s = START + text
    for i in range(1, len(s)):
        for k in range(min(order, i) + 1):
            yield s[i - k:i + 1]


def count_grams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(verdict, url) -> (verdict, gram, n)."""
    def run(batches):
        held = {}

        def out():
            rows = [(v, g, n) for v, c in held.items() for g, n in c.items()]
            held.clear()
            v, g, n = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(v, pa.string()), pa.array(g, pa.string()), pa.array(n, pa.int64())], names=["verdict", "gram", "n"])
        for b in batches:
            for v, u in zip(b.column("verdict").to_pylist(), b.column("url").to_pylist()):
                held.setdefault(v, Counter()).update(grams(u, order))
                if sum(map(len, held.values())) > FLUSH:
                    yield out()
        yield out()
    return urls.mapInArrow(run, "verdict string, gram string, n long").groupBy("verdict", "gram").agg(F.sum("n").alias("n"))


class Markov:
    """Witten-Bell interpolated character model from a dictionary of counts.
    Contexts that are not held fall back to shorter ones.  ``gram_scores``
    computes the same from tables."""

    def __init__(self, counts: dict[str, int], order: int = ORDER):
        self.order, self.counts, self.context = order, counts, {}
        for g, n in counts.items():
            c = self.context.setdefault(g[:-1], [0, 0])
            c[0] += n
            c[1] += 1

    def logp(self, s: str) -> float:
        """log of the probability of the last character of ``s`` after the
        others."""
        p = 1 / 256
        for k in range(min(self.order, len(s) - 1) + 1):
            seen = self.context.get(s[len(s) - 1 - k:-1])
            if seen is None:
                break
            p = (self.counts.get(s[len(s) - 1 - k:], 0) + seen[1] * p) / (seen[0] + seen[1])
        return math.log(p)


def gram_counts(base: DataFrame, order: int = ORDER) -> DataFrame:
    """(verdict, url) -> (gram, a, b, n): counts of each n-gram in the
    accepted, the rejected and all URLs."""
    urls = base.select(F.coalesce("verdict", F.lit("")).alias("verdict"), F.coalesce("url", F.lit("")).alias("url"))
    of = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0))
    return materialize(count_grams(urls, order).groupBy("gram").agg(of("allow").alias("a"), of("block").alias("b"), F.sum("n").alias("n")), "url-grams")


def gram_scores(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n, d): log-likelihood difference of the last character after
    the others, of every n-gram, from the shorter ones to the longer."""
    short = F.expr("left(gram, length(gram) - 1)")
    sums = counts.groupBy(short.alias("context")).agg(*[f(x).alias(f"{x}_{name}") for x in ("a", "b") for name, f in
                                                        (("sum", F.sum), ("kinds", lambda x: F.count_if(F.col(x) > 0)))])
    full = materialize(counts.withColumn("context", short).join(sums, "context").drop("context"), "url-contexts")
    out, below = [], None
    for k in range(order + 1):
        level = full.filter(F.length("gram") == k + 1)
        if below is None:
            level = level.withColumns({"low_a": F.lit(1 / 256), "low_b": F.lit(1 / 256)})
        else:
            level = level.withColumn("tail", F.expr("substring(gram, 2)")).join(
                below.select(F.col("gram").alias("tail"), F.col("p_a").alias("low_a"), F.col("p_b").alias("low_b")), "tail")
        p = lambda x: F.when(F.col(f"{x}_kinds") > 0, (F.col(x) + F.col(f"{x}_kinds") * F.col(f"low_{x}")) /
                             (F.col(f"{x}_sum") + F.col(f"{x}_kinds"))).otherwise(F.col(f"low_{x}"))
        below = materialize(level.select("gram", "n", p("a").alias("p_a"), p("b").alias("p_b")), f"url-level-{k}")
        out.append(below.filter(F.col("gram").startswith(START)) if k < order else below)      # a shorter one is whole at a URL's start
    scores = out[0]
    for x in out[1:]:
        scores = scores.unionByName(x)
    return scores.select("gram", "n", (F.log("p_a") - F.log("p_b")).alias("d"))


def score(pages: DataFrame, scores: DataFrame, schema: str, order: int = ORDER, head: int = HEAD) -> DataFrame:
    """Adds ``lm``, the mean log-likelihood difference per character of the
    URL, as the last column."""
    top = scores.orderBy(F.desc("n"), "gram").limit(head).select("gram", "d").toArrow()
    held = share(pages.sparkSession, dict(zip(top.column("gram").to_pylist(), top.column("d").to_pylist())))

    def run(batches):
        from pyspark import TaskContext
        known = opened(held)
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            sums, chars, rest = [], [], []
            for u in b.column("url").to_pylist():
                s, total, missing = START + (u or ""), 0.0, []
                for i in range(1, len(s)):
                    g = s[max(0, i - order):i + 1]
                    d = known.get(g)
                    if d is None:
                        missing.append(g)
                    else:
                        total += d
                sums.append(total)
                chars.append(max(1, len(s) - 1))
                rest.append(missing)
            own = [pa.array(range(row, row + len(sums)), pa.int64()), pa.array(sums, pa.float64()), pa.array(chars, pa.int64()), pa.array(rest, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *own], names=[*b.schema.names, "row", "part", "chars", "rest"])
            row += len(sums)
    rows = materialize(pages.mapInArrow(run, f"{schema}, row long, part double, chars long, rest array<string>"), "url-rows")
    found = (rows.select("row", F.explode("rest").alias("gram")).join(scores.select("gram", "d"), "gram")
             .groupBy("row").agg(F.sum("d").alias("more")))
    lm = (F.col("part") + F.coalesce("more", F.lit(0.0))) / F.col("chars")
    return materialize(rows.drop("rest").join(found, "row", "left").withColumn("lm", lm).drop("row", "part", "chars", "more"), "url-scored")


def calibrate(scored: DataFrame, bins: int = BINS) -> float:
    """Threshold on ``lm`` with the best balanced accuracy on ruled URLs."""
    lo, hi = scored.agg(F.min("lm"), F.max("lm")).first()
    if lo is None or lo == hi:
        return 0.0
    at = F.least(F.floor((F.col("lm") - lo) / (hi - lo) * bins), F.lit(bins - 1))
    rows = scored.groupBy(at.alias("bin")).agg(F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b")).collect()
    hist = {r.bin: (r.a, r.b) for r in rows}
    all_a, all_b = sum(a for a, _ in hist.values()), sum(b for _, b in hist.values())
    found, under_a, under_b = [], 0, 0
    for k in range(bins + 1):
        found.append((all_a - under_a) / max(1, all_a) + under_b / max(1, all_b))
        a, b = hist.get(k, (0, 0))
        under_a, under_b = under_a + a, under_b + b
    first = found.index(max(found))                 # the middle of the first stretch of equally good cuts
    last = next((k for k in range(first, bins + 1) if found[k] < found[first]), bins + 1) - 1
    return lo + (hi - lo) * (first + last) / 2 / bins


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
               order: int = ORDER, head: int = HEAD, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, lm (null without a model)."""
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host(url).alias("host"), path(url).alias("path"))
    hit = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumn("hit", hit).select("page_id", "url", "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("verdict"))
    counts = gram_counts(base, order)
    if not all(counts.agg(F.max("a"), F.max("b")).first()):
        return base.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"), F.lit(None).cast("double").alias("lm"))
    scored = score(base, gram_scores(counts, order), "page_id long, url string, host string, path string, rule string, verdict string", order, head)
    cut = calibrate(scored.filter("verdict is not null"))
    judged = F.when(F.col("lm") >= cut, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", judged).alias("verdict"), "lm")
