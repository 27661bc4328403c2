"""Pairs of similar texts, as joins.

Equal texts form one class first, so copies are never paired with each other;
pairs are between classes, and every row carries its class.

* ``overlap_pairs``: token sets whose overlap |A ∩ B| / min(|A|, |B|) reaches a
  threshold.  Tokens are ordered by rarity.  The smaller set of a pair must
  share one of its few rarest tokens with the larger one, so only those are
  looked up in the index of all tokens; a common token is looked up only by
  sets that have no rarer ones.  A match also has to leave room for the rest
  of the overlap after its two positions.  What remains is checked in full.
* ``edit_pairs``: strings of one block within ``k`` edits.  Of the k + 1 even
  pieces of the shorter string one must stand unchanged in the longer one, at
  a shift that the edits before and after it allow; so pieces are indexed by
  block, length and number, and the longer string looks up its substrings
  there.  What remains goes through ``levenshtein`` with the threshold.

Both sides of every join come from written tables through exchanges of their
own, so adaptive execution can split a hot token or piece.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.ranking import written


def with_classes(rows: DataFrame, id_col: str, by: list[str]) -> DataFrame:
    """``rows`` with ``class_id``, the least id of those equal in ``by``."""
    least = written(rows.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.min(id_col).alias("class_id")), "classes")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.join(least, same).drop(*[f"__{c}" for c in by])


def rare_first(sets: DataFrame) -> DataFrame:
    """(id, tokens: distinct) -> (id, size, tokens ordered by rarity)."""
    each = sets.select("id", F.explode("tokens").alias("token"))
    seen = written(each.groupBy(F.col("token").alias("t")).agg(F.count(F.lit(1)).alias("n")), "token-counts")
    rows = each.join(seen, F.col("token") == F.col("t")).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("by_n"))
    return written(rows.select("id", F.size("by_n").alias("size"), F.col("by_n.token").alias("tokens")), "token-sets")


def overlap_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    """Distinct ``sets`` (id, tokens: array of distinct strings) -> (a, b,
    overlap): a is the smaller set (of equal sizes, the lesser id).  Empty sets
    are like no other."""
    t = Fraction(str(threshold))
    if not 0 < t <= 1:
        raise ValueError("the threshold must be over 0 and at most 1")
    rows = rare_first(sets)
    need = F.expr(f"({t.numerator}L * size + {t.denominator - 1}L) div {t.denominator}L")
    token = rows.select("id", "size", need.alias("need"), F.posexplode("tokens").alias("at", "token"))
    small = token.filter(F.col("at") <= F.col("size") - F.col("need")).select(
        F.col("token").alias("t"), F.col("id").alias("a"), F.col("size").alias("a_size"), F.col("at").alias("a_at"), F.col("need").alias("a_need"))
    larger = (F.col("size") > F.col("a_size")) | ((F.col("size") == F.col("a_size")) & (F.col("id") > F.col("a")))
    room = F.least(F.col("size") - F.col("at"), F.col("a_size") - F.col("a_at")) >= F.col("a_need")
    found = written(small.join(token, (F.col("token") == F.col("t")) & larger & room).select("a", F.col("id").alias("b")).distinct(), "candidates")
    side = lambda c: rows.select(F.col("id").alias(c), F.col("tokens").alias(f"{c}_tokens"))
    pairs = found.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return (pairs.filter(shared * t.denominator >= F.size("a_tokens") * t.numerator)
            .select("a", "b", (shared / F.size("a_tokens")).alias("overlap")))


def _piece(length: Column, i: Column, k: int) -> tuple[Column, Column]:
    """Start (from 0) and length of piece ``i`` of k + 1 even ones; the last
    ``length % (k + 1)`` are one longer."""
    q, longer = F.floor(length / (k + 1)).cast("int"), (length % (k + 1)).cast("int")
    first = F.lit(k + 1) - longer
    return i * q + F.greatest(i - first, F.lit(0)), q + (i >= first).cast("int")


def edit_candidates(strings: DataFrame, k: int) -> DataFrame:
    """(id, block, s) -> pairs (a, b) that share a piece: a is the shorter
    string (of equal lengths, the lesser id)."""
    n = F.length("s")

    def cut(i):
        start, size = _piece(n, i, k)
        return F.struct(i.alias("i"), F.substring(F.col("s"), start + 1, size).alias("piece"))
    index = strings.select("id", "block", n.alias("n"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(k)), cut)).alias("p"))
    index = index.select(F.col("id").alias("a"), F.col("block").alias("a_block"), F.col("n").alias("a_n"), F.col("p.i").alias("a_i"), F.col("p.piece").alias("a_piece"))

    def of_length(short):            # pieces of strings of that length
        more = n - short

        def of_piece(i):
            start, size = _piece(short, i, k)
            lo = F.greatest(start - i, start + more - (k - i), F.lit(0))
            hi = F.least(start + i, start + more + (k - i), n - size)
            at = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
            return F.transform(at, lambda x: F.struct(short.alias("n"), i.alias("i"), F.substring(F.col("s"), x + 1, size).alias("piece")))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(k)), of_piece))
    probes = F.array_distinct(F.flatten(F.transform(F.sequence(F.greatest(n - k, F.lit(0)), n), of_length)))
    probe = strings.select("id", "block", n.alias("own_n"), F.explode(probes).alias("p"))
    probe = probe.select(F.col("id").alias("b"), "block", "own_n", F.col("p.n").alias("n"), F.col("p.i").alias("i"), F.col("p.piece").alias("piece"))
    same = (F.col("a_block").eqNullSafe(F.col("block")) & (F.col("a_n") == F.col("n")) & (F.col("a_i") == F.col("i")) & (F.col("a_piece") == F.col("piece")))
    ahead = (F.col("own_n") > F.col("a_n")) | (F.col("b") > F.col("a"))
    return index.join(probe, same & ahead).select("a", "b").distinct()


def edit_pairs(strings: DataFrame, k: int) -> DataFrame:
    """Distinct ``strings`` (id, block, s) -> (a, b, distance) of those of one
    block (null: a block of its own) within ``k`` edits.  A null string is
    like no other."""
    rows = written(strings.filter("s is not null").select("id", "block", "s"), "strings")
    found = written(edit_candidates(rows, k), "candidates")
    side = lambda c: rows.select(F.col("id").alias(c), F.col("s").alias(f"{c}_s"))
    pairs = found.join(side("a"), "a").join(side("b"), "b").withColumn("distance", F.levenshtein("a_s", "b_s", k))
    return pairs.filter("distance >= 0").select("a", "b", "distance")


def links(rows: DataFrame, pairs: DataFrame, best: Column) -> DataFrame:
    """``rows`` (with class_id) with n_links, the other classes that theirs is
    paired with, and ``best`` (an aggregate over its pairs; null: none)."""
    rest = [c for c in pairs.columns if c not in ("a", "b")]
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), *rest))
    per = written(both.groupBy(F.col("a").alias("__class")).agg(F.count(F.lit(1)).alias("n_links"), best.alias("best")), "links")
    return (rows.join(per, F.col("class_id") == F.col("__class"), "left").drop("__class")
            .withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))))
