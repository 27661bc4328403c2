"""Packing text into bounded parts and putting them back.

Packing is greedy and sequential inside one document, so it runs as a fold
over the document's line lengths inside the row: no shuffle, JVM-side.  The
fold finds cut positions only; each part is then one slice of the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.constants import PART_LIMIT
from docflow.functions.text import strip

#: Lines whose cuts are gathered in one array before they join the others.
FOLD_LINES = 1024


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once a row, however often (and
    in whichever lambda) the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cuts(sizes: Column, limit: int) -> Column:
    """Numbers of the lines (from 0) at which a new part starts, ascending.

    An array grows by copying, so cuts are gathered for ``FOLD_LINES`` lines
    at a time: a text of n lines copies n * FOLD_LINES / 2 numbers at most,
    even if each line is a part of its own."""
    def block(acc, start):
        init = F.struct(F.array().cast("array<int>").alias("cuts"), acc["fill"].alias("fill"), start.alias("line"))

        def step(a, size):
            fits = a["fill"] + size < limit
            return F.struct(F.when(fits, a["cuts"]).otherwise(F.concat(a["cuts"], F.array(a["line"]))).alias("cuts"),
                            F.when(fits, a["fill"] + size).otherwise(size).alias("fill"), (a["line"] + 1).alias("line"))

        return F.aggregate(F.slice(sizes, start + 1, F.lit(FOLD_LINES)), init, step,
                           lambda a: F.struct(F.concat(acc["done"], F.array(a["cuts"])).alias("done"), a["fill"].alias("fill")))

    init = F.struct(F.array().cast("array<array<int>>").alias("done"), F.lit(0).alias("fill"))
    starts = F.sequence(F.lit(0), F.size(sizes) - 1, F.lit(FOLD_LINES))
    return F.aggregate(starts, init, block, lambda a: F.flatten(a["done"]))


def pack(text, limit: int = PART_LIMIT) -> Column:
    """Array of parts.  Lines are added (each with its newline) while the
    part stays shorter than ``limit``; a line that does not fit starts the
    next part; long lines are never split.  Parts are stripped and empty
    parts dropped; a null text has no array.  The work grows with the text's
    length, whatever the number of lines and parts."""
    t = F.col(text) if isinstance(text, str) else text

    def slices(lines):
        def bounds(cuts):
            starts = F.concat(F.array(F.lit(0)), cuts)
            ends = F.concat(cuts, F.array(F.size(lines)))
            return F.zip_with(starts, ends, lambda s, e: strip(F.array_join(F.slice(lines, s + 1, e - s), "\n")))
        return _let(_let(F.transform(lines, lambda x: F.length(x) + 1), lambda sizes: _cuts(sizes, limit)), bounds)

    return F.when(t.isNotNull(), F.filter(_let(F.split(t, "\n", -1), slices), lambda p: p != ""))


def explode_parts(df: DataFrame, key, text: str = "text", limit: int = PART_LIMIT,
                  keep=()) -> DataFrame:
    """One row per part: key columns, ``part_no`` (0-based), ``part``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(*keys, *keep, F.posexplode(pack(text, limit)).alias("part_no", "part"))


def reassemble(parts: DataFrame, key, part_no: str = "part_no", part: str = "part",
               sep: str = "\n") -> DataFrame:
    """Parts back into one text per key, in part order.

    A document's parts are bounded by the document (and translation refuses
    documents over the line limit), so the group is bounded."""
    keys = [key] if isinstance(key, str) else list(key)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(part_no).alias("n"), F.col(part).alias("t"))))
    return parts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_parts"),
        F.array_join(F.transform(ordered, lambda x: x["t"]), sep).alias("text"))
