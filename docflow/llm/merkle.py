"""A Merkle manifest of a table: a digest for every row, one root for each
part of the table, one root over the parts, and a proof for every row.

Rows of a part (``tree_col``) stand in the order of their id, and every
``FANOUT`` = 2 consecutive nodes become the hash of their digests, written as
hex and put together; the last run may hold one node.  A level is a slot
pivot: rows are grouped by parent and conditional aggregates spread the
children into slot columns; hashing the concatenated columns gives the parent,
and the columns without a child's own give its siblings.  One pivot spreads
``2 ** STRIDE`` = 16 children, so that the four levels above them are
expressions over the columns of one row and a table of n rows takes
log16(n) pivots.

Going up, each pivot is written once (one row for 16 nodes).  Going down, the
steps from a pivot's top node to the root are joined to it by (tree, group),
and each slot adds its own siblings; groups are bounded, so a part that holds
a third of all rows is spread like any other.  The roots of the parts make a
second tree by the same functions.

A proof is an array of steps, leaf to root: ``<`` and a sibling that stands
on the left, ``>`` and one on the right, or an empty string for a run of one.

Only DataFrame functions run; texts are read once and never shuffled.
Defined cases: a null value is hashed as ``-``, unlike an empty text, which is
``0:``; a null part is a part of its own and the first; null ids come first;
rows with equal ids stand in the order of their digests, and equal rows give
equal digests at places of their own; a text of any length is one hash; an
empty table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.llm.common import materialize
from docflow.operators.ranking import ranked

FANOUT = 2
STRIDE = 4
SLOTS = FANOUT ** STRIDE


def field(col: str | Column) -> Column:
    """A value as hashed: ``-`` if null, else its UTF-8 byte count, ``:``
    and the value as text."""
    s = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def height(n: Column, level: int) -> Column:
    """Nodes of a tree of ``n`` leaves ``level`` levels above them."""
    return F.shiftright(n + F.lit((1 << level) - 1), level)


def with_children(wide: DataFrame) -> DataFrame:
    return wide.withColumn("h0", F.array(*[F.col(f"c{j}")["hash"] for j in range(SLOTS)]))


def pivot(nodes: DataFrame, level: int, rest: list[str]) -> DataFrame:
    """Nodes (tree, idx, n, hash, and columns ``rest`` to carry) ``level``
    levels above the leaves -> one row for each 16: tree, group, n, slots
    c0 … c15 (structs), and ``h<k>`` = array of the nodes k levels up."""
    slot = F.col("idx") % SLOTS
    value = F.struct("hash", *rest)
    wide = nodes.groupBy("tree", F.shiftright("idx", STRIDE).alias("group")).agg(
        F.max("n").alias("n"), *[F.max(F.when(slot == j, value)).alias(f"c{j}") for j in range(SLOTS)])
    wide = with_children(wide)
    for k in range(1, STRIDE + 1):
        below = [F.col(f"h{k - 1}")[i] for i in range(SLOTS >> (k - 1))]
        runs = [F.when(height(F.col("n"), level + k - 1) > 1, digest(below[i], F.coalesce(below[i + 1], F.lit(""))))
                .otherwise(below[i]) for i in range(0, len(below), FANOUT)]
        wide = wide.withColumn(f"h{k}", F.array(*runs))
    return wide


def slot_steps(j: int, level: int) -> Column:
    """Steps from slot ``j`` to the top of its pivot row: at each level the
    row's column beside its own."""
    steps = []
    for k in range(STRIDE):
        own = j >> k
        beside = F.col(f"h{k}")[own ^ 1]
        step = F.concat(F.lit("<"), beside) if own & 1 else F.coalesce(F.concat(F.lit(">"), beside), F.lit(""))
        steps.append(F.when(height(F.col("n"), level + k) > 1, step))
    return F.array_compact(F.array(*steps))


def build(nodes: DataFrame, rest: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """Leaves (tree, idx, n, hash, ``rest``) -> the written pivots, lowest
    first, and the roots (tree, hash)."""
    tallest = nodes.agg(F.max("n")).first()[0] or 0
    pivots, level = [], 0
    while True:
        wide = materialize(pivot(nodes, level, rest if not level else []).drop("h0"), f"{name}-{level}")
        pivots.append(wide)
        nodes = wide.select("tree", F.col("group").alias("idx"), "n", F.col(f"h{STRIDE}")[0].alias("hash"))
        level += STRIDE
        if tallest <= 1 << level:
            return pivots, nodes.select("tree", "hash")


def proofs(pivots: list[DataFrame], above: DataFrame) -> DataFrame:
    """Steps of every leaf: ``above`` (tree, root, steps) holds each tree's
    root and the steps from it on.  -> tree, root, leaf (struct of hash and
    what was carried), steps."""
    above = above.withColumn("group", F.lit(0).cast("long"))
    for k in range(len(pivots) - 1, -1, -1):
        up = above.select(F.col("tree").alias("up_tree"), F.col("group").alias("up_group"), "root", "steps")
        same = F.col("tree").eqNullSafe(F.col("up_tree")) & (F.col("group") == F.col("up_group"))
        joined = with_children(pivots[k]).join(up, same)
        kids = F.array(*[F.struct(F.col(f"c{j}").alias("leaf"), slot_steps(j, k * STRIDE).alias("own")) for j in range(SLOTS)])
        out = joined.select("tree", "group", "root", "steps", F.posexplode(kids).alias("slot", "kid")).filter("kid.leaf is not null")
        out = out.select("tree", (F.col("group") * SLOTS + F.col("slot")).alias("group"), "root", F.col("kid.leaf").alias("leaf"),
                         F.concat("kid.own", "steps").alias("steps"))
        if not k:
            return out.drop("group")
        above = materialize(out.drop("leaf"), "merkle-steps")


def siblings(steps: str | Column) -> Column:
    """The digests of a proof, leaf to root, in one string."""
    return F.array_join(F.transform(steps, lambda s: F.substring(s, 2, 64)), "")


def fold(leaf: Column, steps: str | Column) -> Column:
    """The root that a digest and a proof lead to."""
    def one(acc, s):
        side, other = F.substring(s, 1, 1), F.substring(s, 2, 64)
        return F.sha2(F.when(side == "<", F.concat(other, acc)).otherwise(F.concat(acc, other)), 256)
    return F.aggregate(steps, leaf, one)


def manifest(rows: DataFrame, columns: list[str], id_col: str = "doc_id", tree_col: str = "lang",
             extra: dict[str, Column] | None = None) -> DataFrame:
    """Every row's digest over ``columns`` and its proof: id, leaf, subroot,
    root, steps, and the ``extra`` columns (name -> expression over ``rows``)."""
    extra = extra or {}
    leaves = rows.select(F.col(tree_col).cast("string").alias("tree"), F.col(id_col).alias("id"),
                         digest(*[field(c) for c in columns]).alias("hash"),
                         *[c.alias(f"x_{k}") for k, c in extra.items()],
                         F.monotonically_increasing_id().alias("row_no"))
    leaves = materialize(leaves, "merkle-leaves")
    order = [F.col("tree").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("hash"), F.col("row_no")]
    placed = ranked(leaves, order, "place")
    trees = materialize(placed.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")), "merkle-trees")
    start = trees.select(F.col("tree").alias("t"), "n", "first")
    nodes = placed.join(start, F.col("tree").eqNullSafe(F.col("t"))).withColumn("idx", F.col("place") - F.col("first"))
    carried = ["id", *[f"x_{k}" for k in extra]]
    pivots, roots = build(nodes.select("tree", "idx", "n", "hash", *carried), carried, "merkle-part")

    # the parts' roots are the leaves of one more tree
    count = trees.count()
    tops = ranked(materialize(roots, "merkle-roots"), [F.col("tree").asc_nulls_first()], "idx")
    tops = tops.select(F.lit(0).cast("long").alias("tree"), "idx", F.lit(count).cast("long").alias("n"), "hash", F.col("tree").alias("part"))
    top_pivots, top = build(tops, ["part"], "merkle-top")
    first = top.first()
    root = F.lit(first["hash"] if first else None).cast("string")
    end = top.select("tree", root.alias("root"), F.array().cast("array<string>").alias("steps"))
    above = proofs(top_pivots, end).select(F.col("leaf.part").alias("tree"), F.col("leaf.hash").alias("root"), "steps")
    return proofs(pivots, materialize(above, "merkle-above")).select(
        F.col("leaf.id").alias(id_col), F.col("leaf.hash").alias("leaf"), F.col("root").alias("subroot"), root.alias("root"), "steps",
        *[F.col(f"leaf.x_{k}").alias(k) for k in extra])
