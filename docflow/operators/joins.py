"""Join helpers for skewed keys and bounded broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes a dimension may have to be broadcast; past it, shuffle.
MAX_BROADCAST_BYTES = 64 << 20


def checked_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES):
    """``broadcast(df)`` if its size in bytes is proven small, else ``None``.
    Used for dimension tables read from one file; measuring costs one pass."""
    size = df.select(F.octet_length(F.to_csv(F.struct(*df.columns))).alias("n")).agg(F.sum("n")).first()[0]
    return F.broadcast(df) if (size or 0) <= max_bytes else None


def skew_join(left: DataFrame, right: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a ``left`` whose keys may be hot to a ``right`` with unique keys.

    Both sides reach the join through an exchange of their own (``right`` must
    be read from a table or checkpoint, not sit on an aggregation by the same
    keys), so adaptive execution can split a hot key's rows over many tasks and
    hand each its one right row.  The plan is the same at every size."""
    return left.join(right, on, how)
