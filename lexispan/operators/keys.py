"""Broadcasting behind a check of size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# A side may be broadcast only when it has at most this many rows and bytes.
MAX_ROWS = 1_000_000
MAX_BYTES = 64 << 20


def measures(df: DataFrame) -> list[Column]:
    """Aggregates ``n`` and ``bytes`` of the rows of ``df``."""
    strings = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    width = sum((F.coalesce(F.octet_length(name), F.lit(0)) for name in strings), F.lit(16 * len(df.columns)))
    return [F.count("*").alias("n"), F.sum(width.cast("long")).alias("bytes")]


def fits(row: Row) -> bool:
    return row["n"] <= MAX_ROWS and (row["bytes"] or 0) <= MAX_BYTES


def is_small(df: DataFrame) -> bool:
    """Measure ``df`` with one aggregate that only moves partial counts."""
    return fits(df.agg(*measures(df)).first())


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it is measurably small, else ``df`` itself.

    Without the hint the join shuffles, and AQE splits skewed partitions.
    """
    return F.broadcast(df) if is_small(df) else df
