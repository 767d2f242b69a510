"""Global row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispan.sources.workspace import materialized


def with_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position of each row in ``order`` (which must be total).

    A distributed sort numbers rows within each sorted partition; the offsets
    come from one count per partition. The sorted rows are written out, so both
    uses see the same partitions, also after an executor is lost.
    """
    numbered = df.orderBy(*order).select(
        "*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_id")
    )
    numbered = materialized(numbered)
    # One row per sorted partition: bounded by spark.sql.shuffle.partitions.
    sizes = numbered.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_p", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = numbered.join(F.broadcast(offsets), "_p")
    rank = F.col("_before") + F.col("_id") - F.col("_first") + 1
    return ranked.select(*df.columns, rank.alias(name))
