"""Loading documents whose names may repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.operators.ranking import with_rank


def unique_names(docs: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """Add ``doc_id``: the name, or ``name (n)`` if that name was already taken.

    ``n`` is the document's place in arrival order. A name is taken by an
    earlier document of that name, or by one whose generated name it equals. If
    a generated name equals a given one, the later document replaces the
    earlier. Joins are on the arrival number, so a name shared by a large part
    of the corpus makes no large group.
    """
    arrived = with_rank(docs, order, "_n").withColumn("_name", F.col(name))
    firsts = arrived.groupBy("_name").agg(F.min("_n").alias("_n")).select("_n", F.lit(True).alias("_is_first"))
    repeats = arrived.select("_n", "_name").join(firsts, "_n", "left_anti")
    # Given names of the form "name (n)" where the n-th arrival got just that name.
    parts = arrived.select(
        "_n",
        F.regexp_extract("_name", r"^(.*) \((\d+)\)$", 1).alias("_base"),
        F.regexp_extract("_name", r"^(.*) \((\d+)\)$", 2).try_cast("long").alias("_of"),
    ).where(F.col("_of") < F.col("_n"))
    generated = repeats.select(F.col("_n").alias("_of"), F.col("_name").alias("_base"))
    echoed = parts.join(generated, ["_of", "_base"], "left_semi").select("_n", F.lit(True).alias("_is_echo"))
    marked = arrived.join(firsts, "_n", "left").join(echoed, "_n", "left")
    keeps = F.col("_is_first").isNotNull() & F.col("_is_echo").isNull()
    suffixed = F.format_string("%s (%d)", "_name", "_n")
    named = marked.withColumn("doc_id", F.when(keeps, F.col("_name")).otherwise(suffixed))
    latest = named.groupBy("doc_id").agg(F.max("_n").alias("_n")).select("_n")
    return named.join(latest, "_n", "left_semi").select("doc_id", *docs.columns)
