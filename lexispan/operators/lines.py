"""Documents to numbered lines, with the searchable body range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.functions import text as T


def with_line_arrays(docs: DataFrame, split_mode: str = "core", fold_mode: str = "full") -> DataFrame:
    """Replace ``text`` by the array ``_lines`` and the body limits ``_start`` and ``_end``.

    The body range is found inside each row, so no shuffle gathers the lines of
    a document again; texts that never say "gutenberg" skip the marker search.
    """
    rest = [c for c in docs.columns if c != "text"]
    marked = F.col("text").rlike("(?i)gutenberg").alias("_marked")
    split = docs.select(*rest, marked, T.split_lines(F.col("text"), split_mode).alias("_lines"))

    def limit(marker: str) -> Column:
        return F.when(F.col("_marked"), T.first_line_with(F.col("_lines"), marker, fold_mode)).otherwise(0)

    return split.select(*rest, "_lines", limit(T.BODY_START).alias("_start"), limit(T.BODY_END).alias("_end"))


def is_searchable(line_no: Column) -> Column:
    """Strictly between the markers if both occur in order, else everywhere."""
    start, end = F.col("_start"), F.col("_end")
    in_order = (start > 0) & (start < end)
    return ~in_order | ((line_no > start) & (line_no < end))


def document_lines(docs: DataFrame, split_mode: str = "core", fold_mode: str = "full") -> DataFrame:
    """``docs(doc_id, text)`` to ``lines(doc_id, line_no, line, searchable)``."""
    arrays = with_line_arrays(docs.select("doc_id", "text"), split_mode, fold_mode)
    # The outer form, as Spark would otherwise add a filter that splits every text once more.
    numbered = arrays.select("doc_id", "_start", "_end", F.posexplode_outer("_lines").alias("_i", "line"))
    line_no = F.col("_i") + 1
    return numbered.where(F.col("_i").isNotNull()).select(
        "doc_id", line_no.alias("line_no"), "line", is_searchable(line_no).alias("searchable")
    )


def line_universe(lines: DataFrame) -> DataFrame:
    """Keys of all searchable lines, blank ones included."""
    return lines.where("searchable").select("doc_id", "line_no")
