"""Matching lines as people read them: text, order, format, highlighting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.functions import display
from lexispan.functions.text import fold_name
from lexispan.operators.search import Hits


def name_order() -> list[Column]:
    """Folded name, then line; the exact name decides between names that fold alike."""
    name = F.col("doc_id").cast("string")
    return [fold_name(name), F.col("line_no"), name]


def locale_order() -> list[Column]:
    """Name in Unicode collation order, then line."""
    name = F.col("doc_id").cast("string")
    return [F.collate(name, "UNICODE"), F.col("line_no"), name]


def result_lines(hits: Hits) -> DataFrame:
    """``(doc_id, line_no, line, result)`` of every matching line, unordered."""
    result = display.result_line(F.col("line_no"), F.col("doc_id"), F.col("line"))
    return hits.lines_with_text.select("doc_id", "line_no", "line", result.alias("result"))


def ordered_results(hits: Hits, locale: bool = False) -> DataFrame:
    """The result listing in display order (a distributed sort)."""
    return result_lines(hits).orderBy(*(locale_order() if locale else name_order()))


def highlighted_lines(hits: Hits, before: str = "<mark>", after: str = "</mark>") -> DataFrame:
    """Matching lines with every query word marked, the excluded words too."""
    marked = display.highlight(F.col("line"), hits.words, before, after)
    return hits.lines_with_text.select("doc_id", "line_no", marked.alias("highlighted"))


def results_by_document(hits: Hits) -> DataFrame:
    """``(doc_id, n_lines, line_numbers)`` per document with a match.

    The array holds the line numbers of one document, never of several.
    """
    return hits.lines.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.sort_array(F.collect_list("line_no")).alias("line_numbers")
    )
