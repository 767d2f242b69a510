"""Positional text search on Spark: line and posting tables, phrase and Boolean search."""

from lexispan.operators.lines import document_lines, line_universe
from lexispan.operators.postings import line_postings, line_tokens
from lexispan.operators.search import Hits, Searcher
from lexispan.plans.index import TextIndex
from lexispan.plans.report import search_report
from lexispan.sources.corpus import Corpus, table_corpus, text_tree, text_tree_stream
from lexispan.streaming.arrivals import index_stream

__all__ = [
    "Corpus", "Hits", "Searcher", "TextIndex", "document_lines", "index_stream", "line_postings", "line_tokens",
    "line_universe", "search_report", "table_corpus", "text_tree", "text_tree_stream",
]
