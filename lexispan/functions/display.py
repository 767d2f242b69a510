"""Column expressions that format results for people."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispan.functions.text import FOLDED_WORD, WORD_CLASS


def result_line(line_no: Column, doc_id: Column, line: Column) -> Column:
    """``(line_no) name: text``"""
    return F.format_string("(%d) %s: %s", line_no, doc_id.cast("string"), line)


def count_label(label: Column, n: Column) -> Column:
    """``label: n occurrences``, singular at one."""
    noun = F.when(n == 1, "occurrence").otherwise("occurrences")
    return F.format_string("%s: %d %s", label, n, noun)


def highlight(line: Column, words: Iterable[str], before: str = "<mark>", after: str = "</mark>") -> Column:
    """Mark every whole word of ``line`` that equals one of ``words``, ignoring ASCII case."""
    # A query word with other characters equals no word of a text.
    wanted = sorted({w.lower() for w in words if re.fullmatch(FOLDED_WORD, w.lower())}, key=lambda w: (-len(w), w))
    if not wanted:
        return line
    pattern = rf"(?i)(?<![{WORD_CLASS}])({'|'.join(wanted)})(?![{WORD_CLASS}])"
    escape = re.compile(r"([\\$])")
    return F.regexp_replace(line, pattern, escape.sub(r"\\\1", before) + "$1" + escape.sub(r"\\\1", after))
