"""Column expressions for the text rules: folding, line splitting, tokenising.

Everything here is built from JVM-side functions, so a projection over these
expressions stays a narrow, Arrow-free stage.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as part of a word, after and before folding.
FOLDED_WORD = "[0-9a-z가-힣]+"
WORD_CLASS = "0-9a-zA-Z가-힣"

# Characters whose full case fold differs from lower-casing in a
# way that changes the words of a text (each maps to its ``str.casefold``).
FOLD_SPECIALS = "ßẞſŉǰẖẗẘẙẚİﬀﬁﬂﬃﬄﬅﬆ"

# Line boundaries besides "\n"; "\r\n" is a single boundary.
OTHER_LINE_BREAKS = r"\r\n|[\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

# Lines holding these (after folding) delimit a book's body.
BODY_START = "*** start of the project gutenberg ebook"
BODY_END = "*** end of the project gutenberg ebook"


def fold(text: Column) -> Column:
    """Case-fold for tokenising.

    Rows without any special character (nearly all) take the plain ``lower``
    branch. The probe for one goes from cheap to exact: all-ASCII rows end with
    the length comparison, most others with a search over one character range.
    """
    expanded = text
    for char in FOLD_SPECIALS:
        expanded = F.replace(expanded, F.lit(char), F.lit(char.casefold()))
    others = sorted(set(FOLD_SPECIALS) - {"ß"})
    in_range = text.rlike(f"[{others[0]}-{others[-1]}]") & text.rlike(f"[{''.join(others)}]")
    special = (F.octet_length(text) != F.length(text)) & (text.contains("ß") | in_range)
    return F.lower(F.when(special, expanded).otherwise(text))


@lru_cache(maxsize=1)
def _fold_table() -> tuple[dict[str, str], dict[str, str]]:
    """All characters whose fold is not their lower case: (one-to-one, expanding)."""
    single, expanding = {"Σ": "σ"}, {}
    for code in range(0x110000):
        char = chr(code)
        folded = char.casefold()
        if folded != char.lower():
            (single if len(folded) == 1 else expanding)[char] = folded
    return single, expanding


def fold_name(name: Column) -> Column:
    """Complete case fold, used as the sort key of document names."""
    single, expanding = _fold_table()
    expanded = name
    for char, replacement in expanding.items():
        expanded = F.replace(expanded, F.lit(char), F.lit(replacement))
    complete = F.translate(F.lower(expanded), "".join(single), "".join(single.values()))
    return F.when(name.rlike(r"[^\x00-\x7F]"), complete).otherwise(F.lower(name))


def folded(text: Column, mode: str = "full") -> Column:
    """``full`` case folding, or plain ``lower`` (the browser rule)."""
    if mode not in ("full", "lower"):
        raise ValueError(f"fold mode must be 'full' or 'lower', not {mode!r}")
    return fold(text) if mode == "full" else F.lower(text)


def normalize(text: Column, mode: str = "full") -> Column:
    """Fold, then turn each run of characters that belong to no word into a space.

    Whitespace of any script stays as it is.
    """
    return F.regexp_replace(folded(text, mode), rf"(?U)[^{WORD_CLASS}\s\x1c-\x1f]+", " ")


def tokens(text: Column, mode: str = "full") -> Column:
    """Array of the words of ``text`` in order; the array index is the position."""
    return F.regexp_extract_all(folded(text, mode), F.lit(FOLDED_WORD), F.lit(0))


def strip_bom(text: Column) -> Column:
    return F.regexp_replace(text, r"^\uFEFF", "")


def split_lines(text: Column, mode: str = "core") -> Column:
    """Array of lines.

    ``core``: every Unicode line boundary ends a line, and a trailing boundary
    adds no empty line. ``browser``: a leading BOM is dropped, only ``\\r?\\n``
    ends a line, and a trailing one does add an empty line.
    """
    if mode == "browser":
        return F.split(strip_bom(text), r"\r?\n")
    if mode != "core":
        raise ValueError(f"split mode must be 'core' or 'browser', not {mode!r}")
    unified = F.when(
        text.rlike(OTHER_LINE_BREAKS), F.regexp_replace(text, OTHER_LINE_BREAKS, "\n")
    ).otherwise(text)
    # One final boundary closes the last line instead of opening another.
    closed = F.when(unified.endswith("\n"), F.substr(unified, F.lit(1), F.length(unified) - 1))
    lines = F.split(F.coalesce(closed, unified), "\n")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(lines)


def first_line_with(lines: Column, marker: str, mode: str = "full") -> Column:
    """1-based number of the first line containing ``marker`` once folded; 0 if none."""
    hits = F.transform(lines, lambda line: folded(line, mode).contains(marker))
    return F.array_position(hits, True)


def document_key(doc_id: Column) -> Column:
    """Short stable key of a document name: 16 hex digits of its SHA-256."""
    return F.substring(F.sha2(doc_id.cast("string"), 256), 1, 16)
