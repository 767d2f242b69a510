"""Plain-Python statement of the search rules, for comparison on small fixtures."""

import re

from lexispan.functions.stopwords import CORE_STOPWORDS

BREAKS = "\n\v\f\x1c\x1d\x1e\x85\u2028\u2029"


def lines_of(text):
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    return re.sub(rf"[{BREAKS}]\Z", "", re.sub(f"[{BREAKS}]", "\n", text)).split("\n") if text else []


def words_of(line):
    return re.findall("[0-9a-z가-힣]+", line.casefold())


class Corpus:
    def __init__(self, docs):
        self.lines, self.spans = {}, {}
        for doc_id, text in docs.items():
            lines = lines_of(text)
            first = {
                word: next((i for i, line in enumerate(lines) if f"*** {word} of the project gutenberg ebook" in line.casefold()), None)
                for word in ("start", "end")
            }
            start, end = first["start"], first["end"]
            body = start is not None and end is not None and start < end
            for i, line in enumerate(lines):
                if body and not start < i < end:
                    continue
                self.lines[doc_id, i + 1] = line
                for pos, word in enumerate(words_of(line)):
                    if word not in CORE_STOPWORDS:
                        self.spans.setdefault(word, set()).add((doc_id, i + 1, pos, pos))

    def search(self, query):
        """``query`` is a word or (operator, part, ...): -> (lines, spans, has_not)."""
        if isinstance(query, str):
            spans = self.spans.get(query.casefold(), set())
            return {s[:2] for s in spans}, spans, False
        operator, *parts = query
        done = [self.search(part) for part in parts]
        if operator == "none_of":
            return set(self.lines) - done[0][0], set(), True
        result = done[0]
        for other in done[1:]:
            if operator == "any_of":
                result = result[0] | other[0], result[1] | other[1], result[2] or other[2]
            elif operator == "both_lines" or result[2] or other[2]:
                shared = result[0] & other[0]
                spans = {s for s in result[1] | other[1] if s[:2] in shared}
                result = shared, spans, result[2] or other[2]
            else:
                spans = {(*a[:3], b[3]) for a in result[1] for b in other[1] if a[:2] == b[:2] and a[3] + 1 == b[2]}
                result = {s[:2] for s in spans}, spans, False
        return result
