"""The same results in plain SQL, written against the given tables."""

from __future__ import annotations

from catalog.corpora import APPENDIX, BODY_END, BODY_START
from lexispan.functions.stopwords import BROWSER_STOPWORDS, CORE_STOPWORDS
from lexispan.functions.text import FOLD_SPECIALS


def fold(text: str) -> str:
    for char in FOLD_SPECIALS:
        text = f"replace({text}, '{char}', '{char.casefold()}')"
    return f"lower({text})"


def words_in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def literal(text: str) -> str:
    return "'" + text.replace("\n", "' || chr(10) || '") + "'"


BREAKS = r"\r\n|[\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
SPACES = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

DOCUMENTS = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents"
NATIVE_DOCUMENTS = "SELECT doc_id, text FROM documents"
TURNS = "SELECT 'c' || conv_id || ':' || turn AS doc_id, text FROM conversations"
PAGES = "SELECT 'p' || page_id AS doc_id, html AS text FROM pages"
EDITED = f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id,
    CASE WHEN lang = 'de' THEN text || {literal(APPENDIX)} ELSE text END AS text FROM documents"""
LATER = f"{EDITED} UNION ALL {PAGES}"
IN_ORDER = f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN lang = 'es' THEN text || {literal(APPENDIX)} ELSE text END AS text
    FROM documents WHERE lang IS DISTINCT FROM 'fr'"""


def line_ctes(docs: str) -> str:
    """CTE ``lines(doc_id, line_no, line)`` by the core rules."""
    return f"""docs AS ({docs}),
    parted AS (SELECT doc_id, string_split(regexp_replace(text, '{BREAKS}', chr(10), 'g'), chr(10)) AS l FROM docs),
    closed AS (SELECT doc_id, CASE WHEN l[len(l)] = '' THEN l[1:len(l)-1] ELSE l END AS l FROM parted),
    lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS line FROM closed)"""


def token_ctes(source: str = "lines", folded: str = fold("line")) -> str:
    return f"""listed AS (SELECT doc_id, line_no, regexp_extract_all({folded}, '[0-9a-z가-힣]+') AS t FROM {source}),
    tokens AS (SELECT doc_id, line_no, unnest(range(0, len(t))) AS pos, unnest(t) AS term FROM listed)"""


def posting_ctes(docs: str = DOCUMENTS) -> str:
    return f"""{line_ctes(docs)}, {token_ctes()},
    postings AS (SELECT term, doc_id, line_no, pos FROM tokens WHERE term NOT IN {words_in(CORE_STOPWORDS)})"""


class Part:
    """SQL of a search: what its spans and lines are."""

    def __init__(self, spans: str, lines: str | None = None) -> None:
        self.spans = spans
        self.lines = lines or f"SELECT DISTINCT doc_id, line_no FROM ({spans})"


UNIVERSE = "SELECT doc_id, line_no FROM lines"


def word(term: str) -> Part:
    return Part(f"SELECT doc_id, line_no, pos AS start_pos, pos AS end_pos FROM postings WHERE term = '{term}'")


def adjacent(*parts: Part) -> Part:
    left, *rest = parts
    for right in rest:
        left = Part(
            f"""SELECT DISTINCT a.doc_id, a.line_no, a.start_pos, b.end_pos FROM ({left.spans}) a JOIN ({right.spans}) b
            ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND a.end_pos + 1 = b.start_pos"""
        )
    return left


def any_of(*parts: Part) -> Part:
    return Part(*["(" + ") UNION (".join(getattr(p, side) for p in parts) + ")" for side in ("spans", "lines")])


def none_of(part: Part) -> Part:
    none = "SELECT doc_id, line_no, pos AS start_pos, pos AS end_pos FROM postings WHERE false"
    return Part(none, f"{UNIVERSE} EXCEPT ({part.lines})")


def both_lines(left: Part, right: Part) -> Part:
    lines = f"({left.lines}) INTERSECT ({right.lines})"
    return Part(
        f"""SELECT DISTINCT s.* FROM (({left.spans}) UNION ({right.spans})) s
        JOIN ({lines}) l ON s.doc_id = l.doc_id AND s.line_no = l.line_no""",
        lines,
    )


ci, n, de, la = (word(w) for w in ("ci", "n", "de", "la"))
CI_N = adjacent(ci, n)
DE_OR_LA = any_of(de, la)
GROUP = both_lines(any_of(ci, de, word("zzz")), any_of(n, adjacent(la, la), none_of(word("un"))))
MARKED = any_of(CI_N, both_lines(de, none_of(la)))

SEARCHES = {
    "word_search": ci,
    "stopword_search": word("the"),
    "adjacent": CI_N,
    "phrase3": adjacent(de, ci, n),
    "repeated_word": adjacent(de, de),
    "any_of": DE_OR_LA,
    "any_of_phrases": any_of(CI_N, adjacent(de, la), word("aux")),
    "none_of": none_of(de),
    "none_of_stopword": none_of(word("the")),
    "none_of_twice": none_of(none_of(de)),
    "any_of_with_not": any_of(ci, none_of(de)),
    "adjacent_with_not": both_lines(de, none_of(la)),
    "two_exclusions": both_lines(none_of(de), none_of(la)),
    "both_lines": both_lines(de, la),
    "group_adjacent": adjacent(any_of(ci, de), any_of(n, la)),
    "mixed_lengths": adjacent(any_of(ci, adjacent(de, ci)), any_of(n, adjacent(n, de))),
}


def search(body: str, docs: str = DOCUMENTS) -> str:
    return f"WITH {posting_ctes(docs)} {body}"


def occurrences(part: Part) -> str:
    return f"(SELECT count(*) FROM ({part.spans}))"


# Query words and the exact phrases of GROUP, in the order a report shows them.
GROUP_WORDS = ("ci", "de", "zzz", "n", "la", "un")
GROUP_PHRASES = tuple(
    dict.fromkeys([("la", "la")] + [(a, *b) for a in ("ci", "de", "zzz") for b in (("n",), ("la", "la"))])
)
WORD_COUNTS = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS ordinal, '{w}' AS label, {occurrences(word(w))} AS n" for i, w in enumerate(GROUP_WORDS, 1)
)
PHRASE_COUNTS = " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS ordinal, '{' && '.join(p)}' AS label, {occurrences(adjacent(*map(word, p)))} AS n"
    for i, p in enumerate(GROUP_PHRASES, 1)
)


def label(text: str, n: str) -> str:
    return f"{text} || ': ' || {n} || CASE WHEN {n} = 1 THEN ' occurrence' ELSE ' occurrences' END"


def with_text(part: Part) -> str:
    return f"SELECT l.doc_id, l.line_no, l.line FROM lines l JOIN ({part.lines}) k ON l.doc_id = k.doc_id AND l.line_no = k.line_no"


RESULT = "'(' || line_no || ') ' || doc_id || ': ' || line"
RANKED = f"SELECT doc_id, line_no, row_number() OVER (ORDER BY lower(doc_id), line_no, doc_id) AS rank FROM ({DE_OR_LA.lines})"
TOTALS = "SELECT term, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM postings GROUP BY term"

STATES = f"""before AS ({DOCUMENTS} UNION ALL {TURNS}), after AS ({LATER}),
    pairs AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.text AS new_text, b.text AS old_text,
        a.doc_id IS NULL AS gone, b.doc_id IS NOT NULL AS known FROM after a FULL JOIN before b ON a.doc_id = b.doc_id),
    actions AS (SELECT doc_id, known, CASE WHEN gone THEN 'deleted' WHEN NOT known THEN 'new'
        WHEN new_text = old_text THEN 'skipped' ELSE 'updated' END AS action FROM pairs)"""

FRAMED = f"""SELECT doc_id, CASE lang
    WHEN 'de' THEN 'h' || chr(10) || '{BODY_START}' || chr(10) || text || chr(10) || '{BODY_END}' || chr(10) || 'f' || chr(10)
    WHEN 'fr' THEN 'h' || chr(10) || '{BODY_END}' || chr(10) || text || chr(10) || '{BODY_START}' || chr(10) || 'f' || chr(10)
    WHEN 'es' THEN 'h' || chr(10) || '{BODY_START}' || chr(10) || text || chr(10)
    ELSE text END AS text FROM documents"""

TREE = "SELECT 'lang=' || lang || '/doc=' || doc_id || '.txt' AS doc_id, text || chr(10) AS text FROM documents"

ORACLES: dict[str, str] = {
    "lines": f"WITH {line_ctes(NATIVE_DOCUMENTS)} SELECT doc_id, line_no, line FROM lines",
    "lines_browser": r"""WITH parted AS (SELECT doc_id, string_split(regexp_replace(text, '\r\n', chr(10), 'g'), chr(10)) AS l FROM documents)
        SELECT doc_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS line FROM parted""",
    "case_fold": f"SELECT doc_id, {fold('text')} AS folded FROM documents",
    "case_fold_browser": "SELECT doc_id, lower(text) AS folded FROM documents",
    "normalized": f"SELECT doc_id, regexp_replace({fold('text')}, '[^0-9a-zA-Z가-힣{SPACES}]+', ' ', 'g') AS normalized FROM documents",
    "tokens": f"WITH {line_ctes(NATIVE_DOCUMENTS)}, {token_ctes()} SELECT doc_id, line_no, pos, term FROM tokens",
    "stopwords_removed": f"WITH {posting_ctes(NATIVE_DOCUMENTS)} SELECT term, doc_id, line_no, pos FROM postings",
    "stopwords_from_table": f"""WITH {line_ctes(NATIVE_DOCUMENTS)}, {token_ctes()},
        items AS (SELECT unnest(regexp_extract_all({fold('text')}, '[0-9a-z가-힣]+')) AS term FROM benchmark)
        SELECT term, doc_id, line_no, pos FROM tokens WHERE term NOT IN (SELECT term FROM items)""",
    "postings_browser": f"""WITH parted AS (SELECT doc_id, string_split(regexp_replace(text, '\\r\\n', chr(10), 'g'), chr(10)) AS l FROM documents),
        lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS line FROM parted),
        {token_ctes(folded='lower(line)')}
        SELECT term, doc_id, line_no, pos FROM tokens WHERE term NOT IN {words_in(BROWSER_STOPWORDS)}""",
    "bom_stripped": "SELECT doc_id, text FROM documents",
    "document_keys": "SELECT doc_id, substr(sha256(CAST(doc_id AS VARCHAR)), 1, 16) AS key FROM documents",
    "body_range": f"""WITH {line_ctes(FRAMED)},
        marks AS (SELECT doc_id,
            min(CASE WHEN contains({fold('line')}, '*** start of the project gutenberg ebook') THEN line_no END) AS s,
            min(CASE WHEN contains({fold('line')}, '*** end of the project gutenberg ebook') THEN line_no END) AS e
            FROM lines GROUP BY doc_id)
        SELECT l.doc_id, l.line_no FROM lines l JOIN marks m ON l.doc_id = m.doc_id
        WHERE NOT coalesce(s < e, false) OR (line_no > s AND line_no < e)""",
    "line_universe_stored": f"WITH {line_ctes(DOCUMENTS)} {UNIVERSE}",
    "postings": search("SELECT term, doc_id, line_no, pos FROM postings"),
    "document_index": search(
        """SELECT doc_id, term, string_agg(line_no || ':' || pos, ',' ORDER BY line_no, pos) AS entries
        FROM postings GROUP BY doc_id, term"""
    ),
    "master_index": search("SELECT DISTINCT term, doc_id, line_no, pos FROM postings"),
    "merged_indexes": f"WITH {posting_ctes(NATIVE_DOCUMENTS)} SELECT term, doc_id, line_no, pos FROM postings",
    "term_frequency": search("SELECT doc_id, term, count(*) AS tf FROM postings GROUP BY doc_id, term"),
    "term_totals": search(TOTALS),
    "line_difference": search(f"({de.lines}) EXCEPT ({la.lines})"),
    "conversation_search": search(SEARCHES["group_adjacent"].spans, TURNS),
    "page_search": search(adjacent(word("meta"), word("charset"), word("utf"), word("8")).spans, PAGES),
    "occurrence_count": search(f"SELECT count(*) AS occurrences FROM ({CI_N.spans})"),
    "line_count": search(f"SELECT count(*) AS matching_lines FROM ({CI_N.lines})"),
    "word_counts": search(WORD_COUNTS),
    "phrase_alternatives": search(PHRASE_COUNTS),
    "count_labels": search(f"SELECT term, {label('term', 'n')} AS text FROM ({TOTALS})"),
    "document_count": "SELECT count(DISTINCT doc_id) AS documents FROM documents",
    "matching_lines_text": search(f"SELECT doc_id, line_no, line, {RESULT} AS result FROM ({with_text(CI_N)})"),
    "remaining_lines_text": search(f"SELECT doc_id, line_no, line, {RESULT} AS result FROM ({with_text(none_of(de))})"),
    "result_order": search(RANKED),
    # Names are digits only, which Unicode collation orders like bytes.
    "result_order_locale": search(RANKED),
    "results_by_document": search(
        f"""SELECT doc_id, count(*) AS n_lines, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS line_numbers
        FROM ({DE_OR_LA.lines}) GROUP BY doc_id"""
    ),
    "highlighted_lines": search(
        f"""SELECT doc_id, line_no, array_to_string(list_transform(
            regexp_extract_all(line, '[0-9a-zA-Z가-힣]+|[^0-9a-zA-Z가-힣]+'),
            lambda t: CASE WHEN lower(t) IN ('ci', 'n', 'de', 'la') THEN '<mark>' || t || '</mark>' ELSE t END), '') AS highlighted
        FROM ({with_text(MARKED)})"""
    ),
    "report": search(
        f"""SELECT 'word' AS section, ordinal, {label('label', 'n')} AS text FROM ({WORD_COUNTS})
        UNION ALL SELECT 'phrase', ordinal, {label('label', 'n')} FROM ({PHRASE_COUNTS})
        UNION ALL SELECT 'summary', {occurrences(GROUP)},
            'Found ' || (SELECT count(*) FROM ({GROUP.lines})) || ' matching line(s).'
        UNION ALL SELECT 'line', row_number() OVER (ORDER BY lower(doc_id), line_no, doc_id), {RESULT} FROM ({with_text(GROUP)})"""
    ),
    "saved_searches": f"""WITH {posting_ctes()},
        item_docs AS (SELECT item_id, string_split(regexp_replace(text, '{BREAKS}', chr(10), 'g'), chr(10)) AS l FROM benchmark),
        item_lines AS (SELECT item_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS line FROM item_docs),
        item_lists AS (SELECT item_id, line_no, regexp_extract_all({fold('line')}, '[0-9a-z가-힣]+') AS t FROM item_lines),
        item_words AS (SELECT item_id, line_no, unnest(range(0, len(t))) AS pos, unnest(t) AS term FROM item_lists),
        kept AS (SELECT * FROM item_words WHERE term NOT IN {words_in(CORE_STOPWORDS)}),
        saved AS (SELECT a.item_id || ':' || a.line_no || ':' || a.pos AS query_id, a.term AS first, b.term AS second
            FROM kept a JOIN kept b ON a.item_id = b.item_id AND a.line_no = b.line_no AND a.pos + 1 = b.pos),
        pairs AS (SELECT a.term AS first, b.term AS second, a.doc_id, a.line_no, count(*) AS n FROM postings a JOIN postings b
            ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND a.pos + 1 = b.pos GROUP BY ALL),
        found AS (SELECT first, second, sum(n) AS n, count(*) AS n_lines FROM pairs GROUP BY first, second)
        SELECT query_id, CAST(coalesce(n, 0) AS BIGINT) AS occurrences, CAST(coalesce(n_lines, 0) AS BIGINT) AS matching_lines
        FROM saved LEFT JOIN found ON saved.first = found.first AND saved.second = found.second""",
    "saved_exclusions": f"""WITH {posting_ctes()},
        item_docs AS (SELECT item_id, string_split(regexp_replace(text, '{BREAKS}', chr(10), 'g'), chr(10)) AS l FROM benchmark),
        item_lines AS (SELECT item_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS line FROM item_docs),
        item_lists AS (SELECT item_id, line_no, regexp_extract_all({fold('line')}, '[0-9a-z가-힣]+') AS t FROM item_lines),
        item_words AS (SELECT item_id, line_no, unnest(range(0, len(t))) AS pos, unnest(t) AS term FROM item_lists),
        kept AS (SELECT *, first_value(term) OVER (PARTITION BY item_id, line_no ORDER BY pos) AS c
            FROM item_words WHERE term NOT IN {words_in(CORE_STOPWORDS)}),
        saved AS (SELECT a.item_id || ':' || a.line_no || ':' || a.pos AS query_id, a.term AS a, b.term AS b, a.c AS c
            FROM kept a JOIN kept b ON a.item_id = b.item_id AND a.line_no = b.line_no AND a.pos + 1 = b.pos),
        pairs AS (SELECT DISTINCT a.term AS x, b.term AS y, a.doc_id, a.line_no FROM postings a JOIN postings b
            ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND a.pos + 1 = b.pos),
        words AS (SELECT DISTINCT term, doc_id, line_no FROM postings),
        found AS (SELECT query_id, p.doc_id, p.line_no FROM saved JOIN pairs p ON p.x = a AND p.y = b
                ANTI JOIN words w ON w.term = c AND w.doc_id = p.doc_id AND w.line_no = p.line_no
            UNION SELECT query_id, p.doc_id, p.line_no FROM saved JOIN pairs p ON p.y = a AND p.x IN (a, b)),
        barred AS (SELECT query_id, count(*) AS n FROM saved JOIN pairs p ON p.x = a AND p.y = b GROUP BY query_id)
        SELECT s.query_id, count(f.doc_id) AS matching_lines FROM saved s LEFT JOIN found f ON f.query_id = s.query_id GROUP BY s.query_id
        UNION ALL SELECT s.query_id || ':not', (SELECT count(*) FROM lines) - coalesce(n, 0) FROM saved s LEFT JOIN barred b ON b.query_id = s.query_id""",
    "snapshot_diff": f"WITH {STATES} SELECT doc_id, action, known FROM actions",
    "build_summary": f"""WITH {STATES} SELECT count(*) FILTER (WHERE action = 'new') AS new,
        count(*) FILTER (WHERE action = 'updated') AS updated, count(*) FILTER (WHERE action = 'skipped') AS skipped,
        count(*) FILTER (WHERE action = 'deleted') AS deleted, CAST(0 AS BIGINT) AS failed FROM actions""",
    "action_log": f"""WITH {STATES} SELECT doc_id, action,
        row_number() OVER (ORDER BY action = 'deleted', lower(doc_id), doc_id) AS rank FROM actions""",
    "index_upsert": search("SELECT term, doc_id, line_no, pos FROM postings", LATER),
    "index_upsert_lines": f"WITH {line_ctes(LATER)} SELECT doc_id, line_no, line FROM lines",
    "manifest": f"SELECT doc_id, CAST(strlen(text) AS BIGINT) AS size, CAST(2 AS BIGINT) AS index_version FROM ({LATER})",
    "failed_fallback": f"""WITH {line_ctes(EDITED)}
        SELECT l.doc_id, line_no, line, CASE lang WHEN 'de' THEN 'updated' WHEN 'fr' THEN 'failed' ELSE 'skipped' END AS action
        FROM lines l JOIN documents d ON l.doc_id = CAST(d.doc_id AS VARCHAR)""",
    "rebuilt_postings": search(TOTALS, LATER),
    "compacted_index": search(TOTALS, LATER),
    "streamed_arrivals": search(TOTALS),
    "mixed_versions": f"""WITH {line_ctes(DOCUMENTS)}, counted AS (SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id)
        SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, CASE WHEN lang = 'fr' THEN 'updated' ELSE 'skipped' END AS action, true AS known,
            coalesce(n_lines, 0) AS n_lines FROM documents d LEFT JOIN counted c ON c.doc_id = CAST(d.doc_id AS VARCHAR)""",
    "late_change": f"WITH {line_ctes(IN_ORDER)} SELECT doc_id, line_no, line FROM lines",
    "streamed_changes": search(TOTALS, IN_ORDER),
    "deleted_documents": "SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents WHERE lang IS DISTINCT FROM 'fr'",
    "text_files": f"WITH {line_ctes(TREE)} SELECT doc_id, line_no, line FROM lines",
    "fingerprints": f"SELECT doc_id, CAST(strlen(text) AS BIGINT) AS size, CAST(2 AS BIGINT) AS index_version FROM ({TREE})",
    "repeated_names": """WITH numbered AS (SELECT doc_id AS arrival, source, row_number() OVER (ORDER BY doc_id) AS n,
            row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents)
        SELECT arrival, CASE WHEN k = 1 THEN source ELSE source || ' (' || n || ')' END AS doc_id FROM numbered""",
}

for _name, _part in SEARCHES.items():
    ORACLES[f"{_name}_spans"] = search(f"SELECT doc_id, line_no, start_pos, end_pos FROM ({_part.spans})")
    ORACLES[f"{_name}_lines"] = search(f"SELECT doc_id, line_no FROM ({_part.lines})")
