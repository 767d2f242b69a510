import random

import pytest
from pyspark.sql import functions as F

import brute
from lexispan import Searcher, document_lines, line_postings, search_report
from lexispan.operators import counts, results
from lexispan.operators.ranking import with_rank
from lexispan.operators.search import LineSet
from lexispan.plans.saved import saved_search_counts, saved_search_spans

PEOPLE = {
    "people.txt": "Abe Lincoln spoke.\nAbraham Lincoln replied.\nAbe was called Lincoln.\nLincoln Lincoln Lincoln.\n",
    "korean.txt": "대한민국 헌법\n대한민국 국민\n",
    "gutenberg.txt": "header Lincoln\n*** START OF THE PROJECT GUTENBERG EBOOK SAMPLE ***\nAbe Lincoln body\n"
    "*** END OF THE PROJECT GUTENBERG EBOOK SAMPLE ***\nfooter Lincoln\n",
}


def searcher_over(spark, corpus):
    docs = spark.createDataFrame(list(corpus.items()), "doc_id string, text string")
    lines = document_lines(docs)
    return Searcher(lines, line_postings(lines))


@pytest.fixture(scope="module")
def people(spark):
    return searcher_over(spark, PEOPLE)


def lines(hits):
    rows = [tuple(r) for r in hits.lines.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def spans(hits):
    rows = [tuple(r) for r in hits.spans.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_words_phrases_and_body_range(people):
    assert counts.occurrence_count(people.word("Lincoln")).first()[0] == 7
    assert len(spans(people.adjacent("Abe", "Lincoln"))) == 2
    assert ("people.txt", 3) not in lines(people.adjacent("Abe", "Lincoln"))
    assert len(spans(people.adjacent(people.any_of("Abe", "Abraham"), "Lincoln"))) == 3
    assert ("people.txt", 3) in lines(people.any_of("Abe", people.adjacent("Abraham", "Lincoln")))
    assert lines(people.none_of("Lincoln")) == {("korean.txt", 1), ("korean.txt", 2)}
    assert lines(people.adjacent("대한민국", "헌법")) == {("korean.txt", 1)}
    assert len(spans(people.adjacent("lincoln", "LINCOLN"))) == 2


def test_ordered_listing(people):
    hits = people.any_of("Lincoln", "Abraham")
    assert [r.result for r in results.ordered_results(hits).collect()] == [
        "(3) gutenberg.txt: Abe Lincoln body",
        "(1) people.txt: Abe Lincoln spoke.",
        "(2) people.txt: Abraham Lincoln replied.",
        "(3) people.txt: Abe was called Lincoln.",
        "(4) people.txt: Lincoln Lincoln Lincoln.",
    ]


def test_names_order_by_folded_name(spark):
    s = searcher_over(spark, {"B.txt": "red", "a.txt": "red", "A.txt": "red\nred"})
    order = [(r.doc_id, r.line_no) for r in results.ordered_results(s.word("red")).collect()]
    assert order == [("A.txt", 1), ("a.txt", 1), ("A.txt", 2), ("B.txt", 1)]
    locale = [(r.doc_id, r.line_no) for r in results.ordered_results(s.word("red"), locale=True).collect()]
    assert [d for d, _ in locale][-1] == "B.txt"


def test_stopwords_and_accents_match_nothing(spark, people):
    assert spans(people.word("was")) == set()
    assert len(lines(people.none_of("was"))) == 7
    s = searcher_over(spark, {"d": "café\n\n"})
    assert spans(s.word("café")) == set() and len(spans(s.word("caf"))) == 1
    assert lines(s.none_of("caf")) == {("d", 2)}


def test_double_exclusion_keeps_lines_without_spans(people):
    twice = people.none_of(people.none_of("Abraham"))
    assert lines(twice) == {("people.txt", 2)} and spans(twice) == set() and twice.has_not


def test_all_ends_of_a_shared_start_count(spark):
    s = searcher_over(spark, {"d": "red blue green gold"})
    inner = s.any_of("blue", s.adjacent("blue", "green"))
    assert spans(s.adjacent("red", inner)) == {("d", 1, 0, 1), ("d", 1, 0, 2)}
    assert spans(s.adjacent(s.adjacent("red", inner), "gold")) == {("d", 1, 0, 3)}


def test_statistics(people):
    q = people.adjacent(people.any_of("Abe", people.none_of("Abraham")), "Lincoln")
    rows = search_report(q).statistics.orderBy(F.desc("section"), "ordinal").collect()
    assert [r.text for r in rows] == [
        "abe: 3 occurrences", "abraham: 1 occurrence", "lincoln: 7 occurrences", "abe && lincoln: 2 occurrences",
    ]
    nested = people.adjacent(people.adjacent("Lincoln", "Lincoln"), people.any_of("Lincoln", "spoke"))
    labels = [(r.label, r.n) for r in counts.phrase_counts(nested).orderBy("ordinal").collect()]
    assert labels == [
        ("lincoln && lincoln", 2), ("lincoln && lincoln && lincoln", 1), ("lincoln && lincoln && spoke", 0),
    ]
    assert counts.phrase_counts(people.word("Abe")).collect() == []
    summary = search_report(q).summary.first()
    assert summary.matching_lines == len(lines(q)) and summary.occurrences == len(spans(q))
    assert summary.message == f"Found {len(lines(q))} matching line(s)."
    assert search_report(people.word("nowhere")).summary.first().message == "No results found."


def test_grouped_and_highlighted_results(people):
    grouped = {r.doc_id: (r.n_lines, r.line_numbers) for r in results.results_by_document(people.word("lincoln")).collect()}
    assert grouped == {"people.txt": (4, [1, 2, 3, 4]), "gutenberg.txt": (1, [3])}
    q = people.adjacent("Abe", people.none_of("spoke"))
    marked = {r.doc_id: r.highlighted for r in results.highlighted_lines(q).collect()}
    assert marked == {"people.txt": "<mark>Abe</mark> was called Lincoln.", "gutenberg.txt": "<mark>Abe</mark> Lincoln body"}


def test_distinct_only_where_spans_can_coincide(spark, people):
    def shuffles(hits):
        return hits.spans._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")

    s = Searcher(people.lines.checkpoint(), people.postings.checkpoint())
    one_or_two = s.any_of("abe", s.adjacent("lincoln", "lincoln"))
    assert shuffles(s.word("abe")) == 0 and shuffles(s.adjacent("abe", "lincoln")) == 1
    assert shuffles(one_or_two) == 1
    assert shuffles(s.adjacent(one_or_two, "lincoln")) == 1
    assert shuffles(s.adjacent(one_or_two, s.any_of("body", s.adjacent("lincoln", "lincoln")))) == 3
    assert shuffles(s.any_of(s.adjacent("abe", "lincoln"), s.adjacent("lincoln", "spoke"))) == 3


def test_many_alternatives_cost_nothing_until_counted(people):
    pairs = [people.any_of("abe", "lincoln") for _ in range(60)]
    assert spans(people.adjacent(*pairs)) == set()


def test_long_phrases(spark):
    words = [f"w{i % 3}x" for i in range(150)]
    s = searcher_over(spark, {"d": " ".join(words)})
    assert spans(s.adjacent(*words[:130])) == {("d", 1, a, a + 129) for a in range(0, 21, 3)}


VOCABULARY = ["red", "blue", "green", "the", "missing"]


def random_query(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        return rng.choice(VOCABULARY)
    operator = rng.choice(["adjacent", "adjacent", "any_of", "any_of", "none_of", "both_lines"])
    size = {"none_of": 1, "both_lines": 2}.get(operator, rng.choice([2, 2, 3]))
    return (operator, *[random_query(rng, depth - 1) for _ in range(size)])


def build(s, query):
    if isinstance(query, str):
        return s.word(query)
    return getattr(s, query[0])(*[build(s, part) for part in query[1:]])


def test_random_compositions_match_brute_force(spark):
    rng = random.Random(11)
    corpus = {
        f"d{i}": "\n".join(" ".join(rng.choices(VOCABULARY[:4], k=rng.randrange(6))) for _ in range(5)) for i in range(4)
    }
    s = searcher_over(spark, corpus)
    s = Searcher(s.lines.cache(), s.postings.cache())
    expected = brute.Corpus(corpus)
    for _ in range(40):
        query = random_query(rng, 3)
        want_lines, want_spans, want_not = expected.search(query)
        hits = build(s, query)
        assert hits.has_not == want_not, query
        assert lines(hits) == want_lines, query
        assert spans(hits) == want_spans, query


@pytest.mark.parametrize("few_documents", [True, False])
def test_broad_searches_join_by_shuffle(people, monkeypatch, few_documents):
    def is_small(df):
        return few_documents and df.columns == ["doc_id"]

    monkeypatch.setattr("lexispan.operators.search.is_small", is_small)
    assert lines(people.none_of("Lincoln")) == {("korean.txt", 1), ("korean.txt", 2)}
    found = people.adjacent("abe", "lincoln").lines_with_text
    assert {(r.doc_id, r.line_no) for r in found.collect()} == {("people.txt", 1), ("gutenberg.txt", 3)}


def test_selective_search_does_not_shuffle_the_text(people):
    plan = people.adjacent("abe", "lincoln").lines_with_text._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_set_algebra_reads_no_universe(people):
    both = people.adjacent("abe", people.none_of("spoke"))
    assert isinstance(both.line_set, LineSet) and not both.line_set.excluded


@pytest.mark.parametrize("small", [True, False])
def test_saved_searches(spark, people, monkeypatch, small):
    monkeypatch.setattr("lexispan.plans.saved.is_small", lambda df: small)
    queries = {1: ["lincoln"], 2: ["abe", "lincoln"], 3: ["lincoln"] * 2, 4: ["abe", "nowhere"], 5: ["abe", "lincoln", "body"], 6: ["lincoln"] * 3, 7: ["was"], 8: ["abe", "lincoln", "replied"]}
    rows = [(q, i, w) for q, words in queries.items() for i, w in enumerate(words)]
    saved = spark.createDataFrame(rows, "query_id int, slot int, term string")
    got = {}
    for r in saved_search_spans(saved, people.postings).collect():
        got.setdefault(r.query_id, set()).add(tuple(r)[1:])
    for query_id, words in queries.items():
        assert got.get(query_id, set()) == spans(people.adjacent(*words))
    totals = {r.query_id: (r.occurrences, r.matching_lines) for r in saved_search_counts(saved, people.postings).collect()}
    assert totals == {1: (7, 5), 2: (2, 2), 3: (2, 1), 4: (0, 0), 5: (1, 1), 6: (1, 1), 7: (0, 0), 8: (0, 0)}


@pytest.mark.parametrize("small", [True, False])
def test_saved_searches_follow_the_word_rules(spark, people, monkeypatch, small):
    monkeypatch.setattr("lexispan.plans.saved.is_small", lambda df: small)
    slots = {
        "folded": [(0, "Abe"), (1, "LINCOLN")], "gap": [(0, "abe"), (2, "lincoln")], "late": [(1, "abe"), (2, "lincoln")],
        "either": [(0, "abe"), (0, "abraham"), (1, "lincoln"), (1, "was")], "either word": [(0, "Abe"), (0, "replied")],
        "three": [(0, "abe"), (0, "abraham"), (1, "lincoln"), (2, "replied"), (2, "body")], "null": [(0, "abe"), (1, None)],
    }
    saved = spark.createDataFrame([(q, *slot) for q, words in slots.items() for slot in words], "query_id string, slot int, term string")
    totals = {r.query_id: r.occurrences for r in saved_search_counts(saved, people.postings).collect()}
    s = people
    expected = {
        "folded": s.adjacent("abe", "lincoln"),
        "either": s.adjacent(s.any_of("abe", "abraham"), s.any_of("lincoln", "was")),
        "either word": s.any_of("abe", "replied"),
        "three": s.adjacent(s.any_of("abe", "abraham"), "lincoln", s.any_of("replied", "body")),
    }
    assert totals == {q: len(spans(expected[q])) if q in expected else 0 for q in slots}


def test_rank_is_global(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    assert {(r.v, r.rank) for r in with_rank(df, [F.col("v")]).collect()} == {(v, v + 1) for v in range(1000)}


def test_saved_searches_with_exclusions(spark, people):
    """Random searches in options of phrases, against the same search composed by calls."""
    from functools import reduce

    from lexispan.plans.saved_boolean import saved_boolean_counts, saved_boolean_lines

    rnd = random.Random(21)
    vocabulary = ["lincoln", "abe", "abraham", "george", "grew", "up", "Washington", "nowhere", "링컨"]
    s, rows, expected = people, [], {}
    for q in range(25):
        options = []
        for o in range(rnd.randrange(1, 3)):
            wanted, barred = [], []
            for c in range(rnd.randrange(1, 4)):
                excluded = rnd.random() < 0.4
                slots = [rnd.sample(vocabulary, rnd.randrange(1, 3)) for _ in range(rnd.randrange(1, 4))]
                rows += [(f"q{q}", o, c, excluded or None, i, w) for i, words in enumerate(slots) for w in words]
                clause = s.adjacent(*[s.any_of(*words) for words in slots])
                (barred if excluded else wanted).append(lines(clause))
            everything = {(r.doc_id, r.line_no) for r in s.lines.where("searchable").collect()}
            options.append(reduce(set.intersection, wanted, everything) - set().union(*barred))
        expected[f"q{q}"] = len(set().union(*options))
    rows += [("gap", 0, 0, False, 0, "lincoln"), ("gap", 0, 0, False, 2, "abe"), ("null", 0, 0, False, 0, None), ("half", 0, 0, False, 0, "lincoln"), ("half", 0, 0, False, 1, None)]
    expected |= {"gap": 0, "null": 0, "half": 0}
    saved = spark.createDataFrame(rows, "query_id string, option int, clause int, excluded boolean, slot int, term string")
    assert {r.query_id: r.matching_lines for r in saved_boolean_counts(saved, s).collect()} == expected
    nothing = saved_boolean_lines(saved.limit(0), s)
    assert nothing.lines.count() == nothing.all_but.count() == nothing.queries.count() == 0


def test_alternatives_are_not_multiplied_out(spark):
    """Twelve slots of eight words are too many phrases to list; those that occur are counted in one pass."""
    from collections import Counter

    rnd = random.Random(31)
    slots = [[f"s{i}w{k}" for k in range(8)] for i in range(12)]
    found = [" ".join(rnd.choice(words[:2]) for words in slots) for _ in range(40)]
    broken = [" ".join(t.split()[:11]) for t in found[:5]]
    s = searcher_over(spark, {"d": "\n".join(found + broken), "e": f"x {found[0]} y {found[0]}"})
    hits = s.adjacent(*[s.any_of(*words) for words in slots])
    counted = counts.phrase_counts(hits)
    # Beginnings of the phrase are adjacencies inside it.
    expected = Counter(" && ".join(t.split()[:n]) for t in [*found, *broken, found[0], found[0]] for n in range(2, len(t.split()) + 1))
    assert {r.label: r.n for r in counted.collect()} == expected
    assert sorted(r.ordinal for r in counted.collect()) == list(range(1, len(expected) + 1))
    mixed = s.adjacent(s.any_of("s0w0", s.adjacent("s0w0", "s1w0")), s.any_of("s1w0", "s2w0"))
    plan = counts.found_phrases(mixed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2


def test_saved_searches_that_share_a_common_word(spark, monkeypatch):
    """Searches that exclude, or continue with, one very common word do not each meet all of its lines."""
    from lexispan.plans import saved, saved_boolean

    n, lines_with = 40, 300
    s = searcher_over(spark, {"d": "\n".join(["common word"] * lines_with + [f"rare{i} word common" for i in range(n)] + [f"rare{i} word" for i in range(n)])})
    rows = []
    for i in range(n):
        rows += [(f"q{i}", 0, 0, False, 0, f"rare{i}"), (f"q{i}", 0, 1, True, 0, "common")]
        rows += [(f"p{i}", 0, 0, False, 0, "common"), (f"p{i}", 0, 0, False, 1, f"rare{i}"), (f"p{i}", 0, 0, False, 1, "nowhere")]
    sizes = []

    def counted(df, **options):
        out = saved.materialized(df, **options)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(saved_boolean, "materialized", counted)
    searches = spark.createDataFrame(rows, "query_id string, option int, clause int, excluded boolean, slot int, term string")
    found = {r.query_id: r.matching_lines for r in saved_boolean.saved_boolean_counts(searches, s).collect()}
    assert found == {f"q{i}": 1 for i in range(n)} | {f"p{i}": 0 for i in range(n)}
    assert max(sizes) <= 2 * (lines_with + 3 * n)
