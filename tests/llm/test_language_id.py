import random

import numpy as np

from lexispan.llm import language_id
from lexispan.llm.language_id import best_path, fit, identify

ENGLISH = "the quick brown fox jumps over the lazy dog and then runs through every field near that old house".split()
GERMAN = "der schnelle braune fuchs springt über den faulen hund und läuft durch jedes feld nahe dem alten haus".split()
RUSSIAN = "быстрая лиса прыгает через собаку потом бежит через каждое поле около старого дома".split()


def corpus(seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(120):
        lang, words = [("en", ENGLISH), ("de", GERMAN), ("ru", RUSSIAN)][i % 3]
        rows.append((i, " ".join(rnd.choice(words) for _ in range(30)), lang))
    return rows


def all_paths(scores, penalty):
    """Best score over every path, by brute force."""
    n, k = scores.shape
    best = {(): 0.0}
    for i in range(n):
        best = {(*p, x): v + scores[i, x] - (penalty if p and p[-1] != x else 0) for p, v in best.items() for x in range(k)}
    return max(best.values())


def test_viterbi_finds_the_best_path():
    rnd = np.random.default_rng(3)
    for _ in range(60):
        scores = rnd.normal(size=(rnd.integers(1, 8), 3)) * rnd.choice([0.5, 2.0, 6.0])
        path = best_path(scores, 1.5)
        value = scores[np.arange(len(path)), path].sum() - 1.5 * (np.diff(path) != 0).sum()
        assert abs(value - all_paths(scores, 1.5)) < 1e-9


def test_held_out_texts_and_spans(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    model = fit(docs)
    mixed = " ".join(ENGLISH[:12]) + ". " + " ".join(RUSSIAN[:3]) + " " + " ".join(GERMAN * 2)
    rows = [(i, t, "x") for i, t, _ in corpus(9)] + [(900, mixed, "x"), (901, None, "x"), (902, "", "x"), (903, "12 -- 7!", "x"), (904, "漢字 文", "x")]
    asked = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    found = {r.doc_id: r for r in identify(asked, model).collect()}
    assert len(found) == len(rows)
    assert all(found[i].lang_pred == lang for i, _, lang in corpus(9))
    assert [(s.lang, mixed[s.start : s.stop].split()[0]) for s in found[900].lang_spans] == [
        ("en", ENGLISH[0]), ("ru", RUSSIAN[0]), ("de", GERMAN[0])]
    assert found[900].lang_pred == "de" and 0.5 < found[900].lang_score < 1
    for i in (901, 902, 903):
        assert (found[i].lang_pred, found[i].lang_score, found[i].lang_spans) == ("und", 0.0, [])
    assert found[904].lang_pred in ("en", "de", "ru")


def test_a_script_narrows_the_languages(spark):
    model = fit(spark.createDataFrame(corpus(), "doc_id long, text string, lang string"))
    from lexispan.llm.textbytes import letter_runs

    data = np.frombuffer("дом xyzzy".encode(), np.uint8)
    scores = language_id.word_scores(model, letter_runs(data, np.array([0, len(data)])))
    assert scores[0].argmax() == model.languages.index("ru") and scores[1].argmin() == model.languages.index("ru")


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = fit(docs)
    assert [r.lang_pred for r in identify(docs, model).collect()] == ["und", "und"]
    assert identify(docs.limit(0), model).collect() == []
