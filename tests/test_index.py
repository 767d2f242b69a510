import os
import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexispan import TextIndex, index_stream, table_corpus, text_tree, text_tree_stream
from lexispan.operators import counts
from lexispan.plans.classify import INDEX_VERSION, build_summary, classify, log_order, names_only
from lexispan.plans.index import _is_readable
from lexispan.sources.naming import unique_names
from lexispan.sources.workspace import materialized, shared_folder
from test_search import PEOPLE, lines, spans

SUMMARY = ["new", "updated", "skipped", "deleted", "failed"]


def summary(df):
    row = df.first()
    return {name: row[name] for name in SUMMARY if row[name]}


def corpus_of(spark, mapping):
    rows = [(k, v if isinstance(v, (bytes, type(None))) else v.encode()) for k, v in mapping.items()]
    return table_corpus(spark.createDataFrame(rows, "doc_id string, content binary"))


def texts(index):
    got = {}
    for r in index.lines.orderBy("doc_id", "line_no").collect():
        got.setdefault(r.doc_id, []).append(r.line)
    return got


def postings(index):
    rows = [tuple(r) for r in index.postings.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "some documents"
    (root / "sub dir").mkdir(parents=True)
    for name, text in PEOPLE.items():
        (root / name).write_text(text, encoding="utf-8")
    return root


@pytest.fixture
def index(spark, tmp_path):
    return TextIndex(spark, str(tmp_path / "index"))


def test_incremental_build_over_files(spark, tree, index):
    corpus = lambda: text_tree(spark, str(tree))
    assert index.manifest.count() == 0
    assert summary(index.sync(corpus())) == {"new": 3}
    s = index.searcher()
    assert counts.occurrence_count(s.word("Lincoln")).first()[0] == 7
    assert lines(s.none_of("Lincoln")) == {("korean.txt", 1), ("korean.txt", 2)}
    assert summary(index.sync(corpus())) == {"skipped": 3}
    with (tree / "people.txt").open("a", encoding="utf-8") as file:
        file.write("Abraham Lincoln again.\n")
    assert summary(index.sync(corpus())) == {"updated": 1, "skipped": 2}
    assert counts.occurrence_count(index.searcher().word("Lincoln")).first()[0] == 8
    (tree / "korean.txt").unlink()
    assert summary(index.sync(corpus())) == {"deleted": 1, "skipped": 2}
    assert "korean.txt" not in texts(index)
    assert {r.doc_id for r in index.manifest.collect()} == {"people.txt", "gutenberg.txt"}
    assert {r.doc_id: r.action for r in index.actions().collect()}["korean.txt"] == "deleted"


def test_tree_names_and_suffixes(spark, tree):
    (tree / "sub dir" / "Ünï code.TXT").write_text("x", encoding="utf-8")
    (tree / "sub dir" / "not.text").write_text("x", encoding="utf-8")
    corpus = text_tree(spark, str(tree) + "/")
    assert {r.doc_id for r in corpus.listing.collect()} == {*PEOPLE, "sub dir/Ünï code.TXT"}
    assert {r.doc_id for r in text_tree(spark, "file:" + str(tree)).documents.collect()} == {*PEOPLE, "sub dir/Ünï code.TXT"}


@pytest.mark.parametrize("verify", [False, True])
def test_names_that_spark_leaves_out(spark, tree, index, verify):
    names = ["_b.txt", ".c.TXT", "_x/d.txt", "_x/.y/e.txt", "sub dir/_f.txt", "_k=v/g.txt", "_metadata/h.txt", ".hid/deep/_i.txt", "_p[1]/j.txt"]
    for name in names:
        (tree / name).parent.mkdir(parents=True, exist_ok=True)
        (tree / name).write_text(f"Lincoln {name}", encoding="utf-8")
    (tree / "_not.text").write_text("x", encoding="utf-8")
    (tree / "_bad.txt").write_bytes(b"\xff")
    corpus = lambda: text_tree(spark, str(tree), verify_content=verify)
    assert sorted(r.doc_id for r in corpus().listing.collect()) == sorted([*PEOPLE, *names, "_bad.txt"])
    assert summary(index.sync(corpus())) == {"new": 3 + len(names), "failed": 1}
    assert {k: v for k, v in texts(index).items() if k in names} == {name: [f"Lincoln {name}"] for name in names}
    (tree / "_b.txt").write_text("edited text", encoding="utf-8")
    assert summary(index.sync(corpus())) == {"updated": 1, "skipped": 2 + len(names), "failed": 1}
    assert texts(index)["_b.txt"] == ["edited text"]


def test_listing_reads_no_content(spark, tree):
    plan = text_tree(spark, str(tree)).listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_unreadable_bytes_keep_the_old_text(spark, tree, index):
    corpus = lambda: text_tree(spark, str(tree))
    (tree / "bad.txt").write_bytes(b"\xff\xfe a")
    assert summary(index.sync(corpus())) == {"new": 3, "failed": 1}
    assert "bad.txt" not in {r.doc_id for r in index.manifest.collect()}
    before = postings(index)
    (tree / "people.txt").write_bytes(b"Lincoln \xff")
    assert summary(index.sync(corpus())) == {"skipped": 2, "failed": 2}
    assert postings(index) == before
    assert summary(index.sync(corpus())) == {"skipped": 2, "failed": 2}
    (tree / "people.txt").write_text("better", encoding="utf-8")
    (tree / "bad.txt").write_text("good", encoding="utf-8")
    assert summary(index.sync(corpus())) == {"new": 1, "updated": 1, "skipped": 2}
    assert texts(index)["people.txt"] == ["better"]


def test_table_corpus_against_a_fresh_build(spark, index, tmp_path):
    first = {f"d{i}": f"red blue {i}\nthe end {i}" for i in range(40)} | {"blank": "", "space": "\n \n"}
    second = {k: v for k, v in first.items() if k not in ("d1", "blank")} | {"d2": "changed red", "new": "red", "null": None}
    third = {k: v for k, v in second.items() if k != "null"} | {"d3": b"\xff"}
    for state, expected in (
        (first, {"new": 42}),
        (second, {"new": 1, "updated": 1, "deleted": 2, "skipped": 39, "failed": 1}),
        (second, {"skipped": 41, "failed": 1}),
        (third, {"skipped": 40, "failed": 1}),
        ({}, {"deleted": 41}),
        (first, {"new": 42}),
    ):
        assert summary(index.sync(corpus_of(spark, state))) == expected
        served = {k: first["d3"] if v == b"\xff" else v for k, v in state.items() if v is not None}
        fresh = TextIndex(spark, str(tmp_path / "fresh" / str(len(list(tmp_path.glob("fresh/*"))))))
        fresh.sync(corpus_of(spark, served))
        assert postings(index) == postings(fresh)
        assert texts(index) == texts(fresh)
        assert {r.doc_id for r in index.manifest.collect()} == set(served)


def test_first_build_hashes_nothing_to_compare(spark, index, tmp_path):
    spark.createDataFrame([("a", "red")], "doc_id string, text string").write.parquet(str(tmp_path / "docs"))
    listing = table_corpus(spark.read.parquet(str(tmp_path / "docs"))).listing
    plan = classify(names_only(listing), index._live("document", index._state()))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:string>" in plan and "Join" not in plan


def test_tables_compared_by_time_alone(spark, index):
    def corpus(text, mtime):
        schema = "doc_id string, text string, mtime timestamp"
        return table_corpus(spark.createDataFrame([("a", text, mtime), ("b", "blue", datetime(2026, 1, 1))], schema), verify_content=False)

    assert summary(index.sync(corpus("red", datetime(2026, 1, 1)))) == {"new": 2}
    assert summary(index.sync(corpus("red", datetime(2026, 1, 1)))) == {"skipped": 2}
    assert summary(index.sync(corpus("gold", datetime(2026, 1, 2)))) == {"updated": 1, "skipped": 1}
    assert texts(index) == {"a": ["gold"], "b": ["blue"]}
    with pytest.raises(ValueError):
        table_corpus(spark.createDataFrame([("a", "red")], "doc_id string, text string"), verify_content=False)


@pytest.mark.parametrize("small", [{"changed"}, {"skipped"}, set()])
def test_reading_only_changed_documents(spark, index, monkeypatch, small):
    sizes = iter([("changed" in small), ("skipped" in small)])
    first = {f"d{i}": f"red {i}" for i in range(6)}
    index.sync(corpus_of(spark, first))
    monkeypatch.setattr("lexispan.plans.index.is_small", lambda df: next(sizes))
    monkeypatch.setattr("lexispan.plans.index.broadcast_if_small", lambda df: df)
    second = first | {"d1": "blue", "e": "new"}
    assert summary(index.sync(corpus_of(spark, second))) == {"new": 1, "updated": 1, "skipped": 5}
    assert texts(index) == {k: [v] for k, v in second.items()}


def test_compaction_changes_nothing(spark, index):
    for i in range(3):
        index.sync(corpus_of(spark, {f"d{j}": f"red {j}" for j in range(i + 1)}))
    before = postings(index), texts(index), sorted(index.manifest.collect())
    assert len({run for run, _ in index._committed()[1]["document"]}) == 3
    index.compact()
    assert (postings(index), texts(index), sorted(index.manifest.collect())) == before
    assert len({run for run, _ in index._committed()[1]["document"]}) == 1
    assert summary(index.sync(corpus_of(spark, {"d0": "red 0"}))) == {"skipped": 1, "deleted": 2}


@pytest.mark.parametrize("damage", ["missing", "corrupt"])
def test_damaged_postings_are_rebuilt(spark, index, damage):
    corpus = corpus_of(spark, {"a": "red blue", "b": "red"})
    index.sync(corpus)
    before = postings(index)
    if damage == "missing":
        shutil.rmtree(Path(index.root) / "postings")
    else:
        for file in Path(index.root).glob("postings/**/*.parquet"):
            file.write_bytes(b"nonsense")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    assert summary(index.sync(corpus)) == {"skipped": 2}
    assert postings(index) == before


def test_missing_lines_count_as_updated(spark, index):
    corpus = corpus_of(spark, {"a": "red blue", "b": "red"})
    index.sync(corpus)
    before = postings(index)
    for folder in Path(index.root).glob("store/*/kind=line"):
        shutil.rmtree(folder)
    assert summary(index.sync(corpus)) == {"updated": 2}
    assert postings(index) == before


def test_uncommitted_runs_are_ignored_and_replaced(spark, index):
    index.sync(corpus_of(spark, {"a": "red"}))
    index.sync(corpus_of(spark, {"a": "red", "b": "blue"}))
    shutil.rmtree(Path(index.root) / "commits" / "run=2")
    assert set(texts(index)) == {"a"}
    assert summary(index.sync(corpus_of(spark, {"a": "red", "c": "green"}))) == {"new": 1, "skipped": 1}
    assert texts(index) == {"a": ["red"], "c": ["green"]}
    assert {p[0] for p in postings(index)} == {"red", "green"}


def test_other_versions_are_not_read(spark, index, monkeypatch):
    corpus = corpus_of(spark, {"a": "red"})
    index.sync(corpus)
    for module in ("index", "classify"):
        monkeypatch.setattr(f"lexispan.plans.{module}.INDEX_VERSION", INDEX_VERSION + 1)
    assert texts(index) == {} and postings(index) == set()
    assert summary(index.sync(corpus)) == {"updated": 1}
    assert texts(index) == {"a": ["red"]}


def test_change_rows(spark, index):
    schema = "doc_id string, text string, deleted boolean"
    index.sync(corpus_of(spark, {"a": "red", "b": "blue", "c": "green"}))
    rows = [("a", "gold", False), ("b", None, True), ("d", "new", None), ("e", None, True)]
    assert summary(index.apply_changes(spark.createDataFrame(rows, schema))) == {"new": 1, "updated": 1, "deleted": 1}
    assert texts(index) == {"a": ["gold"], "c": ["green"], "d": ["new"]}
    assert summary(index.apply_changes(spark.createDataFrame(rows, schema))) == {"skipped": 2}


def test_streamed_arrivals(spark, index, tmp_path):
    incoming = tmp_path / "incoming"
    schema = "doc_id string, text string, deleted boolean, version int"

    def arrive(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(incoming))
        changes = spark.readStream.schema(schema).parquet(str(incoming))
        writer = index_stream(changes, index, str(tmp_path / "progress"), order=F.col("version"))
        writer.trigger(availableNow=True).start().awaitTermination()

    arrive(("a", "red", False, 1), ("a", "red red", False, 2), ("b", "blue", False, 3))
    assert texts(index) == {"a": ["red red"], "b": ["blue"]}
    arrive(("b", None, True, 4), ("c", "green\nred", False, 5))
    assert texts(index) == {"a": ["red red"], "c": ["green", "red"]}
    assert len(spans(index.searcher().word("red"))) == 3


def test_streamed_files_and_batch_sync_agree(spark, tree, index, tmp_path):
    def arrive():
        stream = index_stream(text_tree_stream(spark, str(tree)), index, str(tmp_path / "progress"))
        stream.trigger(availableNow=True).start().awaitTermination()

    arrive()
    assert counts.occurrence_count(index.searcher().word("Lincoln")).first()[0] == 7
    (tree / "sub dir" / "late.TXT").write_text("Lincoln", encoding="utf-8")
    arrive()
    assert texts(index)["sub dir/late.TXT"] == ["Lincoln"]
    (tree / "korean.txt").unlink()
    assert summary(index.sync(text_tree(spark, str(tree)))) == {"skipped": 3, "deleted": 1}


def test_classification(spark):
    t = datetime(2026, 1, 1)
    schema = "doc_id string, mtime timestamp, size long, content_hash long"
    listing = spark.createDataFrame(
        [("same", t, 1, 1), ("size", t, 2, 1), ("hash", t, 1, 2), ("new", t, 1, 1), ("unhashed", t, 1, None), ("old", t, 1, 1), ("unusable", t, 1, 1)],
        schema,
    )
    names = ["same", "size", "hash", "unhashed", "gone", "unusable"]
    rows = [(n, t, 1, 1, INDEX_VERSION, n != "unusable") for n in names] + [("old", t, 1, 1, INDEX_VERSION - 1, True)]
    manifest = spark.createDataFrame(rows, schema + ", index_version int, usable boolean")
    plan = classify(listing, manifest)
    assert {r.doc_id: r.action for r in plan.collect()} == {
        "same": "skipped", "size": "updated", "hash": "updated", "new": "new", "unhashed": "skipped",
        "old": "updated", "unusable": "updated", "gone": "deleted",
    }
    assert summary(build_summary(plan)) == {"new": 1, "updated": 4, "skipped": 2, "deleted": 1}
    assert [r.doc_id for r in plan.orderBy(*log_order()).collect()][-1] == "gone"


def test_mtime_pruning_reaches_the_scan(spark, tree):
    corpus = text_tree(spark, str(tree))
    recent = corpus.documents.where(F.col("mtime") >= F.timestamp_micros(F.lit(1577836800000000)))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "modificationTime" in plan.split("PushedFilters")[1].split("]")[0]


def test_repeated_names(spark):
    given = ["a", "b", "a", "a", "c", "b", "a (3)", "d (9)", "d", "a"]
    expected = ["a", "b", "a (3)", "a (4)", "c", "b (6)", "a (3) (7)", "d (9)", "d", "a (10)"]
    df = spark.createDataFrame(list(enumerate(given)), "i int, name string").repartition(3)
    got = unique_names(df, "name", [F.col("i")]).orderBy("i").collect()
    assert [r.doc_id for r in got] == expected
    clash = spark.createDataFrame(list(enumerate(["a (2)", "a", "a"])), "i int, name string")
    assert {r.doc_id for r in unique_names(clash, "name", [F.col("i")]).collect()} == {"a (2)", "a", "a (3)"}
    replaced = spark.createDataFrame(list(enumerate(["a", "a (3)", "a"])), "i int, name string")
    assert {(r.doc_id, r.i) for r in unique_names(replaced, "name", [F.col("i")]).collect()} == {("a", 0), ("a (3)", 2)}


def test_browser_rules(spark, tmp_path):
    from lexispan.functions.stopwords import BROWSER_STOPWORDS

    index = TextIndex(spark, str(tmp_path / "browser"), "browser", "lower", BROWSER_STOPWORDS)
    index.sync(corpus_of(spark, {"d": "\uFEFFYou can Straße\nred\r\n"}))
    s = index.searcher()
    assert spans(s.adjacent("can", "STRA")) == {("d", 1, 1, 2)}
    assert spans(s.word("you")) == set()
    assert lines(s.none_of("can")) == {("d", 2), ("d", 3)}


def test_content_check_sees_what_the_clock_does_not(spark, tree, index):
    path = tree / "people.txt"
    corpus = lambda verify: text_tree(spark, str(tree), verify_content=verify)
    index.sync(corpus(True))
    before = path.stat()
    path.write_text(PEOPLE["people.txt"].replace("Abe", "Eba"), encoding="utf-8")
    os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns))
    assert summary(index.sync(corpus(False))) == {"skipped": 3}
    assert summary(index.sync(corpus(True))) == {"updated": 1, "skipped": 2}
    assert spans(index.searcher().adjacent("eba", "lincoln")) == {("people.txt", 1, 0, 1)}


def test_work_tables_go_to_the_configured_folder(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) == str(folder)
    before = set(folder.glob("lexispan/*/tables/*"))
    assert materialized(spark.range(3)).count() == 3
    assert len(set(folder.glob("lexispan/*/tables/*")) - before) == 1


def test_repeated_words_of_a_hot_document(spark, index):
    """One document with most of the lines, and one line with most of the words."""
    corpus = {"many": "red red blue\n" * 2000, "long": "red " * 3000, "small": "red blue"}
    index.sync(corpus_of(spark, corpus))
    s = index.searcher()
    assert counts.occurrence_count(s.adjacent("red", "red")).first()[0] == 2000 + 2999
    assert counts.occurrence_count(s.adjacent("red", s.any_of("blue", s.adjacent("red", "blue")))).first()[0] == 4001
    assert counts.line_count(s.adjacent("red", s.none_of("blue"))).first()[0] == 1


def damage(index, doc_id):
    """Spoil the file with the lines of ``doc_id``, and of it alone."""
    live = [f"store/run={run}/kind=line/part={part}/*.parquet" for run, part in index._committed()[1]["line"]]
    for file in (file for pattern in live for file in Path(index.root).glob(pattern)):
        if {r.doc_id for r in index.spark.read.parquet(str(file)).collect()} == {doc_id}:
            file.write_bytes(b"nonsense")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
            return
    raise AssertionError("no such file")


def test_damage_of_one_part_leaves_the_others(spark, index):
    for i, name in enumerate("abc"):
        index.sync(corpus_of(spark, {n: f"red {n}" for n in "abc"[: i + 1]}))
    damage(index, "c")
    assert summary(index.sync(corpus_of(spark, {"a": "red a", "b": b"\xff", "c": "red c"}))) == {"updated": 1, "skipped": 1, "failed": 1}
    assert texts(index) == {n: [f"red {n}"] for n in "abc"}
    assert {p[1] for p in postings(index)} == set("abc")
    assert {r.doc_id for r in index.manifest.collect()} == set("abc")
    # What can neither be kept nor read again is not said to be there.
    damage(index, "c")
    assert summary(index.sync(corpus_of(spark, {"a": "red a", "b": "red b", "c": b"\xff"}))) == {"skipped": 2, "failed": 1}
    assert set(texts(index)) == {r.doc_id for r in index.manifest.collect()} == {p[1] for p in postings(index)} == {"a", "b"}
    assert summary(index.sync(corpus_of(spark, {n: f"red {n}" for n in "abc"}))) == {"new": 1, "skipped": 2}
    assert texts(index) == {n: [f"red {n}"] for n in "abc"}


def test_other_errors_are_no_damage(spark, index):
    def refuse():
        raise PySparkException("Job aborted: executor lost")

    with pytest.raises(PySparkException):
        _is_readable(refuse)


def test_repeated_and_missing_names_are_counted(spark, index):
    rows = [("a", "red blue"), ("a", "red blue"), ("a", "red"), ("b", "red"), (None, "gone"), (None, "lost")]
    corpus = table_corpus(spark.createDataFrame(rows, "doc_id string, text string").repartition(3))
    assert summary(index.sync(corpus)) == {"new": 2, "failed": 4}
    assert len(index.manifest.collect()) == 2 and len(texts(index)["a"]) == 1
    before = postings(index)
    assert summary(index.sync(corpus)) == {"skipped": 2, "failed": 4}
    assert summary(index.apply_changes(spark.createDataFrame(rows, "doc_id string, text string"))) == {"skipped": 2, "failed": 4}
    assert postings(index) == before


@pytest.mark.parametrize("verify", [False, True])
def test_an_oversize_file_fails_alone(spark, tree, index, verify):
    name = "spark.sql.sources.binaryFile.maxLength"
    largest = max(len(text.encode()) for text in PEOPLE.values())
    (tree / "huge.txt").write_text("x" * (largest + 1), encoding="utf-8")
    spark.conf.set(name, largest)
    try:
        assert summary(index.sync(text_tree(spark, str(tree), verify_content=verify))) == {"new": 3, "failed": 1}
    finally:
        spark.conf.unset(name)
    assert set(texts(index)) == set(PEOPLE)


# -- runs, buckets and places ---------------------------------------------------


def scans(df):
    """The file scans of a plan, run without adaptive execution, by the folder they read."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        rows = df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        found = []
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if "FileSourceScan" in leaf.getClass().getSimpleName():
                files = leaf.metrics().get("numFiles").get().value()
                found.append((leaf.relation().location().rootPaths().apply(0).toString(), files, leaf.verboseStringWithOperatorId()))
        return rows, found
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def size_of(folder, *names):
    return sum(f.stat().st_size for name in names for f in Path(folder).glob(f"{name}/**/*.parquet"))


def many_texts(n):
    return {f"d{i}": "\n".join(f"red w{i} x{i * 7 % 50} common{i % 10} tail{j}" for j in range(20)) for i in range(n)}


def test_a_word_opens_one_bucket_per_run(spark, index, monkeypatch):
    monkeypatch.setattr("lexispan.plans.index.BUCKET_BYTES", 20_000)
    index.sync(corpus_of(spark, many_texts(300)))
    (batch,) = index._state().batches.values()
    assert batch.buckets >= 8
    rows, ((folder, files, plan),) = scans(index.searcher().word("w17").spans)
    assert len(rows) == 20 and "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert files <= max(1, len(list(Path(index.root).glob("postings/**/*.parquet"))) // 4)
    # However many small runs there were, few are left to open.
    for i in range(5):
        index.apply_changes(spark.createDataFrame([(f"new{i}", "red w17")], "doc_id string, text string"))
    rows, found = scans(index.searcher().word("w17").spans)
    assert len(rows) == 25 and len(index._state().batches) <= 4
    assert sum(n for folder, n, _ in found if "postings" in folder) <= 4 + files


def test_an_edit_writes_what_changed(spark, index):
    texts_ = many_texts(1000)
    index.sync(corpus_of(spark, texts_))
    first = size_of(index.root, "store", "postings")
    assert summary(index.sync(corpus_of(spark, texts_ | {"d5": texts_["d5"] + "\nand more"}))) == {"updated": 1, "skipped": 999}
    assert size_of(index.root, "store", "postings", "removed") - first < 0.05 * first
    assert texts(index)["d5"][-1] == "and more" and len(texts(index)) == 1000
    assert len(spans(index.searcher().word("w5"))) == 20


def test_text_is_fetched_from_the_parts_with_a_hit(spark, index):
    rows = [(k, v) for k, v in many_texts(80).items()]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(8)
    index.sync(table_corpus(docs))
    parts = len(index._committed()[1]["line"])
    assert parts >= 6
    found, read = scans(index.searcher().adjacent("red", "w17").lines_with_text)
    assert len(found) == 20
    lines_read = [(files, plan) for folder, files, plan in read if "store" in folder]
    assert [files for files, _ in lines_read] == [1]
    assert "part" in lines_read[0][1].split("PartitionFilters")[1].split("\n")[0]
    everything, _ = scans(index.searcher().none_of("w17").lines_with_text)
    assert len(everything) == 79 * 20


def test_a_phrase_follows_its_rarest_word(spark, index):
    index.sync(corpus_of(spark, many_texts(120) | {"odd": "zebra red\nred zebra"}))
    s = index.searcher()
    rare = s.adjacent("zebra", "red")
    assert spans(rare) == {("odd", 1, 0, 1)}
    assert "LeftSemi" in rare.spans._jdf.queryExecution().optimizedPlan().toString()
    common = s.adjacent("red", s.any_of(*[f"w{i}" for i in range(120)]))
    assert "LeftSemi" not in common.spans._jdf.queryExecution().optimizedPlan().toString()
    assert len(spans(common)) == 120 * 20
    assert spans(s.adjacent("red", "nowhere")) == set() == lines(s.adjacent("nowhere", "red"))


def test_late_rows_do_not_win(spark, index):
    """The same document on two days, the earlier day last."""
    schema = "doc_id string, text string, deleted boolean, day timestamp"

    def arrive(*rows):
        return summary(index.apply_changes(spark.createDataFrame([(d, t, x, datetime(2026, 1, day)) for d, t, x, day in rows], schema), F.col("day")))

    assert arrive(("a", "second day", False, 2)) == {"new": 1}
    assert arrive(("a", "first day", False, 1)) == {}
    assert texts(index) == {"a": ["second day"]}
    assert arrive(("a", None, True, 3), ("b", None, True, 5)) == {"deleted": 1}
    assert arrive(("a", "too late", False, 2), ("b", "too late", False, 4)) == {}
    assert texts(index) == {}
    assert arrive(("a", "again", False, 4), ("b", "again", False, 6), ("b", "not this", False, 5)) == {"new": 2}
    assert texts(index) == {"a": ["again"], "b": ["again"]}
    # The same text on a later day: an earlier change is still too late.
    assert arrive(("a", "again", False, 9)) == {"updated": 1}
    assert arrive(("a", "between", False, 7)) == {}
    index.compact()
    assert arrive(("a", "between", False, 8), ("b", None, True, 6)) == {"deleted": 1}
    assert texts(index) == {"a": ["again"]}
    assert arrive(("b", "older", False, 5)) == {}


def test_purged_documents_leave_the_disk(spark, index):
    def stored(word):
        read = [spark.read.parquet(f"{index.root}/store").where(F.col("line").contains(word)), spark.read.parquet(f"{index.root}/postings").where(F.col("term") == word)]
        return [df.count() for df in read]

    index.sync(corpus_of(spark, {"a": "secret red", "b": "blue", "c": "secret too"}))
    index.sync(corpus_of(spark, {"a": "public red", "b": "blue", "d": "gold"}))
    assert stored("secret") == [2, 2]
    before = index.searcher()
    old = before.word("blue")
    index.purge(timedelta(days=1))
    # Readers of the last commit are not disturbed while its folders are young.
    assert spans(old) == {("b", 1, 0, 0)} and stored("secret") == [2, 2]
    index.purge(timedelta(0))
    assert stored("secret") == [0, 0]
    assert texts(index) == {"a": ["public red"], "b": ["blue"], "d": ["gold"]}
    assert {r.action for r in index.actions(2).collect()} == {"updated", "skipped", "deleted", "new"}
    assert summary(index.sync(corpus_of(spark, {"a": "public red", "b": "blue", "d": "gold"}))) == {"skipped": 3}
    index.purge(timedelta(0))
    assert {f.name for f in Path(index.root).glob("store/run=*")} == {f"run={r}" for r in index._state().batches}


def test_rebuilding_leaves_committed_folders_alone(spark, index):
    index.sync(corpus_of(spark, {"a": "red blue", "b": "red"}))
    before = {f: f.stat().st_mtime_ns for f in Path(index.root).glob("postings/**/*.parquet")}
    old, expected = index.searcher(), postings(index)
    index.rebuild_postings()
    assert {f: f.stat().st_mtime_ns for f in before} == before and len(spans(old.word("red"))) == 2
    assert postings(index) == expected and len(index._state().batches) == 1


def test_runs_are_merged_by_tiers(spark, index):
    state = {}
    for i in range(6):
        state[f"d{i}"] = f"red {i}"
        state["d0"] = f"red again {i}"
        index.sync(corpus_of(spark, state))
    assert len(index._state().batches) < 4
    assert texts(index) == {k: [v] for k, v in state.items()}
    assert {r.doc_id for r in index.manifest.collect()} == set(state)
    assert len(spans(index.searcher().word("red"))) == 6


def test_rows_of_two_versions(spark, index):
    earlier = TextIndex(spark, index.root, version=INDEX_VERSION - 1)
    earlier.sync(corpus_of(spark, {"a": "red", "b": "blue"}))
    assert texts(earlier) == {"a": ["red"], "b": ["blue"]} and texts(index) == {}
    assert summary(index.apply_changes(spark.createDataFrame([("c", "gold")], "doc_id string, text string"))) == {"new": 1}
    assert texts(index) == {"c": ["gold"]} and texts(earlier) == {"a": ["red"], "b": ["blue"]}
    assert summary(index.sync(corpus_of(spark, {"a": "red", "b": b"\xff", "c": "gold"}))) == {"updated": 1, "failed": 1, "skipped": 1}
    assert texts(index) == {"a": ["red"], "c": ["gold"]} and texts(earlier) == {"b": ["blue"]}


def test_document_index_collects_after_the_shuffle(spark):
    from lexispan.operators.postings import document_index

    rows = [("x", "a", 2**31 - 1, 2**31 - 1), ("x", "a", 1, 5), ("x", "a", 1, 0), ("x", "b", 0, 2), ("y", "a", 3, 1)]
    nested = document_index(spark.createDataFrame(rows, "term string, doc_id string, line_no int, pos int"))
    assert {(r.doc_id, r.term): [tuple(e) for e in r.entries] for r in nested.collect()} == {
        ("a", "x"): [(1, 0), (1, 5), (2**31 - 1, 2**31 - 1)], ("b", "x"): [(0, 2)], ("a", "y"): [(3, 1)],
    }
    plan = nested._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [doc_id" in plan


def test_postings_are_packed_and_sorted_before_they_are_moved(spark, tmp_path, monkeypatch):
    index = TextIndex(spark, str(tmp_path / "index"))
    written = []
    overwrite = TextIndex._overwrite

    def kept(self, df, path, *partitions, **options):
        if "/postings/" in path:
            written.append(df._jdf.queryExecution().optimizedPlan().toString())
        return overwrite(self, df, path, *partitions, **options)

    monkeypatch.setattr(TextIndex, "_overwrite", kept)
    docs = spark.createDataFrame([("a", "ci n ci\nde\nci la"), ("b", "la ci")], "doc_id string, text string")
    index.sync(table_corpus(docs))
    (plan,) = written
    after, moved = plan.split("RebalancePartitions")
    assert "Sort" in after and "Sort" in moved
    shuffled = moved.split("Project [", 1)[1].split("]", 1)[0]
    assert "place#" in shuffled and not any(name in shuffled for name in ("index_version", "run#"))
    found = {(r.term, r.doc_id, r.line_no, r.pos) for r in index.postings.collect()}
    assert found == {("ci", "a", 1, 0), ("n", "a", 1, 1), ("ci", "a", 1, 2), ("de", "a", 2, 0), ("ci", "a", 3, 0), ("la", "a", 3, 1), ("la", "b", 1, 0), ("ci", "b", 1, 1)}


def test_common_words_are_grouped_over_many_tasks(spark, tmp_path, monkeypatch):
    from lexispan.operators import counts, search

    index = TextIndex(spark, str(tmp_path / "index"))
    index.sync(table_corpus(spark.createDataFrame([(f"d{i}", "de de la\nde") for i in range(30)], "doc_id string, text string")))
    s = index.searcher()
    compose = lambda: [s.adjacent("de", "de").spans, s.word("de").lines, counts.phrase_counts(s.adjacent("de", s.any_of("de", "la")))]
    whole = [sorted(map(str, df.collect())) for df in compose()]
    monkeypatch.setattr(search, "GROUPED_ROWS", 20)
    for df, rows in zip(compose(), whole):
        assert sorted(map(str, df.collect())) == rows
        assert "RepartitionByExpression" in df._jdf.queryExecution().optimizedPlan().toString()


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    """A tree of many folders; Spark by itself would start a task for each."""
    for i in range(60):
        (tmp_path / f"doc={i}").mkdir()
        (tmp_path / f"doc={i}" / "a.txt").write_text("x")
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.sparkContext.setJobGroup("listing", "")
    try:
        assert text_tree(spark, str(tmp_path)).listing.select("doc_id").distinct().count() == 60
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        sizes = [s.numTasks for s in stages if s]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(name) == before
    assert sizes and max(sizes) < 60
