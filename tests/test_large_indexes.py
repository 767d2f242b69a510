"""What an index does differently when it is large; its rows are the same."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lexispan import TextIndex, table_corpus
from lexispan.operators import postings as P
from lexispan.plans import index as I

FIRST = {f"d{i}": f"red blue {i}\nthe red end {i % 3}" for i in range(12)}
SECOND = {k: v for k, v in FIRST.items() if k != "d1"} | {"d2": "changed red", "new": "red gold red"}


def corpus(spark, mapping):
    return table_corpus(spark.createDataFrame(list(mapping.items()), "doc_id string, text string"))


@pytest.fixture
def index(spark, tmp_path):
    made = TextIndex(spark, str(tmp_path / "index"))
    for state in (FIRST, SECOND):
        made.sync(corpus(spark, state)).collect()
    return made


def expected(spark, tmp_path):
    fresh = TextIndex(spark, str(tmp_path / "fresh"))
    fresh.sync(corpus(spark, SECOND)).collect()
    return sorted(map(tuple, fresh.postings.select("term", "doc_id", "line_no", "pos").collect()))


def rows(index):
    return sorted(map(tuple, index.postings.select("term", "doc_id", "line_no", "pos").collect()))


def test_merged_postings_are_not_sorted_twice(spark, tmp_path, index, monkeypatch):
    written, overwrite = [], TextIndex._overwrite

    def kept(self, df, path, *partitions, **options):
        if "/postings/" in path:
            written.append(df._jdf.queryExecution().optimizedPlan().toString())
        return overwrite(self, df, path, *partitions, **options)

    monkeypatch.setattr(TextIndex, "_overwrite", kept)
    index.compact()
    (plan,) = written
    after, moved = plan.split("RebalancePartitions")
    assert "Sort" in after and "Sort" not in moved
    assert rows(index) == expected(spark, tmp_path)


@pytest.mark.parametrize("job", ["compact", "rebuild_postings"])
@pytest.mark.parametrize("few", [True, False])
def test_removed_documents_are_broadcast_or_hashed(spark, tmp_path, index, monkeypatch, few, job):
    """Never by sorting all postings."""
    if not few:
        monkeypatch.setattr(I, "REMOVED_ROWS", 1)
    plan = index.postings._jdf.queryExecution().optimizedPlan().toString()
    assert f"strategy={'broadcast' if few else 'shuffle_hash'}" in plan
    getattr(index, job)()
    assert rows(index) == expected(spark, tmp_path)


def test_millions_of_removed_documents_are_broadcast():
    assert I._few_removed(I.State(removed={2: (2_700_000, 24_000_000)}))
    assert not I._few_removed(I.State(removed={2: (4_000_000, 24_000_000), 3: (1, 1)}))
    assert not I._few_removed(I.State(removed={2: (1_000_000, 1 << 30)}))


def test_names_of_many_documents_have_no_dictionary(spark, tmp_path, monkeypatch):
    found = []
    for most in (1 << 16, 1):
        monkeypatch.setattr(I, "NAMED_DOCUMENTS", most)
        index = TextIndex(spark, str(tmp_path / f"most{most}"))
        index.sync(corpus(spark, SECOND)).collect()
        files = [pq.ParquetFile(f).metadata for f in (tmp_path / f"most{most}" / "postings").rglob("*.parquet")]
        columns = [f.row_group(0).column(i) for f in files for i in range(f.num_columns)]
        found.append({(c.path_in_schema, any("DICTIONARY" in e for e in c.encodings)) for c in columns if c.path_in_schema in ("term", "doc_id")})
        assert rows(index) == expected(spark, tmp_path)
    assert found == [{("term", True), ("doc_id", True)}, {("term", True), ("doc_id", False)}]


def test_words_are_sorted_in_every_file(spark, tmp_path, index):
    index.compact()
    for file in (tmp_path / "index" / "postings").rglob("*.parquet"):
        terms = pq.ParquetFile(file).read(columns=["term"])["term"].to_pylist()
        assert terms == sorted(terms)


def test_totals_of_many_postings_are_dealt_out(index, monkeypatch):
    before = P.term_totals(index.postings)
    monkeypatch.setattr(P, "TOTALS_BYTES", 1)
    after = P.term_totals(index.postings)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (before, after)]
    assert ["RepartitionByExpression [doc_id" in plan for plan in plans] == [False, True]
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    by_word = index.postings.groupBy("term").agg(F.count("*"), F.count_distinct("doc_id"))
    assert sorted(map(tuple, after.collect())) == sorted(map(tuple, by_word.collect()))
