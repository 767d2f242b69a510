import duckdb
import pytest

from lexispan.llm import mixing
from lexispan.llm.mixing import mixed_documents, sainte_lague

COLUMNS = ["doc_id", "source", "size", "source_size", "target", "taken"]


def rows_of(df):
    return sorted(map(str, (tuple(r[c] for c in COLUMNS) for r in df.collect())))


def sql_rows(table):
    connection = duckdb.connect()
    connection.register("documents", table)
    found = connection.execute(f"SELECT {', '.join(COLUMNS)} FROM ({mixing.oracle()})").fetchall()
    return sorted(map(str, found))


def highest_quotients(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(sorted(votes), key=lambda p: votes[p] / (2 * won[p] + 1))
        won[best] += 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 1001])
def test_seats_go_by_highest_quotients(spark, seats):
    votes = {"a": 53, "b": 24, "c": 23, "d": 1, "e": 1000, "f": 53}
    df = spark.createDataFrame(list(votes.items()), "p string, v long").selectExpr("*", f"{seats}L AS n")
    found = {r.p: r.won for r in sainte_lague(df, [], ["p"], "v", "n", "won").collect()}
    assert found == highest_quotients(votes, seats)


def test_equals_sql_and_keeps_its_limits(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 700)
    monkeypatch.setattr(mixing, "SHARDS_PER_GROUP", 4)
    rows = []
    for i in range(400):
        source = ["big", "big", "b", None, "tiny" if i % 40 == 0 else "c"][i % 5]
        rows.append((i, " ".join(["w"] * (i * 7 % 173)) + "\n", source, 5))
    rows += [(1000, None, "big", 1), (1001, "", "none", 1), (None, "x y z", "big", 1), (7, "x y", "c", 1), (7, "x y", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long").repartition(3)
    mix = mixed_documents(docs)
    assert rows_of(mix) == sql_rows(docs.toArrow())
    found = mix.toPandas()
    assert len(found) == len(rows) and (found.taken <= 2 * found["size"]).all()
    assert abs(found.groupby("source", dropna=False).target.first().sum() - 1.5 * found["size"].sum()) < 1e-6
    for _, group in found.groupby("source", dropna=False):
        target = group.target.iloc[0]
        assert target <= 2 * group.source_size.iloc[0] + 1e-9
        assert abs(group.taken.sum() - target) <= max(0.05 * target, 16)
    assert rows_of(mixed_documents(docs.repartition(5))) == rows_of(mix)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixed_documents(docs).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r.doc_id, r.target, r.taken) for r in mixed_documents(blank).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_small_sources_come_near_their_targets(spark):
    words = lambda n: " ".join(["w"] * n)
    rows = [(i, words(500), "a") for i in range(60)] + [(100, words(3), "b"), (101, words(29), "c"), (102, words(1), "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixed_documents(docs)
    assert rows_of(mix) == sql_rows(docs.toArrow())
    found = mix.groupBy("source").agg({"taken": "sum", "target": "max"}).toDF("source", "taken", "target").collect()
    assert len(found) == 4 and all(abs(r.taken - r.target) <= max(1, 0.02 * r.target) for r in found), found
