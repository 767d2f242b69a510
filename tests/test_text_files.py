"""Trees of many small files: how they are written, listed and read."""

from pyspark.sql import functions as F

from catalog import corpora
from catalog.queries import written_name
from lexispan import text_tree
from lexispan.sources import corpus


def test_small_files_are_read_by_few_tasks(spark, tmp_path):
    """Spark counts 4 MB for opening a file, so by itself it would start a task for every 32."""
    for i in range(300):
        (tmp_path / f"{i}.txt").write_text(f"red {i}")
    tree = text_tree(spark, str(tmp_path))
    assert spark.read.format("binaryFile").load(str(tmp_path)).rdd.getNumPartitions() > 4
    assert tree.documents.rdd.getNumPartitions() == tree.listing.rdd.getNumPartitions() == 4
    assert {r.doc_id: r.text for r in tree.documents.collect()} == {f"{i}.txt": f"red {i}" for i in range(300)}
    plan = tree.documents.where(F.col("mtime") > F.lit("2001-01-01").cast("timestamp"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(" in plan.split("PushedFilters")[-1]
    assert "content" not in tree.listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1].split("\n")[0]


def test_local_files_are_those_of_sparks_writer(spark, tmp_path):
    """Odd and missing names, missing texts and repeated names; without a folder, and so a process, per document."""
    rows = [("de", 1, "a\nb"), ("de", 2, None), (None, 3, "c"), ("", 4, ""), ("a/b:c=%'[x]^ü\x01", 5, "d"), ("de", None, "e"), ("fr", 6, "f"), ("fr", 6, "f")]
    docs = spark.createDataFrame(rows, "lang string, doc long, text string").coalesce(1)
    name = "fs.viewfs.mounttable.lexispan.link./store"
    spark.conf.set(name, f"file://{tmp_path}")
    try:
        corpora.write_text_files(docs, "viewfs://lexispan/store/spark")
    finally:
        spark.conf.unset(name)
    corpora.write_text_files(docs, str(tmp_path / "local"))
    corpora.write_text_files(docs, f"file://{tmp_path}/local")
    found = [text_tree(spark, str(tmp_path / kind)).documents.select(written_name(), "text", "size").collect() for kind in ("spark", "local")]
    assert len(found[0]) == 7 and sorted(map(str, found[0])) == sorted(map(str, found[1]))
    assert not list((tmp_path / "local").rglob("doc=*/")) and list((tmp_path / "spark").rglob("doc=*/"))


def test_left_out_names_of_a_local_tree(spark, tmp_path):
    """One walk finds what the Hadoop file system does, level by level and with a status of every file."""
    names = ["a.txt", "_b.txt", ".c.txt", "x._COPYING_", "_metadata", ".a.txt.crc", "_k=v/_d.txt", "_x/.y/_e.txt", "sub/deep/.f.TXT", "_p[1]{2}/_g.txt"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x")
    (tmp_path / "_gone.txt").symlink_to(tmp_path / "nothing")
    open(bytes(tmp_path) + b"/_\xff.txt", "wb").close()
    name = "fs.viewfs.mounttable.walked.link./store"
    spark.conf.set(name, f"file://{tmp_path}")
    try:
        remote = corpus._hidden(spark, "viewfs://walked/store")
    finally:
        spark.conf.unset(name)
    local = corpus._hidden(spark, str(tmp_path))
    assert sorted(p.removeprefix("viewfs://walked/store") for p, _ in remote) == sorted(p.removeprefix(f"file:{tmp_path}") for p, _ in local)
    assert sorted(corpus._local_names(str(tmp_path), lambda name: name.endswith("TXT"))) == [f"{tmp_path}/sub/deep/.f.TXT"]
