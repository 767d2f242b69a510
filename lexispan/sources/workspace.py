"""Where jobs keep intermediate tables: the folder the cluster names for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without one gets a temporary folder."""
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        or spark.sparkContext.getCheckpointDir()
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = _LOCAL.get(spark.sparkContext.applicationId)
    if folder is None:
        folder = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="lexispan-")
    return folder


_LOCAL: dict[str, str] = {}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session for a while."""
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def materialized(df: DataFrame, **options: str) -> DataFrame:
    """``df`` written to the shared folder (with these Parquet options) and read back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lexispan/{spark.sparkContext.applicationId}/tables/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
