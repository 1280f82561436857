"""Intermediate results kept as Parquet in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from basketry.sources.files import remove

SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a temporary folder. On a cluster a
    missing setting is an error, since a machine-local folder is lost with its host.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/basketry"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, scratch: Scratch | None = None) -> DataFrame:
    """Write a result once and read it back.

    Like ``checkpoint()`` this survives lost executors and cuts the lineage; unlike
    it, later reads fetch only the columns and row groups they need. The result stays in the shared
    folder, or goes with the ``scratch`` it belongs to.
    """
    spark = df.sparkSession
    path = new_path(spark, label) if scratch is None else scratch.new_path(label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """A folder of intermediate results that ends with the ``with`` block that opened it."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = new_path(spark, label)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.folder)

    def new_path(self, label: str) -> str:
        return f"{self.folder}/{label}-{uuid.uuid4().hex}"
