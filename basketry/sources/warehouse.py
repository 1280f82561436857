"""Where results are published and read back: one namespace per layer.

A published table is a chain of versions in a folder. A full refresh writes a new version beside the
one in use and commits it last, by creating an empty file ``_commits/<number>.<version>``: a step that
either happens or not. Readers take the version committed last, so they see a whole one, also while a refresh
runs or after one was killed. The version before it stays, for readers that have begun with it.

The catalog has a table per version, which carries its layout, and a view ``<layer>.<name>`` over the
current one. An application with a catalog of its own adds what it lacks when it reads.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.sources import files

STAGING, INTERMEDIATE, MARTS = "staging", "intermediate", "marts"

# A bucket may weigh this many times the median one before the buckets do more harm than good.
BUCKET_SKEW = 4


def layer_name(custom: str | None, default: str) -> str:
    """The custom layer name as it stands, without any prefix; else the default."""
    return default if custom is None else custom.strip()


def publish_view(df: DataFrame, layer: str, name: str) -> str:
    """Publish a frame that has no SQL text to this session as ``<layer>_<name>``; return the view name."""
    view = f"{layer}_{name}"
    df.createOrReplaceTempView(view)
    return view


@dataclass(frozen=True)
class Layout:
    """How a table's files are divided: a folder per value, and within it by hash of a column."""

    partition_by: str | None = None
    bucket_by: str | None = None
    buckets: int = 0


@dataclass(frozen=True)
class _Version:
    """A committed version: its name, the run that wrote it, its columns and layout."""

    version: str
    run: str | None
    schema: str
    layout: Layout

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> _Version:
        facts = json.loads(text)
        return _Version(**{**facts, "layout": Layout(**facts["layout"])})

    def columns(self) -> list[str]:
        return [field["name"] for field in json.loads(self.schema)["fields"]]


class Warehouse:
    """Published tables and views, in folders under ``root`` or, without one, in those of the catalog's namespaces.

    ``layers`` gives layers other namespaces than their own names.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, layers: Mapping[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self.layers = dict(layers or {})

    # ------------------------------------------------------------ names

    def namespace(self, layer: str) -> str:
        """The catalog namespace of a layer, made if it is missing."""
        name = layer_name(self.layers.get(layer), layer)
        where = f" LOCATION '{self.root}/{name}'" if self.root else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
        return name

    def _folder(self, layer: str, name: str) -> str:
        if self.root:
            return f"{self.root}/{layer_name(self.layers.get(layer), layer)}/{name}"
        facts = self.spark.sql(f"DESCRIBE DATABASE `{self.namespace(layer)}`").collect()
        home = next(r.info_value for r in facts if r.info_name == "Location")
        return f"{home.rstrip('/')}/{name}"

    def _table(self, layer: str, name: str, version: str | None = None) -> str:
        return f"`{self.namespace(layer)}`.`{name if version is None else f'{name}__{version}'}`"

    # ------------------------------------------------------------ views

    def publish_view(self, layer: str, name: str, text: str) -> str:
        """A view in the catalog, as SQL text over tables of the catalog; it outlives the session. Returns its name."""
        view = self._table(layer, name)
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {text}")
        return view

    def register_source(self, layer: str, name: str, schema: StructType, path: str) -> str:
        """A table of the catalog over files that stay where they are; returns its name."""
        table = self._table(layer, name)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._attach(table, path, schema, Layout())
        return table

    # ----------------------------------------------------------- tables

    def publish_table(
        self, df: DataFrame, layer: str, name: str, layout: Layout = Layout(), run: str | None = None
    ) -> None:
        """Full refresh of one table: a new version, committed when it is whole.

        With buckets, rows are first dealt out by partition and bucket, so that few files are written.
        ``run`` says which build wrote the version. Of the versions committed earlier the last one stays.
        """
        version = f"v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
        table, folder = self._table(layer, name, version), self._folder(layer, name)
        writer = _dealt(df, layout).write.format("parquet").option("path", f"{folder}/{version}")
        if layout.partition_by:
            writer = writer.partitionBy(layout.partition_by)
        if layout.bucket_by:
            writer = writer.bucketBy(layout.buckets, layout.bucket_by)
        writer.saveAsTable(table)
        if layout.bucket_by and _lopsided(files.sizes_in(self.spark, f"{folder}/{version}"), layout.buckets):
            # One task reads a bucket: where one key outweighs the rest, tables without buckets read better.
            layout = Layout(layout.partition_by)
            self.spark.sql(f"DROP TABLE {table}")
        self._commit(layer, name, _Version(version, run, df.schema.json(), layout))

    def _commit(self, layer: str, name: str, new: _Version) -> None:
        folder = self._folder(layer, name)
        files.write_text(self.spark, f"{folder}/{new.version}/_version.json", new.to_json())
        commits = files.names_in(self.spark, f"{folder}/_commits")
        number = 1 + max((int(commit.partition(".")[0]) for commit in commits), default=0)
        files.create_marker(self.spark, f"{folder}/_commits/{number:012d}.{new.version}")
        self.attach(layer, name)
        for commit in commits[:-1]:
            self._drop(layer, name, commit.partition(".")[2])
            files.remove(self.spark, f"{folder}/_commits/{commit}")

    def _current(self, layer: str, name: str) -> _Version | None:
        folder = self._folder(layer, name)
        commits = files.names_in(self.spark, f"{folder}/_commits")
        if not commits:
            return None
        version = commits[-1].partition(".")[2]
        return _Version.from_json(files.read_text(self.spark, f"{folder}/{version}/_version.json"))

    def attach(self, layer: str, name: str) -> str:
        """Make the current version and the view over it known to this catalog; returns the name of the view."""
        current = self._current(layer, name)
        if current is None:
            raise LookupError(f"{layer}.{name} has not been published")
        columns = ", ".join(f"`{c}`" for c in current.columns())
        return self.publish_view(layer, name, f"SELECT {columns} FROM {self._version_table(layer, name, current)}")

    def _version_table(self, layer: str, name: str, of: _Version) -> str:
        table = self._table(layer, name, of.version)
        if not self.spark.catalog.tableExists(table):
            schema = StructType.fromJson(json.loads(of.schema))
            self._attach(table, f"{self._folder(layer, name)}/{of.version}", schema, of.layout)
        return table

    def _attach(self, table: str, location: str, schema: StructType, layout: Layout) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = f"PARTITIONED BY (`{layout.partition_by}`) " if layout.partition_by else ""
        buckets = f"CLUSTERED BY (`{layout.bucket_by}`) INTO {layout.buckets} BUCKETS " if layout.bucket_by else ""
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {parts}{buckets}LOCATION '{location}'")
        if layout.partition_by:
            self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")

    def _drop(self, layer: str, name: str, version: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(layer, name, version)}")
        files.remove(self.spark, f"{self._folder(layer, name)}/{version}")

    def read_table(self, layer: str, name: str) -> DataFrame:
        """The version committed last."""
        current = self._current(layer, name)
        if current is None:
            raise LookupError(f"{layer}.{name} has not been published")
        table = self.spark.table(self._version_table(layer, name, current))
        return table.select(*[F.col(f"`{c}`") for c in current.columns()])

    def written_by(self, layer: str, name: str) -> str | None:
        """The run that wrote the current version; None if there is no version, or no run was named."""
        current = self._current(layer, name)
        return current.run if current else None

    def vacuum(self, layer: str, name: str) -> list[str]:
        """Remove versions that were never committed, left by killed refreshes; returns them.

        Call it while no refresh of the table runs.
        """
        folder = self._folder(layer, name)
        kept = {commit.partition(".")[2] for commit in files.names_in(self.spark, f"{folder}/_commits")}
        left = [n for n in files.names_in(self.spark, folder) if re.fullmatch(r"v\d+_\w+", n) and n not in kept]
        for version in left:
            self._drop(layer, name, version)
        return left

    # ------------------------------------------------------------ marts

    def read_mart(self, name: str) -> DataFrame:
        return self.read_table(MARTS, name)

    def mart_rows(self, name: str) -> DataFrame:
        """(n_rows) of a mart, added up from the footers of its files; 0 for a mart that is missing.

        The frame belongs to a session of its own, whose reader answers counts from footers.
        """
        current = self._current(MARTS, name)
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        if current is None:
            rows = session.range(0)
        else:
            schema = StructType.fromJson(json.loads(current.schema))
            rows = session.read.schema(schema).parquet(f"{self._folder(MARTS, name)}/{current.version}")
        return rows.agg(F.count("*").alias("n_rows"))

    def marts_ready(self) -> DataFrame:
        """(ready): whether the orders mart exists and holds a row."""
        return self.mart_rows("fct_orders").select((F.col("n_rows") > 0).alias("ready"))


def _dealt(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows by partition and bucket, so that each task writes few files; a hot key is spread over the partitions."""
    if layout.bucket_by is None:
        return df
    bucket = "_bucket" + "_" * max(map(len, df.columns))
    key = F.hash(F.col(f"`{layout.bucket_by}`"))
    dealt = df.withColumn(bucket, F.pmod(key, F.lit(layout.buckets)))
    by = [bucket, *([layout.partition_by] if layout.partition_by else [])]
    return dealt.repartition(*by).drop(bucket)


def _lopsided(sizes: Mapping[str, int], buckets: int) -> bool:
    """Whether one bucket weighs far more than the others; files name theirs."""
    weight = [0] * buckets
    for path, size in sizes.items():
        found = re.search(r"_(\d+)(?:\.c\d+)?(?:\.\w+)*\.parquet$", path)
        if found:
            weight[int(found[1])] += size
    return buckets > 1 and max(weight) > BUCKET_SKEW * max(median(weight), 1)
