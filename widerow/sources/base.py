"""The base: current cells in buckets by row, kept up to date from deltas.

A base is a Parquet table whose rows lie in buckets by a hash of the row key, sorted by
row and name, one directory a bucket. Spark knows where a row is, so reconciling and
dumping cells of a base (``bucketed=True``) needs no shuffle, and joining deltas to it
shuffles the deltas only.

``merge`` writes anew just the buckets that hold a row of the deltas; other files stay as
they are. A bucket is read, written beside the old one and then put in its place, so a
merge that ends early leaves whole buckets, old or new, and merging the same deltas again
gives the same base. Merges of one base must not run at the same time.

All cells of a row are in one bucket, that is one task, which sorts them, so the number of
buckets must follow the size of the table: ``buckets_for`` tells it. For a table with rows
larger than a bucket use ``compact``, whose ranges split rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reconcile import reconcile
from ..schema import CELL_SCHEMA, FamilySpec
from .cell_table import picked

_PLACE = ["keyspace", "cf", "bucket"]
_LAYOUT = "_layout"  # hidden from readers of the table
BUCKET_BYTES = 128 << 20  # of cells as rows in memory, in a bucket
_MOST = 100_000  # buckets that Spark allows
_CELL = 128  # bytes of a cell besides its texts


@dataclass(frozen=True)
class CellBase:
    """An open base; ``open_base`` makes one."""

    spark: SparkSession
    path: str
    buckets: int
    table: str

    def scan(
        self, spec: FamilySpec | None = None, names: Sequence[str] | None = None
    ) -> DataFrame:
        """Its cells, of one family or all, of the given names or all. They are
        reconciled and bucketed; each family and name is pushed to the scan."""
        cells = picked(self.spark.table(self.table), spec, names)
        return cells.select(*CELL_SCHEMA.names)

    def with_deltas(self, deltas: DataFrame, spec: FamilySpec | None = None) -> DataFrame:
        """The current cells of base and deltas, bucketed and reconciled, without
        writing. Only the deltas are shuffled."""
        if spec is not None:
            deltas = deltas.filter(spec.matches())
        old = picked(self.spark.table(self.table), spec, None)
        return reconcile(old.unionByName(self._dealt(deltas)), spec)

    def merge(self, deltas: DataFrame) -> int:
        """Brings the base up to date with the deltas; gives the number of buckets
        written. ``deltas`` is read twice, the first time only its keys."""
        touched = deltas.select(*_PLACE[:2], self._bucket()).distinct().collect()
        if not touched:
            return 0
        families: dict[tuple[str, str], list[int]] = {}
        for keyspace, cf, bucket in touched:
            families.setdefault((keyspace, cf), []).append(bucket)
        wanted = F.lit(False)
        for (keyspace, cf), buckets in families.items():
            family = (F.col("keyspace") == keyspace) & (F.col("cf") == cf)
            wanted |= family & F.col("bucket").isin(buckets)
        old = self.spark.table(self.table).filter(wanted)
        new = reconcile(old.unionByName(self._dealt(deltas)))
        new = new.withColumn("bucket", self._bucket())
        self._overwrite(new.select(self.spark.table(self.table).columns))
        return len(touched)

    def _bucket(self) -> Column:
        """The bucket Spark puts a row in."""
        return F.pmod(F.hash("row_key"), F.lit(self.buckets)).alias("bucket")

    def _dealt(self, cells: DataFrame) -> DataFrame:
        """Cells dealt like the base, with all columns of its table: a union of both
        keeps the partitioning only if neither side leaves columns out."""
        whole = cells.select(*CELL_SCHEMA.names).withColumn("bucket", self._bucket())
        return whole.select(self.spark.table(self.table).columns).repartition(
            self.buckets, "row_key"
        )

    def _overwrite(self, cells: DataFrame) -> None:
        conf, mode = self.spark.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(mode)
        conf.set(mode, "dynamic")  # directories without new cells stay
        try:
            cells.write.mode("overwrite").insertInto(self.table)
        finally:
            conf.set(mode, before)


def buckets_for(cells: DataFrame, least: int = 1) -> int:
    """How many buckets a base needs to hold so many cells, of which about
    ``BUCKET_BYTES`` are in each. Reads the cells once."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in CELL_SCHEMA.fields
             if f.dataType.simpleString() == "string"]
    size = cells.agg(F.sum(sum(texts, F.lit(_CELL)).cast("long"))).first()[0] or 0
    return min(_MOST, max(least, -(-size // BUCKET_BYTES)))


def open_base(spark: SparkSession, path: str, buckets: int | None = None) -> CellBase:
    """The base at a path. ``buckets`` (see ``buckets_for``) is needed to make a new one, and
    can't be changed; an existing one knows its own."""
    path = _qualified(spark, path)
    known = _known_buckets(spark, path)
    if known is None:
        if buckets is None or buckets < 1:
            raise ValueError(f"no base at {path}; give a number of buckets to make one")
        spark.range(1).select(F.lit(str(buckets)).alias("value")).write.text(f"{path}/{_LAYOUT}")
        known = buckets
    elif buckets not in (None, known):
        raise ValueError(f"the base at {path} has {known} buckets, not {buckets}")
    table = f"widerow_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    columns = [f for f in CELL_SCHEMA.fields if f.name not in _PLACE]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({fields}, keyspace string, cf string, bucket int)"
        f" USING parquet PARTITIONED BY ({', '.join(_PLACE)})"
        f" CLUSTERED BY (row_key) SORTED BY (row_key, super, name) INTO {known} BUCKETS"
        f" LOCATION '{location}'"
    )
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)  # other sessions may have merged
    return CellBase(spark, path, known, table)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that a relative one means the same to readers
    and to the table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(folder).toString().rstrip("/")


def _known_buckets(spark: SparkSession, path: str) -> int | None:
    layout = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_LAYOUT}")
    files = layout.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(layout):
        return None
    return int(spark.read.text(f"{path}/{_LAYOUT}").first()["value"])
