"""The stored cell table: Parquet, partitioned by keyspace and family.

Writing is appending, which makes an upsert cheap and safe to retry as a job;
readers reconcile. ``compact`` pays for that once instead of on every read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reconcile import reconcile
from ..schema import CELL_KEY, CELL_SCHEMA, FamilySpec

_PARTITIONS = ["keyspace", "cf"]


def append_cells(cells: DataFrame, path: str) -> None:
    cells.write.mode("append").partitionBy(*_PARTITIONS).parquet(path)


def scan_cells(
    spark: SparkSession,
    path: str,
    spec: FamilySpec | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Stored cells as written, of one family or all, of the given names or all.

    The family prunes directories and the names are pushed to the Parquet reader.
    Dumpers and ``reconcile`` settle which cells are current.
    """
    cells = picked(spark.read.schema(CELL_SCHEMA).parquet(path), spec, names)
    return cells.select(*CELL_SCHEMA.names)


def picked(
    cells: DataFrame, spec: FamilySpec | None, names: Sequence[str] | None
) -> DataFrame:
    if spec is not None:
        cells = cells.filter(spec.matches())
    if names is not None:
        spell = spec.canonical if spec is not None else str
        cells = cells.filter(F.col("name").isin([spell(n) for n in names]))
    return cells


def compact(
    spark: SparkSession, path: str, new_path: str, by_name: bool = False
) -> None:
    """The current cells of every family, written to a new path in key order.

    Ranges of the whole cell key split a large family or a wide row over many files
    and keep a small family in few. The cells of a row lie together, which packs its
    key and lets a dump combine most of a row before its shuffle.

    With ``by_name`` cells lie by name, then row, and files have Bloom filters of names:
    for tables read by a few names of many, as then most row groups and files, whose
    least and greatest names or filters exclude the wanted ones, are skipped.
    """
    order = CELL_KEY
    if by_name:
        order = [*CELL_KEY[:2], "name", "row_key", "super"]
    cells = reconcile(scan_cells(spark, path)).repartitionByRange(*order)
    writer = cells.sortWithinPartitions(*order).write.mode("errorifexists")
    if by_name:
        writer = writer.option("parquet.bloom.filter.enabled#name", "true")
    writer.partitionBy(*_PARTITIONS).parquet(new_path)
