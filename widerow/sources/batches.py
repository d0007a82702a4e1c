"""Batches: each load in a directory of its own, good cells and rejects from one scan.

``write_batch`` writes everything a load gives in one pass over its input: cells and
rejects go to different directories of the batch. Writing a batch again replaces it, so a
load that failed or ran twice leaves one result. Counters are read from the files that
were committed, which a task that ran twice can't change; only the lines, which have no
record of their own, are counted on the way, within the tasks of the one write.

Batches are the deltas of a base: they sort by name, so name them by date or number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.loaders import LoadResult
from ..schema import CELL_SCHEMA, FamilySpec

_KINDS = ("cells", "rejects")
_RECORDS = StructType(
    [
        *CELL_SCHEMA.fields,
        *(StructField(c, StringType()) for c in ("reason", "line", "batch", "kind")),
    ]
)


def write_batch(load: LoadResult, path: str, batch: str) -> dict[str, int]:
    """The load as batch ``batch`` below ``path``; its counters, as
    ``LoadResult.counters`` has them (without ``rows`` and ``bad_ts`` if the load
    wasn't made with ``count=True``)."""
    if "/" in batch or not batch:
        raise ValueError(f"a batch needs a name without '/', not {batch!r}")
    kind = F.when(F.col("reason").isNull(), _KINDS[0]).otherwise(_KINDS[1])
    own = f"{path.rstrip('/')}/batch={batch}"
    checked = load.checked.withColumn("kind", kind)
    checked.write.mode("overwrite").partitionBy("kind", "keyspace", "cf").parquet(own)
    spark = checked.sparkSession
    found = _scan(spark, path).filter(F.col("batch") == batch).groupBy("kind").count()
    number = {r["kind"]: r["count"] for r in found.collect()}
    lines = load.line_counts.get if load.line_counts is not None else {}
    return {**lines, "columns": number.get(_KINDS[0], 0), "bad": number.get(_KINDS[1], 0)}


def scan_batches(
    spark: SparkSession,
    path: str,
    spec: FamilySpec | None = None,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """The cells of the batches from ``first`` to ``last``, both included, of one family
    or all. Batches, kinds and families prune directories."""
    cells = _between(_scan(spark, path), first, last).filter(F.col("kind") == _KINDS[0])
    if spec is not None:
        cells = cells.filter(spec.matches())
    return cells.select(*CELL_SCHEMA.names)


def scan_rejects(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """What the batches rejected, with reason and line."""
    bad = _between(_scan(spark, path), first, last).filter(F.col("kind") == _KINDS[1])
    return bad.select("keyspace", "cf", "row_key", "super", "name", "reason", "line")


def append_stream(cells: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream of cells to the cell table at ``path``, which only streams may
    write. The table keeps a log of finished batches, so a batch that runs again after a
    failure leaves one result. It takes what there is and ends; start it again with the
    same checkpoint for what has come since."""
    return (
        cells.select(*CELL_SCHEMA.names)
        .writeStream.partitionBy("keyspace", "cf")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path, format="parquet")
    )


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_RECORDS).parquet(path)


def _between(records: DataFrame, first: str | None, last: str | None) -> DataFrame:
    if first is not None:
        records = records.filter(F.col("batch") >= first)
    if last is not None:
        records = records.filter(F.col("batch") <= last)
    return records
