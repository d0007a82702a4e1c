"""What several operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.scratch import shared_folder, stored

__all__ = ["fresh", "ranked", "shared_folder", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add under the same names."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def group_key(column: str | Column) -> Column:
    """A text that is never null and differs wherever the column's values differ."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def ranked(
    df: DataFrame, group: str, order: str, ties: list[str], per_bucket: int, rank: str
) -> DataFrame:
    """Adds the place, from 0, of each row in its group by ``order``, a non-negative
    long below 2^62, and then by ``ties``.

    No group is sorted by one task: the range of ``order`` is cut into equal buckets,
    as many as give ``per_bucket`` rows each over the whole table; rows are numbered
    within a bucket and the counts of the buckets before are added. Where ``order`` is
    a hash, buckets are even however many rows a group has. ``df`` is read twice and
    should be stored.
    """
    buckets = max(1, df.count() // per_bucket)
    width = (1 << 62) // buckets + 1
    split = df.withColumn("_bucket", F.floor(F.col(order) / F.lit(width)).cast("long"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = split.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    offsets = counts.select(
        group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(order, *ties)
    return (
        split.withColumn("_place", F.row_number().over(inside))
        .join(offsets, [group, "_bucket"])
        .withColumn(rank, F.col("_before") + F.col("_place") - 1)
        .drop("_bucket", "_before", "_place")
    )


def hash_order(*columns: Column) -> Column:
    """A seeded-shuffle key for ``ranked``: 62 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo a number; a null key counts as an empty text."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(divisor))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    kept: Column,
    max_rows: int,
    key: str = "doc_id",
) -> DataFrame:
    """``docs`` with a label (``_label``) of 0 or 1: those of about ``max_rows`` rows of
    ``labels`` that are ``kept``, chosen by a hash of the key.

    The chosen rows are broadcast, being bounded by ``max_rows``; documents aren't
    shuffled. Rows without a key or label aren't used. A key with several labels counts
    with each.
    """
    known = labels.filter(kept & F.col(key).isNotNull() & F.col(label).isin(0, 1))
    n = known.count()
    if n > max_rows:
        limit = int((1 << 62) * max_rows / n)
        known = known.filter(hash_order(F.col(key)) < limit)
    known = known.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    return docs.join(F.broadcast(known), F.col(key) == F.col("_key")).drop("_key")


def isotonic(points: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """A rising calibration curve through (raw score, number, sum of labels): neighbours
    that fall are pooled; between the pools' middles it is linear."""
    pools: list[list[float]] = []  # number, sum of labels, sum of raw scores
    for x, n, y in sorted(points):
        pools.append([n, y, x * n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    at = np.array([p[2] / p[0] for p in pools])
    return at, np.array([p[1] / p[0] for p in pools])


MOST_BROADCAST = 2_000_000  # rows of a few numbers each


def small(df: DataFrame) -> DataFrame:
    """``df``, stored, and broadcast where it has few enough rows; where not, Spark picks
    the join."""
    df = stored(df)
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df
