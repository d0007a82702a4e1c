"""Proportional stratified interleaving of rows into shards.

Rows of each source are put in a seeded random order; a row's place there, as a fraction
of its source's rows, is its place in the whole. Cutting the whole into equal runs gives
every shard every source in its share, and all shards row counts at most one apart. The
fractions of a source start at an offset of its own: sources of the same size take turns
in steps of the golden ratio, which spreads any number of them evenly, so many sources
with a row or two fill all shards alike.

A null source is a source of its own. ``identity`` columns settle the order of rows. Rows
equal in all of them are numbered first, and the number counts in their order, so they
spread like others; which of them gets which place is open, the places are the same every
time. Nothing groups rows by their text. An empty table gives no rows. Columns named like
added or inner ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, group_key, hash_order, ranked, stored

PER_BUCKET = 5_000
_TURN = (5**0.5 - 1) / 2


def interleave(
    docs: DataFrame,
    identity: list[str],
    source: str = "source",
    shards: int = 16,
    seed: int = 17,
) -> DataFrame:
    """The rows with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    All columns of ``docs`` are carried through three shuffles, so pass what is wanted:
    keys to plan a layout, whole rows to write it. ``identity`` names the columns that
    tell rows apart. No source and no group of equal rows is sorted by one task, whatever
    its share of the rows.
    """
    inner = (
        "_group _order _size _rank _place _all _position _bucket _before"
        " _same _salt _number _by _turn"
    ).split()
    keyed = fresh(docs, "shard", "slot", *inner).withColumns(
        {
            "_group": group_key(source),
            "_same": F.to_json(F.struct(*identity)),
            "_salt": hash_order(F.monotonically_increasing_id()),
        }
    )
    keyed = stored(keyed)
    n = keyed.count()
    numbered = ranked(keyed, "_same", "_salt", [], PER_BUCKET, "_number")
    order = hash_order(F.lit(seed), "_group", "_same", "_number")
    keyed = stored(numbered.withColumn("_order", order).drop("_same", "_salt", "_number"))
    sizes = keyed.groupBy("_group").agg(F.count("*").alias("_size"))
    sizes = stored(sizes.withColumn("_by", hash_order(F.lit(seed), "_group")))
    sizes = ranked(sizes, "_size", "_by", ["_group"], PER_BUCKET, "_turn").drop("_by")
    placed = ranked(keyed, "_group", "_order", identity, PER_BUCKET, "_rank")
    # Where in the source's row the place lies, then as a place in [0, 2^62).
    turn = F.col("_turn") * _TURN + 0.5
    part = (F.col("_rank") + turn - F.floor(turn)) / F.col("_size")
    placed = placed.join(sizes, "_group").withColumn(
        "_place", (part * F.lit(float(1 << 62))).cast("long")
    )
    placed = stored(placed.drop("_order", "_size", "_turn").withColumn("_all", F.lit("")))
    whole = ranked(
        placed, "_all", "_place", ["_group", "_rank"], PER_BUCKET, "_position"
    )
    # Integer division both ways: shard k starts at the least position p with
    # p * shards >= k * n.
    shard = F.expr(f"_position * {shards} div {max(n, 1)}")
    return whole.withColumn("shard", shard.cast("int")).withColumn(
        "slot",
        F.col("_position")
        - F.expr(f"(shard * cast({n} as bigint) + {shards - 1}) div {shards}"),
    ).drop("_group", "_rank", "_place", "_all", "_position")


def write_shards(sharded: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """One folder a shard, its rows in slot order over several files."""
    files = F.floor(F.col("slot") / F.lit(1 << 16)) % files_per_shard
    (
        sharded.withColumn("_file", files)
        .repartition("shard", "_file")
        .sortWithinPartitions("shard", "slot")
        .drop("_file")
        .write.partitionBy("shard")
        .parquet(path)
    )
