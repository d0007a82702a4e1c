"""Grouping records by key into JSON maps, the input of the map loaders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json_member, json_object, json_pair, split_record
from .wide_rows import by_piece


def split_records(lines: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """Tab-separated records of exactly ``len(names)`` fields, the last of which may
    be empty like any other, and the lines that do not have that many."""
    split = lines.select(
        F.col("value").alias("line"), split_record(F.col("value")).alias("fields")
    )
    fits = F.size("fields") == len(names)
    records = split.filter(fits).select(
        *[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(names)]
    )
    rejects = split.filter(~fits).select(
        F.lit("bad_field_count").alias("reason"), "line"
    )
    return records, rejects


def map_prepare(
    records: DataFrame,
    key: str = "row_key",
    name: str = "name",
    value: str = "value",
    order: str | None = None,
    pieces: int = 1,
) -> DataFrame:
    """``(row_key, json)``: one flat JSON object per key, or ``pieces`` of them.

    A repeated name keeps the value last by ``order``, the greatest without one.
    """
    last = current_records(records, {"row_key": key, "name": name, "value": value}, order)
    return map_lines(last, F.col("name"), pieces)


def super_map_prepare(
    records: DataFrame,
    key: str = "row_key",
    super: str = "super",
    name: str = "name",
    value: str = "value",
    order: str | None = None,
    pieces: int = 1,
) -> DataFrame:
    """``(row_key, json)``: one JSON object of flat JSON objects per key; repeated
    names and ``pieces`` as in ``map_prepare``."""
    named = {"row_key": key, "super": super, "name": name, "value": value}
    last = current_records(records, named, order)
    # The one shuffle serves both groupings.
    dealt, line = by_piece(last, ["super", "name"], pieces)
    supers = dealt.groupBy(*line, "super").agg(_pairs(F.col("name")).alias("pairs"))
    member = json_member(F.col("super"), json_object(F.col("pairs.pair")))
    rows = (
        supers.select(*line, "super", member.alias("member"))
        .groupBy(*line)
        .agg(F.sort_array(F.collect_list(F.struct("super", "member"))).alias("members"))
    )
    return rows.select("row_key", json_object(F.col("members.member")).alias("json"))


def map_lines(
    cells: DataFrame, sort_key: Column, pieces: int, bucketed: bool = False
) -> DataFrame:
    """``(row_key, json)`` from cells with distinct names per row, names sorted by
    ``sort_key``."""
    picked = cells.select("row_key", "name", "value")
    dealt, line = by_piece(picked, ["name"], pieces, bucketed)
    rows = dealt.groupBy(*line).agg(_pairs(sort_key).alias("pairs"))
    return rows.select("row_key", json_object(F.col("pairs.pair")).alias("json"))


def _pairs(sort_key: Column) -> Column:
    pair = json_pair(F.col("name"), F.col("value")).alias("pair")
    return F.sort_array(F.collect_list(F.struct(sort_key.alias("at"), pair)))


def current_records(
    records: DataFrame, named: dict[str, str], order: str | None
) -> DataFrame:
    """The named columns as text, one record for each key and name: the last by
    ``order``, that with the greatest value without one."""
    keys = [new for new in named if new != "value"]
    records = records.withColumns(
        {new: F.col(old).cast("string") for new, old in named.items()}
    )
    if order is None:
        return records.groupBy(*keys).agg(F.max("value").alias("value"))
    return (
        records.groupBy(*keys)
        .agg(F.max(F.struct(F.col(order).alias("at"), "value")).alias("last"))
        .select(*keys, "last.value")
    )
