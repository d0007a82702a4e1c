"""Rows of any size as one line each.

The dumps in ``dumpers`` build a line as one string. These give the same rows in pieces,
a piece per cell: rows are sorted by (row, name) and numbered as they pass, a row being
spilled rather than held, and ``write_pieces`` writes piece after piece, so neither a row
nor a line is ever one string or array. A line still lies in one file, so it is one task's
work.

JSON has a space after each member and the object, and is otherwise that of ``dump_map``;
the map loaders read it all the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import json_member, json_pair
from ..schema import FamilySpec
from .prepare import current_records
from .reconcile import reconcile


def name_pieces(cells: DataFrame, spec: FamilySpec, reconciled: bool = False) -> DataFrame:
    """The lines of ``dump_column_names``."""
    name = F.col("super" if spec.is_super else "name").alias("name")
    named = cells.filter(spec.matches()).select("row_key", name)
    if spec.is_super or not reconciled:
        named = named.distinct()
    named = named.filter(F.col("row_key").isNotNull() & F.col("name").isNotNull())
    starts = _first(["row_key"], [spec.sort_key("name")])
    piece = F.when(F.col("starts"), F.concat_ws("\t", "row_key", "name")).otherwise(F.col("name"))
    return _pieces(named.withColumn("starts", starts), piece, "\t")


def map_pieces(cells: DataFrame, spec: FamilySpec, reconciled: bool = False) -> DataFrame:
    """The lines of ``dump_map``."""
    spec.require(is_super=False)
    newest = cells.filter(spec.matches()) if reconciled else reconcile(cells, spec)
    return _members(newest, spec.sort_key("name"))


def prepared_pieces(
    records: DataFrame,
    key: str = "row_key",
    name: str = "name",
    value: str = "value",
    super: str | None = None,
    order: str | None = None,
) -> DataFrame:
    """Key, tab and the JSON of ``map_prepare``, or of ``super_map_prepare`` where a
    column ``super`` is named."""
    named = {"row_key": key, "name": name, "value": value}
    if super is None:
        return _members(current_records(records, named, order), F.col("name"))
    last = current_records(records, {**named, "super": super}, order)
    return _super_members(last)


def _first(row: list[str], order: list[Column], ends: bool = False) -> Column:
    """Whether this is the row's first record in the order, or its last. Looking one
    record back or ahead costs no memory but that of the sorted row, which spills."""
    beside = F.lead if ends else F.lag
    return beside(F.lit(1)).over(Window.partitionBy(*row).orderBy(*order)).isNull()


def _members(cells: DataFrame, at: Column) -> DataFrame:
    known = cells.filter(F.col("row_key").isNotNull() & F.col("name").isNotNull())
    marked = known.select(
        "row_key",
        json_pair(F.col("name"), F.col("value")).alias("pair"),
        _first(["row_key"], [at]).alias("starts"),
        _first(["row_key"], [at], ends=True).alias("ends"),
    )
    piece = F.concat(
        F.when(F.col("starts"), F.concat("row_key", F.lit("\t{"))).otherwise(""),
        "pair",
        F.when(F.col("ends"), "}").otherwise(","),
    )
    return _pieces(marked, piece, " ")


def _super_members(cells: DataFrame) -> DataFrame:
    given = F.col("row_key").isNotNull() & F.col("super").isNotNull() & F.col("name").isNotNull()
    order = Window.partitionBy("row_key").orderBy("super", "name")
    marked = cells.filter(given).select(
        "row_key",
        "super",
        json_pair(F.col("name"), F.col("value")).alias("pair"),
        F.lag("super").over(order).alias("before"),
        F.lead("super").over(order).alias("after"),
    )
    marked = marked.withColumn("starts", F.col("before").isNull())
    opens = F.col("starts") | (F.col("before") != F.col("super"))
    piece = F.concat(
        F.when(F.col("starts"), F.concat("row_key", F.lit("\t{"))).otherwise(""),
        F.when(opens, json_member(F.col("super"), F.lit("{"))).otherwise(""),
        "pair",
        F.when(F.col("after").isNull(), "}}")
        .when(F.col("after") != F.col("super"), "},")
        .otherwise(","),
    )
    return _pieces(marked, piece, " ")


def _pieces(marked: DataFrame, piece: Column, separator: str) -> DataFrame:
    return marked.select(
        F.col("starts"), piece.alias("piece", metadata={"separator": separator})
    )
