"""Dumpers: cells in, lines of text out.

Each takes cells as a load or ``scan_cells`` gives them, keeps those of one family
and reconciles them. Pass ``reconciled=True`` for cells that are known to be so
already (a compacted table, the result of ``reconcile``) to save that shuffle, and
``bucketed=True`` for cells of a base, of which nothing is shuffled then.
The result has one text column ``value``, in no particular order of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tab_line, tab_line_trailing
from ..schema import FamilySpec
from .prepare import map_lines
from .reconcile import reconcile
from .wide_rows import by_piece


def dump_table(
    cells: DataFrame, spec: FamilySpec, names: Sequence[str], reconciled: bool = False
) -> DataFrame:
    """``row_key`` and the values of the named columns, each followed by a tab.

    Values come in name order, whatever the order of ``names``; a missing column
    leaves no gap and a row with none of them gives no line. The name filter
    reaches the scan, and a group holds at most ``len(names)`` reconciled cells.
    """
    spec.require(is_super=False)
    wanted = sorted({spec.canonical(name) for name in names}, key=spec.order_of)
    if not wanted:
        raise ValueError("no columns to dump")
    picked = cells.filter(spec.matches() & F.col("name").isin(wanted))
    cell = F.struct(spec.sort_key("name").alias("at"), "value")
    rows = (
        _newest(picked, spec, reconciled)
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    )
    return rows.select(
        tab_line_trailing(F.col("row_key"), F.col("cells.value")).alias("value")
    )


def dump_column_names(
    cells: DataFrame,
    spec: FamilySpec,
    reconciled: bool = False,
    pieces: int = 1,
    bucketed: bool = False,
) -> DataFrame:
    """``row_key`` and the name of every column, each followed by a tab, in name
    order; the columns of a super family are its supers. Neither values nor
    timestamps are read. ``pieces`` lines per row, one if not given."""
    name = F.col("super" if spec.is_super else "name").alias("name")
    named = cells.filter(spec.matches()).select("row_key", name)
    if spec.is_super or not reconciled:
        named = named.distinct()
    dealt, line = by_piece(named, ["name"], pieces, bucketed)
    rows = dealt.groupBy(*line).agg(
        F.sort_array(F.collect_list(spec.sort_key("name"))).alias("names")
    )
    names = F.col("names").cast("array<string>")
    return rows.select(tab_line_trailing(F.col("row_key"), names).alias("value"))


def dump_super_map(
    cells: DataFrame,
    spec: FamilySpec,
    max_super: int | None = None,
    reconciled: bool = False,
) -> DataFrame:
    """One line per super cell: ``row_key``, super, name, value. ``max_super`` keeps
    the first so many supers of each row, in name order.

    For that, supers are ranked over cells that are reconciled already. Every task
    ranks its own cells first and passes on only those of its first supers, so a row
    with any number of supers sends few of them; ranking holds no row in memory.
    """
    spec.require(is_super=True)
    newest = _newest(cells, spec, reconciled)
    if max_super is not None:
        place = F.dense_rank().over(
            Window.partitionBy("row_key").orderBy(spec.sort_key("super"))
        )
        newest = (
            newest.filter(F.col("row_key").isNotNull() & F.col("super").isNotNull())
            .withColumn("place", place)
            .filter(F.col("place") <= max_super)
        )
    return newest.select(
        tab_line(*[F.col(c) for c in ("row_key", "super", "name", "value")]).alias(
            "value"
        )
    )


def dump_map(
    cells: DataFrame,
    spec: FamilySpec,
    reconciled: bool = False,
    pieces: int = 1,
    bucketed: bool = False,
) -> DataFrame:
    """``row_key``, tab, JSON object of the row: what ``load_map`` reads. ``pieces``
    lines per row, one if not given."""
    spec.require(is_super=False)
    newest = _newest(cells, spec, reconciled)
    rows = map_lines(newest, spec.sort_key("name"), pieces, bucketed)
    return rows.select(tab_line(F.col("row_key"), F.col("json")).alias("value"))


def _newest(cells: DataFrame, spec: FamilySpec, reconciled: bool) -> DataFrame:
    return cells.filter(spec.matches()) if reconciled else reconcile(cells, spec)
