"""Last write wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CELL_KEY, CELL_SCHEMA, FamilySpec


def reconcile(cells: DataFrame, spec: FamilySpec | None = None) -> DataFrame:
    """The newest cell of each name; of equally new ones the greater value. With
    ``spec``, of that family only, whose constant columns are then not shuffled.

    ``max`` combines before the shuffle, so a cell written a billion times sends
    one candidate per map task, and the shuffle key holds the name, so a row of any
    width spreads over all tasks.
    """
    if spec is None:
        return _newest(cells, CELL_KEY)
    key = ["row_key", "super", "name"] if spec.is_super else ["row_key", "name"]
    constants = {
        "keyspace": F.lit(spec.keyspace),
        "cf": F.lit(spec.cf),
        "super": F.col("super") if spec.is_super else F.lit(None).cast("string"),
    }
    newest = _newest(cells.filter(spec.matches()), key)
    return newest.withColumns(constants).select(*CELL_SCHEMA.names)


def merge_cells(*cells: DataFrame, spec: FamilySpec | None = None) -> DataFrame:
    """Several loads reconciled together, of all families or the given one."""
    if not cells:
        raise ValueError("nothing to merge")
    return reconcile(reduce(DataFrame.unionByName, cells), spec)


def _newest(cells: DataFrame, key: list[str]) -> DataFrame:
    return (
        cells.groupBy(*key)
        .agg(F.max(F.struct("ts", "value")).alias("newest"))
        .select(*key, F.col("newest.value"), F.col("newest.ts"))
    )
