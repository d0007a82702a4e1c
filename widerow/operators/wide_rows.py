"""Rows as lines.

A dump writes one line per row, and a line is one Spark string, built in one task; a
row beyond what a string can hold fails there (``operators.pieces`` writes such rows). For
rows known to be hot, ``pieces`` deals the cells of every row over so many lines, whatever the row's size: each line
starts with the row's key, a cell goes by a hash of its name, and each line keeps name
order. Every layout reads such lines back as the same row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_piece(
    cells: DataFrame, spread: list[str], pieces: int = 1, bucketed: bool = False
) -> tuple[DataFrame, list[str]]:
    """The cells of each line brought together for grouping, and the columns that tell
    lines apart: the row and, with several ``pieces``, the piece. Cells are shuffled
    plain, since collecting them first would only wrap each in an array of its own;
    ``bucketed`` ones, of which all of a row are in one task, stay where they are."""
    if pieces < 1:
        raise ValueError(f"pieces must be 1 or more, not {pieces}")
    line = ["row_key"]
    if pieces > 1:
        line.append("piece")
        cells = cells.withColumn("piece", F.pmod(F.xxhash64(*spread), F.lit(pieces)))
    return (cells if bucketed else cells.repartition(*line)), line
