"""Text files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of a file, directory or glob, as ``value``. Bytes that are no UTF-8
    become U+FFFD."""
    return spark.read.text(path).select(F.make_valid_utf8("value").alias("value"))


def write_lines(lines: DataFrame, path: str, overwrite: bool = False) -> None:
    """One text column, one line per row. Fails when the path exists, unless told
    to overwrite it."""
    lines.write.mode("overwrite" if overwrite else "errorifexists").text(path)


def write_pieces(pieces: DataFrame, path: str, overwrite: bool = False) -> None:
    """Lines given in pieces (``starts``, ``piece``), as ``operators.pieces`` makes them:
    each piece is a record that ends with a space or tab, and one that starts a line has
    a line end before it unless it is its file's first. So a line needs no more memory
    than its longest piece. The last line of a file has no line end."""
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # in the task
    follows = F.col("starts") & (at > 0)
    text = F.when(follows, F.concat(F.lit("\n"), "piece")).otherwise(F.col("piece"))
    # The separator is the pieces' last character, which the sink adds.
    separator = pieces.schema["piece"].metadata["separator"]
    pieces.select(text.alias("value")).write.mode(
        "overwrite" if overwrite else "errorifexists"
    ).option("lineSep", separator).text(path)


def discard(df: DataFrame) -> None:
    """Run a load for its counters alone, storing nothing."""
    df.write.format("noop").mode("overwrite").save()
