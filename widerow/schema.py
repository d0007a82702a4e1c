"""The cell table: one row per cell of a wide-row store.

A family is either *standard* (``super`` is null) or *super* (cells sit one level
deeper, under a super name). Names of a long-named family are kept as canonical
decimal text and compared as numbers.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

_LONG = re.compile("[+-]?[0-9]+")

CELL_KEY = ["keyspace", "cf", "row_key", "super", "name"]

CELL_SCHEMA = StructType(
    [
        StructField("keyspace", StringType()),
        StructField("cf", StringType()),
        StructField("row_key", StringType()),
        StructField("super", StringType()),
        StructField("name", StringType()),
        StructField("value", StringType()),
        StructField("ts", LongType()),
    ]
)

# The default field names of a positional table load.
DEFAULT_NAMES = [
    "rsrc", "tweet_id", "created_at", "user_id", "screen_name", "search_id",
    "in_reply_to_user_id", "in_reply_to_screen_name", "in_reply_to_search_id",
    "in_reply_to_status_id", "text", "source", "lang", "lat", "lng",
    "retweeted_count", "rt_of_user_id", "rt_of_screen_name", "rt_of_tweet_id",
    "contributors",
]


@dataclass(frozen=True)
class FamilySpec:
    """Which family cells belong to, and how its names are to be read."""

    keyspace: str = "Keyspace1"
    cf: str = "Standard1"
    long_names: bool = False
    is_super: bool = False

    def __post_init__(self) -> None:
        if not self.keyspace or not self.cf:
            raise ValueError("keyspace and cf must not be empty")

    def require(self, is_super: bool) -> None:
        if self.is_super != is_super:
            kind = "super" if is_super else "standard"
            raise ValueError(f"{self.cf} is not a {kind} family")

    def matches(self) -> Column:
        return (F.col("keyspace") == self.keyspace) & (F.col("cf") == self.cf)

    def sort_key(self, name: str) -> Column:
        """A column (super or name) in the order the family sorts it."""
        return F.col(name).cast("bigint") if self.long_names else F.col(name)

    def order_of(self, name: str) -> int | str:
        return int(name) if self.long_names else name

    def canonical(self, name: str) -> str:
        """A name as the family stores it; as strict about longs as the loaders."""
        if not self.long_names:
            return name
        if not _LONG.fullmatch(name) or not -(1 << 63) <= int(name) < 1 << 63:
            raise ValueError(f"{name!r} is not a 64-bit long")
        return str(int(name))
