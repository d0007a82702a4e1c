"""Column builders for tab-separated text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAB = "\t"


def split_fields(line: Column, collapse_tabs: bool = False) -> Column:
    """Fields of a line, empty inner fields kept and trailing empty ones dropped.

    An empty line has one empty field, a line of nothing but tabs has none.
    ``F.split`` alone keeps trailing empties whatever its limit.
    """
    body = F.rtrim(line, F.lit(TAB))
    only_tabs = (body == "") & (line != "")
    return F.when(only_tabs, F.array().cast("array<string>")).otherwise(
        F.split(body, TAB + "+" if collapse_tabs else TAB, -1)
    )


def split_record(line: Column) -> Column:
    """Fields of a record, every empty one kept."""
    return F.split(line, TAB, -1)


def tab_line(*columns: Column) -> Column:
    """Join columns with tabs, no trailing tab. A null counts as empty text."""
    return F.concat_ws(TAB, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def tab_line_trailing(key: Column, *items: Column) -> Column:
    """``key`` and every item, each followed by a tab. Items are texts, nulls left
    out, or arrays of text; there must be at least one."""
    return F.concat(key, F.lit(TAB), F.concat_ws(TAB, *items), F.lit(TAB))
