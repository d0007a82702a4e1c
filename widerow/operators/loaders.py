"""Loaders: lines of text in, cells out.

Every loader takes a DataFrame with one text column ``value`` and turns each line
into zero or more cells. All of it is row-local (one scan, one ``Generate``, no
shuffle), so a line costs the same at any scale, and streaming lines work too.

A bad line or cell becomes a reject with a reason. A line-level reject travels
through the ``explode`` as one empty placeholder entry; the test for it reads a
generated column, which keeps Spark from moving the filter below the ``Generate``
and splitting or parsing each line a second time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import (
    json_map,
    json_super_map,
    last_entries,
    parse_long,
    resolve_ts,
    split_fields,
)
from ..schema import FamilySpec


@dataclass(frozen=True)
class LoadResult:
    """``cells`` and ``rejects`` are two views of one shredded input, ``checked`` is
    both in one: every cell with a null ``reason``, and every reject with its reason
    and line.

    Each is lazy; ``checked`` gives both from one scan, using the other two reads the
    input twice. With ``count=True`` an action on ``cells`` also fills the counters, so
    that the rejects need a scan of their own only when ``counters()['bad']`` is not
    zero.
    """

    cells: DataFrame
    rejects: DataFrame
    checked: DataFrame
    line_counts: Observation | None = None
    cell_counts: Observation | None = None

    def counters(self) -> dict[str, int]:
        """Lines loaded, cells loaded, rejects, and lines whose timestamp field
        could not be read. Available once an action has run on ``cells``; exact when
        that writes them straight out, as tasks of an inner stage that run again
        after a loss count again."""
        if self.line_counts is None or self.cell_counts is None:
            raise ValueError("load with count=True to get counters")
        return {**self.line_counts.get, **self.cell_counts.get}


def load_table(
    lines: DataFrame,
    spec: FamilySpec,
    names: Sequence[str],
    key_field: int = 0,
    ts_field: int | None = None,
    load_ts: int | None = None,
    on_bad_ts: str = "now",
    skip_name: str | None = None,
    collapse_tabs: bool = False,
    keep_key: bool = False,
    drop_missing_key: bool = False,
    mode: str = "permissive",
    count: bool = False,
) -> LoadResult:
    """Positional table: field ``i`` becomes a cell named ``names[i]``.

    Names count the key's position too. Fields past the names are dropped, and the
    timestamp field is stored like any other. ``on_bad_ts`` is ``'now'`` (use the
    load time) or ``'reject'``. The last four switches give the wide layout: fields
    named ``skip_name`` are left out, runs of tabs separate once, the key is a cell
    too, and lines without a key are left out silently.
    """
    if on_bad_ts not in ("now", "reject"):
        raise ValueError(f"on_bad_ts must be 'now' or 'reject', not {on_bad_ts!r}")
    spec.require(is_super=False)
    wanted = [
        None
        if name == skip_name or (i == key_field and not keep_key)
        else spec.canonical(name)
        for i, name in enumerate(names)
    ]
    name_at = F.array(*[F.lit(n).cast("string") for n in wanted])

    split = _split(lines, collapse_tabs)
    parsed = None if ts_field is None else parse_long(F.get("fields", F.lit(ts_field)))
    split = split.withColumn("parsed_ts", F.lit(None) if parsed is None else parsed)
    bad_ts = F.lit(False) if parsed is None else F.col("parsed_ts").isNull()
    ts = resolve_ts(None if parsed is None else F.col("parsed_ts"), load_ts)

    key = F.get("fields", F.lit(key_field))
    no_key = F.coalesce(key, F.lit("")) == ""
    reason = F.lit(None).cast("string")
    if not drop_missing_key:
        reason = _key_reason(key)
    if on_bad_ts == "reject":
        spoiled = bad_ts & ~no_key if drop_missing_key else bad_ts
        reason = F.when(spoiled, "bad_timestamp").otherwise(reason)
    fields = F.col("fields")
    if drop_missing_key:
        fields = F.when(no_key, F.array().cast("array<string>")).otherwise(fields)

    keyed = split.select(
        "line",
        "fields",
        key.alias("row_key"),
        ts.alias("ts"),
        bad_ts.alias("bad_ts"),
        reason.alias("line_reason"),
    )
    keyed, line_counts = _observe_lines(keyed, F.col("bad_ts"), count)
    shredded = (
        keyed.select("line", "row_key", "ts", "line_reason", _posexplode(fields))
        .withColumn("name", F.when(F.col("field").isNotNull(), F.get(name_at, "at")))
        .filter(F.col("name").isNotNull() | F.col("field").isNull())
        .select(
            "line",
            "row_key",
            _no_super(),
            "name",
            F.col("field").alias("value"),
            "ts",
            F.when(F.col("field").isNull(), F.col("line_reason")).alias("reason"),
        )
    )
    return _result(shredded, spec, mode, line_counts, parse_names=False)


def load_columns(
    lines: DataFrame,
    spec: FamilySpec,
    key_field: int = 0,
    fill_value: str = "0",
    load_ts: int | None = None,
    mode: str = "permissive",
    count: bool = False,
) -> LoadResult:
    """Adjacency list: every field but the key becomes a cell *name*, whose value
    is ``fill_value``."""
    spec.require(is_super=False)
    key = F.get("fields", F.lit(key_field))
    keyed = _split(lines).select(
        "line", "fields", key.alias("row_key"), _key_reason(key).alias("line_reason")
    )
    keyed, line_counts = _observe_lines(keyed, F.lit(False), count)
    shredded = (
        keyed.select("line", "row_key", "line_reason", _posexplode(F.col("fields")))
        .filter((F.col("at") != key_field) | F.col("field").isNull())
        .select(
            "line",
            "row_key",
            _no_super(),
            F.col("field").alias("name"),
            F.lit(fill_value).alias("value"),
            resolve_ts(None, load_ts).alias("ts"),
            F.when(F.col("field").isNull(), F.col("line_reason")).alias("reason"),
        )
    )
    return _result(shredded, spec, mode, line_counts)


def load_map(
    lines: DataFrame,
    spec: FamilySpec,
    load_ts: int | None = None,
    mode: str = "permissive",
    count: bool = False,
) -> LoadResult:
    """``row_key``, tab, flat JSON object: one cell per entry. Further fields are
    ignored."""
    spec.require(is_super=False)
    parsed = _json_lines(lines, json_map)
    parsed, line_counts = _observe_lines(parsed, F.lit(False), count)
    rejected = F.col("line_reason")
    shredded = parsed.select(
        "line", "row_key", "line_reason", _explode_map(rejected, "parsed", "string")
    ).select(
        "line",
        "row_key",
        _no_super(),
        F.when(rejected.isNull(), F.col("key")).alias("name"),
        F.col("entry").alias("value"),
        resolve_ts(None, load_ts).alias("ts"),
        F.when(F.col("entry").isNull(), F.coalesce(rejected, F.lit("null_value"))).alias(
            "reason"
        ),
    )
    return _result(shredded, spec, mode, line_counts)


def load_super_map(
    lines: DataFrame,
    spec: FamilySpec,
    load_ts: int | None = None,
    mode: str = "permissive",
    count: bool = False,
) -> LoadResult:
    """``row_key``, tab, JSON object of flat JSON objects: one super cell per inner
    entry. A bad super name rejects its super column, a bad inner name its cell."""
    spec.require(is_super=True)
    parsed = _json_lines(lines, json_super_map)
    parsed, line_counts = _observe_lines(parsed, F.lit(False), count)
    supers = parsed.select(
        "line",
        "row_key",
        "line_reason",
        _explode_map(F.col("line_reason"), "parsed", "map<string,string>"),
    ).select(
        "line",
        "row_key",
        "line_reason",
        F.when(F.col("line_reason").isNull(), F.col("key")).alias("super"),
        _canonical(F.col("key"), spec).alias("super_name"),
        last_entries(F.col("entry")).alias("inner"),
    )
    supers = supers.select(
        "line",
        "row_key",
        F.when(
            F.col("super").isNotNull(), F.coalesce("super_name", "super")
        ).alias("super"),
        "inner",
        F.when(F.col("super").isNull(), F.col("line_reason"))
        .when(F.col("inner").isNull(), "null_value")
        .when(F.col("super_name").isNull(), "bad_long_name")
        .alias("super_reason"),
    )
    rejected = F.col("super_reason")
    shredded = supers.select(
        "line", "row_key", "super", "super_reason", _explode_map(rejected, "inner", "string")
    ).select(
        "line",
        "row_key",
        "super",
        F.when(rejected.isNull(), F.col("key")).alias("name"),
        F.col("entry").alias("value"),
        resolve_ts(None, load_ts).alias("ts"),
        F.when(
            F.col("entry").isNull(), F.coalesce(rejected, F.lit("null_value"))
        ).alias("reason"),
    )
    return _result(shredded, spec, mode, line_counts)


def load_super_pairs(
    lines: DataFrame,
    spec: FamilySpec,
    load_ts: int | None = None,
    stop_at_bad_name: bool = False,
    mode: str = "permissive",
    count: bool = False,
) -> LoadResult:
    """``row_key``, super name, then name and value fields in turn. A trailing name
    without a value is ignored. With ``stop_at_bad_name`` a bad long name also
    drops the pairs after it."""
    spec.require(is_super=True)
    key, super_name = F.get("fields", F.lit(0)), F.get("fields", F.lit(1))
    keyed = _split(lines).select(
        "line",
        "fields",
        key.alias("row_key"),
        super_name.alias("super"),
        _canonical(super_name, spec).alias("super_name"),
        F.when(key.isNull(), "missing_key")
        .when(key == "", "empty_key")
        .when(super_name.isNull(), "missing_super")
        .alias("line_reason"),
    )
    keyed = keyed.withColumn(
        "line_reason",
        F.coalesce(
            "line_reason", F.when(F.col("super_name").isNull(), "bad_long_name")
        ),
    )
    keyed, line_counts = _observe_lines(keyed, F.lit(False), count)
    if stop_at_bad_name and spec.long_names:
        keyed = _cut_after_bad_name(keyed)
    # A name field is followed by its value field, so pair every field with the
    # next one and keep the pairs that start at a name.
    fields = F.col("fields")
    pairs = F.arrays_zip(
        fields.alias("name"), F.slice(fields, F.lit(2), F.size(fields)).alias("value")
    )
    super_name = F.when(
        F.col("super").isNotNull(), F.coalesce("super_name", "super")
    ).alias("super")
    shredded = (
        keyed.select("line", "row_key", super_name, "line_reason", pairs.alias("pairs"))
        .select(
            "line",
            "row_key",
            "super",
            "line_reason",
            F.posexplode(
                F.when(
                    F.col("line_reason").isNotNull(),
                    _placeholder("struct<name:string,value:string>"),
                ).otherwise(F.col("pairs"))
            ).alias("at", "pair"),
        )
        .select("line", "row_key", "super", "at", "pair.name", "pair.value", "line_reason")
        .filter(
            F.col("name").isNull()
            | ((F.col("at") >= 2) & (F.col("at") % 2 == 0) & F.col("value").isNotNull())
        )
        .select(
            "line",
            "row_key",
            "super",
            "name",
            "value",
            resolve_ts(None, load_ts).alias("ts"),
            F.when(F.col("name").isNull(), F.col("line_reason")).alias("reason"),
        )
    )
    return _result(shredded, spec, mode, line_counts)


def load_key_value(
    lines: DataFrame,
    spec: FamilySpec,
    load_ts: int | None = None,
    mode: str = "permissive",
    count: bool = False,
) -> LoadResult:
    """``row_key``, name, value triples; further fields are ignored. One cell per
    line; cells of one row meet in ``reconcile``."""
    spec.require(is_super=False)
    row_key, name, value = (F.get("fields", F.lit(i)) for i in range(3))
    shredded = _split(lines).select(
        "line",
        row_key.alias("row_key"),
        _no_super(),
        name.alias("name"),
        value.alias("value"),
        resolve_ts(None, load_ts).alias("ts"),
        F.when(value.isNull(), "missing_value")
        .when(row_key == "", "empty_key")
        .alias("line_reason"),
    )
    shredded, line_counts = _observe_lines(shredded, F.lit(False), count)
    shredded = shredded.withColumnRenamed("line_reason", "reason")
    return _result(shredded, spec, mode, line_counts)


def _split(lines: DataFrame, collapse_tabs: bool = False) -> DataFrame:
    value = F.col("value")
    return lines.select(
        value.alias("line"), split_fields(value, collapse_tabs).alias("fields")
    )


def _key_reason(key: Column) -> Column:
    """A line with no fields, or with nothing but an empty key, holds no cells and
    is no reject either."""
    size = F.size("fields")
    return F.when(key.isNull() & (size > 0), "missing_key").when(
        (key == "") & (size > 1), "empty_key"
    )


def _cut_after_bad_name(keyed: DataFrame) -> DataFrame:
    """Names sit at even positions from 2 on. Ends the fields after the first that
    is no long and its value, so that this one is still reported."""
    bad = F.transform(
        "fields",
        lambda x, i: (i >= 2) & (i % 2 == 0) & parse_long(x).isNull(),
    )
    bad_at = F.array_position(bad, F.lit(True)).cast("int")
    cut = F.when(
        F.col("bad_at") > 0, F.slice("fields", F.lit(1), F.col("bad_at") + 1)
    ).otherwise(F.col("fields"))
    return keyed.withColumn("bad_at", bad_at).withColumn("fields", cut).drop("bad_at")


def _json_lines(lines: DataFrame, parse) -> DataFrame:
    key, text = F.get("fields", F.lit(0)), F.get("fields", F.lit(1))
    checked = _split(lines).select(
        "line",
        key.alias("row_key"),
        parse(text).alias("parsed"),
        F.when(key.isNull(), "missing_key")
        .when(text.isNull(), "missing_json")
        .when(key == "", "empty_key")
        .alias("key_reason"),
    )
    return checked.select(
        "line",
        "row_key",
        last_entries(F.col("parsed")).alias("parsed"),
        F.coalesce(
            "key_reason", F.when(F.col("parsed").isNull(), "bad_json")
        ).alias("line_reason"),
    )


def _placeholder(element_type: str) -> Column:
    return F.array(F.lit(None).cast(element_type))


def _posexplode(fields: Column) -> Column:
    rejected = F.col("line_reason").isNotNull()
    return F.posexplode(
        F.when(rejected, _placeholder("string")).otherwise(fields)
    ).alias("at", "field")


def _explode_map(rejected: Column, m: str, value_type: str) -> Column:
    """Entries of a map. Exploding the map itself, with its keys made distinct
    beforehand, stays within generated code."""
    placeholder = F.create_map(F.lit(""), F.lit(None).cast(value_type))
    return F.explode(
        F.when(rejected.isNotNull(), placeholder).otherwise(F.col(m))
    ).alias("key", "entry")


def _no_super() -> Column:
    return F.lit(None).cast("string").alias("super")


def _canonical(name: Column, spec: FamilySpec) -> Column:
    """The name as stored; null when it should be a long and is not."""
    return parse_long(name).cast("string") if spec.long_names else name


def _observe_lines(
    keyed: DataFrame, bad_ts: Column, count: bool
) -> tuple[DataFrame, Observation | None]:
    if not count:
        return keyed, None
    seen = Observation()
    good = F.col("line_reason").isNull()
    return (
        keyed.observe(
            seen,
            F.count_if(good).alias("rows"),
            F.count_if(good & bad_ts).alias("bad_ts"),
        ),
        seen,
    )


def _result(
    shredded: DataFrame,
    spec: FamilySpec,
    mode: str,
    line_counts: Observation | None,
    parse_names: bool = True,
) -> LoadResult:
    """``parse_names`` is off where names come from the caller, not the data."""
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"mode must be 'permissive' or 'failfast', not {mode!r}")
    if spec.long_names and parse_names:
        # A generated column is parsed once; a projected one would be copied into the
        # filter on the reason and parsed there again.
        parsed = F.explode(F.array(_canonical(F.col("name"), spec)))
        shredded = shredded.select("*", parsed.alias("long_name"))
        shredded = shredded.withColumn(
            "reason",
            F.coalesce(
                "reason", F.when(F.col("long_name").isNull(), "bad_long_name")
            ),
        ).withColumn("name", F.coalesce("long_name", "name"))
    family = [F.lit(spec.keyspace).alias("keyspace"), F.lit(spec.cf).alias("cf")]

    counted, cell_counts = shredded, None
    if line_counts is not None:
        cell_counts = Observation()
        counted = shredded.observe(
            cell_counts,
            F.count_if(F.col("reason").isNull()).alias("columns"),
            F.count_if(F.col("reason").isNotNull()).alias("bad"),
        )
    good = F.col("reason").isNull()
    if mode == "failfast":
        message = F.concat(F.lit("bad record: "), F.col("reason"), F.lit(": "), F.col("line"))
        good = F.when(good, True).otherwise(F.raise_error(message).cast("boolean"))
    cells = counted.filter(good).select(
        *family, "row_key", "super", "name", "value", "ts"
    )
    rejects = shredded.filter(F.col("reason").isNotNull()).select(
        *family, "row_key", "super", "name", "reason", "line"
    )
    line = F.when(F.col("reason").isNotNull(), F.col("line")).alias("line")
    checked = shredded.select(
        *family, "row_key", "super", "name", "value", "ts", "reason", line
    )
    return LoadResult(cells, rejects, checked, line_counts, cell_counts)
