"""The registered queries: each operator over whole test tables.

A loader query renders a table as lines of the loader's layout, so that the lines
grow with the table. Defects (bad timestamps, names, keys) are planted by a rule on
the data and the SQL states the same rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import (
    FamilySpec,
    append_cells,
    append_stream,
    buckets_for,
    compact,
    discard,
    dump_column_names,
    dump_map,
    dump_super_map,
    dump_table,
    load_columns,
    load_key_value,
    load_map,
    load_super_map,
    load_super_pairs,
    load_table,
    map_pieces,
    map_prepare,
    merge_cells,
    name_pieces,
    open_base,
    prepared_pieces,
    read_lines,
    reconcile,
    scan_batches,
    scan_cells,
    scan_rejects,
    split_records,
    super_map_prepare,
    write_batch,
    write_lines,
    write_pieces,
)
from ..functions import bytes_to_long, long_to_bytes, tab_line
from .scratch import shared_folder

# 2024-01-04 00:00:00 UTC in microseconds, inside the range of event times.
LOAD_TS = 1_704_326_400_000_000

CUSTOMERS = FamilySpec("shop", "customers")
EVENTS = FamilySpec("web", "events")
EVENTS_LONG = FamilySpec("web", "events_long", long_names=True)
EVENTS_SUPER = FamilySpec("web", "events_super", is_super=True)
GRAPH = FamilySpec("shop", "graph")
GRAPH_LONG = FamilySpec("shop", "graph_long", long_names=True)
ORDERS_SUPER = FamilySpec("shop", "orders", is_super=True)
ORDERS_LONG = FamilySpec("shop", "orders_long", long_names=True, is_super=True)

STANDARD = ["keyspace", "cf", "row_key", "name", "value", "ts"]
SUPER = ["keyspace", "cf", "row_key", "super", "name", "value", "ts"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(df: DataFrame, *columns: Column | str) -> DataFrame:
    picked = [F.col(c) if isinstance(c, str) else c for c in columns]
    return df.select(tab_line(*picked).alias("value"))


def _epoch_us(ts: str) -> Column:
    """Microseconds of a timestamp without zone, whatever the session's zone."""
    since = f"(CAST({ts} AS TIMESTAMP_NTZ) - TIMESTAMP_NTZ'1970-01-01 00:00:00')"
    return F.expr(
        f"(extract(DAY FROM {since}) * 86400L + extract(HOUR FROM {since}) * 3600L"
        f" + extract(MINUTE FROM {since}) * 60L) * 1000000L"
        f" + CAST(extract(SECOND FROM {since}) * 1000000 AS BIGINT)"
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").withColumn("us", _epoch_us("ts"))


def _spoiled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines whose timestamp is no number for events of type ``error``."""
    us = F.when(F.col("event_type") == "error", "x").otherwise(F.col("us").cast("string"))
    return _lines(_events(spark, sf_dir), "event_id", "event_type", us)


def _customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(
        _table(spark, sf_dir, "customer"), "c_custkey", "c_name", "c_mktsegment"
    )


def _edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency lines from an order to the parts and suppliers of its items."""
    return _lines(
        _table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", "l_suppkey"
    )


def _spoiled_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjacency lines with long names in several spellings; the part of a fifth
    item is no number."""
    part = F.when(F.col("l_linenumber") == 5, F.concat(F.lit("p"), F.col("l_partkey")))
    part = part.otherwise(F.concat(F.lit("+00"), F.col("l_partkey")))
    return _lines(
        _table(spark, sf_dir, "lineitem"), "l_orderkey", part, -F.col("l_suppkey")
    )


def _latest_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells: a row per user, a column per event type, the event id as value."""
    text = {"row_key": "user_id", "name": "event_type", "value": "event_id"}
    return _events(spark, sf_dir).select(
        F.lit(EVENTS.keyspace).alias("keyspace"),
        F.lit(EVENTS.cf).alias("cf"),
        F.lit(None).cast("string").alias("super"),
        *[F.col(old).cast("string").alias(new) for new, old in text.items()],
        F.col("us").alias("ts"),
    )


def _super_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    quoted = F.concat(
        F.lit('{"'), "event_type", F.lit('":{"'), "event_id", F.lit('":"'), "us", F.lit('"}}')
    )
    lines = _lines(_events(spark, sf_dir), "user_id", quoted)
    return load_super_map(lines, EVENTS_SUPER, load_ts=LOAD_TS).cells


def _long_super_orders(spark: SparkSession, sf_dir: str):
    """A row per customer, a super per order, names 1 and 2, and a bad name."""
    quoted = F.concat(
        F.lit('{"'), "o_orderkey", F.lit('":{"01":"'), "o_orderstatus",
        F.lit('","2":"'), "o_orderpriority", F.lit('","q":"bad"}}'),
    )
    lines = _lines(_table(spark, sf_dir, "orders"), "o_custkey", quoted)
    return load_super_map(lines, ORDERS_LONG, load_ts=LOAD_TS)


def q_load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _customer_lines(spark, sf_dir)
    names = ["custkey", "name", "segment"]
    return load_table(lines, CUSTOMERS, names, load_ts=LOAD_TS).cells.select(STANDARD)


def q_load_table_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(_events(spark, sf_dir), "event_id", "event_type", "us", "user_id")
    names = ["event_id", "type", "at"]
    return load_table(lines, EVENTS, names, ts_field=2, load_ts=LOAD_TS).cells.select(
        STANDARD
    )


def q_load_table_bad_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _spoiled_events(spark, sf_dir)
    names = ["event_id", "type", "at"]
    return load_table(lines, EVENTS, names, ts_field=2, load_ts=LOAD_TS).cells.select(
        STANDARD
    )


def q_load_table_reject_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = load_table(
        _spoiled_events(spark, sf_dir),
        EVENTS,
        ["event_id", "type", "at"],
        ts_field=2,
        on_bad_ts="reject",
    )
    bad = F.col("reason").isNotNull()
    return result.checked.select(
        "row_key",
        F.when(bad, "").otherwise(F.col("name")).alias("name"),
        F.when(bad, F.col("line")).otherwise(F.col("value")).alias("value"),
        F.when(bad, F.lit(0)).otherwise(F.col("ts")).cast("bigint").alias("ts"),
        F.coalesce("reason", F.lit("")).alias("reason"),
    )


def q_load_table_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tabs between fields, and no key for customers of nation 3."""
    key = F.when(F.col("c_nationkey") == 3, "").otherwise(
        F.col("c_custkey").cast("string")
    )
    lines = _lines(
        _table(spark, sf_dir, "customer"),
        key, F.lit(""), "c_name", F.lit(""), "c_nationkey", "c_mktsegment",
    )
    return load_table(
        lines,
        CUSTOMERS,
        ["key", "-", "nation", "segment"],
        load_ts=LOAD_TS,
        skip_name="-",
        collapse_tabs=True,
        keep_key=True,
        drop_missing_key=True,
    ).cells.select(STANDARD)


def q_load_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _edge_lines(spark, sf_dir)
    return load_columns(lines, GRAPH, load_ts=LOAD_TS).cells.select(STANDARD)


def q_load_columns_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _spoiled_edges(spark, sf_dir)
    loaded = load_columns(lines, GRAPH_LONG, fill_value="1", load_ts=LOAD_TS)
    return reconcile(loaded.cells, GRAPH_LONG).select(STANDARD)


def q_load_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object per event with text, number, boolean, a repeat and a null."""
    quoted = F.concat(
        F.lit('{"type":"'), "event_type", F.lit('","user":-1,"ok":true,"rate":1.50,"user":'),
        "user_id", F.lit(',"gone":null}'),
    )
    lines = _lines(_events(spark, sf_dir), "event_id", quoted)
    return load_map(lines, EVENTS, load_ts=LOAD_TS).cells.select(STANDARD)


def q_load_map_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(_table(spark, sf_dir, "events"), "event_id", "props")
    return load_map(lines, EVENTS, load_ts=LOAD_TS).cells.select(STANDARD)


def q_load_map_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    quoted = F.concat(
        F.lit('{"0'), "event_id", F.lit('":"'), "event_type", F.lit('","x'),
        "event_id", F.lit('":"bad"}'),
    )
    lines = _lines(_table(spark, sf_dir, "events"), "user_id", quoted)
    return load_map(lines, EVENTS_LONG, load_ts=LOAD_TS).cells.select(STANDARD)


def q_load_super_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _super_events(spark, sf_dir).select(SUPER)


def q_load_super_map_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long_super_orders(spark, sf_dir).cells.select(SUPER)


def q_load_super_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(
        _table(spark, sf_dir, "orders"),
        "o_custkey", "o_orderkey", F.lit("status"), "o_orderstatus",
        F.lit("priority"), "o_orderpriority", F.lit("unpaired"),
    )
    return load_super_pairs(lines, ORDERS_SUPER, load_ts=LOAD_TS).cells.select(SUPER)


def q_load_super_pairs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name between the two pairs is bad for open orders, which ends them."""
    middle = F.when(F.col("o_orderstatus") == "O", "x").otherwise("7")
    lines = _lines(
        _table(spark, sf_dir, "orders"),
        "o_custkey", "o_orderkey", F.lit("1"), "o_orderstatus",
        middle, F.lit("m"), F.lit("2"), "o_orderpriority",
    )
    return load_super_pairs(
        lines, ORDERS_LONG, load_ts=LOAD_TS, stop_at_bad_name=True
    ).cells.select(SUPER)


def q_load_key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(
        _table(spark, sf_dir, "events"), "user_id", "event_type", "event_id", "props"
    )
    cells = load_key_value(lines, EVENTS, load_ts=LOAD_TS).cells
    return reconcile(cells, EVENTS).select(STANDARD)


def q_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a dry run."""
    result = load_columns(_spoiled_edges(spark, sf_dir), GRAPH_LONG, count=True)
    discard(result.cells)
    counts = result.counters()
    return spark.range(1).select(
        F.lit(counts["rows"]).cast("bigint").alias("loaded_rows"),
        F.lit(counts["columns"]).cast("bigint").alias("loaded_columns"),
        F.lit(counts["bad"]).cast("bigint").alias("bad_columns"),
    )


def q_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON lines: no key for high priority, no object when open (neither
    leaves a line without fields), a broken one when finished."""
    key = F.when(F.col("o_orderpriority") == "2-HIGH", "").otherwise(
        F.col("o_orderkey").cast("string")
    )
    text = (
        F.when(F.col("o_orderstatus") == "O", "")
        .when(F.col("o_orderstatus") == "F", '{"a":')
        .otherwise('{"a":"1","b":null}')
    )
    lines = _lines(_table(spark, sf_dir, "orders"), key, text)
    return load_map(lines, CUSTOMERS).rejects.select(
        F.coalesce("row_key", F.lit("")).alias("row_key"), "reason", "line"
    )


def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile(_latest_by_type(spark, sf_dir)).select(STANDARD)


def q_merge_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that write the same rows and names: events at their own times,
    customers at a time among those."""
    events = load_table(
        _lines(_events(spark, sf_dir), "user_id", "event_type", "us"),
        EVENTS,
        ["key", "label", "at"],
        ts_field=2,
    )
    customers = load_table(
        _lines(_table(spark, sf_dir, "customer"), "c_custkey", "c_mktsegment", "c_name"),
        EVENTS,
        ["key", "label", "who"],
        load_ts=LOAD_TS,
    )
    return merge_cells(events.cells, customers.cells, spec=EVENTS).select(STANDARD)


def q_dump_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["view", "click", "absent", "purchase"]
    return dump_table(_latest_by_type(spark, sf_dir), EVENTS, names)


def q_dump_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = load_columns(_edge_lines(spark, sf_dir), GRAPH, load_ts=LOAD_TS).cells
    return dump_column_names(cells, GRAPH)


def q_dump_column_names_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _spoiled_edges(spark, sf_dir)
    cells = load_columns(lines, GRAPH_LONG, load_ts=LOAD_TS).cells
    return dump_column_names(cells, GRAPH_LONG)


def q_dump_column_names_super(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dump_column_names(_super_events(spark, sf_dir), EVENTS_SUPER)


def q_dump_super_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dump_super_map(_super_events(spark, sf_dir), EVENTS_SUPER)


def q_dump_super_map_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dump_super_map(_long_super_orders(spark, sf_dir).cells, ORDERS_LONG)


def q_dump_super_map_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _long_super_orders(spark, sf_dir).cells
    return dump_super_map(cells, ORDERS_LONG, max_super=3)


def q_dump_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dump_map(_latest_by_type(spark, sf_dir), EVENTS)


def q_map_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records come as lines, and a repeated name keeps its greatest value."""
    lines = _lines(_table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")
    records, _ = split_records(lines, "row_key", "name", "value")
    return map_prepare(records)


def q_map_prepare_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return map_prepare(events, "user_id", "event_type", "event_id", order="ts")


def q_super_map_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return super_map_prepare(
        orders, "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderkey",
        order="o_orderkey",
    )


def q_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended loads, read back by family and name."""
    path = shared_folder(spark)
    append_cells(_latest_by_type(spark, sf_dir), path)
    append_cells(load_columns(_edge_lines(spark, sf_dir), GRAPH).cells, path)
    cells = scan_cells(spark, path, EVENTS, names=["click", "view"])
    return reconcile(cells).select(STANDARD)


def q_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compacted table, dumped without reconciling again."""
    path, compacted = shared_folder(spark), shared_folder(spark)
    append_cells(_latest_by_type(spark, sf_dir), path)
    compact(spark, path, compacted)
    cells = scan_cells(spark, compacted, EVENTS)
    return dump_map(cells, EVENTS, reconciled=True)


def q_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written, read back and loaded."""
    path = shared_folder(spark)
    write_lines(_customer_lines(spark, sf_dir), path)
    names = ["custkey", "name", "segment"]
    return load_table(
        read_lines(spark, path), CUSTOMERS, names, load_ts=LOAD_TS
    ).cells.select(STANDARD)


def q_reload_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names dumped as three lines a row, loaded again."""
    cells = load_columns(_edge_lines(spark, sf_dir), GRAPH, load_ts=LOAD_TS).cells
    dumped = dump_column_names(cells, GRAPH, pieces=3)
    return load_columns(dumped, GRAPH, load_ts=LOAD_TS).cells.select(STANDARD)


def q_reload_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    dumped = dump_map(_latest_by_type(spark, sf_dir), EVENTS, pieces=3)
    return load_map(dumped, EVENTS, load_ts=LOAD_TS).cells.select(STANDARD)


def q_reload_super_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Super cells, empty ones among them, dumped, prepared as split JSON lines and
    loaded again."""
    empty = F.when(F.col("super") == "click", "").otherwise(F.col("value"))
    cells = _super_events(spark, sf_dir).withColumn("value", empty)
    dumped = dump_super_map(cells, EVENTS_SUPER)
    records, _ = split_records(dumped, "row_key", "super", "name", "value")
    prepared = super_map_prepare(records, pieces=3)
    lines = _lines(prepared, "row_key", "json")
    return load_super_map(lines, EVENTS_SUPER, load_ts=LOAD_TS).cells.select(SUPER)


def q_overwrite_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written over others at the same path."""
    path = shared_folder(spark)
    write_lines(_edge_lines(spark, sf_dir), path)
    write_lines(_customer_lines(spark, sf_dir), path, overwrite=True)
    return read_lines(spark, path)


def q_load_table_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load at the current time: cells, and whether that lies around now."""
    names = ["custkey", "name", "segment"]
    cells = load_table(_customer_lines(spark, sf_dir), CUSTOMERS, names).cells
    now = F.unix_micros(F.current_timestamp())
    recent = (F.col("ts") <= now) & (F.col("ts") > now - 3_600_000_000)
    return cells.select("row_key", "name", "value", recent.alias("recent"))


def q_bad_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer lines with a byte that is no UTF-8 before the segment, written as they
    are and loaded."""
    path = shared_folder(spark)
    start = F.concat(F.col("c_custkey").cast("string"), F.lit("\t")).cast("binary")
    line = F.concat(start, F.unhex(F.lit("FF")), F.col("c_mktsegment").cast("binary"))
    customers = _table(spark, sf_dir, "customer").select(line.cast("string").alias("value"))
    write_lines(customers, path)
    cells = load_table(
        read_lines(spark, path), CUSTOMERS, ["custkey", "segment"], load_ts=LOAD_TS
    ).cells
    return cells.select(STANDARD)


def q_record_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of four fields, the value empty for type view; those of type click lack
    it and are rejected."""
    value = F.when(F.col("event_type") == "view", "").otherwise(
        F.col("event_id").cast("string")
    )
    full = tab_line(F.col("user_id"), F.col("event_type"), F.col("us"), value)
    short = tab_line(F.col("user_id"), F.col("event_type"), F.col("us"))
    line = F.when(F.col("event_type") == "click", short).otherwise(full)
    lines = _events(spark, sf_dir).select(line.alias("value"))
    records, rejects = split_records(lines, "row_key", "super", "name", "value")
    good = records.select(tab_line(*map(F.col, records.columns)).alias("line"))
    return good.select(F.lit("").alias("reason"), "line").unionByName(rejects)


def q_dump_table_many_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More names than a row has columns."""
    names = ["view", "click", "purchase", *(f"absent{i}" for i in range(97))]
    return dump_table(_latest_by_type(spark, sf_dir), EVENTS, names)


def q_long_name_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long names as stored bytes and back."""
    name = -F.col("l_partkey")
    raw = long_to_bytes(name)
    return _table(spark, sf_dir, "lineitem").select(
        name.alias("name"), F.hex(raw).alias("bytes"), bytes_to_long(raw).alias("back")
    )


BUCKETS = 16  # of the bases below at least


def _event_batches(spark: SparkSession, sf_dir: str) -> str:
    """Event lines in three batches: half of all, and the other half before and after a
    time. Users are rows, so later batches write some cells of earlier ones again."""
    path = shared_folder(spark)
    events = _events(spark, sf_dir)
    first = F.col("event_id") % 2 == 0
    second = ~first & (F.col("us") < LOAD_TS)
    for batch, part in (
        ("2024-01-01", first), ("2024-01-02", second), ("2024-01-03", ~first & ~second),
    ):
        lines = _lines(events.filter(part), "user_id", "event_type", "event_id", "us")
        names = ["user_id", "type", "event_id", "at"]
        write_batch(load_table(lines, EVENTS, names, ts_field=3), path, batch)
    return path


def _new_base(spark: SparkSession, cells: DataFrame):
    """An empty base for so many cells."""
    return open_base(spark, shared_folder(spark), buckets_for(cells, BUCKETS))


def q_base_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base made of the first batch, with two more merged into it."""
    batches = _event_batches(spark, sf_dir)
    base = _new_base(spark, scan_batches(spark, batches))
    for batch in ("2024-01-01", "2024-01-02", "2024-01-03"):
        base.merge(scan_batches(spark, batches, first=batch, last=batch))
    return base.scan(EVENTS).select(STANDARD)


def q_base_with_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base of the first batch and the batches after it, dumped without merging."""
    batches = _event_batches(spark, sf_dir)
    base = _new_base(spark, scan_batches(spark, batches))
    base.merge(scan_batches(spark, batches, last="2024-01-01"))
    cells = base.with_deltas(scan_batches(spark, batches, first="2024-01-02"), EVENTS)
    return dump_table(cells, EVENTS, ["type", "event_id"], reconciled=True)


def _event_base(spark: SparkSession, sf_dir: str, cells: DataFrame):
    base = _new_base(spark, cells)
    base.merge(cells)
    return base


def q_base_dump_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base dumped without a shuffle."""
    base = _event_base(spark, sf_dir, _latest_by_type(spark, sf_dir))
    return dump_map(base.scan(EVENTS), EVENTS, reconciled=True, bucketed=True)


def q_base_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = load_columns(_edge_lines(spark, sf_dir), GRAPH, load_ts=LOAD_TS).cells
    base = _event_base(spark, sf_dir, cells)
    return dump_column_names(base.scan(GRAPH), GRAPH, reconciled=True, bucketed=True)


def q_base_super_map_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _event_base(spark, sf_dir, _long_super_orders(spark, sf_dir).cells)
    cells = base.scan(ORDERS_LONG)
    return dump_super_map(cells, ORDERS_LONG, max_super=3, reconciled=True)


def q_batch_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells and rejects of one load, written in one pass; the batch is written twice."""
    path = shared_folder(spark)
    for _ in range(2):
        write_batch(_long_super_orders(spark, sf_dir), path, "a")
    cells = scan_batches(spark, path, ORDERS_LONG).select(
        "row_key", "super", "name", "value", F.lit("").alias("reason")
    )
    rejects = scan_rejects(spark, path).select(
        "row_key", "super", "name", F.lit("").alias("value"), "reason"
    )
    return cells.unionByName(rejects)


def q_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a load written as a batch."""
    load = load_columns(_spoiled_edges(spark, sf_dir), GRAPH_LONG, count=True)
    counts = write_batch(load, shared_folder(spark), "a")
    return spark.range(1).select(
        F.lit(counts["rows"]).cast("bigint").alias("loaded_rows"),
        F.lit(counts["columns"]).cast("bigint").alias("loaded_columns"),
        F.lit(counts["bad"]).cast("bigint").alias("bad_columns"),
    )


def q_compact_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table laid out by name, read by a few names."""
    path, compacted = shared_folder(spark), shared_folder(spark)
    append_cells(load_columns(_edge_lines(spark, sf_dir), GRAPH, load_ts=LOAD_TS).cells, path)
    compact(spark, path, compacted, by_name=True)
    return scan_cells(spark, compacted, GRAPH, names=["1", "7", "10"]).select(STANDARD)


def _written(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    path = shared_folder(spark)
    write_pieces(pieces, path)
    return read_lines(spark, path)


def q_name_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names written piece by piece."""
    cells = load_columns(_edge_lines(spark, sf_dir), GRAPH, load_ts=LOAD_TS).cells
    return _written(spark, name_pieces(cells, GRAPH))


def q_map_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, map_pieces(_latest_by_type(spark, sf_dir), EVENTS))


def q_prepared_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    named = ["user_id", "event_type", "event_id"]
    return _written(spark, prepared_pieces(events, *named, order="ts"))


def q_prepared_super_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Super maps written piece by piece, and loaded."""
    orders = _table(spark, sf_dir, "orders")
    pieces = prepared_pieces(
        orders, "o_custkey", "o_orderpriority", "o_orderkey", super="o_orderstatus",
        order="o_orderkey",
    )
    lines = _written(spark, pieces)
    return load_super_map(lines, ORDERS_SUPER, load_ts=LOAD_TS).cells.select(SUPER)


def q_load_super_map_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in a map of maps keep their spelling, beside text that looks like one."""
    quoted = F.concat(
        F.lit('{"s":{"price":'), F.format_string("%.2f", "l_extendedprice"),
        F.lit(', "power" : -1e3,"zero":0.50,"key":'), "l_partkey",
        F.lit(',"text":"a\\":7,\\\\"},"t":{"flag":true}}'),
    )
    line = F.concat_ws("-", "l_orderkey", "l_linenumber")
    lines = _lines(_table(spark, sf_dir, "lineitem"), line, quoted)
    return load_super_map(lines, ORDERS_SUPER, load_ts=LOAD_TS).cells.select(SUPER)


def q_append_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines streamed into a cell table in two runs, the second for a later file."""
    source, path, checkpoint = (shared_folder(spark) for _ in range(3))
    for part in (0, 1):
        events = _events(spark, sf_dir).filter(F.col("event_id") % 2 == part)
        lines = _lines(events, "user_id", "event_type", "event_id", "us")
        lines.write.mode("append").text(source)
        names = ["user_id", "type", "event_id", "at"]
        load = load_table(spark.readStream.text(source), EVENTS, names, ts_field=3)
        append_stream(load.cells, path, checkpoint).awaitTermination()
    return reconcile(scan_cells(spark, path, EVENTS), EVENTS).select(STANDARD)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event lines loaded at their own times, reconciled and dumped: the last type
    and id of every user."""
    lines = _lines(_events(spark, sf_dir), "user_id", "event_type", "event_id", "us")
    names = ["user_id", "type", "event_id", "at"]
    loaded = load_table(lines, EVENTS, names, ts_field=3)
    return dump_table(loaded.cells, EVENTS, ["type", "event_id"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {
        name[2:]: query for name, query in globals().items() if name.startswith("q_")
    }
    return {"load_dump_table": flagship, **named}
