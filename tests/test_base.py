"""Bases, batches, streams and layouts by name: plans, files, failures."""

import os
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from widerow import (
    CELL_SCHEMA,
    FamilySpec,
    append_cells,
    append_stream,
    buckets_for,
    compact,
    dump_column_names,
    dump_map,
    dump_super_map,
    dump_table,
    load_columns,
    load_table,
    map_pieces,
    merge_cells,
    name_pieces,
    open_base,
    prepared_pieces,
    read_lines,
    reconcile,
    scan_batches,
    scan_cells,
    scan_rejects,
    write_batch,
    write_lines,
    write_pieces,
)

from widerow.plans import queries as plan_queries
from widerow.sources import base as sources_base

STD = FamilySpec()
SUP = FamilySpec(cf="Super1", is_super=True)
ROOT = str(Path(__file__).resolve().parents[1])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def text(df):
    return sorted(r.value for r in df.collect())


def kept(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or CELL_SCHEMA.names)).collect())


def some(spark, n, rows, at=0, cf="Standard1"):
    ids = spark.range(n)
    supers = F.lit(None) if cf == "Standard1" else F.concat(F.lit("s"), F.col("id") % 5)
    return ids.select(
        F.lit("Keyspace1").alias("keyspace"),
        F.lit(cf).alias("cf"),
        F.concat(F.lit("r"), F.col("id") % rows).alias("row_key"),
        supers.cast("string").alias("super"),
        F.concat(F.lit("n"), F.col("id") % 11).alias("name"),
        F.concat(F.lit("v"), F.col("id") + at).alias("value"),
        (F.col("id") + at).alias("ts"),
    )


def files(path):
    found = Path(path.removeprefix("file:")).rglob("part-*.parquet")
    return {str(f): f.stat().st_size for f in found}


@pytest.fixture
def base(spark, tmp_path):
    base = open_base(spark, str(tmp_path / "base"), 8)
    base.merge(some(spark, 400, 60).unionByName(some(spark, 300, 40, cf="Super1")))
    return base


def test_base_reads_without_a_shuffle(spark, base):
    cells, supers = base.scan(STD), base.scan(SUP)
    done = {"reconciled": True}
    plans = [
        dump_map(cells, STD, bucketed=True, **done),
        dump_column_names(cells, STD, bucketed=True, **done),
        dump_column_names(supers, SUP, bucketed=True, **done),
        dump_table(cells, STD, ["n1", "n2"], **done),
        dump_super_map(supers, SUP, max_super=2, **done),
        dump_super_map(supers, SUP, max_super=2),
        reconcile(cells, STD),
        reconcile(base.scan()),
        name_pieces(cells, STD, reconciled=True),
        map_pieces(cells, STD, reconciled=True),
    ]
    plain = reconcile(some(spark, 400, 60), STD)
    for df in plans:
        assert "Exchange" not in plan(df)
    assert text(plans[0]) == text(dump_map(plain, STD))
    assert text(plans[1]) == text(dump_column_names(plain, STD))
    assert "In(name" in plan(base.scan(STD, ["n1", "n2"]))


def test_deltas_alone_are_shuffled(spark, base):
    deltas = some(spark, 50, 7, at=1000)
    now = base.with_deltas(deltas, STD)
    assert plan(now).count("Exchange") == 1
    both = merge_cells(some(spark, 400, 60), deltas, spec=STD)
    assert kept(now) == kept(both)
    dumped = dump_map(now, STD, reconciled=True, bucketed=True)
    assert plan(dumped).count("Exchange") == 1
    assert text(dumped) == text(dump_map(both, STD))


def test_merge_rewrites_touched_buckets(spark, base):
    before = files(base.path)
    deltas = some(spark, 3, 2, at=1000).unionByName(some(spark, 1, 1, at=1000, cf="New"))
    rows = {r[0] for r in deltas.select("row_key").collect()}
    assert len(rows) == 2
    assert base.merge(deltas) <= 3
    after = files(base.path)
    changed = set(before) - set(after)
    assert 1 <= len(changed) <= 2 and len(after) == len(before) + 1
    assert sum(before[f] for f in changed) < 0.3 * sum(before.values())
    whole = some(spark, 400, 60).unionByName(some(spark, 300, 40, cf="Super1"))
    assert kept(base.scan()) == kept(merge_cells(whole, deltas))
    same = files(base.path)
    assert base.merge(deltas.limit(0)) == 0 and files(base.path) == same
    again = kept(base.scan())
    base.merge(deltas)
    assert kept(base.scan()) == again
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_an_opened_base_is_the_same(spark, base, tmp_path):
    spark.sql(f"DROP TABLE {base.table}")  # as in a new session
    assert kept(open_base(spark, base.path).scan()) == kept(
        reconcile(some(spark, 400, 60).unionByName(some(spark, 300, 40, cf="Super1")))
    )
    assert open_base(spark, base.path).buckets == 8
    with pytest.raises(ValueError, match="has 8 buckets"):
        open_base(spark, base.path, 9)
    with pytest.raises(ValueError, match="no base"):
        open_base(spark, str(tmp_path / "none"))


def test_a_relative_path(spark, tmp_path):
    """Readers and the table mean the same folder."""
    here = os.path.relpath(tmp_path / "base")
    open_base(spark, here, 2).merge(some(spark, 20, 5))
    assert open_base(spark, str(tmp_path / "base")).scan().count() == 20
    assert files(str(tmp_path / "base"))


def test_nulls_and_odd_names_in_a_base(spark, base):
    odd = spark.createDataFrame(
        [("k'1", "c=f", None, None, "a", "1", 1), ("k'1", "c=f", "", None, None, None, None)],
        CELL_SCHEMA,
    )
    base.merge(odd)
    found = base.scan(FamilySpec("k'1", "c=f"))
    rows = [tuple(r) for r in found.select("row_key", "name", "value", "ts").collect()]
    assert sorted(rows, key=str) == [("", None, None, None), (None, "a", "1", 1)]


def test_batch_holds_cells_and_rejects(spark, lines, tmp_path):
    path = str(tmp_path / "batches")
    longs = FamilySpec("k", "c", long_names=True)
    load = load_columns(lines("r\t1\tx\t2", "\ty", "q\t3"), longs, load_ts=5, count=True)
    counts = {"rows": 2, "bad_ts": 0, "columns": 3, "bad": 2}
    assert write_batch(load, path, "2") == counts
    later = load_columns(lines("r\t1", "r\t4"), longs, load_ts=6, count=True)
    assert write_batch(later, path, "10")["columns"] == 2
    again = load_columns(lines("r\t1\tx\t2", "\ty", "q\t3"), longs, load_ts=5, count=True)
    assert write_batch(again, path, "2") == counts
    assert kept(scan_batches(spark, path, longs, last="10"), "row_key", "name", "ts") == [
        ("r", "1", 6), ("r", "4", 6),
    ]
    assert scan_batches(spark, path).count() == 5
    assert kept(scan_rejects(spark, path), "reason", "line") == [
        ("bad_long_name", "r\t1\tx\t2"), ("empty_key", "\ty"),
    ]
    assert scan_batches(spark, path, FamilySpec("k", "other")).count() == 0
    for name in ("", "a/b"):
        with pytest.raises(ValueError):
            write_batch(load, path, name)
    whole = load_table(lines("a\tb"), STD, ["k", "n"])
    assert write_batch(whole, path, "3") == {"columns": 1, "bad": 0}


def test_a_batch_reads_its_input_once(spark, lines, tmp_path):
    write_lines(lines("r\t1\tx", "\ty"), str(tmp_path / "in"))
    load = load_columns(read_lines(spark, str(tmp_path / "in")), STD, load_ts=1)
    assert plan(load.checked).count("FileScan") == 1


def test_counters_after_a_task_that_failed(tmp_path):
    """A task that fails halfway and runs again neither loses nor doubles anything."""
    script = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark import TaskContext
        from pyspark.sql import SparkSession, functions as F
        from widerow import *
        spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
                 .config("spark.sql.execution.arrow.maxRecordsPerBatch", "10").getOrCreate())
        spark.sparkContext.setLogLevel("OFF")
        def flaky(batches):
            for n, batch in enumerate(batches):
                if n == 5 and TaskContext.get().attemptNumber() < 2:
                    raise RuntimeError("lost")
                yield batch
        lines = spark.range(0, 400, 1, 4).selectExpr(
            "concat_ws('\\t', if(id % 10 = 0, '', concat('r', id)), id, id + 1) AS value")
        lines = lines.mapInArrow(flaky, "value string")
        load = load_columns(lines, FamilySpec(), count=True)
        counts = write_batch(load, {str(tmp_path / "out")!r}, "a")
        cells = scan_batches(spark, {str(tmp_path / "out")!r})
        print("GOT", counts, cells.count(), cells.select("row_key", "name").distinct().count())
    """
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(script)],
        capture_output=True, text=True, timeout=240, env=os.environ,
    )
    assert "GOT {'rows': 360, 'bad_ts': 0, 'columns': 720, 'bad': 40} 720 720" in done.stdout, (
        done.stderr[-2000:]
    )


def test_a_replayed_stream_batch_leaves_one_result(spark, lines, tmp_path):
    source, path, checkpoint = (str(tmp_path / x) for x in ("in", "cells", "checkpoint"))

    def run():
        load = load_columns(spark.readStream.text(source), STD, load_ts=1)
        append_stream(load.cells, path, checkpoint).awaitTermination()

    write_lines(lines("n1\t2\t3"), source)
    run()
    lines("n2\t4").write.mode("append").text(source)
    run()
    expected = [("n1", "2"), ("n1", "3"), ("n2", "4")]
    assert kept(scan_cells(spark, path, STD), "row_key", "name") == expected
    # As if the driver had died after the sink's commit, before its own.
    commits = Path(checkpoint) / "commits"
    for f in (commits / "1", commits / ".1.crc"):
        f.unlink()
    run()
    assert kept(scan_cells(spark, path, STD), "row_key", "name") == expected


def rows_read(df):
    """The rows of the row groups that a scan reads."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    found, open_ = 0, [query.executedPlan()]
    while open_:
        node = open_.pop()
        if "Scan" in node.nodeName():
            found += node.metrics().apply("numOutputRows").value()
        open_ += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_names_skip_row_groups(spark, tmp_path):
    """Of a table by name a scan for one name reads few row groups, of one by row all."""
    rows, names = 500, 400
    cells = spark.range(rows * names).select(
        F.lit("Keyspace1").alias("keyspace"), F.lit("Standard1").alias("cf"),
        F.concat(F.lit("r"), F.col("id") % rows).alias("row_key"),
        F.lit(None).cast("string").alias("super"),
        F.format_string("n%03d", (F.col("id") / rows).cast("int")).alias("name"),
        F.concat(F.lit("v"), "id").alias("value"), F.lit(1).cast("long").alias("ts"),
    )
    append_cells(cells, str(tmp_path / "cells"))
    found = {}
    for by_name in (False, True):
        path = str(tmp_path / f"compacted{by_name}")
        compact(spark, str(tmp_path / "cells"), path, by_name=by_name)
        scan = scan_cells(spark, path, STD, names=["n123"])
        assert scan.count() == rows
        found[by_name] = rows_read(scan_cells(spark, path, STD, names=["n123"]))
        absent = scan_cells(spark, path, STD, names=["n123x"])
        if by_name:  # between two names: only the Bloom filter can tell
            assert rows_read(absent) == 0
    assert found[True] <= found[False] / 4


def written(spark, pieces, path):
    write_pieces(pieces, path)
    return text(read_lines(spark, path))


def test_pieces_are_the_lines_of_dumps(spark, tmp_path):
    longs = FamilySpec(long_names=True)
    cells = some(spark, 500, 70)
    numbered = cells.withColumn("name", F.substring("name", 2, 9))
    for spec, given in ((STD, cells), (longs, numbered)):
        path = str(tmp_path / f"names{spec.long_names}")
        assert written(spark, name_pieces(given, spec), path) == text(dump_column_names(given, spec))
        path = str(tmp_path / f"maps{spec.long_names}")
        spaced = [x.replace('","', '", "') + " " for x in text(dump_map(given, spec))]
        assert written(spark, map_pieces(given, spec), path) == spaced
    supers = some(spark, 300, 40, cf="Super1")
    assert written(spark, name_pieces(supers, SUP), str(tmp_path / "s")) == text(
        dump_column_names(supers, SUP)
    )
    one = cells.filter("row_key = 'r1' AND name = 'n1'")
    assert written(spark, name_pieces(one, STD), str(tmp_path / "one")) == ["r1\tn1\t"]
    assert written(spark, map_pieces(cells.limit(0), STD), str(tmp_path / "none")) == []


def test_super_pieces(spark, lines, tmp_path):
    records = spark.createDataFrame(
        [("r", "t", "b", "2"), ("r", "s", "a", "1"), ("r", "s", "A", '0"'), ("q", "s", "a", "")],
        "row_key string, super string, name string, value string",
    )
    assert written(spark, prepared_pieces(records, super="super"), str(tmp_path / "out")) == [
        'q\t{"s":{"a":""}} ', 'r\t{"s":{"A":"0\\"", "a":"1"}, "t":{"b":"2"}} ',
    ]


def test_pieces_hold_no_row(spark):
    """No collecting, and one shuffle."""
    cells = some(spark, 500, 70)
    for pieces in (name_pieces(cells, STD, True), map_pieces(cells, STD, True)):
        assert "collect" not in plan(pieces) and plan(pieces).count("Exchange") == 1


def test_a_row_larger_than_the_heap_is_one_line(tmp_path):
    script = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession, functions as F
        from widerow import *
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.driver.memory", "512m").config("spark.local.dir", {str(tmp_path)!r})
                 .config("spark.sql.shuffle.partitions", "4").getOrCreate())
        spark.sparkContext.setLogLevel("OFF")
        name = "concat(lpad(cast(id AS string), 10, '0'), repeat(sha2(cast(id AS string), 512), 8))"
        cells = spark.range(0, 600_000, 1, 8).selectExpr(
            "'Keyspace1' AS keyspace", "'Standard1' AS cf", "'hot' AS row_key",
            "cast(null AS string) AS super", f"substr({{name}}, 1, 1000) AS name", "'1' AS value",
            "1L AS ts")
        write_pieces(name_pieces(cells, FamilySpec(), reconciled=True), {str(tmp_path / "out")!r})
    """
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=280
    )
    assert done.returncode == 0, done.stderr[-2000:]
    (out,) = (tmp_path / "out").glob("part-*")
    assert out.stat().st_size == len("hot\t") + 600_000 * 1001
    with out.open("rb") as f:
        assert f.read(14) == b"hot\t0000000000"
        assert not any(b"\n" in block for block in iter(lambda: f.read(1 << 24), b""))


def test_buckets_follow_the_size_of_the_cells(spark, monkeypatch):
    cells = some(spark, 2000, 100)
    monkeypatch.setattr(sources_base, "BUCKET_BYTES", 100_000)
    n, more = buckets_for(cells), buckets_for(cells.union(cells).union(cells))
    assert 2000 * 128 / 100_000 < n < 10 and 3 * n - 3 < more <= 3 * n
    assert buckets_for(cells, least=50) == 50 and buckets_for(cells.limit(0)) == 1
    unknown = cells.withColumn("value", F.lit(None).cast("string"))
    assert 2 < buckets_for(unknown) <= n


@pytest.mark.parametrize("name", ["base_column_names", "base_dump_map", "base_merge",
                                  "base_super_map_first", "base_with_deltas"])
def test_bases_of_queries_have_buckets_for_their_tables(spark, tmp_path, monkeypatch, name):
    items = spark.range(600).selectExpr(
        "id % 90 AS l_orderkey", "id % 40 AS l_partkey", "id % 7 AS l_suppkey")
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(600).selectExpr(
        "id AS event_id", "id % 50 AS user_id", "concat('t', id % 3) AS event_type",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS ts",
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(600).selectExpr(
        "id AS o_orderkey", "id % 30 AS o_custkey", "'1-URGENT' AS o_orderpriority",
        "'O' AS o_orderstatus", "CAST(id AS DOUBLE) AS o_totalprice",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    made = []

    def opened(*args):
        made.append(open_base(*args))
        return made[-1]

    monkeypatch.setattr(plan_queries, "open_base", opened)
    run = plan_queries.queries()[name]
    before = sorted(map(tuple, run(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(sources_base, "BUCKET_BYTES", 2000)
    after = sorted(map(tuple, run(spark, str(tmp_path)).collect()))
    assert before == after and before
    assert made[0].buckets == plan_queries.BUCKETS < made[1].buckets
