"""Text files and the stored cell table."""

import pytest
from pyspark.sql import functions as F

from widerow import (
    FamilySpec,
    append_cells,
    compact,
    dump_map,
    dump_table,
    load_columns,
    load_table,
    read_lines,
    reconcile,
    scan_cells,
    write_lines,
)

STD = FamilySpec()


def kept(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_lines_round_trip(spark, lines, tmp_path):
    path = str(tmp_path / "out")
    write_lines(lines("a\tb", "", "c"), path)
    assert kept(read_lines(spark, path), "value") == [("",), ("a\tb",), ("c",)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_lines(lines("x"), path)
    write_lines(lines("x"), path, overwrite=True)
    assert kept(read_lines(spark, path), "value") == [("x",)]


def test_line_ends_and_bad_bytes(spark, tmp_path):
    (tmp_path / "raw.tsv").write_bytes(b"k1\ta\xff\r\nk2\tb\rk3\tc\n")
    assert kept(read_lines(spark, str(tmp_path / "*.tsv")), "value") == [
        ("k1\ta�",), ("k2\tb",), ("k3\tc",),
    ]


def test_append_scan_compact(spark, lines, tmp_path):
    path, new = str(tmp_path / "cells"), str(tmp_path / "compacted")
    numbers = FamilySpec("123", "456", long_names=True)
    append_cells(load_table(lines("u1\told\tx"), STD, ["k", "a", "b"], load_ts=1).cells, path)
    append_cells(load_table(lines("u1\tnew"), STD, ["k", "a"], load_ts=2).cells, path)
    append_cells(load_columns(lines("n\t7\t8"), numbers, load_ts=3).cells, path)
    assert scan_cells(spark, path).count() == 5
    expected = [("u1", "a", "new", 2), ("u1", "b", "x", 1)]
    columns = ["row_key", "name", "value", "ts"]
    assert kept(reconcile(scan_cells(spark, path, STD)), *columns) == expected
    assert kept(reconcile(scan_cells(spark, path, STD, names=["b"])), *columns) == expected[1:]
    assert kept(scan_cells(spark, path, numbers, names=["+07"]), "keyspace", "cf", "name") == [
        ("123", "456", "7")
    ]
    compact(spark, path, new)
    assert kept(scan_cells(spark, new, STD), *columns) == expected
    assert kept(dump_map(scan_cells(spark, new, STD), STD, reconciled=True), "value") == [
        ('u1\t{"a":"new","b":"x"}',)
    ]
    assert scan_cells(spark, path).count() == 5
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        compact(spark, path, new)


def test_family_and_names_reach_the_scan(spark, lines, tmp_path):
    path = str(tmp_path / "cells")
    append_cells(load_table(lines("u1\ta\tb"), STD, ["k", "a", "b"], load_ts=1).cells, path)
    for df in (
        reconcile(scan_cells(spark, path, STD, names=["a"])),
        dump_table(scan_cells(spark, path), STD, ["a"]),
        reconcile(scan_cells(spark, path)).filter(STD.matches() & F.col("name").isin("a")),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan" in line)
        assert "EqualTo(name,a)" in scan or "In(name" in scan
        assert "(keyspace" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_loaders_take_a_stream(spark, lines, tmp_path):
    """Loaders are row-local, so a stream of lines may feed the cell table."""
    source, path = str(tmp_path / "in"), str(tmp_path / "cells")
    write_lines(lines("n1\t2\t3", "n2\t4"), source)
    stream = spark.readStream.text(source)
    query = (
        load_columns(stream, STD, load_ts=1)
        .cells.writeStream.partitionBy("keyspace", "cf")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(path, format="parquet")
    )
    query.awaitTermination()
    assert kept(scan_cells(spark, path, STD), "row_key", "name") == [
        ("n1", "2"), ("n1", "3"), ("n2", "4"),
    ]
