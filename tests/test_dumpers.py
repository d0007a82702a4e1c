"""Reconciliation, dumpers and the prepare steps: FIXTURES.md A6, A7."""

import itertools

import pytest
from pyspark.sql import functions as F

from widerow import (
    CELL_SCHEMA,
    FamilySpec,
    append_cells,
    dump_column_names,
    dump_map,
    dump_super_map,
    dump_table,
    load_columns,
    load_map,
    load_super_map,
    map_prepare,
    merge_cells,
    reconcile,
    scan_cells,
    split_records,
    super_map_prepare,
)

STD = FamilySpec()
LONG = FamilySpec(long_names=True)
SUP = FamilySpec(is_super=True)
SUP_LONG = FamilySpec(is_super=True, long_names=True)


def kept(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def text(df):
    return sorted(r.value for r in df.collect())


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("r", "a", "old", 1), ("r", "a", "new", 2)], [("r", "a", "new", 2)]),
        ([("r", "a", "new", 2), ("r", "a", "old", 1)], [("r", "a", "new", 2)]),
        ([("r", "a", "x", 5), ("r", "a", "y", 5)], [("r", "a", "y", 5)]),
        ([("r", "a", "z", -1), ("r", "a", "y", 0)], [("r", "a", "y", 0)]),
    ],
)
def test_reconcile(cells, rows, expected):
    for spec in (None, STD):
        assert kept(reconcile(cells(*rows), spec), "row_key", "name", "value", "ts") == expected


def test_reconcile_super(cells):
    rows = [("r", "s1", "a", "1", 1), ("r", "s2", "a", "2", 1)]
    for spec in (None, SUP):
        assert kept(reconcile(cells(*rows), spec), "super", "value") == [("s1", "1"), ("s2", "2")]


def test_reconcile_properties(spark, cells):
    """Idempotent, independent of order, and a merge may be done in steps."""
    rows = [
        (f"r{i % 7}", f"n{i % 3}", f"v{i % 5}", i % 4) for i in range(120)
    ]
    a, b = cells(*rows[:50]), cells(*rows[50:])
    whole = kept(reconcile(a.unionByName(b)), *CELL_SCHEMA.names[2:])
    assert kept(reconcile(cells(*reversed(rows))), *CELL_SCHEMA.names[2:]) == whole
    assert kept(merge_cells(a, b), *CELL_SCHEMA.names[2:]) == whole
    assert kept(merge_cells(reconcile(a), reconcile(b)), *CELL_SCHEMA.names[2:]) == whole
    assert kept(reconcile(reconcile(merge_cells(a, b))), *CELL_SCHEMA.names[2:]) == whole


def test_reconcile_keeps_families_apart(cells):
    other = cells(("r", "a", "theirs", 9)).withColumn("cf", F.lit("Other"))
    ours = cells(("r", "a", "ours", 1))
    assert kept(merge_cells(ours, other), "cf", "value") == [("Other", "theirs"), ("Standard1", "ours")]
    assert kept(merge_cells(ours, other, spec=STD), "cf", "value") == [("Standard1", "ours")]


@pytest.fixture
def row(cells):
    return cells(("r", "b", "2", 1), ("r", "a", "0", 0), ("r", "a", "1", 1), ("r", "c", "", 1))


def test_dump_table(row):
    assert text(dump_table(row, STD, ["b", "a"])) == ["r\t1\t2\t"]
    assert text(dump_table(row, STD, ["a", "zz"])) == ["r\t1\t"]
    assert text(dump_table(row, STD, ["c", "b"])) == ["r\t2\t\t"]
    assert text(dump_table(row, STD, ["zz"])) == []
    assert text(dump_table(reconcile(row), STD, ["b", "a"], reconciled=True)) == ["r\t1\t2\t"]


def test_reconciled_means_the_same_for_any_number_of_names(cells):
    rows = cells(("u", "n1", "old", 1), ("u", "n1", "new", 2))
    for names in (["n1"], [f"n{i}" for i in range(1, 101)]):
        assert text(dump_table(rows, STD, names)) == ["u\tnew\t"]
        assert text(dump_table(rows, STD, names, reconciled=True)) == ["u\tnew\told\t"]


def test_dump_table_long_names_in_number_order(cells):
    rows = cells(("r", "10", "ten", 1), ("r", "9", "nine", 1), ("r", "-2", "minus", 1))
    assert text(dump_table(rows, LONG, ["10", "+9", "-2"])) == ["r\tminus\tnine\tten\t"]


def test_dump_column_names(row, cells, lines):
    assert text(dump_column_names(row, STD)) == ["r\ta\tb\tc\t"]
    loaded = load_columns(lines("n3\t10\t9"), STD).cells
    assert text(dump_column_names(loaded, STD)) == ["n3\t10\t9\t"]
    loaded = load_columns(lines("n3\t10\t9"), LONG).cells
    assert text(dump_column_names(loaded, LONG)) == ["n3\t9\t10\t"]
    supers = cells(("r", "t", "a", "1", 1), ("r", "s", "a", "1", 1), ("r", "s", "b", "1", 1))
    assert text(dump_column_names(supers, SUP)) == ["r\ts\tt\t"]


def test_dump_map(row):
    assert text(dump_map(row, STD)) == ['r\t{"a":"1","b":"2","c":""}']


def test_json_escapes_survive_a_round_trip(cells):
    odd = 'quote " slash \\ / tab-less é ☃ 𝄞 \u0001'
    rows = cells(("r", odd, odd, 1))
    dumped = dump_map(rows, STD)
    assert kept(load_map(dumped, STD).cells, "name", "value") == [(odd, odd)]


def test_dump_super_map(cells):
    rows = cells(("r", "s", "a", "0", 0), ("r", "s", "a", "1", 1), ("r", "t", "b", "", 1))
    assert text(dump_super_map(rows, SUP)) == ["r\ts\ta\t1", "r\tt\tb\t"]


def test_dump_super_map_first_supers(cells):
    rows = [("r", str(s), n, "v", 1) for s in (100, 20, 3, -1) for n in "ab"]
    rows.append(("q", "7", "a", "v", 1))
    dumped = text(dump_super_map(cells(*rows), SUP_LONG, max_super=2))
    assert dumped == sorted(
        ["q\t7\ta\tv"] + [f"r\t{s}\t{n}\tv" for s in (-1, 3) for n in "ab"]
    )


def test_wrong_family_kind(cells, row):
    with pytest.raises(ValueError):
        dump_super_map(row, STD)
    with pytest.raises(ValueError):
        dump_map(row, SUP)
    with pytest.raises(ValueError):
        dump_table(row, STD, [])


def test_map_prepare(spark, lines):
    records, rejects = split_records(
        lines("r\tb\t2", "r\ta\t1", "r\tx", "r\tc\t3\t4"), "row_key", "name", "value"
    )
    assert kept(map_prepare(records), "row_key", "json") == [("r", '{"a":"1","b":"2"}')]
    assert kept(rejects, "line", "reason") == [
        ("r\tc\t3\t4", "bad_field_count"), ("r\tx", "bad_field_count"),
    ]
    repeated = spark.createDataFrame(
        [("r", "a", "first", 2), ("r", "a", "last", 1)], "k string, n string, v string, at int"
    )
    assert kept(map_prepare(repeated, "k", "n", "v"), "json") == [('{"a":"last"}',)]
    assert kept(map_prepare(repeated, "k", "n", "v", order="at"), "json") == [('{"a":"first"}',)]


def test_super_map_prepare(lines):
    records, _ = split_records(
        lines("r\tt\tb\t2", "r\ts\ta\t1", "r\ts\tA\t0"), "row_key", "super", "name", "value"
    )
    assert kept(super_map_prepare(records), "row_key", "json") == [
        ("r", '{"s":{"A":"0","a":"1"},"t":{"b":"2"}}')
    ]


HOT = 3000


@pytest.fixture
def skewed(spark):
    """A third of the cells in one row, the rest in rows of ten."""
    n = spark.range(3 * HOT).withColumn("hot", F.col("id") % 3 == 0)
    return n.select(
        F.lit("Keyspace1").alias("keyspace"),
        F.lit("Standard1").alias("cf"),
        F.when(F.col("hot"), "hot").otherwise(F.concat(F.lit("r"), (F.col("id") / 30).cast("int"))).alias("row_key"),
        F.lit(None).cast("string").alias("super"),
        F.format_string("%06d", "id").alias("name"),
        F.concat(F.lit("v"), "id").alias("value"),
        F.lit(1).cast("bigint").alias("ts"),
    )


def test_lines_do_not_depend_on_the_size_of_rows(skewed):
    for dump, load in ((dump_column_names, load_columns), (dump_map, load_map)):
        assert len(text(dump(skewed, STD))) == 301
        lines = text(dump(skewed, STD, pieces=4))
        hot = [line for line in lines if line.startswith("hot\t")]
        assert len(hot) == 4 and max(map(len, hot)) < 2 * min(map(len, hot))
        assert sum(line.startswith("r7\t") for line in lines) in (3, 4)
        dealt = load(dump(skewed, STD, pieces=4), STD, load_ts=1).cells
        assert kept(dealt, "row_key", "name") == kept(skewed, "row_key", "name")
        if dump is dump_column_names:
            names = [line.split("\t")[1:-1] for line in hot]
            assert all(n == sorted(n) for n in names)
    with pytest.raises(ValueError):
        dump_map(skewed, STD, pieces=0)


def test_super_rows_in_pieces(skewed):
    records = skewed.withColumn("super", F.substring("name", 4, 1))
    prepared = super_map_prepare(records, pieces=5)
    assert prepared.filter("row_key = 'hot'").count() == 5
    assert super_map_prepare(records).count() == 301
    lines = prepared.select(F.concat_ws("\t", "row_key", "json").alias("value"))
    columns = ["row_key", "super", "name", "value"]
    assert kept(load_super_map(lines, SUP).cells, *columns) == kept(records, *columns)


def test_empty_values_survive_a_dump_and_a_preparation(cells):
    rows = cells(("r", "s", "a", "", 1), ("r", "s", "b", "2", 1))
    records, rejects = split_records(dump_super_map(rows, SUP), "row_key", "super", "name", "value")
    assert kept(records, "name", "value") == [("a", ""), ("b", "2")]
    assert rejects.count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffles(skewed):
    """One shuffle for reconcile, one more for the rows of a dump, none for a load."""
    names = ["000001", "000002"]
    assert plan(dump_table(skewed, STD, names)).count("Exchange hash") == 2
    assert plan(dump_table(skewed, STD, names, reconciled=True)).count("Exchange hash") == 1
    assert plan(reconcile(skewed, STD)).count("Exchange hash") == 1
    loaded = load_columns(skewed.select(F.col("name").alias("value")), STD).cells
    assert "Exchange" not in plan(loaded)
    assert "partial_max" in plan(reconcile(skewed, STD))


def test_dumps_read_the_table_once(spark, skewed, tmp_path):
    """Cells are shuffled once to be reconciled and once to their lines; a compacted
    table is shuffled once."""
    append_cells(skewed, str(tmp_path / "cells"))
    stored = scan_cells(spark, str(tmp_path / "cells"), STD)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for dump in (dump_map, dump_column_names):
            for reconciled in (False, True):
                text = plan(dump(stored, STD, reconciled=reconciled))
                assert text.count("Exchange hash") == 2 - reconciled
                assert text.count("FileScan") == 1 and "Join" not in text
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_first_supers_are_ranked_before_a_shuffle(spark, tmp_path, lines):
    """No join; each task limits the supers of a row before it passes them on."""
    lines('r\t{"s":{"a":"1"},"t":{"a":"2"}}').write.text(str(tmp_path / "in"))
    loaded = load_super_map(spark.read.text(str(tmp_path / "in")), SUP, load_ts=1).cells
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(dump_super_map(loaded, SUP, max_super=1))
        assert text.count("FileScan") == 1 and "Join" not in text
        assert text.count("Exchange hash") == 2 and text.count("WindowGroupLimit") == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [r.value for r in dump_super_map(loaded, SUP, max_super=1).collect()] == ["r\ts\ta\t1"]


def test_a_load_splits_each_line_once(spark, tmp_path, lines):
    path = str(tmp_path / "in")
    lines("n\t1\t2").write.text(path)
    for spec in (STD, LONG):
        loaded = load_columns(spark.read.text(path), spec).cells
        assert plan(loaded).count("split(") == 1
        assert plan(loaded).count("try_cast(") == spec.long_names
    assert plan(load_map(spark.read.text(path), STD).cells).count("from_json(") <= 1
