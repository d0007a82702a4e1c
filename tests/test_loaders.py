"""The literal cases of FIXTURES.md A1-A5 and the bad-input rules."""

import pytest

from widerow import (
    FamilySpec,
    discard,
    load_columns,
    load_key_value,
    load_map,
    load_super_map,
    load_super_pairs,
    load_table,
    reconcile,
)

LT = 1_000_000
STD = FamilySpec()
LONG = FamilySpec(long_names=True)
SUP = FamilySpec(is_super=True)
SUP_LONG = FamilySpec(is_super=True, long_names=True)
NAMES = ["user_id", "screen_name", "ip_address"]


def got(result, *columns):
    return sorted(tuple(r) for r in result.cells.select(*columns).collect())


def std(result):
    return got(result, "row_key", "name", "value", "ts")


def sup(result):
    return got(result, "row_key", "super", "name", "value")


def reasons(result):
    rows = result.rejects.select("row_key", "super", "name", "reason").collect()
    return sorted(tuple(x for x in r if x is not None) for r in rows)


@pytest.mark.parametrize(
    "line, kwargs, expected",
    [
        ("u1\tann\t10.0.0.1", {}, [("u1", "ip_address", "10.0.0.1", LT), ("u1", "screen_name", "ann", LT)]),
        ("u2\tbob", {}, [("u2", "screen_name", "bob", LT)]),
        ("u3\t\t10.0.0.3", {}, [("u3", "ip_address", "10.0.0.3", LT), ("u3", "screen_name", "", LT)]),
        ("u4\tcy\t\t", {}, [("u4", "screen_name", "cy", LT)]),
        ("u5\tdi\t10.0.0.5\textra", {}, [("u5", "ip_address", "10.0.0.5", LT), ("u5", "screen_name", "di", LT)]),
        ("u6", {}, []),
        ("", {}, []),
        ("\t\t", {}, []),
        ("u7\ted\t123", {"ts_field": 2}, [("u7", "ip_address", "123", 123), ("u7", "screen_name", "ed", 123)]),
        ("u8\tfay\tx", {"ts_field": 2}, [("u8", "ip_address", "x", LT), ("u8", "screen_name", "fay", LT)]),
        ("u9\tgus", {"ts_field": 2}, [("u9", "screen_name", "gus", LT)]),
        ("x\tk\ty", {"key_field": 1}, [("k", "ip_address", "y", LT), ("k", "user_id", "x", LT)]),
    ],
)
def test_load_table(lines, line, kwargs, expected):
    result = load_table(lines(line), STD, NAMES, load_ts=LT, **kwargs)
    assert std(result) == expected
    assert reasons(result) == []


def test_load_table_rejects(lines):
    assert reasons(load_table(lines("a"), STD, NAMES, key_field=2)) == [("missing_key",)]
    assert reasons(load_table(lines("\tx"), STD, NAMES)) == [("", "empty_key")]
    bad_ts = load_table(
        lines("u8\tfay\tx", "u9\tgus", "u7\ted\t123"), STD, NAMES, ts_field=2, on_bad_ts="reject"
    )
    assert reasons(bad_ts) == [("u8", "bad_timestamp"), ("u9", "bad_timestamp")]
    assert {r[0] for r in std(bad_ts)} == {"u7"}


def test_load_table_reads_the_clock_once(lines):
    result = load_table(lines("a\t1\t2", "b\t1\t2"), STD, NAMES)
    stamps = {r.ts for r in result.cells.collect()}
    assert len(stamps) == 1 and stamps.pop() > 1_700_000_000_000_000


@pytest.mark.parametrize(
    "line, expected",
    [
        ("r1\tx\ty", [("r1", "k", "r1"), ("r1", "v", "y")]),
        ("r1\t\tx\ty", [("r1", "k", "r1"), ("r1", "v", "y")]),
        ("\tx\ty", []),
        ("", []),
    ],
)
def test_load_table_wide_layout(lines, line, expected):
    result = load_table(
        lines(line), STD, ["k", "-", "v"], skip_name="-", collapse_tabs=True, keep_key=True, drop_missing_key=True
    )
    assert got(result, "row_key", "name", "value") == expected
    assert reasons(result) == []


def test_load_columns(lines):
    def text(line):
        return got(load_columns(lines(line), STD), "row_key", "name", "value")

    def long(line):
        result = load_columns(lines(line), LONG, load_ts=LT)
        return got(result, "row_key", "name"), [r[1] for r in reasons(result)]

    assert text("n1\t2\t3") == [("n1", "2", "0"), ("n1", "3", "0")]
    assert text("n1\t7\t07\t+7") == [("n1", "+7", "0"), ("n1", "07", "0"), ("n1", "7", "0")]
    assert text("n5\t 12 \t4") == [("n5", " 12 ", "0"), ("n5", "4", "0")]
    assert long("n1\t2\t3") == ([("n1", "2"), ("n1", "3")], [])
    assert long("n1\t7\t07\t+7") == ([("n1", "7")] * 3, [])
    assert long("n2\tx\t5") == ([("n2", "5")], ["x"])
    assert long("n4\t-2\t9223372036854775808") == ([("n4", "-2")], ["9223372036854775808"])
    assert long("n5\t 12 \t4") == ([("n5", "4")], [" 12 "])
    once = reconcile(load_columns(lines("n1\t7\t07\t+7"), LONG, load_ts=LT).cells)
    assert once.count() == 1
    filled = load_columns(lines("a\tb"), STD, key_field=1, fill_value="x")
    assert got(filled, "row_key", "name", "value") == [("b", "a", "x")]


def test_counters(lines):
    result = load_columns(
        lines("n1\t2\t3", "n2\tx\t5", "n3\t10\t9", "n6\ty", "n7"), LONG, count=True
    )
    discard(result.cells)
    assert result.counters() == {"rows": 5, "bad_ts": 0, "columns": 5, "bad": 2}
    table = load_table(
        lines("u1\ta\t5", "u2\ta\tx", "\tq"), STD, NAMES, ts_field=2, count=True
    )
    discard(table.cells)
    assert table.counters() == {"rows": 2, "bad_ts": 1, "columns": 4, "bad": 1}


@pytest.mark.parametrize(
    "line, spec, expected, rejected",
    [
        ('r1\t{"a":"1","b":"2"}', STD, [("r1", "a", "1"), ("r1", "b", "2")], []),
        ('r2\t{"a":1.50,"b":true,"c":1e3}', STD, [("r2", "a", "1.5"), ("r2", "b", "true"), ("r2", "c", "1000.0")], []),
        ('r3\t{"a":"2","b":"x","a":"1","c":"y"}', STD, [("r3", "a", "1"), ("r3", "b", "x"), ("r3", "c", "y")], []),
        ('r3\t{"a":"2","a":"3","a":null}', STD, [], [("r3", "a", "null_value")]),
        ("r4\t{}", STD, [], []),
        ('r5\t{"a":null,"b":"2"}', STD, [("r5", "b", "2")], [("r5", "a", "null_value")]),
        ('r6\t{"a":', STD, [], [("r6", "bad_json")]),
        ("r6\t{'a':'1'}", STD, [], [("r6", "bad_json")]),
        ("r6\tnull", STD, [], [("r6", "bad_json")]),
        ("r7", STD, [], [("r7", "missing_json")]),
        ("\t\t", STD, [], [("missing_key",)]),
        ('\t{"a":"1"}', STD, [], [("", "empty_key")]),
        ('r8\t{"5":"x","z":"y"}', LONG, [("r8", "5", "x")], [("r8", "z", "bad_long_name")]),
        ('r9\t{"a":"1"}\tignored', STD, [("r9", "a", "1")], []),
    ],
)
def test_load_map(lines, line, spec, expected, rejected):
    result = load_map(lines(line), spec)
    assert got(result, "row_key", "name", "value") == expected
    assert reasons(result) == rejected


@pytest.mark.parametrize(
    "line, spec, expected, rejected",
    [
        (
            'r1\t{"s":{"a":"1","b":"2"},"t":{"a":"3"}}',
            SUP,
            [("r1", "s", "a", "1"), ("r1", "s", "b", "2"), ("r1", "t", "a", "3")],
            [],
        ),
        ('r2\t{"s":{}}', SUP, [], []),
        ('r3\t{"s":5}', SUP, [], [("r3", "bad_json")]),
        ('r3\t{"s":{"a":"1"},"t":5}', SUP, [], [("r3", "bad_json")]),
        ('r3\t{"s":null}', SUP, [], [("r3", "s", "null_value")]),
        ('r3\t{"s":{"a":null}}', SUP, [], [("r3", "s", "a", "null_value")]),
        ('r3\t{"s":{"a":"1","b":"9"},"s":{"a":"3","a":"2"}}', SUP, [("r3", "s", "a", "2")], []),
        (
            'r4\t{"1":{"2":"x","q":"y"},"w":{"3":"z"}}',
            SUP_LONG,
            [("r4", "1", "2", "x")],
            [("r4", "1", "q", "bad_long_name"), ("r4", "w", "bad_long_name")],
        ),
        ('r5\t{"+01":{"007":"x"}}', SUP_LONG, [("r5", "1", "7", "x")], []),
    ],
)
def test_load_super_map(lines, line, spec, expected, rejected):
    result = load_super_map(lines(line), spec)
    assert sup(result) == expected
    assert reasons(result) == rejected


@pytest.mark.parametrize(
    "line, spec, stop, expected, rejected",
    [
        ("r1\ts\ta\t1\tb\t2\tc", SUP, False, [("r1", "s", "a", "1"), ("r1", "s", "b", "2")], []),
        ("r1\ts\ta\t\tb\t2", SUP, False, [("r1", "s", "a", ""), ("r1", "s", "b", "2")], []),
        ("r1\ts", SUP, False, [], []),
        ("r1", SUP, False, [], [("r1", "missing_super")]),
        ("\t\t", SUP, False, [], [("missing_key",)]),
        ("r1\t9\t1\ta\tx\tb\t2\tc", SUP_LONG, False, [("r1", "9", "1", "a"), ("r1", "9", "2", "c")], [("r1", "9", "x", "bad_long_name")]),
        ("r1\t9\t1\ta\tx\tb\t2\tc", SUP_LONG, True, [("r1", "9", "1", "a")], [("r1", "9", "x", "bad_long_name")]),
        ("r1\tq\t1\ta", SUP_LONG, False, [], [("r1", "q", "bad_long_name")]),
    ],
)
def test_load_super_pairs(lines, line, spec, stop, expected, rejected):
    result = load_super_pairs(lines(line), spec, stop_at_bad_name=stop)
    assert sup(result) == expected
    assert reasons(result) == rejected


def test_load_key_value(lines):
    result = load_key_value(lines("r1\ta\t1\tjunk", "r1\ta", "r2\t\tv", "\ta\tb", "\t\t"), STD, load_ts=LT)
    assert std(result) == [("r1", "a", "1", LT), ("r2", "", "v", LT)]
    assert reasons(result) == [("", "a", "empty_key"), ("missing_value",), ("r1", "a", "missing_value")]


def test_failfast(lines):
    good = load_map(lines('r1\t{"a":"1"}'), STD, mode="failfast")
    assert got(good, "row_key", "name", "value") == [("r1", "a", "1")]
    for bad in (
        load_map(lines('r6\t{"a":'), STD, mode="failfast"),
        load_columns(lines("n2\tx"), LONG, mode="failfast"),
        load_table(lines("u8\tfay\tx"), STD, NAMES, ts_field=2, on_bad_ts="reject", mode="failfast"),
    ):
        with pytest.raises(Exception, match="bad record"):
            bad.cells.collect()


def test_layout_must_fit_the_family(lines):
    with pytest.raises(ValueError):
        load_columns(lines("a"), SUP)
    with pytest.raises(ValueError):
        load_super_map(lines("a"), STD)


def test_a_callers_long_name_is_read_as_strictly_as_data():
    assert FamilySpec(long_names=True).canonical("+07") == "7"
    for name in ("1_0", " 7 ", "", "99999999999999999999", "\u0663"):
        with pytest.raises(ValueError):
            FamilySpec(long_names=True).canonical(name)


def test_a_line_without_a_key_is_left_out_before_its_timestamp_is_read(lines):
    result = load_table(
        lines("\tx\tbad", "k\tx\tbad"), FamilySpec(), ["k", "v", "t"], ts_field=2,
        on_bad_ts="reject", keep_key=True, drop_missing_key=True,
    )
    assert [(r["reason"], r["row_key"]) for r in result.rejects.collect()] == [("bad_timestamp", "k")]
    assert result.cells.count() == 0


def test_checked_holds_cells_and_rejects_from_one_scan(spark, lines, tmp_path):
    lines("n2\tx\t5").write.text(str(tmp_path / "in"))
    result = load_columns(spark.read.text(str(tmp_path / "in")), FamilySpec(long_names=True))
    got = sorted((r["name"], r["reason"] or "", r["line"] or "") for r in result.checked.collect())
    assert got == [("5", "", ""), ("x", "bad_long_name", "n2\tx\t5")]
    plan = result.checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
