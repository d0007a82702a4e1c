"""Commands from text to table to text."""

import pytest

from widerow import write_lines
from widerow.__main__ import main


@pytest.fixture
def run(spark, tmp_path):
    def path(name):
        return str(tmp_path / name)

    def text(name):
        return sorted(r.value for r in spark.read.text(path(name)).collect())

    return path, text


def test_table(run, lines, capsys):
    path, text = run
    write_lines(lines("1\tu1\told", "2\tu1\tnew", "x\tu2\tb", "3"), path("in"))
    main([
        "load-table", "--ks", "k", "--cf", "c", "--col-names", "at,user,label", "--key-field", "1",
        "--ts-field", "0", "--rejects", path("bad"), path("in"), path("cells"),
    ])
    assert "rows=3 bad_ts=1 columns=6 bad=1" in capsys.readouterr().err
    assert text("bad") == ["missing_key\t\t\t\t3"]
    dump = ["dump-table", "--ks", "k", "--cf", "c", "--col-names", "label,at"]
    main([*dump, path("cells"), path("out")])
    assert text("out") == ["u1\t2\tnew\t", "u2\tx\tb\t"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        main([*dump, path("cells"), path("out")])
    main(["compact", path("cells"), path("compacted")])
    main([*dump, "--rm", "--compacted", path("compacted"), path("out")])
    assert text("out") == ["u1\t2\tnew\t", "u2\tx\tb\t"]


def test_wide_table_and_dry_run(run, lines, capsys):
    path, text = run
    write_lines(lines("r1\t\tx\ty", "\tx\ty"), path("in"))
    load = ["load-table", "--wide", "--col-names", "k,-,v", path("in"), path("cells")]
    main([*load[:-2], "--dry-run", *load[-2:]])
    assert "columns=2 bad=0" in capsys.readouterr().err
    main(load)
    main(["dump-map", path("cells"), path("out")])
    assert text("out") == ['r1\t{"k":"r1","v":"y"}']


def test_columns_and_key_value(run, lines):
    path, text = run
    write_lines(lines("n3\t10\t9"), path("in"))
    main(["load-columns", "--longnames", "--fill-value", "1", path("in"), path("cells")])
    main(["dump-columns", "--longnames", path("cells"), path("out")])
    assert text("out") == ["n3\t9\t10\t"]
    write_lines(lines("r\ta\t1"), path("kv"))
    main(["load-key-value", "--cf", "kv", path("kv"), path("cells")])
    main(["dump-map", "--cf", "kv", path("cells"), path("kvout")])
    assert text("kvout") == ['r\t{"a":"1"}']


def test_rejects_say_why(run, lines, capsys):
    path, text = run
    write_lines(lines("n1\tx\t5\ty"), path("in"))
    load = ["load-columns", "--longnames", "--rejects", path("bad"), path("in"), path("cells")]
    main(load)
    assert text("bad") == [
        f"bad_long_name\tn1\t\t{name}\tn1\tx\t5\ty" for name in ("x", "y")
    ]
    write_lines(lines("r\ta\t", "r\tb", "r\tc\t3"), path("records"))
    main(["prepare-map", "--rejects", path("left"), path("records"), path("json")])
    assert "bad=1" in capsys.readouterr().err
    assert text("left") == ["bad_field_count\tr\tb"]
    assert text("json") == ['r\t{"a":"","c":"3"}']
    main(["prepare-map", "--rm", "--pieces", "9", path("records"), path("json")])
    assert text("json") == ['r\t{"a":""}', 'r\t{"c":"3"}']


def test_prepare_then_load(run, lines):
    path, text = run
    write_lines(lines("r\tt\tb\t2", "r\ts\ta\t1"), path("in"))
    main(["prepare-super-map", path("in"), path("json")])
    assert text("json") == ['r\t{"s":{"a":"1"},"t":{"b":"2"}}']
    main(["load-super-map", path("json"), path("cells")])
    write_lines(lines("r\tu\tc\t3\td\t4"), path("pairs"))
    main(["load-super-pairs", path("pairs"), path("cells")])
    main(["dump-super-map", path("cells"), path("out")])
    assert text("out") == ["r\ts\ta\t1", "r\tt\tb\t2", "r\tu\tc\t3", "r\tu\td\t4"]
    main(["dump-super-map", "--max-super", "1", path("cells"), path("first")])
    assert text("first") == ["r\ts\ta\t1"]
    main(["dump-columns", "--super", path("cells"), path("names")])
    assert text("names") == ["r\ts\tt\tu\t"]
    write_lines(lines("r\tb\t2", "r\ta\t1"), path("flat"))
    main(["prepare-map", path("flat"), path("flatjson")])
    main(["load-map", "--cf", "flat", path("flatjson"), path("cells")])
    main(["dump-table", "--cf", "flat", "--col-names", "b,a", path("cells"), path("table")])
    assert text("table") == ["r\t1\t2\t"]


def test_batches_into_a_base(run, lines, capsys):
    path, text = run
    for day, given in (("1", ["r\ta\tb", "q\tc", "\tx"]), ("2", ["r\td"])):
        write_lines(lines(*given), path(f"in{day}"))
        load = ["load-columns", "--batch", day, "--rejects", path("bad"), path(f"in{day}")]
        main([*load, path("batches")])
        merge = ["merge", "--buckets", "4", "--first", day, path("batches"), path("base")]
        main(merge)
    assert "rows=2 bad_ts=0 columns=3 bad=1" in capsys.readouterr().err
    assert text("bad") == ["empty_key\t\t\t\t\tx"]
    main(["dump-columns", "--base", path("base"), path("names")])
    assert text("names") == ["q\tc\t", "r\ta\tb\td\t"]
    main(["dump-map", "--base", "--any-size", path("base"), path("maps")])
    assert text("maps") == ['q\t{"c":"0"} ', 'r\t{"a":"0", "b":"0", "d":"0"} ']


def test_rows_of_any_size(run, lines):
    path, text = run
    write_lines(lines("r\tt\tb\t2", "r\ts\ta\t1"), path("in"))
    main(["prepare-super-map", "--any-size", path("in"), path("json")])
    assert text("json") == ['r\t{"s":{"a":"1"}, "t":{"b":"2"}} ']
    main(["load-super-map", path("json"), path("cells")])
    main(["compact", "--by-name", path("cells"), path("compacted")])
    main(["dump-columns", "--super", "--any-size", path("compacted"), path("names")])
    assert text("names") == ["r\ts\tt\t"]
