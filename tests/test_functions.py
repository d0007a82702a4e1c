import pytest
from pyspark.sql import functions as F

from widerow.functions import (
    bytes_to_long,
    json_super_map,
    long_to_bytes,
    parse_long,
    split_fields,
)


@pytest.mark.parametrize(
    "line, fields, collapsed",
    [
        ("a\tb", ["a", "b"], ["a", "b"]),
        ("", [""], [""]),
        ("\t", [], []),
        ("\t\t\t", [], []),
        ("a\t\t", ["a"], ["a"]),
        ("a\t\tb", ["a", "", "b"], ["a", "b"]),
        ("\t\tb\t", ["", "", "b"], ["", "b"]),
        (" a \t ", [" a ", " "], [" a ", " "]),
    ],
)
def test_split_fields(lines, line, fields, collapsed):
    got = lines(line).select(
        split_fields(F.col("value")), split_fields(F.col("value"), collapse_tabs=True)
    )
    assert [list(x) for x in got.first()] == [fields, collapsed]


@pytest.mark.parametrize(
    "text, value",
    [
        ("7", 7), ("+7", 7), ("007", 7), ("-0", 0), ("-7", -7),
        ("9223372036854775807", 2**63 - 1), ("-9223372036854775808", -(2**63)),
        ("9223372036854775808", None), ("", None), ("+", None), ("x", None), (" 7", None),
        ("7 ", None), ("7\n", None), ("7.0", None), ("1e3", None), ("7L", None), ("--7", None),
    ],
)
def test_parse_long(lines, text, value):
    assert lines(text).select(parse_long(F.col("value"))).first()[0] == value


@pytest.mark.parametrize("value", [0, 1, 255, 256, 2**63 - 1, -1, -2, -(2**63)])
def test_long_bytes(spark, value):
    raw = long_to_bytes(F.col("v"))
    df = spark.createDataFrame([(value,)], "v bigint").select(raw, bytes_to_long(raw))
    assert [bytes(x) if isinstance(x, bytearray) else x for x in df.first()] == [
        value.to_bytes(8, "big", signed=True), value,
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"s":{"a":1.50,"b": -1e3 ,"c":"x:2,"}}', {"s": {"a": "1.50", "b": "-1e3", "c": "x:2,"}}),
        ('{"s":{"a\\":1":2,"b\\\\":0.10}}', {"s": {'a":1': "2", "b\\": "0.10"}}),
        ('{"s":{"a":1,"a":2.0,"n":null,"t":true}}', {"s": {"a": "2.0", "n": None, "t": "true"}}),
        ('{"s":{"a":01}}', None),
        ('{"s":{"a":1.}}', None),
        ('{"s":{1:"a"}}', None),
        ('{"s":1}', None),
        ('{"s":{"a":1}', None),
        ('{"s":{"a":12345678901234567890.123456789012345678901}}',
         {"s": {"a": "12345678901234567890.123456789012345678901"}}),
    ],
)
def test_numbers_of_super_maps_keep_their_spelling(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    parsed = df.select(json_super_map(F.col("t")).alias("m")).first()["m"]
    assert (parsed if parsed is None else {k: dict(v) for k, v in parsed.items()}) == expected
