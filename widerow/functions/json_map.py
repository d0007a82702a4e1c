"""Column builders for JSON objects as maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain JSON only: Spark's reader takes single quotes and NaN by default.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def json_map(text: Column) -> Column:
    """A JSON object as MAP<STRING,STRING>, null when it is not one."""
    return F.from_json(text, "map<string,string>", _STRICT)


def json_super_map(text: Column) -> Column:
    """A JSON object of objects as MAP<STRING,MAP<STRING,STRING>>, null when it
    is not one. Numbers keep their spelling (``1.50``, ``1e3``)."""
    return F.from_json(numbers_as_text(text), "map<string,map<string,string>>", _STRICT)


def numbers_as_text(text: Column) -> Column:
    """JSON text in which the numbers of objects are strings of the same spelling.

    Parsing a number would lose it. The parts of the text outside strings are every
    other one between quotes, once escaped quotes and backslashes are out of the way;
    the marks that stand for them can't occur in JSON, and a text with them is left
    as it is, as is one that has no number after a colon.
    """
    number = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
    blank = r"[ \t\r\n]*"
    marks = {"\\\\": "\x01", '\\"': "\x02"}
    held = text
    for escaped, mark in marks.items():
        held = F.replace(held, F.lit(escaped), F.lit(mark))
    parts = F.transform(
        F.split(held, '"', -1),
        lambda part, i: F.when(
            i % 2 == 0,
            F.regexp_replace(part, f"(:{blank})({number})(?={blank}[,}}])", '$1"$2"'),
        ).otherwise(part),
    )
    quoted = F.array_join(parts, '"')
    for escaped, mark in reversed(marks.items()):
        quoted = F.replace(quoted, F.lit(mark), F.lit(escaped))
    needed = text.rlike(f":{blank}-?[0-9]") & ~text.rlike("[\\x01\\x02]")
    return F.when(needed, quoted).otherwise(text)


def last_entries(m: Column) -> Column:
    """A parsed JSON map without repeated keys: of each only the last entry.

    ``from_json`` keeps every entry it reads. Repeats are rare, so the common case
    costs one hash set; otherwise keys are sorted with their positions and the
    last position of each key is looked up.
    """
    keys, values = F.map_keys(m), F.map_values(m)
    marked = F.sort_array(
        F.transform(keys, lambda key, at: F.struct(key.alias("key"), at.alias("at")))
    )
    following = F.slice(marked, F.lit(2), F.size(m))
    paired = F.arrays_zip(marked.alias("this"), following.alias("next"))
    last = F.filter(
        paired,
        lambda p: p["next"].isNull() | (p["this"]["key"] != p["next"]["key"]),
    )
    deduplicated = F.transform(
        last,
        lambda p: F.struct(
            p["this"]["key"].alias("key"), F.get(values, p["this"]["at"]).alias("value")
        ),
    )
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), m).otherwise(
        F.map_from_entries(deduplicated)
    )


def json_pair(name: Column, value: Column) -> Column:
    """``"name":"value"``, both escaped: one entry of a JSON object."""
    return _inside(F.to_json(F.create_map(name, value)))


def json_object(pairs: Column) -> Column:
    """A JSON object from an array of its entries' texts, in the array's order.

    Joining texts keeps a row's cost to its own entries. A map column would be
    built by a hash table that Spark keeps for the task: once a wide row has
    stretched it, clearing it costs every later row as much again.
    """
    return F.concat(F.lit("{"), F.concat_ws(",", pairs), F.lit("}"))


def json_member(name: Column, json: Column) -> Column:
    """``"name":`` and a JSON value: one entry of a JSON object."""
    return F.concat(_inside(F.to_json(F.array(name))), F.lit(":"), json)


def _inside(json: Column) -> Column:
    return F.substring(json, F.lit(2), F.length(json) - 2)
