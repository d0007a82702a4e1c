"""Credentials in texts: strong ones by their form, weak ones by what stands near them.

Strong parts are reported wherever they are: assignments of a value to a name such as
``password`` (kind ``assign``), access key ids (``access``) and long hexadecimal runs
(``hex``). Weak parts are account names and mail addresses (``identity``), addresses and
URLs (``endpoint``) and other mixed runs of letters and digits (``candidate``). A weak part
alone is ordinary text. It is reported only when at most ``SCOPE`` code points lie between it and
its complement: a secret for an identity or an endpoint, an identity, access key or
endpoint for a candidate.

The join on intervals runs within the row. Parts are sorted by start, and of each the
greatest end of a complement before it and the least start of one after it tell exactly
whether one is in the scope, however long parts are. Nothing is shuffled, the cost is
linear in the parts, and all is built of Spark's own functions. Patterns start only at the edge of a
run of their characters, so that long runs don't make them quadratic.

A null text is an empty one and has no parts. Equal rows give equal results. A column
named like the added one is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 and more, as its run always matches to the end
HEX = r"[0-9a-f]{24,}"
ACCOUNT = (
    r"""(?<![A-Za-z0-9_])(?:(?i:user(?:name)?|login|account|client_?id))["']?\x20*[:=]\x20*["']?"""
    r"""[A-Za-z0-9._@-]{2,}+"""
)
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ADDRESS = (
    r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?(?![A-Za-z0-9]|\.[0-9])"
)
URL = r"""[a-z][a-z0-9+]{1,12}://[^\s"'<>]++"""
# A whole run, dots included but for those at its end, so that a token of several parts is
# one. It has a letter and a digit; each look goes over the run once.
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z+/_.=-]*+[0-9])(?=[0-9+/_.=-]*+[A-Za-z])"
    r"[A-Za-z0-9+/_.=-]{15,}[A-Za-z0-9+/_=-]"
)

KINDS = ("assign", "access", "hex", "identity", "endpoint", "candidate")
SCOPE = 256
#: Of each pattern the kind and the least length of a match.
_PARTS = (
    (ASSIGN, 0, 12), (ACCESS, 1, 20), (HEX, 2, 24), (ACCOUNT, 3, 7), (MAIL, 3, 5),
    (ADDRESS, 4, 7), (URL, 4, 6), (CANDIDATE, 5, 16),
)
_PART = "array<struct<start:int,kind:int,end:int>>"
_CHUNK = 512
_NONE = -(1 << 30)  # below all places


def _all_before(numbers: Column, add: Callable[[Column, Column], Column], first: int) -> Column:
    """What the numbers before each add up to; in chunks, so that building it stays linear."""

    def within(chunk: Column, start: Column) -> Column:
        return F.aggregate(
            chunk,
            F.struct(start.alias("sum"), F.array().cast("array<int>").alias("all")),
            lambda acc, x: F.struct(
                add(acc["sum"], x).alias("sum"),
                F.array_append(acc["all"], acc["sum"]).alias("all"),
            ),
        )["all"]

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / _CHUNK).cast("int")),
        lambda i: F.slice(numbers, i * _CHUNK + 1, F.lit(_CHUNK)),
    )
    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(first), add))
    starts = within(totals, F.lit(first))
    return F.flatten(F.zip_with(chunks, starts, within))


def _sums_before(numbers: Column) -> Column:
    return _all_before(numbers, lambda x, y: x + y, 0)


def matches(text: Column, pattern: str, kind: int) -> Column:
    """The pattern's matches, leftmost first and without overlap, with their places: the
    gaps between matches come from a split, and gaps and matches add up to places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), F.transform(found, F.length),
                       lambda gap, size: gap + size)
    parts = F.zip_with(
        F.zip_with(_sums_before(steps), gaps, lambda before, gap: before + gap),
        found,
        lambda start, m: F.struct(
            start.alias("start"),
            F.lit(kind).alias("kind"),
            (start + F.length(m)).alias("end"),
        ),
    )
    parts = F.slice(parts, 1, F.size(found))
    if pattern == ASSIGN:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        both = F.zip_with(parts, values, lambda p, v: F.struct(p.alias("p"), v.alias("v")))
        long = F.filter(both, lambda x: F.length(x["v"]) >= 6)
        parts = F.transform(long, lambda x: x["p"])
    return F.when(text.rlike(pattern), parts).otherwise(F.array().cast(_PART))


_OTHERS, _SECRETS, _PLACES = (0, 1, 2, 3, 4), (0, 2, 5), (1, 3, 4)


def _around(parts: Column, kinds: tuple[int, ...]) -> Column:
    """Of each part the greatest end of a part of the kinds before it, and the least start,
    negative, of one after it."""

    def greatest(some: Column, place: Callable[[Column], Column]) -> Column:
        places = F.transform(
            some, lambda q: F.when(q["kind"].isin(*kinds), place(q)).otherwise(F.lit(_NONE))
        )
        return _all_before(places, lambda x, y: F.greatest(x, y), _NONE)

    return F.zip_with(
        greatest(parts, lambda q: q["end"]),
        F.reverse(greatest(F.reverse(parts), lambda q: -q["start"])),
        lambda before, after: F.struct(before.alias("before"), after.alias("after")),
    )


def _gap(p: Column, around: Column) -> Column:
    """The code points between a part and the nearest other, below 0 if they overlap."""
    return F.least(p["start"] - around["before"], -around["after"] - p["end"])


def _filtered(parts: Column, *around: Column, by: Callable[..., Column]) -> Column:
    """The parts for which ``by`` holds, given them and what is around them."""
    whole = F.zip_with(parts, around[0], lambda p, x: F.struct(p.alias("p"), x.alias("x")))
    for more in around[1:]:
        whole = F.zip_with(
            whole, more, lambda w, y: F.struct(w["p"].alias("p"), w["x"].alias("x"), y.alias("y"))
        )
    names = ["p", "x", "y"][: 1 + len(around)]
    kept = F.filter(whole, lambda w: by(*(w[n] for n in names)))
    return F.when(F.size(parts) > 0, F.transform(kept, lambda w: w["p"])).otherwise(parts)


def _distinct(parts: Column) -> Column:
    """The parts without candidates that overlap another part: they are that part."""
    return _filtered(
        parts, _around(parts, _OTHERS), by=lambda p, other: (p["kind"] != 5) | (_gap(p, other) >= 0)
    )


def _linked(parts: Column) -> Column:
    """The strong parts, and the weak ones with a complement in their scope."""

    def reported(p: Column, secret: Column, place: Column) -> Column:
        gap = F.when(p["kind"] == 5, _gap(p, place)).otherwise(_gap(p, secret))
        return (p["kind"] <= 2) | (gap <= SCOPE)

    return _filtered(parts, _around(parts, _SECRETS), _around(parts, _PLACES), by=reported)


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``secrets``: an array of (start, kind, end), sorted, in code
    points with the end exclusive; kinds are places in ``KINDS``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    out = fresh(docs, "secrets", "_parts").withColumn(
        "_parts",
        F.array_sort(F.concat(*(matches(whole, p, kind) for p, kind, _ in _PARTS))),
    )
    out = out.withColumn("_parts", _distinct(F.col("_parts")))
    return out.withColumn("secrets", _linked(F.col("_parts"))).drop("_parts")


def named(spans: Column) -> Column:
    """Spans as texts kind:start:end."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.transform(
        spans,
        lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"]),
    )


def redacted(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """The text with each stretch covered by spans replaced by the mark."""
    done = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("kept")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["kept"])
            .otherwise(
                F.array_append(
                    acc["kept"],
                    F.concat(
                        F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                        F.lit(mark),
                    ),
                )
            )
            .alias("kept"),
        ),
    )
    rest = F.substring(text, done["at"] + 1, F.length(text))
    return F.when(
        F.size(spans) > 0, F.concat(F.array_join(done["kept"], ""), rest)
    ).otherwise(text)
