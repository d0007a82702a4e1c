"""Benchmark passages in documents, found by one Aho-Corasick automaton.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased: runs
of digits, letters a-z and anything beyond ASCII. A window is ``window`` words of an item
in a row; an item of fewer words is one window.

The automaton reads each word as two characters, the halves of its number among the
items' words, so that no node has many children. Its patterns are the items cut into chunks of half a
window, one after another, as any window of an item has one whole chunk in it; so it has
two nodes per word of the items instead of some per word of each window. Where a chunk
occurs in a text, the words around it are compared with those around it in the items, up
to a window's length: the windows that hold the chunk occur exactly where enough of them
are equal. A text is scanned once, and word positions are mapped back to code points of
the text as it was.

Items are a stated query set, held by each Python worker. One scan without a shuffle takes
up to ``block_bytes`` of item text (about 27 bytes of memory a byte); beyond that items
come in blocks, each a scan, and what was found is stored between scans.

Nulls and empty texts have no words and hit nothing, as documents and as items. Repeated
items and documents are each reported. An item without an id marks its words as hit but
isn't listed. Columns of the documents named like added ones are replaced.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored

_WORD_BYTES = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_LOWER = bytes(range(256)).lower()
_TO_WORDS = bytes(b if b in _WORD_BYTES else 0x20 for b in _LOWER)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_RANGE = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("words", _RANGE),
        ("spans", _RANGE),
        ("items", pa.list_(pa.string())),
    ]
)
_RANGE_DDL = "array<struct<first:int,last:int>>"
_FOUND_DDL = (
    f"struct<n_words:long,n_hit:long,words:{_RANGE_DDL},spans:{_RANGE_DDL},items:array<string>>"
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TO_WORDS).split()


class Scanner:
    """The automaton over the chunks of some items."""

    def __init__(self, items: Iterable[tuple[str | None, str]], window: int):
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}  # by words: equal items are one
        for item, text in items:
            words = tuple(
                self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text.encode())
            )
            if words:
                owners.setdefault(words, set()).update(() if item is None else (item,))
        chunk = (window + 1) // 2
        self.around = window - chunk  # words of a window beside a chunk
        self.window = window
        self.owners = list(owners.values())
        self.words = array("i")  # of all items, one after another
        self.starts = array("i", [0])
        places: dict[tuple[int, ...], list[int]] = {}  # of patterns
        for words in owners:
            at = len(self.words)
            self.words.extend(words)
            self.starts.append(len(self.words))
            if len(words) < window:
                places.setdefault(words, []).append(at)
            else:
                for i in range(0, len(words) - chunk + 1, chunk):
                    places.setdefault(words[i : i + chunk], []).append(at + i)
        half = ((len(self.ids) + 1).bit_length() + 1) // 2
        low = (1 << half) - 1
        # The halves have characters of their own, so matches start and end with words.
        codes = [chr(k & low) + chr((1 << half) + (k >> half)) for k in range(len(self.ids) + 1)]
        self.codes = {w: codes[k] for w, k in self.ids.items()}
        self.unknown = codes[0]
        self.automaton = ahocorasick.Automaton()
        for key, found in places.items():
            code = "".join(map(codes.__getitem__, key))
            self.automaton.add_word(code, (len(key), array("i", found)))
        self.empty = not places
        if places:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of hit words, merged, and the items whose windows occur."""
        if self.empty or not words:
            return [], set()
        code = "".join(map(self.codes.get, words, repeat(self.unknown)))
        symbols: list[int] | None = None
        ranges, seen = set(), set()
        for end_at, (length, places) in self.automaton.iter(code):
            if symbols is None:
                symbols = list(map(self.ids.get, words, repeat(0)))
            last = end_at // 2
            first = last - length + 1
            for place in places:
                item = bisect_right(self.starts, place) - 1
                start, end = self.starts[item], self.starts[item + 1]
                if end - start < self.window:
                    if length == end - start:
                        ranges.add((first, last))
                        seen.add(item)
                    continue
                before = min(self.around, first, place - start)
                left = 0
                while left < before and symbols[first - left - 1] == self.words[place - left - 1]:
                    left += 1
                after = min(self.around, len(symbols) - last - 1, end - place - length)
                right = 0
                while right < after and symbols[last + right + 1] == self.words[place + length + right]:
                    right += 1
                if left + right >= self.around:
                    ranges.add((first - left, last + right))
                    seen.add(item)
        return merged(ranges), set().union(*(self.owners[k] for k in seen))


def merged(ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges with both ends included, sorted; those that touch become one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def spans_of(raw: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points, end exclusive, of ranges of words."""
    spans, words, at, at_byte = [], enumerate(_WORD.finditer(raw)), 0, 0
    for first, last in ranges:
        start = next(m for k, m in words if k == first)
        end = start if first == last else next(m for k, m in words if k == last)
        at += len(raw[at_byte : start.start()].decode())
        size = len(raw[start.start() : end.end()].decode())
        spans.append((at, at + size))
        at, at_byte = at + size, end.end()
    return spans


def _scan_udf(items: list[tuple[str | None, str]], window: int, spark):
    shared = spark.sparkContext.broadcast(items)
    made: list[Scanner] = []

    def rows(texts: pa.Array, words: pa.Array, found: pa.Array) -> Iterator[dict]:
        if not made:
            made.append(Scanner(shared.value, window))
        for raw, old, names in zip(
            texts.cast(pa.binary()).to_pylist(), words.to_pylist(), found.to_pylist()
        ):
            tokens = words_of(raw or b"")
            ranges, own = made[0].scan(tokens)
            ranges = merged([*ranges, *((r["first"], r["last"]) for r in old or ())])
            yield {
                "n_words": len(tokens),
                "n_hit": sum(last - first + 1 for first, last in ranges),
                "words": [{"first": a, "last": b} for a, b in ranges],
                "spans": [
                    {"first": a, "last": b} for a, b in spans_of(raw or b"", ranges)
                ],
                "items": sorted(own.union(names or ())),
            }

    @F.arrow_udf(_FOUND_DDL)
    def scan(texts: pa.Array, words: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array(rows(texts, words, found), _FOUND)

    return scan.asNondeterministic()  # so that it runs once a row


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks; never more than one block and one partition here."""
    block, size = [], 0
    for item, text in items.toLocalIterator():
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    yield block


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block_bytes: int = 24 << 20,
) -> DataFrame:
    """The documents with ``n_words``, ``n_hit``, ``hit_spans`` (code points, end
    exclusive), ``items`` (ids of the items found, as sorted texts) and
    ``contaminated``."""
    added = ["n_words", "n_hit", "hit_spans", "items", "contaminated"]
    stated = items.select(F.col(item_id).cast("string"), item_text).filter(
        F.col(item_text).isNotNull()
    )
    out = fresh(docs, *added, "_found").withColumn(
        "_found", F.lit(None).cast(_FOUND_DDL)
    )
    later = False
    for block in _blocks(stated, block_bytes):
        scan = _scan_udf(block, window, docs.sparkSession)
        out = (stored(out) if later else out).withColumn(
            "_found", scan(text, F.col("_found.words"), F.col("_found.items"))
        )
        later = True
    return out.select(
        *[c for c in out.columns if c != "_found"],
        F.col("_found.n_words").alias("n_words"),
        F.col("_found.n_hit").alias("n_hit"),
        F.col("_found.spans").alias("hit_spans"),
        F.col("_found.items").alias("items"),
        (F.col("_found.n_hit") > 0).alias("contaminated"),
    )
