"""Word-piece counts by a longest-match automaton, without building pieces.

A word is cut greedily: the longest vocabulary entry at its start, then the longest at
the place reached, and so on. The vocabulary is a trie over bytes. Each node has a failure
link, the node that the longest cut of what was read leads to, and the number of pieces
which that cut gives off. So a word is read once, left to right, whatever it holds, and
only numbers are added.

Entries may differ at the start of a word and later in it, and may ask for the word's end
(here the symbol 256). That symbol is an entry by itself which counts nothing, for words
whose last piece has no form with it. A word that can't be cut is one unknown piece.

Words repeat, so a bounded table keeps the counts of short words seen by a task; it holds
no more than ``_KEPT`` words and changes no result. Null and empty texts have no words.
Columns of the input named like added ones are replaced.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

# Fixed values of the vocabulary file's format: its word pattern and its mark of an end.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
END_MARK = "</w>"
END = chr(256)
_KEPT, _KEPT_LENGTH = 1 << 19, 64
_UNKNOWN = 1 << 40


class LongestMatch:
    """Counts pieces. Entries are bytes as latin-1 texts, ``END`` standing for the end
    of the word; ``first`` may stand at a word's start, ``later`` elsewhere."""

    def __init__(self, first: Iterable[str], later: Iterable[str] | None = None):
        self.next: dict[int, int] = {}  # node << 9 | symbol: node
        size = 1
        pieces: dict[int, int] = {}  # of nodes that are entries

        def grow(root: int, entries: Iterable[str]) -> None:
            nonlocal size
            for entry in entries:
                node = root
                for symbol in map(ord, entry):
                    key = node << 9 | symbol
                    if key not in self.next:
                        self.next[key] = size
                        size += 1
                    node = self.next[key]
                if node != root:
                    pieces[node] = int(entry != END)

        grow(0, first)
        self.later = 0
        if later is not None:
            self.later = size
            size += 1
            grow(self.later, later)
        self._link(size, pieces)

    def _link(self, size: int, pieces: dict[int, int]) -> None:
        below: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for key, child in self.next.items():
            below[key >> 9].append((key & 511, child))
        self.fail = [-1] * size
        self.pops = [0] * size
        queue = deque({0, self.later})
        while queue:
            node = queue.popleft()
            for symbol, child in below[node]:
                queue.append(child)
                if child in pieces:
                    self.fail[child], self.pops[child] = self.later, pieces[child]
                    continue
                at, pops = self.fail[node], self.pops[node]
                while at >= 0 and (at << 9 | symbol) not in self.next:
                    pops, at = pops + self.pops[at], self.fail[at]
                if at >= 0:
                    self.fail[child] = self.next[at << 9 | symbol]
                    self.pops[child] = pops

    def count(self, word: str) -> int | None:
        """The number of pieces; None if the word can't be cut."""
        if not word:
            return 0
        node, pieces, follow, fail, pops = 0, 0, self.next, self.fail, self.pops
        for symbol in map(ord, word):
            while (after := follow.get(node << 9 | symbol)) is None:
                pieces += pops[node]
                node = fail[node]
                if node < 0:
                    return None
            node = after
        while node != self.later:
            pieces += pops[node]
            node = fail[node]
            if node < 0:
                return None
        return pieces


class _Counts(dict):
    """Pieces by word, with ``_UNKNOWN`` more for an unknown word."""

    def __init__(self, entries: list[str]):
        self.automaton = LongestMatch([*entries, END])

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(word.encode().decode("latin-1") + END)
        n = 1 + _UNKNOWN if n is None else n
        if len(word) <= _KEPT_LENGTH:
            if len(self) >= _KEPT:
                self.clear()
            self[word] = n
        return n


def byte_symbols() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable
    ones for themselves, the others in order for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load_vocabulary(path: str) -> list[str]:
    """Entries of a byte-level vocabulary file whose words end in ``END_MARK``."""
    symbols = byte_symbols()
    with open(path, encoding="utf-8") as file:
        names = json.load(file)["model"]["vocab"]
    out = []
    for name in names:
        body = name.removesuffix(END_MARK)
        if body and all(c in symbols for c in body):
            end = END if name != body else ""
            out.append("".join(chr(symbols[c]) for c in body) + end)
    return out


def words_of(text: str) -> list[str]:
    """The words, after composition and lower-casing."""
    return _PATTERN.findall(unicodedata.normalize("NFC", text).lower())


_PATTERN = regex.compile(WORD)


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """The documents with ``n_words``, ``n_tokens`` and ``n_unknown`` (words that can't
    be cut). ``vocabulary`` is the path of a vocabulary file on the driver; its entries,
    as many as the file has, are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))
    made: list[_Counts] = []
    kind = pa.struct([(n, pa.int64()) for n in ("n_words", "n_tokens", "n_unknown")])

    @F.arrow_udf("struct<n_words:long,n_tokens:long,n_unknown:long>")
    def count(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(_Counts(shared.value))
        pieces, rows = made[0].__getitem__, []
        for one in texts.to_pylist():
            words = words_of(one or "")
            unknown, tokens = divmod(sum(map(pieces, words)), _UNKNOWN)
            rows.append((len(words), tokens, unknown))
        return pa.StructArray.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
            fields=list(kind),
        )

    out = fresh(docs, "n_words", "n_tokens", "n_unknown", "_counts")
    kept = out.columns
    counted = out.withColumn("_counts", count.asNondeterministic()(text))
    return counted.select(*kept, "_counts.*")
