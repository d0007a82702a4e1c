"""Vector codes: product quantisation by a dual-tree Lloyd in whole numbers.

Each component becomes floor(SCALE * x); vectors are cut into equal consecutive parts, and
each part position has a codebook of whole-number entries. A round gives every part to the
nearest entry (squared distance, ties to the lower index) and moves each entry to the floor
of its parts' mean; entries that are not used stay.

Rows are packed into blocks of ``BLOCK`` vectors once. A block holds, for each part
position, a k-d tree over its parts with a box, a count and a sum for every node. In a
round the tree is walked together with a k-d tree over the entries: a pair of nodes goes
when its least distance is above the greatest distance to some other entry node; once
entries stand alone, an entry goes when another is nearer at that corner of the box which
favours it most. A tree node left with one entry is given to it whole, by its cached sum.
Leaves that stay uncertain are settled by whole-number distances. All bounds are in whole
numbers too, so the result equals that of trying every entry, whatever the blocks.

A task sums its blocks and returns one row per part position and entry; the driver holds
codebooks only. The blocks are stored, so a lost executor costs its tasks of one round.

Rows are dropped if the vector is null, holds a null or a component that isn't finite or
isn't below ``LIMIT`` (beyond it squared distances could leave 64 bits), or has another
length than the one used: the length, a multiple of the parts, of the least key that has
such. Rows that repeat a key are rows of their own; the first entries are those of the
least keys (null last), then of the least vectors. With fewer rows than entries the
codebooks are smaller. Null labels are one label. An empty table gives no rows and empty
codebooks. Only the three named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import group_key, small, stored

LIMIT = 8192.0
BLOCK = 2048  # vectors
LEAF = 16  # parts, at about which a tree ends


def _cuts(n: int, level: int) -> np.ndarray:
    """Bounds of the 2^level ranges that a level cuts n places into."""
    return (np.arange((1 << level) + 1) * n) >> level


@dataclass
class Tree:
    """A k-d tree: node k of a level holds the points at places cuts[k] to cuts[k + 1] of
    ``order``. ``low``, ``high`` and ``sums`` have the levels one after another, so node k
    of level l is row 2^l - 1 + k."""

    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray
    depth: int

    def level(self, name: str, level: int) -> np.ndarray:
        return getattr(self, name)[(1 << level) - 1 : (2 << level) - 1]


def grown(points: np.ndarray, leaf: int) -> Tree:
    """Every level halves every node along the widest side of its box. No node is empty."""
    n = len(points)
    depth = max(0, (n // leaf).bit_length() - 1)
    order, low, high, sums = np.arange(n), [], [], []
    for level in range(depth + 1):
        cuts = _cuts(n, level)
        placed = points[order]
        low.append(np.minimum.reduceat(placed, cuts[:-1]))
        high.append(np.maximum.reduceat(placed, cuts[:-1]))
        sums.append(np.add.reduceat(placed, cuts[:-1]))
        if level < depth:
            node = np.repeat(np.arange(1 << level), np.diff(cuts))
            widest = (high[-1] - low[-1]).argmax(1)
            order = order[np.lexsort((placed[np.arange(n), widest[node]], node))]
    return Tree(order, *map(np.concatenate, (low, high, sums)), depth)


def _children(a: np.ndarray, b: np.ndarray, split_b: bool) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of children, of b only where it has some."""
    a = np.concatenate([2 * a, 2 * a + 1])
    b = np.concatenate([b, b])
    if split_b:
        a, b = np.concatenate([a, a]), np.concatenate([2 * b, 2 * b + 1])
    return a, b


def assigned(points: np.ndarray, tree: Tree, entries: np.ndarray):
    """The nearest entry of each point, the sum of each entry's points and their number,
    and how many points were settled as whole nodes."""
    places = grown(entries, 1)
    # Entry tree levels hold two children or one single entry a node.
    codes = np.full(len(points), -1)
    sums, counts = np.zeros_like(entries), np.zeros(len(entries), np.int64)
    node, other = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for level in range(tree.depth + 1):
        low, high = tree.level("low", level)[node], tree.level("high", level)[node]
        at = min(level, places.depth)
        e_low, e_high = places.level("low", at)[other], places.level("high", at)[other]
        gap = np.maximum(np.maximum(e_low - high, low - e_high), 0)
        span = np.maximum(e_high - low, high - e_low)
        best = np.full(1 << level, np.iinfo(np.int64).max)
        np.minimum.at(best, node, (span * span).sum(1))
        near = (gap * gap).sum(1) <= best[node]
        node, other = node[near], other[near]
        cuts = _cuts(len(points), level)
        if at == places.depth and _single(places, len(entries)):
            node, other = _undominated(tree, level, node, places.order[other], entries)
            alone = np.bincount(node, minlength=1 << level)[node] == 1
            for k, e in zip(node[alone], other[alone]):
                codes[tree.order[cuts[k] : cuts[k + 1]]] = e
            np.add.at(sums, other[alone], tree.level("sums", level)[node[alone]])
            np.add.at(counts, other[alone], np.diff(cuts)[node[alone]])
            node, other = node[~alone], np.argsort(places.order)[other[~alone]]
        if level < tree.depth:
            node, other = _children(node, other, at < places.depth)
    whole = int(counts.sum())
    open_ = np.flatnonzero(codes < 0)
    if len(open_):
        # Of the leaves left: which entries are still possible for each of their points.
        leaf_of = np.empty(len(points), np.int64)
        cuts = _cuts(len(points), tree.depth)
        leaf_of[tree.order] = np.repeat(np.arange(1 << tree.depth), np.diff(cuts))
        e_cuts = _cuts(len(entries), min(tree.depth, places.depth))
        possible = np.zeros((1 << tree.depth, len(entries)), bool)
        for k, e in zip(node, other):
            possible[k, places.order[e_cuts[e] : e_cuts[e + 1]]] = True
        apart = points[open_][:, None, :] - entries
        distance = (apart * apart).sum(2)
        distance[~possible[leaf_of[open_]]] = np.iinfo(np.int64).max
        codes[open_] = distance.argmin(1)
        np.add.at(sums, codes[open_], points[open_])
        counts += np.bincount(codes[open_], minlength=len(entries))
    return codes, sums, counts, whole


def _single(places: Tree, n: int) -> bool:
    return 1 << places.depth == n


def _undominated(tree, level, node, entry, entries):
    """The pairs whose entry isn't ruled out by the one nearest to the box's middle."""
    low, high = tree.level("low", level)[node], tree.level("high", level)[node]
    off = 2 * entries[entry] - low - high
    off = (off * off).sum(1)
    order = np.lexsort((entry, off, node))
    first = order[np.concatenate([[True], np.diff(node[order]) != 0])] if len(node) else order
    champion = np.zeros(1 << level, np.int64)
    champion[node[first]] = entry[first]
    rival = champion[node]
    corner = np.where(entries[entry] > entries[rival], high, low)
    own, others = corner - entries[entry], corner - entries[rival]
    behind = (own * own).sum(1) - (others * others).sum(1)
    stays = (behind < 0) | ((behind == 0) & (entry <= rival))
    return node[stays], entry[stays]


@dataclass(frozen=True)
class Codes:
    """``rows``: key, ``code`` (an index per part), ``error`` (squared distance) and
    ``label_error`` (its sum over rows of the label). ``codebooks``: the final entries by
    part and entry."""

    rows: DataFrame
    codebooks: list[list[list[int]]]


def _blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, label, numbers) as blocks: ids, labels, points and the trees' arrays."""
    for batch in batches:
        width = len(batch.column("numbers")[0]) if batch.num_rows else 0
        for start in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(start, BLOCK)
            flat = rows.column("numbers").flatten().to_numpy(zero_copy_only=False)
            points = flat.reshape(rows.num_rows, width).astype(np.int64)
            trees = [grown(p, LEAF) for p in np.split(points, parts, axis=1)]
            ends = pa.array([0, rows.num_rows], pa.int32())
            out = {
                "ids": pa.ListArray.from_arrays(ends, rows.column("id")),
                "labels": pa.ListArray.from_arrays(ends, rows.column("label")),
                "points": pa.array([points.astype(np.int32).tobytes()]),
                "orders": pa.array([np.stack([t.order for t in trees]).astype(np.int16).tobytes()]),
                "low": pa.array([np.stack([t.low for t in trees]).astype(np.int32).tobytes()]),
                "high": pa.array([np.stack([t.high for t in trees]).astype(np.int32).tobytes()]),
                "sums": pa.array([np.stack([t.sums for t in trees]).tobytes()]),
            }
            yield pa.RecordBatch.from_pydict(out)


def _opened(batch: pa.RecordBatch, row: int, parts: int) -> list[tuple[np.ndarray, Tree]]:
    """The points and the tree of each part position of a block."""

    def array(name: str, dtype) -> np.ndarray:
        return np.frombuffer(batch.column(name)[row].as_buffer(), dtype).astype(np.int64)

    n = len(batch.column("ids")[row])
    points = array("points", np.int32).reshape(n, -1)
    d = points.shape[1] // parts
    orders = array("orders", np.int16).reshape(parts, n)
    low, high, sums = (
        array(name, dtype).reshape(parts, -1, d)
        for name, dtype in (("low", np.int32), ("high", np.int32), ("sums", np.int64))
    )
    depth = (low.shape[1] + 1).bit_length() - 2
    return [
        (points[:, k * d : (k + 1) * d], Tree(orders[k], low[k], high[k], sums[k], depth))
        for k in range(parts)
    ]


def _round(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A task's sum and number of parts per part position and entry."""
    total = [np.zeros_like(b) for b in books]
    number = [np.zeros(len(b), np.int64) for b in books]
    for batch in batches:
        for row in range(batch.num_rows):
            for k, (points, tree) in enumerate(_opened(batch, row, len(books))):
                _, sums, counts, _ = assigned(points, tree, books[k])
                total[k] += sums
                number[k] += counts
    used = [(k, e) for k in range(len(books)) for e in np.flatnonzero(number[k]).tolist()]
    yield pa.RecordBatch.from_pydict(
        {
            "part": pa.array([k for k, _ in used], pa.int32()),
            "entry": pa.array([e for _, e in used], pa.int32()),
            "n": pa.array([int(number[k][e]) for k, e in used], pa.int64()),
            "total": pa.array([total[k][e].tolist() for k, e in used], pa.list_(pa.int64())),
        }
    )


def _coded(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows (id, label, code, error) of blocks, by the final codebooks."""
    for batch in batches:
        for row in range(batch.num_rows):
            codes, error = [], 0
            for k, (points, tree) in enumerate(_opened(batch, row, len(books))):
                code = assigned(points, tree, books[k])[0]
                apart = points - books[k][code]
                error = error + (apart * apart).sum(1)
                codes.append(code)
            flat = np.stack(codes, 1).astype(np.int32)
            ends = np.arange(len(flat) + 1, dtype=np.int32) * len(books)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("ids")[row].values,
                    "label": batch.column("labels")[row].values,
                    "code": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel())),
                    "error": pa.array(error),
                }
            )


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> Codes:
    """Learns the codebooks from all rows and codes all rows with them."""
    x = F.col(vector)
    usable = (F.size(x) > 0) & (F.size(x) % parts == 0) & F.forall(
        x, lambda c: c.isNotNull() & (F.abs(c) < LIMIT)
    )
    numbers = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("int"))
    rows = vectors.filter(x.isNotNull() & usable).select(
        F.col(key).alias("id"), F.col(label).alias("label"), numbers.alias("numbers")
    )
    by_key = [F.asc_nulls_last("id"), F.asc("numbers")]
    least = rows.orderBy(*by_key).select(F.size("numbers")).first()
    width = least[0] if least else parts
    rows = rows.filter(F.size("numbers") == width)
    first = [r["numbers"] for r in rows.orderBy(*by_key).limit(entries).collect()]
    start = np.array(first, np.int64).reshape(len(first), width)
    books = [np.ascontiguousarray(b) for b in np.split(start, parts, axis=1)]

    kind = {f.name: f.dataType for f in rows.schema.fields}
    binary = [T.StructField(c, T.BinaryType()) for c in ("points", "orders", "low", "high", "sums")]
    lists = [
        T.StructField(name, T.ArrayType(kind[of])) for name, of in (("ids", "id"), ("labels", "label"))
    ]
    blocks = stored(
        rows.mapInArrow(lambda b: _blocks(b, parts), T.StructType([*lists, *binary]))
    )
    for _ in range(rounds if first else 0):
        held = books
        summed = (
            blocks.mapInArrow(
                lambda b, held=held: _round(b, held),
                "part int, entry int, n long, total array<long>",
            )
            .groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), *(
                F.sum(F.col("total")[i]).alias(f"c{i}") for i in range(width // parts)
            ))
        )
        books = [b.copy() for b in books]
        for r in summed.collect():
            books[r["part"]][r["entry"]] = [x // r["n"] for x in r[3:]]  # // floors

    final = books
    coded = stored(
        blocks.mapInArrow(
            lambda b: _coded(b, final),
            T.StructType(
                [
                    T.StructField("id", kind["id"]),
                    T.StructField("label", kind["label"]),
                    T.StructField("code", T.ArrayType(T.IntegerType())),
                    T.StructField("error", T.LongType()),
                ]
            ),
        ).withColumn("name", group_key("label"))
    )
    totals = coded.groupBy("name").agg(F.sum("error").alias("label_error"))
    out = coded.join(small(totals), "name").select(
        F.col("id").alias(key), "code", "error", "label_error"
    )
    return Codes(out, [b.tolist() for b in books])
