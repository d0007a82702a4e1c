"""Vector codes and near-duplicate vectors against plain computations; edge cases."""

import math
import random
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from widerow.llm import vector_codes, vector_dedup  # noqa: E402
from widerow.llm.vector_codes import LEAF, assigned, compress, grown  # noqa: E402
from widerow.llm.vector_dedup import near_vectors, visited  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int"


def near_rows(n, d, seed):
    """Vectors with copies, near copies at all distances about the limit, and scaled ones."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = rng.integers(6)
        base = np.array(rows[rng.integers(len(rows))][1]) if rows and kind < 4 else rng.normal(size=d)
        if kind in (1, 2):
            base = base + rng.normal(size=d) * rng.uniform(0.01, 0.4) * np.linalg.norm(base) / d**0.5
        if kind == 3:
            base = base * 4.0
        rows.append((i, base.tolist(), int(rng.integers(3))))
    return rows


def plain_links(rows):
    """Links, components and kept ids by comparing all pairs."""
    good = []
    for at, (key, vector, label) in enumerate(rows):
        if key is None or label is None or not vector:
            continue
        if any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        good.append((at, np.array(vector), label))
    near = defaultdict(set)
    for a, x, p in good:
        for b, y, q in good:
            if a != b and p == q and len(x) == len(y):
                cosine = float(x @ y) / (float(x @ x) ** 0.5 * float(y @ y) ** 0.5)
                if cosine >= vector_dedup.LEAST:
                    near[a].add(b)
    out = []
    for at, (key, _, _) in enumerate(rows):
        reached, open_ = {at}, [at]
        while open_:
            for b in near[open_.pop()] - reached:
                reached.add(b)
                open_.append(b)
        least = None if key is None else min(rows[b][0] for b in reached)
        out.append((key, len(near[at]), least, key is None or least == key))
    return sorted(out, key=str)


def got_links(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, near_vectors(df).collect()), key=str)


@pytest.mark.parametrize("block", [7, 2048])
def test_near_vectors_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    monkeypatch.setattr(vector_dedup, "PER_CELL", 20)
    rows = near_rows(400, 6, 1)
    expected = plain_links(rows)
    assert sum(n for _, n, _, _ in expected) > 100
    assert got_links(spark, rows) == expected


def test_near_vectors_edges(spark):
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [None, 1.0], 1),
        (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1), (None, [1.0, 2.0], 1),
        (7, [1.0, 2.0], None), (8, [1.0, 2.0], 1), (9, [1.0, 2.0], 1), (9, [1.0, 2.0], 1),
        (10, [1.0, 2.0], 2), (11, [2.0, 4.0], 1), (12, [1.0, 2.0, 0.0], 1),
        (13, [1e200, 1e200], 4), (14, [1e-200, 1e-200], 4), (15, [-0.0, 3.0], 5), (16, [0.0, 3.0], 5),
        (20, [1.0, 0.0], 6), (20, [0.0, 1.0], 6), (21, [0.0, 1.0], 6),
    ]
    got = got_links(spark, rows)
    by_id = defaultdict(list)
    for key, *rest in got:
        by_id[key].append(tuple(rest))
    for key in (1, 2, 3, 4, 5, 6, 7, 10, 12):
        assert by_id[key] == [(0, key, True)]
    assert by_id[None] == [(0, None, True)]
    assert by_id[8] == [(3, 8, True)] and by_id[9] == [(3, 8, False)] * 2
    assert by_id[11] == [(3, 8, False)]
    assert by_id[13] == [(1, 13, True)] and by_id[14] == [(1, 13, False)]
    assert by_id[15] == [(1, 15, True)] and by_id[16] == [(1, 15, False)]
    assert sorted(by_id[20]) == [(0, 20, True), (1, 20, True)] and by_id[21] == [(1, 20, False)]
    assert got_links(spark, []) == []


def test_near_vectors_clashing_columns(spark):
    names = "node unit n name id rep links component low high block guest".split()
    df = spark.createDataFrame(near_rows(60, 4, 2), SCHEMA)
    more = df.select("*", *(F.lit("clash").alias(c) for c in names))
    assert sorted(near_vectors(more).collect()) == sorted(near_vectors(df).collect())


def test_a_group_of_differing_copies_links_whole(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 32)
    rng = np.random.default_rng(3)
    base = rng.normal(size=8)
    rows = [(i, (base + rng.normal(size=8) * 1e-4).tolist(), 0) for i in range(300)]
    got = got_links(spark, rows)
    assert all(r[1:] == (299, 0, r[0] == 0) for r in got)


def test_linked_vectors_meet_in_a_cell():
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(50, 5))
    centers /= np.linalg.norm(centers, axis=1, keepdims=True)
    x = rng.normal(size=(3000, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    import pyarrow as pa

    cells = visited({5: centers})(pa.array([r.tobytes() for r in x])).to_pylist()
    linked = np.argwhere(np.triu(x @ x.T >= vector_dedup.LEAST, 1))
    assert len(linked) > 500
    apart = 0
    for i, j in linked:
        later = max(cells[i][0], cells[j][0])
        apart += cells[i][0] != cells[j][0]
        assert later in cells[i] and later in cells[j]
    assert apart > 100


def plain_codes(rows, parts, entries, rounds):
    """Lloyd in whole numbers, entry by entry."""
    kept = [
        (key, label, [math.floor(4096 * x) for x in vector])
        for key, vector, label in rows
        if vector and all(x is not None and abs(x) < vector_codes.LIMIT for x in vector)
    ]
    kept = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    d = len(kept[0][2]) // parts
    pieces = [[r[2][k * d : (k + 1) * d] for r in kept] for k in range(parts)]
    books = [[list(p) for p in pieces[k][:entries]] for k in range(parts)]

    def nearest(p, book):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            groups = defaultdict(list)
            for p in pieces[k]:
                groups[nearest(p, books[k])[1]].append(p)
            for i, g in groups.items():
                books[k][i] = [sum(c) // len(g) for c in zip(*g)]
    out, by_label = [], defaultdict(int)
    for at, (key, label, _) in enumerate(kept):
        found = [nearest(pieces[k][at], books[k]) for k in range(parts)]
        out.append((key, label, [i for _, i in found], sum(e for e, _ in found)))
        by_label[label] += out[-1][3]
    return books, sorted(((k, c, e, by_label[lab]) for k, lab, c, e in out), key=str)


@pytest.mark.parametrize("n,parts,entries,block", [(300, 2, 5, 64), (90, 4, 16, 2048), (7, 2, 16, 2048)])
def test_codes_match_plain_lloyd(spark, monkeypatch, n, parts, entries, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rng = random.Random(n)
    rows = []
    for i in range(n):  # few values, so that ties are common
        vector = [rng.choice([-0.5, -0.0001, 0.0, 0.25, 0.250001, 1.0]) for _ in range(8)]
        rows.append((rng.randrange(n), vector, rng.choice([None, 1, 2])))
    got = compress(spark.createDataFrame(rows, SCHEMA), parts=parts, entries=entries, rounds=4)
    books, expected = plain_codes(rows, parts, entries, 4)
    assert got.codebooks == books
    assert sorted((tuple(r) for r in got.rows.collect()), key=str) == expected


def test_trees_assign_whole_nodes():
    """Equal to trying all entries, and clustered parts aren't settled one by one."""
    rng = np.random.default_rng(5)
    middles = rng.integers(-(10**6), 10**6, (16, 3))
    points = middles[rng.integers(16, size=2000)] + rng.integers(-1000, 1000, (2000, 3))
    for entries in (middles, middles[:5], middles[:1], np.concatenate([middles[:8]] * 2)):
        apart = points[:, None] - entries
        expected = (apart * apart).sum(2).argmin(1)
        codes, sums, counts, whole = assigned(points, grown(points, LEAF), entries)
        assert (codes == expected).all()
        assert (counts == np.bincount(expected, minlength=len(entries))).all()
        for e in range(len(entries)):
            assert (sums[e] == points[expected == e].sum(0)).all()
        if len(entries) == 16 and len(np.unique(entries, axis=0)) == 16:
            assert whole > 1000


def test_codes_edges(spark):
    good = [(i, [0.1 * i, -0.2, 0.3, 0.4], i % 2) for i in range(1, 6)]
    bad = [
        (0, None, 1), (0, [], 1), (0, [1.0, 2.0, 3.0], 1), (-1, [None] * 4, 1),
        (-1, [float("nan")] * 4, 1), (-1, [float("-inf")] * 4, 1), (9, [1.0] * 8, 1),
        (-1, [1e300] * 4, 1),
    ]
    df = spark.createDataFrame(good + bad, SCHEMA).select("*", F.lit("clash").alias("id"))
    got = compress(df, parts=2)
    books, expected = plain_codes(good, 2, 16, 6)
    assert got.codebooks == books
    assert sorted(map(tuple, got.rows.collect())) == expected
    none = compress(df.limit(0))
    assert none.rows.collect() == [] and none.codebooks == [[]] * 8
