"""Near-duplicate vectors of one label: spherical k-means cells, blocked cosine products.

Vectors with equal label and equal direction, bit for bit, are one class with so many
copies; classes are compared, so copies cost one row of counting each. Centers are fitted
by a few rounds of spherical k-means on a sample of at most ``SAMPLE`` classes per cell
and ``MOST_CELLS`` cells; every class is assigned.

The cells lose no pair. A class is homed in the cell of its nearest center. If x is homed
at center c and y at c', and their angle is at most t = acos(``LEAST``), then y lies beyond
the plane that halves c and c', so x lies within sin t of that plane:
(x.c - x.c') / |c - c'| <= sin t. So x also visits every later cell c' for which this
holds, and any pair meets in the later of its two homes. Vectors without structure visit
many cells; results stay whole, the work then grows faster than their number.

The members of a cell, label by label, come in blocks of about ``BLOCK`` by a hash, and a
task compares two blocks as one product of matrices. It emits per class the number of
vectors linked and one root of its linked classes, never pairs, so a block of copies that
all differ in a bit costs as many rows as it has members.

A vector that is null, empty, zero, or holds a null or non-finite component, or whose label
or id is null, links with nothing and is kept. Vectors of different lengths aren't
compared. Rows that repeat an id are vectors of their own, ``component_id`` being the least
id reached. An empty table gives no rows. Only the three named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import group_key, hash_order, small, stored
from .components import components
from .vectors import matrices, stacked

LEAST = 0.98
REACH = (1 - LEAST * LEAST) ** 0.5 + 1e-9  # sine of the greatest angle of a link
PER_CELL, MOST_CELLS = 1024, 4096  # classes of the largest label in a cell; cells
SAMPLE, ROUNDS = 32, 4  # sampled classes per cell; rounds of k-means
BLOCK = 2048
_PRODUCTS = 1 << 20  # held at once
_CLASS = T.StructType(
    [T.StructField("node", T.BinaryType()), T.StructField("unit", T.BinaryType())]
)


def units(vectors: pa.Array, labels: pa.Array) -> pa.Array:
    """Of each vector its class and its unit vector; null where it can't be compared."""
    names = labels.to_pylist()
    rows: list[dict | None] = [None] * len(names)
    for at, x in matrices(vectors):
        most = np.abs(x).max(1, initial=0.0)  # NaN stays NaN
        good = np.isfinite(most) & (most > 0)
        with np.errstate(all="ignore"):
            # Scaled by a power of two, which is exact, only where squares would leave
            # the range of doubles.
            far = good & ((most > 1e150) | (most < 1e-150))
            x[far] /= np.exp2(np.floor(np.log2(most[far])))[:, None]
            x = x / np.sqrt((x * x).sum(1))[:, None] + 0.0  # no negative zeros
        for i in np.flatnonzero(good):
            if names[at[i]] is not None:
                raw = x[i].tobytes()
                node = xxhash.xxh3_128_digest(names[at[i]].encode() + b"\0" + raw)
                rows[at[i]] = {"node": node, "unit": raw}
    return pa.array(rows, pa.struct([("node", pa.binary()), ("unit", pa.binary())]))


def _nearest(x: np.ndarray, centers: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Products with all centers, some rows at a time."""
    step = max(1, _PRODUCTS // len(centers))
    for start in range(0, len(x), step):
        rows = slice(start, start + step)
        yield rows, x[rows] @ centers.T


def _by_width(rows: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = np.array([len(r) for r in rows], np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.frombuffer(b"".join(rows[i] for i in at), np.float64).reshape(len(at), -1)


def _fitted(sample: DataFrame, k: int, width: int) -> np.ndarray:
    """Centers after some rounds on the sample; sums come from the tasks. Which centers
    come out affects the work only, not the result."""
    first = sample.orderBy(hash_order(F.col("node"))).limit(k).select("unit").collect()
    if len(first) < 2:
        return np.empty((0, width))
    centers = np.array([np.frombuffer(r["unit"], np.float64) for r in first])

    def sums(batches: Iterator[pa.RecordBatch], centers: np.ndarray) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centers), width))
        for batch in batches:
            x = stacked(batch.column("unit")) if batch.num_rows else np.empty((0, width))
            for rows, product in _nearest(x, centers):
                np.add.at(total, product.argmax(1), x[rows])
        cell, at = np.nonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"cell": pa.array(cell), "at": pa.array(at), "x": pa.array(total[cell, at])}
        )

    for _ in range(ROUNDS):
        held = centers
        parts = sample.select("unit").mapInArrow(
            lambda batches, held=held: sums(batches, held), "cell long, at long, x double"
        )
        total = np.zeros_like(centers)
        for r in parts.groupBy("cell", "at").agg(F.sum("x").alias("x")).collect():
            total[r["cell"], r["at"]] = r["x"]
        size = np.sqrt((total * total).sum(1))
        moved = size > 1e-9
        centers = np.where(moved[:, None], total / np.where(moved, size, 1)[:, None], centers)
    return np.unique(centers, axis=0)


def visited(centers: dict[int, np.ndarray]):
    """A function from unit vectors to their cells: the home, then later ones that may be
    the home of a vector linked with it. Centers by the length of a vector; vectors of a
    length without centers share one cell."""

    def cells(raw: pa.Array) -> pa.Array:
        rows = raw.to_pylist()
        out: list[list[int]] = [[0]] * len(rows)
        for places, x in _by_width(rows):
            own = centers.get(x.shape[1])
            if own is None or len(own) < 2:
                continue
            for part, product in _nearest(x, own):
                home = product.argmax(1)
                gap = np.maximum(2 - 2 * (own[home] @ own.T), 0) ** 0.5
                margin = product[np.arange(len(home)), home][:, None] - product
                visit = margin <= REACH * gap + 1e-12
                visit &= np.arange(len(own)) > home[:, None]
                for i, h, v in zip(places[part], home, visit):
                    out[i] = [int(h), *np.flatnonzero(v).tolist()]
        return pa.array(out, pa.list_(pa.int32()))

    return cells


def compared(group: pa.Table) -> pa.Table:
    """One row for each class of two blocks (or one) that has a link: the vectors it is
    linked with, and the first class that links reach from it within the blocks."""
    x, n = stacked(group["unit"]), group["n"].to_numpy()
    guest, block = group["guest"].to_numpy(), group["block"].to_numpy()
    crossed = group["low"][0].as_py() != group["high"][0].as_py()
    links, root = np.zeros(len(x), np.int64), np.arange(len(x))
    step = max(1, _PRODUCTS // len(x))
    for start in range(0, len(x), step):
        rows = np.arange(start, min(start + step, len(x)))[:, None]
        linked = x[rows[:, 0]] @ x.T >= LEAST
        linked &= rows < np.arange(len(x))
        linked &= ~(guest[rows] & guest)
        if crossed:
            linked &= block[rows] != block
        i, j = np.nonzero(linked)
        i += start
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        while len(i):  # roots of linked classes become one, the lesser
            a, b = root[i], root[j]
            apart = a != b
            i, j = i[apart], j[apart]
            np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
            while (root != root[root]).any():
                root = root[root]
    some = np.flatnonzero(links)
    nodes = group["node"].combine_chunks()
    return pa.table(
        {"node": nodes.take(pa.array(some)), "links": pa.array(links[some]),
         "root": nodes.take(pa.array(root[some]))}
    )


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row a vector: the key, ``n_links`` (other vectors with a cosine of at least
    ``LEAST``), ``component_id`` (the least id that links reach) and ``kept`` (whether that
    is its own)."""
    udf = F.arrow_udf
    name = F.when(
        F.col(label).isNotNull() & F.col(key).isNotNull(), group_key(label)
    )
    base = stored(
        vectors.select(
            F.col(key).alias("id"),
            name.alias("name"),
            udf(units, _CLASS).asNondeterministic()(vector, name).alias("class"),
        ).select("id", "name", "class.node", "class.unit")
    )
    classes = stored(
        base.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("id").alias("rep"),
            F.count("*").alias("n"),
            F.first("name").alias("name"),
            F.first("unit").alias("unit"),
        )
    )
    out = stored(_compared(classes))
    reached = components(out.select("node", "root"))
    links = out.groupBy("node").agg(F.sum("links").alias("links"))
    linked = (
        classes.select("node", "rep", "n")
        .join(links, "node", "left")
        .join(reached, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    linked = stored(linked)
    least = (
        linked.filter(F.col("links") > 0)
        .groupBy("component")
        .agg(F.min("rep").alias("component_id"))
    )
    found = linked.join(small(least), "component", "left").select(
        "node",
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    return (
        base.select("id", "node")
        .join(found, "node", "left")
        .select(
            F.col("id").alias(key),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(True)))
    )


def _compared(classes: DataFrame) -> DataFrame:
    # A cell should hold PER_CELL classes of the largest label.
    per_width = (
        classes.groupBy(F.octet_length("unit").alias("bytes"), "name")
        .count()
        .groupBy("bytes")
        .agg(F.max("count").alias("most"), F.sum("count").alias("n"))
        .filter(F.col("most") > PER_CELL)
        .orderBy(F.desc("n"))
        .limit(4)  # lengths beyond these are compared in blocks alone
        .collect()
    )
    centers = {}
    for r in per_width:
        k = min(-(-r["most"] // PER_CELL), MOST_CELLS)
        share = min(1.0, SAMPLE * k / r["n"])
        sample = classes.filter(F.octet_length("unit") == r["bytes"])
        sample = sample.filter(hash_order(F.col("node")) <= int(((1 << 62) - 1) * share))
        centers[r["bytes"] // 8] = _fitted(stored(sample), k, r["bytes"] // 8)

    cells = F.arrow_udf(visited(centers), T.ArrayType(T.IntegerType()))
    members = classes.select(
        "node", "n", "name", "unit", F.octet_length("unit").alias("bytes"),
        F.posexplode(cells("unit")).alias("place", "cell"),
    ).withColumn("guest", F.col("place") > 0)
    members = stored(members.drop("place"))
    cell = ["name", "bytes", "cell"]
    sizes = members.groupBy(*cell).agg(F.count("*").alias("size"))
    sizes = sizes.filter(F.col("size") > 1)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    return (
        members.join(small(sizes), cell)
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select(*cell, "low", "high", "node", "n", "unit", "guest", "block")
        .groupBy(*cell, "low", "high")
        .applyInArrow(compared, "node binary, links long, root binary")
    )
