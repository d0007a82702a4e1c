"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A document's set holds its runs of ``WORDS`` words (its whole sequence if it has fewer).
Documents with equal sets are one class. A signature has ``SYMBOLS`` minimum hashes of 16
bits.

The index cuts the symbols into chunks of ``CHUNK``. Two signatures that differ in fewer
than 2 * SYMBOLS / CHUNK symbols have, by pigeonhole, a chunk with at most one error; so
each chunk is indexed once for each symbol that may be wrong, by the other symbols. Any
pair within that distance meets in a bucket. (A pair as little alike as links allow still
meets in one with a chance above 0.999998.)

Pairs in a bucket aren't all emitted. First every member is compared with the bucket's
least member; most groups of copies become one component. Then buckets that still hold
several components, in blocks of bounded size, emit pairs of different components, each
pair in its first common bucket only. There a bitmap of each set, of eight bits or more a
shingle, bounds the intersection from above: each bit that only one of the two has set is
a shingle the other lacks. Pairs that sizes or bitmaps exclude, which is certain, are left
out; all others are confirmed on the full sets: 100 * intersection >= 75 * union.

Documents without words, or with a null text, have an empty set, link with nothing and are
kept. A row with a null id links with nothing. Rows that repeat an id each have their own
set, so an id with several texts is in the group of each; each row gets a row of the
result, ``component_id`` being the least id that its set reaches. An empty table gives no
rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, small, stored
from .components import components

WORDS = 5
SHARE = 75  # per cent of the union that the intersection must be
SYMBOLS, CHUNK = 40, 4
BLOCK = 1024
_PAIRS = 1 << 17  # looked at together
_CELLS = 4096  # rows of blocks handled together
_BYTES = 1 << 23  # of bitmaps looked at together
_RNG = np.random.default_rng(9)
_FACTORS = _RNG.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHAPE = pa.struct(
    [("n_shingles", pa.int64()), ("set_hash", pa.binary()), ("signature", pa.binary())]
)


def shingles(raw: bytes) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    last = max(len(words) - WORDS, 0)
    starts = [0, *ends[:last].tolist()]
    stops = (ends[len(words) - 1 - last :] - 1).tolist()
    digest = xxhash.xxh3_64_intdigest
    found = {digest(text[a:b]) for a, b in zip(starts, stops)}
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def signature(found: np.ndarray) -> bytes:
    """Symbols as 16-bit numbers."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), 4096):
        np.minimum(least, (found[k : k + 4096, None] * _FACTORS).min(0), out=least)
    return ((least * _MIX) >> np.uint64(48)).astype(np.uint16).tobytes()


def _signed(texts: pa.Array) -> pa.Array:
    rows = []
    for raw in texts.cast(pa.binary()).to_pylist():
        found = shingles(raw or b"")
        some = len(found) > 0
        rows.append(
            {
                "n_shingles": len(found),
                "set_hash": xxhash.xxh3_128_digest(found.tobytes()) if some else None,
                "signature": signature(found) if some else None,
            }
        )
    return pa.array(rows, _SHAPE)


def _symbols(signatures: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint16).reshape(-1, SYMBOLS)


def _keys(signatures: pa.Array) -> pa.Array:
    """Of each signature the index keys: variant (chunk and symbol left out), symbols."""
    symbols = _symbols(signatures.to_pylist()).astype(np.int64)
    columns = []
    for variant in range(SYMBOLS):
        chunk = variant - variant % CHUNK
        key = np.full(len(symbols), variant, np.int64)
        for at in range(chunk, chunk + CHUNK):
            if at != variant:
                key = key << 16 | symbols[:, at]
        columns.append(key)
    flat = np.stack(columns, 1).ravel()
    offsets = np.arange(0, len(flat) + 1, SYMBOLS, dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(flat))


def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether sets have enough in common."""
    out = []
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(100 * both >= SHARE * (len(x) + len(y) - both))
    return pa.array(out, pa.bool_())


def bitmap(found: np.ndarray) -> bytes:
    """A bit for each range of the hashes, set where the set has one: 8 to 16 bits a hash,
    a power of two in all."""
    width = max(len(found) - 1, 7).bit_length() + 3
    bits = np.zeros(1 << width, bool)
    bits[found >> np.uint64(64 - width)] = True
    return np.packbits(bits).tobytes()


def _able(maps: list[bytes], sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) may be linked by their bitmaps. Sizes that may be linked have
    bitmaps of equal length, or one twice as long, which is folded."""
    widths = np.array([len(m) for m in maps])
    out = np.zeros(len(i), bool)
    for width in np.unique(np.minimum(widths[i], widths[j])):
        some = np.flatnonzero(np.minimum(widths[i], widths[j]) == width)
        rows = np.unique(np.concatenate([i[some], j[some]]))
        bits = np.empty((len(rows), width), np.uint8)
        for k, row in enumerate(rows):
            own = np.frombuffer(maps[row], np.uint8)
            if len(own) > width:
                own = np.packbits(np.unpackbits(own).reshape(-1, 2).any(1))
            bits[k] = own
        step = max(1, _BYTES // int(width))
        for start in range(0, len(some), step):
            at = some[start : start + step]
            a, b = i[at], j[at]
            x, y = bits[np.searchsorted(rows, a)], bits[np.searchsorted(rows, b)]
            lacks = np.bitwise_count(x & ~y).sum(1, dtype=np.int64)
            lacked = np.bitwise_count(y & ~x).sum(1, dtype=np.int64)
            both = np.minimum(sizes[a] - lacks, sizes[b] - lacked)
            out[at] = (100 + SHARE) * both >= SHARE * (sizes[a] + sizes[b])
    return out


def _first_common(symbols: np.ndarray, variant: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) of a variant's bucket have no earlier variant in common."""
    chunk, left_out = divmod(variant, CHUNK)
    first = np.ones(len(i), bool)
    if left_out:  # with that symbol equal too, the chunk's first variant is common
        first = symbols[i, variant] != symbols[j, variant]
    if chunk:
        at = np.flatnonzero(first)
        width = chunk * CHUNK
        same = symbols[i[at], :width] == symbols[j[at], :width]
        first[at] = (same.reshape(len(at), chunk, CHUNK).sum(2) < CHUNK - 1).all(1)
    return first


def _cross_pairs(group: pa.Table) -> pa.Table:
    """Pairs of blocks worth confirming: of different components, in their first common
    bucket, not excluded by sizes or bitmaps. A group holds the blocks of several
    buckets."""
    keys, low, high, ids, labels, sizes, block = (
        group[c].to_numpy()
        for c in ("key", "low", "high", "rep", "label", "n_shingles", "block")
    )
    symbols = _symbols(group["signature"].to_pylist())
    maps = group["bits"].to_pylist()
    order = np.lexsort((high, low, keys))
    cells = np.stack([keys[order], low[order], high[order]])
    cuts = np.flatnonzero((cells[:, 1:] != cells[:, :-1]).any(0)) + 1
    found_a, found_b = [], []
    for run in np.split(order, cuts):
        variant = int(keys[run[0]]) >> 16 * (CHUNK - 1)
        crossed = low[run[0]] != high[run[0]]
        step = max(1, _PAIRS // len(run))
        for start in range(0, len(run), step):
            rows = run[start : start + step, None]
            apart = labels[rows] != labels[run]
            apart &= np.arange(start, start + len(rows))[:, None] < np.arange(len(run))
            if crossed:
                apart &= block[rows] != block[run]
            large, less = np.maximum(sizes[rows], sizes[run]), np.minimum(sizes[rows], sizes[run])
            i, j = np.nonzero(apart & (SHARE * large <= 100 * less))
            i, j = run[i + start], run[j]
            first = _first_common(symbols, variant, i, j)
            i, j = i[first], j[first]
            able = _able(maps, sizes, i, j)
            found_a.append(ids[i[able]])
            found_b.append(ids[j[able]])
    return pa.table({"a": np.concatenate(found_a), "b": np.concatenate(found_b)})


def _udf(function, kind):
    return F.arrow_udf(function, kind)


_SET = T.StructType(
    [T.StructField("set", T.BinaryType()), T.StructField("of", T.BinaryType())]
)


def _packed(texts: pa.Array) -> pa.Array:
    rows = []
    for raw in texts.cast(pa.binary()).to_pylist():
        held = shingles(raw or b"").tobytes()
        rows.append({"set": held, "of": xxhash.xxh3_128_digest(held)})
    return pa.array(rows, pa.struct([("set", pa.binary()), ("of", pa.binary())]))


def _sets(docs: DataFrame, key: str, text: str, reps: DataFrame, classes: DataFrame) -> DataFrame:
    """(rep, set) of some classes, read from the text of their least id. An id may have
    several texts; the set's hash tells the one that is meant."""
    wanted = small(reps.join(classes.select("rep", "least", "set_hash"), "rep"))
    found = docs.join(wanted, F.col(key) == F.col("least")).select(
        "rep", "set_hash", _udf(_packed, _SET).asNondeterministic()(text).alias("p")
    )
    found = found.filter(F.col("p.of") == F.col("set_hash"))
    return stored(found.groupBy("rep").agg(F.first("p.set").alias("set")))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are linked."""
    linked = _udf(_linked, T.BooleanType())
    return (
        pairs.join(sets.toDF("a", "set_a"), "a")
        .join(sets.toDF("b", "set_b"), "b")
        .filter(linked("set_a", "set_b"))
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: the key, ``n_shingles``, ``component_id`` (the least id that
    links reach) and ``kept`` (whether that is its own)."""
    signed = _udf(
        _signed,
        T.StructType(
            [
                T.StructField("n_shingles", T.LongType()),
                T.StructField("set_hash", T.BinaryType()),
                T.StructField("signature", T.BinaryType()),
            ]
        ),
    )
    docs = docs.select(key, text)
    base = docs.withColumn("s", signed.asNondeterministic()(text)).select(key, "s.*")
    base = stored(base)
    classes = (
        base.filter(F.col(key).isNotNull() & F.col("set_hash").isNotNull())
        .groupBy("set_hash")
        .agg(
            F.min(key).alias("least"),
            *(F.first(c).alias(c) for c in ("n_shingles", "signature")),
        )
        .withColumn("rep", F.monotonically_increasing_id())  # settled by being stored
    )
    classes = stored(classes)
    members = stored(_members(classes))
    pairs = stored(_star_pairs(members))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    reached = components(_confirmed(pairs, _sets(docs, key, text, ends, classes)))
    more = _cross_links(members, classes, reached, docs, key, text)
    reached = stored(components(reached.toDF("a", "b").union(more)))
    linked = classes.select("set_hash", "rep", "least").join(
        reached, F.col("rep") == F.col("node"), "left"
    )
    least = (
        reached.join(classes.select("rep", "least"), F.col("rep") == F.col("node"))
        .groupBy("component")
        .agg(F.min("least").alias("component_id"))
    )
    found = linked.join(small(least), "component", "left").select(
        "set_hash", F.coalesce("component_id", "least").alias("component_id")
    )
    own = fresh(base, "component_id")
    return own.join(found, "set_hash", "left").select(
        key,
        "n_shingles",
        F.when(F.col(key).isNull(), F.col(key))
        .otherwise(F.coalesce("component_id", key))
        .alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(True)))


def _members(classes: DataFrame) -> DataFrame:
    """(key, rep, size, center, n) of every member of a bucket with several; the center
    is the least member and its size."""
    keys = _udf(_keys, T.ArrayType(T.LongType()))
    each = classes.select(
        "rep", F.col("n_shingles").alias("size"), F.explode(keys("signature")).alias("key")
    )
    centers = each.groupBy("key").agg(
        F.min(F.struct("rep", "size")).alias("center"), F.count("*").alias("n")
    )
    return each.join(centers.filter(F.col("n") > 1), "key")


def _star_pairs(members: DataFrame) -> DataFrame:
    """Members of a bucket and its least one, where sizes allow a link."""
    sizes = (F.col("size"), F.col("center.size"))
    able = SHARE * F.greatest(*sizes) <= 100 * F.least(*sizes)
    pairs = members.filter((F.col("rep") != F.col("center.rep")) & able)
    return pairs.select(F.col("rep").alias("a"), F.col("center.rep").alias("b")).distinct()


def _cross_links(members, classes, reached, docs, key, text) -> DataFrame:
    """Links between different components within buckets, beside those to centers."""
    label = F.coalesce("component", "rep")
    # The center has been compared with all, so two others are needed.
    others = stored(
        members.filter((F.col("n") > 2) & (F.col("rep") != F.col("center.rep")))
        .join(reached, F.col("rep") == F.col("node"), "left")
        .select("key", "rep", "n", label.alias("label"))
    )
    mixed = others.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    mixed = mixed.filter(F.col("x") != F.col("y")).select("key")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mixed = stored(others.join(mixed, "key"))
    sets = _sets(docs, key, text, mixed.select("rep").distinct(), classes)
    bits = _udf(
        lambda raw: pa.array(
            [bitmap(np.frombuffer(r, np.uint64)) for r in raw.to_pylist()], pa.binary()
        ),
        T.BinaryType(),
    )
    blocked = stored(
        mixed
        .withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other", "n")
    )
    held = classes.select("rep", "n_shingles", "signature").join(
        sets.select("rep", bits("set").alias("bits")), "rep"
    )
    held = stored(held)
    # Groups of about so many rows and bytes.
    long = held.agg(F.avg(F.octet_length("bits"))).first()[0] or 0
    groups = F.lit(int(blocked.count() * max(1, long / 4096)) // _CELLS + 1)
    pairs = (
        blocked.join(held, "rep")
        .groupBy(F.pmod(F.xxhash64("key", "low", "high"), groups))
        .applyInArrow(_cross_pairs, "a long, b long")
    )
    return _confirmed(stored(pairs), sets)
