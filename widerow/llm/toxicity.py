"""Toxicity by the nearest labelled examples.

Examples are a bounded sample of labelled documents; of those with equal words and equal
label one is kept. A vector is the TF-IDF over all words of its text, of length 1. Words
that depend on the label weigh more: with G the log-likelihood ratio of word and label, a
word's weight is (G / (G + ``DOUBT``))^2 and ``LEAST_WEIGHT`` on top, so that none is left
out and long neutral texts aren't nearest to each other by chance.

Texts are looked up in batches. Words are of three kinds. The few that many examples hold
are one product of matrices for a batch. Light ones, whose lists are long for the little
they add to any vector, have no lists at all: how much they can add to a score is bounded
by their length in the text times that in the example, band by band, which is a product of
matrices, too. The others have inverted lists, which are read whole. The examples best by
that give a threshold, those whose bound reaches it get their light words' sum, and the few
that can still be among the best are scored exactly. The result is that of scoring all
examples.

Neighbours vote with weights that fall with their distance. A rising curve, fitted on the
examples' own votes with each left out of its own, turns votes into the share of toxic
documents. The nearest examples are the evidence.

The index is broadcast: it holds at most ``MAX_EXAMPLES`` vectors (in expectation, as rows
are chosen by a hash) and ``MAX_ENTRIES`` words of vectors; where long texts exceed those,
the rows with the least hashes stay. Scoring is one pass without a shuffle; the examples'
own votes are taken in tasks, too. A text without a word of any example has no neighbours,
and its vote is the average example's. Null and empty texts have no terms. Without any
example every score is 0. Equal texts get equal scores.
Columns of the input named like added ones are replaced.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, isotonic, labelled_sample, stored

MAX_EXAMPLES = 20_000
MAX_ENTRIES = 12_000_000  # words of all examples' vectors
# Chosen by five-fold cross-validation within the rows that labels may be learnt from.
DOUBT = 20.0  # log-likelihood ratio at which a word has a quarter of the full weight
LEAST_WEIGHT = 0.01
NEIGHBOURS = 15
BLOCK = 256  # groups of examples, whose greatest scores give a threshold
EVIDENCE = 3
PRIOR = 1.0  # votes of the average example added to each vote
_NEAREST = 0.05  # distances below count as this
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
_BREAKS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_HEADS = 8  # heaviest words by which examples are put in order
_COMMON = 8  # words held by one example in so many have a whole row instead of a list
_TOGETHER = 48  # texts looked up at once
_LIGHT = 0.01  # of the vectors' squared lengths, in the mean: what light words may hold
_SMALL = 1 << 18  # multiplications in a product
_PIECE = 16  # examples in a product of matrices
_FEW = 64  # vectors scored exactly at once
_BANDS = 16  # of light words by the number of examples that hold them
_SLACK = 1e-5  # above the rounding errors of sums in single precision
_PARTS = 1024  # of the hashes' range, in which rows are cut to MAX_ENTRIES


def words_of(text: str) -> list[str]:
    """``_WORD.findall(text.lower())``: cut where ASCII has no word, and by the pattern only
    what other characters may cut."""
    lower = text.lower()
    raw = lower.encode("utf-8", "surrogatepass").translate(_BREAKS)
    parts = raw.decode("utf-8", "surrogatepass").split()
    if lower.isascii():
        return parts
    words = []
    for part in parts:
        if part.isalnum():
            words.append(part)
        else:
            words += _WORD.findall(part)
    return words


def _spans(starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all entries of the lists ``at``, and the lists' lengths."""
    first, sizes = starts[at], starts[at + 1] - starts[at]
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first - before, sizes), sizes


def head_order(starts, terms, weights) -> np.ndarray:
    """The vectors' order in the index: by their heaviest terms. Of equal neighbours the
    first in it is taken."""
    n = len(starts) - 1
    rows = np.repeat(np.arange(n), np.diff(starts))
    by = np.lexsort((terms, -weights, rows))
    rank = np.arange(len(rows)) - starts[rows]
    heads = np.full((n, _HEADS), terms.max(initial=-1) + 1)
    head = rank < _HEADS
    heads[rows[head], rank[head]] = terms[by][head]
    return np.lexsort((np.arange(n), *heads.T[::-1]))


class Index:
    """An inverted index of unit vectors {term: weight}, with bounds for light terms."""

    def __init__(self, vectors: list[dict[int, float]], block: int = BLOCK):
        starts = np.cumsum([0, *map(len, vectors)])
        terms = np.fromiter((t for v in vectors for t in v), np.int64, starts[-1])
        weights = np.fromiter((w for v in vectors for w in v.values()), float, starts[-1])
        self._build(starts, terms, weights, block)

    def _build(self, starts, terms, weights, block) -> None:
        order = head_order(starts, terms, weights)
        found, sizes = _spans(starts, order)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        self._post(order, starts, terms[found], weights[found], block)

    @classmethod
    def ordered(cls, ids, starts, terms, weights, block: int = BLOCK) -> Index:
        """Of vectors already in the index's order, ids being their names."""
        index = cls.__new__(cls)
        index._post(ids, starts, terms, weights, block)
        return index

    def _post(self, ids, starts, terms, weights, block) -> None:
        n, self.size, self.block = len(starts) - 1, int(terms.max(initial=-1)) + 1, block
        self.ids, self.place = ids, np.argsort(ids)
        self.starts, self.terms, self.weights = starts, terms.astype(np.int32), weights
        rows = np.repeat(np.arange(n, dtype=np.int32), np.diff(starts))
        number = np.bincount(self.terms, minlength=self.size)
        mass = np.bincount(self.terms, weights * weights, self.size)
        common = number * _COMMON > n
        light = _light_terms(number, mass, ~common & (number > 0), n)
        step = math.lcm(block, _PIECE)
        width = -(-n // step) * step
        # A common term's row, a light one's band below -1, and -1 for one with a list.
        self.kind = np.full(self.size, -1, np.int32)
        self.kind[common] = np.arange(common.sum())
        self.kind[light] = -2 - np.minimum(_BANDS - 1, np.log2(number[light]).astype(int))
        kind = self.kind[self.terms]
        own = np.flatnonzero(kind >= 0)
        at = rows[own]
        self.rows = np.zeros((width // _PIECE, common.sum(), _PIECE), np.float32)
        self.rows[at // _PIECE, kind[own], at % _PIECE] = weights[own]
        # Of light terms: every vector's own, and its length by band.
        own = np.flatnonzero(kind < -1)
        at, band = rows[own], -2 - kind[own]
        self.light_starts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))])
        self.light_terms, self.light_weights = self.terms[own], weights[own].astype(np.float32)
        self.lengths = np.zeros((width // _PIECE, _BANDS, _PIECE), np.float32)
        for b in range(_BANDS):
            here = band == b
            squared = np.bincount(at[here], weights[own[here]] ** 2, width)
            self.lengths[:, b] = np.sqrt(squared).reshape(-1, _PIECE)
        # The lists of all other terms, a place and a weight's bits each.
        own = np.flatnonzero(kind == -1)
        del kind
        own = own[np.argsort(self.terms[own], kind="stable")]
        posts = np.empty((len(own), 2), np.int32)
        posts[:, 0] = rows[own]
        posts.view(np.float32)[:, 1] = weights[own]
        self.posts = posts.view(np.int64).ravel()
        self.lists = np.concatenate([[0], np.cumsum(np.where(self.kind == -1, number, 0))])
        self._dense = np.zeros(self.size)

    def nearest(
        self, query: dict[int, float], k: int, without: int | None = None
    ) -> list[tuple[float, int]]:
        """The k best (cosine, vector) with a cosine above 0, best first, of equal ones
        those first in the index."""
        size = len(query)
        terms = np.fromiter(query, np.int64, size)
        weights = np.fromiter(query.values(), float, size)
        return self.search([(terms, weights)], k, None if without is None else [without])[0]

    def search(
        self,
        queries: list[tuple[np.ndarray, np.ndarray]],
        k: int,
        without: list[int] | None = None,
    ) -> list[list[tuple[float, int]]]:
        """``nearest`` of several queries given as arrays of terms and weights."""
        out = []
        for start in range(0, len(queries), _TOGETHER):
            some = [(t[t < self.size], w[t < self.size]) for t, w in queries[start : start + _TOGETHER]]
            left_out = None if without is None else without[start : start + _TOGETHER]
            out += self._batch(some, k, left_out)
        return out

    def _batch(self, queries, k, without):
        common = np.zeros((len(queries), self.rows.shape[1]), np.float32)
        light = np.zeros((len(queries), _BANDS), np.float32)
        lists = []
        for i, (terms, weights) in enumerate(queries):
            kind = self.kind[terms]
            common[i, kind[kind >= 0]] = weights[kind >= 0]
            here = kind < -1
            light[i] = np.sqrt(np.bincount(-2 - kind[here], weights[here] ** 2, _BANDS))
            lists.append((terms[kind == -1], weights[kind == -1]))
        scores = _product(common, self.rows)
        scores[:, len(self.ids) :] = -np.inf  # places that fill the last block
        if without is not None:
            scores[np.arange(len(queries)), self.place[without]] = -np.inf
        able = _product(light, self.lengths)  # what light terms can add
        return [self._one(*one, k) for one in zip(queries, lists, scores, able)]

    def _one(self, query, listed, scores, able, k):
        (terms, weights), (at, by) = query, listed
        first, last = self.lists[at], self.lists[at + 1]
        if len(at):
            posts = self.posts
            posts = np.concatenate([posts[i:j] for i, j in zip(first.tolist(), last.tolist())])
            posts = posts.view(np.int32).reshape(-1, 2)
            added = np.repeat(by, last - first) * posts.view(np.float32)[:, 1]
            scores += np.bincount(posts[:, 0], added, len(scores))
        dense = self._dense
        dense[terms] = weights
        # The k-th of the greatest of so many groups is a threshold.
        worst = _kth(scores.reshape(-1, self.block).max(0, initial=-np.inf), k)
        able += scores
        best, exact = np.empty(0, int), np.empty(0)
        if worst > 0:
            best = np.flatnonzero(scores >= worst)
            exact = self._exact(best)
            worst = max(worst, _kth(exact, k))
            able[best] = 0.0
        able = np.flatnonzero((able > 0) & (able >= worst - _SLACK))
        if len(able) > _FEW:
            whole = scores[able] + self._light(able)
            worst = max(worst, _kth(whole, k))
            able = able[(whole > 0) & (whole >= worst - _SLACK)]
        exact = np.concatenate([exact, self._exact(able)])
        able = np.concatenate([best, able])
        dense[terms] = 0.0
        able, exact = able[exact > 0], np.round(exact[exact > 0], 9)
        best = np.lexsort((able, -exact))[:k]
        return [(float(s), int(p)) for s, p in zip(exact[best], self.ids[able[best]])]

    def _exact(self, vectors: np.ndarray) -> np.ndarray:
        """The scores of vectors; the query is in ``_dense``."""
        dense, terms, weights, starts = self._dense, self.terms, self.weights, self.starts
        spans = zip(starts[vectors].tolist(), starts[vectors + 1].tolist())
        return np.array([dense[terms[i:j]] @ weights[i:j] for i, j in spans], float)

    def _light(self, vectors: np.ndarray) -> np.ndarray:
        """What light terms add to the scores of vectors; the query is in ``_dense``."""
        found, sizes = _spans(self.light_starts, vectors)
        rows = np.repeat(np.arange(len(vectors)), sizes)
        added = self._dense[self.light_terms[found]] * self.light_weights[found]
        return np.bincount(rows, added, len(vectors))


def _product(left: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """The product of ``left`` and a matrix cut into ``_PIECE`` columns each. Small products don't make the
    library start threads, which would take other tasks' cores and wait busily."""
    n, inner, _ = pieces.shape
    out = np.empty((len(left), n * _PIECE), np.float32)
    into = out.reshape(len(left), n, _PIECE).transpose(1, 0, 2)
    step = max(1, _SMALL // (_PIECE * max(1, inner)))
    for start in range(0, len(left), step):
        some = slice(start, start + step)
        np.matmul(left[some], pieces, out=into[:, some])
    return out


def _light_terms(number, mass, able: np.ndarray, n: int) -> np.ndarray:
    """Which of the ``able`` terms are light: those that add least for the length of their
    lists, as many as hold ``_LIGHT`` of the vectors' squared lengths together. ``number``
    and ``mass`` are each term's vectors and squared weights."""
    at = np.flatnonzero(able)
    at = at[np.argsort(mass[at] / number[at].astype(float) ** 2, kind="stable")]
    light = np.zeros(len(able), bool)
    light[at[np.cumsum(mass[at]) <= _LIGHT * n]] = True
    return light


def _kth(scores: np.ndarray, k: int) -> float:
    """The k-th best score above 0; 0 if there are fewer."""
    if len(scores) < k:
        return 0.0
    return max(0.0, float(np.partition(scores, len(scores) - k)[len(scores) - k]))


class Model:
    """Examples' ids and labels, their words' counts and weights, and the curve.

    What tasks need of the examples is broadcast once, packed; each Python worker makes
    its index of it once."""

    def __init__(self, names, weights, unknown, ids, labels, order, starts, terms, counts):
        self.labels = labels
        self.average = float(np.mean(labels)) if len(labels) else 0.0
        self.at, self.to = [0.0, 1.0], [0.0, 1.0]
        self.parts = (names, weights, unknown, ids, order, starts, terms, counts)

    def broadcast(self, spark: SparkSession) -> None:
        packed = zlib.compress(pickle.dumps(self.parts, protocol=5), 1)
        self.key = xxhash.xxh3_128_hexdigest(packed)
        self.parts = spark.sparkContext.broadcast(packed)

    def ready(self) -> Model:
        """Itself, with words and index."""
        if "index" not in self.__dict__:
            if _MADE.get("key") != self.key:
                made = pickle.loads(zlib.decompress(self.parts.value))
                names, weights, unknown, ids, order, starts, terms, counts = made
                raw = raw_weights(counts) * weights[terms]
                sizes = np.diff(starts)
                of = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
                raw /= np.repeat(np.sqrt(np.bincount(of, raw * raw, len(ids))), sizes)
                del made, counts, of, sizes
                index = Index.ordered(order, starts, terms, raw)
                words = {t: k for k, t in enumerate(names)}
                _MADE.update(key=self.key, all=(words, weights, unknown, ids, index))
            self.terms, self.weights, self.unknown, self.ids, self.index = _MADE["all"]
        return self

    def __getstate__(self) -> dict:
        names = ("labels", "average", "at", "to", "parts", "key")
        return {k: self.__dict__[k] for k in names}

    def vector(
        self, counts: dict[str, int], number: dict[str, int]
    ) -> tuple[np.ndarray, np.ndarray]:
        """The text's words among the examples' and their weights, at length 1 together
        with the words that no example holds, whose ``number`` is -1."""
        at = np.fromiter(map(number.__getitem__, counts), np.int64, len(counts))
        raw = raw_weights(np.fromiter(counts.values(), float, len(counts)))
        raw *= np.where(at >= 0, self.weights[at], self.unknown) if len(self.terms) else 1.0
        size = np.sqrt((raw * raw).sum())
        return at[at >= 0], raw[at >= 0] / size

    def near(self, texts: list[dict[str, int]]) -> list[list[tuple[float, int]]]:
        """The neighbours of texts given by their words' counts."""
        if not self.terms:
            return [[] for _ in texts]
        none = (np.empty(0, np.int64), np.empty(0))
        number = {w: self.terms.get(w, -1) for w in set().union(*texts)}
        queries = [self.vector(c, number) if c else none for c in texts]
        return self.index.search(queries, NEIGHBOURS)

    def near_examples(self, places: list[int]) -> list[list[tuple[float, int]]]:
        """The neighbours of examples, but for themselves."""
        queries = []
        for k in places:
            own = slice(*self.index.starts[self.index.place[k] + [0, 1]])
            queries.append((self.index.terms[own].astype(np.int64), self.index.weights[own]))
        return self.index.search(queries, NEIGHBOURS, places)

    def vote(self, near: list[tuple[float, int]]) -> float:
        weights = [1 / max(_NEAREST, 1 - cosine) for cosine, _ in near]
        toxic = sum(w * self.labels[k] for w, (_, k) in zip(weights, near))
        return (toxic + PRIOR * self.average) / (sum(weights) + PRIOR)

    def calibrated(self, vote: float) -> float:
        return float(np.clip(np.interp(vote, self.at, self.to), 0.0, 1.0))


_MADE: dict = {}  # of this process: the last index made


def raw_weights(counts: np.ndarray) -> np.ndarray:
    return 1 + np.log(counts)


def label_weights(docs: np.ndarray, hits: np.ndarray, n: int, positive: int) -> np.ndarray:
    """Of words held by ``docs`` of n examples, ``hits`` of them positive: how much to make
    of each. None is 0."""

    def part(seen: np.ndarray, share: float) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1) / (np.maximum(docs, 1) * share))

    share = positive / n
    g = np.maximum(0.0, 2 * (part(hits, share) + part(docs - hits, 1 - share)))
    return (g / (g + DOUBT)) ** 2 + LEAST_WEIGHT


def _examples(sample: DataFrame, key: str, text: str) -> DataFrame:
    """The sampled examples with their word counts: of those with equal words in equal
    order and an equal label that with the least id."""

    def read(texts: pa.Array) -> pa.Array:
        rows = []
        for one in texts.to_pylist():
            words = words_of(one or "")
            counts = Counter(words)
            rows.append(
                {
                    "same": xxhash.xxh3_128_digest(" ".join(words)),
                    "words": list(counts),
                    "counts": list(counts.values()),
                }
            )
        shape = pa.struct(
            [
                ("same", pa.binary()),
                ("words", pa.list_(pa.string())),
                ("counts", pa.list_(pa.int32())),
            ]
        )
        return pa.array(rows, shape)

    kind = T.StructType(
        [
            T.StructField("same", T.BinaryType()),
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
        ]
    )
    parsed = F.arrow_udf(read, kind).asNondeterministic()(text)
    out = stored(sample.select(F.col(key).alias("id"), "_label", parsed.alias("p")))
    out = out.select("id", "_label", "p.*")
    first = out.groupBy("same", "_label").agg(F.min("id").alias("id"))
    out = out.join(F.broadcast(first), ["same", "_label", "id"])  # MAX_EXAMPLES
    out = stored(out.dropDuplicates(["same", "_label"]).drop("same"))
    return _fitting(out)


def _fitting(examples: DataFrame) -> DataFrame:
    """The examples with the least hashes whose words together are few enough."""
    part = F.shiftrightunsigned(F.xxhash64("id"), 64 - (_PARTS - 1).bit_length())
    sizes = examples.groupBy(part.alias("part")).agg(F.sum(F.size("words")).alias("n"))
    held, cut = 0, 0
    for r in sorted(sizes.collect()):  # _PARTS
        held += r["n"]
        if held > MAX_ENTRIES:
            break
        cut = r["part"] + 1
    return examples.filter(part < cut) if held > MAX_ENTRIES else examples


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    kept: Column,
    text: str = "text",
    key: str = "doc_id",
    max_examples: int = MAX_EXAMPLES,
) -> Model:
    """The index and curve from labels that are ``kept``."""
    sample = labelled_sample(
        docs.select(key, text), labels, label, kept, max_examples, key
    )
    examples = _examples(sample, key, text)
    n, positive = examples.agg(F.count("*"), F.coalesce(F.sum("_label"), F.lit(0))).first()
    if not 0 < positive < n:
        model = Model([], np.empty(0), 0.0, [], [], np.empty(0, int), np.zeros(1, int),
                      np.empty(0, np.int32), np.empty(0, np.int32))
        model.broadcast(docs.sparkSession)
        model.to = [float(positive / n) if n else 0.0] * 2
        return model
    rows = examples.orderBy("id", "_label").toArrow()  # max_examples
    words = rows["words"].combine_chunks()
    counts = rows["counts"].combine_chunks().flatten().to_numpy()
    sizes = pc.list_value_length(words).to_numpy()
    ids, label = rows["id"].to_pylist(), rows["_label"].to_numpy()
    listed = words.flatten().dictionary_encode()
    del rows, words
    terms, names = listed.indices.to_numpy(), listed.dictionary.to_pylist()
    del listed
    held = np.bincount(terms, minlength=len(names)).astype(float)
    hits = np.bincount(terms, np.repeat(label, sizes), len(names))
    weights = (np.log((1 + n) / (1 + held)) + 1) * label_weights(held, hits, n, positive)
    unknown = float(np.log(1 + n) + 1) * LEAST_WEIGHT
    starts = np.concatenate([[0], np.cumsum(sizes)])
    # Within a vector the length doesn't change the order.
    order = head_order(starts, terms, raw_weights(counts) * weights[terms])
    found, sizes = _spans(starts, order)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    # Words that many examples hold come first, so that what is often read lies together.
    first = np.argsort(-held, kind="stable")
    number = np.empty(len(names), np.int32)
    number[first] = np.arange(len(names))
    names = [names[i] for i in first.tolist()]
    model = Model(
        names, weights[first], unknown, ids, label.tolist(), order, starts,
        number[terms[found]], counts[found],
    )
    model.broadcast(docs.sparkSession)
    votes = _own_votes(docs.sparkSession, model, n)
    points = Counter(votes)
    toxic = Counter()
    for vote, one in zip(votes, model.labels):
        toxic[vote] += one
    model.at, model.to = isotonic([(v, c, toxic[v]) for v, c in points.items()])
    return model


def _own_votes(spark: SparkSession, model: Model, n: int) -> list[float]:
    """Each example's vote with itself left out."""

    def read(places: pa.Array) -> pa.Array:
        votes = []
        for start in range(0, len(places), _TOGETHER):
            some = places.slice(start, _TOGETHER).to_pylist()
            votes += [round(model.vote(n), 3) for n in model.ready().near_examples(some)]
        return pa.array(votes, pa.float64())

    vote = F.arrow_udf(read, T.DoubleType())
    rows = spark.range(n).select("id", vote("id").alias("vote")).collect()
    return [r["vote"] for r in sorted(rows)]


_SCORED = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "evidence",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.LongType()),
                        T.StructField("cosine", T.DoubleType()),
                        T.StructField("label", T.IntegerType()),
                    ]
                )
            ),
        ),
    ]
)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents with ``score`` and ``evidence``: the nearest examples' ids, cosines
    and labels."""
    evidence = pa.list_(
        pa.struct([("id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())])
    )
    shape = pa.struct([("score", pa.float64()), ("evidence", evidence)])

    def scored(texts: pa.Array) -> pa.Array:
        rows = []
        for start in range(0, len(texts), _TOGETHER):
            some = texts.slice(start, _TOGETHER).to_pylist()
            for near in model.ready().near([Counter(words_of(t or "")) for t in some]):
                best = [
                    {"id": model.ids[k], "cosine": c, "label": model.labels[k]}
                    for c, k in near[:EVIDENCE]
                ]
                rows.append({"score": model.calibrated(model.vote(near)), "evidence": best})
        return pa.array(rows, shape)

    scores = F.arrow_udf(scored, _SCORED)
    out = fresh(docs, "score", "evidence", "_scored")
    kept = out.columns
    return out.withColumn("_scored", scores.asNondeterministic()(text)).select(
        *kept, "_scored.*"
    )
