"""Variable-capacity best-fit packing of texts into sequences.

Items are taken by falling length. Each goes to the open bin with the least room that
still holds it, whatever that bin's size. If none does, bins are opened of the permitted
size that costs least per item of this length (of equals the smaller size), so all sizes
are planned jointly. At the end every bin is cut down to the least permitted size that
holds its contents. A text longer than the largest size is cut into pieces of that size
and a rest.

Items of one length are interchangeable, so the plan needs only the histogram of lengths,
which has at most as many entries as the largest size, however many items there are. Runs
of bins in the same state are moved together. The plan is a list of runs: items of length
l with ranks a to b go to bins from c on, so many in each, from this offset. Items are
ranked within their length in buckets (no length is ranked by one task) and look up their
run in the broadcast plan.

Every row has at least one piece: a null or empty text has the length of its end mark.
Equal rows are separate items. An empty table gives no rows. Columns beside the identity
aren't returned.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, hash_order, ranked, stored

CAPACITIES = (2048, 4096, 8192, 16384)
PER_BUCKET = 20_000
_PLACE = pa.struct(
    [("bin_id", pa.int64()), ("bin_offset", pa.int32()), ("bin_capacity", pa.int32())]
)


def token_cost(capacity: int) -> float:
    """Linear work and the attention part, equal at 32,768 tokens."""
    return capacity + capacity * capacity / 32768


class Plan:
    """Runs of items and runs of bins.

    ``runs``: rows (length, first rank, first bin, items a bin, offset), sorted.
    ``bins``: rows (first bin, final capacity), sorted. ``n_bins``: their number.
    """

    def __init__(self, runs: np.ndarray, bins: np.ndarray, n_bins: int):
        self.runs, self.bins, self.n_bins = runs, bins, n_bins


def plan(
    histogram: Iterable[tuple[int, int]],
    capacities: Sequence[int] = CAPACITIES,
    cost=token_cost,
) -> Plan:
    """The packing of (length, count) pairs; no length is above the largest capacity."""
    sizes = sorted(capacities)
    rooms: list[int] = []  # rooms that open bins have, sorted
    open_bins: dict[int, list[tuple[int, int, int]]] = {}  # by room: first, n, capacity
    runs, n_bins = [], 0

    def keep(room: int, first: int, n: int, capacity: int) -> None:
        if n:
            if room not in open_bins:
                insort(rooms, room)
            open_bins.setdefault(room, []).append((first, n, capacity))

    for length, count in sorted(histogram, reverse=True):
        rank = 0
        while rank < count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fitting = [s for s in sizes if s >= length]
                size = min(fitting, key=lambda s: (cost(s) / (s // length), s))
                n = -(-(count - rank) // (size // length))
                keep(size, n_bins, n, size)
                n_bins += n
                continue
            room = rooms[at]
            first, n, capacity = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
            each = room // length
            full = min(n, (count - rank) // each)
            if full:
                runs.append((length, rank, first, each, capacity - room))
                keep(room - each * length, first, full, capacity)
                rank += full * each
            rest = min(count - rank, each) if full < n else 0
            if rest:
                runs.append((length, rank, first + full, each, capacity - room))
                keep(room - rest * length, first + full, 1, capacity)
                rank += rest
            keep(room, first + full + bool(rest), n - full - bool(rest), capacity)

    bins = [
        (first, sizes[bisect_left(sizes, capacity - room)])
        for room, group in open_bins.items()
        for first, _, capacity in group
    ]
    return Plan(
        np.array(sorted(runs), dtype=np.int64).reshape(-1, 5),
        np.array(sorted(bins), dtype=np.int64).reshape(-1, 2),
        n_bins,
    )


def _place_udf(made: Plan, spark):
    shared = spark.sparkContext.broadcast((made.runs, made.bins))

    @F.arrow_udf("struct<bin_id:long,bin_offset:int,bin_capacity:int>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        runs, bins = shared.value
        length, rank = lengths.to_numpy(), ranks.to_numpy()
        # Runs are sorted by length, then rank; so are these pairs as complex numbers.
        keys = runs[:, 0] + 1j * runs[:, 1]
        run = runs[np.searchsorted(keys, length + 1j * rank, side="right") - 1]
        beyond = rank - run[:, 1]
        bin_id = run[:, 2] + beyond // run[:, 3]
        offset = run[:, 4] + beyond % run[:, 3] * length
        capacity = bins[np.searchsorted(bins[:, 0], bin_id, side="right") - 1, 1]
        return pa.StructArray.from_arrays(
            [
                pa.array(bin_id),
                pa.array(offset.astype(np.int32)),
                pa.array(capacity.astype(np.int32)),
            ],
            fields=list(_PLACE),
        )

    return place


def byte_tokens(text: str = "text") -> Column:
    """UTF-8 bytes and one end mark."""
    return F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1


def pack(
    docs: DataFrame,
    identity: list[str],
    length: Column | None = None,
    capacities: Sequence[int] = CAPACITIES,
    cost=token_cost,
) -> DataFrame:
    """One row a piece: the ``identity`` columns, ``piece`` (from 0), ``piece_start``,
    ``piece_length`` (in tokens), ``bin_id``, ``bin_offset`` and ``bin_capacity``.

    ``length`` is the number of tokens of a row, 1 at least; bytes and an end mark if
    not given. ``identity`` names the columns that tell rows apart.
    """
    largest = max(capacities)
    tokens = byte_tokens() if length is None else F.greatest(length, F.lit(1))
    names = ["piece", "piece_start", "piece_length"]
    pieces = fresh(docs.select(*identity, tokens.cast("long").alias("_tokens")), *names)
    identity = [c for c in pieces.columns if c != "_tokens"]
    last = F.expr(f"cast((_tokens - 1) div {largest} as int)")
    pieces = (
        pieces.withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("piece_start", F.col("piece") * F.lit(largest).cast("long"))
        .withColumn(
            "piece_length",
            F.least(F.lit(largest).cast("long"), F.col("_tokens") - F.col("piece_start")),
        )
        .withColumn("_order", hash_order(*identity, "piece"))
        .drop("_tokens")
    )
    pieces = stored(pieces)
    histogram = pieces.groupBy("piece_length").agg(F.count("*").alias("n")).collect()
    made = plan([(r["piece_length"], r["n"]) for r in histogram], capacities, cost)
    place = _place_udf(made, docs.sparkSession)
    ties = [*identity, "piece"]
    return (
        ranked(pieces, "piece_length", "_order", ties, PER_BUCKET, "_rank")
        .withColumn("_place", place("piece_length", "_rank"))
        .select(*identity, *names, "_place.*")
    )
