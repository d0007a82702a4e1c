"""Threshold-scaled sketches of texts.

A text's shingles are its runs of five words (white space apart, lower-cased), or all its
words if it has fewer. Its fingerprint is every shingle hash below a fixed fraction of the
hash range, sorted; a text with words but no hash there keeps its least one. The fraction
doesn't depend on the text, so sketches of any lengths compare, and the sketch of a union
is the union of sketches: what share of the smaller sketch the larger one holds estimates
the containment of one text in the other, however unequal they are.

A null text is an empty one: no words, an empty fingerprint. Two empty fingerprints are
alike (1), an empty one and another are not (0). Equal texts have equal fingerprints.
Columns of the input that are named like added or inner ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh

FRACTION = 0.25
WORDS = 5
_PER_BUCKET = 2000
_COARSE = _FINE = 256  # so that the table of buckets has 65,536 rows at most


def sketch(df: DataFrame, text: str, name: str, fraction: float = FRACTION) -> DataFrame:
    """Adds the fingerprint of a text column: a sorted array of hashes."""
    spaced = F.trim(F.translate(text, "\t\n\x0b\f\r", "     "))
    words = F.when(F.length(spaced) > 0, F.split(F.lower(spaced), " +"))
    limit = int(fraction * (1 << 63))
    df = df.withColumn("_words", words)
    more = [lambda i, k=k: F.get("_words", i + k) for k in range(1, WORDS)]
    firsts = F.slice("_words", F.lit(1), F.greatest(F.size("_words") - WORDS + 1, F.lit(1)))
    hashes = F.transform(firsts, lambda w, i: F.xxhash64(w, *(m(i) for m in more)))
    df = df.withColumn("_hashes", hashes)
    below = F.filter("_hashes", lambda h: F.shiftrightunsigned(h, 1) < limit)
    kept = F.array_sort(F.array_distinct(below))
    least = F.array(F.array_min("_hashes"))
    df = df.withColumn("_words", F.lit(None)).withColumn(name, kept)
    return df.withColumn(
        name,
        F.when(F.col("_hashes").isNull(), F.array().cast("array<bigint>"))
        .when(F.size(name) > 0, F.col(name))
        .otherwise(least),
    ).drop("_words", "_hashes")


def merged(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The fingerprint of two texts together."""
    limit = int(fraction * (1 << 63))
    both = F.array_sort(F.array_union(a, b))
    below = F.filter(both, lambda h: F.shiftrightunsigned(h, 1) < limit)
    return F.when(F.size(below) > 0, below).otherwise(F.slice(both, 1, 1))


def containment(a: Column, b: Column) -> Column:
    """The share of the smaller sketch's hashes that the other has."""
    least = F.least(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        F.when(least == 0, F.lit(0.0)).otherwise(shared / least)
    )


def similarity(a: Column, b: Column) -> Column:
    """The estimated share of common shingles among all shingles of both."""
    shared = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - shared
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / total)


def _bucketed(docs: DataFrame, key: str) -> DataFrame:
    """Adds ``_bucket``, rising with the key (nulls first): up to ``_COARSE`` ranges with
    equally many keys each, and within each up to ``_FINE`` equally wide ones."""
    ids = docs.select(F.col(key).cast("long").alias("k"))
    n = ids.count()
    coarse = min(_COARSE, n // _PER_BUCKET + 1)
    fine = min(_FINE, n // coarse // _PER_BUCKET + 1)
    cuts = [i / coarse for i in range(coarse + 1)]
    bounds = ids.agg(F.percentile_approx("k", cuts, 100 * coarse).alias("b")).first()["b"]
    bounds = sorted(set(bounds or [0]))
    low = F.array(*(F.lit(b).cast("long") for b in bounds))
    k = F.col(key).cast("long")
    ranges = F.greatest(F.size(F.filter(low, lambda b: b <= k)), F.lit(1))
    start, end = F.get(low, F.col("_range") - 1), F.get(low, F.col("_range"))
    width = F.coalesce(end - start, F.lit(1)).cast("double")
    step = F.floor((k.cast("double") - start.cast("double")) / width * fine)
    step = F.greatest(F.least(step, F.lit(fine - 1)), F.lit(0))
    return docs.withColumn("_range", ranges).withColumn(
        "_bucket",
        F.when(k.isNull(), F.lit(-1)).otherwise(F.col("_range") * fine + step).cast("long"),
    ).drop("_range")


def with_next(
    docs: DataFrame, key: str, text: str, bring: list[str], prepare=lambda df: df
) -> DataFrame:
    """Adds ``next_<column>`` for the columns in ``bring``: those of the next row by
    ascending key (nulls first, equal keys by text), of the first for the last.

    Rows are shuffled once, into buckets that rise with the key; the first key's rows of
    each bucket go to the bucket before as well, so that its last row finds them.
    ``prepare`` runs on rows after the shuffle, so what it adds isn't shuffled.
    """
    rows = _bucketed(docs, key)
    firsts = rows.groupBy("_bucket").agg(F.min(key).alias("first")).collect()
    numbers = sorted(r["_bucket"] for r in firsts)  # 65,537 at most
    before = {b: numbers[i - 1] for i, b in enumerate(numbers)}
    spark = docs.sparkSession
    edges = spark.createDataFrame(
        [(r["_bucket"], r["first"], before[r["_bucket"]]) for r in firsts],
        "_bucket long, _first long, _before long",
    )
    place = F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("copy"))
    copy = F.struct(F.col("_before").alias("bucket"), F.lit(1).alias("copy"))
    is_first = F.col(key).cast("long").eqNullSafe(F.col("_first"))
    rows = (
        rows.join(F.broadcast(edges), "_bucket")
        .withColumn("_at", F.explode(F.when(is_first, F.array(place, copy)).otherwise(F.array(place))))
        .withColumn("_copy", F.col("_at.copy"))
        .withColumn("_to", F.col("_at.bucket"))
        .drop("_bucket", "_first", "_before", "_at")
        .repartition("_to")
    )
    rows = prepare(rows)
    order = Window.partitionBy("_to").orderBy(
        "_copy", F.col(key).asc_nulls_first(), F.xxhash64(text), text
    )
    for column in bring:
        rows = rows.withColumn(f"next_{column}", F.lead(column).over(order))
    return rows.filter(F.col("_copy") == 0).drop("_copy", "_to")


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by as much of the following one."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - quarter),
        F.substring(following, F.lit(1), quarter),
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, their edited texts (``edited_text``), both fingerprints
    (``sketch``, ``edited_sketch``) and that of the next document (``next_sketch``)."""
    names = ["edited_text", "sketch", "edited_sketch", "next_sketch", f"next_{text}"]
    inner = "_words _hashes _range _bucket _first _before _at _copy _to".split()
    rows = fresh(docs, *names, *inner).withColumn(
        text, F.coalesce(F.col(text), F.lit(""))
    )
    rows = with_next(
        rows, key, text, [text, "sketch"], lambda df: sketch(df, text, "sketch")
    )
    rows = rows.withColumn("edited_text", edited(F.col(text), F.col(f"next_{text}")))
    return sketch(rows.drop(f"next_{text}"), "edited_text", "edited_sketch")


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), ",")
