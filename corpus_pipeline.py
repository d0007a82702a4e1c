"""A corpus cleaned and packed: the stages in order, over the documents table.

Each stage works on all rows that the stage before kept. All but the last return the
columns of ``documents``. Rows with nulls pass unless their text says otherwise: a null or
empty text is scored like any other, has no duplicates, windows or secrets, and is packed
as its end mark. Extra columns of ``docs`` are dropped. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from widerow.llm import quality
from widerow.llm.common import remainder, small, stored, table
from widerow.llm.decontaminate import decontaminate
from widerow.llm.neardup import near_duplicates
from widerow.llm.pack import pack
from widerow.llm.secrets import find_secrets, redacted

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
GOOD = 0.7  # least quality score


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below ``GOOD`` go. Labels are those the classifier may
    learn from; documents without one are scored by their text alone."""
    docs = docs.select(COLUMNS)
    learn = remainder("doc_id", 4) != 2
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", learn)
    scored = quality.score(docs, model)
    return scored.filter(F.col("score") >= GOOD).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays (a null id
    is the greatest). Rows are told apart by a number of their own, so rows that repeat an
    id or have none are documents like others."""
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")))
    found = near_duplicates(rows, "_row").select("_row", "component_id")
    found = stored(found.join(rows.select("_row", "doc_id"), "_row"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    groups = (
        found.groupBy("component_id")
        .agg(F.count("*").alias("n"), F.min(order).alias("first"))
        .filter(F.col("n") > 1)
    )
    others = found.join(small(groups), "component_id").filter(
        F.col("_row") != F.col("first._row")
    )
    return rows.join(small(others.select("_row")), "_row", "left_anti").select(COLUMNS)


def benchmark_decontamination(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    found = decontaminate(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.filter(~F.col("contaminated")).select(COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and ``n_chars`` is that of the new text."""
    found = find_secrets(docs.select(COLUMNS))
    some = F.size("secrets") > 0
    text = F.when(some, redacted(F.col("text"), F.col("secrets"))).otherwise(F.col("text"))
    n_chars = F.when(some, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return found.withColumns({"text": text, "n_chars": n_chars}).select(COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies: sequence, offset and sequence length."""
    return pack(docs.select(COLUMNS), ["doc_id"])


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scan", secret_scan),
    ("best-fit packing", best_fit_packing),
]

# A trained classifier and greedy packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
