"""The operators over whole tables, as registered queries, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles, quality, toxicity
from .common import group_key, remainder, table
from .conversations import repair
from .decontaminate import decontaminate
from .extract import extract
from .fingerprint import as_text, containment, fingerprints, similarity
from .neardup import near_duplicates
from .pack import pack
from .secrets import find_secrets, named
from .shard import interleave
from .tokens import count_tokens
from .vector_codes import compress
from .vector_dedup import near_vectors

# The vocabulary file of op8; any of its format will do.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"


def _sha256(*parts: Column) -> Column:
    return F.sha2(F.concat_ws(",", *parts), 256)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 4) == 2
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", ~held_out)
    return quality.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"),
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _sha256(F.col("items")).alias("items_sha256"),
        "contaminated",
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] <= 2)

    def number(kind: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        _sha256(named(base)).alias("base_sha256"),
        F.array_join(named(F.col("secrets")), ",").alias("spans"),
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, ["doc_id"])


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    own, changed, following = map(F.col, ("sketch", "edited_sketch", "next_sketch"))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"),
        as_text(changed).alias("edited_fingerprint"),
        containment(own, changed).alias("near_edited"),
        containment(own, following).alias("near_next"),
        similarity(own, changed).alias("similar_edited"),
        similarity(own, following).alias("similar_next"),
    )


def op8_token_counts(
    spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY
) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, vocabulary).drop("text")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return interleave(rows, ["doc_id", "size", "text_crc32"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = compress(table(spark, sf_dir, "embeddings"))
    numbers = (str(x) for part in codes.codebooks for entry in part for x in entry)
    held = ",".join(numbers)  # bounded: 16 entries of a vector's length
    index = F.transform("code", lambda i: F.lpad(F.lower(F.hex(i)), 2, "0"))
    return codes.rows.select(
        "vec_id",
        F.array_join(index, "").alias("code"),
        "error",
        "label_error",
        F.sha2(F.lit(held), 256).alias("codebooks_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults by a hash of id and turn; null roles and texts become
    one space."""
    conv, turn, role, text = (
        F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")
    )
    fault = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    copies = F.array_repeat(F.lit(0), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "")
        .when(fault == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def op12_conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    done = repair(damaged(turns)).select(
        group_key("conv_id").alias("conv"), *numbers, "audit", F.sha2("repaired", 256).alias("sha")
    )
    convs = turns.select("conv_id").distinct().withColumn("conv", group_key("conv_id"))
    return convs.join(done, "conv", "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[:2] == "op" and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
