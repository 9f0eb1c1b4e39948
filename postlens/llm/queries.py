"""One query for each operator, over whole tables; each digests what its operator returns."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import (
    bpe, chat, group_join, matrix_join, packing, pair_alignment, pii, pivot_index, quality, secret_scan, spelling,
    substring_dedup, suffix_dedup,
)

TOKENIZER = corpus_pipeline.TOKENIZER
BYTE_BPE, PIECE_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counts(spans: str, kinds: tuple[str, ...]) -> list[Column]:
    """How many spans of each kind."""
    found = F.transform(spans, lambda s: s["kind"])
    return [(F.size(found) - F.size(F.array_remove(found, k))).cast("long").alias(f"n_{k}") for k in kinds]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["layers"] == "")
    return found.withColumn("_base", base).select(
        "doc_id",
        *counts("_base", secret_scan.KINDS),
        F.sha2(secret_scan.joined(F.col("_base")), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
        "unopened",
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.withColumn("_base", base).select(
        "doc_id",
        *counts("_base", pii.BASE_KINDS),
        F.sha2(pii.joined(F.col("_base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


def op3_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    rows = rows.union(spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema))
    found = chat.format_trees(chat.chains(rows, "conv_id", "turn", "role", "text"))
    turns = found.select(
        F.col("tree").alias("conv_id"), "formatted", chat.parsed(F.col("formatted")).alias("_turns"),
        chat.loss_text(F.col("formatted"), F.col("loss")).alias("_loss"),
    )
    said_by = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return turns.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said_by, ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_group_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_join.similarity_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality.score(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id",
        (quality.fold(F.col("doc_id")) == quality.HELD_OUT).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op6_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.top_k(table(spark, sf_dir, "embeddings"))


def op7_matrix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix_join.nearest(table(spark, sf_dir, "embeddings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = substring_dedup.mark_repeats(table(spark, sf_dir, "documents"), "passage")
    return marked.select(
        "doc_id",
        "text",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("removed"),
        "owners",
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER)
    return bpe.decode(ids, TOKENIZER).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_pair_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_alignment.align(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE, digest=True)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    lengths = F.transform("removed", lambda s: s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op6_sql() -> str:
    return """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def op7_sql() -> str:
    return """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_pii, op3_reply_trees, op4_group_join, op5_quality, op6_pivot_index, op7_matrix_join,
        op8_packing, op9_substring_dedup, op10_bpe, op11_pair_alignment, op12_suffix_dedup, op13_spelling,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE: dict[str, str] = {"op6_pivot_index": op6_sql(), "op7_matrix_join": op7_sql()}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
