"""The registered queries of this folder: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricwatch.llm import alignment, chat, collisions, counts, decontamination, near, neighbours, packing, pitman_yor, private, quality, spelling, token_files
from metricwatch.llm.shared import remainder, table
from metricwatch.llm.tokens import BYTE_BPE, WORD_BPE, vocabulary


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_token_files(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE))
    return token_files.read_digests(spark, path)


def op2_edited_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits of each document: a piece of itself put in, a stretch taken out, and one put in another's place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def number(salt: int, below: Column) -> Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(salt)), below).cast("int")

    def edit(salt: int, removed: int, inserted: int) -> Column:
        at = number(salt, F.length("text") + 1)
        piece = F.substring("text", number(salt + 1, F.length("text") + 1) + 1, number(salt + 2, F.lit(inserted + 1)))
        return F.struct(at.alias("at"), number(salt + 3, F.lit(removed + 1)).alias("removed"), piece.alias("inserted"))

    edits = F.array(edit(0, 0, 60), edit(10, 60, 0), edit(20, 20, 20))
    return counts.edited_counts(docs.withColumn("edits", edits), vocabulary(BYTE_BPE))


def op3_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = pitman_yor.Model(table(spark, sf_dir, "documents")).scores()
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private.entity_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in private.KINDS),
        F.sha2(private.span_text(private.KINDS), 256).alias("base_sha256"),
        private.span_text((*private.KINDS, "term")).alias("spans"),
    )


def op5_chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    path = vocabulary(BYTE_BPE)
    return chat.digests(chat.assemble(chat.planted(turns), path), path)


def op6_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_vectors(table(spark, sf_dir, "embeddings"))


def op7_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "overlap", "containment")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(packing.token_pieces(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE)))


def op9_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.scores(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(remainder("doc_id", quality.FOLDS) == 0, F.lit(False))
    predicted = (F.col("score") >= quality.ACCEPT).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_copies(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.corpus_words(table(spark, sf_dir, "documents")))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_counts(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_edited_counts": op2_edited_counts,
    "op3_pitman_yor": op3_pitman_yor,
    "op4_disclosure": op4_disclosure,
    "op5_chat_tokens": op5_chat_tokens,
    "op6_posting_lists": op6_posting_lists,
    "op7_benchmark_containment": op7_benchmark_containment,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_pairwise_quality": op9_pairwise_quality,
    "op10_near_copies": op10_near_copies,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_token_alignment": op13_token_alignment,
}
