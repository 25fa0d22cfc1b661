"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import (
    additive_quality,
    chat_preferences,
    chunked_bpe,
    digest_index,
    divergence_rules,
    packing,
    pair_search,
    pattern_packing,
    personal_data,
    ring_sharding,
    simhash,
    token_alignment,
    wrapper_extraction,
)
from tabloom.llm.registry import ORACLES, QUERIES, query, table
from tabloom.llm.sql import ANSWERS, DIGESTS, RANKED, RULES

__all__ = ["ORACLES", "QUERIES"]


def _spans(column: str) -> Column:
    """Spans as text: start-end, separated by commas."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")


@query("op1_preference_format", ANSWERS)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat_preferences.paired_answers(table(spark, sf_dir, "conversations"))
    formatted = chat_preferences.format_preferences(pairs)
    return formatted.withColumns({f"{side}_spans": _spans(f"{side}_spans") for side in ("chosen", "rejected")})


@query("op2_additive_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = additive_quality.train(documents, labels.where(~additive_quality.held_out("doc_id")), "quality")
    scored = additive_quality.score_documents(documents, model)
    return scored.select(
        "doc_id",
        additive_quality.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op3_dominance_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(documents: DataFrame) -> DataFrame:
    """Where each piece of the documents goes, its ids as their checksum."""
    pieces = packing.token_pieces(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


@query("op4_digest_index", DIGESTS)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = digest_index.temporary_index(spark)
    found = digest_index.deduplicate(table(spark, sf_dir, "documents"), index)
    index.forget()
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op5_ring_sharding")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring_sharding.assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op6_divergence_rules", RULES)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = divergence_rules.assess(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *(F.col("quality")[n].alias(n) for n in names))


@query("op7_wrapper_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper_extraction.extract_main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query("op8_personal_data")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find_personal_data(documents)

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*personal_data.BASE_KINDS))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in personal_data.BASE_KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query("op9_chunked_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return chunked_bpe.encode_documents(table(spark, sf_dir, "documents"), path, chunked_bpe.DIGESTS)


@query("op10_simhash_tiles")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=2, shingle=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op11_pattern_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = pattern_packing.pack_documents(table(spark, sf_dir, "documents"), path, shape=F.crc32)
    return packed.withColumnRenamed("ids", "ids_crc32")


@query("op12_pair_bitmaps")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    corpus = token_alignment.align_corpus(table(spark, sf_dir, "documents"), *paths, digest=True)
    return token_alignment.document_alignments(corpus).withColumnRenamed("groups", "groups_sha256")


@query("op13_pair_maxscore", RANKED)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = pair_search.build_index(table(spark, sf_dir, "documents"))
    return pair_search.search(index, table(spark, sf_dir, "benchmark"), k=20)
