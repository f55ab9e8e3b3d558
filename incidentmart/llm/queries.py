"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import alignment_counts
from .bpe_count import count_tokens
from .clustering import cluster
from .common import WORD, new_scratch, number_rows
from .decontamination import decontaminate
from .exact_dedup import exact_dedup
from .jaccard_join import jaccard_join
from .langid import LanguageModel, fit_languages, identify_language
from .mixing import mix_sources
from .piece_sampling import round_trip
from .quality import COUNTS, quality_filter
from .sharding import shard_rows
from .substring_dedup import remove_repeats
from .warc import read_warc, write_warc

SHARDS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out():
    """The fold that language models never see: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def language_model(docs: DataFrame) -> LanguageModel:
    return fit_languages(docs.filter(F.col("lang").isNotNull() & ~held_out()).select("doc_id", "text", "lang"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify_language(docs, language_model(docs), columns=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def source_weights(docs: DataFrame) -> DataFrame:
    """(source, weight): sources by code point, null last, weigh 3, 1, 2, repeating."""
    place = [F.col("source").isNull(), F.col("source")]
    ranked = number_rows(docs.select("source").distinct(), place, "n", "mix-weights")
    return ranked.select("source", F.element_at(F.array(F.lit(3), F.lit(1), F.lit(2)), (F.col("n") % 3 + 1).cast("int")).alias("weight"))


def mixed(docs: DataFrame) -> DataFrame:
    size = F.regexp_count("text", F.lit(WORD))
    return mix_sources(docs, source_weights(docs), size, share=1.5, max_epochs=2.0, seed=42)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard_rows(rows, ["doc_id", "text_crc32", "size"], shards=SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch(spark, "warc")
    write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder, min_revisit_bytes=0)
    return read_warc(spark, folder, with_payload=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), columns=["doc_id"])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_filter(docs).select("doc_id", *COUNTS, "base_failed", "kept")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join(docs).select("doc_id", "class_id", "n_links", "kept")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    hits = decontaminate(docs, items, window=10, columns=["doc_id"])
    return hits.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    placed = cluster(vectors, dims=64, k=40, rounds=5, scale=256, seed=2, columns=["vec_id"])
    return placed.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                         F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256).alias("centroid_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_mixing, op3_exact_dedup, op4_sharding, op5_warc, op6_substring_dedup, op7_piece_sampling, op8_token_counts, op9_quality_rules, op10_jaccard_join,
    op11_alignment, op12_decontamination, op13_clustering)}
