"""The registered queries of this folder: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolog.llm import alignment, bpe, decontaminate, divergence, html_wrapper, line_dedup, near_dedup, packing, quality_cnn, quality_rules, sharding, token_files, toxicity
from aerolog.llm.common import table
from aerolog.session import scratch_folder

SHARDS = 40
#: The id that ends a document in the token files.
END = 1


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def sha256(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    out = sharding.sharded(table(spark, sf, "documents"), SHARDS, f"{scratch_folder(spark)}/slot_map")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"))


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = line_dedup.without_repeated_lines(docs, dropped="n_dropped")
    return out.select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), F.col("n_dropped").cast("long").alias("n_dropped"),
                      F.length("text").cast("long").alias("n_chars"), sha256(F.col("text")).alias("text_sha256"))


def op3_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    held_out = toxicity.remainder(F.col("doc_id"), 4) == 2
    net = quality_cnn.trained(docs, labels.where(~held_out))
    out = quality_cnn.scored(docs, net)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    out = decontaminate.hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      sha256(F.concat_ws(",", "items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op6_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_copies(table(spark, sf, "documents"))


def op7_html(spark: SparkSession, sf: str) -> DataFrame:
    out = html_wrapper.main_texts(table(spark, sf, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = bpe.with_tokens(docs, tokenizer_path(), back="decoded")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      sha256(F.concat_ws(" ", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
                      sha256(F.col("decoded")).alias("decoded_sha256"))


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{scratch_folder(spark)}/token_files"
    token_files.write_tokens(table(spark, sf, "documents"), tokenizer_path(), END, folder)
    out = token_files.read_tokens(spark, folder, as_bytes=True)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    held_out = toxicity.remainder(F.col("doc_id"), 5) == 0
    model = toxicity.trained(docs, labels.where(~held_out))
    out = toxicity.scored(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_packing(spark: SparkSession, sf: str) -> DataFrame:
    path = tokenizer_path()
    out = packing.packed(table(spark, sf, "documents"), path, 2)
    return out.select("doc_id", "start", "length", packing.ids_crc32(F.col("ids"), "<u2").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source", "round")


def op12_alignment(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.digests(table(spark, sf, "documents"), a, b).drop("row")


def op13_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audited(table(spark, sf, "documents"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
