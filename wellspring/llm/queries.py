"""The operators of this package as queries over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.llm import (
    alignment,
    chat,
    decontaminate,
    html_extract,
    jaccard_join,
    packing,
    quality,
    runs,
    shuffle_shards,
    substring_dedup,
    token_counts,
    token_shards,
    warc,
)
from wellspring.llm.bpe import tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard_join.components(docs, shingle=3, similarity=(90, 100))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, tokenizer_path(), end_id=1, keep_ids=False)
    return packing.pack(pieces)


def op3_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    return chat.digests(chat.format_examples(turns.unionByName(more)))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(warc.records(table(spark, sf_dir, "pages")))
    read = warc.read_archives(spark, path)
    stored = F.col("record_type") == "response"
    return read.select(
        "page_id",
        F.when(stored, F.octet_length("payload").cast("long"))
        .otherwise(F.col("payload_length"))
        .alias("payload_bytes"),
        F.when(stored, warc.base32_sha1(F.col("payload")))
        .otherwise(F.col("payload_digest"))
        .alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_extract.extract(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = token_shards.write_shards(token_shards.token_sequences(docs, tokenizer_path()), key=1)
    read = token_shards.read_shards(spark, path)
    return read.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op10_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shuffle_shards.shard(table(spark, sf_dir, "documents"), shards=16, seed=1)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def with_repeated_ends(docs: DataFrame) -> DataFrame:
    """Documents whose ids' checksums end in 0 get a text that repeats a stretch of its words from
    some word on; the other texts stay as they are."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, first, period = F.col("n"), F.col("first"), F.col("period")
    shown = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get("words", F.when(i < first, i).otherwise(first + (i - first) % period)),
    )
    return (
        docs.select("doc_id", "text", checksum.alias("checksum"))
        .select("*", F.when(F.col("checksum") % 10 == 0, words).alias("words"))
        .select("*", F.floor(F.col("checksum") / 10).alias("g"), F.size("words").alias("n"))
        .select("*", F.when(n > 0, F.col("g") % n).cast("int").alias("first"))
        .select("*", (1 + F.floor((n - first) / (3 + F.col("g") % 8))).cast("int").alias("period"))
        .select("doc_id", F.when(n > 0, F.array_join(shown, " ")).otherwise(F.col("text")).alias("text"))
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(with_repeated_ends(table(spark, sf_dir, "documents")))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    found = found.withColumn("best", runs.longest_power())
    return found.select(
        "doc_id",
        "n_words",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=20)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        op2_packing,
        op3_chat_examples,
        op4_quality_rules,
        op5_warc,
        op6_decontaminate,
        op7_token_counts,
        op8_html_text,
        op9_token_shards,
        op10_shuffle_shards,
        op11_token_alignment,
        op12_periodic_runs,
        op13_substring_dedup,
    )
}
