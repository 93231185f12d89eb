"""Registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    centroids,
    decontam,
    divergence,
    jaccard,
    langid,
    licences,
    line_dedup,
    merkle,
    mixing,
    quotes,
    shards,
    sql,
    token_files,
    warc,
)
from millrace.llm.store import shared_folder

HELD_OUT = "pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def warc_normaliser(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.with_revisits(table(spark, folder, "pages"))
    archives = warc.write_archives(records, shared_folder(spark, "warc-whole"))
    index = warc.normalise(archives, shared_folder(spark, "warc-members"))
    return warc.read_records(index)


def line_dedup_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, folder, "documents"))
    kept = F.sha2(F.coalesce("kept_text", F.lit("")), 256)
    return found.select(
        "doc_id", "n_lines", "n_deleted", "longest_run", kept.alias("kept_sha256")
    )


def mail_threads(conversations: DataFrame) -> DataFrame:
    """Conversations as mail: each turn quotes the one before it, which quotes one more."""
    turns = conversations.groupBy("conv_id", "turn").agg(F.min("text").alias("earlier"))
    one = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("earlier").alias("one"))
    two = turns.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("earlier").alias("two"))
    rows = conversations.join(one, ["conv_id", "turn"], "left").join(
        two, ["conv_id", "turn"], "left"
    )
    marked = lambda c, mark: F.regexp_replace(c, "(?m)^", mark)
    return rows.select(
        F.col("conv_id").alias("thread"),
        F.col("turn").alias("position"),
        F.concat_ws("\n", marked("two", "> > "), marked("one", "> "), "text").alias("text"),
    )


def quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    linked = quotes.link_quotes(mail_threads(table(spark, folder, "conversations")))
    own = F.sha2(F.coalesce("own_text", F.lit("")), 256).alias("own_sha256")
    return linked.select(
        F.col("thread").alias("conv_id"),
        F.col("position").alias("turn"),
        "reply_to",
        "root",
        "reply_depth",
        "levels",
        "n_quoted",
        "n_linked",
        "outside_thread",
        own,
    )


def distribution_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.judge(table(spark, folder, "documents"))


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    docs = docs.withColumn("held_out", F.coalesce(F.expr(HELD_OUT), F.lit(False)))
    model = langid.train(docs.where("NOT held_out").select("doc_id", "text", "lang"))
    return langid.identify(docs, model, keep=("doc_id", "held_out"))


def sharding(spark: SparkSession, folder: str) -> DataFrame:
    shuffled = shards.shuffle(table(spark, folder, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return shuffled.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def mixing_sources(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.copies(table(spark, folder, "documents"))
    return taken.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"))


def token_ids(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    tokenizer = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text("utf-8")
    docs = table(spark, folder, "documents")
    files = token_files.write_token_files(docs, tokenizer, shared_folder(spark, "token-ids"))
    return token_files.read_token_files(files)


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    lowered = F.translate("text", sql.UPPER, sql.LOWER)
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    changed = merkle.record(["doc_id", "source", "lang", "n_chars", lowered])
    return merkle.prove(table(spark, folder, "documents"), changed=F.when(tampered, changed))


def centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings")).drop("n_checked")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_normaliser": warc_normaliser,
    "op2_line_dedup": line_dedup_runs,
    "op3_quotation_linking": quotation_linking,
    "op4_divergence": distribution_divergence,
    "op5_language_id": language_id,
    "op6_token_files": token_ids,
    "op7_external_shuffle": sharding,
    "op8_systematic_mixing": mixing_sources,
    "op9_decontamination": decontamination,
    "op10_jaccard_join": jaccard_join,
    "op11_license_scan": license_scan,
    "op12_merkle_manifest": merkle_manifest,
    "op13_ptolemaic_centroids": centroid_clustering,
}

SQL: dict[str, str] = {
    "op1_warc_normaliser": sql.WARC,
    "op2_line_dedup": sql.LINE_DEDUP,
    "op8_systematic_mixing": sql.MIXING,
    "op9_decontamination": sql.DECONTAMINATION,
    "op10_jaccard_join": sql.JACCARD,
    "op11_license_scan": sql.LICENSES,
    "op12_merkle_manifest": sql.MERKLE,
    "op13_ptolemaic_centroids": sql.CENTROIDS,
}
