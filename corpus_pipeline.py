"""From raw documents to shuffled shards of a training mix."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontam, jaccard, langid, mixing, shards
from millrace.llm.queries import HELD_OUT, table
from millrace.llm.store import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model trained on them is sure of; all if none is labelled."""
    docs = docs.select(*COLUMNS)
    labelled = docs.where(~F.coalesce(F.expr(HELD_OUT), F.lit(False)))
    model = langid.train(labelled.select("doc_id", "text", "lang"))
    return langid.identify(docs, model, keep=COLUMNS).where("NOT rejected").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_per_group(docs.select(*COLUMNS))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = table(spark, sf_dir, "benchmark")
    judged = decontam.contamination(docs, benchmark, keep=COLUMNS)
    return judged.where("NOT contaminated").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs.select(*COLUMNS))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in shuffled order, with shard and slot."""
    return shards.shuffle(docs.select(*COLUMNS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", uncontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: SQL can express neither the trained model nor the seeded shuffle.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
