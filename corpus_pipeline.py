"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

toxicity (rejected documents go), near_dedup (one document of each group stays),
substring_dedup (repeated passages go from the texts), decontamination (documents with
benchmark passages go), packing (token pieces of training sequences).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.llm import decontaminate, near_dedup, packing, substring_dedup, tokens, toxicity
from autolake.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not scored toxic; the model is fitted on the labelled ones among them."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, "doc_id", "text", *(c for c in docs.columns if c != "doc_id"))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents kept: the one with the smallest id of each near-duplicate group (similarity 0.8 or more).

    Rows that repeat an id are one document: the row with the first text stays, one without a text
    only where the id has no other. Rows without an id all stay.
    """
    classes = near_dedup.classes(docs).where("not kept").select("doc_id").distinct()
    kept = docs.join(classes, "doc_id", "left_anti")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    first = F.min_by(F.struct("text", *rest), F.struct(F.col("text").isNull(), "text", *rest))
    named = kept.where("doc_id is not null").groupBy("doc_id").agg(first.alias("row"))
    return named.select("doc_id", "row.*").select(*docs.columns).unionAll(kept.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without their repeated passages; n_chars counts the text that is left.

    Documents of which nothing is left go.
    """
    cut = substring_dedup.remove_repeats(docs)
    left = cut.where("repeats.n_removed = 0 or repeats.n_removed < repeats.n_words")
    return left.withColumn("n_chars", F.when(F.col("repeats.n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed training sequences."""
    return packing.pack(docs, tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")), special=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Tokenisation and fitted trees have no SQL form; tests/llm holds a brute-force version.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
