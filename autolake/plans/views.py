"""Spark-side domain views over the driver tables, composed from the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.functions.joins import partitions_for
from autolake.operators.clean import clean_listings
from autolake.operators.features import build_features
from autolake.operators.fx import normalize_fx
from autolake.operators.model import score_by_group_median
from autolake.plans import fixtures as fx_
from autolake.session import scratch_path
from autolake.sources import storage


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing records as landed (the bronze layer), stored once like the landed files."""
    # Not bucketed: landed records repeat keys, and a key holding a third of the rows
    # would make one bucket (one task) hold a third of the table. Keyed work on the
    # records (keep-first, first-two, first-seen) aggregates map-side instead.
    # Written from the join's own partitions: no further shuffle only to even out files.
    return stored(spark, sf_dir, "records", lambda: fx_.listings(spark, sf_dir))


def keyed_buckets(spark: SparkSession, sf_dir: str) -> int:
    """Buckets of the layers keyed by ``cod``: they share the number, so joins between them need no shuffle."""
    return partitions_for(spark, listings(spark, sf_dir).count())


def compute_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1-C6 over the listing records (both sources, cleaned by the same function)."""
    return clean_listings(listings(spark, sf_dir), fx_.RUN_YEAR, partitions=keyed_buckets(spark, sf_dir))


_TABLES: dict[tuple, str] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return spark.sparkContext.applicationId, sf_dir, storage.state(spark, sf_dir), name


def stored_name(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where a layer that was built lies: a path, or ``table:`` and a catalog name."""
    return _TABLES[_key(spark, sf_dir, name)]


def stored(spark: SparkSession, sf_dir: str, name: str, build, bucket_by: str | None = None) -> DataFrame:
    """A layer as a stored table: built once per session and state of the input files into the
    shared work folder (a reliable write that also cuts the lineage), then read by
    every downstream query — the medallion layout of the pipeline.

    With ``bucket_by`` the table is written bucketed on that key (``keyed_buckets``)
    and registered in the catalog, so aggregates and joins on the
    key read co-located buckets instead of shuffling the table again."""
    key = _key(spark, sf_dir, name)
    if key in _TABLES and _TABLES[key].startswith("table:") and not spark.catalog.tableExists(_TABLES[key][6:]):
        del _TABLES[key]          # the catalog lost it (e.g. a new session): build again
    if key not in _TABLES:
        path = scratch_path(spark, name)
        if bucket_by is None:
            build().write.option("compression", "zstd").parquet(path)
            _TABLES[key] = path
        else:
            table = f"autolake_{name}_{uuid.uuid4().hex[:12]}"
            n = keyed_buckets(spark, sf_dir)
            build().write.bucketBy(n, bucket_by).option("compression", "zstd").option("path", path).format("parquet").saveAsTable(table)
            _TABLES[key] = "table:" + table
    ref = _TABLES[key]
    return spark.table(ref[6:]) if ref.startswith("table:") else spark.read.parquet(ref)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored silver (the output of C1-C6), read by gold, scoring, pages and sinks.
    Bucketed by ``cod``, which is unique in silver, so no bucket can be skewed."""
    return stored(spark, sf_dir, "silver", lambda: compute_silver(spark, sf_dir), bucket_by="cod")


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored gold (G13 output), read by training and the model-side operators."""
    return stored(spark, sf_dir, "gold", lambda: gold(spark, sf_dir))


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored scores (M9/M10 output), read by evaluation and the opportunity reports."""
    return stored(spark, sf_dir, "scored", lambda: scored(spark, sf_dir), bucket_by="cod")


def serving_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored serving listings (S11 output), read by the market queries."""
    return stored(spark, sf_dir, "serving", lambda: serving(spark, sf_dir))


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_.fx_records(spark, sf_dir)


def fx_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_fx(fx_.fx_bronze(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str, silver_df: DataFrame | None = None) -> DataFrame:
    s = silver_df if silver_df is not None else silver(spark, sf_dir)
    return build_features(s, fx(spark, sf_dir), fx_.RUN_YEAR, day_col="scraped_day")


def scored(spark: SparkSession, sf_dir: str, silver_df: DataFrame | None = None) -> DataFrame:
    """Silver rows with a price, scored by the SQL-expressible stand-in estimate
    (median price of the same brand and model)."""
    s = silver_df if silver_df is not None else silver(spark, sf_dir)
    return score_by_group_median(s.where(F.col("precio_ars").isNotNull()), ["marca", "modelo"])


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_.requests(spark, sf_dir)


def serving(spark: SparkSession, sf_dir: str, silver_df: DataFrame | None = None) -> DataFrame:
    """The serving listings table: every silver row, with the stand-in estimate and
    score on rows that have a price (null otherwise), ``url`` and day columns.

    Equivalent to ``silver LEFT JOIN scored USING (cod)`` but joined on the small
    (marca, modelo) median table instead of on ``cod``, so no large-to-large join."""
    from autolake.functions.joins import bounded_broadcast
    from autolake.functions.stats import group_median
    from autolake.operators.model import estimate_columns

    s = silver_df if silver_df is not None else silver(spark, sf_dir)
    med = group_median(s.where(F.col("precio_ars").isNotNull()), ["marca", "modelo"], "precio_ars", "_med")
    j = s.join(bounded_broadcast(med), ["marca", "modelo"], "left")
    j = j.withColumn("_med", F.when(F.col("precio_ars").isNotNull(), F.col("_med")))
    return (estimate_columns(j, "_med").drop("_med")
            .withColumnRenamed("path", "url")
            .withColumn("fecha", F.col("scraped_day"))
            .withColumnRenamed("scraped_day", "scraped_at"))
