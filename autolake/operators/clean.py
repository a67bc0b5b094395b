"""Listing cleaning, bronze records -> silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autolake.functions.columns import NEW_CONDITION, YEAR_MIN
from autolake.functions.joins import keep_first
from autolake.schemas import LISTING_SILVER_TYPES


def typed_projection(records: DataFrame, day=None, scraped_at: Column | None = None) -> DataFrame:
    """Cast every known column to its silver type (ANSI casts fail on bad input).

    ``day`` adds the ``fecha`` literal; ``scraped_at`` (an envelope column) overrides
    any per-record value, like the reference's constant column."""
    out = records
    if day is not None:
        out = out.withColumn("fecha", F.lit(str(day)).cast("date"))
    if scraped_at is not None:
        out = out.withColumn("scraped_at", scraped_at)
    return out.select(*[
        F.col(c).cast(LISTING_SILVER_TYPES[c]).alias(c) if c in LISTING_SILVER_TYPES else F.col(c)
        for c in out.columns
    ])


CORRUPT = "_corrupt_record"


def checked_projection(records: DataFrame, day=None, scraped_at: Column | None = None) -> DataFrame:
    """C1/C2 for records read as text: every known column cast to its silver type, and ``_reason``,
    null for a good row: the record was no JSON (``CORRUPT`` holds its text), or which columns'
    text is not of the type. ``_record`` is the record as it was read."""
    fields = [c for c in records.columns if c in LISTING_SILVER_TYPES]
    faults = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(LISTING_SILVER_TYPES[c]).isNull(), F.lit(f"{c} is not {LISTING_SILVER_TYPES[c]}"))
              for c in fields]
    corrupt = F.col(CORRUPT) if CORRUPT in records.columns else F.lit(None).cast("string")
    reasons = F.concat_ws("; ", F.when(corrupt.isNotNull(), F.lit("record is not JSON")), *faults)
    out = (records.withColumn("_reason", F.nullif(reasons, F.lit("")))
                  .withColumn("_record", F.coalesce(corrupt, F.to_json(F.struct(*fields)))).drop(CORRUPT))
    for c in fields:
        out = out.withColumn(c, F.col(c).try_cast(LISTING_SILVER_TYPES[c]))
    if day is not None:
        out = out.withColumn("fecha", F.lit(str(day)).cast("date"))
    return out if scraped_at is None else out.withColumn("scraped_at", scraped_at)


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of ``checked_projection``."""
    return checked.where(F.col("_reason").isNull()).drop("_reason", "_record"), checked.where(F.col("_reason").isNotNull())


def enforce_bad_share(bad: int, total: int, limit: float) -> None:
    """A day with too many bad records is an error: something is wrong with the feed, not with a record."""
    if bad > limit * total:
        raise ValueError(f"{bad} of {total} records are bad, more than a share of {limit}")


def null_zero_price(df: DataFrame) -> DataFrame:
    """A price of 0 means 'no price'."""
    return df.withColumn("precio_ars", F.nullif(F.col("precio_ars"), F.lit(0).cast("bigint")))


def null_year_out_of_range(df: DataFrame, year_max: int | Column, year_min: int = YEAR_MIN) -> DataFrame:
    """C4: years outside [year_min, year_max] become null."""
    a = F.col("anio")
    return df.withColumn("anio", F.when((a < year_min) | (a > year_max), F.lit(None)).otherwise(a))


def null_suspicious_zero_km(df: DataFrame) -> DataFrame:
    """km = 0 on a vehicle that is not new is not believable. A null condition
    keeps km = 0 (three-valued logic: the test is null, so the row keeps its value)."""
    km = F.col("km")
    return df.withColumn(
        "km", F.when((km == 0) & (F.col("condicion") != NEW_CONDITION), F.lit(None)).otherwise(km))


def dedup_first(df: DataFrame, key: str = "cod", order: str = "_ord", partitions: int | None = None) -> DataFrame:
    """One row per ``key``, the first in input order (``order`` column), dropped after."""
    return keep_first(df, [key], order, drop=[order], spread=True, partitions=partitions)


def clean_listings(records: DataFrame, year_max: int, order: str = "_ord", partitions: int | None = None) -> DataFrame:
    """C3-C6 in the reference's order: per-row rules first, then keep-first by cod.

    Runs once per source (C8): the function has no source-specific branch."""
    cleaned = null_suspicious_zero_km(null_year_out_of_range(null_zero_price(records), year_max))
    return dedup_first(cleaned, "cod", order, partitions)


def null_profile(raw: DataFrame, clean: DataFrame, by: str | None = None) -> DataFrame:
    """Rows in, rows out and null counts of price, year and km (per ``by`` group)."""
    keys = [by] if by else []
    rin = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_in"))
    rout = clean.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_out"),
        F.count_if(F.col("precio_ars").isNull()).alias("null_precio_ars"),
        F.count_if(F.col("anio").isNull()).alias("null_anio"),
        F.count_if(F.col("km").isNull()).alias("null_km"),
    )
    if not keys:
        return rin.crossJoin(rout)  # two one-row aggregates
    return rin.join(rout, keys, "full")


def stamp_source(df: DataFrame, source: str) -> DataFrame:
    """Silver carries no source column; the load stamps the run's source."""
    return df.withColumn("source", F.lit(source))
