"""Day-partitioned Parquet tables: write, read one day, latest day, preferred-or-latest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.sources import storage


def write_day_partitions(df: DataFrame, root: str, day_col: str, spread_by: Sequence[str] | None = None) -> None:
    """Parquet partitioned by ``day_col``; rewriting a day replaces only that day
    (dynamic overwrite), so re-running a day is idempotent.

    Range partitioning on (day, spread key) samples the keys first, so one huge day
    is cut over many tasks instead of landing in one. The default spread key is a
    deterministic hash of the whole row (repeated keys still spread)."""
    spread = [F.col(c) for c in spread_by] if spread_by else [F.xxhash64(*[F.col(c) for c in df.columns])]
    keys = [F.col(day_col), *spread]
    (df.repartitionByRange(*keys)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(day_col).parquet(root))


def replace_day(df: DataFrame, root: str, day_col: str, day) -> None:
    """S4 for a day that may have no rows: its partition is replaced, or goes."""
    storage.delete(df.sparkSession, f"{root}/{day_col}={day}")
    write_day_partitions(df, root, day_col)


def read_table(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root)


def read_day(spark: SparkSession, root: str, day_col: str, day) -> DataFrame:
    """One day; the filter on the partition column prunes folders (PartitionFilters)."""
    return read_table(spark, root).where(F.col(day_col) == F.lit(str(day)).cast("date"))


def latest_day_frame(df: DataFrame, day_col: str) -> DataFrame:
    """S6 as a one-row frame: ``max(day_col)`` (reads no data column of the files)."""
    return df.agg(F.max(day_col).alias("latest"))


def latest_day(df: DataFrame, day_col: str):
    """Latest partition day; an empty table is an error."""
    d = latest_day_frame(df, day_col).first()["latest"]
    if d is None:
        raise FileNotFoundError("table has no partitions")
    return d


def chosen_day(df: DataFrame, day_col: str, day) -> Column:
    """The requested day when that partition exists, else the latest day (which
    may be later than the one requested) — one scalar subquery, evaluated once."""
    want = F.lit(str(day)).cast("date")
    return df.select(F.coalesce(F.max(F.when(F.col(day_col) == want, F.col(day_col))),
                                F.max(day_col))).scalar()


def read_preferred_or_latest(df: DataFrame, day_col: str, day) -> DataFrame:
    """Rows of the chosen day (partition pruned at run time)."""
    return df.where(F.col(day_col) == chosen_day(df, day_col, day))


def days(spark: SparkSession, root: str, day_col: str) -> list[dt.date]:
    """The days that have a partition, ascending: one folder listing, no file is opened."""
    prefix = f"{day_col}="
    return [dt.date.fromisoformat(n[len(prefix):]) for n in storage.names(spark, root)
            if n.startswith(prefix) and n[len(prefix):] != "__HIVE_DEFAULT_PARTITION__"]


def last_day(spark: SparkSession, root: str, day_col: str) -> dt.date:
    """S6 on a stored table: its latest partition; a table without partitions is an error."""
    found = days(spark, root, day_col)
    if not found:
        raise FileNotFoundError(f"no partitions under {root}")
    return found[-1]


def read_day_or_last(spark: SparkSession, root: str, day_col: str, day) -> DataFrame:
    """S7 on a stored table: the requested day where it has a partition, else the latest one."""
    want = dt.date.fromisoformat(str(day))
    return read_day(spark, root, day_col, want if want in days(spark, root, day_col) else last_day(spark, root, day_col))
