"""Exchange-rate operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autolake.functions.columns import BLUE, FEATURED_HOUSES, js_round
from autolake.functions.joins import bounded_broadcast


def normalize_fx(records: DataFrame, day=None) -> DataFrame:
    """typed FX silver ``fecha, casa, nombre, compra, venta, fetched_at``.

    ``records`` are exploded bronze rows (S3). With ``day`` the date is the run
    literal, as in the reference; without it the records must carry ``fecha``."""
    fecha = F.lit(str(day)).cast("date") if day is not None else F.col("fecha").cast("date")
    return records.select(
        fecha.alias("fecha"),
        F.col("casa").cast("string").alias("casa"),
        F.col("nombre").cast("string").alias("nombre"),
        F.col("compra").cast("double").alias("compra"),
        F.col("venta").cast("double").alias("venta"),
        F.col("fetched_at").cast("string").alias("fetched_at"),
    )


def latest_panel(fx: DataFrame) -> DataFrame:
    """F2 + F3: every rate of the latest day, highest ``venta`` first (nulls first,
    as the serving database orders by default), with a ``featured`` flag."""
    latest = fx.select(F.max("fecha")).scalar()
    return (fx.where(F.col("fecha") == latest)
              .withColumn("featured", F.col("casa").isin(FEATURED_HOUSES))
              .orderBy(F.desc_nulls_first("venta"), "casa"))


def rate_on_day(df: DataFrame, fx: DataFrame, day_col: str = "scraped_day",
                house: str = BLUE, out: str = "dolar_blue_venta") -> DataFrame:
    """the ``house`` selling rate on each row's day, null when that day has none.

    The rate table holds at most one row per calendar day, so it is broadcast after
    a checked row count (see ``bounded_broadcast``)."""
    rates = (fx.where(F.col("casa") == house)
               .select(F.col("fecha").alias("_fx_day"), F.col("venta").alias(out)))
    rates = bounded_broadcast(rates)
    return (df.join(rates, F.col(day_col) == F.col("_fx_day"), "left").drop("_fx_day"))


def latest_rate(fx: DataFrame, house: str = BLUE) -> DataFrame:
    """last known rate of ``house`` (one row: ``fecha``, ``venta``)."""
    return (fx.where(F.col("casa") == house)
              .agg(F.max("fecha").alias("fecha"), F.max_by("venta", "fecha").alias("venta")))


def asof_rate(df: DataFrame, fx: DataFrame, day_col: str = "scraped_day",
              house: str = BLUE, out: str = "dolar_blue_venta_asof") -> DataFrame:
    """Last rate on or before each row's day.

    The rate series is small (one row per day); its as-of table is built over the
    distinct days of ``df`` united with the rate days, and joined back by day."""
    rates = fx.where(F.col("casa") == house).select(F.col("fecha").alias("_d"), F.col("venta").alias("_v"))
    days = df.select(F.col(day_col).alias("_d")).distinct().withColumn("_v", F.lit(None).cast("double"))
    # within a year by a window per year; before its first rate, what earlier years left
    # (a table of one row per year)
    both = rates.withColumn("_rate", F.lit(1)).unionByName(days.withColumn("_rate", F.lit(0))).withColumn("_y", F.year("_d"))
    w = Window.partitionBy("_y").orderBy("_d", F.col("_rate").desc()).rowsBetween(Window.unboundedPreceding, 0)
    last = both.groupBy("_y").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_d"))).alias("_end"))
    earlier = Window.orderBy("_y").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("_y", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    series = (both.withColumn("_own", F.last("_v", ignorenulls=True).over(w)).where(F.col("_rate") == 0)
                  .join(carried, "_y", "left")
                  .select("_d", F.coalesce("_own", "_carried").alias(out)))
    return df.join(bounded_broadcast(series), F.col(day_col) == F.col("_d"), "left").drop("_d")


def usd_price(price: Column, rate: Column) -> Column:
    """ARS -> USD rounded half up; null when the rate is null or 0."""
    return js_round(F.try_divide(price.cast("double"), F.nullif(rate, F.lit(0.0)))).cast("bigint")


def ars_bound(rate: Column, usd: Column) -> Column:
    """USD budget -> ARS bound, truncated toward zero."""
    return (rate * usd).cast("bigint")
