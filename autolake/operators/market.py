"""Market queries over the serving listings table (Q1-Q11).

The serving table has one row per listing with ``precio_estimado`` and
``oportunidad_score`` (null until scored). Filters are ``Column`` trees, so they
reach the Parquet scan as pushed filters; top-k queries plan as
``TakeOrderedAndProject`` (a bounded heap per task, no global sort).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autolake.functions.columns import (OPPORTUNITY_THRESHOLD, contains_ci, js_round,
                                        tenths_percent_label, thousands)
from autolake.functions.joins import BROADCAST_MAX_BYTES, dense_index, stored_size

# Fixed values of the serving queries.
SEARCH_COLUMNS = ["cod", "marca", "modelo", "anio", "km", "precio_ars", "provincia",
                  "oportunidad_score", "url"]
TOP_COLUMNS = ["cod", "marca", "modelo", "anio", "km", "precio_ars", "precio_estimado",
               "oportunidad_score", "provincia", "url"]
BOARD_COLUMNS = ["cod", "marca", "modelo", "anio", "provincia", "precio_ars", "precio_estimado",
                 "oportunidad_score", "url"]
FEED_COLUMNS = ["cod", "marca", "modelo", "provincia", "precio_ars", "anio", "km", "url"]
SEARCH_LIMIT = 10
TOP_DEFAULT, TOP_MAX = 5, 10
BOARD_LIMIT = 20
FEED_LIMIT = 1000
UNKNOWN_KM = "—"
DISCOUNT_PREFIX = " 🔥 "
DISCOUNT_SUFFIX = "% subvaluado"
# the two listing sites (a: detail pages, b: cards); serving rows of site a have relative links
BASE_URL = "https://www.example.com.ar"
CARD_BASE_URL = "https://cards.example.com"
# up to 128 ranges Spark compares a row with one bound after the other
BISECTED_RANGES = 200


@dataclass
class SearchFilter:
    """Q1 arguments. Text filters are case-insensitive substrings; a numeric bound of
    0 or None is 'no bound' (the reference tests truthiness)."""
    marca: str | None = None
    modelo: str | None = None
    provincia: str | None = None
    anio_min: int | None = None
    anio_max: int | None = None
    km_min: int | None = None
    km_max: int | None = None
    precio_max: int | None = None
    solo_oportunidades: bool = False


def search_predicate(f: SearchFilter) -> Column:
    """AND of the given filters. Both bounds of a range apply (the
    reference sends only the max when both are given; we apply both on purpose).
    SQL nulls never match a bound."""
    preds = [F.lit(True)]
    for c in ("marca", "modelo", "provincia"):
        v = getattr(f, c)
        if v:
            preds.append(contains_ci(F.col(c), v))
    for c, lo, hi in (("anio", f.anio_min, f.anio_max), ("km", f.km_min, f.km_max),
                      ("precio_ars", None, f.precio_max)):
        if lo:
            preds.append(F.col(c) >= lo)
        if hi:
            preds.append(F.col(c) <= hi)
    if f.solo_oportunidades:
        preds.append(F.col("oportunidad_score") >= OPPORTUNITY_THRESHOLD)
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def search(serving: DataFrame, f: SearchFilter, limit: int = SEARCH_LIMIT) -> DataFrame:
    """Q1: filtered search, best score first (nulls last), ``cod`` breaks ties."""
    return (serving.where(search_predicate(f))
                   .orderBy(F.desc_nulls_last("oportunidad_score"), "cod")
                   .limit(limit).select(*SEARCH_COLUMNS))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def result_lines(rows: DataFrame) -> DataFrame:
    """Q1d: one display line per row, thousands separators, and a discount label only
    when the score reaches the threshold."""
    score = F.col("oportunidad_score")
    label = F.when(score >= OPPORTUNITY_THRESHOLD,
                   F.concat(F.lit(DISCOUNT_PREFIX), tenths_percent_label(score), F.lit(DISCOUNT_SUFFIX))
                   ).otherwise(F.lit(""))
    line = F.concat(F.lit("- "), _text(F.col("marca")), F.lit(" "), _text(F.col("modelo")), F.lit(" "),
                    _text(F.col("anio")), F.lit(" | "), F.coalesce(thousands(F.col("km")), F.lit("None")),
                    F.lit(" km | $"), F.coalesce(thousands(F.col("precio_ars")), F.lit("None")), label,
                    F.lit(" | "), _text(F.col("provincia")), F.lit(" | "), _text(F.col("url")))
    return rows.select("cod", line.alias("line"))


def top_opportunities(serving: DataFrame, marca: str | None = None, provincia: str | None = None,
                      limite: int = TOP_DEFAULT) -> DataFrame:
    """Q2 + Q2a: score >= threshold, optional brand/province substring, at most 10 rows,
    with the savings ``coalesce(estimate, 0) - coalesce(price, 0)``."""
    p = F.col("oportunidad_score") >= OPPORTUNITY_THRESHOLD
    if marca:
        p = p & contains_ci(F.col("marca"), marca)
    if provincia:
        p = p & contains_ci(F.col("provincia"), provincia)
    ahorro = F.coalesce(F.col("precio_estimado"), F.lit(0)) - F.coalesce(F.col("precio_ars"), F.lit(0))
    return (serving.where(p).orderBy(F.desc("oportunidad_score"), "cod")
                   .limit(min(limite, TOP_MAX)).select(*TOP_COLUMNS, ahorro.alias("ahorro")))


def opportunity_lines(top: DataFrame) -> DataFrame:
    """Q2 display lines of ``top_opportunities`` rows: listed and estimated price, savings and percent."""
    money = lambda c: F.coalesce(thousands(F.col(c)), F.lit("None"))
    line = F.concat(F.lit("- "), _text(F.col("marca")), F.lit(" "), _text(F.col("modelo")), F.lit(" "), _text(F.col("anio")),
                    F.lit(" | "), money("km"), F.lit(" km | Publicado: $"), money("precio_ars"),
                    F.lit(" | Estimado: $"), money("precio_estimado"), F.lit(" | Ahorro: $"), money("ahorro"), F.lit(" ("),
                    tenths_percent_label(F.col("oportunidad_score")), F.lit("%) | "), _text(F.col("provincia")),
                    F.lit(" | "), _text(F.col("url")))
    return top.select("cod", line.alias("line"))


def absolute_url(url: Column, base: str) -> Column:
    """P6g / Q3: keep absolute URLs, prefix relative ones with the site."""
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(base), url))


def opportunity_board(serving: DataFrame, limit: int = BOARD_LIMIT) -> DataFrame:
    """Q3: score strictly above the threshold, top 20, savings, whole percent (half up)
    and an absolute link."""
    return (serving.where(F.col("oportunidad_score") > OPPORTUNITY_THRESHOLD)
                   .orderBy(F.desc("oportunidad_score"), "cod").limit(limit)
                   .select(*[c for c in BOARD_COLUMNS if c != "url"],
                           (F.col("precio_estimado") - F.col("precio_ars")).alias("ahorro"),
                           js_round(F.col("oportunidad_score") * 100).cast("bigint").alias("pct"),
                           absolute_url(F.col("url"), BASE_URL).alias("url")))


def recent_feed(serving: DataFrame, order_col: str = "scraped_at", limit: int = FEED_LIMIT) -> DataFrame:
    """Q4: the newest listings (nulls first, like the database's default for DESC)."""
    return (serving.orderBy(F.desc_nulls_first(order_col), "cod").limit(limit)
                   .select(*FEED_COLUMNS))


def facets(feed: DataFrame) -> DataFrame:
    """Q5: sorted distinct brands and provinces of a feed (long format ``facet, value``)."""
    m = feed.select(F.lit("marca").alias("facet"), F.col("marca").alias("value"))
    p = feed.select(F.lit("provincia").alias("facet"), F.col("provincia").alias("value"))
    return m.unionByName(p).distinct().orderBy("facet", "value")


def table_predicate(marca: str = "", provincia: str = "", anio_min: str = "", anio_max: str = "",
                    precio_max: str = "", search_text: str = "") -> Column:
    """Q6: the table's client filters. Empty string = off. Numbers compare with nulls
    as 0 (so a null passes a max bound and fails a min bound); the text search is a
    substring of model OR brand."""
    p = F.lit(True)
    if marca:
        p = p & (F.col("marca") == marca)
    if provincia:
        p = p & (F.col("provincia") == provincia)
    if anio_min:
        p = p & (F.coalesce(F.col("anio"), F.lit(0)) >= int(anio_min))
    if anio_max:
        p = p & (F.coalesce(F.col("anio"), F.lit(0)) <= int(anio_max))
    if precio_max:
        p = p & (F.coalesce(F.col("precio_ars"), F.lit(0)) <= int(precio_max))
    if search_text:
        p = p & (contains_ci(F.col("modelo"), search_text) | contains_ci(F.col("marca"), search_text))
    return p


def user_sort(df: DataFrame, key: str, ascending: bool = True, collation: str = "es",
              max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Q7: sort on one of five columns. Text uses the Spanish collation; numbers
    treat null as 0. ``cod`` makes the order total.

    Comparing two texts by a collation is slow, and a sort compares a row with bounds of the ranges and
    then with other rows. Texts of at most ``max_bytes`` are therefore put in order once each, and the rows are
    sorted by their text's place (equal texts of the collation share one; null has none and stays
    first or last). Beyond the bound the rows are sorted by the collation, in so many ranges that Spark
    finds a row's by bisection."""
    order = lambda c: [c.asc() if ascending else c.desc(), F.col("cod").asc()]
    if key not in ("marca", "modelo"):
        return df.orderBy(*order(F.coalesce(F.col(key), F.lit(0))))
    collated = F.collate(F.col(key), collation)
    texts, size = stored_size(df.select(key).where(F.col(key).isNotNull()).distinct())
    if size > max_bytes:
        n = max(BISECTED_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        return df.repartitionByRange(n, *order(collated)).sortWithinPartitions(*order(collated))
    ranked = dense_index(texts.select(collated.alias("_text")), "_text", "_place")
    places = texts.join(F.broadcast(ranked), collated == F.col("_text")).select(key, "_place")
    return df.join(F.broadcast(places), key, "left").orderBy(*order(F.col("_place"))).select(*df.columns)


def relative_price(serving: DataFrame) -> DataFrame:
    """Q8: price as a percent of the highest price of the unfiltered table (at least 1).
    The maximum is a one-row aggregate, cross-joined as a broadcast."""
    top = serving.agg(F.greatest(F.coalesce(F.max("precio_ars"), F.lit(0)), F.lit(1)).alias("_max"))
    return (serving.crossJoin(F.broadcast(top))
                   .select("cod", (F.coalesce(F.col("precio_ars"), F.lit(0)) / F.col("_max") * 100)
                           .alias("pct_of_max")))


def match_counter(df: DataFrame, pred: Column) -> DataFrame:
    """Q9: rows passing the table filters, and all rows."""
    return df.agg(F.count_if(pred).alias("filtered"), F.count(F.lit(1)).alias("total"))


def km_display(km: Column) -> Column:
    """Q10: an unknown km (null, 0 or 1) shows a dash; else '154.267 km'."""
    return (F.when(F.coalesce(km, F.lit(0)) <= 1, F.lit(UNKNOWN_KM))
             .otherwise(F.concat(thousands(km, "."), F.lit(" km"))))


def market_metrics(serving: DataFrame, day_col: str = "fecha") -> DataFrame:
    """Q11: total rows, rows above the threshold, latest day and the threshold, in one pass."""
    return serving.agg(F.count(F.lit(1)).alias("total_autos"),
                       F.count_if(F.col("oportunidad_score") > OPPORTUNITY_THRESHOLD).alias("total_oportunidades"),
                       F.max(day_col).alias("ultima_fecha_scraping"),
                       F.lit(OPPORTUNITY_THRESHOLD).alias("threshold_oportunidad"))
