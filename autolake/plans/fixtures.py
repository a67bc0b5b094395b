"""Driver tables -> domain views (listings, FX, requests), as specified in FIXTURES.md.

The driver ships TPC-H-style tables; these functions re-shape them into the
records the pipeline expects, so every operator runs over whole tables whose
size grows with the scale factor. ``_ord`` is the input order of a listing
inside its ``cod`` (what file position is in a real bronze load).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.functions.columns import NEW_CONDITION

# Run day of the listing views: years are valid up to 2001.
RUN_YEAR = 2001
RUN_DAY = "2001-12-31"
# Run day of the estimate requests (upper bound of a request year).
REQUEST_RUN_YEAR = 2026

# FX house by the first character of the order priority (fixed mapping of the fixture).
HOUSE_BY_PRIORITY = [("1", "blue"), ("2", "oficial"), ("3", "mep"), ("4", "ccl")]
OTHER_HOUSE = "cripto"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze listing records: one per lineitem row, with duplicates of ``cod``."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation is a fixed 25-row table: a proven broadcast bound
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(supp, li.l_suppkey == supp.s_suppkey)
           .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    cond = F.when(F.col("l_returnflag") == "N", F.lit(NEW_CONDITION)).otherwise(F.lit("Usado"))
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("cod"),
        F.col("p_brand").alias("marca"),
        F.col("p_name").alias("modelo"),
        cond.alias("condicion"),
        F.col("n_name").alias("provincia"),
        F.when(F.col("l_discount") == 0.0, F.lit(0).cast("bigint"))
         .otherwise(F.floor(F.col("l_extendedprice") * 100).cast("bigint")).alias("precio_ars"),
        (F.year("l_shipdate") - F.col("p_size") % 10
         + F.when(F.col("l_tax") == 0.08, 3).otherwise(0)).cast("int").alias("anio"),
        F.when(F.col("l_quantity") == 1, F.lit(0).cast("bigint"))
         .when(F.col("l_quantity") == 2, F.lit(1).cast("bigint"))
         .otherwise((F.col("l_quantity") * 3000).cast("bigint")).alias("km"),
        F.concat(F.lit("/vendo/"), F.replace(F.col("p_brand"), F.lit(" "), F.lit("-")), F.lit("/"),
                 F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit("/"), cond, F.lit("/"),
                 F.col("n_name"), F.lit("?cod="),
                 (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")).alias("path"),
        (F.col("l_linenumber") % 3).cast("tinyint").alias("segmento"),
        F.when(F.col("l_linestatus") == "F", F.lit("a")).otherwise(F.lit("b")).alias("source"),
        F.col("l_shipdate").cast("date").alias("scraped_day"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus").alias("_ord"),
    )


def fx_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX rates, one row per (fecha, casa): compra = min, venta = max of the order totals / 100."""
    o = table(spark, sf_dir, "orders")
    prio = F.substring("o_orderpriority", 1, 1)
    casa = F.lit(OTHER_HOUSE)
    for p, h in reversed(HOUSE_BY_PRIORITY):
        casa = F.when(prio == p, F.lit(h)).otherwise(casa)
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("fecha"), casa.alias("casa"))
             .agg((F.min("o_totalprice") / 100).alias("compra"),
                  (F.max("o_totalprice") / 100).alias("venta")))


def fx_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX records with the feed's descriptive name and the ingest stamp (input of F1)."""
    return (fx_records(spark, sf_dir)
            .withColumn("nombre", F.concat(F.lit("Dolar "), F.col("casa")))
            .withColumn("fetched_at", F.concat(F.col("fecha").cast("string"), F.lit("T12:00:00+00:00"))))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimate requests, one per part; every tenth has an invalid km of -1."""
    part = table(spark, sf_dir, "part")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    return (part.join(nation, F.col("p_partkey") % 25 == F.col("n_nationkey"))
                .select(F.col("p_partkey").alias("req_id"), F.col("p_brand").alias("marca"),
                        F.col("p_name").alias("modelo"), F.col("n_name").alias("provincia"),
                        (F.lit(1985) + F.col("p_size")).cast("int").alias("anio"),
                        F.when(F.col("p_partkey") % 10 == 0, F.lit(-1).cast("bigint"))
                         .otherwise(F.col("p_partkey") * 100).alias("km")))


def model_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model registry keys: urgent orders name a dated model folder, the rest an
    undated run folder (no date to parse)."""
    o = table(spark, sf_dir, "orders")
    key = F.when(F.substring("o_orderpriority", 1, 1) == "1",
                 F.concat(F.lit("models/gbt/fecha="), F.col("o_orderdate").cast("date").cast("string"))
                 ).otherwise(F.concat(F.lit("models/gbt/run-"), F.col("o_orderkey").cast("string")))
    return o.select(key.alias("key")).distinct()


def raw_listings(records: DataFrame) -> DataFrame:
    """Listing records as a feed delivers them: every field as text, some of them no numbers (a
    year 's/d' where it is a multiple of 11, a km 'consultar' where it is one of 21000)."""
    text = {"cod": F.col("cod"), "marca": F.col("marca"), "modelo": F.col("modelo"), "condicion": F.col("condicion"),
            "provincia": F.col("provincia"), "precio_ars": F.col("precio_ars").cast("string"),
            "anio": F.when(F.col("anio") % 11 == 0, "s/d").otherwise(F.col("anio").cast("string")),
            "km": F.when((F.col("km") > 0) & (F.col("km") % 21000 == 0), "consultar").otherwise(F.col("km").cast("string")),
            "segmento": F.col("segmento").cast("string"), "url": F.col("path")}
    return records.select(*[c.alias(n) for n, c in text.items()], "source", "_ord")


# ---------------------------------------------------------------- pages built from listings
# The driver's own pages hold no listing links; these builders render silver rows
# as the two sites' HTML so the extraction jobs can parse them back.

def _txt(c):
    return F.coalesce(c.cast("string"), F.lit(""))


def index_pages(rows: DataFrame) -> DataFrame:
    """A search-result page per row: its listing link among site links."""
    html = F.concat(F.lit('<html><body><nav><a href="/ayuda">ayuda</a><a href="/bus.asp?segmento='),
                    F.col("segmento").cast("string"), F.lit('">volver</a></nav><ul><li><a href="'),
                    F.col("path"), F.lit('" class="item">'), _txt(F.col("marca")), F.lit(" "),
                    _txt(F.col("modelo")), F.lit("</a></li></ul></body></html>"))
    return rows.select("segmento", "source", html.alias("html"))


def detail_pages(rows: DataFrame) -> DataFrame:
    """A detail page per row with price, year and km in hidden inputs (empty when null)."""
    def inp(name, c):
        return F.concat(F.lit(f'<input type="hidden" name="{name}" id="{name}" value="'), _txt(c), F.lit('">'))
    html = F.concat(F.lit("<html><body><form>"), inp("precio", F.col("precio_ars")), inp("anio", F.col("anio")),
                    inp("kilometraje", F.col("km")), F.lit("</form></body></html>"))
    # the fetch time of a detail page is the listing's scrape time
    return rows.select("path", html.alias("html"), F.col("scraped_day").alias("fetched_at"))


def card_pages(rows: DataFrame) -> DataFrame:
    """A results page per row: one listing card (title, subtitle, an instalment amount
    below the price floor, the price) plus a non-listing anchor."""
    price = F.when(F.col("precio_ars").isNotNull(),
                   F.concat(F.lit("<div><span>$</span> "), F.translate(F.format_number("precio_ars", 0), ",", "."),
                            F.lit("</div>"))).otherwise(F.lit(""))
    card = F.concat(F.lit('<a href="/ar/venta/'), F.col("cod"), F.lit('/" class="card">'),
                    F.lit("<h3>"), _txt(F.col("marca")), F.lit(" • "), _txt(F.col("modelo")), F.lit("</h3>"),
                    # a missing year shows as a non-numeric placeholder
                    F.lit("<p>"), F.coalesce(F.col("anio").cast("string"), F.lit("s/d")), F.lit(" • "),
                    F.translate(F.format_number(F.coalesce(F.col("km"), F.lit(0)), 0), ",", "."),
                    F.lit(" km • 1.6 • Manual</p><div>Cuota $ 150.000</div>"), price,
                    F.lit('<span class="x_footerInfo_y">'), _txt(F.col("provincia")), F.lit("</span></a>"))
    html = F.concat(F.lit('<html><body><a href="/ar/usados">todos</a>'), card, F.lit("</body></html>"))
    return rows.select("marca", html.alias("html"))
