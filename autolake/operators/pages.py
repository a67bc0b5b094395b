"""Record extraction from fetched web pages (P1-P7), as Spark jobs over a
``pages(url/path, html)`` table. Only native regex and string expressions.

Patterns stay inside the subset shared by Java regex and RE2 (no look-around,
no back-references), so the same pattern can be checked in another engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.functions.columns import unescape_html
from autolake.functions.joins import bounded_broadcast
from autolake.operators.market import absolute_url
from autolake.session import work_dir
from autolake.sources import sinks

# The patterns of the two listing sites.
LISTING_LINK = r"""/vendo/[^\s"<']+"""
LISTING_PATH = r"^/vendo/([^/]+)/([^/]+)/([^/]+)/([^?]+)\?cod=(\d+)"
HIDDEN_INPUT = r'name="{name}"[^>]+value="([^"]*)"'
DETAIL_FIELDS = [("precio", "precio_ars"), ("anio", "anio"), ("kilometraje", "km")]
CARD_MARKER = "/ar/venta/"
CARD_ANCHOR = r"""(?s)<a\s[^>]*href\s*=\s*(?:"[^"]*/ar/venta/[^"]*"|'[^']*/ar/venta/[^']*')[^>]*>.*?</a>"""
TITLE_SEP = " • "
AMOUNT = r"\d{1,3}(?:\.\d{3})+"
MIN_PRICE = 1_000_000
FOOTER_SPAN = r"""(?s)<span[^>]*class\s*=\s*["'][^"']*footerInfo[^"']*["'][^>]*>(.*?)</span>"""
CARD_CONDITION = "Usado"


def extract_links(pages: DataFrame, html: str = "html", pattern: str = LISTING_LINK, group: int = 0,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Every match of ``pattern`` in each page, distinct (per ``keep`` columns)."""
    return (pages.select(*keep, F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), group))
                         .alias("link"))
                 .distinct())


def new_links(page_links: DataFrame, seen: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(new, seen') with new = page - seen and seen' = seen ∪ new, both distinct.
    The difference is a left-anti join on ``keys``."""
    fresh = page_links.select(*keys).distinct().join(seen.select(*keys), list(keys), "left_anti")
    return fresh, seen.select(*keys).unionByName(fresh).distinct()


def take_new(spark: SparkSession, root: str, page_links: DataFrame, keys: Sequence[str], batch: str) -> DataFrame:
    """P2 across runs: the links that no other batch has seen, which are then in the seen-set under ``root``.

    The seen-set is a table of (keys, batch) in buckets by a hash of the keys; only the buckets that
    the page's links fall into are read, and merged anew. The page's links are sent to the stored
    side (checked broadcast), which is scanned and not shuffled. Running a batch again gives the
    same links again."""
    keys = list(keys)
    links = page_links.select(*keys).distinct()
    now = sinks.table_version(spark, root)
    if now is not None:
        links = bounded_broadcast(links)
        known = sinks.read_touched(spark, root, now, links, keys).where(F.col("batch") != batch).join(links, keys, "left_semi").select(*keys)
        links = links.join(bounded_broadcast(known), keys, "left_anti")
    work_dir(spark)
    fresh = links.checkpoint(eager=True)      # what is new is settled before the set grows
    sinks.merge(spark, root, fresh.withColumn("batch", F.lit(batch)), keys, update_cols=[])
    return fresh


def parse_listing_path(df: DataFrame, path: str = "path") -> DataFrame:
    """Brand, model, condition, province and code from a listing path; '-' means
    a space in brand, model and province (not in condition). Paths that do not
    match are dropped."""
    p = F.col(path)
    g = [F.regexp_extract(p, LISTING_PATH, i) for i in range(1, 6)]
    dash = lambda c: F.replace(c, F.lit("-"), F.lit(" "))
    return (df.where(p.rlike(LISTING_PATH))
              .withColumn("marca", dash(g[0])).withColumn("modelo", dash(g[1]))
              .withColumn("condicion", g[2]).withColumn("provincia", dash(g[3]))
              .withColumn("cod", g[4]))


def hidden_inputs(df: DataFrame, html: str = "html") -> DataFrame:
    """Price, year and km from hidden inputs; a page missing any of them, with an
    empty value or a non-integer one, is dropped ("0" is kept)."""
    out = df
    for name, col in DETAIL_FIELDS:
        raw = F.regexp_extract(F.col(html), HIDDEN_INPUT.format(name=name), 1)
        out = out.withColumn(col, F.nullif(raw, F.lit("")).try_cast("bigint"))
    return out.dropna(subset=[c for _, c in DETAIL_FIELDS])


def assemble(links: DataFrame, details: DataFrame, scraped_at: Column, base: str, path: str = "path", url: str | None = None) -> DataFrame:
    """P5: parsed link fields joined with the detail fields of the same path, plus the
    absolute URL on the site ``base`` and the scrape time (e.g. the detail page's fetch
    time). Details are unique by ``path``; ``url`` is the column of the listing's path on the
    site, where ``path`` is only its digest."""
    return (links.join(details, path)
                 .withColumn("url", absolute_url(F.col(url or path), base))
                 .withColumn("scraped_at", scraped_at))


def split_cards(pages: DataFrame, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """One row per anchor that links to a listing (``/ar/venta/``)."""
    return pages.select(*keep, F.explode(F.regexp_extract_all(F.col(html), F.lit(CARD_ANCHOR), 0)).alias("card"))


def _strip_tags(c: Column, sep: str = "|") -> Column:
    return F.regexp_replace(c, r"<[^>]*>", sep)


def parse_cards(cards: DataFrame, base: str, card: str = "card", id_prefix: str = "b-", source: str = "b") -> DataFrame:
    """P6b-P6g: slug/id, title split (fewer than 2 parts: dropped), subtitle year (all
    digits, else null) and km (non-digits: 0), price = last amount >= 1,000,000
    (none: dropped), footer province ('' when absent), absolute URL on the site
    ``base``, segment 0 and the source. Attributes may stand in single or double quotes;
    character references in texts are decoded; numbers beyond their type read as absent.

    Each field is extracted from the card once: the fields leave a generator, below which
    no filter on them is pushed, and character references, which name their text several
    times, are decoded above it. A missing subtitle reads as an empty one (no year, km 0)."""
    c = F.col(card)
    text = lambda tag: _strip_tags(F.regexp_extract(c, tag, 1), "")
    fields = F.struct(
        F.regexp_extract(c, r"""href\s*=\s*["']([^"']*)["']""", 1).alias("_href"),
        text(r"(?s)<h3[^>]*>(.*?)</h3>").alias("_title"),
        text(r"(?s)<p[^>]*>(.*?)</p>").alias("_sub"),
        F.regexp_extract_all(_strip_tags(c), F.lit(AMOUNT), 0).alias("_amounts"),
        text(FOOTER_SPAN).alias("provincia"))
    raw = cards.select("*", F.inline(F.array(fields)))
    raw = raw.select(*cards.columns, "_amounts", unescape_html(F.col("_href")).alias("_href"),
                     *[F.trim(unescape_html(F.col(x))).alias(x) for x in ("_title", "_sub", "provincia")])
    amounts = F.transform("_amounts", lambda a: F.replace(a, F.lit("."), F.lit("")).try_cast("bigint"))
    step = raw.select("*", F.split("_title", TITLE_SEP).alias("_t"), F.split("_sub", TITLE_SEP).alias("_s"),
                      F.try_element_at(F.filter(amounts, lambda a: a >= MIN_PRICE), F.lit(-1)).alias("precio_ars"))
    year_txt = F.element_at("_s", 1)
    km_txt = F.trim(F.replace(F.replace(F.try_element_at("_s", F.lit(2)), F.lit("km"), F.lit("")),
                              F.lit("."), F.lit("")))
    slug = F.rtrim(F.element_at(F.split("_href", CARD_MARKER), -1), F.lit("/"))
    keep = [x for x in cards.columns if x != card]
    return (step.where(F.col("_href").contains(CARD_MARKER) & (F.size("_t") >= 2) & F.col("precio_ars").isNotNull())
                .select(*keep,
                        F.concat(F.lit(id_prefix), slug).alias("cod"),
                        F.trim(F.col("_t")[0]).alias("marca"),
                        F.trim(F.col("_t")[1]).alias("modelo"),
                        F.lit(CARD_CONDITION).alias("condicion"),
                        "provincia", "precio_ars",
                        F.when(year_txt.rlike(r"^[0-9]+$"), year_txt.try_cast("int")).alias("anio"),
                        F.coalesce(F.when(km_txt.rlike(r"^[0-9]+$"), km_txt.try_cast("bigint")),
                                   F.lit(0).cast("bigint")).alias("km"),
                        absolute_url(F.col("_href"), base).alias("url"),
                        F.lit(0).alias("segmento"), F.lit(source).alias("source")))


def first_seen(cards: DataFrame, key: str = "cod", order: str = "brand_ord") -> DataFrame:
    """A card already seen under an earlier brand page is dropped; repeats inside
    the first brand page survive. The earliest page per key is a map-side-combined
    aggregate joined back (left-semi) on (key, order)."""
    work_dir(cards.sparkSession)
    # stored: the join then sees two plain shuffles and AQE may split a hot key's rows
    first = cards.groupBy(key).agg(F.min(order).alias(order)).checkpoint(eager=True)
    return cards.join(first, [key, order], "left_semi")
