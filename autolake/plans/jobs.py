"""Batch jobs (J1-J4): the operators composed into the daily pipeline.

Layout under ``lake`` (a shared filesystem path):
  raw/dolar/fecha=<day>/             fetched answers of the rates feed (JSON lists)
  raw/<s>/{index,detail,cards}/fecha=<day>/  fetched page files of a source
  seen/<s>/fecha=<day>               links of the day's batches (keyed, in buckets)
  bronze/dolar/fecha=<day>/          FX envelopes (one JSON document per day)
  bronze/listings/source=<s>/scraped_day=<day>/  listing records (JSON lines)
  silver/dolar, silver/listings/source=<s>   Parquet, partitioned by day
  gold/listings                      Parquet, partitioned by day
  serving/dolar, serving/listings    versioned keyed tables (buckets, named by _log/<n>)
  quarantine/listings/source=<s>     records that could not be read, with the reason
  models/fecha=<day>, models/_registry, runs

Every step passes ``day`` explicitly; an exception stops the job and leaves
earlier committed data untouched (serving tables switch version only after a
complete write). Re-running a day gives the same state (J4): day partitions are
overwritten dynamically and serving tables are keyed upserts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autolake import schemas
from autolake.functions.columns import OPPORTUNITY_THRESHOLD
from autolake.functions.joins import keep_first
from autolake.operators import clean, features, fx, market, model, pages
from autolake.session import scratch_path, work_dir
from autolake.sources import bronze, partitions, registry, sinks, storage
from autolake.sources import pages as source_pages

# The columns a conflicting row updates (listings keep the old descriptive
# columns; FX rates take every value of the new row).
PARTIAL_UPDATE = ["fecha", "precio_ars", "km", "scraped_at", "segmento", "source"]
ENVELOPE_RECORDS = 10_000
BAD_SHARE = 0.05        # of a day's records, beyond which its silver job fails
FX_UPDATE = ["nombre", "compra", "venta", "fetched_at"]


def enforce_contract(rows: DataFrame, contract: dict) -> dict:
    """S12 before a load: one aggregate of violation counts. Nulls in NOT NULL columns
    and repeated keys fail the load (as the serving database would reject it); text
    longer than its declared size is reported only (no length limit is stored)."""
    v = sinks.contract_violations(rows, contract).first().asDict()
    hard = {k: n for k, n in v.items() if (k.startswith("null_") or k == "duplicate_keys") and n}
    if hard:
        raise ValueError(f"load rejected, contract violated: {hard}")
    return v


def _upsert_serving(spark: SparkSession, root: str, updates: DataFrame, keys, update_cols,
                    contract: dict) -> dict:
    """Keyed merge into a stored serving table after the contract check: only the buckets that the
    batch hits are rewritten, and the new version becomes current only after they are written."""
    violations = enforce_contract(updates, contract)
    done = sinks.merge(spark, root, updates, keys, update_cols)
    return {"version": done.version, "buckets_rewritten": len(done.rewritten), "buckets": done.buckets, "rows": done.rows,
            "fingerprint": str(done.fingerprint), "violations": violations}


# ---------------------------------------------------------------- J1: FX

def land_fx(records: DataFrame, lake: str, day, fetched_at: str, source: str = "rates-feed") -> None:
    """S1 for FX: the day's records in envelopes of about ENVELOPE_RECORDS (a usual day is one)."""
    fields = ["casa", "nombre", "compra", "venta"]
    work_dir(records.sparkSession)
    once = records.select(*fields).checkpoint(eager=True)       # counted and landed from one reading
    parts = -(-max(once.count(), 1) // ENVELOPE_RECORDS)
    env = (once.groupBy(F.pmod(F.xxhash64(*fields), F.lit(parts)).alias("_part"))
               .agg(F.collect_list(F.struct(*fields)).alias("data"))
               .select(F.lit(fetched_at).alias("fetched_at"), F.lit(source).alias("source"), "data",
                       F.lit(str(day)).cast("date").alias("fecha")))
    bronze.land_envelopes(env, f"{lake}/bronze/dolar", "fecha")


def extract_fx(spark: SparkSession, lake: str, day) -> bool:
    """The day's fetched answers of the rates feed (files with a JSON list of records), landed as
    envelopes with the time of the last fetch; False where nothing was fetched."""
    root = f"{lake}/raw/dolar/fecha={day}"
    if not storage.has_entries(spark, root):
        return False
    answers = (spark.read.schema(schemas.FX_RECORD).option("multiLine", True).option("mode", "FAILFAST").json(root)
               .withColumn("_at", F.col("_metadata.file_modification_time")))
    utc = F.date_format(F.to_utc_timestamp(F.max("_at"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    land_fx(answers.drop("_at"), lake, day, answers.agg(utc.alias("at")).first()["at"])
    return True


def fx_job(spark: SparkSession, lake: str, day) -> dict:
    """Land what was fetched -> bronze envelope of ``day`` -> F1 silver partition -> S9 merge of the serving table."""
    extract_fx(spark, lake, day)
    env = bronze.read_envelopes(spark, f"{lake}/bronze/dolar/fecha={day}", schemas.FX_ENVELOPE)
    silver = fx.normalize_fx(bronze.explode_envelope(env, ["fetched_at", "source"]), day)
    partitions.write_day_partitions(silver, f"{lake}/silver/dolar", "fecha")
    day_rows = partitions.read_day(spark, f"{lake}/silver/dolar", "fecha", day)
    return _upsert_serving(spark, f"{lake}/serving/dolar", day_rows, ["fecha", "casa"], FX_UPDATE,
                           schemas.SERVING_FX)


# ---------------------------------------------------------------- J2: listings

def land_listings(records: DataFrame, lake: str, source: str, day, scraped_at: str | None = None) -> None:
    """S1 for listings: records with their position and scrape time (``scraped_at``: one for all)."""
    recs = records if scraped_at is None else records.withColumn("scraped_at", F.lit(scraped_at))
    bronze.land_records(recs.withColumn("scraped_day", F.lit(str(day)).cast("date")), f"{lake}/bronze/listings/source={source}", "scraped_day")


def extract_linked(spark: SparkSession, lake: str, source: str, day, base: str = market.BASE_URL) -> DataFrame:
    """P1-P5 over the files of a site with index and detail pages: the records of ``day``.

    ``raw/<source>/index/fecha=<day>/segmento=<n>/`` holds index pages, ``raw/<source>/detail/fecha=<day>/``
    detail pages named by the MD5 of their listing's path. A link counts once per segment and day, whatever
    batch of index pages (``lote=<batch>`` under a segment) shows it again. A record's scrape time is
    the fetch time of its detail page, its position the order of (segment, path)."""
    index = source_pages.read_pages(spark, f"{lake}/raw/{source}/index/fecha={day}")
    batches = [r[0] for r in index.select("lote").distinct().orderBy("lote").collect()] if "lote" in index.columns else [None]
    found = None
    for lote in batches:        # a day's batches: a handful of crawler runs
        rows = index if lote is None else index.where(F.col("lote") == lote)
        links = pages.extract_links(rows, keep=["segmento"])
        new = pages.take_new(spark, f"{lake}/seen/{source}/fecha={day}", links, ["segmento", "link"], str(lote))
        found = new if found is None else found.unionByName(new)
    parsed = pages.parse_listing_path(found.withColumnRenamed("link", "path"))
    detail = source_pages.read_pages(spark, f"{lake}/raw/{source}/detail/fecha={day}")
    fields = pages.hidden_inputs(detail.withColumn("_page", F.regexp_replace("file", "[.]html$", ""))).drop("html", "file", "fecha")
    # one detail page per path, however many segments list it
    records = pages.assemble(parsed.withColumn("_page", F.md5("path")), fields, F.col("fetched_at"), base, path="_page", url="path")
    columns = [f.name for f in schemas.LISTING_RECORD.fields if f.name != "source"]
    return records.select(*columns, F.xxhash64("segmento", "path").alias("pos"))


def extract_cards(spark: SparkSession, lake: str, source: str, day, base: str = market.CARD_BASE_URL) -> DataFrame:
    """P6-P7 over the files of a site with result cards: ``raw/<source>/cards/fecha=<day>/marca=<brand>/``.

    A card that an earlier brand's pages showed goes; the scrape time is its page's fetch time."""
    files = source_pages.read_pages(spark, f"{lake}/raw/{source}/cards/fecha={day}").withColumnRenamed("marca", "brand_ord")
    cards = pages.parse_cards(pages.split_cards(files, keep=["brand_ord", "fetched_at"]), base, source=source)
    first = pages.first_seen(cards).withColumnRenamed("fetched_at", "scraped_at")
    columns = [f.name for f in schemas.LISTING_RECORD.fields if f.name != "source"]
    return first.select(*columns, F.xxhash64("brand_ord", "cod").alias("pos"))


def extract_job(spark: SparkSession, lake: str, source: str, day) -> bool:
    """Fetched page files -> landed records of one source's day; False where no pages were fetched."""
    if storage.has_entries(spark, f"{lake}/raw/{source}/index/fecha={day}"):
        records = extract_linked(spark, lake, source, day)
    elif storage.has_entries(spark, f"{lake}/raw/{source}/cards/fecha={day}"):
        records = extract_cards(spark, lake, source, day)
    else:
        return False
    land_listings(records, lake, source, day)
    return True


def silver_listings_job(spark: SparkSession, lake: str, source: str, day, bad_share: float = BAD_SHARE) -> DataFrame:
    """S2 + C1-C6 + S4: typed, cleaned, de-duplicated silver partition of one source.

    Records that are no JSON or do not fit their types go to the quarantine partition of the day
    with the reason and their file; more than ``bad_share`` of them fail the job. Returns the C7
    profile (rows in and out, null counts) of the good records."""
    schema = T.StructType(list(schemas.LISTING_RECORD.fields) + [T.StructField("pos", T.LongType())])
    raw = bronze.read_records_checked(spark, f"{lake}/bronze/listings/source={source}", schema, "scraped_day")
    raw = raw.where(F.col("scraped_day") == F.lit(str(day)).cast("date")).drop("source")
    # parsed once: counted, quarantined and cleaned from the stored rows
    path = scratch_path(spark, "checked")
    clean.checked_projection(raw.withColumn("pos", F.col("pos").try_cast("bigint")), day=day).write.parquet(path)
    checked = spark.read.parquet(path)
    good, bad = clean.split_checked(checked)
    counts = checked.agg(F.count(F.lit(1)).alias("n"), F.count("_reason").alias("bad")).first()
    bad = bad.select("fecha", "_file", "pos", F.col("_reason").alias("reason"), F.col("_record").alias("record"))
    partitions.replace_day(bad, f"{lake}/quarantine/listings/source={source}", "fecha", day)
    clean.enforce_bad_share(counts["bad"], counts["n"], bad_share)
    # input order for keep-first: the record's position in its scrape batch (landing
    # spreads a day over files by a row hash, so file order is not input order)
    typed = good.withColumn("_ord", F.struct(F.col("pos"), F.col("_file"))).drop("scraped_day", "pos", "_file")
    silver = clean.clean_listings(typed, year_max=dt.date.fromisoformat(str(day)).year)
    partitions.write_day_partitions(silver, f"{lake}/silver/listings/source={source}", "fecha", ["cod"])
    written = partitions.read_day(spark, f"{lake}/silver/listings/source={source}", "fecha", day)
    return clean.null_profile(good, written)


def load_listings_job(spark: SparkSession, lake: str, source: str, day) -> dict:
    """C9 + S12 + S10: stamp the source, apply defaults, check the contract, upsert."""
    rows = partitions.read_day(spark, f"{lake}/silver/listings/source={source}", "fecha", day)
    rows = sinks.apply_defaults(clean.stamp_source(rows, source), schemas.SERVING_LISTINGS["defaults"])
    rows = rows.withColumn("precio_estimado", F.lit(None).cast("bigint")) \
               .withColumn("oportunidad_score", F.lit(None).cast("double"))
    return _upsert_serving(spark, f"{lake}/serving/listings", rows, ["cod"], PARTIAL_UPDATE,
                           schemas.SERVING_LISTINGS)


def silver_of(spark: SparkSession, roots: dict[str, str], day, day_col: str = "fecha") -> DataFrame:
    """S7 + G1 + G2 + C9: every source's preferred-or-latest silver day, stamped and united by name.

    The first source is required. Another one whose folder is not there, or holds no data, is left
    out; one that is there but cannot be read is an error."""
    out = None
    for n, (source, root) in enumerate(roots.items()):
        if not storage.has_entries(spark, root):
            if n == 0:
                raise FileNotFoundError(f"required silver source {source} is missing")
            continue
        rows = clean.stamp_source(partitions.read_day_or_last(spark, root, day_col, day), source)
        out = rows if out is None else features.union_sources(out, rows)
    return out


def gold_job(spark: SparkSession, lake: str, day, sources=("a", "b")) -> str:
    """S7 + G1-G13 + F4: each source's preferred-or-latest silver day, united, featured,
    with the blue rate of the run day; written as the gold partition of ``day``."""
    silver = silver_of(spark, {s: f"{lake}/silver/listings/source={s}" for s in sources}, day)
    rates = sinks.read_current(spark, f"{lake}/serving/dolar") if sinks.table_version(spark, f"{lake}/serving/dolar") else None
    run_year = dt.date.fromisoformat(str(day)).year
    g = features.build_features(silver.withColumn("_run_day", F.lit(str(day)).cast("date")), rates, run_year,
                                day_col="_run_day", carry=("source",))
    partitions.write_day_partitions(g.withColumn("fecha", F.lit(str(day)).cast("date")), f"{lake}/gold/listings",
                                    "fecha", ["cod"])
    return f"{lake}/gold/listings"


def train_job(spark: SparkSession, lake: str, day, max_iter: int = model.GBT_TREES) -> dict:
    """M1-M5 + S13 + S14: train on the gold partition of ``day``, evaluate both splits on the raw
    predictions, save the model and record the run."""
    gold = partitions.read_day(spark, f"{lake}/gold/listings", "fecha", day).drop("fecha", "source")
    m = model.train_gbt(gold, max_iter=max_iter)
    scored = model.with_split(model.model_scores(m, gold))
    metrics = {r.split: r.asDict() for r in
               model.regression_metrics(scored, "precio_ars", "prediction", ["split"]).collect()}
    key = registry.save_model(m, f"{lake}/models", day)
    pick = lambda split: {k: metrics.get(split, {}).get(k) for k in ("mae", "rmse", "r2", "mape")}
    rows = {split: metrics.get(split, {}).get("n", 0) for split in ("train", "test")}
    registry.record_run(spark, f"{lake}/runs", model.training_parameters(rows["train"], rows["test"], day, max_iter),
                        pick("train"), pick("test"), day)
    return {"model": key, "metrics": metrics}


def compare_job(spark: SparkSession, lake: str, day, max_iter: int = model.GBT_TREES, num_trees: int = 100) -> list[dict]:
    """M8: the boosted trees against a random forest on the same hold-out rows."""
    gold = partitions.read_day(spark, f"{lake}/gold/listings", "fecha", day).drop("fecha", "source")
    test_rows = model.with_split(gold).where(F.col("split") == "test").drop("split")
    a = model.model_scores(model.train_gbt(gold, max_iter=max_iter), test_rows)
    b = model.model_scores(model.train_forest(gold, num_trees=num_trees), test_rows)
    ma = model.regression_metrics(a, "precio_ars", "precio_estimado")
    mb = model.regression_metrics(b, "precio_ars", "precio_estimado")
    return [r.asDict() for r in model.compare_models(ma, mb, "gbt", "forest").collect()]


def score_job(spark: SparkSession, lake: str, day, sources=("a", "b")) -> dict:
    """S8 + M9-M12 + S11: score every gold row with the latest model, merge the scores
    into the serving table (update only), report counts and the top 5."""
    gold = partitions.read_day(spark, f"{lake}/gold/listings", "fecha", day).drop("fecha")
    m = registry.load_latest_model(spark, f"{lake}/models")
    scores = model.model_scores(m, gold, carry=("source", "marca", "modelo", "anio"))
    # gold keeps both sources' rows of a shared cod; as when the scores are applied
    # in batch order, the later source's score is the one that stays
    later_first = F.lit(0) - F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source"))
    # scored once: the merge, the count and the top 5 read the stored scores
    scored = scratch_path(spark, "scores")
    keep_first(scores.withColumn("_ord", later_first), ["cod"], "_ord", drop=["_ord", "source"]).write.parquet(scored)
    scores = spark.read.parquet(scored)
    sinks.merge(spark, f"{lake}/serving/listings", scores.select("cod", "precio_estimado", "oportunidad_score"), ["cod"],
                ["precio_estimado", "oportunidad_score"], insert=False)
    c = model.count_opportunities(scores, OPPORTUNITY_THRESHOLD).first()
    top = model.top_scores(scores, 5).collect()
    return {"oportunidades": c.oportunidades, "total": c.total, "top": [r.asDict() for r in top]}


def listings_job(spark: SparkSession, lake: str, day, source: str, max_iter: int = model.GBT_TREES) -> dict:
    """Extract and land the fetched pages -> silver -> load -> gold -> train -> score for one source's day.

    Where no pages were fetched, the records that are landed are taken."""
    extract_job(spark, lake, source, day)
    profile = silver_listings_job(spark, lake, source, day).first().asDict()
    load_listings_job(spark, lake, source, day)
    gold_job(spark, lake, day)
    trained = train_job(spark, lake, day, max_iter)
    return {"profile": profile, "train": trained, "score": score_job(spark, lake, day)}


def retrain_job(spark: SparkSession, lake: str, day, max_iter: int = model.GBT_TREES) -> dict:
    """Gold -> train -> score on the silver that is there."""
    gold_job(spark, lake, day)
    trained = train_job(spark, lake, day, max_iter)
    return {"train": trained, "score": score_job(spark, lake, day)}
