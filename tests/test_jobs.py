"""The composed jobs, idempotent reruns."""

from __future__ import annotations

from pyspark.sql import functions as F

from autolake.plans import fixtures, jobs
from autolake.sources import sinks
from tests.conftest import SF001, rows

DAY = "2001-06-30"


def _records(spark, source):
    """One scrape: the sf0.001 listing records of one source, with a position."""
    lst = fixtures.listings(spark, SF001).where(F.col("source") == source)
    return lst.select("cod", "marca", "modelo", "condicion", "provincia", "precio_ars",
                      F.col("anio").cast("long").alias("anio"), "km", F.col("segmento").cast("long").alias("segmento"),
                      F.concat(F.lit("https://example.com.ar"), F.col("path")).alias("url"),
                      F.xxhash64("cod", "_ord").alias("pos"))


def test_fx_job_idempotent(spark, tmp_root):
    lake = f"{tmp_root}/lake"
    recs = spark.createDataFrame([("blue", "Blue", 1180.0, 1200.0), ("oficial", "Oficial", 900.0, 950.0)],
                                 "casa string, nombre string, compra double, venta double")
    jobs.land_fx(recs, lake, DAY, "2001-06-30T12:00:00+00:00")
    jobs.fx_job(spark, lake, DAY)
    first = rows(sinks.read_current(spark, f"{lake}/serving/dolar"))
    jobs.land_fx(recs, lake, DAY, "2001-06-30T12:00:00+00:00")
    jobs.fx_job(spark, lake, DAY)                     # J4: same day twice = same state
    assert rows(sinks.read_current(spark, f"{lake}/serving/dolar")) == first
    assert len(first) == 2


def test_listings_job_end_to_end(spark, tmp_root):
    lake = f"{tmp_root}/lake"
    recs = spark.createDataFrame([("blue", "Blue", 1180.0, 1200.0)], "casa string, nombre string, compra double, venta double")
    jobs.land_fx(recs, lake, DAY, "t")
    jobs.fx_job(spark, lake, DAY)
    jobs.land_listings(_records(spark, "a"), lake, "a", DAY, "2001-06-30T10:00:00+00:00")
    out = jobs.listings_job(spark, lake, DAY, "a", max_iter=3)
    serving = sinks.read_current(spark, f"{lake}/serving/listings")
    n = serving.count()
    assert n == out["profile"]["rows_out"] > 0
    assert serving.select("cod").distinct().count() == n
    assert serving.where(F.col("oportunidad_score").isNotNull()).count() == out["score"]["total"]
    assert len(out["score"]["top"]) == 5
    # source b arrives later the same day; A is kept, B is added
    jobs.land_listings(_records(spark, "b"), lake, "b", DAY, "2001-06-30T11:00:00+00:00")
    jobs.silver_listings_job(spark, lake, "b", DAY)
    jobs.load_listings_job(spark, lake, "b", DAY)
    both = sinks.read_current(spark, f"{lake}/serving/listings")
    assert both.count() > n
    # Retraining and re-running give a consistent serving table
    jobs.gold_job(spark, lake, DAY)
    res = jobs.retrain_job(spark, lake, DAY, max_iter=3)
    cmp = {r["metric"]: r["winner"] for r in jobs.compare_job(spark, lake, DAY, max_iter=3, num_trees=3)}
    assert set(cmp) == {"MAE", "RMSE", "R2", "MAPE", "OVERALL"} and cmp["OVERALL"] in ("gbt", "forest")
    assert res["score"]["total"] > out["score"]["total"]
    again = sinks.read_current(spark, f"{lake}/serving/listings")
    assert again.count() == both.count()


def test_listings_rerun_same_day_is_idempotent(spark, tmp_root):
    lake = f"{tmp_root}/lake"
    jobs.land_listings(_records(spark, "a"), lake, "a", DAY, "2001-06-30T10:00:00+00:00")
    jobs.silver_listings_job(spark, lake, "a", DAY)
    jobs.load_listings_job(spark, lake, "a", DAY)
    first = rows(sinks.read_current(spark, f"{lake}/serving/listings"))
    # the same day landed and loaded again: the same serving state
    jobs.land_listings(_records(spark, "a"), lake, "a", DAY, "2001-06-30T10:00:00+00:00")
    jobs.silver_listings_job(spark, lake, "a", DAY)
    jobs.load_listings_job(spark, lake, "a", DAY)
    assert rows(sinks.read_current(spark, f"{lake}/serving/listings")) == first


def test_keep_first_follows_scrape_position_not_file_order(spark, tmp_root):
    """Landing spreads a day over several files; the first record is the one with the
    smallest position in the scrape, whatever file it landed in."""
    lake = f"{tmp_root}/lake"
    base = _records(spark, "a").limit(1).collect()[0].asDict()
    recs = spark.createDataFrame([dict(base, cod="x", modelo=f"m{i}", pos=1000 - i) for i in range(200)],
                                 _records(spark, "a").schema)
    jobs.land_listings(recs, lake, "a", DAY, "t")
    jobs.silver_listings_job(spark, lake, "a", DAY)
    from autolake.sources import partitions
    silver = partitions.read_day(spark, f"{lake}/silver/listings/source=a", "fecha", DAY)
    assert [r.modelo for r in silver.collect()] == ["m199"]      # position 801 is the first


def test_load_rejects_contract_violations(spark, tmp_root):
    import pytest
    lake = f"{tmp_root}/lake"
    recs = spark.createDataFrame([("blue", "Blue", 1.0, 2.0), ("blue", "Blue", 1.0, 3.0)],
                                 "casa string, nombre string, compra double, venta double")
    jobs.land_fx(recs, lake, DAY, "t")
    with pytest.raises(ValueError, match="duplicate_keys"):
        jobs.fx_job(spark, lake, DAY)          # two rows for (day, blue): rejected, nothing committed
    assert sinks.current_version(spark, f"{lake}/serving/dolar") == (0, None)


def test_corrupt_source_is_an_error_not_absent(spark, tmp_root):
    import glob

    import pytest
    lake = f"{tmp_root}/lake"
    for s in ("a", "b"):
        jobs.land_listings(_records(spark, s).limit(50), lake, s, DAY, "t")
        jobs.silver_listings_job(spark, lake, s, DAY)
    assert jobs.gold_job(spark, lake, DAY)
    for path in glob.glob(f"{lake}/silver/listings/source=b/fecha=*/*.parquet"):
        with open(path, "wb") as f:
            f.write(b"broken")
    with pytest.raises(Exception, match="(?i)parquet|corrupt|footer"):
        jobs.gold_job(spark, lake, DAY)


def test_large_fx_day_lands_in_several_envelopes(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(jobs, "ENVELOPE_RECORDS", 10)
    lake = f"{tmp_root}/lake"
    recs = spark.range(45).select(F.concat(F.lit("h"), "id").alias("casa"), F.lit("x").alias("nombre"),
                                  F.col("id").cast("double").alias("compra"), F.col("id").cast("double").alias("venta"))
    jobs.land_fx(recs, lake, DAY, "2001-06-30T12:00:00+00:00")
    jobs.fx_job(spark, lake, DAY)
    assert sinks.read_current(spark, f"{lake}/serving/dolar").count() == 45


# ---------------------------------------------------------------- from fetched files on

def _write(path, text):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def _fetched_pages(spark, lake, day, n=400):
    """What a crawler leaves: index pages of two batches (the second shows everything again), a detail
    page per listing, card pages per brand, the rates feed's answer."""
    import hashlib

    from autolake.plans import views
    rows_ = views.compute_silver(spark, SF001).where("precio_ars is not null and anio is not null and km is not null").orderBy("cod").limit(n)
    a, b = rows_.where("source = 'a'"), rows_.where("source = 'b'")
    for i, r in enumerate(fixtures.index_pages(a).collect()):
        if i % 2 == 0:
            _write(f"{lake}/raw/a/index/fecha={day}/segmento={r.segmento}/lote=1/{i}.html", r.html)
        _write(f"{lake}/raw/a/index/fecha={day}/segmento={r.segmento}/lote=2/{i}.html", r.html)
    for r in fixtures.detail_pages(a).collect():
        _write(f"{lake}/raw/a/detail/fecha={day}/{hashlib.md5(r.path.encode()).hexdigest()}.html", r.html)
    for i, r in enumerate(fixtures.card_pages(b).collect()):
        _write(f"{lake}/raw/b/cards/fecha={day}/marca={r.marca.replace('#', '')}/{i}.html", r.html)
    _write(f"{lake}/raw/b/cards/fecha={day}/marca=zz/again.html", fixtures.card_pages(b).first().html)      # a card that an earlier brand showed
    _write(f"{lake}/raw/dolar/fecha={day}/answer.json",
           '[{"casa": "blue", "nombre": "Blue", "compra": 1180.5, "venta": 1200}, {"casa": "oficial", "nombre": "Oficial", "compra": 900, "venta": 950, "x": 1}]')
    return a, b


def test_page_files_to_scored_rows(spark, tmp_root):
    lake = f"{tmp_root}/lake"
    a, b = _fetched_pages(spark, lake, DAY)
    fx = jobs.fx_job(spark, lake, DAY)              # lands the feed's answer first
    assert fx["rows"] == 2
    rate = sinks.read_current(spark, f"{lake}/serving/dolar").where("casa = 'blue'").first()
    assert rate.venta == 1200.0 and rate.fetched_at.startswith("20") and rate.fetched_at.endswith("+00:00")
    out = jobs.listings_job(spark, lake, DAY, "a", max_iter=3)
    listing = sinks.read_current(spark, f"{lake}/serving/listings")
    want = sorted((p.split("?cod=")[1], m, price, anio, km) for p, m, price, anio, km in rows(a, "path", "marca", "precio_ars", "anio", "km"))
    assert rows(listing, "cod", "marca", "precio_ars", "anio", "km") == want and out["profile"]["rows_out"] == len(want)
    assert listing.where("oportunidad_score is null or scraped_at not like '20%+00:00' or url not like 'https://%/vendo/%'").count() == 0
    first = listing.count()
    # the other source's cards join the same table
    assert jobs.extract_job(spark, lake, "b", DAY)
    jobs.silver_listings_job(spark, lake, "b", DAY)
    done = jobs.load_listings_job(spark, lake, "b", DAY)
    cards = b.where("precio_ars >= 1000000")
    assert done["rows"] == first + cards.count() and cards.count() > 0
    jobs.gold_job(spark, lake, DAY)
    res = jobs.retrain_job(spark, lake, DAY, max_iter=3)
    assert res["score"]["total"] == done["rows"]
    # the run table has all nine parameters and the raw predictions' metrics
    from autolake.sources import registry
    runs = registry.read_runs(spark, f"{lake}/runs").collect()
    assert len(runs) == 2 and all(len(r.params) == 9 and len(r.metrics) == 9 for r in runs)
    assert runs[0].params["learning_rate"] == "0.05" and runs[0].params["n_estimators"] == "3"
    # The whole day again, from the same files: the same table
    again = jobs.listings_job(spark, lake, DAY, "a", max_iter=3)
    jobs.extract_job(spark, lake, "b", DAY)
    jobs.silver_listings_job(spark, lake, "b", DAY)
    assert jobs.load_listings_job(spark, lake, "b", DAY)["rows"] == done["rows"] and again["profile"] == out["profile"]
    # nothing was fetched on another day
    assert not jobs.extract_job(spark, lake, "a", "2001-07-01") and not jobs.extract_fx(spark, lake, "2001-07-01")


def test_bad_records_are_quarantined_and_too_many_fail(spark, tmp_root):
    import pytest
    lake = f"{tmp_root}/lake"
    jobs.land_listings(_records(spark, "a").limit(200), lake, "a", DAY, "t")
    folder = f"{lake}/bronze/listings/source=a/scraped_day={DAY}"
    _write(f"{folder}/feed.json", '{"cod": "bad-1", "marca": "M", "anio": "s/d", "km": "many", "pos": 1}\n{"cod": "bad-2", "mar\n'
                                  '{"cod": "ok-1", "marca": "M", "modelo": "x", "condicion": "Usado", "anio": "1999", "km": "7", "segmento": "1", "pos": 2}\n')
    profile = jobs.silver_listings_job(spark, lake, "a", DAY).first()
    bad = spark.read.parquet(f"{lake}/quarantine/listings/source=a").orderBy("reason").collect()
    assert [(r.reason, r.record[:14]) for r in bad] == [("anio is not int; km is not bigint", '{"cod":"bad-1"'), ("record is not JSON", '{"cod": "bad-2')]
    assert all(r._file.endswith("feed.json") for r in bad)
    silver = spark.read.parquet(f"{lake}/silver/listings/source=a")
    ok = silver.where("cod = 'ok-1'").first()
    assert (ok.anio, ok.km, ok.segmento) == (1999, 7, 1) and silver.where("cod like 'bad%'").count() == 0
    assert profile.rows_in == 201
    _write(f"{folder}/more.json", "no json at all\n" * 50)
    with pytest.raises(ValueError, match="52 of 253 records are bad"):
        jobs.silver_listings_job(spark, lake, "a", DAY)
    # the day without its bad files: the quarantine partition is empty again
    import os
    os.remove(f"{folder}/more.json")
    os.remove(f"{folder}/feed.json")
    jobs.silver_listings_job(spark, lake, "a", DAY)
    assert not os.path.exists(f"{lake}/quarantine/listings/source=a/fecha={DAY}")


def test_links_across_runs(spark, tmp_root):
    from autolake.operators import pages
    from autolake.sources import sinks as s
    page = lambda *links: spark.createDataFrame([(1, x) for x in links], "segmento int, link string")
    seen = f"{tmp_root}/seen"
    take = lambda links, batch: rows(pages.take_new(spark, seen, links, ["segmento", "link"], batch), "link")
    assert take(page("a", "b", "b"), "1") == [("a",), ("b",)]
    assert take(page("b", "c"), "2") == [("c",)]
    assert take(page("a", "b"), "1") == [("a",), ("b",)]       # the first run again: the same links
    assert take(page(), "3") == [] and take(page("a", "b", "c"), "3") == []
    assert s.read_current(spark, seen).count() == 3
    # the stored side is not shuffled: the page's links are broadcast to it
    big = spark.range(5000).select(F.lit(1).alias("segmento"), F.concat(F.lit("l"), "id").alias("link"), F.lit("0").alias("batch"))
    s.merge(spark, seen, big, ["segmento", "link"])
    now = s.table_version(spark, seen)
    from autolake.functions.joins import bounded_broadcast
    links = bounded_broadcast(page("l1", "l2", "new"))
    known = s.read_touched(spark, seen, now, links, ["segmento", "link"]).join(links, ["segmento", "link"], "left_semi")
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert len(known.inputFiles()) <= 3


def test_command_line_names_every_job():
    import subprocess
    import sys
    out = subprocess.run([sys.executable, "-m", "autolake", "--help"], capture_output=True, text=True, timeout=120)
    assert all(x in out.stdout for x in ("fx", "extract", "listings", "gold", "train", "score", "compare", "retrain", "query"))
