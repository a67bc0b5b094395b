"""Incremental ingest: only new bronze files are processed; replays are idempotent."""

from __future__ import annotations

from pyspark.sql import functions as F

from autolake.plans import jobs
from autolake.sources import sinks
from autolake.streaming.incremental import ingest_listings
from tests.test_jobs import _records


def test_incremental_ingest(spark, tmp_root):
    lake = f"{tmp_root}/lake"
    bronze_root = f"{lake}/bronze/listings/source=a"
    serving = f"{lake}/serving/listings"
    ckpt = f"{tmp_root}/ckpt"
    recs = _records(spark, "a")
    half1 = recs.where(F.col("cod") < "3")
    half2 = recs.where(F.col("cod") >= "3")
    jobs.land_listings(half1, lake, "a", "2001-06-29", "t1")
    ingest_listings(spark, bronze_root, serving, ckpt, "a")
    n1 = sinks.read_current(spark, serving).count()
    assert n1 == half1.select("cod").distinct().count()
    jobs.land_listings(half2, lake, "a", "2001-06-30", "t2")
    ingest_listings(spark, bronze_root, serving, ckpt, "a", max_files_per_batch=1)
    cur = sinks.read_current(spark, serving)
    assert cur.count() == recs.select("cod").distinct().count()
    assert cur.select("cod").distinct().count() == cur.count()
    # nothing new: the state does not change
    ingest_listings(spark, bronze_root, serving, ckpt, "a")
    assert sinks.read_current(spark, serving).count() == cur.count()


def test_state_does_not_depend_on_batches(spark, tmp_root):
    """The same files in one batch, file by file, and in either order of days give the same table."""
    base = _records(spark, "a").limit(1).collect()[0].asDict()
    schema = _records(spark, "a").schema
    days = {"2001-06-29": [dict(base, cod="x", marca="early", precio_ars=100, anio=2001, pos=0), dict(base, cod="y", precio_ars=5, pos=3)],
            "2001-06-30": [dict(base, cod="x", marca="late", precio_ars=200, anio=2001, pos=5), dict(base, cod="x", marca="later", precio_ars=300, pos=6),
                           dict(base, cod="z", precio_ars=7, pos=1)],
            "2002-01-02": [dict(base, cod="y", marca="new", precio_ars=9, anio=2002, pos=9)]}
    seen = []
    for case, (order, per_batch) in enumerate([(sorted(days), None), (sorted(days), 1), (sorted(days, reverse=True), 1), (["2001-06-30", "2002-01-02", "2001-06-29"], None)]):
        lake = f"{tmp_root}/lake{case}"
        for day in order:
            jobs.land_listings(spark.createDataFrame(days[day], schema), lake, "a", day, "2001-06-30T10:00:00+00:00")
            if case > 1:
                ingest_listings(spark, f"{lake}/bronze/listings/source=a", f"{lake}/serving", f"{lake}/ckpt", "a")
        ingest_listings(spark, f"{lake}/bronze/listings/source=a", f"{lake}/serving", f"{lake}/ckpt", "a", max_files_per_batch=per_batch)
        cur = sinks.read_current(spark, f"{lake}/serving")
        seen.append(sorted((tuple(r) for r in cur.select(*sorted(cur.columns)).collect()), key=repr))
        x = cur.where("cod = 'x'").first()
        assert (x.marca, x.precio_ars, str(x.fecha)) == ("early", 200, "2001-06-30")
    assert all(s == seen[0] for s in seen)
