"""Partitions, keyed upserts, contract, idempotent reruns."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from autolake import schemas
from autolake.sources import partitions, sinks, storage
from tests.conftest import rows

LIST = "cod string, fecha date, marca string, precio_ars bigint, km bigint, segmento tinyint, source string"
D1, D2 = dt.date(2026, 7, 1), dt.date(2026, 7, 2)


def test_partial_and_full_upsert(spark):
    target = spark.createDataFrame([("1", D1, "Old", 10, 5, 0, "a"), ("2", D1, "Keep", 20, 6, 0, "a")], LIST)
    updates = spark.createDataFrame([("1", D2, "New", 11, 7, 1, "b"), ("3", D2, "Ins", 30, 8, 2, "b")], LIST)
    partial = sinks.upsert(target, updates, ["cod"], ["fecha", "precio_ars", "km", "segmento", "source"])
    assert rows(partial) == [("1", D2, "Old", 11, 7, 1, "b"), ("2", D1, "Keep", 20, 6, 0, "a"),
                             ("3", D2, "Ins", 30, 8, 2, "b")]
    full = sinks.upsert(target, updates, ["cod"])
    assert rows(full)[0] == ("1", D2, "New", 11, 7, 1, "b")


def test_update_only_never_inserts(spark):
    target = spark.createDataFrame([("1", 100), ("2", 200)], "cod string, precio_ars long")
    scores = spark.createDataFrame([("1", 120, 0.1667), ("9", 5, 0.5)],
                                   "cod string, precio_estimado long, oportunidad_score double")
    out = sinks.update_only(target, scores, ["cod"], ["precio_estimado", "oportunidad_score"])
    assert rows(out) == [("1", 100, 120, 0.1667), ("2", 200, None, None)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(t=st.dictionaries(st.integers(0, 30), st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=12),
       u=st.dictionaries(st.integers(0, 30), st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=12))
def test_upsert_matches_dict_merge(spark, t, u):
    schema = "k int, a int, b int"
    tdf = spark.createDataFrame([(k, *v) for k, v in t.items()], schema)
    udf = spark.createDataFrame([(k, *v) for k, v in u.items()], schema)
    # model: new wins on b only, a keeps the old value on conflict
    want = {k: v for k, v in t.items()}
    for k, (a, b) in u.items():
        want[k] = (t[k][0], b) if k in t else (a, b)
    got = sinks.upsert(tdf, udf, ["k"], ["b"]).collect()
    assert {r.k: (r.a, r.b) for r in got} == want
    # rerun with the same updates changes nothing
    again = sinks.upsert(sinks.upsert(tdf, udf, ["k"], ["b"]), udf, ["k"], ["b"]).collect()
    assert {r.k: (r.a, r.b) for r in again} == want


def test_contract_violations(spark):
    df = spark.createDataFrame([("x" * 21, D1, "M", 1, 1, 0, "a"), ("1", None, "M", 1, 1, 0, "a"),
                                ("1", D1, None, 1, 1, None, "a")], LIST)
    df = sinks.apply_defaults(df.withColumn("modelo", df.marca), {"segmento": 0})
    v = sinks.contract_violations(df, schemas.SERVING_LISTINGS).first().asDict()
    assert v["rows"] == 3 and v["too_long_cod"] == 1 and v["null_fecha"] == 1
    assert v["null_marca"] == 1 and v["null_segmento"] == 0 and v["duplicate_keys"] == 1


def test_day_partitions_idempotent(spark, tmp_root):
    df = spark.createDataFrame([("1", D1, "A", 1, 1, 0, "a"), ("2", D2, "B", 2, 2, 0, "a")], LIST)
    root = f"{tmp_root}/silver"
    partitions.write_day_partitions(df, root, "fecha", ["cod"])
    # re-landing day 2 with new content replaces only day 2
    partitions.write_day_partitions(spark.createDataFrame([("3", D2, "C", 3, 3, 0, "a")], LIST), root, "fecha")
    partitions.write_day_partitions(spark.createDataFrame([("3", D2, "C", 3, 3, 0, "a")], LIST), root, "fecha")
    t = partitions.read_table(spark, root)
    assert rows(t, "cod", "fecha") == [("1", D1), ("3", D2)]
    assert partitions.latest_day(t, "fecha") == D2
    assert rows(partitions.read_day(spark, root, "fecha", D1), "cod") == [("1",)]
    # preferred day exists -> it; missing -> latest (even if later than asked)
    assert rows(partitions.read_preferred_or_latest(t, "fecha", D1), "cod") == [("1",)]
    assert rows(partitions.read_preferred_or_latest(t, "fecha", dt.date(2026, 1, 1)), "cod") == [("3",)]
    assert partitions.days(spark, root, "fecha") == [D1, D2] and partitions.last_day(spark, root, "fecha") == D2
    assert rows(partitions.read_day_or_last(spark, root, "fecha", D1), "cod") == [("1",)]
    assert rows(partitions.read_day_or_last(spark, root, "fecha", dt.date(2026, 1, 1)), "cod") == [("3",)]
    with pytest.raises(FileNotFoundError):
        partitions.last_day(spark, f"{tmp_root}/none", "fecha")
    plan = partitions.read_day(spark, root, "fecha", D1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fecha" in plan


def test_latest_day_empty_is_error(spark):
    empty = spark.createDataFrame([], "fecha date")
    with pytest.raises(FileNotFoundError):
        partitions.latest_day(empty, "fecha")


def test_versioned_commit(spark, tmp_root):
    root = f"{tmp_root}/serving"
    table = lambda *v: spark.createDataFrame([(x,) for x in v], "cod string")
    with pytest.raises(FileNotFoundError):
        sinks.read_current(spark, root)
    sinks.commit_version(table("1"), root, 0)
    sinks.commit_version(table("1", "2"), root, 1)
    assert rows(sinks.read_current(spark, root)) == [("1",), ("2",)]
    # a second writer that started from version 1 must not hide version 2
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.commit_version(table("other"), root, 1)
    assert rows(sinks.read_current(spark, root)) == [("1",), ("2",)]
    for n in range(2, 7):
        sinks.commit_version(table(str(n)), root, n)
    assert rows(sinks.read_current(spark, root)) == [("6",)]
    kept = [x for x in os.listdir(root) if x.startswith("attempt-")]
    assert len(kept) == sinks.VERSIONS_KEPT


def test_failed_commit_is_never_seen_and_can_be_retried(spark, tmp_root):
    from pyspark.sql import functions as F

    root = f"{tmp_root}/serving"
    sinks.commit_version(spark.range(10), root, 0)
    bad = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            sinks.commit_version(bad, root, 1)
        assert sinks.read_current(spark, root).count() == 10
    # what a driver lost in the middle leaves: files without a log entry
    spark.range(3).write.parquet(f"{root}/attempt-lost")
    os.remove(f"{root}/attempt-lost/_SUCCESS")
    assert sinks.read_current(spark, root).count() == 10
    sinks.commit_version(spark.range(20), root, 1)
    assert sinks.current_version(spark, root)[0] == 2 and sinks.read_current(spark, root).count() == 20


def _files(root, version):
    return {b: p.folder for b, p in version.parts.items()}


def test_merge_rewrites_only_the_buckets_that_the_batch_hits(spark, tmp_root):
    from pyspark.sql import functions as F

    root = f"{tmp_root}/serving"
    base = spark.range(0, 5000).select(F.col("id").cast("string").alias("cod"), F.lit("old").alias("marca"), F.col("id").alias("km"))
    first = sinks.merge(spark, root, base, ["cod"], ["km"], buckets=32)
    assert (first.version, len(first.rewritten), first.rows) == (1, 32, 5000)
    before = sinks.table_version(spark, root)
    batch = spark.createDataFrame([("17", "new", -1), ("4999", "new", -2), ("brand-new", "new", 3)], "cod string, marca string, km long")
    files = {f: os.path.getmtime(f) for f in _parquet(root)}
    done = sinks.merge(spark, root, batch, ["cod"], ["km"])
    after = sinks.table_version(spark, root)
    # the batch's 3 keys hit 3 buckets at most: the others' files are the same ones, untouched
    assert len(done.rewritten) <= 3 and done.buckets == 32
    assert {b: f for b, f in _files(root, after).items() if b not in done.rewritten} == \
        {b: f for b, f in _files(root, before).items() if b not in done.rewritten}
    new = [f for f in _parquet(root) if f not in files]
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in new} == set(done.rewritten)
    assert all(os.path.getmtime(f) == t for f, t in files.items() if os.path.exists(f))
    # rows, and the totals that the version carries, are those of a whole upsert
    whole = sinks.upsert(base, batch, ["cod"], ["km"])
    now = sinks.read_current(spark, root)
    assert rows(now, "cod", "marca", "km") == rows(whole, "cod", "marca", "km")
    f = sinks.fingerprint(now).first()
    assert (done.rows, done.fingerprint) == (f["rows"], int(f["fingerprint"])) == (5001, int(sinks.fingerprint(whole).first()["fingerprint"]))
    # the same batch again changes nothing; a batch without rows rewrites nothing
    again = sinks.merge(spark, root, batch, ["cod"], ["km"])
    assert (again.rows, again.fingerprint) == (done.rows, done.fingerprint)
    none = sinks.merge(spark, root, batch.limit(0), ["cod"], ["km"])
    assert none.rewritten == [] and (none.rows, none.fingerprint) == (done.rows, done.fingerprint)
    # update only: an unknown key stays out
    only = sinks.merge(spark, root, spark.createDataFrame([("nobody", 7), ("17", 8)], "cod string, km long"), ["cod"], ["km"], insert=False)
    assert only.rows == 5001 and sinks.read_current(spark, root).where("cod = '17'").first().km == 8


def _parquet(root):
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]


def test_two_writers_of_one_version_conflict(spark, tmp_root, monkeypatch):
    root = f"{tmp_root}/serving"
    sinks.merge(spark, root, spark.createDataFrame([("1", 1)], "cod string, km long"), ["cod"], buckets=4)
    stale = sinks.table_version(spark, root)
    sinks.merge(spark, root, spark.createDataFrame([("2", 2)], "cod string, km long"), ["cod"])
    monkeypatch.setattr(sinks, "table_version", lambda *_: stale)
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.merge(spark, root, spark.createDataFrame([("3", 3)], "cod string, km long"), ["cod"])
    monkeypatch.undo()
    assert rows(sinks.read_current(spark, root)) == [("1", 1), ("2", 2)]


def test_versions_kept_and_folders_still_named_stay(spark, tmp_root):
    root = f"{tmp_root}/serving"
    cols = "cod string, km long"
    sinks.merge(spark, root, spark.createDataFrame([(str(i), i) for i in range(50)], cols), ["cod"], buckets=8)
    for n in range(8):
        sinks.merge(spark, root, spark.createDataFrame([("7", 100 + n)], cols), ["cod"])
    assert rows(sinks.read_current(spark, root)) == sorted([(str(i), i) for i in range(50) if i != 7] + [("7", 107)])
    assert len(os.listdir(f"{root}/_log")) >= sinks.VERSIONS_KEPT
    logs = [n for n in os.listdir(f"{root}/_log") if n.isdigit()]
    assert len(logs) == sinks.VERSIONS_KEPT
    # the first attempt's untouched buckets and the last versions' folders; nothing else
    assert len([d for d in os.listdir(root) if d.startswith("attempt-")]) == 1 + sinks.VERSIONS_KEPT


def test_new_columns_rewrite_all_buckets_and_whole_tables_can_be_merged(spark, tmp_root):
    root = f"{tmp_root}/t"
    sinks.commit_version(spark.createDataFrame([("1", 1), ("2", 2)], "cod string, km long"), root, 0)
    done = sinks.merge(spark, root, spark.createDataFrame([("2", 5)], "cod string, km long"), ["cod"], buckets=4)
    assert done.rows == 2 and done.buckets == 4
    sinks.merge(spark, root, spark.createDataFrame([("1", 9, 0.5)], "cod string, km long, score double"), ["cod"], ["score"])
    assert rows(sinks.read_current(spark, root)) == [("1", 1, 0.5), ("2", 5, None)]
    with pytest.raises(ValueError, match="buckets"):
        sinks.merge(spark, root, spark.createDataFrame([("1", 9)], "cod string, km long"), ["km"])
    empty = f"{tmp_root}/empty"
    sinks.merge(spark, empty, spark.createDataFrame([], "cod string, km long"), ["cod"])
    assert sinks.read_current(spark, empty).columns == ["cod", "km"] and sinks.read_current(spark, empty).count() == 0


def test_fingerprint_is_of_the_rows_alone(spark):
    a = spark.createDataFrame([("x", None, 1), ("y", "z", 2), ("y", "z", 2)], "a string, b string, c int")
    same = a.select("c", "b", "a").repartition(3).orderBy("c")
    value = lambda df: tuple(sinks.fingerprint(df).first())
    assert value(a) == value(same)
    for other in ([("x", None, 1), ("y", "z", 2)], [("x", None, 1), ("y", "z", 2), ("y", "z", 3)], [(None, "x", 1), ("y", "z", 2), ("y", "z", 2)],
                  [("x", "", 1), ("y", "z", 2), ("y", "z", 2)]):
        assert value(a) != value(spark.createDataFrame(other, "a string, b string, c int"))
    assert value(a.limit(0)) == (0, 0)


def test_first_seen_and_first_and_last_with_a_hot_key(spark):
    from pyspark.sql import functions as F

    from autolake.functions.joins import first_and_last
    from autolake.operators.pages import first_seen
    # a third of the rows share one key
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("cod"),
        (F.col("id") % 7).cast("int").alias("brand_ord"), F.col("id").alias("o"))
    two = {r.cod: (r.first.brand_ord, r["last"].brand_ord if r["last"] else None)
           for r in first_and_last(df.repartition(8), ["cod"], "o").collect()}
    assert two["hot"] == (0, 29997 % 7) and two["1"] == (1, None)
    kept = first_seen(df.repartition(8), "cod", "brand_ord")
    assert kept.where("cod = 'hot'").count() == len([i for i in range(0, 30000, 3) if i % 7 == 0])
    assert kept.where("cod <> 'hot'").count() == 20000


def test_merge_shuffles_each_side_once(spark, tmp_root, monkeypatch):
    """Round 3's F8, F9, F15: the joined rows are written as they lie, a bucket by several tasks."""
    import glob

    root, seen = f"{tmp_root}/once", []
    write = sinks._write_parts
    monkeypatch.setattr(sinks, "_write_parts", lambda df, *more: (seen.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *more))[1])
    rows = spark.range(0, 4000).selectExpr("cast(id as string) as cod", "id as km", "id as precio")
    sinks.merge(spark, root, rows, ["cod"], ["km"], buckets=2)
    done = sinks.merge(spark, root, rows.selectExpr("cod", "km + 1 as km", "precio - 1 as precio"), ["cod"], ["km"], buckets=2)
    assert [p.count("Exchange hashpartitioning") for p in seen] == [1, 2]
    assert done.rewritten == [0, 1] and done.rows == 4000
    got = {r.cod: (r.km, r.precio) for r in sinks.read_current(spark, root).collect()}
    assert got == {str(i): (i + 1, i) for i in range(4000)}
    now = sinks.table_version(spark, root)
    files = [len(glob.glob(f"{root}/{p.folder}/part-*")) for p in now.parts.values()]
    assert sum(files) <= sinks._tasks(spark, 2, 4000) and min(files) > 1


def test_buckets_by_another_hash_are_dealt_anew(spark, tmp_root):
    """A table whose versions do not name the hash of its buckets is rewritten whole by its next merge."""
    root = f"{tmp_root}/older"
    sinks.merge(spark, root, spark.createDataFrame([(str(i), i) for i in range(40)], "cod string, km long"), ["cod"], buckets=4)
    log = f"{root}/{sinks.LOG}/{1:020d}"
    with open(log.removeprefix("file:")) as f:
        text = f.read()
    storage.delete(spark, log)
    storage.create_once(spark, log, text.replace(sinks.DEALT_BY, ""))
    done = sinks.merge(spark, root, spark.createDataFrame([("3", 99)], "cod string, km long"), ["cod"], buckets=4)
    assert len(done.rewritten) == 4 and done.rows == 40
    assert {r.cod: r.km for r in sinks.read_current(spark, root).collect()} == {str(i): 99 if i == 3 else i for i in range(40)}
