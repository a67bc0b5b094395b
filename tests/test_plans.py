"""Plan shape: pushdown, pruning, broadcasts, no Python evaluation in any query."""

from __future__ import annotations

from autolake.operators import market as mk
from autolake.plans import views as V
from autolake.plans.catalog import QUERIES
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _executed(df) -> str:
    """The plan as it ran: this very query execution is run, so AQE's final plan is shown."""
    df._jdf.queryExecution().toRdd().count()
    plan = _plan(df)
    assert "isFinalPlan=true" in plan or "AdaptiveSparkPlan" not in plan
    return plan


def test_no_python_in_any_query_plan(spark, monkeypatch):
    from autolake.operators import model
    from tests.test_zz_oracle import FEW_TREES, SLOW
    train = model.train_gbt
    monkeypatch.setattr(model, "train_gbt", lambda gold: train(gold, max_iter=FEW_TREES))
    for name, q in QUERIES.items():
        if name in SLOW:
            continue
        plan = _plan(q(spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_search_pushes_filters_to_parquet(spark, tmp_root):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    V.serving(spark, SF001).write.parquet(f"{tmp_root}/serving")
    s = spark.read.parquet(f"{tmp_root}/serving")
    out = mk.search(s, mk.SearchFilter(anio_min=1996, precio_max=9_000_000, solo_oportunidades=True))
    plan = _plan(out)
    assert "PushedFilters: [IsNotNull(anio), IsNotNull(precio_ars)" in plan
    assert "GreaterThanOrEqual(anio,1996)" in plan
    assert "TakeOrderedAndProject" in plan
    # column pruning: only the projected and filtered columns are read
    read = plan[plan.index("ReadSchema: struct<") + len("ReadSchema: struct<"):].split(">")[0]
    cols = {c.split(":")[0] for c in read.split(",")}
    assert cols == {"cod", "marca", "modelo", "provincia", "anio", "km", "precio_ars", "oportunidad_score", "url"}


def test_small_dimensions_are_broadcast(spark):
    plan = _plan(QUERIES["g_features"](spark, SF001))
    assert plan.count("BroadcastHashJoin") >= 2     # brand medians and the day rates
    assert "SortMergeJoin" not in plan


def test_dedup_combines_map_side_without_window(spark):
    for name in ("c_clean_silver", "c_dedup_first"):
        df = QUERIES[name](spark, SF001)
        plan = _executed(df)
        assert "partial_min_by" in plan, name          # hot keys shrink before the shuffle
        assert "Window" not in plan, name               # no per-key window holding a whole key


def test_stored_unique_key_layers_are_bucketed(spark):
    V.silver(spark, SF001)
    V.scored_table(spark, SF001)
    for layer in ("silver", "scored"):
        table = V.stored_name(spark, SF001, layer)[len("table:"):]
        info = {r.col_name: r.data_type for r in spark.sql(f"describe formatted {table}").collect()}
        assert info.get("Bucket Columns") == "[`cod`]", layer
        assert int(info.get("Num Buckets")) == int(spark.conf.get("spark.sql.shuffle.partitions")), layer


def test_bounded_broadcast_falls_back_to_shuffle_join(spark):
    from pyspark.sql import functions as F

    from autolake.functions.joins import bounded_broadcast
    big = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 10).alias("k"))
    dim = spark.range(0, 10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")    # only our hint may broadcast
    try:
        small = big.join(bounded_broadcast(dim, max_bytes=320), "k")
        assert "BroadcastHashJoin" in _executed(small)
        over = big.join(bounded_broadcast(dim, max_bytes=319), "k")     # 10 rows of 32 bytes > bound: no hint
        plan = _executed(over)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert over.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_hot_key_of_first_seen_is_split(spark):
    """Half of the rows share one key: AQE cuts that key's partition."""
    from pyspark.sql import functions as F

    from autolake.operators.pages import first_seen
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 200_000, 1, 16).select(
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("cod"),
            (F.col("id") % 7).cast("int").alias("brand_ord"), F.sha2(F.col("id").cast("string"), 256).alias("pay"))
        assert "skew=true" in _executed(first_seen(df))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sort_positions_shuffle_only_their_own_key(spark, monkeypatch):
    """Round 3's F6: each of the five sorts carries the row's key and the column that it sorts by."""
    from autolake.operators import market
    from autolake.plans import catalog, views
    serving = spark.createDataFrame([("1", "b", "x", 2000, 5, 10, "p"), ("2", "a", "y", None, 4, 20, "q")],
                                    "cod string, marca string, modelo string, anio int, km long, precio_ars long, url string")
    monkeypatch.setattr(views, "serving_table", lambda spark, d: serving)
    seen, sort = [], market.user_sort
    monkeypatch.setattr(market, "user_sort", lambda df, key, **more: (seen.append((key, df.columns)), sort(df, key, **more))[1])
    got = {(r["key"], r.cod): r.position for r in catalog.QUERIES["q_sort_positions"](spark, "").collect()}
    assert seen == [(k, ["cod", k]) for k in ("marca", "modelo", "anio", "km", "precio_ars")]
    assert [got[k, "1"] for k, _ in seen] == [1, 2, 1, 1, 2] and len(got) == 10


def test_keep_first_sorts_no_whole_input_split(spark):
    """Round 3's F4, F5, F7, F12: ordinary keys are shuffled before they are sorted, in partitions of few rows;
    only a hot key is combined before the shuffle."""
    from pyspark.sql import functions as F

    from autolake.functions import joins
    rows = spark.range(0, 20_000, 1, 4).select((F.col("id") % 15_000).cast("string").alias("k"), (-F.col("id")).alias("o"))
    keep = lambda df: joins.keep_first(df, ["k"], "o", drop=["o"], spread=True)
    plan = _plan(keep(rows.withColumn("v", F.col("o") * 2)))
    assert plan.count("Exchange hashpartitioning(k") == 1 and "Union" not in plan
    assert plan.index("partial_min_by") < plan.index("Exchange hashpartitioning(k")      # printed from the top: after it
    hot = rows.unionByName(rows.select(F.when(F.col("o") > -10_000, "7").alias("k"), (F.col("o") - 30_000).alias("o"))).withColumn("v", F.col("o") * 2)
    plan = _plan(keep(hot))
    assert "Union" in plan and plan.rindex("partial_min_by") > plan.rindex("Exchange hashpartitioning(k")
    want = {}
    for r in hot.collect():
        want[r.k] = min(want.get(r.k, (r.o, r.v)), (r.o, r.v))
    got = keep(hot).collect()
    assert len(got) == len(want) and {r.k: r.v for r in got} == {k: v for k, (_, v) in want.items()}
    assert joins.key_counts(rows, ["k"]) == (20_000, [])
    n, found = joins.key_counts(hot, ["k"])
    assert n == 40_000 and len(found) == 2          # '7' and null
    assert joins.partitions_for(spark, 10 * joins.ROWS_PER_TASK * 1000) == 10_000


def test_card_fields_are_extracted_once(spark):
    """Round 3's F10: one regular expression per field of a card, whatever is done with the field."""
    from autolake.operators import pages as pg
    cards = spark.createDataFrame([("<a href='/ar/venta/x&amp;1/'><h3>A • B &lt;</h3><p>2000 • 1.000 km</p>$ 2.000.000</a>",)], "card string")
    out = pg.parse_cards(cards, "http://s")
    assert _plan(out).count("regexp_extract(") == 4
    r = out.first()
    assert (r.cod, r.modelo, r.km, r.precio_ars, r.url) == ("b-x&1", "B <", 1000, 2_000_000, "http://s/ar/venta/x&1/")


def test_user_sort_compares_by_the_collation_once_a_text(spark):
    """Round 3's F13: rows are sorted by their text's place, or, with too many texts to broadcast, in ranges found by
    bisection; the order is that of a plain sort by the collation."""
    import re

    from pyspark.sql import functions as F
    texts = ["Zeta", "Ñandú", "Nube", "nube", "árbol", "arbol", "", None, "café", "café", "a", "a\u0000", "Zeta"]
    df = spark.createDataFrame([(f"{n}-{i}", t, i) for n in range(3) for i, t in enumerate(texts)], "cod string, modelo string, km int")
    for asc in (True, False):
        k = F.collate("modelo", "es")
        want = [tuple(r) for r in df.orderBy(k.asc() if asc else k.desc(), "cod").collect()]
        placed = mk.user_sort(df, "modelo", asc)
        top = _plan(placed).split("rangepartitioning(")[1].split("\n")[0]
        assert "_place" in top and "collate" not in top
        ranged = mk.user_sort(df, "modelo", asc, max_bytes=0)
        assert int(re.search(r"rangepartitioning\(.*, (\d+)\)", _plan(ranged))[1]) > 128
        assert placed.columns == ranged.columns == df.columns
        assert [tuple(r) for r in placed.collect()] == [tuple(r) for r in ranged.collect()] == want


def test_upsert_sides_are_read_from_buckets(spark, tmp_root, monkeypatch):
    """Round 4's F4-F6: the first and last records are shuffled once, stored in buckets, and joined as they lie; before,
    they were stored plain and both sides of the join shuffled them again."""
    from autolake.plans import catalog
    cols = [c for c in catalog._SERVING_COLS if c not in ("cod", "km")]
    found = [("1-1", 5, 1), ("1-2", 6, 2), ("1-2", 7, 1), ("1-2", 8, 3), ("2-7", 9, 2), ("2-7", 10, 1), ("3-7", 11, 1), (None, 12, 1), (None, 13, 2),
             ("4-1", 14, 1), ("4-1", 14, 1)]
    records = spark.createDataFrame([(c, km, o, *[f"{x}{km}" for x in cols]) for c, km, o in found],
                                    "cod string, km int, _ord int, " + ", ".join(f"{c} string" for c in cols))
    monkeypatch.setattr(V, "listings", lambda spark, d: records)
    full, partial = (catalog.QUERIES[q](spark, tmp_root) for q in ("s_upsert_full", "s_upsert_partial"))
    for df in (full, partial):
        assert _plan(df).count("Bucketed: true") == 2 and "Exchange" not in _plan(df)
    assert {(r.cod, r.km, r.path) for r in full.collect()} == {("1-1", 5, "path5"), ("1-2", 8, "path8"), ("2-7", 10, "path10"), ("3-7", 11, "path11"),
                                                               ("4-1", 14, "path14")}
    assert {(r.cod, r.km, r.path) for r in partial.collect()} == {("1-1", 5, "path5"), ("1-2", 8, "path7"), ("2-7", 10, "path10"), ("3-7", 11, "path11"),
                                                                  ("4-1", 14, "path14")}
    r = catalog.QUERIES["s_contract_violations"](spark, tmp_root).first()
    assert (r.rows, r.duplicate_keys) == (5, 0)


def test_first_and_last_shuffle_before_they_sort(spark):
    """The same rows whether the keys are shuffled first or not, with a hot key and a null one too."""
    from pyspark.sql import functions as F

    from autolake.functions import joins
    rows = spark.range(0, 20_000, 1, 4).select((F.col("id") % 15_000).cast("string").alias("k"), F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    hot = rows.unionByName(rows.select(F.when(F.col("o") < 10_000, "7").alias("k"), (F.col("o") + 30_000).alias("o"), "v"))
    both = lambda df, **how: joins.first_and_last(df, ["k"], "o", **how)
    plan = _plan(both(rows, spread=True))
    assert plan.index("partial_min_by") < plan.index("Exchange hashpartitioning(k") and plan.count("Exchange hashpartitioning(k") == 1
    assert "Union" in _plan(both(hot, spread=True, partitions=5))
    for df in (rows, hot):
        assert sorted(both(df, spread=True).collect(), key=str) == sorted(both(df).collect(), key=str)
