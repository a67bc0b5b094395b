"""The query catalog: one Spark query per operator, plus its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``. Every
query reads the driver tables (or data Spark derives from them) in full.
Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autolake import schemas
from autolake.functions.joins import first_and_last, small_broadcast, with_position
from autolake.functions.stats import group_median
from autolake.operators import clean, encode, features
from autolake.operators import fx as fxo
from autolake.operators import market as mk
from autolake.operators import model as mo
from autolake.operators import pages as pg
from autolake.operators.fx import normalize_fx
from autolake.plans import fixtures as fxt
from autolake.plans import views as V
from autolake.plans.fixtures import REQUEST_RUN_YEAR, RUN_DAY, RUN_YEAR, fx_bronze, model_keys, table
from autolake.plans.jobs import silver_of
from autolake.plans.oracle_views import with_views
from autolake.session import scratch_path
from autolake.sources import storage, bronze, partitions, sinks
from autolake.sources.registry import latest_model_key, load_latest_model, model_registry, read_runs, record_run, save_model

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- C: cleaning

@query("c_clean_silver", with_views(["silver"], "select * from silver"))
def c_clean_silver(spark, d):
    return V.compute_silver(spark, d)


@query("c_dedup_first", with_views(["listings"], """
select cod, marca, modelo, condicion, provincia, precio_ars, anio, km, path, segmento, source, scraped_day
from listings where pos = 1"""))
def c_dedup_first(spark, d):
    return clean.dedup_first(V.listings(spark, d))


@query("c_null_profile", with_views(["listings", "silver"], """
select i.source, i.rows_in, o.rows_out, o.null_precio_ars, o.null_anio, o.null_km
from (select source, count(*) as rows_in from listings group by source) i
full join (select source, count(*) as rows_out,
                  count(*) filter (where precio_ars is null) as null_precio_ars,
                  count(*) filter (where anio is null) as null_anio,
                  count(*) filter (where km is null) as null_km
           from silver group by source) o on i.source = o.source"""))
def c_null_profile(spark, d):
    raw = V.listings(spark, d)
    # rows out = the stored silver table, the output of the cleaning (C8: one
    # function cleans every source)
    return clean.null_profile(raw, V.silver(spark, d), by="source")


# ---------------------------------------------------------------- G: gold features

@query("g_union_sources", with_views(["silver"], """
select cod, marca, modelo, condicion, provincia, null as path, segmento, source, scraped_day, precio_ars, anio, km
from silver where source = 'a'
union all
select cod, marca, modelo, null as condicion, provincia, path, segmento, source, scraped_day, precio_ars, anio, km
from silver where source = 'b'"""))
def g_union_sources(spark, d):
    s = V.silver(spark, d)
    a = s.where(F.col("source") == "a").drop("path")
    b = s.where(F.col("source") == "b").drop("condicion")
    return features.union_sources(a, b)


@query("g_km_valid_flag", with_views(["silver"], """
select cod, km, km > 1 as km_valido from silver where precio_ars is not null"""))
def g_km_valid_flag(spark, d):
    return features.with_km_valid(features.with_price(V.silver(spark, d))).select("cod", "km", "km_valido")


@query("g_median_by_brand", with_views(["silver"], """
select marca, median(km) as km_mediana from silver
where precio_ars is not null and km > 1 group by marca"""))
def g_median_by_brand(spark, d):
    return features.km_median_by_brand(features.with_km_valid(features.with_price(V.silver(spark, d))))


@query("g_impute_km", with_views(["gold"], "select cod, marca, km, km_valido from gold"))
def g_impute_km(spark, d):
    f = features.with_km_valid(features.with_price(V.silver(spark, d)))
    return features.impute_km(f, features.km_median_by_brand(f)).select("cod", "marca", "km", "km_valido")


@query("g_age_ratio", with_views(["gold"], "select cod, anio, antiguedad, km_por_anio from gold"))
def g_age_ratio(spark, d):
    f = features.with_km_valid(features.with_price(V.silver(spark, d)))
    g = features.with_age(features.impute_km(f, features.km_median_by_brand(f)), RUN_YEAR)
    return g.select("cod", "anio", "antiguedad", "km_por_anio")


@query("g_features", with_views(["gold"], "select * from gold"))
def g_features(spark, d):
    return V.gold(spark, d)


# ---------------------------------------------------------------- F: exchange rates


@query("f_normalize", with_views(["fx_silver"], "select * from fx_silver"))
def f_normalize(spark, d):
    return V.fx_silver(spark, d)


@query("f_latest_panel", with_views(["fx_silver"], """
select *, casa in ('blue', 'oficial') as featured from fx_silver
where fecha = (select max(fecha) from fx_silver)"""))
def f_latest_panel(spark, d):
    return fxo.latest_panel(V.fx_silver(spark, d))


@query("f_rate_on_day", with_views(["silver", "blue"], """
select s.cod, s.scraped_day, b.venta as dolar_blue_venta
from silver s left join blue b on s.scraped_day = b.fecha"""))
def f_rate_on_day(spark, d):
    s = V.silver(spark, d).select("cod", "scraped_day")
    return fxo.rate_on_day(s, V.fx(spark, d), "scraped_day")


@query("f_latest_rate", with_views(["blue"], """
select max(fecha) as fecha, arg_max(venta, fecha) as venta from blue"""))
def f_latest_rate(spark, d):
    return fxo.latest_rate(V.fx(spark, d))


@query("f_asof_rate", with_views(["silver", "blue"], """
select s.cod, s.scraped_day, b.venta as dolar_blue_venta_asof
from silver s asof left join blue b on s.scraped_day >= b.fecha"""))
def f_asof_rate(spark, d):
    s = V.silver(spark, d).select("cod", "scraped_day")
    return fxo.asof_rate(s, V.fx(spark, d), "scraped_day")


@query("f_usd_estimate", with_views(["scored", "blue"], """
select s.cod, s.precio_estimado, b.venta as dolar_blue_venta,
       cast(floor(s.precio_estimado / nullif(b.venta, 0) + 0.5) as bigint) as precio_usd
from scored s left join blue b on s.scraped_day = b.fecha"""))
def f_usd_estimate(spark, d):
    s = V.scored_table(spark, d).select("cod", "precio_estimado", "scraped_day")
    r = fxo.rate_on_day(s, V.fx(spark, d), "scraped_day")
    return r.select("cod", "precio_estimado", "dolar_blue_venta",
                    fxo.usd_price(F.col("precio_estimado"), F.col("dolar_blue_venta")).alias("precio_usd"))


@query("f_usd_to_ars_bound", with_views(["blue"], """
select c_custkey, cast(floor(abs(c_acctbal)) as bigint) as usd,
       cast(trunc((select arg_max(venta, fecha) from blue) * cast(floor(abs(c_acctbal)) as bigint)) as bigint)
         as precio_max
from customer"""))
def f_usd_to_ars_bound(spark, d):
    rate = fxo.latest_rate(V.fx(spark, d)).select(F.col("venta").alias("_rate"))
    cust = table(spark, d, "customer").select(
        "c_custkey", F.floor(F.abs("c_acctbal")).cast("bigint").alias("usd"))
    # one-row rate table: a proven broadcast bound
    return (cust.crossJoin(F.broadcast(rate))
                .select("c_custkey", "usd", fxo.ars_bound(F.col("_rate"), F.col("usd")).alias("precio_max")))


# ---------------------------------------------------------------- M: model and scores


_SPLIT_SQL = "case when substr(md5('42:' || cod), 1, 2) < '33' then 'test' else 'train' end"

_METRICS_SQL = """
select {by} count(*) as n,
       round(cast(sum(abs(e)) as double) / count(*), 2) as mae,
       round(sqrt(sum(cast(e as double) * cast(e as double)) / count(*)), 2) as rmse,
       round(1.0 - sum(cast(e as double) * cast(e as double)) / (count(*) * var_pop(cast(y as double))), 6) as r2,
       round(avg(abs(cast(e as double) / cast(y as double))) * 100, 4) as mape
from (select *, precio_estimado - precio_ars as e, precio_ars as y from {src}) t {where} {group}"""


def _metrics_sql(src: str, by: str | None = None, where: str = "") -> str:
    return _METRICS_SQL.format(by=f"{by}, " if by else "", src=src, where=where,
                               group=f"group by {by}" if by else "")


@query("m_split_counts", with_views(["gold"], f"select {_SPLIT_SQL} as split, count(*) as n from gold group by 1"))
def m_split_counts(spark, d):
    return mo.split_counts(V.gold_table(spark, d))


def _fitted_sql(keys: str) -> str:
    """Priced silver rows of both splits with the median price of their group's training rows."""
    rows = f"(select *, {_SPLIT_SQL} as split from silver where precio_ars is not null)"
    return f"""(select t.*, cast(round_even(m.med, 0) as bigint) as precio_estimado from {rows} t
  join (select {keys}, median(precio_ars) as med from {rows} where split = 'train' group by {keys}) m using ({keys}))"""


def _fitted(spark, d, keys):
    """A median model fitted on the training split alone, applied to the rows of both splits. The
    fitted table is stored once, like any model, and read by every evaluation."""
    rows = mo.with_split(V.silver(spark, d).where(F.col("precio_ars").isNotNull()))
    fit = lambda: group_median(rows.where(F.col("split") == "train"), keys, "precio_ars", "_med")
    return mo.apply_median(rows, small_broadcast(V.stored(spark, d, "median_train_" + "_".join(keys), fit)), keys)


@query("m_metrics", with_views(["silver"], _metrics_sql(_fitted_sql("marca, modelo"), "split")))
def m_metrics(spark, d):
    return mo.regression_metrics(_fitted(spark, d, ["marca", "modelo"]), "precio_ars", "precio_estimado", ["split"])


@query("m_overfit_gap", with_views(["silver"], f"""
select train_mae, test_mae, round(test_mae - train_mae, 2) as gap_mae,
       round(test_mae - train_mae, 2) > train_mae * 0.5 as overfit
from (select max(case when split = 'train' then mae end) as train_mae,
             max(case when split = 'test' then mae end) as test_mae
      from ({_metrics_sql(_fitted_sql("marca, modelo"), "split")}))"""))
def m_overfit_gap(spark, d):
    return mo.overfit_gap(m_metrics(spark, d))


@query("m_label_encode", with_views(["gold"], """
select cod, dense_rank() over (order by coalesce(marca, 'None')) - 1 as marca_code,
       dense_rank() over (order by coalesce(modelo, 'None')) - 1 as modelo_code,
       dense_rank() over (order by coalesce(provincia, 'None')) - 1 as provincia_code
from gold"""))
def m_label_encode(spark, d):
    return mo.label_encode(V.gold_table(spark, d)).select("cod", "marca_code", "modelo_code", "provincia_code")


_STD_COLS = ["anio", "km", "km_por_anio"]


def _std_sql() -> str:
    stats = ", ".join([f"avg({c}) as {c}__mu, stddev_pop({c}) as {c}__sd" for c in _STD_COLS])
    outs = []
    for c in _STD_COLS:
        sd = f"(case when {c}__sd = 0 then 1.0 else {c}__sd end)"
        z = f"(({c} - {c}__mu) / {sd})"
        outs.append(f"round({z}, 6) as {c}_z, round({z} * {sd} + {c}__mu, 4) as {c}_inv")
    return f"select cod, {', '.join(outs)} from gold cross join (select {stats} from gold)"


@query("m_standardize", with_views(["gold"], _std_sql()))
def m_standardize(spark, d):
    return mo.standardize(V.gold_table(spark, d), _STD_COLS)


_COMPARE_CTES = [
    ("t", f"select * from {_fitted_sql('marca, modelo')} where split = 'test'"),
    ("b", f"select * from {_fitted_sql('marca')} where split = 'test'"),
    ("ma", _metrics_sql("t")), ("mb", _metrics_sql("b")),
    ("la", "unpivot ma on mae, rmse, r2, mape into name metric value value_a"),
    ("lb", "unpivot mb on mae, rmse, r2, mape into name metric value value_b"),
    ("per", """select upper(la.metric) as metric, value_a, value_b,
                      case when (la.metric = 'r2' and value_a > value_b) or (la.metric <> 'r2' and value_a < value_b)
                           then 'a' else 'b' end as winner
               from la join lb on la.metric = lb.metric"""),
]


@query("m_compare", with_views(["silver"], """
select * from per
union all
select 'OVERALL', cast(count(*) filter (where winner = 'a') as double),
       cast(count(*) filter (where winner = 'b') as double),
       case when count(*) filter (where winner = 'a') >= 3 then 'a' else 'b' end from per""", _COMPARE_CTES))
def m_compare(spark, d):
    """M8: two models fitted on the training split, measured on the hold-out rows they can estimate."""
    test = F.col("split") == "test"
    ma = mo.regression_metrics(_fitted(spark, d, ["marca", "modelo"]).where(test), "precio_ars", "precio_estimado")
    mb = mo.regression_metrics(_fitted(spark, d, ["marca"]).where(test), "precio_ars", "precio_estimado")
    return mo.compare_models(ma, mb)


@query("m_score", with_views(["scored"], "select cod, precio_ars, precio_estimado, oportunidad_score from scored"))
def m_score(spark, d):
    return V.scored(spark, d).select("cod", "precio_ars", "precio_estimado", "oportunidad_score")


@query("m_opportunity_count", with_views(["scored"], """
select count(*) filter (where oportunidad_score > 0.1) as oportunidades, count(*) as total from scored"""))
def m_opportunity_count(spark, d):
    return mo.count_opportunities(V.scored_table(spark, d))


@query("m_top5", with_views(["scored"], """
select cod, marca, modelo, anio, precio_ars, precio_estimado, oportunidad_score from scored
where oportunidad_score is not null order by oportunidad_score desc, cod limit 5"""))
def m_top5(spark, d):
    return mo.top_scores(V.scored_table(spark, d), 5)


@query("m_prepare", with_views(["gold"], """
select cod, marca, modelo, provincia, anio, antiguedad, km, coalesce(km_valido, false) as km_valido, km_por_anio, dolar_blue_venta, precio_ars
from gold"""))
def m_prepare(spark, d):
    return mo.prepare(V.gold_table(spark, d))


_FOLD_SQL = f"cast('0x' || substr(md5('fold:42:' || cod), 1, 8) as bigint) % {encode.FOLDS}"
_TE_COLS = ["marca", "modelo", "provincia"]
_K = encode.SMOOTHING


def _te_sql() -> str:
    """Per gold row and categorical: the smoothed mean price of the value's training rows outside the row's own fold."""
    joins = "\n".join(f"left join by_value v_{c} on v_{c}.c = '{c}' and v_{c}.v = coalesce(r.{c}, 'None')"
                      f" left join by_fold f_{c} on f_{c}.c = '{c}' and f_{c}.v = coalesce(r.{c}, 'None') and f_{c}.fold = r.own" for c in _TE_COLS)
    out = ", ".join(
        f"round(case when v_{c}.n is null then a.mean else (cast(v_{c}.s - coalesce(f_{c}.s, 0) as double) + a.mean * {_K}.0)"
        f" / (v_{c}.n - coalesce(f_{c}.n, 0) + {_K}.0) end, 4) as {c}_te" for c in _TE_COLS)
    return f"select r.cod, r.own as fold, {out} from r join a on a.fold = r.own {joins}"


_TE_CTES = [
    ("r", f"select *, case when {_SPLIT_SQL} = 'train' then {_FOLD_SQL} else {encode.OUTSIDE} end as own from gold"),
    ("cells", " union all ".join(f"select '{c}' as c, coalesce({c}, 'None') as v, own as fold, precio_ars as y from r where own >= 0" for c in _TE_COLS)),
    ("by_fold", "select c, v, fold, count(*) as n, sum(y) as s from cells group by all"),
    ("by_value", "select c, v, count(*) as n, sum(y) as s from cells group by all"),
    ("a", f"""select g.f as fold, cast(sum(precio_ars) filter (where own <> g.f) as double) / count(*) filter (where own <> g.f) as mean
              from r, (select unnest(range({encode.OUTSIDE}, {encode.FOLDS})) as f) g where own >= 0 group by g.f"""),
]


@query("m_target_encode", with_views(["gold"], _te_sql(), _TE_CTES))
def m_target_encode(spark, d):
    """M3's categoricals: training rows by the other folds' statistics, the other rows by all of them."""
    rows = mo.with_split(V.gold_table(spark, d))
    train = F.col("split") == "train"
    stats_path = scratch_path(spark, "te-statistics")
    encode.statistics(rows.where(train)).write.parquet(stats_path)
    own = F.when(train, encode.fold(F.col("cod"))).otherwise(encode.OUTSIDE).cast("int")
    out = encode.encode(rows.withColumn("fold", own), spark.read.parquet(stats_path), own)
    return out.select("cod", "fold", *[F.round(f"{c}_te", 4).alias(f"{c}_te") for c in _TE_COLS])


_MODELS: dict[tuple, tuple] = {}


def _model(spark, d):
    """M3 + S13 + S8: all trees trained on gold, once per session and data folder; saved, saved again
    and loaded as the registry's latest model. Returns (as trained, as loaded)."""
    key = (spark.sparkContext.applicationId, d, storage.state(spark, d))
    if key not in _MODELS:
        root = scratch_path(spark, "models")
        trained = mo.train_gbt(V.gold_table(spark, d))
        for day in ("2001-12-30", "2001-12-31", "2001-12-31"):
            save_model(trained, root, day)
        _MODELS[key] = (trained, load_latest_model(spark, root))
    return _MODELS[key]


def _library_prediction(model, rows):
    """Spark ML's own prediction of the fitted model, to hold the one from the node table against."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressionModel

    data = VectorAssembler(inputCols=mo.FEATURES, outputCol="features").transform(rows)
    return GBTRegressionModel.load(model.fitted).setPredictionCol("library").transform(data)


def _predictions(spark, d):
    """Every gold row scored once by the loaded model and, beside it, by Spark ML's own; stored."""
    trained, loaded = _model(spark, d)

    def score():
        rows = mo.feature_rows(V.gold_table(spark, d), loaded.statistics)
        return _library_prediction(trained, loaded.transform(rows)).select("cod", "precio_ars", "prediction", "library")
    return V.stored(spark, d, "gbt_predictions", score)


@query("m_gbt_score")
def m_gbt_score(spark, d):
    """Estimates and scores of every gold row by the loaded model.

    No SQL states a fitted model's estimates; `m_gbt_quality` checks them."""
    return mo.with_split(mo.estimate_columns(_predictions(spark, d))).select(
        "cod", "precio_ars", "split", F.round("prediction", 4).alias("prediction"), "precio_estimado", "oportunidad_score")


@query("m_gbt_quality", with_views(["silver"], f"""
select n, mae as baseline_mae, true as trees_better, 0::bigint as other_estimates, 0::bigint as other_scores
from ({_metrics_sql("(select * from " + _fitted_sql("marca, modelo") + " where split = 'test')")})"""))
def m_gbt_quality(spark, d):
    """M3, M9, M10 proved on every hold-out row that the brand-model median can estimate: the trees'
    mean absolute error is below the median's, every estimate from the saved node table is that of
    Spark ML's own model, and every score follows from its estimate."""
    base = _fitted(spark, d, ["marca", "modelo"]).where("split = 'test'")
    baseline = mo.regression_metrics(base, "precio_ars", "precio_estimado").select("n", F.col("mae").alias("baseline_mae"))
    both = mo.estimate_columns(mo.with_split(_predictions(spark, d)).where("split = 'test'"))
    other = F.abs(F.col("prediction") - F.col("library")) > 1e-6 * F.abs(F.col("library"))
    exact = F.bround((F.col("precio_estimado") - F.col("precio_ars")) / F.nullif(F.col("precio_estimado").cast("double"), F.lit(0.0)), 4)
    found = (both.join(base.select("cod"), "cod", "left_semi")
             .agg(F.avg(F.abs(F.col("prediction") - F.col("precio_ars"))).alias("mae"), F.count_if(other | F.col("prediction").isNull()).alias("other_estimates"),
                  F.count_if(~exact.eqNullSafe(F.col("oportunidad_score"))).alias("other_scores")))
    return (baseline.crossJoin(F.broadcast(found))      # one row each
            .select("n", "baseline_mae", (F.col("mae") < F.col("baseline_mae")).alias("trees_better"), "other_estimates", "other_scores"))


_REQ_RATE_SQL = "(select arg_max(venta, fecha) from blue)"


@query("m_request_features", with_views(["requests", "blue"], f"""
select req_id, marca, modelo, provincia, anio, km, {REQUEST_RUN_YEAR} - anio as antiguedad, km > 1 as km_valido,
       km / greatest({REQUEST_RUN_YEAR} - anio, 1) as km_por_anio, {_REQ_RATE_SQL} as dolar_blue_venta,
       case when {REQUEST_RUN_YEAR} - anio = 0 then '{mo.AGE_ZERO_WARNING}' end as advertencia
from requests"""))
def m_request_features(spark, d):
    rate = fxo.latest_rate(V.fx(spark, d)).select(F.col("venta").alias("_rate"))
    req = V.requests(spark, d).crossJoin(F.broadcast(rate))
    return mo.request_features(req, REQUEST_RUN_YEAR, F.col("_rate")).drop("_rate")


@query("m_request_validation", with_views(["requests"], f"""
select req_id, nullif(concat_ws('; ',
         case when marca is null then 'marca missing' end,
         case when modelo is null then 'modelo missing' end,
         case when provincia is null then 'provincia missing' end,
         case when anio is null then 'anio missing' end,
         case when km is null then 'km missing' end,
         case when anio < 1990 or anio > {REQUEST_RUN_YEAR} then 'anio out of range' end,
         case when km < 0 then 'km negative' end), '') as reasons,
       nullif(concat_ws('; ',
         case when marca is null then 'marca missing' end,
         case when modelo is null then 'modelo missing' end,
         case when provincia is null then 'provincia missing' end,
         case when anio is null then 'anio missing' end,
         case when km is null then 'km missing' end,
         case when anio < 1990 or anio > {REQUEST_RUN_YEAR} then 'anio out of range' end,
         case when km < 0 then 'km negative' end), '') is null as valid
from requests"""))
def m_request_validation(spark, d):
    return mo.validate_requests(V.requests(spark, d)).select("req_id", "reasons", "valid")


_REASONS_SQL = """nullif(concat_ws('; ',
         case when marca is null then 'marca missing' end, case when modelo is null then 'modelo missing' end,
         case when provincia is null then 'provincia missing' end, case when anio is null then 'anio missing' end,
         case when km is null then 'km missing' end,
         case when anio < 1990 or anio > {year} then 'anio out of range' end, case when km < 0 then 'km negative' end), '')"""


@query("m_request_score", with_views(["requests"], f"""
select req_id, reasons is null as valid, reasons, case when reasons is null and {REQUEST_RUN_YEAR} - anio = 0 then '{mo.AGE_ZERO_WARNING}' end as advertencia,
       reasons is null as estimated, reasons is null as truncated
from (select *, {_REASONS_SQL.format(year=REQUEST_RUN_YEAR)} as reasons from requests)"""))
def m_request_score(spark, d):
    """Every request scored by the registry's latest model; a valid one has an estimate, which
    is Spark ML's own prediction cut to a whole number, an invalid one has none."""
    trained, loaded = _model(spark, d)
    rate = fxo.latest_rate(V.fx(spark, d)).select(F.col("venta").alias("_rate"))
    req = V.requests(spark, d).crossJoin(F.broadcast(rate))
    scored = mo.score_requests(loaded, req, REQUEST_RUN_YEAR, F.col("_rate"))
    feats = mo.request_features(mo.validate_requests(req), REQUEST_RUN_YEAR, F.col("_rate")).where("valid")
    library = _library_prediction(trained, mo.feature_rows(feats, trained.statistics, keep=("req_id",))).select("req_id", "library")
    off = F.col("library") - F.col("precio_estimado_ars")
    # a whole number below a positive prediction, by less than one
    cut = (off > -1e-3) & (off < 1 + 1e-3)
    return (scored.join(library, "req_id", "left")
            .select("req_id", "valid", "reasons", "advertencia", F.col("precio_estimado_ars").isNotNull().alias("estimated"),
                    F.coalesce(cut, F.lit(False)).alias("truncated")))


_MODEL_KEYS_SQL = """
select distinct case when substr(o_orderpriority, 1, 1) = '1'
                     then 'models/gbt/fecha=' || cast(cast(o_orderdate as date) as varchar)
                     else 'models/gbt/run-' || cast(o_orderkey as varchar) end as key
from orders"""


@query("m_model_date", f"""
select key, try_cast(nullif(regexp_extract(key, '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '') as date) as model_date
from ({_MODEL_KEYS_SQL})""")
def m_model_date(spark, d):
    return model_keys(spark, d).select("key", mo.model_date(F.col("key")).alias("model_date"))


# ---------------------------------------------------------------- Q: market queries


_SEARCH = mk.SearchFilter(marca="brand#1", provincia="nation_1", anio_min=1996, anio_max=2000,
                          km_max=150000, precio_max=9_000_000, solo_oportunidades=True)
_TABLE = dict(search_text="gear", anio_min="1997", precio_max="5000000")
_TABLE_SQL = ("(contains(lower(modelo), 'gear') or contains(lower(marca), 'gear')) "
              "and coalesce(anio, 0) >= 1997 and coalesce(precio_ars, 0) <= 5000000")
_FEED = ", ".join(mk.FEED_COLUMNS)


@query("q_search", with_views(["serving"], """
select cod, marca, modelo, anio, km, precio_ars, provincia, oportunidad_score, url from serving
where contains(lower(marca), 'brand#1') and contains(lower(provincia), 'nation_1')
  and anio >= 1996 and anio <= 2000 and km <= 150000 and precio_ars <= 9000000 and oportunidad_score >= 0.1
order by oportunidad_score desc nulls last, cod limit 10"""))
def q_search(spark, d):
    return mk.search(V.serving_table(spark, d), _SEARCH)


def _fmt(c: str) -> str:
    return f"coalesce(format('{{:,}}', {c}), 'None')"


@query("q_labels", with_views(["serving"], f"""
select cod, '- ' || coalesce(marca, 'None') || ' ' || coalesce(modelo, 'None') || ' ' ||
       coalesce(cast(anio as varchar), 'None') || ' | ' || {_fmt('km')} || ' km | $' || {_fmt('precio_ars')} ||
       case when oportunidad_score >= 0.1 then ' 🔥 ' || format('{{:.1f}}', oportunidad_score * 100) || '% subvaluado' else '' end ||
       ' | ' || coalesce(provincia, 'None') || ' | ' || coalesce(url, 'None') as line
from serving"""))
def q_labels(spark, d):
    return mk.result_lines(V.serving_table(spark, d))


@query("q_top_opportunities", with_views(["serving"], """
select cod, marca, modelo, anio, km, precio_ars, precio_estimado, oportunidad_score, provincia, url,
       coalesce(precio_estimado, 0) - coalesce(precio_ars, 0) as ahorro
from serving where oportunidad_score >= 0.1 and contains(lower(marca), 'brand#2')
order by oportunidad_score desc, cod limit 7"""))
def q_top_opportunities(spark, d):
    return mk.top_opportunities(V.serving_table(spark, d), marca="brand#2", limite=7)


@query("q_top_lines", with_views(["serving"], f"""
select cod, '- ' || marca || ' ' || modelo || ' ' || coalesce(cast(anio as varchar), 'None') || ' | ' || {_fmt('km')} ||
       ' km | Publicado: $' || {_fmt('precio_ars')} || ' | Estimado: $' || {_fmt('precio_estimado')} || ' | Ahorro: $' ||
       format('{{:,}}', coalesce(precio_estimado, 0) - coalesce(precio_ars, 0)) || ' (' ||
       format('{{:.1f}}', oportunidad_score * 100) || '%) | ' || coalesce(provincia, 'None') || ' | ' || coalesce(url, 'None') as line
from (select * from serving where oportunidad_score >= 0.1 order by oportunidad_score desc, cod limit 10)"""))
def q_top_lines(spark, d):
    return mk.opportunity_lines(mk.top_opportunities(V.serving_table(spark, d), limite=10))


@query("q_board", with_views(["serving"], f"""
select cod, marca, modelo, anio, provincia, precio_ars, precio_estimado, oportunidad_score,
       precio_estimado - precio_ars as ahorro, cast(floor(oportunidad_score * 100 + 0.5) as bigint) as pct,
       case when starts_with(url, 'http') then url else '{mk.BASE_URL}' || url end as url
from serving where oportunidad_score > 0.1 order by oportunidad_score desc, cod limit 20"""))
def q_board(spark, d):
    return mk.opportunity_board(V.serving_table(spark, d))


_FEED_SQL = f"select {_FEED} from serving order by scraped_at desc nulls first, cod limit 1000"


@query("q_recent_feed", with_views(["serving"], _FEED_SQL))
def q_recent_feed(spark, d):
    return mk.recent_feed(V.serving_table(spark, d))


@query("q_facets", with_views(["serving"], """
select distinct 'marca' as facet, marca as value from serving
union select distinct 'provincia', provincia from serving"""))
def q_facets(spark, d):
    return mk.facets(V.serving_table(spark, d))


@query("q_table_filter", with_views(["serving"], f"select {_FEED} from serving where {_TABLE_SQL}"))
def q_table_filter(spark, d):
    return V.serving_table(spark, d).where(mk.table_predicate(**_TABLE)).select(*mk.FEED_COLUMNS)


@query("q_user_sort", with_views(["serving"], f"select {_FEED} from serving"))
def q_user_sort(spark, d):
    return mk.user_sort(V.serving_table(spark, d).select(*mk.FEED_COLUMNS), "modelo", ascending=False)


_SORT_KEYS = ("marca", "modelo", "anio", "km", "precio_ars")


@query("q_sort_positions", with_views(["serving"], " union all ".join(
    f"""select '{k}' as key, cod, row_number() over (order by {k if k in ('marca', 'modelo') else f'coalesce({k}, 0)'} desc, cod) as position
from serving""" for k in _SORT_KEYS)))
def q_sort_positions(spark, d):
    """Q7 checked: every row's place under each of the five sort keys, over the whole table."""
    out = None
    for k in _SORT_KEYS:
        one = with_position(mk.user_sort(V.serving_table(spark, d).select("cod", k), k, ascending=False))
        one = one.select(F.lit(k).alias("key"), "cod", "position")
        out = one if out is None else out.unionByName(one)
    return out


@query("c_stamp_source", with_views(["silver"], "select cod, precio_ars, scraped_day, 'a' as source from silver"))
def c_stamp_source(spark, d):
    return clean.stamp_source(V.silver(spark, d).drop("source"), "a").select("cod", "precio_ars", "scraped_day", "source")


@query("q_relative_price", with_views(["serving"], """
select cod, coalesce(precio_ars, 0) / (select greatest(coalesce(max(precio_ars), 0), 1) from serving) * 100
       as pct_of_max from serving"""))
def q_relative_price(spark, d):
    return mk.relative_price(V.serving_table(spark, d))


@query("q_match_counter", with_views(["serving"], f"""
select count(*) filter (where {_TABLE_SQL}) as filtered, count(*) as total from serving"""))
def q_match_counter(spark, d):
    return mk.match_counter(V.serving_table(spark, d), mk.table_predicate(**_TABLE))


@query("q_km_display", with_views(["serving"], """
select cod, case when coalesce(km, 0) <= 1 then '—' else replace(format('{:,}', km), ',', '.') || ' km' end
       as km_text from serving"""))
def q_km_display(spark, d):
    return V.serving_table(spark, d).select("cod", mk.km_display(F.col("km")).alias("km_text"))


@query("q_market_metrics", with_views(["serving"], """
select count(*) as total_autos, count(*) filter (where oportunidad_score > 0.1) as total_oportunidades,
       max(fecha) as ultima_fecha_scraping, cast(0.1 as double) as threshold_oportunidad from serving"""))
def q_market_metrics(spark, d):
    return mk.market_metrics(V.serving_table(spark, d))


# ---------------------------------------------------------------- S: sources and sinks


_WRITTEN: dict[tuple, str] = {}
_PREFERRED_DAY = "2000-03-15"
_SERVING_COLS = ["cod", "marca", "modelo", "condicion", "provincia", "precio_ars", "anio", "km",
                 "path", "segmento", "source", "scraped_day"]
_PARTIAL_UPDATE = ["scraped_day", "precio_ars", "km", "segmento", "source"]


def _silver_by_day(spark, d):
    """Silver as a day-partitioned table per source (``source=<s>/scraped_day=<d>``); source b
    has no rows on the preferred day, so its reader falls back. One write for both
    sources, once per session and data folder."""
    key = (spark.sparkContext.applicationId, d, storage.state(spark, d), "silver_by_day")
    if key not in _WRITTEN:
        root = scratch_path(spark, "silver_by_day")
        s = V.silver(spark, d)
        rows = s.where((F.col("source") == "a") | (F.col("scraped_day") != F.lit(_PREFERRED_DAY).cast("date")))
        # so many ranges that the writer's sort by day holds few rows
        (rows.repartitionByRange(V.keyed_buckets(spark, d), "source", "scraped_day", "cod")
             .write.option("compression", "zstd").mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("source", "scraped_day").parquet(root))
        _WRITTEN[key] = root
    return _WRITTEN[key]


_B_GAP = f"(source = 'a' or scraped_day <> date '{_PREFERRED_DAY}')"


@query("s_latest_partition", with_views(["silver"], f"""
select source, max(scraped_day) as latest from silver where {_B_GAP} group by source"""))
def s_latest_partition(spark, d):
    root = _silver_by_day(spark, d)
    last = [F.struct(F.lit(s).alias("source"), F.lit(partitions.last_day(spark, f"{root}/source={s}", "scraped_day")).alias("latest"))
            for s in ("a", "b")]
    return spark.range(1).select(F.inline(F.array(*last)))


@query("s_read_day", with_views(["silver"], f"""
select * from silver where source = 'a' and scraped_day = date '{_PREFERRED_DAY}'"""))
def s_read_day(spark, d):
    # both predicates are on partition columns: only one folder is read
    return (partitions.read_day(spark, _silver_by_day(spark, d), "scraped_day", _PREFERRED_DAY)
            .where(F.col("source") == "a"))


@query("s_preferred_or_latest", with_views(["silver"], """
select c.source, c.chosen_day, count(*) as n_rows
from t join c on t.source = c.source and t.scraped_day = c.chosen_day group by c.source, c.chosen_day""",
    [("t", f"select * from silver where {_B_GAP}"),
     ("c", f"""select source, coalesce(max(case when scraped_day = date '{_PREFERRED_DAY}' then scraped_day end),
                                       max(scraped_day)) as chosen_day from t group by source""")]))
def s_preferred_or_latest(spark, d):
    root = _silver_by_day(spark, d)
    out = []
    for s in ("a", "b"):
        rows = partitions.read_day_or_last(spark, f"{root}/source={s}", "scraped_day", _PREFERRED_DAY)
        out.append(rows.groupBy(F.lit(s).alias("source"), F.col("scraped_day").alias("chosen_day"))
                       .agg(F.count(F.lit(1)).alias("n_rows")))
    return out[0].unionByName(out[1])


@query("s_listing_bronze_roundtrip", with_views(["listings"], """
select cod, marca, modelo, condicion, provincia, precio_ars, anio, km, path, segmento, source, scraped_day
from listings"""))
def s_listing_bronze_roundtrip(spark, d):
    """S1 + S2: land every listing record as a JSON line under its day, read it back
    with the explicit record schema."""
    key = (spark.sparkContext.applicationId, d, storage.state(spark, d), "listing_bronze")
    if key not in _WRITTEN:
        root = scratch_path(spark, "bronze_listings")
        recs = V.listings(spark, d).drop("_ord")
        bronze.land_records(recs, root, "scraped_day")
        _WRITTEN[key] = root
    schema = T.StructType([f for f in V.listings(spark, d).drop("_ord", "scraped_day").schema.fields])
    return bronze.read_records(spark, _WRITTEN[key], schema, "scraped_day")


@query("s_fx_bronze_roundtrip", with_views(["fx_silver"], "select * from fx_silver"))
def s_fx_bronze_roundtrip(spark, d):
    """S1-S3 + F1: one envelope document per day (fetched_at, source, data[]), read
    as multi-line JSON with the envelope schema, exploded and normalised."""
    key = (spark.sparkContext.applicationId, d, storage.state(spark, d), "fx_bronze")
    if key not in _WRITTEN:
        root = scratch_path(spark, "bronze_fx")
        recs = fx_bronze(spark, d)
        # at most one record per house and day: a bounded array per envelope
        env = recs.groupBy("fecha").agg(
            F.first("fetched_at").alias("fetched_at"), F.lit("rates-feed").alias("source"),
            F.collect_list(F.struct("casa", "nombre", "compra", "venta")).alias("data"))
        bronze.land_envelopes(env, root, "fecha")
        _WRITTEN[key] = root
    env_schema = T.StructType(list(schemas.FX_ENVELOPE.fields) + [T.StructField("fecha", T.DateType())])
    env = bronze.read_envelopes(spark, _WRITTEN[key], env_schema)
    return normalize_fx(bronze.explode_envelope(env, ["fetched_at", "source", "fecha"]))


_FX_T = "select * from fx_silver where fecha < date '2000-01-01'"
_FX_U = "select fecha, casa, nombre, compra, venta * 2 as venta, fetched_at from fx_silver where fecha > date '1999-06-30'"


@query("s_upsert_fx", with_views(["fx_silver"], f"""
select coalesce(t.fecha, u.fecha) as fecha, coalesce(t.casa, u.casa) as casa,
       case when u.fecha is not null then u.nombre else t.nombre end as nombre,
       case when u.fecha is not null then u.compra else t.compra end as compra,
       case when u.fecha is not null then u.venta else t.venta end as venta,
       case when u.fecha is not null then u.fetched_at else t.fetched_at end as fetched_at
from ({_FX_T}) t full join ({_FX_U}) u on t.fecha = u.fecha and t.casa = u.casa"""))
def s_upsert_fx(spark, d):
    fx = V.fx_silver(spark, d)
    target = fx.where(F.col("fecha") < F.lit("2000-01-01").cast("date"))
    updates = (fx.where(F.col("fecha") > F.lit("1999-06-30").cast("date"))
                 .withColumn("venta", F.col("venta") * 2))
    return sinks.upsert(target, updates, ["fecha", "casa"], ["nombre", "compra", "venta", "fetched_at"])


def _upsert_inputs(spark, d):
    # first and last record of each cod in one pass over all records, stored in buckets by the key: both
    # sides of the upsert read them as they lie
    def both():
        return first_and_last(V.listings(spark, d), ["cod"], "_ord", spread=True, partitions=V.keyed_buckets(spark, d))

    two = V.stored(spark, d, "first_and_last", both, bucket_by="cod")
    seven = F.col("cod").endswith("-7")
    target = two.where(~seven).select("cod", "first.*").select(*_SERVING_COLS)
    # one reading of the stored rows, as a union would lose their buckets; a null cod is in neither side
    newer = [F.when(seven, F.col(f"first.{c}")).otherwise(F.col(f"last.{c}")).alias(c) for c in _SERVING_COLS if c != "cod"]
    updates = two.where(F.col("cod").isNotNull() & (seven | F.col("last").isNotNull())).select("cod", *newer)
    return target, updates


def _upsert_select(update_cols) -> str:
    cols = []
    for c in _SERVING_COLS:
        if c == "cod":
            cols.append("coalesce(t.cod, u.cod) as cod")
        elif c in update_cols:
            cols.append(f"case when u.cod is not null then u.{c} else t.{c} end as {c}")
        else:
            cols.append(f"case when t.cod is not null then t.{c} else u.{c} end as {c}")
    sel = ", ".join(_SERVING_COLS)
    return f"""
select {', '.join(cols)}
from (select {sel} from listings where pos = 1 and cod not like '%-7') t
full join (select {sel} from (select *, max(pos) over (partition by cod) as top from listings)
           where (pos = top and pos > 1 and cod not like '%-7') or (pos = 1 and cod like '%-7')) u
  on t.cod = u.cod"""


def _upsert_sql(update_cols) -> str:
    return with_views(["listings"], _upsert_select(update_cols))


@query("s_upsert_partial", _upsert_sql(_PARTIAL_UPDATE))
def s_upsert_partial(spark, d):
    target, updates = _upsert_inputs(spark, d)
    return sinks.upsert(target, updates, ["cod"], _PARTIAL_UPDATE)


@query("s_upsert_full", _upsert_sql([c for c in _SERVING_COLS if c != "cod"]))
def s_upsert_full(spark, d):
    target, updates = _upsert_inputs(spark, d)
    return sinks.upsert(target, updates, ["cod"])


@query("s_update_only", with_views(["silver", "scored"], """
select t.cod, t.precio_ars, s.precio_estimado, s.oportunidad_score
from (select cod, precio_ars from silver where source = 'a') t left join scored s on t.cod = s.cod"""))
def s_update_only(spark, d):
    target = V.silver(spark, d).where(F.col("source") == "a").select("cod", "precio_ars")
    scores = V.scored_table(spark, d).select("cod", "precio_estimado", "oportunidad_score")
    return sinks.update_only(target, scores, ["cod"], ["precio_estimado", "oportunidad_score"])


def _contract_sql() -> str:
    c = schemas.SERVING_LISTINGS
    parts = ["count(*) as rows"]
    parts += [f"count(*) filter (where {x} is null) as null_{x}" for x in c["not_null"]]
    parts += [f"count(*) filter (where length({x}) > {n}) as too_long_{x}" for x, n in c["max_len"].items()]
    return with_views(["listings"], f"""
select {', '.join(parts)},
       (select coalesce(sum(n - 1), 0) from (select cod, count(*) as n from m group by cod having count(*) > 1))
         :: bigint as duplicate_keys
from (select *, scraped_day as fecha from m)""", [("m", _upsert_select(_PARTIAL_UPDATE))])


@query("s_contract_violations", _contract_sql())
def s_contract_violations(spark, d):
    merged = s_upsert_partial(spark, d).withColumn("fecha", F.col("scraped_day"))
    return sinks.contract_violations(merged, schemas.SERVING_LISTINGS)


_HISTORY_KEEP = [c for c in _SERVING_COLS if c not in _PARTIAL_UPDATE]
_HISTORY_BUCKETS = 8
_BATCH_SQL = "case when year(scraped_day) <= 1994 then 0 when year(scraped_day) <= 1996 then 1 else 2 end"
_HISTORY_CTES = [
    ("k", f"""select * from (select *, {_BATCH_SQL} as batch, row_number() over (partition by cod, {_BATCH_SQL} order by pos) as nr from listings)
              where nr = 1"""),
    ("e", "select *, min(batch) over (partition by cod) as lo, max(batch) over (partition by cod) as hi from k"),
    ("history", "select " + ", ".join(f"{'l' if c in _PARTIAL_UPDATE else 'f'}.{c}" for c in _SERVING_COLS) +
     " from (select * from e where batch = lo) f join (select * from e where batch = hi) l using (cod)"),
]
_HISTORIES: dict[tuple, list] = {}


def _history(spark, d):
    """S10 over time: all records in three batches by year, each merged into a stored table, the
    last batch once more (J4), then one changed row. Returns the versions' root and what every
    step left (step, rows, fingerprint); once per session and data folder."""
    key = (spark.sparkContext.applicationId, d, storage.state(spark, d))
    if key not in _HISTORIES:
        root, steps = scratch_path(spark, "history"), []
        rows = V.listings(spark, d)
        year = F.year("scraped_day")
        batches = [rows.where(year <= 1994), rows.where((year > 1994) & (year <= 1996)), rows.where(year > 1996)]
        parts = V.keyed_buckets(spark, d)
        merge = lambda batch, n=None: sinks.merge(spark, root, batch, ["cod"], _PARTIAL_UPDATE, buckets=_HISTORY_BUCKETS, partitions=n)
        first = lambda batch: clean.dedup_first(batch, partitions=parts).select(*_SERVING_COLS)
        # merged twice: stored in buckets by the key, which both merges read as they lie
        last = V.stored(spark, d, "history_batch", lambda: first(batches[2]), bucket_by="cod")
        for batch in (first(batches[0]), first(batches[1]), last, last):
            done = merge(batch, parts)
            steps.append((("first" if len(steps) < 3 else "again"), done.rows, str(done.fingerprint)))
        at = f"{root}/{sinks.LOG}/{done.version:020d}"
        now = sinks.table_version(spark, root)
        changed = sinks.read_current(spark, root).orderBy("cod").limit(1).withColumn("km", F.coalesce(F.col("km"), F.lit(0)) + 1)
        done = merge(changed)
        steps.append(("changed", done.rows, str(done.fingerprint)))
        assert len(done.rewritten) == 1 and storage.exists(spark, at)
        _HISTORIES[key] = [root, now, steps[2:]]
    return _HISTORIES[key]


@query("s_merge_buckets", with_views(["listings"], "select * from history", _HISTORY_CTES))
def s_merge_buckets(spark, d):
    """S10 on a stored table: three batches merged bucket by bucket, and the last one again."""
    root, version, _ = _history(spark, d)
    return sinks.read_version(spark, root, version)


def _row_hash_sql(km: str = "km") -> str:
    text = [f"coalesce('=' || cast({km if c == 'km' else c} as varchar), '-')" for c in sorted(_SERVING_COLS)]
    return f"cast('0x' || substr(md5(concat_ws(chr(31), {', '.join(text)})), 1, 15) as hugeint)"


@query("j_rerun_fingerprint", with_views(["listings"], f"""
select 'first' as step, rows, cast(total as varchar) as fingerprint from t
union all select 'again', rows, cast(total as varchar) from t
union all select 'changed', rows, cast(total - old + new as varchar)
from t, (select {_row_hash_sql()} as old, {_row_hash_sql("(coalesce(km, 0) + 1)")} as new from history order by cod limit 1)""",
    [*_HISTORY_CTES, ("t", f"select count(*) as rows, sum({_row_hash_sql()}) as total from history")]))
def j_rerun_fingerprint(spark, d):
    """The stored table's rows and fingerprint after the load, after the same load again, and after
    one row changed, as the versions carry them."""
    _, _, steps = _history(spark, d)
    return spark.createDataFrame(steps, "step string, rows long, fingerprint string")


_RUN_PARAMS_SQL = ", ".join(f"('{k}', '{v}')" for k, v in mo.training_parameters(0, 0, "").items() if k not in ("train_size", "test_size", "gold_date"))


@query("s_runs", with_views(["silver"], f"""
select 'param' as kind, name, text, null::double as number from (values {_RUN_PARAMS_SQL}) t(name, text)
union all select 'param', split || '_size', cast(n as varchar), null from m
union all select 'param', 'gold_date', cast(max(scraped_day) as varchar), null from silver
union all select 'metric', split || '_' || x.name, null, x.value from m, (select unnest(['mae', 'rmse', 'r2', 'mape']) as name, unnest([mae, rmse, r2, mape]) as value) x
union all select 'metric', 'overfitting_gap_mae', null, round(max(mae) filter (where split = 'test') - max(mae) filter (where split = 'train'), 2) from m""",
    [("m", _metrics_sql(_fitted_sql("marca, modelo"), "split"))]))
def s_runs(spark, d):
    """A run recorded in the run table and read back: the nine parameters, the metrics of both splits, the gap."""
    root = scratch_path(spark, "runs")
    found = {r.split: r.asDict() for r in m_metrics(spark, d).collect()}
    day = V.silver(spark, d).agg(F.max("scraped_day")).first()[0]
    pick = lambda s: {k: found[s][k] for k in ("mae", "rmse", "r2", "mape")}
    record_run(spark, root, mo.training_parameters(found["train"]["n"], found["test"]["n"], day), pick("train"), pick("test"), day)
    runs = read_runs(spark, root)
    metric = F.when(F.col("name") == "overfitting_gap_mae", F.round("value", 2)).otherwise(F.col("value"))
    return (runs.select(F.lit("param").alias("kind"), F.explode("params").alias("name", "text")).withColumn("number", F.lit(None).cast("double"))
            .unionByName(runs.select(F.lit("metric").alias("kind"), F.explode("metrics").alias("name", "value"))
                         .select("kind", "name", F.lit(None).cast("string").alias("text"), metric.alias("number"))))


_GOOD_SQL = """try_cast(precio_ars as bigint) as precio_ars, try_cast(anio as int) as anio, try_cast(km as bigint) as km,
       url, try_cast(segmento as tinyint) as segmento"""
_FAULTS_SQL = """nullif(concat_ws('; ', case when anio is not null and try_cast(anio as int) is null then 'anio is not int' end,
                                case when km is not null and try_cast(km as bigint) is null then 'km is not bigint' end), '')"""


@query("c_typed_envelope", with_views(["raw_listings"], f"""
select cod, marca, modelo, condicion, provincia, {_GOOD_SQL}, 'scraped/' || source as scraped_at, date '{RUN_DAY}' as fecha
from raw_listings where {_FAULTS_SQL} is null"""))
def c_typed_envelope(spark, d):
    """S1-S3 + C1 + C2: the feed's records landed in envelopes, read back as text, typed, the good ones
    with the envelope's scrape time."""
    raw = fxt.raw_listings(V.listings(spark, d))
    fields = [f for f in schemas.LISTING_RECORD.fieldNames() if f not in ("scraped_at", "source")]
    parts = -(-max(raw.count(), 1) // 10_000)       # envelopes of about 10,000 records
    env = (raw.groupBy("source", F.pmod(F.xxhash64("cod", "_ord"), F.lit(parts)).alias("_part"))
              .agg(F.collect_list(F.struct(*fields)).alias("data"))
              .select(F.concat(F.lit("scraped/"), "source").alias("scraped_at"), "source", "data", F.lit(RUN_DAY).cast("date").alias("fecha")))
    root = scratch_path(spark, "envelopes")
    bronze.land_envelopes(env, root, "fecha")
    rows = bronze.read_envelopes_checked(spark, root, T.StructType([f for f in schemas.LISTING_ENVELOPE.fields if f.name in ("scraped_at", "source", "data")]),
                                         ["scraped_at", "source"])
    good, _ = clean.split_checked(clean.checked_projection(rows.drop("source"), day=RUN_DAY, scraped_at=F.col("scraped_at")))
    return good.select(*[f for f in fields], "scraped_at", "fecha")


_BROKEN_SQL = "segmento = '2' and km = '3000'"


@query("c_quarantine", with_views(["raw_listings"], f"""
select null as cod, 'record is not JSON' as reason, '{{"cod":"' || cod || '"' as head from raw_listings where {_BROKEN_SQL}
union all
select cod, {_FAULTS_SQL}, null from raw_listings where not ({_BROKEN_SQL}) and {_FAULTS_SQL} is not null"""))
def c_quarantine(spark, d):
    """S2 + C1: the day's records that do not fit, with their reasons; some lines of the feed break off."""
    raw = fxt.raw_listings(V.listings(spark, d))
    fields = [f for f in schemas.LISTING_RECORD.fieldNames() if f not in ("scraped_at", "source")]
    broken = (F.col("segmento") == "2") & (F.col("km") == "3000")
    line = F.when(broken, F.concat(F.lit('{"cod":"'), "cod", F.lit('"'))).otherwise(F.to_json(F.struct(*fields)))
    root = scratch_path(spark, "feed")
    raw.select(line.alias("value")).write.text(f"{root}/scraped_day={RUN_DAY}")
    schema = T.StructType([f for f in schemas.LISTING_RECORD.fields if f.name in fields])
    checked = clean.checked_projection(bronze.read_records_checked(spark, root, schema, "scraped_day"), day=RUN_DAY)
    _, bad = clean.split_checked(checked)
    lost = F.col("_reason") == "record is not JSON"
    return bad.select("cod", F.col("_reason").alias("reason"), F.when(lost, F.col("_record")).alias("head"))


@query("g_optional_source", with_views(["silver"], """
select 'absent' as case_, 'a' as source, count(*) as rows, count(km) as with_km from silver where source = 'a'
union all select 'empty', 'a', count(*), count(km) from silver where source = 'a'
union all select 'present', source, count(*), count(km) from silver group by source
union all select 'narrow', source, count(*), case when source = 'a' then count(km) else 0 end from silver group by source"""))
def g_optional_source(spark, d):
    """G1 + G2 + S7: source b absent, without data, present, and present without its km column."""
    s, root, out = V.silver(spark, d), scratch_path(spark, "sources"), None
    day = F.lit(RUN_DAY).cast("date").alias("fecha")
    a, b = (s.where(F.col("source") == x).drop("source").select("*", day) for x in ("a", "b"))
    for name, rows in (("a", a), ("present", b), ("narrow", b.drop("km"))):
        partitions.write_day_partitions(rows, f"{root}/{name}", "fecha", ["cod"])
    b.limit(0).write.partitionBy("fecha").parquet(f"{root}/empty")
    for case in ("absent", "empty", "present", "narrow"):
        rows = silver_of(spark, {"a": f"{root}/a", "b": f"{root}/{case}"}, RUN_DAY)
        found = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count("km").alias("with_km"))
        found = found.select(F.lit(case).alias("case_"), "source", "rows", "with_km")
        out = found if out is None else out.unionByName(found)
    return out


# ---------------------------------------------------------------- P: page extraction


@query("p_links", """
select distinct unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) as link from pages""")
def p_links(spark, d):
    return pg.extract_links(fxt.table(spark, d, "pages"), pattern=r'href="([^"]+)"', group=1)


@query("p_new_links", with_views(["listings"], """
select distinct segmento, path as link from listings where source = 'b'
except
select segmento, path from listings where source = 'a'"""))
def p_new_links(spark, d):
    pages = fxt.index_pages(V.listings(spark, d))
    links = pg.extract_links(pages, keep=["segmento", "source"])
    fresh, _ = pg.new_links(links.where(F.col("source") == "b"), links.where(F.col("source") == "a"),
                            ["segmento", "link"])
    return fresh


@query("p_seen_links", with_views(["listings"], """
select distinct segmento, path as link from listings where source in ('a', 'b')"""))
def p_seen_links(spark, d):
    """P2, the other half: the links seen after the new ones are taken in."""
    links = pg.extract_links(fxt.index_pages(V.listings(spark, d)), keep=["segmento", "source"])
    _, seen = pg.new_links(links.where(F.col("source") == "b"), links.where(F.col("source") == "a"),
                           ["segmento", "link"])
    return seen


@query("p_links_across_runs", with_views(["listings"], """
select segmento, link, min(run) as run from (
  select segmento, path as link, 1 as run from listings where source = 'b'
  union all select segmento, path, 2 from listings) group by segmento, link"""))
def p_links_across_runs(spark, d):
    """P2 with the stored seen-set: two runs over overlapping pages give each link once, in the run that
    met it first."""
    links = pg.extract_links(fxt.index_pages(V.listings(spark, d)), keep=["segmento", "source"])
    root, out = scratch_path(spark, "seen"), None
    for run, page in ((1, links.where(F.col("source") == "b")), (2, links)):
        new = pg.take_new(spark, root, page, ["segmento", "link"], str(run)).select("segmento", "link", F.lit(run).alias("run"))
        out = new if out is None else out.unionByName(new)
    return out


@query("p_parse_path", with_views(["silver"], """
select path, marca, modelo, condicion, provincia, split_part(path, '?cod=', 2) as cod from silver"""))
def p_parse_path(spark, d):
    return pg.parse_listing_path(V.silver(spark, d).select("path"))


@query("p_hidden_inputs", with_views(["silver"], """
select path, precio_ars, cast(anio as bigint) as anio, km from silver
where precio_ars is not null and anio is not null and km is not null"""))
def p_hidden_inputs(spark, d):
    return pg.hidden_inputs(fxt.detail_pages(V.silver(spark, d))).drop("html", "fetched_at")


@query("p_assemble", with_views(["silver"], f"""
select split_part(path, '?cod=', 2) as cod, marca, modelo, condicion, provincia, precio_ars,
       cast(anio as bigint) as anio, km, segmento, '{mk.BASE_URL}' || path as url, scraped_day as scraped_at
from silver where precio_ars is not null and anio is not null and km is not null"""))
def p_assemble(spark, d):
    s = V.silver(spark, d)
    links = pg.parse_listing_path(
        pg.extract_links(fxt.index_pages(s), keep=["segmento"]).withColumnRenamed("link", "path"))
    details = pg.hidden_inputs(fxt.detail_pages(s)).drop("html")
    rec = pg.assemble(links, details, F.col("fetched_at"), mk.BASE_URL)
    return rec.select("cod", "marca", "modelo", "condicion", "provincia", "precio_ars", "anio", "km",
                      "segmento", "url", "scraped_at")


@query("p_cards", with_views(["silver"], f"""
select 'b-' || cod as cod, marca, modelo, 'Usado' as condicion, provincia, precio_ars, anio,
       coalesce(km, 0) as km, '{mk.CARD_BASE_URL}/ar/venta/' || cod || '/' as url, 0 as segmento, 'b' as source
from silver where precio_ars >= 1000000"""))
def p_cards(spark, d):
    cards = pg.split_cards(fxt.card_pages(V.silver(spark, d)))
    return pg.parse_cards(cards, mk.CARD_BASE_URL)


@query("p_first_seen", with_views(["listings"], """
select cod, marca, modelo, precio_ars from listings l
where marca = (select min(marca) from listings l2 where l2.cod = l.cod)"""))
def p_first_seen(spark, d):
    cards = V.listings(spark, d).select("cod", "marca", "modelo", "precio_ars", F.col("marca").alias("brand_ord"))
    return pg.first_seen(cards).drop("brand_ord")


@query("s_latest_model", f"""
select max(model_date) as model_date, arg_max(key, model_date) as key
from (select key, try_cast(nullif(regexp_extract(key, '(\\d{{4}}-\\d{{2}}-\\d{{2}})', 1), '') as date) as model_date
      from ({_MODEL_KEYS_SQL}))
where model_date is not null""")
def s_latest_model(spark, d):
    """The newest dated model of a registry (keys from the orders fixture)."""
    return latest_model_key(model_registry(spark, model_keys(spark, d)))
