"""Model preparation, training, evaluation, scoring and request features."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.functions.columns import (OPPORTUNITY_THRESHOLD, REQUEST_YEAR_MAX, YEAR_MIN,
                                        clip_lower, hash_split)
from autolake.functions.joins import bounded_broadcast, dense_index_columns
from autolake.functions.stats import group_median
from autolake.operators import encode, trees
from autolake.schemas import CATEGORICAL, TARGET
from autolake.session import scratch_path

NUMERIC_FEATURES = ["anio", "antiguedad", "km", "km_valido", "km_por_anio", "dolar_blue_venta"]
FEATURES = [f"{c}_te" for c in CATEGORICAL] + NUMERIC_FEATURES
# Boosted-tree settings of the reference (300 trees, learning rate 0.05,
# at least 5 rows per leaf, 80 % of rows and of features per tree, seed 42); Spark's
# depth-wise trees use depth 4 for the reference's 15 leaves.
GBT_TREES = 300
GBT_STEP = 0.05
GBT_DEPTH = 4
MIN_ROWS_PER_LEAF = 5
ROW_SAMPLE = 0.8
FEATURE_SAMPLE = "0.8"
SEED = 42
# What a missing number reads as in a tree.
MISSING = -1.0
MAX_BINS = 256
# Fixed value: warning text of an estimate for a car of the run year.
AGE_ZERO_WARNING = "Auto del año actual — estimación menos confiable"


# ---------------------------------------------------------------- scoring formulas

def estimate_columns(df: DataFrame, prediction: str = "prediction", price: str = TARGET) -> DataFrame:
    """M9 + M10: ``precio_estimado`` = prediction rounded half-even to an integer;
    ``oportunidad_score`` = (estimate - price) / estimate rounded half-even to 4 digits.
    An estimate of 0 gives a null score (the reference would produce inf/NaN)."""
    est = F.bround(F.col(prediction), 0)
    est_int = est.cast("bigint")
    # "+ 0.0" turns a signed zero into +0.0
    score = F.bround((est_int - F.col(price)) / F.nullif(est, F.lit(0.0)).cast("double"), 4) + F.lit(0.0)
    return df.withColumn("precio_estimado", est_int).withColumn("oportunidad_score", score)


def score_by_group_median(df: DataFrame, keys: Sequence[str], price: str = TARGET) -> DataFrame:
    """Stand-in estimator: the median price of rows sharing ``keys`` (exact, no task
    holds a whole group), joined back with a checked broadcast (shuffle join beyond
    the bound)."""
    return score_by_fitted_median(df, df, keys, price)


def score_by_fitted_median(df: DataFrame, fit_on: DataFrame, keys: Sequence[str], price: str = TARGET) -> DataFrame:
    """The same estimator fitted on ``fit_on`` alone; rows of groups that it lacks drop out."""
    return apply_median(df, bounded_broadcast(group_median(fit_on, keys, price, "_med")), keys, price)


def apply_median(df: DataFrame, medians: DataFrame, keys: Sequence[str], price: str = TARGET) -> DataFrame:
    """Estimates from a fitted table (keys, _med); rows of groups that it lacks drop out."""
    return estimate_columns(df.join(medians, list(keys), "inner"), "_med", price).drop("_med")


# ---------------------------------------------------------------- preparation / split

def prepare(gold: DataFrame) -> DataFrame:
    """M1: the nine features plus target; a null ``km_valido`` becomes false."""
    return gold.withColumn("km_valido", F.coalesce(F.col("km_valido"), F.lit(False)))


def with_split(df: DataFrame, key: str = "cod") -> DataFrame:
    """M2: seeded ~80/20 split from a hash of the key (same rows on any layout)."""
    return df.withColumn("split", hash_split(F.col(key)))


def split_counts(df: DataFrame, key: str = "cod") -> DataFrame:
    return with_split(df, key).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- boosted trees

class PriceModel(NamedTuple):
    """A fitted model as two tables: the trees' nodes (``operators.trees``) and the categoricals'
    statistics (``operators.encode``). ``fitted`` is the folder of Spark ML's own copy, if it is there."""
    nodes: DataFrame
    statistics: DataFrame
    fitted: str | None = None

    def save(self, path: str) -> None:
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.statistics.write.mode("overwrite").parquet(f"{path}/statistics")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PriceModel:
        return cls(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/statistics"))

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` of ``feature_rows`` with the model's ``prediction``."""
        return rows.withColumn("prediction", trees.estimate(self.nodes))


def training_parameters(train_rows: int, test_rows: int, day, max_iter: int = GBT_TREES) -> dict:
    """The nine recorded parameters of a training run (a tree of depth d has at most 2^d leaves)."""
    return {"n_estimators": max_iter, "num_leaves": 2 ** GBT_DEPTH, "learning_rate": GBT_STEP, "min_child_samples": MIN_ROWS_PER_LEAF,
            "subsample": ROW_SAMPLE, "colsample_bytree": FEATURE_SAMPLE, "train_size": train_rows, "test_size": test_rows, "gold_date": day}


def feature_rows(gold: DataFrame, statistics: DataFrame, fold: Column | None = None, keep: Sequence[str] = ("cod", TARGET)) -> DataFrame:
    """The model's nine features as numbers, and ``keep``: categoricals by their target statistics
    (``fold``: what training rows leave out), a missing number as MISSING, which a split separates
    from every real value (the reference's library routes missing values at each split natively)."""
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(c) for c in NUMERIC_FEATURES]
    kept = [F.col(c).alias(f"_keep_{c}") for c in keep]
    rows = encode.encode(prepare(gold).select(*CATEGORICAL, *NUMERIC_FEATURES, *kept, *([] if fold is None else [fold.alias("_own_fold")])),
                         statistics, None if fold is None else F.col("_own_fold"))
    return rows.select(*[f"{c}_te" for c in CATEGORICAL], *numbers, *[F.col(f"_keep_{c}").alias(c if c not in FEATURES else f"_keep_{c}") for c in keep])


def _fit(gold: DataFrame, regressor, average: bool) -> PriceModel:
    """Fit on the training split; the statistics and the nodes are stored, so they are made once."""
    from pyspark.ml.feature import VectorAssembler

    spark = gold.sparkSession
    train = with_split(gold).where(F.col("split") == "train").drop("split")
    stats_path, fitted, nodes_path = (scratch_path(spark, n) for n in ("model-statistics", "model-fitted", "model-nodes"))
    encode.statistics(train).write.parquet(stats_path)
    statistics = spark.read.parquet(stats_path)
    rows = feature_rows(train, statistics, encode.fold(F.col("cod")))
    data = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="error").transform(
        rows.withColumn("label", F.col(TARGET).cast("double")))
    regressor.fit(data.select("features", "label")).write().save(fitted)
    trees.node_table(spark, fitted, FEATURES, average).write.parquet(nodes_path)
    return PriceModel(spark.read.parquet(nodes_path), statistics, fitted)


def train_gbt(gold: DataFrame, max_iter: int = GBT_TREES, seed: int = SEED) -> PriceModel:
    """M3: gradient-boosted trees on the training split.

    Settings follow the reference's intent: shallow trees, learning rate 0.05, at least 5 rows
    per leaf, 80 % row and feature sampling. The rows' errors are checkpointed every 10 trees
    to the shared folder: a lost executor recomputes from the last checkpoint, not from the
    first iteration. Node ids are not cached: at this depth a row's walk from the root is a few
    comparisons, a cache an RDD stored and joined per level of every tree; the trees are the same."""
    from pyspark.ml.regression import GBTRegressor

    return _fit(gold, GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=GBT_DEPTH,
                                   stepSize=GBT_STEP, minInstancesPerNode=MIN_ROWS_PER_LEAF, subsamplingRate=ROW_SAMPLE,
                                   featureSubsetStrategy=FEATURE_SAMPLE, seed=seed, maxBins=MAX_BINS,
                                   cacheNodeIds=False, checkpointInterval=10), average=False)


def train_forest(gold: DataFrame, num_trees: int = 100, seed: int = SEED) -> PriceModel:
    """Second model for M8: a random forest on the same features and training split."""
    from pyspark.ml.regression import RandomForestRegressor

    return _fit(gold, RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=num_trees, maxDepth=8,
                                            minInstancesPerNode=MIN_ROWS_PER_LEAF, subsamplingRate=ROW_SAMPLE, seed=seed,
                                            maxBins=MAX_BINS, cacheNodeIds=True, checkpointInterval=10), average=True)


def model_scores(model: PriceModel, gold: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """M9 + M10 with a trained model, as one expression per row: cod, price, raw prediction,
    estimate, score. ``carry`` columns pass through with their original (unprepared) values."""
    rows = feature_rows(gold, model.statistics, keep=("cod", TARGET, *carry))
    out = estimate_columns(model.transform(rows), "prediction")
    return out.select("cod", TARGET, "prediction", "precio_estimado", "oportunidad_score",
                      *[F.col(f"_keep_{c}").alias(c) if c in FEATURES else F.col(c) for c in carry])


# ---------------------------------------------------------------- evaluation

def regression_metrics(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """M4: MAE, RMSE, R2 and MAPE (%) in one aggregate pass (per ``by`` group).

    The absolute-error sum is exact (errors to six digits); float sums are rounded so the
    figures do not depend on the summation order."""
    e = (F.col(pred) - F.col(truth))
    y = F.col(truth).cast("double")
    agg = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(e).cast("decimal(28,6)")).alias("_sae"),
        F.sum(e.cast("double") * e.cast("double")).alias("_sse"),
        F.var_pop(y).alias("_var"),
        # a zero truth or a zero variance gives a null figure (ANSI division would fail)
        F.avg(F.abs(F.try_divide(e.cast("double"), y))).alias("_ape"),
    )
    return agg.select(
        *by, "n",
        F.round(F.col("_sae").cast("double") / F.col("n"), 2).alias("mae"),
        F.round(F.sqrt(F.col("_sse") / F.col("n")), 2).alias("rmse"),
        F.round(F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("n") * F.col("_var")), 6).alias("r2"),
        F.round(F.col("_ape") * 100, 4).alias("mape"),
    )


def overfit_gap(metrics: DataFrame, split_col: str = "split") -> DataFrame:
    """M5: test MAE - train MAE; flagged when the gap exceeds half the train MAE."""
    m = metrics.groupBy().agg(
        F.max(F.when(F.col(split_col) == "train", F.col("mae"))).alias("train_mae"),
        F.max(F.when(F.col(split_col) == "test", F.col("mae"))).alias("test_mae"))
    return (m.withColumn("gap_mae", F.round(F.col("test_mae") - F.col("train_mae"), 2))
             .withColumn("overfit", F.col("gap_mae") > F.col("train_mae") * 0.5))


def compare_models(metrics_a: DataFrame, metrics_b: DataFrame, name_a: str = "a",
                   name_b: str = "b") -> DataFrame:
    """M8: winner per metric (higher R2, lower others; a tie goes to ``b`` as in the
    reference) and an OVERALL row: ``a`` wins overall with at least 3 of 4."""
    def long(m: DataFrame, tag: str) -> DataFrame:
        return m.select(F.expr(
            f"stack(4, 'MAE', mae, 'RMSE', rmse, 'R2', r2, 'MAPE', mape) as (metric, {tag})"))

    j = long(metrics_a, "value_a").join(long(metrics_b, "value_b"), "metric")
    a_wins = F.when(F.col("metric") == "R2", F.col("value_a") > F.col("value_b")) \
              .otherwise(F.col("value_a") < F.col("value_b"))
    per = j.withColumn("winner", F.when(a_wins, F.lit(name_a)).otherwise(F.lit(name_b)))
    overall = per.groupBy().agg(F.count_if(F.col("winner") == name_a).cast("double").alias("value_a"),
                                F.count_if(F.col("winner") == name_b).cast("double").alias("value_b"))
    overall = overall.select(F.lit("OVERALL").alias("metric"), "value_a", "value_b",
                             F.when(F.col("value_a") >= 3, F.lit(name_a)).otherwise(F.lit(name_b)).alias("winner"))
    return per.unionByName(overall)


def label_encode(df: DataFrame, cols: Sequence[str] = CATEGORICAL) -> DataFrame:
    """M6: the rows with ``<col>_code`` per categorical: 0..k-1 in ascending code-point order.

    A missing value is a class of its own, the text 'None'. All columns are ranked in one
    distributed pass; each column's mapping is joined back (broadcast only if small)."""
    text = df.select([F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c) for c in cols])
    codes = bounded_broadcast(dense_index_columns(text, cols))
    for c in cols:
        own = codes.where(F.col("column") == c).select(F.col("value").alias(f"_{c}"), F.col("code").alias(f"{c}_code"))
        df = df.join(own, F.coalesce(F.col(c).cast("string"), F.lit("None")) == F.col(f"_{c}"), "left").drop(f"_{c}")
    return df


def standardize(df: DataFrame, cols: Sequence[str], key: str = "cod", digits: int = 6) -> DataFrame:
    """M7: population-std scaling (a zero std divides by 1); the one-row statistics
    table is cross-joined (broadcast of one row). Returns scaled columns and the
    inverse transform of each, which must give back the input."""
    stats = df.agg(*[F.avg(c).alias(f"{c}__mu") for c in cols],
                   *[F.stddev_pop(c).alias(f"{c}__sd") for c in cols])
    j = df.select(key, *cols).crossJoin(F.broadcast(stats))
    out = [F.col(key)]
    for c in cols:
        sd = F.when(F.col(f"{c}__sd") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__sd"))
        z = (F.col(c) - F.col(f"{c}__mu")) / sd
        out += [F.round(z, digits).alias(f"{c}_z"),
                F.round(z * sd + F.col(f"{c}__mu"), 4).alias(f"{c}_inv")]
    return j.select(*out)


# ---------------------------------------------------------------- scored rows

def count_opportunities(scored: DataFrame, threshold: float = OPPORTUNITY_THRESHOLD) -> DataFrame:
    """Rows with score strictly above the threshold, and all rows."""
    return scored.agg(F.count_if(F.col("oportunidad_score") > threshold).alias("oportunidades"),
                      F.count(F.lit(1)).alias("total"))


def top_scores(scored: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` highest scores (null scores never rank); ties by ``cod``."""
    return (scored.where(F.col("oportunidad_score").isNotNull())
                  .orderBy(F.desc("oportunidad_score"), "cod").limit(n)
                  .select("cod", "marca", "modelo", "anio", "precio_ars", "precio_estimado",
                          "oportunidad_score"))


# ---------------------------------------------------------------- estimate requests

REQUEST = "req_id long, marca string, modelo string, provincia string, anio int, km long"


def validate_requests(req: DataFrame, year_max: int = REQUEST_YEAR_MAX) -> DataFrame:
    """A request needs every field, a year in [1990, year_max] and km >= 0.
    ``valid`` flag plus the reasons (null when valid)."""
    checks = [(F.col(c).isNull(), f"{c} missing") for c in ["marca", "modelo", "provincia", "anio", "km"]]
    checks += [((F.col("anio") < YEAR_MIN) | (F.col("anio") > year_max), "anio out of range"),
               (F.col("km") < 0, "km negative")]
    reasons = F.concat_ws("; ", *[F.when(cond, F.lit(msg)) for cond, msg in checks])
    return (req.withColumn("reasons", F.nullif(reasons, F.lit("")))
               .withColumn("valid", F.col("reasons").isNull()))


def request_features(req: DataFrame, run_year: int, rate: Column) -> DataFrame:
    """M13 + M15: request rows get the model features without any imputation (unlike
    gold: a km of 0/1 stays as sent), the latest rate or null, and a warning when
    the car is from the run year."""
    age = (F.lit(run_year) - F.col("anio")).cast("int")
    return (req.withColumn("antiguedad", age)
               .withColumn("km_valido", F.col("km") > 1)
               .withColumn("km_por_anio", F.col("km") / clip_lower(F.col("antiguedad"), 1))
               .withColumn("dolar_blue_venta", rate.cast("double"))
               .withColumn("advertencia", F.when(F.col("antiguedad") == 0, F.lit(AGE_ZERO_WARNING))))


def score_requests(model: PriceModel, req: DataFrame, run_year: int, rate: Column, carry: Sequence[str] = ()) -> DataFrame:
    """M13-M16 row by row, for a table or a stream of requests: validate, build the features (no
    imputation), score the valid ones and truncate the estimate; invalid requests keep their
    reasons and have no estimate."""
    keep = ("req_id", "valid", "reasons", "advertencia", *carry)
    feats = request_features(validate_requests(req), run_year, rate)
    scored = model.transform(feature_rows(feats, model.statistics, keep=keep))
    estimate = F.when(F.col("valid"), truncated_estimate(F.col("prediction")))
    return scored.select("req_id", "valid", "reasons", estimate.alias("precio_estimado_ars"),
                         F.when(F.col("valid"), F.col("advertencia")).alias("advertencia"), *carry)


def truncated_estimate(prediction: Column) -> Column:
    """Request estimates truncate (batch scores round)."""
    return prediction.cast("bigint")


def model_date(key: Column) -> Column:
    """The ISO date inside a model key, or null."""
    return F.try_to_date(F.nullif(F.regexp_extract(key, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")))
