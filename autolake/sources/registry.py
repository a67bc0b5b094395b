"""Model registry and run records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.operators.model import PriceModel, model_date


def save_model(model: PriceModel, root: str, day) -> str:
    """A fitted model's tables under ``root/fecha=<day>`` (re-saving a day overwrites them),
    then registered as one row ``key, model_date`` in ``root/_registry``."""
    path = f"{root}/fecha={day}"
    model.save(path)
    spark = model.nodes.sparkSession
    (spark.createDataFrame([(path,)], "key string")
          .select("key", model_date(F.col("key")).alias("model_date"))
          .write.mode("append").parquet(f"{root}/_registry"))
    return path


def model_registry(spark: SparkSession, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """Registry rows ``key, model_date`` from model folder names (M17 parse)."""
    return keys.select(F.col(key_col).alias("key"), model_date(F.col(key_col)).alias("model_date"))


def latest_model_key(registry: DataFrame) -> DataFrame:
    """The key of the newest dated model (undated keys never win)."""
    return (registry.where(F.col("model_date").isNotNull())
                    .agg(F.max("model_date").alias("model_date"),
                         F.max_by("key", "model_date").alias("key")))


def load_latest_model(spark: SparkSession, root: str) -> PriceModel:
    """Load the newest dated model of the registry table; none is an error."""
    latest = latest_model_key(spark.read.parquet(f"{root}/_registry")).first()
    if latest is None or latest["key"] is None:
        raise FileNotFoundError(f"no model under {root}")
    return PriceModel.load(spark, latest["key"])


# A run's parameters and metrics are maps, so runs with other names need no other schema.
RUNS = "fecha date, recorded_at string, params map<string,string>, metrics map<string,double>"


def record_run(spark: SparkSession, root: str, params: dict, train: dict, test: dict, day) -> DataFrame:
    """Append one row (params, train_* and test_* metrics, overfit gap) to the ``runs`` table."""
    metrics = {f"{split}_{k}": float(v) for split, found in (("train", train), ("test", test)) for k, v in found.items() if v is not None}
    if train.get("mae") is not None and test.get("mae") is not None:
        metrics["overfitting_gap_mae"] = float(test["mae"] - train["mae"])
    row = (dt.date.fromisoformat(str(day)), dt.datetime.now(dt.timezone.utc).isoformat(), {k: str(v) for k, v in params.items()}, metrics)
    df = spark.createDataFrame([row], RUNS)
    df.write.mode("append").parquet(root)
    return df


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(root)


def run_values(runs: DataFrame) -> DataFrame:
    """Long form of the run table: fecha, kind (param or metric), name, value as text."""
    side = lambda kind, col, value: runs.select(
        "fecha", F.lit(kind).alias("kind"), F.explode(col).alias("name", "value")).withColumn("value", value)
    return side("param", "params", F.col("value")).unionAll(side("metric", "metrics", F.col("value").cast("string")))
