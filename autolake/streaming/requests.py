"""Estimate requests as a stream (M13-M16): request files in, scored rows out.

Every row is scored by itself with the registry's latest model (S8), by the function that scores
a table of requests, so the stream keeps no state; each trigger takes the files that are new.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from autolake.operators import model
from autolake.sources import registry


def score_stream(spark: SparkSession, requests: str, out: str, checkpoint: str, models: str, run_year: int,
                 rate: float | None = None, max_files_per_batch: int | None = None) -> None:
    """One ``availableNow`` trigger over the JSON-lines files under ``requests``: all new ones are
    scored and appended to the table ``out``, then the stream stops. ``rate`` is the latest rate, if any."""
    latest = registry.load_latest_model(spark, models)
    reader = spark.readStream.schema(model.REQUEST)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    scored = model.score_requests(latest, reader.json(requests), run_year, F.lit(rate))
    q = (scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
