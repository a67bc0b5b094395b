"""Exact group statistics that no single task has to hold for a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autolake.session import work_dir


def group_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median",
                 partitions: int | None = None) -> DataFrame:
    """Exact median of ``value`` per ``keys`` group (nulls ignored), interpolated
    between the two middle values like ``median`` / ``percentile(v, 0.5)``.

    Spark's ``median`` merges one value->count map per group in one task, so a group
    holding a third of all rows with mostly distinct values would sit in one task.
    Here no step holds a whole group, whatever the size of the data:
      1. count each (group, value) pair (combined map-side);
      2. range-partition the pairs by (group, value): a large group spans many tasks;
      3. running counts inside each (partition, group) chunk, plus the chunk offsets
         of each group (a table of at most partitions x groups-in-partition rows);
      4. keep the one or two pairs whose rank interval holds a middle rank.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = list(keys)
    work_dir(spark)
    pairs = (df.where(F.col(value).isNotNull())
               .groupBy(*keys, F.col(value).cast("double").alias("_v"))
               .agg(F.count(F.lit(1)).alias("_c")))
    ranged = pairs.repartitionByRange(n, *keys, "_v").withColumn("_pid", F.spark_partition_id())
    # written once: both branches below must see the same range bounds (a recomputed
    # sample could draw other bounds), and the write cuts the lineage
    ranged = ranged.checkpoint(eager=True)
    in_chunk = Window.partitionBy("_pid", *keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_cum", F.sum("_c").over(in_chunk))
    chunks = ranged.groupBy("_pid", *keys).agg(F.sum("_c").alias("_chunk"))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (chunks.withColumn("_off", F.coalesce(F.sum("_chunk").over(before), F.lit(0)))
                     .withColumn("_n", F.sum("_chunk").over(Window.partitionBy(*keys)))
                     .drop("_chunk"))
    # null-safe on the keys: a null key is a group of its own, as in groupBy
    cond = [local["_pid"] == offsets["_pid"]] + [local[k].eqNullSafe(offsets[k]) for k in keys]
    ranks = (local.join(offsets, cond).select(local["*"], offsets["_off"], offsets["_n"])
                  .withColumn("_hi", F.col("_off") + F.col("_cum"))
                  .withColumn("_lo", F.col("_hi") - F.col("_c") + 1))
    # 1-based middle ranks: equal for an odd count, adjacent for an even one
    k1 = F.floor((F.col("_n") + 1) / 2)
    k2 = F.floor(F.col("_n") / 2) + 1
    holds = lambda k: (F.col("_lo") <= k) & (k <= F.col("_hi"))
    mids = (ranks.where(holds(k1) | holds(k2))
                 .groupBy(*keys)
                 .agg(F.max(F.when(holds(k1), F.col("_v"))).alias("_lower"),
                      F.max(F.when(holds(k2), F.col("_v"))).alias("_upper")))
    return mids.select(*keys, (F.col("_lower") + (F.col("_upper") - F.col("_lower")) * 0.5).alias(out))
