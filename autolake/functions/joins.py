"""Join, dedup and ranking helpers that stay safe when one key holds a large share of rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from autolake.session import work_dir

# Derived dimensions of at most so many bytes are broadcast; larger ones are joined by
# shuffle. Summed over the materialised table, never guessed.
BROADCAST_MAX_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """Size of a row in memory, nearly: 16 bytes, 8 per column, and the bytes of text."""
    size = F.lit(16 + 8 * len(df.columns))
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
    return size.cast("long")


def stored_size(dim: DataFrame) -> tuple[DataFrame, int]:
    """A derived table written once (a reliable ``checkpoint`` to the shared work folder: it survives
    executor loss and cuts its lineage) and its bytes, summed in the same job."""
    work_dir(dim.sparkSession)
    obs = Observation()
    dim = dim.observe(obs, F.sum(row_bytes(dim)).alias("bytes")).checkpoint(eager=True)
    return dim, obs.get["bytes"] or 0


def bounded_broadcast(dim: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Materialise a derived dimension once (``stored_size``) and broadcast it only if it is small.

    Beyond the bound the caller's join is a shuffle join: another plan, the same rows.
    """
    dim, size = stored_size(dim)
    return F.broadcast(dim) if size <= max_bytes else dim


def small_broadcast(stored: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """The same for a table that is stored already: its bytes are summed, nothing is written."""
    size = stored.agg(F.sum(row_bytes(stored))).first()[0] or 0
    return F.broadcast(stored) if size <= max_bytes else stored


def keep_first(df: DataFrame, keys: Sequence[str], order: Column | str,
               drop: Sequence[str] = (), spread: bool = False, partitions: int | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order`` value (input order).

    Implemented as a ``min_by`` aggregate rather than ``row_number`` over a
    window: the aggregate combines map-side, so a key that holds a third of all
    rows is reduced to one row per input partition before the shuffle, instead
    of landing whole in one task.

    Combining map-side sorts whole rows, an input split at a time, and spills where a split
    is larger than a task's memory. With ``spread`` only the hot keys' rows (``key_counts``:
    one more pass, over the keys) are combined map-side; the others are shuffled as
    they are, to so many ``partitions`` that a task sorts few rows. Which keys count as hot changes
    the plan and not the rows.
    """
    order_col = F.col(order) if isinstance(order, str) else order
    payload = [c for c in df.columns if c not in keys and c not in drop]
    first = lambda rows: (rows.groupBy(*keys)
                              .agg(F.min_by(F.struct(*payload), order_col).alias("_first"))
                              .select(*keys, "_first.*"))
    return _spread(df, keys, first, partitions) if spread else first(df)


def _spread(df: DataFrame, keys: Sequence[str], reduced: Callable[[DataFrame], DataFrame], partitions: int | None) -> DataFrame:
    """``reduced`` (an aggregate by ``keys``) of the rows, shuffled before it; hot keys' rows are combined map-side."""
    rows, hot = key_counts(df, keys)
    n = partitions or partitions_for(df.sparkSession, rows)
    if not hot:
        return reduced(df.repartition(n, *keys))
    is_hot = F.xxhash64(*keys).isin(hot)
    return reduced(df.where(~is_hot).repartition(n, *keys)).unionByName(reduced(df.where(is_hot)))


ROWS_PER_TASK = 250_000     # rows that a task sorts, where their number is known
HOT_SHARE = 1000            # a key with more than one of so many rows is hot


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions of at most about ``ROWS_PER_TASK`` rows, the session's number of them at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def key_counts(df: DataFrame, keys: Sequence[str]) -> tuple[int, list[int]]:
    """Rows, and the hashes of the keys that hold more than one in ``HOT_SHARE`` of them (and a task's rows
    in ``HOT_SHARE``), from one sketch: at most ``HOT_SHARE`` numbers come back."""
    found = df.agg(F.count(F.lit(1)).alias("n"),
                   F.expr(f"approx_top_k(xxhash64({', '.join(f'`{k}`' for k in keys)}), {HOT_SHARE}, {HOT_SHARE * 10})").alias("top")).first()
    least = max(found["n"], ROWS_PER_TASK) // HOT_SHARE
    return found["n"], [t["item"] for t in found["top"] or [] if t["count"] > least]


def dense_index(values: DataFrame, col: str, out: str = "code",
                partitions: int | None = None) -> DataFrame:
    """Map each distinct value of ``col`` to its 0-based rank in ascending order."""
    ranked = dense_index_columns(values, [col], partitions)
    return ranked.select(F.col("value").alias(col), F.col("code").alias(out))


def dense_index_columns(values: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``column, value, code``: per column, each distinct non-null value and its
    0-based rank in ascending order — all columns in one distributed pass.

    The (column, value) pairs are range-partitioned and numbered inside each
    partition; a value's rank is its number minus the first number of its column in
    that partition, plus the count of the column's values in earlier partitions. The
    offsets table has one row per (partition, column): a proven bound, so it is
    broadcast. No single-partition window, nothing collected on the driver.
    """
    spark = values.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = None
    for c in cols:
        # one column keeps its type (numeric order for numbers); several share a
        # string column, so they rank by their text
        v = F.col(c) if len(cols) == 1 else F.col(c).cast("string")
        p = values.select(F.lit(c).alias("column"), v.alias("value"))
        pairs = p if pairs is None else pairs.unionByName(p)
    distinct = pairs.where(F.col("value").isNotNull()).distinct()
    ranged = (distinct.repartitionByRange(n, "column", "value").sortWithinPartitions("column", "value")
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    work_dir(spark)
    # ids are fixed once written: a recomputed partition could otherwise renumber
    ranged = ranged.checkpoint(eager=True)
    sizes = ranged.groupBy("column", "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy("column").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (ranged.join(F.broadcast(offsets), ["column", "_pid"])
                  .select("column", "value", (F.col("_off") + F.col("_mid") - F.col("_m0")).alias("code")))


def first_and_last(df: DataFrame, keys: Sequence[str], order: str, drop: Sequence[str] = (), spread: bool = False,
                   partitions: int | None = None) -> DataFrame:
    """Per key the first and the last row in ``order`` as structs ``first`` and ``last``
    (``last`` is null when the key has one order value).

    One aggregate that combines map-side: a key holding a third of all rows is one row
    per task before the shuffle. ``spread`` and ``partitions`` as in ``keep_first``."""
    payload = [c for c in df.columns if c not in keys and c not in drop and c != order]
    both = lambda rows: (rows.groupBy(*keys)
                             .agg(F.min_by(F.struct(*payload), F.col(order)).alias("first"),
                                  F.max_by(F.struct(*payload), F.col(order)).alias("_last"),
                                  (F.min(order) < F.max(order)).alias("_two"))
                             .select(*keys, "first", F.when(F.col("_two"), F.col("_last")).alias("last")))
    return _spread(df, keys, both, partitions) if spread else both(df)


def with_position(ordered: DataFrame, out: str = "position") -> DataFrame:
    """``ordered`` (a frame ending in a global ``orderBy``) with each row's place from 1.

    The sort range-partitions the rows; they are stored, numbered inside each partition and
    shifted by the rows of earlier partitions (a table with one row per partition)."""
    work_dir(ordered.sparkSession)
    rows = (ordered.withColumn("_pid", F.spark_partition_id())
                   .withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True))
    sizes = rows.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (rows.join(F.broadcast(offsets), "_pid")
                .withColumn(out, F.col("_off") + F.col("_mid") - F.col("_m0") + 1)
                .drop("_pid", "_mid", "_n", "_m0", "_off"))
