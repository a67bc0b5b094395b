"""Session construction and the shared work folder.

On a cluster the work folder is whatever ``spark.checkpoint.dir`` names (a shared
filesystem). Only when nothing is configured (tests, laptops) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "autolake", driver_memory: str | None = None) -> SparkSession:
    """A session with the library's settings. Master, shuffle partitions and driver memory are
    left to spark-submit or the cluster's defaults unless given."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in (("spark.master", master), ("spark.sql.shuffle.partitions", shuffle_partitions),
                       ("spark.driver.memory", driver_memory)):
        if value is not None:
            builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). If neither is set, a
    single-machine session (``local[...]``) gets a fresh scratch folder; on a cluster, whose
    machines do not share one, it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # the context appends a random sub-folder; keep writing next to it
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").partition("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="autolake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
