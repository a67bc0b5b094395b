"""Fetched web pages as files: the text of every file, where it lies and when it was fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, root: str, pattern: str = "*.html") -> DataFrame:
    """(file, fetched_at, html, <partition columns>) of the files under ``root`` that match ``pattern``.

    ``fetched_at`` is the file's modification time in UTC as ISO text. Bytes that are no UTF-8
    become U+FFFD. Folders named column=value under ``root`` give columns, which prune files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("basePath", root).load(root)
    own = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    utc = F.date_format(F.to_utc_timestamp("modificationTime", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), utc.alias("fetched_at"),
                        F.make_valid_utf8(F.col("content").cast("string")).alias("html"), *own)
