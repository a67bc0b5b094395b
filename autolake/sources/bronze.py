"""Bronze layer: land raw records as day-keyed JSON and read them back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def land_records(records: DataFrame, root: str, day_col: str, spread_by: Sequence[str] | None = None) -> None:
    """One JSON line per record under ``root/<day_col>=<day>/``; re-landing a day
    replaces only that day (dynamic partition overwrite).

    Records are range-partitioned by (day, spread key) before the write, so a large
    day spreads over many tasks and a small one stays in one file. The default spread
    key is a hash of the whole record: deterministic (a retried task writes the same
    rows) and different for repeated keys, so even a key holding a third of the day's
    records is cut over many tasks. Files are gzipped: text takes several times the room."""
    spread = [F.col(c) for c in spread_by] if spread_by else [F.xxhash64(*[F.col(c) for c in records.columns])]
    keys = [F.col(day_col), *spread]
    (records.repartitionByRange(*keys)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(day_col).json(root, compression="gzip"))


def land_envelopes(envelopes: DataFrame, root: str, day_col: str) -> None:
    """S1 for envelope-shaped feeds (one document per source and day, records in
    ``data``): every envelope is a file of its own, one document per file. Envelopes are
    not shuffled: a day's envelopes are written by the tasks that hold them, gzipped."""
    (envelopes.write.mode("overwrite").option("maxRecordsPerFile", 1).option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_col).json(root, compression="gzip"))


def read_records(spark: SparkSession, root: str, schema: T.StructType, day_col: str,
                 day_type: str = "date") -> DataFrame:
    """S2 for record files: explicit schema (no inference pass); the day comes from
    the folder name and is pruned by any filter on it."""
    full = T.StructType(list(schema.fields) + [T.StructField(day_col, T.DateType() if day_type == "date"
                                                             else T.StringType())])
    return spark.read.schema(full).json(root)


def as_text(schema: T.StructType) -> T.StructType:
    """The same fields, all read as text: a value of another type than expected is kept to be looked at."""
    def text(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(text(kind.elementType))
        return as_text(kind) if isinstance(kind, T.StructType) else kind if isinstance(kind, T.MapType) else T.StringType()
    return T.StructType([T.StructField(f.name, text(f.dataType)) for f in schema.fields])


def read_records_checked(spark: SparkSession, root: str, schema: T.StructType, day_col: str) -> DataFrame:
    """S2 without trust in the records: fields as text, the text of a line that is no JSON in
    ``_corrupt_record``, and the file. The day comes from the folder name."""
    fields = [*as_text(schema).fields, T.StructField("_corrupt_record", T.StringType()), T.StructField(day_col, T.DateType())]
    return (spark.read.schema(T.StructType(fields)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(root)
            .withColumn("_file", F.col("_metadata.file_path")))


def read_envelopes_checked(spark: SparkSession, path: str, schema: T.StructType, scalars: Sequence[str], data: str = "data") -> DataFrame:
    """S2 + S3 without trust: the records of every envelope as text with the envelope's scalars,
    position and file; a file that is no JSON document is one row with its text in ``_corrupt_record``."""
    read = T.StructType([*as_text(schema).fields, T.StructField("_corrupt_record", T.StringType())])
    env = (spark.read.schema(read).option("multiLine", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    fields = [f.name for f in read[data].dataType.elementType.fields]
    rows = env.select(*scalars, "_corrupt_record", F.col("_metadata.file_path").alias("_file"), F.posexplode_outer(data).alias("pos", "_r"))
    return (rows.where(F.col("pos").isNotNull() | F.col("_corrupt_record").isNotNull())
                .select(*scalars, "_corrupt_record", "_file", "pos", *[F.col(f"_r.{f}").alias(f) for f in fields if f not in scalars]))


def read_envelopes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S2 for envelope files: each file is one JSON document (possibly pretty-printed)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def explode_envelope(envelopes: DataFrame, scalars: Sequence[str], data: str = "data") -> DataFrame:
    """S3: one row per element of ``data`` with the envelope scalars copied onto it,
    plus the element position ``pos`` and the source file (the keep-first order).
    An envelope scalar wins over a record field of the same name."""
    fields = [f.name for f in envelopes.schema[data].dataType.elementType.fields]
    return (envelopes.select(*scalars, F.col("_metadata.file_path").alias("_file"),
                             F.posexplode(data).alias("pos", "_r"))
                     .select(*scalars, "_file", "pos",
                             *[F.col(f"_r.{f}").alias(f) for f in fields if f not in scalars]))
