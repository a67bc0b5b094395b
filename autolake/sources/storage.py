"""Files and folders through Hadoop's file system: the same calls on local disks, HDFS and object stores."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there. A path that is there but cannot be read is an error of its reader."""
    fs, p = _path(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if there is no such folder."""
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def state(spark: SparkSession, path: str) -> int:
    """A number that changes when any file under ``path`` is added, removed or rewritten."""
    fs, p = _path(spark, path)
    files, found = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hash(tuple(sorted(found)))


def has_entries(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds data (entries that Spark's readers do not skip)."""
    return any(n[0] not in "_." for n in names(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a name that must be free; readers see it whole or not at all."""
    fs, p = _path(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    part = hadoop.Path(p.getParent(), f"_{p.getName()}-{spark.sparkContext._jvm.java.util.UUID.randomUUID()}")
    stream = fs.create(part, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(part, p, none)       # without OVERWRITE an existing name is an error
    except Exception:
        fs.delete(part, False)
        raise
