"""Keyed serving tables: upsert, update-only merge, contract checks, versioned commits.

A stored table is a log of versions; a version lists the folders of its buckets. A merge rewrites
the buckets that its batch's keys fall into and carries the other buckets' folders over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from autolake.functions.joins import partitions_for
from autolake.sources import storage

LOG = "_log"            # one small file per committed version, named by its number
VERSIONS_KEPT = 3
BUCKETS = 64            # folders that a keyed table is dealt to, unless the caller says otherwise
DEALT_BY = "hash:"      # the hash that deals rows to buckets, named in every version


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str] | None = None, insert: bool = True) -> DataFrame:
    """S9/S10/S10b/S11 in one function: the merged table.

    - a key only in ``target`` keeps its row;
    - a key in both takes ``update_cols`` from ``updates`` and keeps every other
      column from ``target`` (``update_cols=None`` means every non-key column);
    - a key only in ``updates`` is inserted when ``insert`` (else dropped: S11).

    Keys must be unique on both sides (see ``duplicate_keys``). The join shuffles
    both sides by key; keys are unique, so no key can skew a task.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    extra = [c for c in updates.columns if c not in keys and c not in cols]
    upd = set(update_cols) if update_cols is not None else set(cols + extra)
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_t"))
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in updates.columns if c not in keys],
                       F.lit(True).alias("_u"))
    j = t.join(u, keys, "full" if insert else "left")
    has_u = F.col("_u").isNotNull()
    has_t = F.col("_t").isNotNull()
    out = [F.col(k) for k in keys]
    for c in cols + extra:
        tc = F.col(f"_t_{c}") if c in cols else F.lit(None)
        uc = F.col(f"_u_{c}") if c in updates.columns else F.lit(None)
        if c in upd:
            out.append(F.when(has_u, uc).otherwise(tc).alias(c))
        else:
            out.append(F.when(has_t, tc).otherwise(uc).alias(c))
    return j.select(*out)


def update_only(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                update_cols: Sequence[str]) -> DataFrame:
    """Set ``update_cols`` on matching keys, never insert. Columns missing on the
    target are added (null where unmatched)."""
    tgt = target
    for c in update_cols:
        if c not in tgt.columns:
            tgt = tgt.withColumn(c, F.lit(None).cast(updates.schema[c].dataType))
    return upsert(tgt, updates.select(*keys, *update_cols), keys, update_cols, insert=False)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (a batch must not upsert one key twice)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """S12 defaults: a null in a defaulted column takes the default."""
    for c, v in defaults.items():
        if c in df.columns:
            df = df.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)))
    return df


def contract_violations(df: DataFrame, contract: dict) -> DataFrame:
    """One row of violation counts — nulls in NOT NULL columns, duplicate keys,
    text longer than its declared VARCHAR — from one pass: counts per key (combined
    map-side, so a hot key is one row per task), then their sums."""
    key = contract["key"]
    sums = {"rows": F.count(F.lit(1))}
    for c in contract["not_null"]:
        if c in df.columns:
            sums[f"null_{c}"] = F.count_if(F.col(c).isNull())
    for c, n in contract["max_len"].items():
        if c in df.columns:
            sums[f"too_long_{c}"] = F.count_if(F.length(c) > n)
    by_key = df.groupBy(*key).agg(*[v.alias(f"_{k}") for k, v in sums.items()])
    # a sum over nothing is null, a count is 0
    total = lambda v: F.coalesce(F.sum(v), F.lit(0)).cast("bigint")
    return by_key.agg(*[total(F.col(f"_{k}")).alias(k) for k in sums],
                      total(F.greatest(F.col("_rows") - 1, F.lit(0))).alias("duplicate_keys"))


# ---------------------------------------------------------------- versioned tables

class Part(NamedTuple):
    """One bucket of a version: its folder under the table's root, its rows and their fingerprint."""
    folder: str
    rows: int
    fingerprint: int


class Version(NamedTuple):
    """A committed version: its number, columns, the keys that deal rows to buckets (none: one bucket), the parts."""
    number: int
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int
    parts: dict[int, Part]


class Merged(NamedTuple):
    """What a merge did: the version it made, the buckets it rewrote, of how many, rows and fingerprint of the table."""
    version: int
    rewritten: list[int]
    buckets: int
    rows: int
    fingerprint: int


def row_hash(cols: Sequence[str]) -> Column:
    """60 bits of the MD5 of a row's values as text, in the order of the column names; a null differs from any text."""
    text = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in sorted(cols)]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *text)), 1, 15), 16, 10).cast("decimal(20,0)")


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and the exact sum of their hashes (per ``by`` group): equal for equal tables, whatever
    the order of rows and columns and however they are stored. A sum, so a repeated row counts."""
    cols = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"),
                               F.coalesce(F.sum(row_hash(cols)), F.lit(0)).cast("decimal(38,0)").alias("fingerprint"))


def table_version(spark: SparkSession, root: str) -> Version | None:
    """The table's current version, from the newest entry of its log; None before the first commit."""
    numbers = [n for n in storage.names(spark, f"{root}/{LOG}") if n.isdigit()]
    return _read_version(spark, root, numbers[-1]) if numbers else None


def _read_version(spark: SparkSession, root: str, name: str) -> Version:
    schema, head, *lines = storage.read_text(spark, f"{root}/{LOG}/{name}").split("\n")
    buckets, *keys = head.split("\t")
    if buckets.startswith(DEALT_BY):
        buckets = buckets.removeprefix(DEALT_BY)
    else:
        keys = []       # dealt by another hash: a table without buckets, which its next merge deals anew
    parts = {}
    for line in lines:
        bucket, folder, rows, total = line.split("\t")
        parts[int(bucket)] = Part(folder, int(rows), int(total))
    return Version(int(name), T.StructType.fromJson(json.loads(schema)), tuple(keys), int(buckets), parts)


def current_version(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number and log entry of the table's current version; (0, None) before the first commit."""
    now = table_version(spark, root)
    return (now.number, f"{root}/{LOG}/{now.number:020d}") if now else (0, None)


def _commit(spark: SparkSession, root: str, version: Version, retain: int) -> None:
    """Make a version current: its number must be free (else another writer has committed, an error).

    Folders that none of the last ``retain`` versions names are deleted after that."""
    lines = [version.schema.json(), "\t".join([f"{DEALT_BY}{version.buckets}", *version.keys])]
    lines += ["\t".join(map(str, (b, *p))) for b, p in sorted(version.parts.items())]
    storage.create_once(spark, f"{root}/{LOG}/{version.number:020d}", "\n".join(lines))
    entries = [n for n in storage.names(spark, f"{root}/{LOG}") if n.isdigit()]
    folders = {n: {p.folder for p in _read_version(spark, root, n).parts.values()} for n in entries}
    kept = set().union(*[folders[n] for n in entries[-retain:]])
    for n in entries[:-retain]:
        for folder in folders[n] - kept:
            storage.delete(spark, f"{root}/{folder}")
        storage.delete(spark, f"{root}/{LOG}/{n}")
    for attempt in {f.split("/")[0] for n in entries[:-retain] for f in folders[n]} - {f.split("/")[0] for f in kept}:
        storage.delete(spark, f"{root}/{attempt}")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """The hash that ``repartition`` deals rows by: a partition of a multiple of ``buckets`` lies in one bucket."""
    return F.pmod(F.hash(*keys), F.lit(buckets)).cast("int")


def _tasks(spark: SparkSession, buckets: int, rows: int) -> int:
    """Partitions to write a table in: a multiple of its buckets, few rows each."""
    return -(-partitions_for(spark, rows) // buckets) * buckets


def _write_parts(df: DataFrame, root: str, attempt: str, keys: Sequence[str], buckets: int) -> dict[int, Part]:
    """The rows as one folder per bucket under ``attempt``; rows and fingerprints from what was written.

    With ``keys`` the rows are partitioned by their hash already, so a task holds one bucket, or a few."""
    spark, folder = df.sparkSession, f"{root}/{attempt}"
    if not keys:
        df.write.option("compression", "zstd").mode("errorifexists").parquet(folder)
        r = fingerprint(spark.read.schema(df.schema).parquet(folder)).first()
        return {0: Part(attempt, r["rows"], int(r["fingerprint"]))}
    dealt = df.withColumn("_bucket", _bucket(keys, buckets))
    dealt.write.option("compression", "zstd").mode("errorifexists").partitionBy("_bucket").parquet(folder)
    written = spark.read.schema(dealt.schema).parquet(folder)
    # at most one row per bucket
    return {r["_bucket"]: Part(f"{attempt}/_bucket={r['_bucket']}", r["rows"], int(r["fingerprint"]))
            for r in fingerprint(written, by=["_bucket"]).collect()}


def commit_version(df: DataFrame, root: str, base: int, retain: int = VERSIONS_KEPT, keys: Sequence[str] = (),
                   buckets: int = BUCKETS) -> str:
    """Write a full new version of a serving table and make it current.

    The rows go to an attempt folder of their own, with ``keys`` dealt to ``buckets`` folders by a
    hash of the keys; only after the write is complete a small file named ``base + 1`` in the
    table's log names the folders. Readers follow the log, so a failed or half-moved write is
    never seen, and a retry starts a new attempt. ``base`` is the version that the rows were made
    from: if another writer has committed since, the number is taken and the commit fails instead
    of losing rows. The last ``retain`` versions stay for running readers."""
    spark, attempt = df.sparkSession, f"attempt-{uuid.uuid4().hex}"
    try:
        dealt = df.repartition(_tasks(spark, buckets, 0), *keys) if keys else df
        parts = _write_parts(dealt, root, attempt, keys, buckets)
        _commit(spark, root, Version(base + 1, df.schema, tuple(keys), buckets if keys else 1, parts), retain)
    except Exception:
        storage.delete(spark, f"{root}/{attempt}")
        raise
    return f"{root}/{attempt}"


def _hit(updates: DataFrame, keys: Sequence[str], buckets: int) -> set[int]:
    """Buckets that the rows' keys fall into (at most ``buckets`` rows are collected)."""
    return {r[0] for r in updates.select(_bucket(keys, buckets)).distinct().collect()}


def read_touched(spark: SparkSession, root: str, version: Version, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the buckets that the rows' keys fall into; other buckets are not read."""
    hit = _hit(updates, keys, version.buckets) if version.keys else set(version.parts)
    return read_version(spark, root, version._replace(parts={b: p for b, p in version.parts.items() if b in hit}))


def merge(spark: SparkSession, root: str, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None,
          insert: bool = True, buckets: int = BUCKETS, retain: int = VERSIONS_KEPT,
          combine: Callable[[DataFrame, DataFrame], DataFrame] | None = None, partitions: int | None = None) -> Merged:
    """S9-S11 on a stored table: ``upsert`` of ``updates``, rewriting only the buckets that they hit.

    Rows lie in buckets by a hash of ``keys``; a new version lists the new folders of the buckets
    that the batch's keys fall into and carries the other buckets' folders over, with their rows and
    fingerprints. The current rows of untouched buckets are neither read nor written. The number
    of buckets is the table's from its first version on (``buckets``); a table whose last version
    was written whole is dealt to buckets by its first merge, and columns that the table lacks
    rewrite all buckets. Two writers from one version still conflict: the second one fails.
    ``combine(current rows, updates)`` replaces the upsert; its result has the same columns.
    Both sides are shuffled once, by the keys, and written as joined. ``partitions`` says that the
    updates are partitioned by the keys already, into so many."""
    keys = list(keys)
    now = table_version(spark, root)
    attempt = f"attempt-{uuid.uuid4().hex}"
    if now and now.keys and now.keys != tuple(keys):
        raise ValueError(f"the table's buckets are by {now.keys}, not {tuple(keys)}")
    count = now.buckets if now and now.keys else buckets
    whole = now is None or not now.keys or any(c not in now.schema.names for c in updates.columns)
    hit = set() if whole else _hit(updates, keys, count)
    n = partitions or _tasks(spark, count, totals(now)[0] if now else 0)
    dealt = updates if partitions or combine else updates.repartition(n, *keys)
    if now is None:
        merged, old = (dealt.repartition(n, *keys) if combine else dealt if insert else dealt.limit(0)), {}
    else:
        old = {} if whole else {b: p for b, p in now.parts.items() if b not in hit}
        touched = now if whole else now._replace(parts={b: p for b, p in now.parts.items() if b in hit})
        current = read_version(spark, root, touched)
        if combine:
            merged = combine(current, updates).repartition(n, *keys)
        else:
            merged = upsert(current.repartition(n, *keys), dealt, keys, update_cols, insert)
        merged = merged.select(*now.schema.names, *[c for c in merged.columns if c not in now.schema.names])
    try:
        fresh = _write_parts(merged, root, attempt, keys, count)
        version = Version((now.number if now else 0) + 1, merged.schema, tuple(keys), count, old | fresh)
        _commit(spark, root, version, retain)
    except Exception:
        storage.delete(spark, f"{root}/{attempt}")
        raise
    return Merged(version.number, sorted(fresh), count, *totals(version))


def totals(version: Version) -> tuple[int, int]:
    """Rows and fingerprint of a version: the sums over its parts, no data is read."""
    return sum(p.rows for p in version.parts.values()), sum(p.fingerprint for p in version.parts.values())


def read_version(spark: SparkSession, root: str, version: Version) -> DataFrame:
    """Rows of a version."""
    paths = [f"{root}/{p.folder}" for _, p in sorted(version.parts.items())]
    return spark.read.schema(version.schema).parquet(*paths) if paths else spark.createDataFrame([], version.schema)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the current version."""
    now = table_version(spark, root)
    if now is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return read_version(spark, root, now)
