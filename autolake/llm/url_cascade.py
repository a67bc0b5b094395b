"""URL rules by Bloom filter cascades: exact membership over the corpus's keys, without joins.

A rule is (host, path, verdict) with verdict allow or block and fits its host and all
subdomains where the url's path starts with the rule's. The keys of a url are its host
suffixes times its path prefixes, of the label counts and lengths that rules have. Each
verdict's listed keys get a cascade: level 1 is a filter of the listed keys, level 2 of the
corpus keys that pass level 1 unlisted, level 3 of the listed keys that pass level 2, and so
on until a level lets nothing wrong through. A key of the corpus is listed if the first level
that it fails is even, or if it passes all of an odd number. Everything is DataFrame
expressions; pages are scanned with the filters as constants, without join or shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autolake.llm.stored import stored

# A larger filter is cut into shards; listed keys * log2(corpus keys / listed keys) bounds their bytes.
MAX_FILTER_BYTES = 16 << 20
# Filters after the first let half of the other keys pass.
LATER_RATE = 0.5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def keys(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Array of (key, size, host size) that any rule could have: host suffix and path prefix in one string."""
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    out = []
    for n in labels:
        suffix = F.substring_index(host, ".", -n)
        for m in lengths:
            key = F.concat(suffix, F.substring(path, 1, m))
            fits = (dots >= n - 1) & (F.length(path) >= m) & (host != "")
            out.append(F.when(fits, F.struct(key.alias("key"), F.length(key).alias("size"), F.length(suffix).alias("host"))))
    return F.filter(F.array(*out), lambda k: k.isNotNull())


@dataclass
class Level:
    """A Bloom filter in shards of at most ``MAX_FILTER_BYTES``; a hash of the key names its shard."""
    shards: list[bytes]
    probes: int
    seed: int

    def passes(self, key: Column) -> Column:
        out = F.lit(False)
        for n, bits in enumerate(self.shards):
            here = F.exists(F.array(F.lit(bits)), self._probe(8 * len(bits), key))     # one literal, however many probes
            out = here if len(self.shards) == 1 else F.when(_shard(self.seed, key, len(self.shards)) == n, here).otherwise(out)
        return out

    def _probe(self, n_bits: int, key: Column):
        def all_set(bits: Column) -> Column:
            out = F.lit(True)
            for at in _positions(self.seed, self.probes, key, n_bits):
                byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
                out = out & (F.getbit(byte, (at % 8).cast("int")) == 1)
            return out
        return all_set


def _shard(seed: int, key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed - 1), key), F.lit(shards)).cast("int")


def _positions(seed: int, probes: int, key: Column, n_bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed + i), key), F.lit(n_bits)) for i in range(probes)]


def listed(levels: list[Level], key: Column) -> Column:
    """Membership of a key of the corpus."""
    out = F.lit(len(levels) % 2 == 1)
    for depth in range(len(levels), 0, -1):
        out = F.when(levels[depth - 1].passes(key), out).otherwise(F.lit(depth % 2 == 0))
    return out


def _level(held: DataFrame, n: int, rate: float, seed: int, max_bytes: int) -> Level:
    """A filter of the ``n`` stored keys with false positive rate ``rate``."""
    whole = max(64, math.ceil(n * math.log2(math.e) * math.log2(1 / rate) / 64) * 64)
    shards = -(-whole // (8 * max_bytes))
    n_bits = math.ceil(whole / shards / 64) * 64
    probes = min(max(1, round(whole / n * math.log(2))) if n else 1, 24)
    at = F.array(*[p + 1 for p in _positions(seed, probes, F.col("key"), n_bits)])
    rows = (held.select(_shard(seed, F.col("key"), shards).alias("shard"), F.explode(at).alias("p"))
                .groupBy("shard", F.bitmap_bucket_number("p").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect())
    out = [bytearray(n_bits // 8) for _ in range(shards)]
    for r in rows:      # one row per 32,768 bits
        a = (r["bucket"] - 1) * 4096
        part = bytes(r["bits"])[:len(out[r["shard"]]) - a]
        out[r["shard"]][a:a + len(part)] = part
    return Level([bytes(x) for x in out], probes, seed)


def cascade(wanted: DataFrame, universe: DataFrame, seed: int = 0, max_bytes: int = MAX_FILTER_BYTES) -> list[Level]:
    """Levels that tell the ``wanted`` keys from the other keys of ``universe`` (stored tables of ``key``)."""
    levels: list[Level] = []
    inside, n_inside = wanted, wanted.count()
    n_universe = universe.count()
    if not n_inside:
        return levels
    rate = min(0.5, n_inside / (math.sqrt(2) * max(n_universe, 1)))
    outside = None
    while n_inside:
        levels.append(_level(inside, n_inside, rate if not levels else LATER_RATE, seed + 100 * len(levels) + 1, max_bytes))
        passed = levels[-1].passes(F.col("key"))
        # keys of the other side that pass: of the universe but the listed ones, then of the last round
        other = universe.join(wanted, "key", "left_anti") if outside is None else outside
        inside, outside = stored(other.where(passed), "cascade-keys"), inside
        n_inside = inside.count()
    return levels


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``id_col``, host, path, rule (host and path of the longest fitting rule, or null), verdict.

    ``rules``: host, path, verdict (allow or block); repeated rules count once, nulls are
    skipped, a rule listed under both verdicts blocks. The longest rule string wins, then the
    longer host. Without a fitting rule the verdict is ``default``. Null urls and urls without
    ``://`` have an empty host and path and fit no rule. Null ids and repeated rows are judged
    like others; empty tables are fine on either side.
    """
    own = rules.select(F.translate("host", _UPPER, _UPPER.lower()).alias("host"), "path", "verdict").dropna()
    # the shapes of rules: a few label counts and path lengths, whatever the number of rules
    labels = [r[0] for r in own.select(F.size(F.split("host", r"\."))).distinct().collect()]
    lengths = [r[0] for r in own.select(F.length("path")).distinct().collect()]
    host, path = parts(F.col(url_col))
    split = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    found = split.withColumn("keys", keys(F.col("host"), F.col("path"), sorted(labels), sorted(lengths)) if labels
                             else F.expr("cast(array() as array<struct<key:string,size:int,host:int>>)"))
    universe = stored(found.select(F.explode("keys.key").alias("key")).distinct(), "cascade-universe")
    levels = {}
    for n, verdict in enumerate(("block", "allow")):
        wanted = stored(own.where(F.col("verdict") == verdict).select(F.concat("host", "path").alias("key")).distinct(), "cascade-listed")
        levels[verdict] = cascade(wanted, universe, seed=10_000 * n)
    hit = lambda verdict, key: listed(levels[verdict], key) if levels[verdict] else F.lit(False)
    marked = F.transform("keys", lambda k: F.struct(
        k["size"].alias("size"), k["host"].alias("host"), k["key"].alias("key"),
        F.when(hit("block", k["key"]), F.lit("block")).when(hit("allow", k["key"]), F.lit("allow")).alias("verdict")))
    best = F.array_max(F.filter(marked, lambda k: k["verdict"].isNotNull()))
    return (found.withColumn("best", best)
                 .select(F.col("id").alias(id_col), "host", "path", F.col("best")["key"].alias("rule"),
                         F.coalesce(F.col("best")["verdict"], F.lit(default)).alias("verdict")))


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A small list of (host, path, verdict) as a table."""
    listed_rules = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
    return spark.range(1).select(F.explode(listed_rules).alias("r")).select("r.*")
