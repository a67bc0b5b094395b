"""op4 and op10: rule verdicts against a plain loop, archives by round trip."""

from __future__ import annotations

import base64
import hashlib
import random

from pyspark.sql import functions as F

from autolake.llm import url_cascade, warc
from autolake.session import scratch_path

PAGES = "page_id long, url string, host string, path string, key string, html string"


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] + [len(tail)])]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def test_verdicts_equal_a_plain_loop(spark):
    rnd = random.Random(1)
    names = [f"h{i}" for i in range(300)]
    rules = [(f"{rnd.choice(names)}.{rnd.choice(['com', 'net'])}", rnd.choice(["/", "/a/", "/b/c/", ""]), rnd.choice(["allow", "block"])) for _ in range(250)]
    rules += [("com", "/zz", "block"), ("h1.com", "/a/", "allow"), ("h1.com", "/a/", "block")]
    urls = [f"http{rnd.choice(['', 's'])}://{rnd.choice(['', 'www.', 'A.b.'])}{rnd.choice(names)}.{rnd.choice(['com', 'net', 'org'])}"
            f"{rnd.choice(['', '/', '/a/', '/b/c/d', '/zz?x=/a/', '#/a/', '/a/b#c'])}" for _ in range(2500)]
    urls += [None, "", "no scheme", "http://", "://com/zz", "HTTP://COM/ZZ", "http://COM/zz", "x://h1.com", "http://h1.com:80/a/", "http://.com/zz", "a://b://c", "http://É.com/zz\n/x"]
    pages = spark.createDataFrame([(i, u, "h", "p", "k", None) for i, u in enumerate(urls)] + [(None, urls[0], "", "", "", None)] * 2, PAGES)
    got = url_cascade.judge(pages, spark.createDataFrame(rules + [(None, "/", "block")], "host string, path string, verdict string"))
    for r in got.collect():
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id or 0], rules), urls[r.page_id or 0]
    assert got.count() == len(urls) + 2


def test_cascade_is_exact_over_its_universe(spark):
    wanted = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("key")).checkpoint()
    universe = spark.range(0, 9000).select(F.concat(F.lit("k"), "id").alias("key")).checkpoint()
    for limit in (url_cascade.MAX_FILTER_BYTES, 64):        # whole filters, and ones in many shards
        levels = url_cascade.cascade(wanted, universe, max_bytes=limit)
        assert len(levels) > 1 and all(len(x) <= limit for level in levels for x in level.shards)
        assert (max(len(level.shards) for level in levels) > 1) == (limit == 64)
        got = {r.key for r in universe.where(url_cascade.listed(levels, F.col("key"))).collect()}
        assert got == {f"k{i}" for i in range(0, 3000, 3)}


def test_no_rules_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b/c", "", "", "", "")], PAGES)
    assert [(r.rule, r.verdict) for r in url_cascade.judge(pages, none).collect()] == [(None, "allow")]
    assert url_cascade.judge(pages.limit(0), url_cascade.rule_table(spark, [("a", "/", "block")])).count() == 0


def pages_of(spark, payloads):
    return spark.createDataFrame([(i, u, None if p is None else bytearray(p)) for i, u, p in payloads], "page_id long, url string, payload binary")


PAYLOADS = [(1, "http://a/", b"same"), (5, "http://b/\r\nX: y", b"same"), (3, None, b"same"), (None, "u", b"same"), (7, "e", b""), (8, "", None), (9, " é ", b"\r\n\r\nWARC/1.1\r\n\r\n"),
            (10, "b", bytes(range(256))), (2, "l", b"x" * 300_000), (11, "t", b"tie"), (11, "t", b"tie")]


def expected(least):
    out = []
    for i, _, p in PAYLOADS:
        p = p or b""
        same = [j for j, _, q in PAYLOADS if (q or b"") == p and j is not None]
        top = max(same, default=None)
        whole = len(p) < least or i == top
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if whole else "revisit", None if whole else top))
    return sorted(out, key=repr)


def test_archive_round_trip(spark):
    for least in (0, 4, 5):
        path = scratch_path(spark, "test-warc")
        warc.write(pages_of(spark, PAYLOADS).repartition(2), path, least_bytes=least)
        got = warc.resolve(warc.read(spark, path)).collect()
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == expected(least)
        assert {r.url for r in got} == {None, "http://a/", "http://b/%0D%0AX: y", "u", "e", "", "%20é%20", "b", "l", "t"}


def test_no_records(spark):
    path = scratch_path(spark, "test-warc")
    warc.write(pages_of(spark, []), path)
    assert warc.resolve(warc.read(spark, path)).count() == 0


def test_every_record_is_a_gzip_member_of_its_own(spark):
    import glob
    import gzip
    import zlib

    path = scratch_path(spark, "test-warc")
    warc.write(pages_of(spark, PAYLOADS), path, date="2026-01-02T03:04:05Z")
    kinds, ids = [], []
    for file in glob.glob(f"{path.removeprefix('file:')}/part-*"):
        data = open(file, "rb").read()
        whole = gzip.decompress(data) if data else b""
        again = b""
        at = 0
        while at < len(data):       # each one by its offset alone
            one = zlib.decompressobj(31)
            part = one.decompress(data[at:])
            at = len(data) - len(one.unused_data)
            again += part
            if part:
                fields, block = warc.parse(part)
                kinds.append(fields["warc-type"])
                ids.append(fields["warc-record-id"])
                assert fields["warc-date"] == "2026-01-02T03:04:05Z"
        assert again == whole
    assert kinds.count("response") + kinds.count("revisit") == len(PAYLOADS) and "warcinfo" in kinds


def test_payloads_are_not_shuffled(spark):
    rows = [(i, f"u{i}", b"same" if i % 3 == 0 else str(i).encode()) for i in range(3000)]
    path = scratch_path(spark, "test-warc")
    heads = pages_of(spark, rows).select("page_id", "url", "payload").mapInArrow(lambda b: warc._heads(b, False), warc._HEADS)
    again = warc.revisits(heads)
    assert again.columns == ["digest", "page_id", "url", "bytes", "original"] and again.count() == 999
    warc.write(pages_of(spark, rows).repartition(4), path)
    got = warc.resolve(warc.read(spark, path))
    assert got.where("record_type = 'revisit' and refers_to = 2997").count() == 999 and got.count() == 3000
