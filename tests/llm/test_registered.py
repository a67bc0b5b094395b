"""The registered queries over whole small tables, and the pipeline, against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from autolake.llm import oracles, queries, toxicity, words
from tests.conftest import SF001
from tests.llm.corpus import alnum_words, blank_words, edge_texts, mixed_texts
from tests.llm.test_near_dedup import brute as near_brute
from tests.llm.test_quality_license import brute_counts
from tests.llm.test_substring_dedup import brute as repeat_brute
from tests.llm.test_toxicity_pipeline import pipeline


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1_ids_in_order(spark, documents):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for i, text in documents:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    got = queries.QUERIES["op1_token_blocks"](spark, SF001).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_op3_pieces_hold_every_id_once(spark, documents):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in documents}
    got = queries.QUERIES["op3_packing"](spark, SF001).collect()
    seen = Counter()
    for r in got:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length and crc(part) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        seen.update((r.doc_id, k) for k in range(r.start, r.start + r.length))
    assert len(seen) == sum(map(len, ids.values())) and set(seen.values()) == {1}
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048


def test_op6_and_op9_base_columns(spark, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op6_quality_rules"](spark, SF001).collect()}
    assert len(got) == len(documents)
    for i, text in documents:
        n, chars, symbols, lines, again = brute_counts(text)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, again)
        assert r.base_failed == (n < 50 or 100 * again > 50 * n) and not (r.base_failed and r.kept)
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    got = {r.doc_id: r for r in queries.QUERIES["op9_license_scan"](spark, SF001).collect()}
    for i, text in documents:
        w = alnum_words(text)
        places = [(k, label) for p, label in phrases.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        starts = [k for k, _ in places]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_op5_held_out_rows_by_the_querys_own_model(spark):
    sf01 = "/root/testdata/sf0.1"       # some labels of these tables are noise: a few hundred held-out rows are needed
    got = queries.QUERIES["op5_toxicity"](spark, sf01)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf01}/labels.parquet").collect()}
    hit = Counter()
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{sf01}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
        if r.held_out and r.doc_id in labels:
            hit[labels[r.doc_id], r.predicted] += 1
    assert hit[0, 0] >= 0.99 * (hit[0, 0] + hit[0, 1]) and hit[1, 1] >= 0.9 * (hit[1, 1] + hit[1, 0])


def test_toxicity_features_as_plain_python():
    texts = ["You are BAD!! you b4d thing, really", "good text", "", None, "bad " * 30, "nothing here. BAD WORDS badly", "ye BÄD bad you"]
    hashed = lambda *w: np.sort(words.word_hashes(pa.array([" ".join(w)]))[0])
    lexicon = toxicity.Lexicon(words=hashed("bad", "worse"), core_words=hashed("bad"))
    found = toxicity.features(pa.array(texts, pa.string()), lexicon)
    for i, text in enumerate(texts):
        w = [x.encode() for x in alnum_words(text)]
        some = max(len(w), 1)
        hits = [k for k, x in enumerate(w) if x in (b"bad", b"worse")]
        you = [k for k, x in enumerate(w) if x.decode() in toxicity.SECOND_PERSON]
        near = [k for k in hits if any(abs(k - y) <= toxicity.NEAR for y in you)]
        letters = max(sum(c.isascii() and c.isalpha() for c in text or "") + sum(b >= 128 for b in (text or "").encode()), 1)
        assert found["lex"][i] == len(hits) / some and found["lex_hits"][i] == min(len(hits), 20)
        assert found["core"][i] == sum(x == b"bad" for x in w) / some and found["near_you"][i] == len(near) / some
        assert found["bangs"][i] == (text or "").count("!") / some and found["length"][i] == np.log1p(len(w))
        assert found["caps"][i] == sum("A" <= c <= "Z" for c in text or "") / letters


def test_em_equals_a_plain_loop():
    from autolake.llm import quality_rules as q
    rnd = random.Random(2)
    votes = np.array([[rnd.choice([-1, 0, 1, 1]) for _ in range(5)] for _ in range(40)])
    counts = np.array([float(rnd.randrange(1, 50)) for _ in range(40)])
    prior, weights = q.fit(votes, counts)
    total = counts.sum()
    believed = [[[p, 1 - p] for _ in range(5)] for p in q.JUNK_VOTE]
    share, rate = q.PRIOR, believed
    for _ in range(q.ROUNDS):
        post = []
        for v in votes:
            odds = np.log(share / (1 - share))
            for j, x in enumerate(v):
                if x >= 0:
                    odds += np.log(rate[1][j][x]) - np.log(rate[0][j][x])
            post.append(1 / (1 + np.exp(-odds)))
        new = [[[q.BELIEF * total * believed[c][j][x] + sum(n * (p if c else 1 - p) for v, n, p in zip(votes, counts, post) if v[j] == x)
                 for x in (0, 1)] for j in range(5)] for c in (0, 1)]
        new = [[[r[0] / sum(r), r[1] / sum(r)] for r in side] for side in new]
        for j in range(5):
            if new[0][j][0] < new[1][j][0]:
                both = [(new[0][j][x] + new[1][j][x]) / 2 for x in (0, 1)]
                new[0][j], new[1][j] = both, list(both)
        later = (sum(n * p for n, p in zip(counts, post)) + q.BELIEF * total * q.PRIOR) / (total * (1 + q.BELIEF))
        moved = abs(later - share) + max(abs(new[c][j][x] - rate[c][j][x]) for c in (0, 1) for j in range(5) for x in (0, 1))
        share, rate = later, new
        if moved < 1e-9:
            break
    assert abs(prior - share) < 1e-9 and np.abs(weights - np.log(np.array(rate))).max() < 1e-6


def test_op10_with_repeats_against_sql(spark, tmp_root):
    rnd = random.Random(1)
    html = ["", None, "same page", "another page", "ünï\r\n\r\nWARC/1.1\r\n\r\n", "x" * 5000]
    pages = pa.table({"page_id": pa.array([3 * i + 1 for i in range(300)], pa.int64()), "url": [f"http://h{i % 7}/{i}" for i in range(300)],
                      "html": pa.array([rnd.choice(html) if i % 4 else f"only {i}" for i in range(300)], pa.string())})
    pq.write_table(pages, f"{tmp_root}/pages.parquet")
    got = queries.QUERIES["op10_warc"](spark, tmp_root)
    con = duckdb.connect()
    con.execute(f"create view pages as from '{tmp_root}/pages.parquet'")
    want = con.execute(oracles.OP10)
    names = [c[0] for c in want.description]
    want = sorted(want.fetchall())
    assert sorted(map(tuple, got.select(*names).collect())) == want
    kinds = Counter(r[names.index("record_type")] for r in want)
    assert kinds["revisit"] > 200 and kinds["response"] == 75 + 5


def _contaminated(text, items):
    w = alnum_words(text)
    hit = set()
    for item in items:
        b = alnum_words(item)
        n = min(len(b), 13)
        windows = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in windows:
                hit.update(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(w)


def test_pipeline_as_plain_python(spark, tmp_root):
    """All stages over a small corpus with copies, passages and benchmark text; the first stage's
    decisions are taken as given, the others are made again in plain Python."""
    rnd = random.Random(8)
    items = [" ".join(f"quiz{rnd.randrange(300)}" for _ in range(rnd.choice([5, 13, 30]))) for _ in range(6)]
    texts = mixed_texts(21, 140) + [(1000 + i, t) for i, t in edge_texts() if i is not None and len(t or "") < 100_000]
    texts += [(2000 + i, "intro words of this one " + rnd.choice(items) + f" end {i}") for i in range(8)]
    texts += [(2100, None), (2100, "the real text of an id with two rows"), (None, "no id here " * 4), (None, "no id here " * 4)]
    table = pa.table({"doc_id": pa.array([i for i, _ in texts], pa.int64()), "text": pa.array([t for _, t in texts], pa.string()),
                      "lang": ["en"] * len(texts), "source": pa.array([None if k % 5 == 0 else "s" for k in range(len(texts))], pa.string()),
                      "n_chars": pa.array([len(t or "") for _, t in texts], pa.int64())})
    pq.write_table(table, f"{tmp_root}/documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array(range(len(items)), pa.int64()), "text": items}), f"{tmp_root}/benchmark.parquet")
    pq.write_table(pa.table({"doc_id": pa.array([0, 1], pa.int64()), "quality": [1, 1], "toxic": [0, 0]}), f"{tmp_root}/labels.parquet")
    p = pipeline()
    got = p.run(spark, tmp_root).collect()

    first = [(r.doc_id, r.text) for r in p.STAGES[0][1](spark, spark.read.parquet(f"{tmp_root}/documents.parquet"), tmp_root).collect()]
    lowest = {d: c for d, _, c in near_brute(first, 80)}
    rows = {}
    for d, t in first:
        if d is not None and lowest[d] == d and (d not in rows or (t is None, t or "") < (rows[d] is None, rows[d] or "")):
            rows[d] = t
    kept = list(rows.items()) + [(d, t) for d, t in first if d is None]
    cut = []
    for d, n, gone, left in repeat_brute(kept, 35):
        if gone < n or not n:
            text = next(t for i, t in kept if i == d and len(blank_words(t)) == n)
            cut.append((d, text if not gone else b" ".join(left).decode()))
    final = [(d, t) for d, t in cut if not _contaminated(t, items)]
    assert 0 < len(final) < len(cut) < len(kept) < len(first)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole = {}
    for r in got:
        whole.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert set(whole) == {d for d, _ in final}
    for d, parts in whole.items():
        same = [tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in final if i == d]
        assert sum(n for _, n, _, _ in parts) == sum(map(len, same))
        if len(same) == 1 and len(blank_words(next(t for i, t in final if i == d))) == len(blank_words(next((t for i, t in kept if i == d), None))):
            assert all(crc(same[0][a:a + n]) == c and size == len(same[0]) for a, n, c, size in parts)
