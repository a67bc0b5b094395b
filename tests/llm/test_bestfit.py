"""op13: best-fit decreasing over the lengths of all documents."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from autolake.llm import bestfit, queries, tokens
from tests.conftest import SF001
from tests.llm.corpus import DOCS, edge_texts, rows

NAME = "byte_bpe_50k.json"


def plain_sequences(lengths, window):
    """Sequences of best-fit decreasing, one piece at a time."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(window - n)
    return Counter(room)


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    window = rnd.choice([1, 2, 7, 30, 64, 100])
    lengths = [rnd.randint(1, rnd.choice([window, max(1, window // 3)])) for _ in range(rnd.choice([0, 1, 5, 300]))]
    counts = Counter(lengths)
    runs = bestfit.plan(dict(counts), window)
    filled, placed = defaultdict(list), Counter()
    for length, first, n, sequence, each, offset in runs.tolist():
        assert first == placed[length]
        placed[length] += n
        for k in range(n):
            filled[sequence + k // each].append((offset + k % each * length, length))
    assert placed == counts
    for parts in filled.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
    assert sorted(filled) == list(range(len(filled)))
    assert Counter(window - sum(n for _, n in parts) for parts in filled.values()) == plain_sequences(lengths, window)


def check(got, texts, window, end):
    """Every id of every document in one piece; sequences full from 0; best-fit decreasing's number of sequences."""
    tok = Tokenizer.from_file(public_tokenizers.path(NAME))
    want = Counter()
    for i, text in texts:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [end]
        short = (len(ids) - 1) % window + 1
        cuts = [0, *range(short, len(ids) + 1, window)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert sum(n for _, n in parts) <= window
    assert len(filled) == sum(plain_sequences([r.length for r in got], window).values())


@pytest.mark.parametrize("window", [16, 1024])
def test_documents_of_all_kinds(spark, window):
    texts = edge_texts() * 2
    docs = spark.createDataFrame(rows(texts), DOCS + ", piece int, part int, number long, length int")        if False else spark.createDataFrame(rows(texts), DOCS).withColumn("length", F.lit("x")).withColumn("number", F.lit(3)).withColumn("doc", F.lit("d"))
    got = bestfit.pack(docs.repartition(5), tokens.read_vocabulary(public_tokenizers.path(NAME)), window=window, special=True).collect()
    check(got, texts, window, 2)


def test_empty_table_and_text_ids(spark):
    vocabulary = tokens.read_vocabulary(public_tokenizers.path(NAME))
    assert bestfit.pack(spark.createDataFrame([], DOCS), vocabulary).count() == 0
    named = spark.createDataFrame([("x", "a b"), (None, "c")], "doc_id string, text string")
    assert sorted((r.doc_id or "", r.start) for r in bestfit.pack(named, vocabulary).collect()) == [("", 0), ("x", 0)]


def test_registered_query_over_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op13_best_fit"](spark, SF001)
    assert dict(got.dtypes) == {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                                "sequence_id": "bigint", "offset": "bigint"}
    check(got.collect(), [(r.doc_id, r.text) for r in docs], 1024, 2)
