"""op1 and op3: whole-text encoding, block files and packing."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from autolake.llm import packing, queries, token_blocks, tokens
from autolake.session import scratch_path
from tests.llm.corpus import DOCS, edge_texts, rows


def plain_ids(name, text):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_memoised_ids_equal_plain_encoding(name):
    texts = [t for _, t in edge_texts() if t is None or len(t) < 10_000]
    texts += ["a  b", "a   b", " x", "x ", "\n \n a  b", "don' t", "\u0301a e\u0301 E\u0301", "x.\n\nY,z", "1234 \u00bd \u00b23", "A\x00B", "\u3000 x \t y", "end.\nNext 's"]
    enc = tokens.Encoder(tokens.read_vocabulary(public_tokenizers.path(name)))
    for _ in range(2):      # the second time from the memo
        ids, bounds = enc.encode(texts, 1)
        for i, text in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == plain_ids(name, text), text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_white_space_runs_before_letters(name):
    rng = np.random.default_rng(5)
    parts = ["\n", "\n", "\n\n", " ", "\t", "\r\n", "\u00a0", "\u3000", "\x1c", "a", "Bc", "\u00e9", "\u0301", "\u4e2d", "1", ".", "!", "'s", "'"]
    texts = ["End of one.\n\nNext", "end\n\n\n\nNext", "\nA", "\n\nA b", "x. \n\n y"]
    texts += ["".join(rng.choice(parts, rng.integers(1, 12))) for _ in range(20_000)]
    enc = tokens.Encoder(tokens.read_vocabulary(public_tokenizers.path(name)))
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    ids, bounds = enc.encode(texts, 1)
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids + [1], text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_every_letter_beside_every_sign(name):
    letters = [chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250)]]
    signs = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()] + ["\n", "\t", "\n\n"]
    texts = [f"x{a}{s}{a}y {a}{s}" for a in letters for s in signs]
    rng = np.random.default_rng(7)
    parts = [*"abzAZé\u0130\u0131ßŉǰ\u0307\u0301中ー—«½²٣", "\n", "\n", " ", " ", "  ", "\t", "\x85", "\u2003", "\u1680", ".", "'", "'s", "_", "9", "\x00", "\x7f"]
    texts += ["".join(rng.choice(parts, rng.integers(1, 14))) for _ in range(50_000)]
    enc = tokens.Encoder(tokens.read_vocabulary(public_tokenizers.path(name)))
    plain = Tokenizer.from_file(public_tokenizers.path(name)).encode_batch_fast(texts, add_special_tokens=False)
    ids, bounds = enc.encode(texts)
    for i, text in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == plain[i].ids, text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_special_strings_as_by_the_library(name):
    rng = np.random.default_rng(6)
    parts = ["<|endoftext|>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", " ", "  ", "\n", "a", "B", "e", "\u0301", "."]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x"]
    texts += ["".join(rng.choice(parts, rng.integers(1, 10))) for _ in range(5_000)]
    enc = tokens.Encoder(tokens.read_vocabulary(public_tokenizers.path(name)), special=True)
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    for _ in range(2):      # the second time from the memo
        ids, bounds = enc.encode(texts, 1)
        for i, text in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids + [1], text


@pytest.mark.parametrize("n", [0, 1, 5, 255, 256, 257, 3000])
@pytest.mark.parametrize("high", [0, 1, 300, 2**32 - 1])
def test_segment_round_trip(n, high):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), high).astype(np.uint32) if high > 1 else np.full(n, high, np.uint32)
    data = token_blocks.encode_segment(3, 4, 5, [7, None], np.array([n // 2, n - n // 2]), ids) + token_blocks.TRAILER.encode()
    (head, docs, counts, back), _ = token_blocks.decode_segments(data + data)
    assert head == (3, 4, 5) and docs == [7, None] and counts.tolist() == [n // 2, n - n // 2]
    assert back.tolist() == ids.tolist()


def test_blocks_hold_ids_in_id_order(spark):
    name, texts = "word_bpe_49k.json", edge_texts()
    docs = spark.createDataFrame(rows(texts), DOCS).repartition(3)
    files = scratch_path(spark, "test-blocks")
    token_blocks.write(docs, files, tokens.read_vocabulary(public_tokenizers.path(name)))
    table = token_blocks.read(spark, files, with_ids=True).checkpoint()
    got = token_blocks.with_starts(table).collect()
    assert sorted((r.doc_id is not None, r.doc_id, r.ids_crc32) for r in got if r.doc_id is not None) == sorted((True, i, crc(plain_ids(name, t))) for i, t in texts if i is not None)
    assert sorted(r.ids_crc32 for r in got if r.doc_id is None) == sorted(crc(plain_ids(name, t)) for i, t in texts if i is None)
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == crc(r.ids)
        at += r.n_tokens
    ids = [-2**63 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)


def test_blocks_of_no_documents(spark):
    files = scratch_path(spark, "test-blocks")
    token_blocks.write(spark.createDataFrame([], DOCS), files, tokens.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))
    assert token_blocks.with_starts(token_blocks.read(spark, files)).count() == 0


def test_best_fit_decreasing_equals_linear_search():
    rng = np.random.default_rng(3)
    for window in (1, 7, 64, 100):
        lengths = rng.integers(1, window + 1, 200)
        number, offset, used = packing.best_fit_decreasing(lengths, window)
        room: list[int] = []
        for n in sorted(lengths.tolist(), reverse=True):
            fits = [(r, i) for i, r in enumerate(room) if r >= n]
            if fits:
                room[min(fits)[1]] -= n
            else:
                room.append(window - n)
        assert used == len(room)
        left = sorted(room)
        assert sorted(window - np.bincount(number, weights=lengths, minlength=used).astype(int)) == left
        assert len(set(zip(number.tolist(), offset.tolist()))) == len(lengths)


def test_pieces_cover_every_id_once(spark):
    name, texts = "byte_bpe_50k.json", edge_texts()
    docs = spark.createDataFrame(rows(texts), DOCS).coalesce(1)
    pieces = packing.pack(docs, tokens.read_vocabulary(public_tokenizers.path(name)), window=128, with_ids=True).checkpoint()
    got = pieces.collect()
    by_doc: dict = {}
    for r in got:
        assert 1 <= r.length <= 128 and len(r.ids) == r.length and r.ids_crc32 == crc(r.ids)
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    expected = sorted(crc(plain_ids(name, t)) for _, t in texts)
    found = []
    for (_, n), parts in by_doc.items():
        copies = sum(p.start == 0 for p in parts)
        parts.sort(key=lambda p: p.start)
        assert sum(p.length for p in parts) == copies * n
        found += [crc([x for p in parts[::copies] for x in p.ids])] * copies
    assert sorted(found) == expected
    windows: dict = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append(r)
    for parts in windows.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 128
    total = sum(r.length for r in got)
    assert len(windows) <= -(-total // 128) + 2
    for r in packing.sequences(pieces, 128).collect():
        assert len(r.ids) == (r.n_ids if r.n_ids & (r.n_ids - 1) == 0 else 128)


def test_packing_nothing(spark):
    out = packing.pack(spark.createDataFrame([], DOCS), tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    assert out.count() == 0


def test_queries_encode_special_strings(spark):
    text = "a <|endoftext|> b"
    folder = scratch_path(spark, "test-special")
    spark.createDataFrame(rows([(1, text)]), DOCS).write.parquet(f"{folder}/documents.parquet")
    plain = {n: Tokenizer.from_file(public_tokenizers.path(n)).encode(text, add_special_tokens=False).ids + [1] for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}
    assert [r.ids_crc32 for r in queries.QUERIES["op1_token_blocks"](spark, folder).collect()] == [crc(plain["word_bpe_49k.json"])]
    assert [r.ids_crc32 for r in queries.QUERIES["op3_packing"](spark, folder).collect()] == [crc(plain["byte_bpe_50k.json"])]


def test_bits_of_few_blocks_at_a_time():
    """Round 3's op1: a segment's ids as bits all at once took some 90 bytes an id in every task."""
    import tracemalloc
    ids = np.random.default_rng(5).integers(0, 49_000, 500_000).astype(np.uint32)
    tracemalloc.start()
    data = token_blocks.encode_segment(0, 0, 0, [1], np.array([len(ids)]), ids)
    assert tracemalloc.get_traced_memory()[1] < 30 * len(ids)
    (_, _, _, back), = token_blocks.decode_segments(memoryview(data + token_blocks.TRAILER.encode()))
    assert tracemalloc.get_traced_memory()[1] < 30 * len(ids)
    tracemalloc.stop()
    assert (back == ids).all()
