"""op2: suffix-array decontamination against a brute-force search."""

from __future__ import annotations

from autolake.llm import decontaminate
from tests.llm.corpus import DOCS, alnum_words, edge_texts, mixed_texts, rows

ITEMS = "item_id long, text string, found string"


def brute(texts, items, window=13):
    wins: dict = {}
    for i, t in items:
        w = alnum_words(t)
        n = min(window, len(w))
        for k in range(max(len(w) - window + 1, 1) if w else 0):
            if i is not None:
                wins.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    out = []
    for d, t in texts:
        w, hit, found = alnum_words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (who := wins.get(tuple(w[k:k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= who
        out.append((d, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def found(docs, bench):
    rows_ = decontaminate.annotate(docs, bench, out="found").select("doc_id", "found", decontaminate.contaminated("found").alias("c")).collect()
    for r in rows_:
        spans = [(s.a, s.b) for s in r.found.spans]
        assert spans == sorted(spans) and r.found.n_hit == sum(b - a for a, b in spans) and r.found.n_items == len(r.found["items"])
        assert r.found.longest <= r.found.n_words
    return sorted(((r.doc_id, r.found.n_words, r.found.n_hit, list(r.found["items"]), r.c) for r in rows_), key=repr)


def corpus():
    texts = mixed_texts(5, 120) + edge_texts()
    items = [(i, t) for i, t in mixed_texts(5, 40)[::4]]
    items += [(100, "w3 W4, w5"), (101, "x"), (102, None), (103, "..."), (None, "w1 w2"), (104, texts[3][1]), (104, texts[3][1]), (9, "x x x x x x x x x x x x x x")]
    return texts, items


def test_equals_brute_force(spark):
    texts, items = corpus()
    docs, bench = spark.createDataFrame(rows(texts), DOCS).repartition(3), spark.createDataFrame([(*i, "f") for i in items], ITEMS)
    assert found(docs, bench) == brute(texts, items)


def test_several_benchmark_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    texts, items = corpus()
    docs, bench = spark.createDataFrame(rows(texts), DOCS), spark.createDataFrame([(*i, "f") for i in items], ITEMS)
    assert len(decontaminate._blocks(bench, "item_id", "text")) > 1
    assert found(docs, bench) == brute(texts, items)


def test_blocks_are_read_in_turn(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 600)
    texts, items = corpus()
    docs, bench = spark.createDataFrame(rows(texts), DOCS), spark.createDataFrame([(*i, "f") for i in items], ITEMS)
    read, at_store = [], []
    collect, stored = type(bench).collect, decontaminate.stored

    def counted(df):
        out = collect(df)
        if df.columns == ["i", "t"] and out:
            read.append(len(out))
        return out

    monkeypatch.setattr(type(bench), "collect", counted)
    monkeypatch.setattr(decontaminate, "stored", lambda *a: at_store.append(len(read)) or stored(*a))
    decontaminate.annotate(docs, bench)
    assert len(read) > 2 and at_store == list(range(2, len(read) + 1))


def test_empty_tables_and_rows_kept(spark):
    texts, items = corpus()
    docs, bench = spark.createDataFrame(rows(texts), DOCS), spark.createDataFrame([(*i, "f") for i in items], ITEMS)
    none, empty = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert found(none, bench) == [] and all(r[2] == 0 for r in found(docs, empty))
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in brute(texts, items) if not r[4]), key=repr)


def test_longest_match(spark):
    text = " ".join(f"b{i}" for i in range(40))
    docs = spark.createDataFrame(rows([(1, "a " + " ".join(f"b{i}" for i in range(5, 25)) + " z")]), DOCS)
    bench = spark.createDataFrame([(1, text, "")], ITEMS)
    r = decontaminate.annotate(docs, bench).first().found
    assert r.longest == 20 and [(s.a, s.b) for s in r.spans] == [(1, 21)]
