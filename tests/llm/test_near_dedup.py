"""op8: near-duplicate classes against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from autolake.llm import near_dedup
from tests.llm.corpus import DOCS, edge_texts, mixed_texts, rows


def brute(texts, percent):
    def shingles(t):
        w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in (t or "").encode().split()]
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    sets = [shingles(t) for _, t in texts]
    ids = [i for i, _ in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in range(len(texts)):
        for b in range(a):
            same = ids[a] is not None and ids[a] == ids[b]
            linked = sets[a] and sets[b] and None not in (ids[a], ids[b]) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
            if same or linked:
                up[root(a)] = root(b)
    group: dict = {}
    for i in range(len(texts)):
        if ids[i] is not None:
            group[root(i)] = min(group.get(root(i), ids[i]), ids[i])
    out = [(d, len(s), None if d is None else group[root(i)]) for i, (d, s) in enumerate(zip(ids, sets))]
    return sorted(out, key=repr)


@pytest.mark.parametrize("percent", [80, 85])
def test_equals_all_pairs(spark, percent):
    texts = mixed_texts(11, 260) + [(i + 1000 if i is not None else None, t) for i, t in edge_texts()]
    docs = spark.createDataFrame(rows(texts), DOCS).repartition(3)
    got = near_dedup.classes(docs, percent=percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(texts, percent)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def copies(seed, n, edits=4, length=80):
    """Near copies of one text, linked by chains."""
    rng = np.random.default_rng(seed)
    base = mixed_texts(2, 1)[0][1] + " " + " ".join(f"base{i}" for i in range(length))
    texts = []
    for i in range(n):
        w = base.split()
        for j in rng.integers(0, len(w), rng.integers(0, edits + 1)):
            w[j] = f"edit{rng.integers(0, 1000)}"
        texts.append((i, " ".join(w)))
    return texts


@pytest.mark.parametrize("block, group, edits", [(4, 3, 6)])
def test_small_groups_give_the_same(spark, block, group, edits):
    texts = [(i, t) for i, (_, t) in enumerate(copies(0, 40, edits) + mixed_texts(4, 20))]
    docs = spark.createDataFrame(rows(texts), DOCS)
    got = near_dedup.classes(docs, block=block, group=group).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(texts, 80)


def test_several_texts_of_one_id(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    texts = [(5, a), (5, b), (9, b + " more"), (3, ""), (7, None), (7, a), (8, a + " x"), (2, "one"), (2, None), (4, "one two"), (1, b), (1, "z " * 30), (0, "z " * 30)]
    for t in (texts, texts[::-1]):
        got = near_dedup.classes(spark.createDataFrame(rows(t), DOCS).repartition(3)).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(t, 80)


def test_ids_of_text(spark):
    a = " ".join(f"a{i}" for i in range(50))
    docs = spark.createDataFrame([("x", a), ("b", a + " tail"), (None, a), ("c", "")], "doc_id string, text string")
    assert sorted((r.doc_id or "", r.component_id, r.kept) for r in near_dedup.classes(docs).collect()) == [
        ("", None, True), ("b", "b", True), ("c", "c", True), ("x", "b", False)]


def test_rows_grow_with_the_members_of_a_group(spark, monkeypatch):
    """One cluster of near copies, far larger than what one task compares: four times the copies
    give about four times the rows of every intermediate table."""
    made = {}

    def counted(df, name):
        out = keep(df, name)
        made[n][name] = made[n].get(name, 0) + out.count()
        return out
    keep = near_dedup.stored
    monkeypatch.setattr(near_dedup, "stored", counted)
    for n in (1000, 4000):
        made[n] = {}
        docs = spark.createDataFrame(rows(copies(3, n, 6, 400)), DOCS).repartition(8)
        got = near_dedup.classes(docs, block=256, group=64)
        assert got.where("component_id = 0").count() > 0.9 * n
    for name, rows_ in made[4000].items():
        assert rows_ <= 6 * made[1000][name] + 200, (name, made[1000][name], rows_)


def test_empty_table(spark):
    assert near_dedup.classes(spark.createDataFrame([], DOCS)).count() == 0


def test_index_finds_every_pair_within_the_distance():
    rng = np.random.default_rng(1)
    for distance in (0, 3, 28, 33):
        a = rng.integers(0, 65536, (50, near_dedup.SIGNATURE)).astype("<u2")
        b = a.copy()
        for row in b:
            at = rng.choice(near_dedup.SIGNATURE, distance, replace=False)
            row[at] ^= 1
        ka, kb = near_dedup.chunk_keys(a, distance), near_dedup.chunk_keys(b, distance)
        assert all(set(x.tolist()) & set(y.tolist()) for x, y in zip(ka, kb))


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 9), (9, 8), (8, 7), (7, 6), (20, 20), (5, 6), (30, 31), (31, 30)]
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, **{i: 5 for i in range(5, 11)}, 30: 30, 31: 30}
