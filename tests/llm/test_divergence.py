"""op11: source divergence audit against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from autolake.llm import divergence
from tests.llm.corpus import edge_texts

DOCS = "doc_id long, text string, lang string, source string, term string, n int, size string, left string, number string, value int"


def rows(docs):
    return [(i, t, lang, source, "t", 1, "s", None, "x", 7) for i, (t, lang, source) in enumerate(docs)]


def plain(docs, min_docs, ranks):
    found = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")))
             for t, lang, source in docs]
    n_docs, counts, per_lang = Counter(), defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for lang, source, terms in found:
        groups[lang].add(source)
        n_docs.update((lang, t) for t in set(terms))
    for lang, source, terms in found:
        keep = [t for t in terms if n_docs[lang, t] >= min_docs]
        counts[lang, source].update(keep)
        per_lang[lang].update(keep)
    out = []
    for lang, sources in groups.items():
        vocabulary = sorted(per_lang[lang], key=str.encode)
        size = 2 * len(vocabulary)
        share = lambda c: {t: 1 + 10 ** 9 * (c[t] + 2) // (sum(c.values()) + size) for t in vocabulary}
        score = lambda p, q: (p - q) ** 2 // (p + q)
        whole, own = share(per_lang[lang]), {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum(score(own[s][t], own[o][t]) for t in vocabulary)) for o in sources if o != s]
            terms = [(t, score(own[s][t], whole[t])) for t in vocabulary if counts[lang, s][t] and own[s][t] > whole[t]]
            for part, items, top in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items[:top])]
    return sorted(out)


def random_docs(seed, n=400):
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ["a", "B", "é", "zz", "中", "\U0001F600x", "~q"] for b in "abcdefghij"]
    docs = []
    for _ in range(n):
        source = rnd.choice(["s0", "s0", "s0", "s1", "S2", "é", "", None, "s3"])
        weight = [1 + 5 * ((len(source or "") * 7 + k * 5) % 3) for k in range(len(vocabulary))]
        text = " ".join(rnd.choices(vocabulary, weight, k=rnd.randrange(0, 40)))
        docs.append((text, rnd.choice(["en", "en", "de", None, ""]), source))
    return docs


@pytest.mark.parametrize("seed, block, terms", [(1, 256, 512), (2, 2, 3), (3, 1, 1)])
def test_as_plain_python(spark, seed, block, terms):
    docs = random_docs(seed) + [(t, "xx", f"e{i % 3}") for i, (_, t) in enumerate(edge_texts() * 4) if t is None or len(t) < 100_000]
    docs += [("only here", "yy", "one")] * 12 + [("too rare", "ww", "a"), ("", "ww", "b"), (None, "vv", "none")]
    # many terms tied in one cell
    docs += [(" ".join(f"tie{chr(97 + k)}" for k in range(26)), "tt", s) for s in ["p"] * 11 + ["q"] * 3] + [("tiea", "tt", "q")]
    df = spark.createDataFrame(rows(docs), DOCS).repartition(4)
    assert sorted(map(tuple, divergence.audit(df, min_docs=3, block=block, step=terms).collect())) == plain(docs, 3, 10)


def test_registered_defaults(spark):
    docs = random_docs(9, 300)
    df = spark.createDataFrame(rows(docs), DOCS)
    got = divergence.audit(df)
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    assert sorted(map(tuple, got.collect())) == plain(docs, 10, 10)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_exact_arithmetic(spark):
    n = [0, 1, 7, 10 ** 6, 123456789012, 10 ** 13 - 1]
    size = 2 * 10 ** 13 + 12345
    df = spark.createDataFrame([(x,) for x in n], "n long").withColumn("size", F.lit(size))
    want = [1 + 10 ** 9 * (x + 2) // size for x in n]
    p = [r.p for r in df.select(divergence.share(F.col("n"), F.col("size")).alias("p")).collect()]
    assert p == want == divergence._shares(np.array(n), np.array([size])).tolist()
    pairs = [(a, b) for a in [1, 2, 999_999_999, 10 ** 9 + 1] for b in [1, 3, 500_000_001, 10 ** 9 + 1]]
    got = spark.createDataFrame(pairs, "p long, q long").select(divergence.score(F.col("p"), F.col("q")).alias("f")).collect()
    assert [r.f for r in got] == [(a - b) ** 2 // (a + b) for a, b in pairs]
