"""op7: repeated windows against counting all windows."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from autolake.llm import substring_dedup
from tests.llm.corpus import DOCS, blank_words, edge_texts, mixed_texts, rows


def brute(texts, window):
    split = [blank_words(t) for _, t in texts]
    count = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(texts, split):
        gone = {j for i in range(len(w) - window + 1) if count[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        out.append((d, len(w), len(gone), [x for j, x in enumerate(w) if j not in gone]))
    return sorted(out, key=repr)


def found(docs, window, group=substring_dedup.GROUP, **more):
    got = substring_dedup.remove_repeats(docs, window=window, group=group, **more)
    assert got.columns == [*docs.columns, "repeats"]
    return sorted(((r.doc_id, r.repeats.n_words, r.repeats.n_removed, blank_words(r.text)) for r in got.collect()), key=repr)


@pytest.mark.parametrize("group, max_bits", [(1, 1 << 27), (200_000, 1 << 27), (150, 64), (2000, 1024)])
def test_equals_counting_all_windows(spark, group, max_bits):
    """Groups through automata, by counting, and mixed; filters that tell keys apart, few, and none."""
    texts = mixed_texts(3, 150) + edge_texts()
    docs = spark.createDataFrame(rows(texts), DOCS).repartition(3)
    assert found(docs, 35, group, max_bits=max_bits) == brute(texts, 35)


def test_dense_repeats_in_few_words(spark):
    rnd = random.Random(4)
    texts = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randrange(0, 60)))) for i in range(80)]
    docs = spark.createDataFrame(rows(texts), DOCS)
    assert found(docs, 14, 3) == brute(texts, 14) and found(docs, 13) == brute(texts, 13)
    periodic = [(1, "a b c " * 30), (2, " ".join(map(str, range(50)))), (3, "z " * 36 + "y")]
    assert found(spark.createDataFrame(rows(periodic), DOCS), 35) == brute(periodic, 35)


def test_rest_of_the_text_stays_as_it_is(spark):
    shared = " ".join(f"s{i}" for i in range(40))
    docs = spark.createDataFrame(rows([(1, f"Head\n\tline {shared}\n tail  end "), (2, f"{shared} x")]), DOCS)
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == {1: "Head\n\tline tail  end", 2: "x"}


def test_empty_table(spark):
    assert found(spark.createDataFrame([], DOCS), 35) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=25), min_size=1, max_size=6))
def test_automaton_counts_occurrences(sequences):
    automaton = substring_dedup.SuffixAutomaton()
    for s in sequences:
        automaton.add(s, 1)
    automaton.close()
    count = Counter(tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1))
    for s in sequences:
        for end, length in enumerate(automaton.repeated(s), 1):
            best = max((n for n in range(1, end + 1) if count[tuple(s[end - n:end])] > 1), default=0)
            assert length == best
