"""op6 and op9: counts and licence places against plain Python."""

from __future__ import annotations

from collections import Counter

import numpy as np

from autolake.llm import license_scan, quality_rules
from tests.llm.corpus import DOCS, alnum_words, blank_words, edge_texts, mixed_texts, rows


def brute_counts(text):
    w = blank_words(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(w), sum(len(x.decode("utf-8", "surrogatepass")) for x in w), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(again))


def test_counts_equal_brute_force(spark):
    texts = edge_texts() + mixed_texts(1, 60, 30) + [(70, "# a\n#a\n# a\n\n b | c <d> & $5 100%\n# a"), (71, "a b c a b c\na b")]
    docs = spark.createDataFrame(rows(texts), DOCS).repartition(3)
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.with_counts(docs).collect()]
    assert sorted(got, key=repr) == sorted(((i, *brute_counts(t)) for i, t in texts), key=repr)


def test_em_tells_junk_from_clean_and_base_holds(spark):
    clean = [(i, ". ".join(f"Word{(7 * i + j) % 997} then some more text{(i + 31 * j) % 1009} of it" for j in range(20))) for i in range(200)]
    junk = [(1000 + i, " ".join(f"q{((i + 1) * j) % 887}###***" for j in range(1, 120))) for i in range(20)]
    bad = [(2000, "short text"), (2001, "same again here " * 60), (2002, None)]
    counted = quality_rules.with_counts(spark.createDataFrame(rows(clean + junk + bad), DOCS)).checkpoint()
    got = {r.doc_id: r for r in quality_rules.judge(counted).collect()}
    assert all(got[i].kept for i, _ in clean) and not any(got[i].kept for i, _ in junk + bad)
    assert all(got[i].base_failed for i, _ in bad) and not any(got[i].base_failed for i, _ in junk)
    assert quality_rules.judge(quality_rules.with_counts(spark.createDataFrame([], DOCS))).count() == 0


def test_posterior_is_neutral_on_abstention():
    votes = np.array([[-1, -1], [1, 1], [0, 0]])
    prior, weights = quality_rules.fit(votes, np.array([10.0, 80.0, 10.0]))
    p = quality_rules.posterior(votes, prior, weights)
    assert abs(p[0] - prior) < 1e-9 and p[1] > p[0] > p[2]


def test_licence_places_equal_brute_force(spark):
    texts = edge_texts() + [
        (20, "MIT License\nThe mit license, and the MIT-license; mitlicense"), (21, "GNU General Public License"), (22, "Licensed under the Apache License, Version 2.0."),
        (23, "apache"), (24, "license mit"), (25, "ends with general public"), (26, "license of the next text; Licensed under CC BY-NC 4.0"),
        (27, "this work is licenced under the gnu general public license version 3 really"), (28, "licensed under the apache"), (28, "license version 2")]
    docs = spark.createDataFrame(rows(texts), DOCS).coalesce(1)
    got = {}
    for r in license_scan.scan(docs).collect():
        base = [(f.word, f.label) for f in r.found if f.base]
        got.setdefault(r.doc_id, []).append((r.n_words, sorted(base)))
        assert all(0 <= f.score <= 1 for f in r.found)
        if r.doc_id == 22:
            assert {f.label for f in r.found} == {"apache", "apache-2.0"}
        if r.doc_id == 26:
            assert {f.label for f in r.found} == {"cc-by-nc-4.0"}
        if r.doc_id == 27:      # one word differs
            assert {f.label for f in r.found} == {"gpl", "gpl-3.0"}
        if r.doc_id == 28:
            assert not base
    want = {}
    for i, t in texts:
        w = alnum_words(t)
        places = sorted((k, label) for p, label in license_scan.BASE for k in range(len(w)) if w[k:k + len(p.split())] == p.split())
        want.setdefault(i, []).append((len(w), places))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert license_scan.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_full_texts_tags_and_own_templates(spark):
    from autolake.llm import licences
    full = {label: text for text, label, _ in licences.TEMPLATES}
    texts = [(i, f"Copyright 2020 Someone. {text.upper()} end of it") for i, (label, text) in enumerate(sorted(full.items()))]
    # some words behind the key phrase are other ones
    texts += [(100 + i, " ".join(w if k < 40 or k % 12 else "other" for k, w in enumerate(text.split()))) for i, (label, text) in enumerate(sorted(full.items()))]
    texts += [(200 + i, f"// SPDX-License-Identifier: {name}\ncode here") for i, name in enumerate(licences.SPDX)]
    texts += [(300 + i, f"plain words number {i} and more of them") for i in range(40)]
    docs = spark.createDataFrame(rows(texts), DOCS).coalesce(2)
    got = {r.doc_id: {f.label for f in r.found if not f.base} for r in license_scan.scan(docs).collect()}
    for i, label in enumerate(sorted(full)):
        assert label in got[i] and (label in got[100 + i] or label == "bsd-3-clause" or label == "bsd-2-clause"), label
    for i, name in enumerate(licences.SPDX):
        assert f"spdx:{name.lower()}" in got[200 + i]
    assert not any(got[300 + i] for i in range(40))
    own = spark.createDataFrame([("our house licence number nine applies", "house-9", ["house licence number nine"]), (None, "x", ["y"])],
                                "text string, label string, keys array<string>")
    texts = [(1, "Note: our house licence, number nine, applies. MIT license"), (2, "our house licence number ten applies")]
    got = {r.doc_id: {f.label for f in r.found} for r in license_scan.scan(spark.createDataFrame(rows(texts), DOCS), templates=own).collect()}
    assert got == {1: {"house-9", "mit"}, 2: set()}
    assert license_scan.template_table(spark).count() == len(license_scan.ALL)
