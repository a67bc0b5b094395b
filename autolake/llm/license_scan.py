"""Licence scan with a positional index of rare template words.

A template is a word sequence with a label and mandatory key phrases. Document frequencies of
the templates' words are counted over the whole corpus; a template is entered in the index
under its rarest words that occur at all, each with its place in the template (a posting).
In a file, an occurrence of an indexed word proposes, by relative position, where a template
would begin; proposals that enough rare words agree on are aligned word by word and accepted
if the IDF-weighted share of matching words is high enough and a key phrase stands whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autolake.llm import licences, words


def _words(name: str) -> str:
    return name.lower().replace("-", " ").replace(".", " ")


# fixed values: base phrases and labels
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# fixed values: licence wordings, their labels, and the key phrases of which one must stand whole
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0", ("apache license",)),
    ("licensed under the gnu general public license version 3", "gpl-3.0", ("general public license version 3",)),
    ("licensed under the gnu general public license version 2", "gpl-2.0", ("general public license version 2",)),
    ("licensed under the gnu lesser general public license", "lgpl", ("lesser general public license",)),
    ("licensed under the gnu affero general public license", "agpl", ("affero general public license",)),
    ("released under the mit license", "mit-notice", ("mit license",)),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0", ("cc by nc 4 0",)),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0", ("cc by sa 4 0",)),
    ("licensed under cc by 4 0", "cc-by-4.0", ("cc by 4 0",)),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     "mit-text", ("permission is hereby granted free of charge",)),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     "bsd-text", ("redistribution and use in source and binary forms",)),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "isc-text", ("permission to use copy modify",)),
    ("this is free and unencumbered software released into the public domain", "unlicense", ("unencumbered software",)),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0", ("mozilla public license",)),
)

# the short wordings, the full texts and headers, and a template per SPDX tag
ALL = (*TEMPLATES, *licences.TEMPLATES, *((f"spdx license identifier {_words(i)}", f"spdx:{i.lower()}", (f"spdx license identifier {_words(i)}",))
                                         for i in licences.SPDX))

RARE = 3            # index words of one template, and one more for so many of its words
WORDS_PER_RARE = 20
MAX_TEMPLATES = 10_000
SHARE = 0.8         # IDF-weighted share of a template's words that must match


@dataclass
class Index:
    vocabulary: np.ndarray      # sorted word hashes
    templates: list             # (codes, label, weights, key phrase places, base)
    postings: list              # (template, code, place): the index
    needed: list                # per template, rare words that must agree


def _split(texts) -> list[np.ndarray]:
    hashes, bounds = words.word_hashes(pa.array(list(texts), pa.string()), words.ALNUM)
    return [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def vocabulary(templates) -> np.ndarray:
    return np.unique(np.concatenate(_split([p for p, _ in BASE] + [t for t, _, _ in templates])))


def template_table(spark: SparkSession, templates=ALL) -> DataFrame:
    """Templates as a table (text, label, keys), to be kept, edited and given to ``scan``."""
    return spark.createDataFrame([(t, label, list(keys)) for t, label, keys in templates], "text string, label string, keys array<string>")


def _codes(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Number of each word in the vocabulary, -1 for others."""
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return np.where(table[at] == hashes, at, -1)


def build_index(templates, frequency: np.ndarray, n_docs: int) -> Index:
    """``frequency``: documents that hold each vocabulary word."""
    table = vocabulary(templates)
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1
    entered, postings, needed = [], [], []
    listed = [(p, label, (p,), True) for p, label in BASE] + [(*t, False) for t in templates]
    for number, (text, label, keys, base) in enumerate(listed):
        codes = _codes(_split([text])[0], table)
        places = []
        for key in keys:
            k = _codes(_split([key])[0], table)
            at = [i for i in range(len(codes) - len(k) + 1) if len(k) and (codes[i:i + len(k)] == k).all()]
            if not at:
                raise ValueError(f"key phrase {key!r} is not in the text of {label!r}")
            places.append(np.arange(at[0], at[0] + len(k)))
        order = [i for i in np.argsort(-idf[codes], kind="stable").tolist() if frequency[codes[i]]]
        # a whole phrase holds its rarest word: one place is enough to find all of its occurrences
        rare = order[:1 if base else RARE + len(codes) // WORDS_PER_RARE]
        if base and len(order) < len(codes):
            rare = []           # a word of the phrase is nowhere
        postings += [(number, int(codes[i]), i) for i in rare]
        needed.append(max(1, min(2, len(rare))))
        entered.append((codes, label, idf[codes] / idf[codes].sum(), places, base))
    return Index(table, entered, postings, needed)


def frequencies(docs: DataFrame, templates) -> tuple[np.ndarray, int]:
    """Documents that hold each vocabulary word, and all documents; one pass over ``text``."""
    table = vocabulary(templates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(len(table), np.int64), 0
        for batch in batches:
            for rows in words.slices(batch, "text"):
                hashes, bounds = words.word_hashes(rows.column("text"), words.ALNUM)
                code = _codes(hashes, table)
                doc = np.repeat(np.arange(rows.num_rows), np.diff(bounds))
                pair = np.unique(doc[code >= 0] * len(table) + code[code >= 0])
                found += np.bincount(pair % len(table), minlength=len(table))
                n += rows.num_rows
        yield pa.RecordBatch.from_pydict({"code": pa.array(np.arange(-1, len(table))), "n": pa.array(np.r_[n, found])})

    # one row per vocabulary word comes back
    rows = docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    totals = {r["code"]: r["n"] for r in rows}
    return np.array([totals.get(i, 0) for i in range(len(table))]), totals.get(-1, 0)


def matches(hashes: np.ndarray, bounds: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word in the text, template, score) of every accepted place."""
    code = _codes(hashes, index.vocabulary)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    indexed = np.zeros(len(index.vocabulary) + 1, bool)     # the last one stands for words of no template
    indexed[[c for _, c, _ in index.postings]] = True
    held = np.flatnonzero(indexed[code])
    by_code = held[np.argsort(code[held], kind="stable")]
    sorted_codes = code[by_code]
    out = []
    for number, (codes, _, weight, places, base) in enumerate(index.templates):
        starts = [by_code[np.searchsorted(sorted_codes, c):np.searchsorted(sorted_codes, c, "right")] - i for t, c, i in index.postings if t == number]
        if not starts:
            continue
        start, votes = np.unique(np.concatenate(starts), return_counts=True)
        start = start[votes >= index.needed[number]]
        if not len(start):
            continue
        # the template may overhang a text's ends; those places do not match
        at = start[:, None] + np.arange(len(codes))
        inside = np.clip(at, 0, len(code) - 1)
        anchor = index.postings[[p[0] for p in index.postings].index(number)][2]
        own = doc[np.clip(start + anchor, 0, len(code) - 1)]
        same = (code[inside] == codes) & (at >= 0) & (at < len(code)) & (doc[inside] == own[:, None])
        score = (same * weight).sum(1)
        whole = np.any([same[:, p].all(1) for p in places], axis=0)
        good = whole & (same.all(1) if base else score >= SHARE)
        first = np.maximum(start[good], bounds[own[good]])
        out.append((own[good], first - bounds[own[good]], np.full(good.sum(), number), np.where(same[good].all(1), 1.0, score[good])))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


_FOUND = ("n_words long, found array<struct<label:string,word:bigint,base:boolean,score:double>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: DataFrame | None = None) -> DataFrame:
    """``id_col``, n_words and found: label, first word, base and score of every licence place.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Null or wordless
    texts: no words, nothing found. Null ids and repeated rows are scanned like others. An empty
    table gives no rows. Places overlap freely: each template's are found on their own.

    ``templates``: a table (text, label, keys), read on the driver (at most ``MAX_TEMPLATES`` rows, more is an
    error), beside the base phrases; without one, ``ALL``. A key must stand in its text; rows with a null go.
    """
    listed = ALL
    if templates is not None:
        found = templates.select("text", "label", "keys").dropna().limit(MAX_TEMPLATES + 1).collect()
        if len(found) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        listed = [(r["text"], r["label"], tuple(r["keys"])) for r in sorted(found)]
    kind = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    index = build_index(listed, *frequencies(slim, listed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in words.slices(batch, "text"):
                hashes, bounds = words.word_hashes(rows.column("text"), words.ALNUM)
                found = [[] for _ in range(rows.num_rows)]
                if len(hashes):
                    for d, w, t, s in zip(*(x.tolist() for x in matches(hashes, bounds, index))):
                        found[d].append({"label": index.templates[t][1], "word": w, "base": index.templates[t][4], "score": min(s, 1.0)})
                yield pa.RecordBatch.from_pydict({"id": rows.column("id"), "n_words": pa.array(np.diff(bounds)), "found": pa.array(found, _LIST)})

    return slim.mapInArrow(run, f"id {kind}, {_FOUND}").withColumnRenamed("id", id_col)


_LIST = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]))
