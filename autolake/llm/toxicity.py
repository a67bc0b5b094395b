"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features of a whole text: densities of a learnt lexicon (words, and word beginnings for
inflected forms), the same near second-person words and after undoing letter look-alikes,
capitals, punctuation, obfuscated words and length. The lexicon, the trees and the calibration
are fitted on labelled rows only, at most ``TRAIN_ROWS`` of them, chosen by a hash of their
id; scoring covers every row. Labels, language, source and id are no features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autolake.llm import tokens, words
from autolake.llm.stored import stored

TRAIN_ROWS = 20_000     # labelled rows that the fit may use
LEXICON = 4096          # entries of each lexicon
LEAST_ODDS = 2.5        # smoothed log odds of an entry
LEAST_G = 17.0          # log-likelihood ratio that an entry tells toxic from clean texts
FOLDS = 5               # fold 0 is held out, CALIBRATION for isotonic regression, the rest for the trees
CALIBRATION = 4
SLICE_BYTES = 1 << 20   # text looked at at once; its features take some 40 times as much memory
NEAR = 6                # words between an entry and a second-person word
PREFIXES = (4, 5, 6)    # bytes of word beginnings

# fixed values: second-person words in English, French, German and Spanish
SECOND_PERSON = ("you", "your", "yours", "yourself", "tu", "toi", "te", "vous", "ton", "ta", "tes", "votre", "vos",
                 "du", "dich", "dir", "dein", "deine", "ihr", "euch", "usted", "ustedes", "tus", "vosotros")
# fixed values: look-alike characters and the letters they stand for
LOOK_ALIKES = {"@": "a", "$": "s", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}

CORE_G = 40.0           # of a core entry: beyond what a few copies of one text can make

FEATURES = ("core", "core_hits", "lex", "lex_hits", "stem", "stem_hits", "near_you", "unmasked", "caps", "caps_words", "bangs", "marks", "mixed", "length", "word_size")


def _table(extra: dict[str, str]) -> bytes:
    out = bytearray(words.ALNUM)
    for c, letter in extra.items():
        out[ord(c)] = ord(letter)
    return bytes(out)


_UNMASK = _table(LOOK_ALIKES)
_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[[b for b in range(256) if words.ALNUM[b] != 32]] = True


def _hash_words(listed: tuple[str, ...]) -> np.ndarray:
    return np.sort(words.word_hashes(pa.array([" ".join(listed)]))[0])


_YOU = _hash_words(SECOND_PERSON)


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table) or not len(values):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


@dataclass
class Lexicon:
    """Sorted hashes of words and of word beginnings, and those of either that are core entries."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    stems: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    core_words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    core_stems: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))


def _tokens(texts: pa.Array, table: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Word hashes, text bounds, hashes of the beginnings (0 where a word is no longer), bytes and begins."""
    raw, begins = words.joined(texts, table)
    starts, ends, bounds = words.word_spans(raw, begins)
    stems = []
    for n in PREFIXES:
        long = ends - starts > n
        h = np.zeros(len(starts), np.uint64)
        h[long] = words.hashed(raw, starts[long], starts[long] + n)
        stems.append(h)
    return words.hashed(raw, starts, ends), bounds, stems, raw, begins


def features(texts: pa.Array, lexicon: Lexicon) -> dict[str, np.ndarray]:
    """FEATURES of each text; densities are per word, 0 for texts without words."""
    hashes, bounds, stems, _, _ = _tokens(texts, words.ALNUM)
    n = np.diff(bounds)
    some = np.maximum(n, 1)
    doc = np.repeat(np.arange(len(n)), n)
    per = lambda mask, d=doc: np.bincount(d[mask], minlength=len(n))
    hit = _in(hashes, lexicon.words)
    stem = np.any([_in(s, lexicon.stems) for s in stems], axis=0) if len(hashes) else hit
    core = _in(hashes, lexicon.core_words) | (np.any([_in(s, lexicon.core_stems) for s in stems], axis=0) if len(hashes) else hit)
    you = np.flatnonzero(_in(hashes, _YOU))
    any_hit = np.flatnonzero(hit | stem)
    near = np.zeros(len(any_hit), bool)
    if len(you) and len(any_hit):
        for k in (-1, 0):
            other = you[np.clip(np.searchsorted(you, any_hit) + k, 0, len(you) - 1)]
            near |= (np.abs(other - any_hit) <= NEAR) & (doc[other] == doc[any_hit])
    unmasked, ubounds, ustems, _, _ = _tokens(texts, _UNMASK)
    udoc = np.repeat(np.arange(len(n)), np.diff(ubounds))
    uhit = _in(unmasked, lexicon.words) | np.any([_in(s, lexicon.stems) for s in ustems], axis=0) if len(unmasked) else np.zeros(0, bool)
    raw, begins = words.joined(texts)
    total = lambda flags: np.diff(np.r_[0, np.cumsum(flags)][begins])
    upper, lower = (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122)
    letters = np.maximum(total(upper | lower | (raw >= 128)), 1)
    starts, ends, blank_bounds = words.word_spans(raw, begins)
    of_word = lambda flags: (lambda c: c[ends] - c[starts])(np.r_[0, np.cumsum(flags)])
    wdoc = np.repeat(np.arange(len(n)), np.diff(blank_bounds))
    ups, lows = of_word(upper), of_word(lower | (raw >= 128))
    odd = of_word(((raw >= 48) & (raw <= 57)) | np.isin(raw, np.frombuffer(b"@$*#%&", np.uint8)))
    return {
        "core": per(core) / some, "core_hits": np.minimum(per(core), 20), "lex": per(hit) / some, "lex_hits": np.minimum(per(hit), 20), "stem": per(stem) / some, "stem_hits": np.minimum(per(stem), 20),
        "near_you": np.bincount(doc[any_hit[near]], minlength=len(n)) / some,
        "unmasked": np.maximum(per(uhit, udoc) - per(hit | stem), 0) / some,
        "caps": total(upper) / letters, "caps_words": per((ups > 1) & (lows == 0), wdoc) / some,
        "bangs": total(raw == 33) / some, "marks": total((raw > 32) & (raw < 128) & ~_WORD_BYTES[raw]) / some,
        "mixed": per((odd > 0) & (ups + lows > 0), wdoc) / some,
        "length": np.log1p(n), "word_size": letters / some,
    }


def with_features(docs: DataFrame, lexicon: Lexicon, id_col: str, text_col: str, *keep: str) -> DataFrame:
    """``keep`` columns and FEATURES (double) of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(lexicon)
    cols = [F.col(c).alias(f"k{i}") for i, c in enumerate((id_col, *keep))]
    slim = docs.select(*cols, F.col(text_col).alias("text"))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]] + [f"{c} double" for c in FEATURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch in batches:
            for rows in words.slices(batch, "text", SLICE_BYTES):
                found = features(rows.column("text"), shipped.value)
                yield pa.RecordBatch.from_arrays(rows.columns[:-1] + [pa.array(np.asarray(found[c], np.float64)) for c in FEATURES],
                                                 rows.schema.names[:-1] + list(FEATURES))

    out = slim.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate((id_col, *keep))], *FEATURES)


def fold(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


def learn_lexicon(train: DataFrame) -> Lexicon:
    """Words and word beginnings whose log odds of a toxic text are high, from (text, toxic) rows.

    Texts are counted per token within each task before the shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch in batches:
            for rows in words.slices(batch, "text", SLICE_BYTES):
                hashes, bounds, stems, _, _ = _tokens(rows.column("text"), words.ALNUM)
                doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                toxic = rows.column("toxic").to_numpy()[doc]
                for kind, values in [(0, hashes)] + [(1, s) for s in stems]:
                    used = values != 0
                    salt = words.mix(doc[used].astype(np.uint64) + np.uint64(1))
                    _, first = np.unique(values[used] ^ salt, return_index=True)
                    v, y = values[used][first], toxic[used][first]
                    token, inverse = np.unique(v, return_inverse=True)
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array(np.full(len(token), kind, np.int32)), "token": pa.array(token.view(np.int64)),
                        "t": pa.array(np.bincount(inverse, weights=y, minlength=len(token)).astype(np.int64)),
                        "c": pa.array(np.bincount(inverse, weights=1 - y, minlength=len(token)).astype(np.int64))})

    sizes = train.groupBy("toxic").count().collect()
    toxic = sum(r["count"] for r in sizes if r["toxic"] == 1)
    clean = sum(r["count"] for r in sizes if r["toxic"] == 0)
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    share = F.lit(toxic / (toxic + clean))
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    both = F.col("t") + F.col("c")
    g = 2 * (part(F.col("t"), both * share) + part(F.col("c"), both * (1 - share)))
    found = (train.select("text", "toxic").mapInArrow(count, "kind int, token long, t long, c long")
             .groupBy("kind", "token").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
             .withColumn("g", g).where((odds >= LEAST_ODDS) & (F.col("g") >= LEAST_G)))
    rows = [r for kind in (0, 1) for r in found.where(F.col("kind") == kind).orderBy(F.col("g").desc(), "token").limit(LEXICON).collect()]
    pick = lambda kind, least: np.sort(np.array([r["token"] for r in rows if r["kind"] == kind and r["g"] >= least], np.int64).view(np.uint64))
    return Lexicon(pick(0, LEAST_G), pick(1, LEAST_G), pick(0, CORE_G), pick(1, CORE_G))


@dataclass
class Model:
    lexicon: Lexicon
    trees: object = None
    calibration: object = None
    rate: float = 0.0       # score where nothing could be fitted


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rows: int = TRAIN_ROWS, rounds: int = 20, depth: int = 4) -> Model:
    """Lexicon and trees from the training folds, isotonic calibration from fold CALIBRATION.

    ``docs`` are read for the labelled rows alone. A row's label is the largest of its labels;
    null labels and ids are skipped. Without rows of both labels the model gives the share of
    toxic ones (0 without any) as every score.
    """
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id is not null and toxic is not null")
             .groupBy("id").agg(F.max("toxic").alias("toxic")).where(fold("id") != 0)
             .orderBy(F.xxhash64("id"), "id").limit(rows))     # the documented bound of the fit
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = stored(texts.join(F.broadcast(known), "id").withColumn("fold", fold("id")), "tox-sample")     # at most ``rows`` labels are shipped
    train, held = sample.where(F.col("fold") != CALIBRATION), sample.where(F.col("fold") == CALIBRATION)
    counts = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    if not (counts.get(0) and counts.get(1)):
        return Model(Lexicon(), rate=float(bool(counts.get(1))))
    lexicon = learn_lexicon(train)
    table = stored(with_features(sample, lexicon, "id", "text", "toxic", "fold"), "tox-features")
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7,
                          maxBins=64).fit(ready.where(F.col("fold") != CALIBRATION).coalesce(4))
    raw = trees.transform(ready.where(F.col("fold") == CALIBRATION)).select(
        F.col("toxic").cast("double").alias("label"), vector_to_array("probability")[1].alias("raw"))
    both = held.agg(F.countDistinct("toxic")).first()[0] == 2
    calibration = IsotonicRegression(featuresCol="raw_vector", labelCol="label", predictionCol="score").fit(
        VectorAssembler(inputCols=["raw"], outputCol="raw_vector").transform(raw)) if both else None
    return Model(lexicon, trees, calibration)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *keep: str) -> DataFrame:
    """``id_col``, ``keep`` columns, score (0 to 1) and predicted (1 if score >= 0.5) of every row.

    Null, empty and wordless texts are scored by their zero features; null ids and repeated
    rows like others; an empty table gives no rows.
    """
    table = with_features(docs, model.lexicon, id_col, text_col, *keep)
    names = [id_col, *keep]
    if model.trees is None:
        out = table.select(*names, F.lit(model.rate).alias("score"))
    else:
        own = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
            table.select(F.struct(*names).alias("row"), *FEATURES))
        out = model.trees.transform(own).select("row", vector_to_array("probability")[1].alias("raw"))
        if model.calibration is None:
            out = out.withColumnRenamed("raw", "score")
        else:
            out = model.calibration.transform(VectorAssembler(inputCols=["raw"], outputCol="raw_vector").transform(out))
        out = out.select("row.*", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
