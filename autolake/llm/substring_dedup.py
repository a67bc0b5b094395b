"""Removal of repeated passages with suffix automata over reference shards.

A window of ``window`` words is repeated if its word sequence starts at two or more places.
All equal windows share the smallest hash among their ``ANCHOR``-word runs, their minimizer. So
every text is cut into pieces, runs of consecutive windows of one minimizer, and equal windows
of any documents meet in pieces of one minimizer. Only minimizers seen at two places matter;
pieces with equal words are counted, not compared. What remains are different pieces of one
minimizer: they are the reference shards. A task builds a suffix automaton of each of its
shards, with occurrence counts, and streams the single pieces through it: where the longest
suffix that occurs twice reaches ``window`` words, a repeated window ends.

A shard holds whole minimizer groups. A group of more than ``GROUP`` words of different pieces (a
passage in very many documents, each with its own words before and after) is not gathered: its
windows are counted by hash instead, with partial sums before the shuffle.

Filters of the minimizers and texts that matter spare shuffles; they have a fixed largest size
and what passes them is joined exactly, so the steps are the same at every size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autolake.llm import key_filter, words
from autolake.llm.stored import stored

WINDOW = 35
ANCHOR = 12
GROUP = 200_000         # words of one minimizer's different pieces that an automaton takes
SHARD_WORDS = 20_000    # words after which a shard is closed (groups stay whole)

_PIECE = "g long, c long, key long, start int, windows int, anchors int"


class SuffixAutomaton:
    """Generalised suffix automaton of several word sequences with weighted occurrence counts."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def add(self, sequence: list[int], weight: int) -> None:
        last = 0
        for word in sequence:
            last = self._extend(last, word)
            self.count[last] += weight

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.link) - 1

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, word, known)
        state = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, word, q)
        return state

    def _clone(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.next[q].copy(), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def close(self) -> None:
        """Carry counts to suffixes; call once, after the last ``add``."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[s]] += self.count[s]

    def repeated(self, sequence: list[int]) -> list[int]:
        """Per word, the length of the longest suffix ending there that occurs twice or more."""
        out, state, length = [], 0, 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            while state and self.count[state] < 2:
                state = self.link[state]
                length = self.length[state]
            out.append(length)
        return out


def _sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    out, n = values, 1
    while 2 * n <= size:
        out, n = np.minimum(out[:-n], out[n:]), 2 * n
    return np.minimum(out[:len(out) - (size - n)], out[size - n:]) if size > n else out


def _sums(hashes: np.ndarray) -> np.ndarray:
    prefix = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * words._powers(words._BASE, len(hashes)), out=prefix[1:])
    return prefix


def pieces(hashes: np.ndarray, bounds: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Pieces of the texts: text number, first word (within the text), windows, minimizer g, content hash c, and
    the places in the piece at which its minimizer stands (two or more: windows may repeat within it)."""
    anchor = min(ANCHOR, window)
    span = window - anchor + 1
    at = words.window_starts(bounds, window)
    if not len(at):
        return {k: np.zeros(0, np.int64) for k in ("doc", "start", "windows", "anchors")} | {k: np.zeros(0, np.uint64) for k in ("g", "c")}
    runs = words.window_hashes(hashes, anchor)
    least = _sliding_min(runs, span)[at]
    doc = np.searchsorted(bounds, at, "right") - 1
    first = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])])
    n = np.diff(np.r_[first, len(at)])
    begin, g = at[first], least[first]
    wide = n + span - 1
    before = np.cumsum(wide) - wide
    inside = np.repeat(begin - before, wide) + np.arange(wide.sum())
    anchors = np.add.reduceat((runs[inside] == np.repeat(g, wide)).astype(np.int64), before)
    sums = _sums(hashes)
    c = words.mix((sums[begin + n + window - 1] - sums[begin]) * words._powers(words._INVERSE, len(hashes))[begin])
    return {"doc": doc[first], "start": begin - bounds[doc[first]], "windows": n, "anchors": anchors, "g": g, "c": c}


def _ranges(offsets: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Covered [a, b) ranges of windows starting at ascending offsets."""
    if not len(offsets):
        return []
    cut = np.flatnonzero(np.diff(offsets) > window)
    a, b = offsets[np.r_[0, cut + 1]], offsets[np.r_[cut, len(offsets) - 1]] + window
    return list(zip(a.tolist(), b.tolist()))


def _shard_ranges(shard: list[tuple], window: int) -> pa.RecordBatch:
    automaton = SuffixAutomaton()
    for _, _, n, sequence in shard:
        automaton.add(sequence, n)
    automaton.close()
    out = {"g": [], "c": [], "a": [], "b": []}
    for g, c, n, sequence in shard:
        if n == 1:
            ends = np.flatnonzero(np.array(automaton.repeated(sequence)) >= window)
            for a, b in _ranges(ends - window + 1, window):
                for k, v in zip(out, (g, c, a, b)):
                    out[k].append(v)
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64() if k in "gc" else pa.int32()) for k, v in out.items()})


def repeated_spans(docs: DataFrame, window: int = WINDOW, group: int = GROUP, max_bits: int = key_filter.MAX_BITS) -> DataFrame:
    """(id, key, spans): the word ranges [a, b) under repeated windows of every text that has any.

    ``docs``: id, text, key (a hash of both, to tell rows of one id apart).
    """
    def cut(batches: Iterator[pa.RecordBatch], keep=None, light: bool = False) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in words.slices(batch, "text"):
                p = pieces(*words.word_hashes(rows.column("text")), window)
                if light:
                    yield pa.RecordBatch.from_pydict({"g": pa.array(p["g"].view(np.int64)), "anchors": pa.array(p["anchors"])})
                    continue
                mask = keep.value(p["g"])
                p = {k: v[mask] for k, v in p.items()}
                doc = pa.array(p["doc"])
                yield pa.RecordBatch.from_pydict({
                    "g": pa.array(p["g"].view(np.int64)), "c": pa.array(p["c"].view(np.int64)), "key": rows.column("key").take(doc),
                    **{k: pa.array(p[k].astype(np.int32)) for k in ("start", "windows", "anchors")}, "id": rows.column("id").take(doc)})

    kind = docs.schema["id"].dataType.simpleString()
    sc = docs.sparkSession.sparkContext
    # minimizers at two places or more, and their pieces
    seen = docs.select("text").mapInArrow(lambda b: cut(b, light=True), "g long, anchors long")
    often = stored(seen.groupBy("g").agg(F.sum("anchors").alias("n")).where("n > 1").select("g"), "span-often")
    keep = sc.broadcast(key_filter.build(often, "g", max_bits))
    cut_rows = docs.select("id", "key", "text").mapInArrow(lambda b: cut(b, keep), f"{_PIECE}, id {kind}")
    found = stored(cut_rows, "span-pieces")     # with a few pieces of minimizers seen once: they go with the groups
    contents = stored(found.groupBy("g", "c").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "id", "start", "windows")).alias("at"), F.max("anchors").alias("anchors")), "span-contents")
    size = F.sum(F.col("at.windows") + window - 1).alias("k")
    # stored, so that the join shuffles both sides and a hot minimizer's pieces can be split
    groups = stored(contents.groupBy("g").agg(size, F.count("*").alias("pieces"), F.min("n").alias("least"), F.max("anchors").alias("most")).where(
        "least = 1 and (pieces > 1 or most > 1)").drop("least", "most", "pieces"), "span-groups")

    # words of the pieces that an automaton is needed for: texts that hold one, read once more
    wanted = stored(contents.join(groups, "g").select("g", "c", "n", "k", "at.*")
                     .groupBy("key", "id").agg(F.collect_list(F.struct("g", "c", "n", "k", "start", "windows")).alias("pieces")), "span-wanted")
    holds = sc.broadcast(key_filter.build(wanted, "key", max_bits))

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = holds.value(batch.column("key").to_numpy().view(np.uint64))
            yield batch.filter(pa.array(mask))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in words.slices(batch, "text"):
                hashes, bounds = words.word_hashes(rows.column("text"))
                raw = hashes.astype("<u8", copy=False)
                out = {"g": [], "c": [], "n": [], "k": [], "words": []}
                for begin, listed in zip(bounds[:-1].tolist(), rows.column("pieces").to_pylist()):
                    for p in listed:
                        a = begin + p["start"]
                        for k in ("g", "c", "n", "k"):
                            out[k].append(p[k])
                        out["words"].append(raw[a:a + p["windows"] + window - 1].tobytes())
                yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "words" else pa.int64()) for k, v in out.items()})

    texts = docs.select("id", "key", "text")
    texts = texts.mapInArrow(holding, texts.schema)
    spelled = stored(texts.join(wanted.withColumnRenamed("id", "own"), (F.col("own").eqNullSafe(F.col("id"))) & (texts["key"] == wanted["key"]))
                      .select("text", "pieces").mapInArrow(spell, "g long, c long, n long, k long, words binary"), "span-words")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size, last = [], 0, None
        for batch in batches:
            for g, c, n, raw in zip(*(batch.column(k).to_pylist() for k in ("g", "c", "n", "words"))):
                if g != last and size > SHARD_WORDS:
                    yield _shard_ranges(shard, window)
                    shard, size = [], 0
                sequence = np.frombuffer(raw, "<u8").tolist()
                shard.append((g, c, n, sequence))
                size, last = size + len(sequence), g
        if shard:
            yield _shard_ranges(shard, window)

    def unroll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, c, n, raw in zip(*(batch.column(k).to_pylist() for k in ("g", "c", "n", "words"))):
                h = words.window_hashes(np.frombuffer(raw, "<u8").astype(np.uint64), window)
                m = len(h)
                yield pa.RecordBatch.from_pydict({"g": pa.array([g] * m, pa.int64()), "c": pa.array([c] * m, pa.int64()), "n": pa.array([n] * m, pa.int64()),
                                                  "a": pa.array(np.arange(m, dtype=np.int32)), "h": pa.array(h.view(np.int64))})

    small, large = spelled.where(F.col("k") <= group), spelled.where(F.col("k") > group)
    by_automaton = small.repartition("g").sortWithinPartitions("g", "c").drop("k").mapInArrow(stream, "g long, c long, a int, b int")
    unrolled = large.drop("k").mapInArrow(unroll, "g long, c long, n long, a int, h long")
    twice = unrolled.groupBy("g", "h").agg(F.sum("n").alias("n")).where("n > 1").select("g", "h")
    by_count = unrolled.where("n = 1").join(twice, ["g", "h"]).select("g", "c", "a", (F.col("a") + window).alias("b"))
    single = contents.where("n = 1").select("g", "c", "at.*").join(by_automaton.unionAll(by_count), ["g", "c"]).select(
        "id", "key", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))
    whole = found.join(contents.where("n > 1").select("g", "c"), ["g", "c"]).select(
        "id", "key", F.col("start").alias("a"), (F.col("start") + F.col("windows") + window - 1).alias("b"))
    return whole.unionAll(single).groupBy("id", "key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def _kept(text: str, spans: list[dict]) -> tuple[int, int, str]:
    """n_words, n_removed and the text without the spans' words (and the blanks after them)."""
    raw, begins = words.joined(pa.array([text], pa.string()))
    starts, ends, _ = words.word_spans(raw, begins)
    gone = np.zeros(len(starts) + 1, np.int64)
    for s in spans:
        gone[s["a"]] += 1
        gone[s["b"]] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    if not gone.any():
        return len(starts), 0, text
    out, data = [], raw[:begins[-1] - 1].tobytes()
    edge = np.flatnonzero(np.diff(np.r_[True, gone, True].astype(np.int8)))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):      # runs of kept words
        out.append(data[starts[a]:starts[b] if b < len(starts) else len(data)])
    return len(starts), int(gone.sum()), b"".join(out).rstrip(b" \t\n\x0b\x0c\r").decode("utf-8", "surrogatepass")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   group: int = GROUP, max_bits: int = key_filter.MAX_BITS) -> DataFrame:
    """All rows and columns of ``docs`` with ``text_col`` cut, and struct ``repeats``: n_words, n_removed.

    Words are ``[^\\x20\\x09-\\x0D]+``; every word under a window that starts anywhere else too,
    in the same text or another, is removed, with the blanks behind it; other text stays as it
    is. Null texts stay null (no words); texts of fewer words than ``window`` are untouched;
    repeated rows repeat each other and lose their windows; null ids are texts like others. An
    empty table gives no rows. ``repeats`` must not be a column already.
    """
    if "repeats" in (c.lower() for c in docs.columns):
        raise ValueError("column repeats is taken")
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("key"))
    spans = stored(repeated_spans(plain, window, group, max_bits), "span-spans")    # a plain side: AQE can split the join
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), F.col(id_col).alias("id"), key.alias("key"))
    spans = spans.select(F.col("id").alias("own"), F.col("key").alias("own_key"), "spans")
    joined = rows.join(spans, (F.col("own_key") == F.col("key")) & F.col("own").eqNullSafe(F.col("id")), "left").select("row", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in words.slices(batch, "text"):
                done = [(len(t.encode("utf-8", "surrogatepass").split()) if t else 0, 0, t) if not s else _kept(t, s)
                        for t, s in zip(rows.column("text").to_pylist(), rows.column("spans").to_pylist())]
                yield pa.RecordBatch.from_pydict({"row": rows.column("row"), "n_words": pa.array([d[0] for d in done], pa.int64()),
                                                  "n_removed": pa.array([d[1] for d in done], pa.int64()), "text": pa.array([d[2] for d in done], pa.string())})

    slim = joined.withColumn("row", F.col("row").dropFields(text_col)) if len(docs.columns) > 1 else joined
    kind = slim.schema["row"].dataType.simpleString()
    out = slim.mapInArrow(cut, f"row {kind}, n_words long, n_removed long, text string")
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns],
                      F.struct("n_words", "n_removed").alias("repeats"))
