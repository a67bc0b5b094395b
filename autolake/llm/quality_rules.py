"""Quality by weak supervision: rules vote or abstain, EM weighs them.

Every rule looks at one document and votes clean (1), junk (0) or abstains (null). Documents
are counted by their vector of votes (at most 3**rules vectors, whatever the corpus size), and
expectation-maximisation over those counts estimates each rule's voting rates for clean and
for junk documents and the share of clean ones. A document's verdict is the posterior
probability of being clean given its votes, in place of passing every rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from autolake.llm import words

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Prior belief about every rule, before any document is seen: how often it votes junk (where it
# votes) on a junk and on a clean document; and the share of clean documents.
JUNK_VOTE = (0.5, 0.01)
PRIOR = 0.9
# Weight of that belief in documents, as a share of the corpus. It ties all rules to one notion
# of junk: without it EM settles on whichever single kind of junk is most frequent.
BELIEF = 0.05
ROUNDS = 200

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_stops", "n_distinct")


def _flag(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_IS_SYMBOL = _flag(SYMBOLS)
_IS_UPPER = _flag(bytes(range(65, 91)))
_IS_LETTER = _flag(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_IS_STOP = _flag(b".!?:;")


def _per_text(flags: np.ndarray, begins: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[begins])


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts ``_COUNTS`` of each text."""
    raw, begins = words.joined(texts)
    starts, ends, bounds = words.word_spans(raw, begins)
    hashes = words.hashed(raw, starts, ends)
    n = len(texts)
    n_words = np.diff(bounds)
    doc = np.repeat(np.arange(n), n_words)
    salt = words.mix(np.arange(1, n + 1, dtype=np.uint64))
    in_word = words._IN_WORD[raw].astype(bool)

    # lines: cut at \n; the blank that ``joined`` puts behind a text is not part of its last line
    breaks = np.flatnonzero(raw[:begins[-1]] == 10)
    first = np.sort(np.r_[begins[:-1], breaks + 1])
    last = np.sort(np.r_[begins[1:] - 1, breaks])
    full = np.searchsorted(starts, first) < np.searchsorted(starts, last)
    first, last = first[full], last[full]
    line_doc = np.searchsorted(begins, first, "right") - 1
    keys = words.hashed(raw, first, last) ^ salt[line_doc]
    n_lines = np.bincount(line_doc, minlength=n)
    _, one = np.unique(keys, return_index=True)
    n_dup_lines = n_lines - np.bincount(line_doc[one], minlength=n)

    at = words.window_starts(bounds, 3)
    windows = words.window_hashes(hashes, 3)[at] ^ salt[doc[at]]
    _, inverse, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = words.covered(at[count[inverse] > 1], 3, len(hashes))
    _, one = np.unique(hashes ^ salt[doc], return_index=True)
    return {
        "n_words": n_words,
        "word_chars": _per_text(in_word & ((raw & 0xC0) != 0x80), begins),
        "n_symbols": _per_text(_IS_SYMBOL[raw], begins),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": np.bincount(doc[again], minlength=n),
        "n_lines": n_lines,
        "n_upper": _per_text(_IS_UPPER[raw], begins),
        "n_letters": _per_text(_IS_LETTER[raw], begins),
        "n_stops": _per_text(_IS_STOP[raw], begins),
        "n_distinct": np.bincount(doc[one], minlength=n),
    }


def with_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the counts of each whole text (null: empty)."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc {kind}, " + ", ".join(f"{c} long" for c in _COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in words.slices(batch, "text"):
                counts = text_counts(rows.column("text"))
                yield pa.RecordBatch.from_pydict({"doc": rows.column("doc")} | {c: pa.array(counts[c].astype(np.int64)) for c in _COUNTS})

    return (docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
                .mapInArrow(run, schema).withColumnRenamed("doc", id_col))


def _vote(junk: Column, clean: Column) -> Column:
    return F.when(junk, F.lit(0)).when(clean, F.lit(1)).cast("tinyint")


def rules() -> dict[str, Column]:
    """Each rule's vote: 1 clean, 0 junk, null abstains."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "length": _vote(F.col("n_words") < 50, F.col("n_words") >= 100),
        "word_size": _vote((share("word_chars", "n_words") < 3) | (share("word_chars", "n_words") > 10),
                           share("word_chars", "n_words").between(4, 8)),
        "symbols": _vote(share("n_symbols", "n_words") > 0.1, share("n_symbols", "n_words") < 0.02),
        "dup_lines": _vote(share("n_dup_lines", "n_lines") > 0.3, (F.col("n_dup_lines") == 0) & (F.col("n_lines") > 2)),
        "repeats": _vote(share("n_repeat_words", "n_words") > 0.35, share("n_repeat_words", "n_words") < 0.05),
        "capitals": _vote(share("n_upper", "n_letters") > 0.3, share("n_upper", "n_letters").between(0.002, 0.1)),
        "symbol_chars": _vote(share("n_symbols", "word_chars") > 0.03, share("n_symbols", "word_chars") < 0.005),
        "letters": _vote(share("n_letters", "word_chars") < 0.8, share("n_letters", "word_chars") > 0.9),
        "stops": _vote(share("n_stops", "n_words") > 0.5, share("n_stops", "n_words").between(0.01, 0.25)),
        "variety": _vote((F.col("n_words") >= 20) & (share("n_distinct", "n_words") < 0.15), share("n_distinct", "n_words") > 0.3),
    }


def fit(votes: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """EM over vote vectors: the share of clean documents, and the log weights of votes.

    ``votes``: one row per distinct vector (1, 0, or -1 for abstaining), ``counts``: its
    documents. The weights [class, rule, vote] are logarithms of the rate of each vote
    (0, 1) among non-abstaining ones in class 0 (junk) and 1 (clean); abstaining says nothing.
    """
    total = max(counts.sum(), 1)
    believed = np.stack([np.tile([p, 1 - p], (votes.shape[1], 1)) for p in JUNK_VOTE])
    prior, rates = PRIOR, believed
    for _ in range(ROUNDS):
        post = posterior(votes, prior, np.log(rates))
        mass = np.stack([counts * (1 - post), counts * post])
        seen = np.stack([np.stack([(m[:, None] * (votes == v)).sum(0) for v in (0, 1)], 1) for m in mass])
        new = seen + BELIEF * total * believed
        new /= new.sum(2, keepdims=True)
        # a rule may be weak, but its junk vote never speaks for a document
        worse = new[0, :, 0] < new[1, :, 0]
        new[:, worse] = new[:, worse].mean(0)
        share = (mass[1].sum() + BELIEF * total * PRIOR) / (total * (1 + BELIEF))
        moved = abs(share - prior) + np.abs(new - rates).max()
        prior, rates = share, new
        if moved < 1e-9:
            break
    return prior, np.log(rates)


def posterior(votes: np.ndarray, prior: float, weights: np.ndarray) -> np.ndarray:
    score = np.log(prior / (1 - prior)) + sum(np.where(votes[:, j] < 0, 0.0, (weights[1, j] - weights[0, j])[np.maximum(votes[:, j], 0)])
                                              for j in range(votes.shape[1]))
    return 1 / (1 + np.exp(-np.clip(score, -700, 700)))


def judge(counted: DataFrame) -> DataFrame:
    """``with_counts`` rows (stored: read twice) with votes, quality (posterior) and kept.

    base_failed: fewer than 50 words, or more than half of the words in 3-word windows found
    twice or more; such a document is never kept. Texts without a word fail it. Ties at 0.5
    are kept. An empty table gives no rows. Null ids and repeated rows are judged like others.
    """
    names = list(rules())
    voted = counted.withColumns({f"vote_{n}": v for n, v in rules().items()})
    found = voted.groupBy([f"vote_{n}" for n in names]).count().collect()   # at most 3**rules rows
    votes = np.array([[-1 if r[i] is None else r[i] for i in range(len(names))] for r in found], np.int64).reshape(-1, len(names))
    prior, weights = fit(votes, np.array([r["count"] for r in found], float))
    score = F.lit(float(np.log(prior / (1 - prior))))
    for j, n in enumerate(names):
        gain = weights[1, j] - weights[0, j]
        score = score + F.when(F.col(f"vote_{n}") == 1, float(gain[1])).when(F.col(f"vote_{n}") == 0, float(gain[0])).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (voted.withColumn("quality", 1 / (1 + F.exp(-score))).withColumn("base_failed", failed)
                 .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)))
