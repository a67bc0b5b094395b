"""Whole-text encoding with a public vocabulary, memoised on blank-separated pieces.

The vocabularies split text before merging and never merge across the point between a
non-blank character and the blank after it. So a text's ids are the ids of its pieces in
order, and a worker process encodes each distinct piece once with the tokenizers library.
Cutting and counting distinct pieces are Arrow and numpy operations over a whole slice.
"""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from autolake.llm import words

# Pieces, ids and characters remembered by one worker process; the memo starts anew beyond any.
MEMO_PIECES = 1_000_000
MEMO_IDS = 16_000_000
MEMO_CHARS = 32_000_000
# New pieces that go through the library in one call.
RUN = 64

_MEMO: dict = {}


class Encoder:
    """Encodes texts into one array of ids and the bounds of each text's ids.

    ``vocabulary`` is the JSON text of a tokenizers file; special-token strings in a text
    are ordinary text, or with ``special`` become their ids, which is the library's default.
    Byte-level vocabularies give blanks ids, so there a piece keeps the blanks before it; word
    vocabularies drop white space.
    """

    def __init__(self, vocabulary: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_str(vocabulary)
        self._tok.no_padding()
        self._tok.no_truncation()
        # strings that the library takes out of a text before all else, with their ids
        added = self._tok.get_added_tokens_decoder() if special else {}
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens must be matched as they are written")
        self._added = {t.content: i for i, t in added.items()}
        self._split_added = re.compile("(" + "|".join(map(re.escape, sorted(self._added, key=len, reverse=True))) + ")").split
        # within texts between these, such a string is ordinary text (it can arise by lower-casing)
        self._tok.encode_special_tokens = True
        # a vocabulary that gives a blank ids of its own keeps white space
        self._blanks = bool(self._alone(" "))
        self._lower = self._alone("AZ") == self._alone("az")
        # ids that stand between pieces, or end a word
        names = self._tok.get_vocab(with_added_tokens=True)
        self._breaks = np.zeros(max(names.values()) + 1, bool)
        self._breaks[self._alone("\n") if self._blanks else [i for t, i in names.items() if t.endswith("</w>")]] = True
        self._start()

    def _start(self) -> None:
        self._codes: dict[bytes, int] = {}
        self._pool = np.zeros(1 << 16, np.uint32)
        self._first = np.zeros(1 << 14, np.int64)
        self._size = np.zeros(1 << 14, np.int64)
        self._used = self._known = self._chars = 0

    def _alone(self, text: str) -> list[int]:
        return self._tok.encode(text, add_special_tokens=False).ids

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of all texts in a row and each text's first piece.

        Besides the point before a blank, no id spans the point between an ASCII letter and ASCII
        punctuation or a line end, nor that between a single line end and an ASCII letter. (A longer
        run of white space is not cut from the letter: the byte vocabulary looks at what follows it.)
        """
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        full = at[:-1][np.diff(at) > 0]
        kind = _KIND[raw]
        letter = kind == _LETTER
        cut = np.zeros(len(raw) + 1, bool)
        cut[full] = cut[-1] = True
        cut[1:-1] |= letter[:-1] & ((kind[1:] == _SIGN) | (kind[1:] == _LINE))
        line = np.flatnonzero((kind[1:-1] == _LINE) & letter[2:]) + 1
        cut[line[_sure_sign(raw, line - 1)] + 1] = True
        if self._blanks:
            blank = np.flatnonzero(raw[1:] == 32) + 1
            cut[blank[_sure_sign(raw, blank - 1)]] = True
            starts = np.flatnonzero(cut)
            first = np.searchsorted(starts, at)
            data = raw
        else:
            # ASCII white space only: it separates words under every definition
            inside = words._IN_WORD[raw] == 1
            begins = inside & (cut[:-1] | ~np.r_[False, inside[:-1]])
            before = np.cumsum(inside) - inside
            begins = np.flatnonzero(begins)
            first = np.searchsorted(begins, at)
            data = raw[inside]
            starts = np.r_[before[begins], len(data)]
            if self._lower:
                data = _LOWERED[data]
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [
            None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        return pieces, first

    def _learn(self, keys: list[bytes]) -> None:
        """Ids of new pieces; pieces that are one word of letters go through the library many in a call."""
        texts = [k.decode() for k in keys]
        if self._blanks:
            single = [t[t[:1] == " ":].isalpha() for t in texts]
        else:       # some letters are lower-cased to a letter and a sign
            single = [t.isalpha() and t.lower().isalpha() for t in texts]
        alone = [i for i, s in enumerate(single) if not s]
        joined = [i for i, s in enumerate(single) if s]
        runs = [joined[a:a + RUN] for a in range(0, len(joined), RUN)]
        self._tok.encode_special_tokens = True
        between = "\n" if self._blanks else " "
        found = self._tok.encode_batch_fast([between.join([texts[i] for i in r]) for r in runs], add_special_tokens=False)
        for r, e in zip(runs, found):
            ids = np.array(e.ids, np.uint32)
            last = self._breaks[ids]
            if self._blanks:        # the id of the line end stands between two pieces
                ends, ids = np.r_[np.flatnonzero(last), len(ids)] - np.arange(last.sum() + 1), ids[~last]
            else:
                ends = np.flatnonzero(last) + 1
            if len(ends) == len(r):
                self._add([keys[i] for i in r], ids, np.diff(np.r_[0, ends]))
            else:
                alone += r
        found = self._tok.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)
        size = np.array([len(e.ids) for e in found], np.int64)
        self._add([keys[i] for i in alone], np.fromiter(chain.from_iterable(e.ids for e in found), np.uint32, size.sum()), size)

    def _add(self, keys: list[bytes], ids: np.ndarray, size: np.ndarray) -> None:
        n = self._known
        self._first, self._size = _room(self._first, n + len(keys)), _room(self._size, n + len(keys))
        self._pool = _room(self._pool, self._used + len(ids))
        self._pool[self._used:self._used + len(ids)] = ids
        self._size[n:n + len(keys)] = size
        self._first[n:n + len(keys)] = self._used + np.cumsum(size) - size
        self._codes.update(zip(keys, range(n, n + len(keys))))
        self._used += len(ids)
        self._known += len(keys)
        self._chars += sum(map(len, keys))

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self._known > MEMO_PIECES or self._used > MEMO_IDS or self._chars > MEMO_CHARS:
            self._start()
        pieces, first = self._pieces(texts)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        codes = np.fromiter(map(self._codes.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(codes < 0)
        if len(new):
            keys = [distinct[i] for i in new.tolist()]
            self._learn(keys)
            codes[new] = np.fromiter(map(self._codes.__getitem__, keys), np.int64, len(keys))
        codes = codes[coded.indices.to_numpy(zero_copy_only=False)]
        size = self._size[codes]
        return _ranges(self._pool, self._first[codes], size), np.r_[0, np.cumsum(size)][first]

    def _with_added(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``_plain``, for texts that hold added tokens: the text between these is encoded on its own."""
        parts = [self._split_added(t) for t in texts.to_pylist()]
        counts = np.cumsum([0] + [len(p) for p in parts])
        flat = [p for ps in parts for p in ps]
        odd = np.array([i % 2 for ps in parts for i in range(len(ps))], bool)
        ids, bounds = self._plain(pa.array(["" if o else p for p, o in zip(flat, odd)], pa.large_string()))
        tokens = [self._added[p] for p, o in zip(flat, odd) if o]
        ids = np.insert(ids, bounds[:-1][odd], tokens)
        return ids, (bounds + np.r_[0, np.cumsum(odd)])[counts]

    def encode(self, texts: pa.Array | list[str | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (null: empty) and each text's bounds; ``end`` closes each text."""
        texts = pc.fill_null((pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())), "")
        if self._added and any(pc.any(pc.match_substring(texts, a)).as_py() for a in self._added):
            ids, bounds = self._with_added(texts)
        else:
            ids, bounds = self._plain(texts)
        if end is None:
            return ids, bounds
        return np.insert(ids, bounds[1:], end), bounds + np.arange(len(bounds))


_LETTER, _SIGN, _LINE, _OTHER = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[128:] = _OTHER
_KIND[33:127] = _SIGN
_KIND[48:58] = _OTHER
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[[9, 10]] = _LINE
# Second-last bytes of all white space beyond ASCII.
_MAYBE_SPACE = np.zeros(256, bool)
_MAYBE_SPACE[[0xC2, 0x80, 0x81, 0x9A]] = True


def _sure_sign(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character that surely is no white space ends with the byte at each place."""
    last, second = raw[at], raw[at - 1]
    return (_KIND[last] > 0) & (_KIND[last] != _LINE) & ((last < 128) | ~_MAYBE_SPACE[second])


_LOWERED = np.frombuffer(words.LOWER, np.uint8)


def _room(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    out = np.zeros(max(n, 2 * len(a)), a.dtype)
    out[:len(a)] = a
    return out


def _ranges(pool: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """pool[first[0]:first[0] + size[0]], pool[first[1]:...], ... in a row."""
    before = np.cumsum(size) - size
    return pool[np.repeat(first - before, size) + np.arange(size.sum())]


def encoder(vocabulary: str, special: bool = False) -> Encoder:
    """This worker process's encoder for a vocabulary (kept between tasks)."""
    if (vocabulary, special) not in _MEMO:
        _MEMO.clear()
        _MEMO[vocabulary, special] = Encoder(vocabulary, special)
    return _MEMO[vocabulary, special]


def forget() -> None:
    """Drop what this worker process remembers, for tasks of other operators that it runs later."""
    _MEMO.clear()


def read_vocabulary(path: str) -> str:
    """The vocabulary file's text, read on the driver and sent to tasks with the plan."""
    with open(path, encoding="utf-8") as f:
        return f.read()
