"""Small corpora for the operators' tests: edge cases and random texts that share passages."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, id string, key string, row string, n int, spans string, found_merged string, signature string"


def rows(texts):
    """Documents with columns whose names clash with the operators' own."""
    return [(i, t, "x", None, "r", None, "s", None, "") for i, t in texts]


def edge_texts():
    base = " ".join(f"w{i}" for i in range(60))
    return [(0, base), (1, None), (2, ""), (3, " \n\t  \r\n"), (4, " ".join(f"long{i % 7919}" for i in range(60_000))),
            (5, base), (6, base + " tail"), (6, base + " tail"), (None, base), (None, None), (7, "One\nOne\n\nOne  two. "),
            (8, "Ünï çödé " * 30 + "A\u00a0b \u2003c \x1c d\x85e"), (9, "x " * 500), (-3, "<|endoftext|> it's 12 345  end "), (10, "a" * 9000)]


def mixed_texts(seed: int, n: int, vocabulary: int = 400, passages: int = 4):
    """Random texts, some with common passages, some edited copies of others."""
    rnd = random.Random(seed)
    word = lambda: f"v{rnd.randrange(vocabulary)}"
    shared = [[word() for _ in range(rnd.randrange(20, 60))] for _ in range(passages)]
    texts: list[list[str]] = []
    for _ in range(n):
        kind = rnd.random()
        if texts and kind < 0.45:
            own = list(rnd.choice(texts))
            for _ in range(rnd.randrange(0, 4)):
                own[rnd.randrange(len(own))] = word()
        else:
            own = [word() for _ in range(rnd.randrange(1, 120))]
            if kind > 0.7:
                at = rnd.randrange(len(own) + 1)
                own[at:at] = rnd.choice(shared)
        texts.append(own)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def blank_words(text):
    return (text or "").encode("utf-8", "surrogatepass").split()


def alnum_words(text):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
