"""op12: conversation repair against a plain dynamic programme."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from autolake.llm import conversations, queries
from tests.conftest import SF001

ROWS = "conv_id long, turn long, role string, text string, position string, kind string, symbols int, part string, conv string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if way == 1:
            text = ""
        if way == 2:
            text = re.sub("[.!?]", "", text)
        if way == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    return out


def plain_repair(rows, ids):
    """Per conversation: the cheapest (cost, audit, output) by state, all ways tried."""
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = []
    for conv in ids:
        own = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in own:
            body = text.strip(SPACE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        best = {"": (0, "", ())}        # by the output's last role initial (start: nothing)
        after = {"": "u", "s": "u", "u": "a", "a": "u"}
        name = {"u": "user", "a": "assistant"}

        def insert(best):
            todo = dict(best)
            for _ in range(3):
                for state, (cost, audit, lines) in list(todo.items()):
                    to = after[state]
                    found = (cost + 5, audit + "I", lines + (name[to] + ":",))
                    if to not in todo or found[:2] < todo[to][:2]:
                        todo[to] = found
            return todo

        for (_, _, role, text), fault in zip(own, faults):
            new = {}
            for state, (cost, audit, lines) in insert(best).items():
                ways = [(state, cost + 2, audit + "D", lines)]
                if fault not in ("blank", "duplicate"):
                    extra = 5 * (fault == "truncated")
                    to = after[state]
                    ways.append((to, cost + 1 + extra, audit + "R", lines + (f"{name[to]}:{text}",)))
                    if role[:1] == to or (role[:1] == "s" and state == ""):
                        ways.append((role[:1], cost + extra, audit + "K", lines + (f"{role}:{text}",)))
                for to, *found in ways:
                    if to not in new or tuple(found[:2]) < new[to][:2]:
                        new[to] = tuple(found)
            best = new
        cost, audit, lines = min((v for s, v in insert(best).items() if s in ("", "a")), key=lambda v: v[:2])
        turns = [r[1] for r in own if r[1] is not None]
        initials = [r[2][:1] for r in own]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0]))


def random_rows(seed, n_conv=120, longest=14):
    rnd = random.Random(seed)
    rows = []
    for c in range(n_conv):
        conv = None if c == 7 else c - 3
        for t in range(rnd.randrange(1, longest)):
            turn = None if rnd.random() < 0.05 else t * rnd.choice([1, 1, 1, 2]) - 1
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "User", "ux"]) if rnd.random() < 0.6 else ["user", "assistant"][t % 2]
            text = rnd.choice(["Hi.", "ok", "Is it?", "", " \t", None, "end. ", "zwölf!\n\x0b", "a\u00a0", "\u2003", f"text {rnd.randrange(30)}."])
            rows.append((conv, turn, role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", None, 3, "x", "c") for r in rows], ROWS)


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=lambda r: (r[0] is not None, r[0]))


@pytest.mark.parametrize("seed, chunk, rounds", [(1, 1024, 12), (2, 3, 12), (3, 1, 0), (4, 5, 2)])
def test_as_plain_programme(spark, seed, chunk, rounds):
    rows = random_rows(seed) + random_rows(seed)[:5]        # repeated rows, too
    df = frame(spark, rows).repartition(5)
    ids = {r[0] for r in rows}
    got = conversations.repair(conversations.damaged(df), df, chunk=chunk, rounds=rounds)
    assert result(got) == plain_repair(plain_damage(rows), ids)


def test_rows_as_they_are_and_conversations_without_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, None, "system", "Be kind."), (3, 5, "assistant", "cut"), (4, 2, "user", " ")]
    df = frame(spark, rows)
    got = result(conversations.repair(df, frame(spark, rows + [(9, 1, "user", "x"), (None, 1, "user", "x")])))
    assert got == plain_repair([(c, t, r, x) for c, t, r, x in rows], [1, 2, 3, 4, 9, None])
    assert got[0] == (None, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_one_long_conversation(spark):
    rnd = random.Random(5)
    rows = [(1, t, rnd.choice(["user", "assistant", "system"]), f"text {t}{rnd.choice(['.', '!', '', '?', '.'])}") for t in range(4000)]
    rows += [(2, 0, "user", "a" * 300_000 + "."), (2, 1, "assistant", "b.")]
    df = frame(spark, rows).repartition(7)
    assert result(conversations.repair(df, df, chunk=64)) == plain_repair(rows, [1, 2])


def test_empty_table(spark):
    empty = frame(spark, [])
    assert conversations.repair(conversations.damaged(empty), empty).count() == 0


def test_grammar_gives_the_sequences_back(spark):
    rnd = random.Random(3)
    chunks = ["".join(rnd.choice("uauauasUAd") for _ in range(rnd.randrange(1, 40))) for _ in range(300)] + ["uuuuuuu"] * 9
    grammar = conversations.re_pair(spark.createDataFrame([(c,) for c in chunks], "symbols string"))
    assert grammar
    parts = {i: s for i, s in enumerate(conversations.SYMBOLS)}
    for rules in grammar:
        assert len({s for pair in rules for s in set(pair)}) == sum(len(set(pair)) for pair in rules)
        parts |= {number: parts[a] + parts[b] for (a, b), number in rules.items()}
    for c in chunks:
        sequence = [conversations.SYMBOLS.index(s) for s in c]
        for rules in grammar:
            sequence = conversations.replaced(sequence, rules)
        assert "".join(parts[s] for s in sequence) == c
    assert all(len(m.cost) == 16 for m in conversations.matrices(grammar))


def test_registered_query_over_a_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op12_conversation_repair"](spark, SF001)
    assert [t for _, t in got.select(*COLUMNS).dtypes] == ["bigint"] * 7 + ["string"] * 2
    assert result(got) == plain_repair(plain_damage(rows), {r[0] for r in rows})
