"""Conversation structure repair: a min-plus dynamic programme over grammar-compressed conversations.

1. All rows are sorted at once by conversation and turn and numbered, so that no task holds a
   conversation; repeats are found by the first position of every (conversation, role, text).
   A row becomes one symbol: its role's class and its fault.
2. A conversation's symbols are cut into chunks of at most ``CHUNK`` rows. Re-Pair over the distinct
   chunks gives a grammar: per round the most frequent pairs, no symbol in two of them, become
   rules (at most ``ROUNDS`` rounds; what no rule covers stays as it is).
3. Every rule has one transfer matrix: for each state of the role automaton before and after, the
   cheapest cost and the audit that goes with it. It is the min-plus product of the matrices of
   the rule's two sides, made once, bottom-up, and shared by all conversations.
4. A chunk is the product of what is left of it, a conversation the product of its chunks.

An audit is a rope: an entry of a product points into the two factors. Ropes are compared without
being written out: the edits of one row are a word I*K, I*R or I*D, and no such word begins
another, so two audits of the same rows compare as the pairs of their halves' ranks do.

The last step hashes a conversation's repaired rows in order, in a stream through one task that
holds no more than a batch: the digest of one conversation cannot be made in parts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from autolake.llm.stored import stored

CHUNK = 1024
ROUNDS = 12
# Pairs looked at in a round (the most frequent), and chunks remembered by a task.
PAIRS = 4096
MEMO = 100_000

# States of (s?(ua)+)?: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
EXPECT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}      # what a rerole or an insert gives
INSERTS_TO_END = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# A row's symbol: role class s, u, a, other, in capitals if truncated; d if it must go.
SYMBOLS = "suaoSUAOd"
_BLANK = " \t\n\x0b\x0c\r"


class Matrix:
    """Cheapest (cost, audit) between every two states; ``rank`` orders the audits of its entries.

    A terminal has its audits in ``words``; a product has the middle state of every entry in
    ``middle`` and its factors.
    """

    __slots__ = ("cost", "rank", "words", "middle", "left", "right")

    def __init__(self, cost, keys, words=None, middle=None, left=None, right=None):
        order = {k: r for r, k in enumerate(sorted({k for k in keys if k is not None}))}
        self.cost, self.rank = cost, [None if k is None else order[k] for k in keys]
        self.words, self.middle, self.left, self.right = words, middle, left, right

    def audit(self, entry: int) -> str:
        """The rope of an entry, written out."""
        out, stack = [], [(self, entry)]
        while stack:
            m, e = stack.pop()
            if m.words is not None:
                out.append(m.words[e])
            else:
                k = m.middle[e]
                stack.append((m.right, k * STATES + e % STATES))
                stack.append((m.left, e - e % STATES + k))
        return "".join(out)


def terminal(symbol: str) -> Matrix:
    """The matrix of one row: any inserts before it, then keep, rerole or delete."""
    best: list = [None] * STATES * STATES
    extra = TRUNCATED if symbol in "SUAO" else 0
    for before in range(STATES):
        state = before
        for inserts in range(3):        # two inserts lead back to where one leads from
            edits = [(DELETE, "D", state)]
            if symbol != "d":
                edits.append((REROLE + extra, "R", EXPECT[state]))
                if state in KEEP[symbol.lower()]:
                    edits.append((extra, "K", KEEP[symbol.lower()][state]))
            for cost, letter, after in edits:
                found = (INSERT * inserts + cost, "I" * inserts + letter)
                e = before * STATES + after
                best[e] = found if best[e] is None else min(best[e], found)
            state = EXPECT[state]
    words = [b and b[1] for b in best]
    return Matrix([b and b[0] for b in best], words, words=words)


def product(a: Matrix, b: Matrix) -> Matrix:
    cost, keys, middle = [], [], []
    for i in range(0, STATES * STATES, STATES):
        for j in range(STATES):
            best = None
            for k in range(STATES):
                x, y = a.cost[i + k], b.cost[k * STATES + j]
                if x is not None and y is not None:
                    found = (x + y, a.rank[i + k], b.rank[k * STATES + j], k)
                    best = found if best is None else min(best, found)
            cost.append(best and best[0])
            keys.append(best and best[1:3])
            middle.append(best and best[3])
    return Matrix(cost, keys, middle=middle, left=a, right=b)


def matrices(grammar: list[dict]) -> list[Matrix]:
    """One matrix per symbol: the terminals, then every rule from those of its two sides."""
    out = [terminal(s) for s in SYMBOLS]
    for rules in grammar:
        for (a, b), number in sorted(rules.items(), key=lambda r: r[1]):
            assert number == len(out)
            out.append(product(out[a], out[b]))
    return out


def replaced(sequence: list[int], rules: dict) -> list[int]:
    """The sequence with every pair of the rules replaced, from the left."""
    out, i, last = [], 0, len(sequence) - 1
    while i <= last:
        rule = rules.get((sequence[i], sequence[i + 1])) if i < last else None
        out.append(sequence[i] if rule is None else rule)
        i += 1 if rule is None else 2
    return out


def _replace(batches: Iterator[pa.RecordBatch], rules: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sequences = pa.array([replaced(s, rules) for s in batch.column("sequence").to_pylist()], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([sequences, batch.column("n")], names=["sequence", "n"])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("sequence")
        flat, size = column.flatten().to_numpy().astype(np.int64), np.diff(column.offsets.to_numpy())
        row = np.repeat(np.arange(len(size)), size)
        pair = (flat[:-1] << 32 | flat[1:])[row[:-1] == row[1:]]
        weight = batch.column("n").to_numpy()[row[:-1][row[:-1] == row[1:]]]
        codes, place = np.unique(pair, return_inverse=True)
        n = np.zeros(len(codes), np.int64)
        np.add.at(n, place, weight)
        yield pa.RecordBatch.from_pydict({"a": pa.array(codes >> 32), "b": pa.array(codes & 0xFFFFFFFF), "n": pa.array(n)})


def re_pair(chunks: DataFrame, rounds: int = ROUNDS) -> list[dict]:
    """Rules (pair: new symbol) of every round, from a table with ``symbols`` strings.

    A round takes pairs that occur at least twice, the most frequent first, ties by the pair, and
    no symbol in two pairs, so that replacing one takes no occurrence from another.
    """
    place = F.transform(F.split("symbols", ""), lambda s: (F.position(s, F.lit(SYMBOLS)) - 1).cast("int"))
    now = stored(chunks.groupBy("symbols").agg(F.count("*").alias("n")).select(place.alias("sequence"), "n"), "repair-sequences")
    grammar, symbols = [], len(SYMBOLS)
    for _ in range(rounds):
        pairs = now.mapInArrow(_count_pairs, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        frequent = pairs.where("n > 1").orderBy(F.desc("n"), "a", "b").limit(PAIRS).collect()
        rules, used = {}, set()
        for r in frequent:
            if r.a not in used and r.b not in used:
                used |= {r.a, r.b}
                rules[r.a, r.b] = symbols + len(rules)
        if not rules:
            break
        symbols += len(rules)
        grammar.append(rules)
        now = stored(now.mapInArrow(partial(_replace, rules=rules), "sequence array<int>, n long"), "repair-sequences")
    return grammar


def _evaluate(batches: Iterator[pa.RecordBatch], grammar: list[dict]) -> Iterator[pa.RecordBatch]:
    """Costs and audits between every two states, chunk by chunk."""
    known = matrices(grammar)
    memo: dict[str, tuple] = {}
    for batch in batches:
        found = []
        for symbols in batch.column("symbols").to_pylist():
            if symbols not in memo:
                if len(memo) >= MEMO:
                    memo.clear()
                sequence = [SYMBOLS.index(s) for s in symbols]
                for rules in grammar:
                    sequence = replaced(sequence, rules)
                whole = known[sequence[0]]
                for s in sequence[1:]:
                    whole = product(whole, known[s])
                memo[symbols] = whole.cost, [None if c is None else whole.audit(e) for e, c in enumerate(whole.cost)]
            found.append(memo[symbols])
        columns = {c: batch.column(c) for c in ("conv", "position", "roles", "blank", "duplicate", "truncated")}
        yield pa.RecordBatch.from_pydict(columns | {
            "costs": pa.array([f[0] for f in found], pa.list_(pa.int64())), "audits": pa.array([f[1] for f in found], pa.list_(pa.string()))})


class _Fold:
    """The chunks of one conversation in order: cheapest way to every state, without writing audits out."""

    def __init__(self, conv):
        self.conv = conv
        self.sums = [0, 0, 0, 0]            # blank, duplicate, truncated, illegal
        self._last = ""
        self._best = {START: (0, 0)}        # state: (cost, rank of the audit)
        self._ways: list[tuple] = []        # (position, {state: (state before, audit of the chunk)})

    def add(self, position, roles, blank, duplicate, truncated, costs, audits) -> None:
        roles, self._last = self._last + roles, roles[-1]
        legal = sum(roles.count(pair) for pair in ("su", "ua", "au"))
        self.sums = [x + y for x, y in zip(self.sums, (blank, duplicate, truncated, len(roles) - 1 - legal))]
        best = {}
        for before, (cost, rank) in self._best.items():
            for after in range(STATES):
                e = before * STATES + after
                if costs[e] is not None:
                    found = (cost + costs[e], (rank, audits[e]), before)
                    best[after] = min(best.get(after, found), found)
        order = {k: r for r, k in enumerate(sorted({key for _, key, _ in best.values()}))}
        self._ways.append((position, {s: (before, key[1]) for s, (_, key, before) in best.items()}))
        self._best = {s: (cost, order[key]) for s, (cost, key, _) in best.items()}

    def rows(self) -> list[tuple]:
        """Per chunk: conv, position, state before it, its audit; the sums and the cost in the first one."""
        cost, _, state = min((cost + INSERT * INSERTS_TO_END[s], rank, s) for s, (cost, rank) in self._best.items())
        out, tail = [], "I" * INSERTS_TO_END[state]
        for position, ways in reversed(self._ways):
            state, audit = ways[state]
            out.append([self.conv, position, state, audit + tail, None, None, None, None, None])
            tail = ""
        out[-1][4:] = [*self.sums, cost]
        return out[::-1]


_HEADS = "position long, state int, audit string, blank long, duplicate long, truncated long, illegal long, cost long"


def _fold(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    names = ["conv", *(f.split()[0] for f in _HEADS.split(", "))]
    types = [conv_type, pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 5]
    now = None
    for batch in batches:
        done = []
        for conv, *chunk in zip(*[batch.column(c).to_pylist() for c in
                                  ("conv", "position", "roles", "blank", "duplicate", "truncated", "costs", "audits")]):
            if now is None or now.conv != conv:
                done += now.rows() if now else []
                now = _Fold(conv)
            now.add(*chunk)
        yield _table(done, names, types)
    if now:
        yield _table(now.rows(), names, types)


def _table(rows: list, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


_WORD = re.compile(r"I*[KRD]")
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_CLASS = {"s": "s", "u": "u", "a": "a"}


class _Written:
    """The repaired rows of one conversation, hashed as they come."""

    def __init__(self, conv):
        self.conv, self.head = conv, [0, 0, 0, 0, 0]
        self._digest, self._empty = hashlib.sha256(), True
        self._audit, self._words, self._tail, self._state = [], iter(()), "", START
        self._turns, self._low, self._high = 0, None, None

    def start(self, state: int, audit: str, head: list) -> None:
        self._state, self._words = state, iter(_WORD.findall(audit))
        self._tail = audit[len(audit.rstrip("I")):]
        self._audit.append(audit)
        if head[-1] is not None:
            self.head = head

    def _line(self, role: str, text: str) -> None:
        self._digest.update((role if self._empty else "\n" + role).encode() + b":" + text.encode())
        self._empty = False

    def _insert(self, n: int) -> None:
        for _ in range(n):
            self._state = EXPECT[self._state]
            self._line(_ROLE[self._state], "")

    def row(self, turn, role: str, text: str) -> None:
        if turn is not None:
            if turn != self._high:
                self._turns += 1
            self._low, self._high = turn if self._low is None else self._low, turn
        word = next(self._words)
        self._insert(len(word) - 1)
        if word[-1] == "K":
            self._state = KEEP[_CLASS[role[0]]][self._state]
            self._line(role, text)
        elif word[-1] == "R":
            self._state = EXPECT[self._state]
            self._line(_ROLE[self._state], text)

    def result(self) -> tuple:
        self._insert(len(self._tail))
        gaps = 0 if self._low is None else self._high - self._low + 1 - self._turns
        return (self.conv, gaps, *self.head, "".join(self._audit), self._digest.hexdigest())


_RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _write(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
    now = None
    for batch in batches:
        done = []
        for conv, kind, turn, role, text, state, *head in zip(*[batch.column(c).to_pylist() for c in (
                "conv", "kind", "turn", "role", "text", "state", "blank", "duplicate", "truncated", "illegal", "cost")]):
            if kind == 0:           # every conversation begins with such a row
                done += [now.result()] if now else []
                now = _Written(conv)
            elif kind == 1:
                now.start(state, text, head)
            else:
                now.row(turn, role, text)
        yield _table(done, ["conv", *_RESULT], types)
    if now:
        yield _table([now.result()], ["conv", *_RESULT], types)


def fault(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """Role class (s, u, a or o), whether the text is blank, and whether it is truncated."""
    trimmed = F.rtrim(text, F.lit(_BLANK))
    initial = F.substring(role, 1, 1)
    return F.when(initial.isin("s", "u", "a"), initial).otherwise("o"), trimmed == "", ~F.substring(trimmed, -1, 1).isin(".", "!", "?")


def repair(rows: DataFrame, conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", chunk: int = CHUNK, rounds: int = ROUNDS) -> DataFrame:
    """Per conversation of ``conversations``: its faults, the cheapest edits and the repaired text's digest.

    Columns: ``conv_col``, gaps (turn numbers missing between the first and the last), blank,
    duplicate, truncated (rows by their first fault), illegal (neighbours whose role initials are
    not su, ua or au), cost, audit (K keep, R rerole, D delete, I insert), repaired_sha256 (of the
    lines role:text). A conversation is brought to the role initials (s?(ua)+)?; blank and repeated
    rows must go, kept truncated rows cost extra; of equally cheap audits the ASCII-least is taken.

    Rows are taken by turn (nulls first), then role and text in UTF-8 order. Null roles and texts
    read as one space; a null conversation id is a conversation of its own; an empty role counts as
    one that is neither s, u nor a. Conversations without rows have zeros, an empty audit and the
    digest of nothing. An empty table gives no rows. Other columns are not read.
    """
    spark = rows.sparkSession
    conv_kind = rows.schema[conv_col].dataType.simpleString()
    conv_type = rows.select(conv_col).limit(0).toArrow().schema.field(0).type
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    base = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"))
    kind, blank, cut = fault(F.col("role"), F.col("text"))
    ordered = stored(base.orderBy(F.col("conv"), F.col("turn").asc_nulls_first(), "role", "text")
                     .select("*", kind.alias("class"), blank.alias("is_blank"), cut.alias("is_cut"),
                             F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("within")), "repair-rows")
    # one row per partition of the sort
    sizes = ordered.groupBy("part").agg(F.count("*").alias("size"), F.min("within").alias("least"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shift = sizes.select("part", (F.coalesce(before, F.lit(0)) - F.col("least")).alias("shift"))
    numbered = ordered.join(F.broadcast(shift), "part").withColumn("position", F.col("within") + F.col("shift")).drop("part", "within", "shift")

    firsts = (numbered.groupBy("conv", "role", F.unhex(F.sha2("text", 256)).alias("text")).agg(F.min("position").alias("position"))
              .select("position", F.lit(True).alias("first")))
    small = numbered.select("conv", "position", "class", "is_blank", "is_cut").join(firsts, "position", "left")
    again = ~F.col("is_blank") & F.col("first").isNull()
    ends = ~F.col("is_blank") & ~again & F.col("is_cut")
    symbol = F.when(F.col("is_blank") | again, "d").when(ends, F.upper("class")).otherwise(F.col("class"))
    cells = F.array_sort(F.collect_list(F.struct("position", symbol.alias("symbol"), "class")))
    joined = lambda field: F.array_join(F.transform("cells", lambda x: x[field]), "")
    count = lambda c, name: F.sum(c.cast("long")).alias(name)
    chunks = stored(small.groupBy("conv", F.floor(F.col("position") / chunk).alias("block"))
                    .agg(cells.alias("cells"), F.min("position").alias("position"), count(F.col("is_blank"), "blank"),
                         count(again, "duplicate"), count(ends, "truncated"))
                    .select("conv", "position", joined("symbol").alias("symbols"), joined("class").alias("roles"),
                            "blank", "duplicate", "truncated"), "repair-chunks")
    grammar = re_pair(chunks, rounds)
    evaluated = chunks.mapInArrow(partial(_evaluate, grammar=grammar),
                                  f"conv {conv_kind}, position long, roles string, blank long, duplicate long, truncated long, "
                                  "costs array<long>, audits array<string>")
    heads = (evaluated.repartition("conv").sortWithinPartitions("conv", "position")
             .mapInArrow(partial(_fold, conv_type=conv_type), f"conv {conv_kind}, {_HEADS}"))

    # one stream per conversation: that it is there, then every chunk's audit before the chunk's rows
    head = ["state", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = lambda *names: [F.lit(None).cast("int" if n == "state" else "string" if n in ("role", "text") else "long").alias(n) for n in names]
    there = conversations.select(F.col(conv_col).alias("conv")).distinct()
    stream = (there.select("conv", F.lit(-1).cast("long").alias("position"), F.lit(0).alias("kind"), *nothing("turn", "role", "text", *head))
              .unionAll(heads.select("conv", "position", F.lit(1), *nothing("turn", "role"), "audit", *head))
              .unionAll(numbered.select("conv", "position", F.lit(2), "turn", "role", "text", *nothing(*head))))
    out = (stream.repartition("conv").sortWithinPartitions("conv", "position", "kind")
           .mapInArrow(partial(_write, conv_type=conv_type),
                       f"conv {conv_kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"))
    return out.withColumnRenamed("conv", conv_col)


def damaged(rows: DataFrame) -> DataFrame:
    """The `conversations` table with faults by the crc32 of `conv_id:turn` (nulls: one space) modulo 20:
    0 drops a row, 1 empties its text, 2 removes [.!?] from it, 3 repeats it, 4 sets the role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    hit = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), way.alias("way")).where("way <> 0")
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (hit.select("conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))
            .drop("copy"))
