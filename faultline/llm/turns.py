"""Repair of conversations: the cheapest edits that give a legal sequence of roles, by an auction algorithm on a lattice.

A node of the lattice is a row and a state of the pattern ``(s?(ua)+)?``; arcs keep, rerole or delete the row, or insert one, at integer costs. The
auction for shortest paths keeps a price per node, never above the cost of an arc plus the price at its end. A path grows from the origin: where the
best arc is tight, the path extends along it, else the end node's price rises to the best arc's value and the path contracts by a node. When the path
reaches the sink the origin's price is its distance, and every arc on any shortest path is tight. Among the tight paths the
audit string that is least is traced with the set of all nodes that share it so far.

Conversations are cut in blocks of ``BLOCK`` rows, from the last to the first: the prices that converged on a block's left edge are the costs into the
sink of the block before. Blocks with equal codes and prices are solved once per task. A conversation of any length takes one byte per row in its
task, as does its audit; rows and texts are streamed through a sort by conversation and are never held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from faultline.session import ship_package, stored

BLOCK = 32
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# Codes of a row: its role's initial (other, s, u, a) times four, and its fault (none, blank, duplicate, truncated).
INITIALS = {"s": 1, "u": 2, "a": 3}
BLANK, DUPLICATE, CUT = 1, 2, 3
#: State after an initial: 0 at the start, 1 after s, 2 after u, 3 after a.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ENDS = (0, 3)
FAR = 1 << 60


def insertions(state: int) -> list[tuple[str, int, int]]:
    return [("I", NEXT[state, x], INSERT) for x in "ua" if (state, x) in NEXT]


def consumptions(code: int, state: int) -> list[tuple[str, int, int]]:
    """Audit letter, next state and cost of what can be done with a row."""
    initial, fault = divmod(code, 4)
    arcs = [("D", state, DELETE)]
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED if fault == CUT else 0
        arcs += [("K", NEXT[state, x], KEEP + more) for x, i in INITIALS.items() if i == initial and (state, x) in NEXT]
        arcs += [("R", NEXT[state, x], REROLE + more) for x in "ua" if (state, x) in NEXT]
    return arcs


ARCS = [[consumptions(code, state) for state in range(4)] for code in range(16)]
INSERTS = [insertions(state) for state in range(4)]


class Block:
    """The lattice of some rows, entered at any state on its left; ``right`` are the costs from its right edge to the sink."""

    def __init__(self, codes: bytes, right: tuple[int, ...], last: bool):
        self.rows, self.last, self.right = len(codes), last, right
        self.sink = 4 * (len(codes) + 1)
        self.arcs: list[list[tuple[int, int, str]]] = []  # end node, cost, letter
        for i, code in enumerate(codes):
            for state in range(4):
                arcs = [(4 * (i + 1) + s, cost, letter) for letter, s, cost in ARCS[code][state]]
                self.arcs.append(arcs + [(4 * i + s, cost, letter) for letter, s, cost in INSERTS[state]])
        for state in range(4):
            arcs = [(self.sink, right[state], "")] if right[state] < FAR else []
            self.arcs.append(arcs + ([(self.sink - 4 + s, cost, letter) for letter, s, cost in INSERTS[state]] if last else []))
        self.prices = [0] * (self.sink + 1)
        self.traced: dict[frozenset[int], tuple[frozenset[int], str]] = {}

    def price(self, origin: int) -> int:
        """The distance from an origin to the sink, by extending and contracting a path."""
        prices, path, sink = self.prices, [origin], self.sink
        while path[-1] != sink:
            at = path[-1]
            best, end = min((cost + prices[j], j) for j, cost, _ in self.arcs[at])
            if prices[at] < best:
                prices[at] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(end)
        return prices[origin]

    def trace(self, states: frozenset[int]) -> tuple[frozenset[int], str]:
        """From nodes with converged prices, the states on the right edge, or at the sink, after the least letters on tight paths."""
        if states not in self.traced:
            self.traced[states] = self._trace(states)
        return self.traced[states]

    def _trace(self, states: frozenset[int]) -> tuple[frozenset[int], str]:
        tight = [[(j, letter) for j, cost, letter in arcs if self.prices[i] == cost + self.prices[j]] for i, arcs in enumerate(self.arcs)]
        reaches = [False] * self.sink + [True]
        for i in reversed(range(self.rows + 1)):
            for _ in range(4):  # inserts lead to other states of the same row
                for node in range(4 * i, 4 * i + 4):
                    reaches[node] = reaches[node] or any(reaches[j] for j, _ in tight[node])
        letters, nodes, edge = [], set(states), self.sink - 4
        while True:
            arcs = [(letter, j) for node in nodes for j, letter in tight[node] if reaches[j]]
            if any(j == self.sink for _, j in arcs):  # the end is less than any letter
                return frozenset(node - edge for node in nodes if node >= edge), "".join(letters)
            least = min(letter for letter, _ in arcs)
            letters.append(least)
            nodes = {j for letter, j in arcs if letter == least}


@lru_cache(maxsize=1 << 14)
def block(codes: bytes, right: tuple[int, ...], last: bool) -> Block:
    return Block(codes, right, last)


def repair(codes: bytes, size: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of the cheapest edits."""
    solved = [block(b"", tuple(0 if s in ENDS else FAR for s in range(4)), True)]
    paid = 0
    for start in reversed(range(0, len(codes), size)):
        prices = [solved[-1].price(state) for state in range(4)]
        paid += min(prices)
        solved.append(block(codes[start : start + size], tuple(p - min(prices) for p in prices), False))
    paid += solved[-1].price(0)
    states, audit = frozenset([0]), []
    for part in reversed(solved):
        states, letters = part.trace(states)
        audit.append(letters)
    return paid, "".join(audit)


def role_after(state: int) -> str:
    """The role that a rerole or insert gives."""
    return "assistant" if state == 2 else "user"


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, turn, role, text after seeded faults; what is null is one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank(conv_col), F.lit(":"), blank(turn_col)).cast("binary")) % 20
    text, role = blank(text_col), blank(role_col)
    return rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), fault.alias("fault")).filter("fault != 0").select(
        "conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(0), (F.col("fault") == 3).cast("int"))).alias("copy"),
    ).drop("copy")


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


ORDER = ["conv", "mark", "turn", "role", "digest"]


def _streamed(rows: DataFrame) -> DataFrame:
    """Each conversation's rows in one stream, its marked row first: nulls first, then by turn; rows of one turn by role and digest."""
    return rows.repartition("conv").sortWithinPartitions(*ORDER)


AUDITED = pa.schema([("conv", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation: counts, cost and audit."""
    legal = {(1, 2), (2, 3), (3, 2)}
    conv, state = None, None

    def closed() -> tuple:
        codes = bytes(state["codes"])
        faults = [c % 4 for c in codes]
        cost, audit = repair(codes)
        gaps = state["high"] - state["low"] + 1 - state["turns"] if state["turns"] else 0
        illegal = sum((a // 4, b // 4) not in legal for a, b in zip(codes, codes[1:]))
        return conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit

    for batch in batches:
        done = []
        columns = (batch.column(c).to_pylist() for c in ("conv", "mark", "turn", "role", "digest", "initial", "blank", "truncated", "later"))
        for key, mark, turn, role, digest, initial, blank, truncated, later in zip(*columns):
            if mark == 0:  # every conversation begins with its mark
                if state is not None:
                    done.append(closed())
                conv, state = key, {"codes": bytearray(), "low": 0, "high": 0, "turns": 0, "last": None}
                continue
            if turn is not None and (not state["turns"] or turn != state["high"]):
                state["low"] = state["low"] if state["turns"] else turn
                state["high"], state["turns"] = turn, state["turns"] + 1
            again = later or state["last"] == (turn, role, digest)
            state["last"] = (turn, role, digest)
            state["codes"].append(4 * INITIALS.get(initial, 0) + (BLANK if blank else DUPLICATE if again else CUT if truncated else 0))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*done)) or [()] * len(AUDITED), AUDITED)], schema=AUDITED)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(closed()), AUDITED)], schema=AUDITED)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's repaired rows, whose audit comes first."""
    schema = pa.schema([("of", pa.int64()), ("repaired_sha256", pa.string())])
    conv = audit = digest = None
    at = state = 0
    begun = False

    def add(role: str, text: str) -> None:
        nonlocal begun
        digest.update(b"\n" * begun + role.encode() + b":" + text.encode())
        begun = True

    def inserts() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            add(role_after(state), "")
            state = NEXT[state, "a" if state == 2 else "u"]
            at += 1

    for batch in batches:
        done = []
        for key, mark, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "mark", "role", "text"))):
            if mark == 0:
                if digest is not None:
                    inserts()
                    done.append((conv, digest.hexdigest()))
                conv, audit, digest, at, state, begun = key, text, hashlib.sha256(), 0, 0, False
                continue
            inserts()
            letter, at = audit[at], at + 1
            if letter == "D":
                continue
            if letter == "R":
                role = role_after(state)
            add(role, text)
            state = NEXT[state, role[0]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*done)) or [()] * 2, schema)], schema=schema)
    if digest is not None:
        inserts()
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], schema=schema)


def repaired(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Per conversation of ``ids`` (conv): counts of faults, cost, audit and the repaired rows' hash, from ``rows`` (conv, turn, role, text).

    Rows go by turn, null first; rows of one turn by role and by their text's SHA-256, so that equal ones are neighbours. A null conversation is one
    like any other; a conversation without rows has zeros, an empty audit and the hash of nothing.
    """
    ship_package(rows.sparkSession)
    white = r"[\x20\x09-\x0D]"
    last = F.regexp_extract("text", rf"([^\x20\x09-\x0D]){white}*\z", 1)
    lean = stored(rows.select("conv", "turn", "role", _digest("text").alias("digest"), (last == "").alias("blank"), (~last.rlike("[.!?]")).alias("truncated")))
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    firsts = lean.groupBy("conv", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select(F.col("conv").alias("of"), F.col("role").alias("its_role"), F.col("digest").alias("its_digest"), "first")
    same = F.col("conv").eqNullSafe(F.col("of")) & (F.col("role") == F.col("its_role")) & (F.col("digest") == F.col("its_digest"))
    flagged = lean.join(firsts, same, "left").select(
        "conv", F.lit(1).alias("mark"), "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "blank", "truncated",
        F.coalesce(place > F.col("first"), F.lit(False)).alias("later"),
    )
    mark = lambda kind: F.lit(None).cast(kind)
    marks = ids.select("conv", F.lit(0).alias("mark"), mark("long").alias("turn"), mark("string").alias("role"), mark("binary").alias("digest"),
                       mark("string").alias("initial"), mark("boolean").alias("blank"), mark("boolean").alias("truncated"), mark("boolean").alias("later"))
    schema = "conv bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
    audits = stored(_streamed(marks.union(flagged)).mapInArrow(_audited, schema))
    texts = rows.select("conv", F.lit(1).alias("mark"), "turn", "role", _digest("text").alias("digest"), "text")
    heads = audits.select("conv", F.lit(0).alias("mark"), mark("long").alias("turn"), mark("string").alias("role"), mark("binary").alias("digest"), F.col("audit").alias("text"))
    hashes = _streamed(heads.union(texts)).mapInArrow(_repaired, "of bigint, repaired_sha256 string")
    return audits.join(hashes, F.col("conv").eqNullSafe(F.col("of"))).drop("of")


def damaged_and_repaired(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, after seeded damage.

    Null texts, roles, ids and turns count as one space in the damage, null turns come first and make no gaps. Repeated rows are rows of their own, the later ones
    duplicates. Very long conversations and texts are streamed. No rows give no rows; other columns are ignored.
    """
    rows = damaged(conversations, conv_col, turn_col, role_col, text_col).withColumn("conv", F.col("conv").cast("long"))
    ids = conversations.select(F.col(conv_col).cast("long").alias("conv")).distinct()
    return repaired(rows, ids).withColumnRenamed("conv", "conv_id")
