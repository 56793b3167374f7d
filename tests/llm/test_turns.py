"""Conversation repair against a plain version that relaxes whole strings."""

import hashlib
import random
import re
import zlib

import pytest

from faultline.llm import turns
from faultline.llm.queries import QUERIES

STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def slow_repair(rows):
    """Cheapest (cost, audit) from the end to the start; ``rows`` are (initial, fault)."""
    best = {(len(rows), q): (0, "") for q in (0, 3)}

    def relax(node, arcs):
        options = [(best[end][0] + cost, letter + best[end][1]) for letter, end, cost in arcs if end in best]
        if options and (node not in best or min(options) < best[node]):
            best[node] = min(options)

    for i in reversed(range(len(rows) + 1)):
        for _ in range(4):
            for q in range(4):
                arcs = [("I", (i, STEP[q, x]), 3) for x in "ua" if (q, x) in STEP]
                if i < len(rows):
                    initial, fault = rows[i]
                    arcs.append(("D", (i + 1, q), 4))
                    if fault not in ("blank", "duplicate"):
                        more = 3 if fault == "truncated" else 0
                        if (q, initial) in STEP:
                            arcs.append(("K", (i + 1, STEP[q, initial]), more))
                        arcs += [("R", (i + 1, STEP[q, x]), 3 + more) for x in "ua" if (q, x) in STEP]
                relax((i, q), arcs)
    return best[0, 0]


def slow(table):
    space = lambda v: " " if v is None else str(v)
    after = {}
    for conv, turn, role, text in table:
        rows = after.setdefault(conv, [])
        role, text = space(role), space(text)
        fault = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, rows in after.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in rows:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        known = {t for t, _, _ in rows if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = slow_repair([(r[1][:1], f) for r, f in zip(rows, faults)])
        left, state, lines = iter(rows), 0, []
        for letter in audit:
            role, text = ("", "") if letter == "I" else next(left)[1:]
            if letter != "D":
                role = role if letter == "K" else "assistant" if state == 2 else "user"
                state = STEP[state, role[0]]
                lines.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        out.append((conv, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").collect()
    assert got(QUERIES["op12_turns"](spark, f"/root/testdata/{sf}")) == slow([tuple(r) for r in rows])


@pytest.mark.parametrize("size", [1, 3, 32])
def test_repair_equals_relaxation(size):
    rng = random.Random(size)
    faults = ["", "blank", "duplicate", "truncated"]
    for n in [*range(9)] * 40 + [70, 200]:
        rows = [(rng.choice("xsuaua"), rng.choice(["", "", "", *faults])) for _ in range(n)]
        codes = bytes(4 * turns.INITIALS.get(i, 0) + faults.index(f) for i, f in rows)
        assert turns.repair(codes, size) == slow_repair(rows)


def test_edge_cases(spark):
    """Nulls anywhere, empty and very long texts, ties and repeated rows, one long conversation, roles of all kinds, extra columns."""
    rng = random.Random(3)
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, None, None), (2, None, "assistant", "ok"), (2, None, "assistant", "ok"), (2, 5, "", "x."),
            (None, 1, "user", "null conversation."), (None, None, "tool", "\t\n"), (3, 2, "system", "s" * 300_000 + "."), (3, 9, "user", "é😀!"), (4, 1, "User", "Caps.")]
    rows += [(9, t, rng.choice(["user", "assistant", "system"]), rng.choice(["One.", "Two", "", f"Own {t}."])) for t in range(700)]
    rows += [(conv, turn, "user", "All go.") for conv in range(100, 400) for turn in (7,)]
    schema = "conv_id bigint, turn bigint, role string, text string"
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "1 as conv", "2 as mark", "'c' as digest", "'d' as initial", "0 as cost").repartition(4)
    assert got(turns.damaged_and_repaired(frame)) == slow(rows)
    assert turns.damaged_and_repaired(spark.createDataFrame([], schema)).count() == 0
