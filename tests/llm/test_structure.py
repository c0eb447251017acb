"""op12: block tables against all edits, reports against a plain repair by exhaustive shortest paths."""

import hashlib
import heapq
import random
import zlib

import numpy as np
import pytest

from meterflow.llm import blocktables, structure
from meterflow.llm.blocktables import ENDS, INSERT, NEXT_TURN, START, row_edges

SCHEMA = "conv_id long, turn long, role string, text string, _id string, dropped string"
SPACE = " \t\n\x0b\x0c\r"


def every_edit(symbols, most):
    """All edits up to a cost: (cost, letters)."""
    stack = [(0, START, 0, "")]
    while stack:
        i, state, cost, letters = stack.pop()
        if cost > most:
            continue
        if i == len(symbols) and state in ENDS:
            yield cost, letters
        stack.append((i, NEXT_TURN[state], cost + INSERT, letters + "I"))
        if i < len(symbols):
            stack += [(i + 1, behind, cost + more, letters + c) for c, more, behind in row_edges(state, symbols[i])]


def test_every_short_sequence():
    tables = blocktables.Tables()
    rng = random.Random(3)
    for _ in range(250):
        symbols = [rng.randrange(9) for _ in range(rng.randint(0, 6))]
        cost, letters, after = tables.solve(np.array(symbols, np.uint8))
        assert (cost, "".join(letters) + after) == min(every_edit(symbols, cost)), symbols


def cheapest(symbols):
    """Least (cost, letters) by best-first search; cost first, then letters, so ties are ASCII-least."""
    heap, done = [(0, "", 0, START)], set()
    while heap:
        cost, letters, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(symbols) and state in ENDS:
            return cost, letters
        heapq.heappush(heap, (cost + INSERT, letters + "I", i, NEXT_TURN[state]))
        if i < len(symbols):
            for c, more, behind in row_edges(state, symbols[i]):
                heapq.heappush(heap, (cost + more, letters + c, i + 1, behind))


@pytest.mark.parametrize("block", [1, 2, 3, 4])
def test_blocks_and_pieces_do_not_matter(block):
    tables, rng = blocktables.Tables(block), random.Random(block)
    for n in [0, 1, 7, 40, 173]:
        symbols = np.array([rng.choice([0, 1, 2, 3, 3, 3, 4, 5, 5, 5, 6, 7, 8]) for _ in range(n)], np.uint8)
        cost, letters, after = tables.solve(symbols)
        assert (cost, "".join(letters) + after) == cheapest(symbols.tolist())
        cut = rng.randint(0, n)
        behind, rise = tables.transfers(symbols[:cut])
        second, more = tables.transfers(symbols[cut:])
        whole, total = tables.transfers(symbols)
        assert (second[behind] == whole).all() and (rise + more[behind] == total).all()


def damage(rows):
    """The stated damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        deal = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if deal == 0:
            continue
        if deal == 1:
            text = ""
        elif deal == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif deal == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if deal == 3 else 1)
    return out


def plain(rows, order):
    """Reports as the contract words them; ``order`` sorts the rows of a conversation."""
    reports = {row[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for row in rows}
    groups = {}
    for row in damage(rows):
        groups.setdefault(row[0], []).append(row[1:])
    for conv, turns in groups.items():
        turns.sort(key=order)
        seen, symbols, counts = set(), [], [0, 0, 0]
        for _, role, text in turns:
            body = text.rstrip(SPACE)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            symbols.append(blocktables.symbol(role, fault in (0, 1), fault == 2))
        cost, letters = cheapest(symbols)
        lines, state, i = [], START, 0
        for c in letters:
            turn = NEXT_TURN[state]
            name = {2: "user", 3: "assistant"}[turn]
            if c == "I":
                lines.append(name + ":")
            if c in "KR":
                lines.append(f"{turns[i][1] if c == 'K' else name}:{turns[i][2]}")
                turn = 1 if c == "K" and turns[i][1][:1] == "s" else turn
            i += c != "I"
            state = state if c == "D" else turn
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        starts = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        reports[conv] = (gaps, *counts, illegal, cost, letters, digest)
    return reports


def table(spark, rows):
    return spark.createDataFrame([(*r, "own", "no") for r in rows], SCHEMA)


def reports(frame):
    rows = structure.repair(structure.damaged(frame))[0].collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def distinct_turns(row):
    return row[0] is not None, row[0] or 0


def dialogue(rng, conv, n):
    words = ["Yes.", "No!", "why?", "well", "", " \n", "a longer turn. And more", "Thanks. "]
    rows = []
    for turn in range(n):
        role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][turn % 2]
        role = "system" if turn == 0 and rng.random() < 0.5 or rng.random() < 0.03 else role
        role = rng.choice([role] * 20 + [None, "", "tool", "usher"])
        rows.append((conv, turn * rng.choice([1, 1, 1, 2]) + 1000 * turn, role, rng.choice([*words, f"turn {turn}.", None])))
    return rows


def test_conversations_against_plain_repair(spark):
    rng = random.Random(7)
    rows = [row for conv in range(120) for row in dialogue(rng, conv, rng.randint(1, 14))]
    rows += [(None, 2**63 - 1, "user", "Hi."), (None, -(2**63), "assistant", "Hm."), (500, None, None, None)]
    rng.shuffle(rows)
    want = plain(rows, distinct_turns)
    want[None] = (2**63 - 1, *want[None][1:]) if want[None][0] > 2**63 else want[None]
    assert reports(table(spark, rows).repartition(4)) == want


def test_one_conversation_over_many_pieces(spark, monkeypatch):
    """A third of all rows in one conversation, cut into small pieces over many partitions."""
    monkeypatch.setattr(structure, "PIECE_ROWS", 16)
    rng = random.Random(8)
    rows = dialogue(rng, 1, 700) + [row for conv in range(2, 120) for row in dialogue(rng, conv, rng.randint(1, 9))]
    rows += [(None, t, r, x) for _, t, r, x in dialogue(rng, 0, 60)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert reports(table(spark, rows).repartition(6)) == plain(rows, distinct_turns)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repeated_rows_and_ties(spark):
    same = [(7, 1, "user", "Again."), (7, None, None, None)] * 5 + [(7, 2, "assistant", "Yes.")]
    assert reports(table(spark, same)) == plain(same, distinct_turns)
    tied = [(8, 3, role, text) for role in ["user", "assistant", "user"] for text in ["One.", "Two.", "Two."]]
    first = reports(table(spark, tied))
    assert reports(table(spark, tied[::-1]).repartition(3)) == first and first[8][2] >= 2


def test_repaired_turns_spell_the_digest(spark, monkeypatch):
    monkeypatch.setattr(structure, "PIECE_ROWS", 8)
    rng = random.Random(9)
    rows = [row for conv in range(20) for row in dialogue(rng, conv, rng.choice([3, 30]))]
    report, pieces = structure.repair(structure.damaged(table(spark, rows)))
    turns = {}
    for r in sorted(structure.repaired_turns(pieces).collect(), key=lambda r: (r.part, r.seq, r.pos)):
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in report.collect():
        assert hashlib.sha256("\n".join(turns.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256


def test_empty_table(spark):
    assert structure.repair(structure.damaged(table(spark, [])))[0].count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in structure.query(spark, sf).collect()}
    assert got == plain(rows, distinct_turns)
