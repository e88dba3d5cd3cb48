from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from blotterline.llm import conversation_repair as cr
from blotterline.llm.queries import QUERIES

NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
WORD = re.compile("[^\\x20\\x09-\\x0D]")
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(rows: list[tuple]) -> list[str]:
    found, seen = [], set()
    for _, role, text in rows:
        marks = WORD.findall(text)
        found.append(
            "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    return found


def plain_repair(rows: list[tuple]) -> tuple:
    """All results of one conversation's ordered rows (turn, role, text), by a search over edits."""
    found = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [found.count(x) for x in ("blank", "duplicate", "truncated")]

    follows = {"": "su", "s": "u", "u": "a", "a": "u"}  # from nothing a kept system row, too
    open_edits = [(0, "", 0, "", [])]
    done = set()
    while open_edits:
        cost, audit, at, last, out = heapq.heappop(open_edits)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            body = "\n".join(f"{role}:{text}" for role, text in out)
            return (gaps, *counts, illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest())
        moves = [(3, "I", at, r, (n, "")) for r, n in (("u", "user"), ("a", "assistant")) if r in follows[last]]
        if at < len(rows):
            _, role, text = rows[at]
            moves.append((4, "D", at + 1, last, None))
            if found[at] in ("", "truncated"):
                extra = 3 if found[at] else 0
                if role[:1] and role[0] in follows[last]:
                    moves.append((extra, "K", at + 1, role[0], (role, text)))
                for r, n in (("u", "user"), ("a", "assistant")):
                    if r in follows[last]:
                        moves.append((3 + extra, "R", at + 1, r, (n, text)))
        for more, letter, next_at, state, line in moves:
            heapq.heappush(open_edits, (cost + more, audit + letter, next_at, state, out + [line] if line else out))
    raise AssertionError


def damage(conv, turn, role, text) -> list[tuple]:
    said = " " if conv is None else str(conv), " " if turn is None else str(turn)
    kind = zlib.crc32(":".join(said).encode()) % 20
    role, text = " " if role is None else role, " " if text is None else text
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    if kind == 4:
        role = "user"
    return [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)


def order(row: tuple):
    turn, role, text = row
    return turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def expected(rows: list[tuple]) -> dict:
    conversations: dict = {}
    for conv, turn, role, text in rows:
        conversations.setdefault(conv, []).extend(damage(conv, turn, role, text))
    return {conv: plain_repair(sorted(own, key=order)) for conv, own in conversations.items()}


def got(df) -> dict:
    rows = df.collect()
    made = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in rows}
    assert len(made) == len(rows)
    return made


def repaired(spark, rows, tasks=3):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(tasks)
    return got(cr.repair(cr.damaged(cr.normal_rows(df))))


def conversation(draw: random.Random, conv, length: int) -> list[tuple]:
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "unknown", "", None]
    texts = ["Yes.", "No", "Why?", " ", "", None, "So!  \n", "Well. And", "x\x85"]
    return [
        (conv, draw.choice([t, t, t, t + 1, None]), draw.choice(roles), draw.choice(texts)) for t in range(length)
    ]


def test_re_pair_writes_the_same_sequences():
    draw = random.Random(1)
    sequences = [[draw.randrange(3) for _ in range(draw.randrange(1, 60))] for _ in range(40)] + [[5] * 33, [5]]
    bodies, rules = cr.re_pair(sequences)

    def written(symbol: int) -> list[int]:
        return [symbol] if symbol < 16 else [x for part in rules[symbol - 16] for x in written(part)]

    assert [[x for s in body for x in written(s)] for body in bodies] == sequences
    assert sum(map(len, bodies)) < sum(map(len, sequences)) / 2
    pairs = [p for body in bodies for p in zip(body, body[1:]) if p[0] != p[1]]
    assert len(pairs) == len(set(pairs))


def test_the_grammar_changes_no_matrix():
    draw = random.Random(2)
    sequences = [[draw.randrange(16) for _ in range(draw.randrange(1, 12))] for _ in range(300)]
    for sequence, matrix in zip(sequences, cr.matrices(sequences), strict=True):
        plain = cr.TERMINALS[sequence[0]]
        for symbol in sequence[1:]:
            plain = cr.product(plain, cr.TERMINALS[symbol])
        assert cr._flat(plain) == cr._flat(matrix)


@pytest.mark.parametrize("chunk", [cr.CHUNK, 3])
def test_equals_a_search_over_edits(spark, monkeypatch, chunk):
    monkeypatch.setattr(cr, "CHUNK", chunk)
    draw = random.Random(3)
    rows = [r for conv in range(400) for r in conversation(draw, conv, draw.randrange(1, 9))]
    rows += conversation(draw, None, 6) + conversation(draw, 1000, 150)
    rows += [(2000, t, "user" if t % 2 else "assistant", f"Said {t}.") for t in range(60)]
    assert repaired(spark, rows) == expected(rows)


def test_the_query_equals_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    made = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows.collect()]
    assert got(QUERIES["op12_conversation_repair"](spark, "/root/testdata/sf0.01")) == expected(made)


def test_nothing_left_and_nothing_there(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert repaired(spark, [(dropped, 0, "user", "Hi.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", EMPTY)}
    assert repaired(spark, []) == {}


def test_a_long_conversation_in_many_tasks_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(cr, "CHUNK", 16)
    monkeypatch.setattr(cr, "FAN_IN", 1)
    draw = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system"]
    rows = [(7, t, draw.choice(roles), draw.choice([f"Said {t}.", "Yes.", f"open {t}"])) for t in range(900)]
    rows += [(8, 0, "user", "w " * 200_000 + "."), (8, 1, "assistant", "Good.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("conv", "at", "place", "part", "cost", "kept", "symbol"):
        df = df.selectExpr("*", f"'x' AS {name}")
    assert got(cr.repair(cr.damaged(cr.normal_rows(df.repartition(5))))) == expected(rows)
