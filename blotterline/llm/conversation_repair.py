"""Conversation structure repair: the cheapest edits that make turns alternate, by grammar-compressed DP.

Each row of a conversation is one symbol: the initial of its role and its fault. An edit of a row
moves between four states (nothing yet, after system, after user, after assistant), so a symbol is
a min-plus transfer matrix over these states: from each state to each state the least cost and the
edits that reach it. Matrices multiply along a sequence. Sequences are compressed by Re-Pair:
frequent pairs of symbols become rules, each with one matrix, made from the matrices of its two
parts, whatever number of conversations it occurs in. The edits of an entry are a rope: it names
the two ropes it is made of and is written out only where it is compared or given back.

Rows are numbered by one range shuffle without their texts, so a conversation may lie in any number
of tasks: it is cut into chunks of bounded length, and the chunks' matrices are multiplied in
order, group by group. Only the digest of the repaired texts needs them in one sequence; its task
reads one row after another and holds one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterline.llm.common import bound_batches, by_global_order, map_frames, materialize

BLANKS = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT, OPEN_END = 0, 3, 4, 3, 3
#: Rows per chunk, symbols that share a grammar, and parts that one product takes.
CHUNK, SCOPE, FAN_IN = 2_048, 200_000, 6  # FAN_IN as a power of two
#: A symbol is 4 * status + initial.
INITIALS = "sua"
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
STATES = range(4)  # nothing, after system, after user, after assistant


# --- sequences, on arrays ------------------------------------------------------------------------


class Rope:
    """Edits as a text or as two ropes one after the other."""

    __slots__ = ("parts", "_text")

    def __init__(self, text: str | None = None, parts: tuple[Rope, Rope] | None = None):
        self._text, self.parts = text, parts

    def text(self) -> str:
        if self._text is None:
            pieces, open_ropes = [], [self]
            while open_ropes:
                rope = open_ropes.pop()
                if rope._text is not None:
                    pieces.append(rope._text)
                else:
                    open_ropes += (rope.parts[1], rope.parts[0])
            self._text = "".join(pieces)
        return self._text


#: An entry of a matrix: the least cost and its edits, or None where no edits lead there.
Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def better(a: Entry, b: Entry) -> Entry:
    """The cheaper entry, ties to the edits that are least as text.

    All edits of one sequence have as many letters other than I, and end with one: none is the
    beginning of another, so the least whole is made of the least parts.
    """
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if a[1].text() <= b[1].text() else b


def product(x: Matrix, y: Matrix) -> Matrix:
    """What ``x`` and then ``y`` do."""
    made: Matrix = [[None] * 4 for _ in STATES]
    for p in STATES:
        for q in STATES:
            first = x[p][q]
            if first is None:
                continue
            for r in STATES:
                second = y[q][r]
                if second is None:
                    continue
                cost, old = first[0] + second[0], made[p][r]
                if old is None or cost <= old[0]:
                    made[p][r] = better(old, (cost, Rope(parts=(first[1], second[1]))))
    return made


def _inserts(state: int) -> Iterator[tuple[int, int]]:
    """The states that inserted rows lead to, and how many rows that takes."""
    yield state, 0
    yield 3 if state == 2 else 2, 1
    if state in (0, 1):
        yield 3, 2


def terminal(symbol: int) -> Matrix:
    """The matrix of one row, with whatever is inserted before it."""
    status, initial = divmod(symbol, 4)
    made: Matrix = [[None] * 4 for _ in STATES]
    for p in STATES:
        for q, inserted in _inserts(p):
            moves = [(q, DELETE, "D")]
            if status in (FINE, TRUNCATED):
                extra = OPEN_END if status == TRUNCATED else 0
                turn = 3 if q == 2 else 2  # what may follow besides a first system row
                moves.append((turn, REROLE + extra, "R"))
                if initial < 3 and (initial + 1 == turn or (initial == 0 and q == 0)):
                    moves.append((initial + 1, KEEP + extra, "K"))
            for r, cost, letter in moves:
                entry = (cost + INSERT * inserted, Rope("I" * inserted + letter))
                made[p][r] = better(made[p][r], entry)
    return made


TERMINALS = [terminal(symbol) for symbol in range(16)]


def re_pair(sequences: list[list[int]]) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """The sequences over a grammar's symbols, and its rules; rule i is symbol 16 + i.

    Round by round the most frequent pairs that have no symbol in common become rules, until no
    pair occurs twice. Pairs never cross two sequences.
    """
    rules: list[tuple[int, int]] = []
    lengths = np.array([len(s) + 1 for s in sequences], np.int64)
    body = np.full(int(lengths.sum()), -1, np.int64)  # -1 ends a sequence
    inside = np.ones(len(body), bool)
    inside[np.cumsum(lengths) - 1] = False
    body[inside] = np.concatenate([np.asarray(s, np.int64) for s in sequences]) if inside.any() else []
    while True:
        left, right = body[:-1], body[1:]
        both = (left >= 0) & (right >= 0)
        codes = (left << 32) | right
        # Of a run of one symbol only every second pair can be replaced.
        same = both & (left == right)
        starts = same & ~np.concatenate([[False], same[:-1]])
        run = np.maximum.accumulate(np.where(starts, np.arange(len(same)), 0))
        both &= ~(same & ((np.arange(len(same)) - run) % 2 == 1))
        found, times = np.unique(codes[both], return_counts=True)
        order = np.lexsort((found, -times))
        taken, chosen = set(), {}
        for at in order[times[order] > 1].tolist():
            a, b = int(found[at]) >> 32, int(found[at]) & 0xFFFFFFFF
            if a not in taken and b not in taken:
                taken |= {a, b}
                chosen[int(found[at])] = 16 + len(rules)
                rules.append((a, b))
        if not chosen:
            break
        wanted = np.array(sorted(chosen), np.int64)
        place = np.minimum(np.searchsorted(wanted, codes), len(wanted) - 1)
        hit = np.flatnonzero(both & (wanted[place] == codes))
        names = np.array([chosen[int(c)] for c in wanted], np.int64)
        body[hit] = names[place[hit]]
        body = np.delete(body, hit + 1)
    ends = np.flatnonzero(body < 0)
    cut = np.split(body, ends + 1)[: len(sequences)]
    return [piece[:-1].tolist() for piece in cut], rules


def matrices(sequences: list[list[int]]) -> list[Matrix]:
    """The matrix of each sequence (not empty): equal ones once, rules bottom up."""
    place: dict[tuple[int, ...], int] = {}
    of_sequence = [place.setdefault(tuple(s), len(place)) for s in sequences]
    bodies, rules = re_pair([list(s) for s in place])
    known = list(TERMINALS)
    for a, b in rules:
        known.append(product(known[a], known[b]))
    made = []
    for body in bodies:
        whole = known[body[0]]
        for symbol in body[1:]:
            whole = product(whole, known[symbol])
        made.append(whole)
    return [made[at] for at in of_sequence]


def cheapest(matrix: Matrix | None) -> tuple[int, str]:
    """Cost and edits of a whole conversation, with whatever is inserted at its end."""
    if matrix is None:
        return 0, ""
    best: Entry = None
    for state, missing in ((0, 0), (1, 2), (2, 1), (3, 0)):
        entry = matrix[0][state]
        if entry is not None:
            best = better(best, (entry[0] + INSERT * missing, Rope(entry[1].text() + "I" * missing)))
    return best[0], best[1].text()


# --- conversations, on Spark ---------------------------------------------------------------------


def key_of(value: Column) -> Column:
    """A text that tells all values and null apart."""
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), value.cast("string")))


def normal_rows(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv, conv_id, turn, role, text; null roles and texts are one blank, null turns stay."""
    return conversations.select(
        key_of(F.col(conv_id)).alias("conv"),
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with planted faults, chosen by the CRC-32 of ``conv_id:turn`` (null: a blank) mod 20.

    0 drops the row (``kept`` is false), 1 empties its text, 2 takes out full stops, exclamation and
    question marks, 3 repeats the row, 4 makes it a user's.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(name.cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv",
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (kind != 0).alias("kept"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def _digest() -> Column:
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))


def _symbols(rows: DataFrame) -> DataFrame:
    """conv, at (the order of all rows), turn, symbol of each row. Texts are not shuffled."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    status = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    marks = rows.select("conv", "turn", _digest().alias("digest"), status.alias("status"), initial.alias("initial"))
    at = F.monotonically_increasing_id()
    ordered = materialize(by_global_order(marks, "conv", "turn", "digest").withColumn("at", at), "turns")
    # Places of the first of equal rows: a repeated row is one whose place is not among them.
    firsts = ordered.where(F.col("status") != BLANK).groupBy("conv", "digest").agg(F.min("at").alias("at"))
    known = ordered.drop("digest").join(firsts.select("at", F.lit(True).alias("first")), "at", "left")
    repeated = (F.col("status") != BLANK) & F.col("first").isNull()
    symbol = F.when(repeated, DUPLICATE).otherwise(F.col("status")) * 4 + F.col("initial")
    return known.select("conv", "at", "turn", symbol.cast("int").alias("symbol"))


PART = (
    "conv string, place long, blank long, duplicate long, truncated long, illegal long, head int, tail int, "
    "costs array<long>, edits array<string>"
)


def _flat(matrix: Matrix) -> tuple[list[int | None], list[str | None]]:
    entries = [entry for row in matrix for entry in row]
    return [e and e[0] for e in entries], [None if e is None else e[1].text() for e in entries]


def _matrix(costs: Iterable, edits: Iterable) -> Matrix:
    entries = [None if c is None else (c, Rope(e)) for c, e in zip(costs, edits, strict=True)]
    return [entries[4 * p : 4 * p + 4] for p in STATES]


def _legal(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string())]
    names = [column.split()[0] for column in PART.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _chunks(symbols: DataFrame) -> DataFrame:
    """The parts of conversations that lie in one chunk: counts, ends and matrix. Bounded rows each."""
    inside = F.col("at").bitwiseAND((1 << 33) - 1)
    place = F.shiftright("at", 33) * (1 << 20) + F.floor(inside / CHUNK).cast("long")
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("at", "symbol"))), lambda m: m["symbol"])
    chunks = symbols.groupBy("conv", place.alias("place")).agg(ordered.alias("symbols"))

    def scope(rows: list[tuple[str, int, list[int]]]) -> pa.RecordBatch:
        made = []
        for (conv, at, own), matrix in zip(rows, matrices([own for _, _, own in rows]), strict=True):
            status, initial = [s >> 2 for s in own], [s & 3 for s in own]
            illegal = sum(not _legal(a, b) for a, b in zip(initial, initial[1:]))
            counts = (status.count(BLANK), status.count(DUPLICATE), status.count(TRUNCATED))
            made.append((conv, at, *counts, illegal, initial[0], initial[-1], *_flat(matrix)))
        return _arrow(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for row in zip(*(batch[name].to_pylist() for name in ("conv", "place", "symbols")), strict=True):
                rows.append(row)
                size += len(row[2])
                if size >= SCOPE:
                    yield scope(rows)
                    rows, size = [], 0
            if rows:
                yield scope(rows)

    return chunks.mapInArrow(run, PART)


def _joined(parts: DataFrame, group: Column) -> DataFrame:
    """The parts of a conversation with one ``group`` as one part, in the order of ``place``."""
    columns = [column.split()[0] for column in PART.split(", ")[1:]]
    own = parts.groupBy("conv", group.alias("group")).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in range(batch.num_rows):
                conv, place, some = (batch[name][row].as_py() for name in ("conv", "group", "parts"))
                whole, *others = some
                matrix = _matrix(whole["costs"], whole["edits"]) if others else None
                for part in others:
                    matrix = product(matrix, _matrix(part["costs"], part["edits"]))
                    whole["illegal"] += part["illegal"] + (not _legal(whole["tail"], part["head"]))
                    whole["tail"] = part["tail"]
                    for name in ("blank", "duplicate", "truncated"):
                        whole[name] += part[name]
                if others:
                    whole["costs"], whole["edits"] = _flat(matrix)
                made.append((conv, place, *(whole[name] for name in columns[1:])))
            yield _arrow(made)

    return own.mapInArrow(run, PART)


def _plans(symbols: DataFrame) -> DataFrame:
    """conv, blank, duplicate, truncated, illegal, cost, audit of every conversation with rows."""
    top = symbols.agg(F.max(F.shiftright("at", 33))).first()[0] or 0
    parts = _joined(materialize(_chunks(symbols), "chunks"), F.shiftright("place", 20))
    while top:
        top >>= FAN_IN
        parts = _joined(materialize(parts, "parts"), F.shiftright("place", FAN_IN))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            plans = [cheapest(_matrix(c, e)) for c, e in zip(frame.pop("costs"), frame.pop("edits"), strict=True)]
            yield frame.assign(cost=[cost for cost, _ in plans], audit=[edits for _, edits in plans])

    counts = ("blank", "duplicate", "truncated", "illegal")
    schema = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    return map_frames(parts.select("conv", *counts, "costs", "edits"), run, schema)


class Repairer:
    """The digest of one conversation's repaired rows, fed row by row in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.rows = audit, 0, 0, 0
        self.digest = hashlib.sha256()

    def _write(self, role: str, text: str, state: int) -> None:
        line = f"{role}:{text}" if not self.rows else f"\n{role}:{text}"
        self.digest.update(line.encode("utf-8", "surrogatepass"))
        self.state, self.rows = state, self.rows + 1

    def _insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(*self._turn(""))
            self.at += 1

    def _turn(self, text: str) -> tuple[str, str, int]:
        return ("assistant", text, 3) if self.state == 2 else ("user", text, 2)

    def row(self, role: str, text: str) -> None:
        self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._write(role, text, INITIALS.index(role[0]) + 1)
        elif edit == "R":
            self._write(*self._turn(text))

    def end(self) -> str:
        self._insert()
        return self.digest.hexdigest()


def _digests(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """``heads`` (conv, conv_id, counts, cost, audit) with ``repaired_sha256``.

    One shuffle of the texts by conversation; a head comes before its rows, and a task holds one
    row at a time.
    """
    columns = heads.columns[1:]
    part = F.lit(1).alias("part")
    body = rows.select("conv", part, "turn", _digest().alias("digest"), "role", "text")
    both = heads.withColumn("part", F.lit(0)).unionByName(body, allowMissingColumns=True)
    order = ["conv", "part", F.col("turn").asc_nulls_first(), "digest"]
    stream = both.repartition("conv").sortWithinPartitions(*order).drop("digest", "turn")
    schema = heads.drop("conv").select("*", F.lit("").alias("repaired_sha256")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = repairer = None
        for batch in batches:
            done, digests = [], []
            parts, roles, texts = (batch[name].to_pylist() for name in ("part", "role", "text"))
            for at, is_row in enumerate(parts):
                if is_row:
                    repairer.row(roles[at], texts[at])
                    continue
                if head is not None:
                    done.append(head)
                    digests.append(repairer.end())
                head = batch.slice(at, 1).select(columns)
                repairer = Repairer(head["audit"][0].as_py())
            if done:
                table = pa.Table.from_batches(done).combine_chunks()
                yield from table.append_column("repaired_sha256", pa.array(digests, pa.string())).to_batches()
        if head is not None:
            table = pa.Table.from_batches([head])
            yield from table.append_column("repaired_sha256", pa.array([repairer.end()], pa.string())).to_batches()

    return stream.mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation its faults, the cheapest repair and the digest of the repaired rows.

    ``rows`` has conv, conv_id, turn, role, text and, if some of them were dropped, ``kept``
    (``normal_rows``, ``damaged``). Rows of a conversation follow by turn, nulls first; rows with one
    turn by a digest of role and text, so equal rows stand together. A conversation without kept
    rows has zeros, no edits and the digest of the empty text. Null conv_ids are one conversation.
    An empty table gives no rows; other columns are not read.

    ``audit`` is one text per conversation with a letter per row, and the digest reads its rows one
    after the other: both are what a conversation's own length allows.
    """
    spark = rows.sparkSession
    bound_batches(spark)
    if "kept" not in rows.columns:
        rows = rows.withColumn("kept", F.lit(True))
    kept = rows.where("kept").drop("kept")
    turn = F.when(F.col("kept"), F.col("turn"))
    gaps = F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn)
    facts = rows.groupBy("conv").agg(F.min("conv_id").alias("conv_id"), F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"))
    plans = _plans(materialize(_symbols(kept), "symbols"))
    zero = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
    heads = facts.join(plans, "conv", "left").select(
        "conv", "conv_id", "gaps", *zero, F.coalesce("audit", F.lit("")).alias("audit")
    )
    return _digests(kept, materialize(heads, "plans"))
