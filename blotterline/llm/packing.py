"""Best-fit packing of tokenized documents by a grouping genetic algorithm on islands.

A document is its ids and a closing id. Longer ones are cut from the end into full sequences, so
only their first piece may be shorter. Full pieces are sequences of their own; the others are
packed. They are dealt into blocks of bounded size, and each block is solved by several islands,
each with a population of packings:

* crossover takes whole well-filled sequences of one parent into the other, removes the other's
  sequences that hold any of the same pieces, and puts the displaced pieces back by best fit;
* mutation empties the worst and some random sequences and puts their pieces back;
* the fittest (largest mean of squared fill) survive; after each epoch every island gets the
  best packing of its neighbour.

Sequences of the best packing that are not well filled give their pieces to a second level of
blocks, which are packed the same way, if there is more than one block: what a single block leaves
has nothing else to be packed with. An island is one row (lengths and packings as arrays of
bounded size), so epochs are maps and migration is one shuffle of these rows.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotterline.llm.bpe import broadcast_tokenizer, codec_of
from blotterline.llm.byte_level import byte_level
from blotterline.llm.common import map_frames, materialize, small_frames

CAPACITY = 2048
#: Pieces per block: bounds an island's memory; the waste of a block falls with its size.
BLOCK_PIECES = 16_384
ISLANDS, EPOCHS = 2, 2
POPULATION, OFFSPRING = 4, 6
WELL_FILLED = 0.995
LEVELS = 2
#: Islands share tasks beyond this number of them.
MOST_TASKS = 20_000


def token_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of every document.

    Null text is the empty one, which is the closing id alone. No shuffle.
    """
    spec = broadcast_tokenizer(docs.sparkSession, path)
    kind = docs.schema[doc_id].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = byte_level(spec.value) or codec_of(spec)
        for frame in small_frames(frames, "text", 2_000_000):
            rows = []
            encoded = codec.encode(frame["text"].fillna("").tolist())
            for at, ids in enumerate(encoded):
                ids += end
                count = len(ids) // 4
                first = count % capacity or capacity
                start, piece, stop = 0, 0, first
                while start < count:
                    rows.append((at, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, piece, stop = stop, piece + 1, stop + capacity
            made = pd.DataFrame(rows, columns=["at", "piece", "start", "length", "ids_crc32"])
            made.insert(0, "doc_id", frame["doc_id"].take(made.pop("at")).reset_index(drop=True))
            yield made

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_frames(chosen, run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class OpenSequences:
    """Sequences by the room they have left, and the one that fits best."""

    def __init__(self, room: list[int]):
        self.by_room: dict[int, list[int]] = {}
        self.there = 0  # bit r: some sequence has room r
        self.count = len(room)
        for at, left in enumerate(room):
            self._add(at, left)

    def _add(self, at: int, left: int) -> None:
        if left:
            self.by_room.setdefault(left, []).append(at)
            self.there |= 1 << left

    def put(self, length: int, capacity: int) -> int:
        """The sequence that takes the piece: the one with the least room for it, else a new one."""
        fitting = self.there >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            held = self.by_room[room]
            at = held.pop()
            if not held:
                self.there ^= 1 << room
        else:
            at, room, self.count = self.count, capacity, self.count + 1
        self._add(at, room - length)
        return at


def best_fit(lengths: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each piece, filled in the given order."""
    bins, packed = OpenSequences([]), np.empty(len(lengths), np.int32)
    for at in order.tolist():
        packed[at] = bins.put(int(lengths[at]), capacity)
    return packed


def fills(packing: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.bincount(packing, weights=lengths).astype(np.int64)


def fitness(packing: np.ndarray, lengths: np.ndarray, capacity: int) -> float:
    return float(np.mean((fills(packing, lengths) / capacity) ** 2))


def refill(
    packing: np.ndarray, displaced: np.ndarray, lengths: np.ndarray, capacity: int
) -> np.ndarray:
    """``packing`` with the displaced pieces put back by best fit, longest first."""
    kept = packing.copy()
    kept[displaced] = -1
    used, compact = np.unique(kept, return_inverse=True)
    kept = (compact - (1 if len(used) and used[0] == -1 else 0)).astype(np.int32)
    inside = kept >= 0
    room = capacity - np.bincount(kept[inside], weights=lengths[inside]).astype(int)
    bins = OpenSequences(room.tolist())
    for at in displaced[np.argsort(-lengths[displaced], kind="stable")].tolist():
        kept[at] = bins.put(int(lengths[at]), capacity)
    return kept


def crossover(
    giver: np.ndarray, taker: np.ndarray, lengths: np.ndarray, capacity: int, draw: random.Random
) -> np.ndarray:
    """``taker`` with well-filled sequences of ``giver``, whole."""
    filled = fills(giver, lengths)
    best = np.flatnonzero(filled >= max(WELL_FILLED * capacity, np.quantile(filled, 0.5)))
    chosen = best[np.array([draw.random() < 0.5 for _ in best], bool)] if len(best) else best
    injected = np.isin(giver, chosen)
    hit = np.isin(taker, np.unique(taker[injected]))
    child = taker.astype(np.int64)
    child[injected] = giver[injected].astype(np.int64) + len(lengths)
    return refill(child, np.flatnonzero(hit & ~injected), lengths, capacity)


def mutation(
    packing: np.ndarray, lengths: np.ndarray, capacity: int, draw: random.Random
) -> np.ndarray:
    filled = fills(packing, lengths)
    worst = np.argsort(filled, kind="stable")[: max(2, len(filled) // 50)]
    others = [draw.randrange(len(filled)) for _ in range(max(2, len(filled) // 50))]
    emptied = np.union1d(worst, others)
    return refill(packing, np.flatnonzero(np.isin(packing, emptied)), lengths, capacity)


def evolve(
    lengths: np.ndarray, population: list[np.ndarray], capacity: int, seed: int
) -> list[np.ndarray]:
    """One epoch of an island; gives its population, the fittest first."""
    draw, noise = random.Random(seed), np.random.default_rng(seed)
    if not len(lengths):
        return population
    if not population:
        population = [best_fit(lengths, np.argsort(-lengths, kind="stable"), capacity)]
    while len(population) < POPULATION:
        shaken = -lengths * (1 + 0.2 * noise.random(len(lengths)))
        population.append(best_fit(lengths, np.argsort(shaken, kind="stable"), capacity))
    least = -(-int(lengths.sum()) // capacity)
    for _ in range(OFFSPRING):
        population.sort(key=lambda p: -fitness(p, lengths, capacity))
        if population[0].max() + 1 == least:
            break  # no packing has fewer sequences
        a, b = draw.sample(range(len(population)), 2)
        child = crossover(population[b], population[a], lengths, capacity, draw)
        population.append(mutation(child, lengths, capacity, draw))
        population.sort(key=lambda p: -fitness(p, lengths, capacity))
        population.pop()
    return sorted(population, key=lambda p: -fitness(p, lengths, capacity))


def _epoch(states: DataFrame, tasks: int, capacity: int, number: int, seed: int) -> DataFrame:
    """One epoch of every island: a map over rows, dealt evenly over ``tasks``.

    The number is given, as adaptive execution goes by bytes and would put these few small rows
    with much work each into one task.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, island, lengths, population in frame.itertuples(index=False):
                lengths = np.asarray(lengths, np.int64)
                start = [np.asarray(p, np.int32) for p in population]
                own = zlib.crc32(f"{seed} {number} {block} {island}".encode())
                done = evolve(lengths, start, capacity, own)
                yield pd.DataFrame(
                    {
                        "block": [block],
                        "island": [island],
                        "lengths": [lengths],
                        "population": [done],
                        "fit": [fitness(done[0], lengths, capacity)],
                    }
                )

    schema = "block long, island int, lengths array<int>, population array<array<int>>, fit double"
    dealt = states.select("block", "island", "lengths", "population").repartition(tasks)
    return dealt.mapInPandas(run, schema)


def pack_blocks(pieces: DataFrame, capacity: int, seed: int) -> DataFrame:
    """``pieces`` (block, key, length) with ``bin``: their sequence in the block."""
    blocks = materialize(
        pieces.groupBy("block").agg(
            F.sort_array(F.collect_list(F.struct("key", F.col("length").cast("int").alias("length")))).alias("members")
        ),
        "packing-blocks",
    )
    states = blocks.select(
        "block",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.col("members.length").alias("lengths"),
        F.expr("CAST(array() AS array<array<int>>)").alias("population"),
    )
    tasks = max(1, min(MOST_TASKS, ISLANDS * blocks.count()))
    for number in range(EPOCHS):
        states = materialize(_epoch(states, tasks, capacity, number, seed), "islands")
        if number < EPOCHS - 1:
            # Each island also gets the best packing of the one before it in the ring.
            ring = Window.partitionBy("block").orderBy("island")
            last = F.max_by("population", "island").over(Window.partitionBy("block"))
            elite = F.coalesce(F.lag("population").over(ring), last)[0]
            kept = F.slice("population", 1, POPULATION - 1)
            states = states.withColumn("population", F.concat(kept, F.array(elite)))
    best = states.groupBy("block").agg(
        F.max_by(F.col("population")[0], F.struct("fit", "island")).alias("packing")
    )
    return blocks.join(best, "block").select(
        "block",
        F.explode(F.arrays_zip(F.col("members").alias("member"), F.col("packing").alias("bin"))).alias("_at"),
    ).select("block", F.col("_at.member.key").alias("key"), F.col("_at.member.length").cast("long").alias("length"), F.col("_at.bin").alias("bin"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, seed: int = 0) -> DataFrame:
    """Every piece with its ``sequence_id`` and its ``offset`` there.

    ``pieces`` has a column ``length`` (1 to ``capacity``) and any others, which stay. Offsets
    are gapless from 0. The same piece twice is two pieces. An empty frame gives no rows.
    """
    # The key is part of the stored rows: made anew by a later read, it could differ.
    stored = materialize(pieces.withColumn("_key", F.monotonically_increasing_id()), "pieces")
    full = stored.where(F.col("length") >= capacity)
    left = stored.where(F.col("length") < capacity).select(F.col("_key").alias("key"), "length")
    placed = None
    for level in range(LEVELS):
        left = left if level == 0 else materialize(left, "packing-left")
        count = left.count()
        if not count:
            break
        dealt = F.pmod(F.xxhash64("key", F.lit(seed + level)), F.lit(max(1, count // BLOCK_PIECES)))
        packed = materialize(
            pack_blocks(left.withColumn("block", dealt), capacity, seed + level), "packed"
        )
        filled = F.sum("length").over(Window.partitionBy("block", "bin"))
        packed = packed.withColumn("_filled", filled).withColumn("_level", F.lit(level))
        good = packed
        if level < LEVELS - 1 and count > BLOCK_PIECES:
            good = packed.where(F.col("_filled") >= WELL_FILLED * capacity)
            left = packed.where(F.col("_filled") < WELL_FILLED * capacity).select("key", "length")
        else:
            left = left.limit(0)
        placed = good if placed is None else placed.unionByName(good)
    kept = stored.columns[:-1]
    whole = full.select(*kept, (-F.col("_key") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if placed is None:
        return whole
    inside = Window.partitionBy("_level", "block", "bin").orderBy("key")
    offsets = placed.select(
        "key",
        (F.sum("length").over(inside) - F.col("length")).alias("offset"),
        ((F.col("_level").cast("long") * (1 << 56)) + F.col("block") * (1 << 24) + F.col("bin")).alias("sequence_id"),
    )
    rest = stored.where(F.col("length") < capacity).join(offsets, stored["_key"] == offsets["key"])
    return rest.select(*kept, "sequence_id", "offset").unionByName(whole)


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every document's pieces.

    Null and empty texts are one closing id. Repeated rows are packed as often as they occur.
    Other columns of ``docs`` are not read.
    """
    return pack(token_pieces(docs, path, capacity, end_id, doc_id, text), capacity, seed)
