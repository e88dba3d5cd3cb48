"""Document fingerprints by a randomised edit embedding.

A walk reads a text character by character. At step j it writes down the character under it and
moves on if a shared random bit of (j, character) says so, else stays. Two walks over similar
texts that drift apart by an edit meet again by chance, so a small edit distance becomes a small
Hamming distance between what they write down.

The bits are fixed by the step (modulo a period) and a hash of the character, so how long a walk
stays at a character is looked up, and the walk costs one step per character. A fingerprint
samples the written string at shared random places: each slot has its own increasing sequence of
places and uses the last one before the walk's end, which is spread evenly over texts of any
length and is the same place for texts of similar length. Slots grouped in bands find candidates;
the share of equal slots verifies them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotterline.llm.common import (
    bound_batches,
    by_global_order,
    crc32_of,
    map_frames,
    materialize,
    numbered_rows,
)
from blotterline.llm.components import components, connect

PERIOD = 4_096
CLASSES = 1_024  # character hashes
SLOTS = 128
SIDE_BY_SIDE = 4_096  # characters up to which texts walk side by side
#: Members of one block of a crowded bucket.
BUCKET_BLOCK = 256


@lru_cache(maxsize=1)
def stays() -> np.ndarray:
    """stays[c, j]: steps that a walk spends on a character of class c that it meets at step j.

    At most 255, so that no walk stays for ever.
    """
    draw = np.random.default_rng(20_240_501)
    leave = draw.integers(0, 2, (CLASSES, PERIOD), np.uint8).astype(bool)
    leave[:, -1] = True
    steps = np.arange(2 * PERIOD)
    following = np.where(np.concatenate([leave, leave], axis=1), steps, 2 * PERIOD)
    following = np.minimum.accumulate(following[:, ::-1], axis=1)[:, ::-1]
    return np.minimum(following[:, :PERIOD] - steps[:PERIOD] + 1, 255).astype(np.int32)


def sampled_places(steps: np.ndarray) -> np.ndarray:
    """For each walk length and slot the place sampled: the last of the slot's places below it.

    The n-th place of a slot follows from the one before and a random number as the next record
    of independent draws does, so the last one below any length is evenly spread below it.
    """
    places = np.zeros((len(steps), SLOTS), np.int64)
    most = int(steps.max(initial=0))
    at, level = np.zeros(SLOTS, np.int64), 0
    while (at < most).any():
        below = at[None, :] < steps[:, None]
        places = np.where(below, at[None, :], places)
        at = np.minimum(np.floor((at + 1) / _uniform(level)), 1 << 60).astype(np.int64)
        level += 1
    return places


@lru_cache(maxsize=4096)
def _uniform(level: int) -> np.ndarray:
    return 1 - np.random.default_rng([7, level]).random(SLOTS)


def walk(texts: list[str]) -> list[np.ndarray]:
    """Per text the step at which the walk leaves each character (running, from 1)."""
    table = stays()
    classes = [
        (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % CLASSES
        for t in texts
    ]
    ends = [np.zeros(len(c), np.int64) for c in classes]
    order = sorted(range(len(texts)), key=lambda i: -len(classes[i]))
    lengths = np.array([len(classes[i]) for i in order])
    width = min(SIDE_BY_SIDE, int(lengths.max(initial=0)))
    state = np.zeros(len(texts), np.int64)  # step so far
    if width:
        grid = np.zeros((width, len(texts)), np.int64)
        for column, i in enumerate(order):
            grid[: len(classes[i]), column] = classes[i][:width]
        flat = table.ravel()
        # Texts get shorter from left to right, so those still walking are the first ones.
        active = np.searchsorted(-lengths, -np.arange(width), side="left")
        for at in range(width):
            n = active[at]
            now = state[:n]
            now += flat[grid[at, :n] * PERIOD + (now & (PERIOD - 1))]
            grid[at, :n] = now
        for column, i in enumerate(order):
            n = min(width, len(classes[i]))
            ends[i][:n] = grid[:n, column]
    for column, i in enumerate(order):
        if len(classes[i]) <= width:
            break
        # The rest of a long text walks alone.
        rows, step, written = _rows(), int(state[column]), []
        for c in classes[i][width:].tolist():
            step += rows[c][step & (PERIOD - 1)]
            written.append(step)
        ends[i][width:] = written
    return ends


@lru_cache(maxsize=1)
def _rows() -> list[bytes]:
    """``stays`` for single walks: byte strings are read fast."""
    return [row.astype(np.uint8).tobytes() for row in stays()]


def embed(texts: list[str]) -> np.ndarray:
    """Fingerprints: a row of ``SLOTS`` bytes per text. An empty text has zeros."""
    ends = walk(texts)
    steps = np.array([int(e[-1]) if len(e) else 0 for e in ends])
    places = sampled_places(steps)
    prints = np.zeros((len(texts), SLOTS), np.uint8)
    for i, (text, end) in enumerate(zip(texts, ends, strict=True)):
        if len(end):
            under = np.searchsorted(end, places[i], side="right")
            codes = np.array([ord(text[k]) for k in under.tolist()], np.uint64)
            # One to 255: a place with a character never equals an empty text's.
            prints[i] = 1 + (codes * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(40)) % np.uint64(255)
    return prints


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots, row by row: 1 less the Hamming distance as a share."""
    return (a == b).mean(axis=1)


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )


def _groups(frame: pd.DataFrame, most_chars: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """Runs of rows, in order, of about ``most_chars`` characters or one text."""
    run = frame["text"].str.len().cumsum() // most_chars
    for _, part in frame.groupby(run, sort=True):
        yield part.reset_index(drop=True)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``fingerprint`` (binary, ``SLOTS`` bytes) of every whole text. No shuffle.

    Null is the empty text, whose fingerprint is zeros. Equal texts have equal fingerprints.
    Repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in _groups(frame):
                prints = [row.tobytes() for row in embed(part["text"].tolist())]
                yield pd.DataFrame({"doc_id": part["doc_id"], "fingerprint": prints})

    return map_frames(_texts(docs, doc_id, text), run, f"doc_id {kind}, fingerprint binary")


def bands_for(least: float) -> int:
    """Bands that each hold other slots, so many that fingerprints of that likeness agree in one whole
    band: one more than the slots in which they may differ."""
    return min(SLOTS, int(math.floor((1 - least) * SLOTS + 1e-9)) + 1)


def similar_documents(
    docs: DataFrame, least: float = 0.8, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, fingerprint and ``class_id``: documents linked by fingerprints of likeness ``least``.

    Distinct fingerprints that agree in all slots of a band meet and are verified; the bands miss no
    pair of that likeness. Classes are what the verified links connect, named by their smallest
    doc_id. A bucket is cut into blocks that meet two by two, so no task holds a crowded bucket, and a
    cell returns a spanning forest of its links, not all pairs. Equal fingerprints are one entry.
    """
    marked = materialize(fingerprints(docs, doc_id, text), "edit-fingerprints")
    distinct, _ = numbered_rows(
        marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "fingerprint", column="node"
    )
    distinct = materialize(distinct, "edit-distinct")
    count = bands_for(least)

    def band(b: int) -> Column:
        # Bit-sampled: each band takes its own slots, spread over the fingerprint.
        own = [F.substring("fingerprint", 1 + at, 1) for at in range(b, SLOTS, count)]
        return F.xxhash64(F.lit(b), F.concat(*own))

    # A key is eight bytes; fingerprints follow only where two of them share one.
    banded = distinct.select("node", F.explode(F.array(*[band(b) for b in range(count)])).alias("key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("count")).where("count > 1")
    sizes = sizes.withColumn("blocks", F.ceil(F.col("count") / BUCKET_BLOCK).cast("int")).drop("count")
    met = materialize(banded.join(sizes, "key"), "edit-buckets")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = met.withColumn("own", own).join(distinct.select("node", "fingerprint"), "node")
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = met.select(
        "key",
        F.least("own", "other").alias("a"),
        F.greatest("own", "other").alias("b"),
        (F.col("own") > F.col("other")).alias("second"),
        "node",
        "fingerprint",
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spanning forests of the links within each cell."""
        for batch in batches:
            members = batch["members"]
            bounds = (members.offsets.to_numpy() - members.offsets[0].as_py()).tolist()
            flat = members.flatten()
            prints = np.frombuffer(b"".join(flat.field("fingerprint").to_pylist()), np.uint8).reshape(-1, SLOTS)
            nodes, second = flat.field("node").to_numpy(), flat.field("second").to_numpy(zero_copy_only=False)
            sizes = np.diff(bounds)
            # Most cells are two documents: all of these at once.
            twos = np.array(bounds[:-1], np.int64)[sizes == 2]
            linked = twos[likeness(prints[twos], prints[twos + 1]) >= least]
            u, v = [nodes[linked]], [nodes[linked + 1]]
            for at in np.flatnonzero(sizes > 2).tolist():
                own = slice(bounds[at], bounds[at + 1])
                cell, is_second = prints[own], second[own]
                parent = np.arange(len(cell))
                columns = np.flatnonzero(is_second) if is_second.any() else parent
                for row in np.flatnonzero(~is_second).tolist():
                    near = columns[likeness(cell[columns], cell[row]) >= least]
                    parent = connect(parent, np.full(len(near), row), near)
                linked = np.flatnonzero(parent != np.arange(len(parent)))
                u.append(nodes[own][linked])
                v.append(nodes[own][parent[linked]])
            yield pa.record_batch([np.concatenate(u), np.concatenate(v)], names=["u", "v"])

    together = cells.groupBy("key", "a", "b").agg(F.collect_list(F.struct("second", "node", "fingerprint")).alias("members"))
    edges = together.where(F.size("members") > 1).select("members").mapInArrow(verify, "u long, v long")
    found = components(edges)
    owner = distinct.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = owner.groupBy("component").agg(F.min("least").alias("class_id"))
    of_print = materialize(owner.join(named, "component").select("fingerprint", "class_id"), "edit-classes")
    return marked.join(of_print, "fingerprint").select("doc_id", "fingerprint", "class_id")


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the beginning of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and the likenesses.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hexadecimal), near_edited,
    near_next. The next document follows by doc_id, the first follows the last; documents with one
    doc_id follow each other by their CRC. A single document is its own next.

    One range shuffle by doc_id puts next documents side by side. Only the first and last
    document of a range wait for those of the ranges beside it.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    keyed = _texts(docs, doc_id, text).withColumn("_crc", crc32_of(F.col("text")))
    ordered = by_global_order(keyed, "doc_id", "_crc").select(
        F.spark_partition_id().alias("part"), "doc_id", "text"
    )
    columns = ["part", "open", "doc_id", "n_chars", "sha", "own", "new", "near_edited", "near_next", "text"]

    def compared(ids: list, texts: list[str], prints: np.ndarray) -> pd.DataFrame:
        """Rows of all documents but the last, which is the next of the one before."""
        new_texts = [edited(t, n) for t, n in zip(texts, texts[1:])]
        new = embed(new_texts)
        own, following = prints[:-1], prints[1:]
        return pd.DataFrame(
            {
                "part": None,
                "open": None,
                "doc_id": ids[:-1],
                "n_chars": [len(t) for t in texts[:-1]],
                "sha": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new_texts],
                "own": [p.tobytes().hex() for p in own],
                "new": [p.tobytes().hex() for p in new],
                "near_edited": likeness(own, new),
                "near_next": likeness(own, following),
                "text": None,
            },
            columns=columns,
        )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, prints, part = [], [], np.zeros((0, SLOTS), np.uint8), None
        for frame in frames:
            for some in _groups(frame):
                first = not texts
                part = int(some["part"].iloc[0])
                ids, texts = [*ids, *some["doc_id"].tolist()], [*texts, *some["text"].tolist()]
                prints = np.concatenate([prints, embed(some["text"].tolist())])
                if first:
                    yield pd.DataFrame([(part, False, ids[0], *[None] * 6, texts[0])], columns=columns)
                if len(texts) > 1:
                    yield compared(ids, texts, prints)
                ids, texts, prints = ids[-1:], texts[-1:], prints[-1:]
        if texts:
            yield pd.DataFrame([(part, True, ids[0], *[None] * 6, texts[0])], columns=columns)

    schema = (
        f"part int, open boolean, doc_id {kind}, n_chars long, sha string, own string, new string, "
        "near_edited double, near_next double, text string"
    )
    stored = materialize(map_frames(ordered, run, schema), "edited")
    # Two documents per range; the ranges' numbers alone go through the window.
    edges = stored.where(F.col("part").isNotNull())
    parts = edges.where("open").select("part")
    order = Window.orderBy("part")
    following = F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy()))
    heads = edges.where("NOT open").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    waiting = (
        edges.where("open")
        .join(parts.select("part", following.alias("next")), "part")
        .join(heads, "next")
        .select("doc_id", "text", "next_text")
    )

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                pair = [row.text, row.next_text]
                made = compared([row.doc_id, None], pair, embed(pair))
                yield made.drop(columns=["part", "open", "text"])

    done = ["doc_id", "n_chars", "sha", "own", "new", "near_edited", "near_next"]
    finished = map_frames(
        waiting,
        finish,
        f"doc_id {kind}, n_chars long, sha string, own string, new string, near_edited double, near_next double",
    )
    return stored.where(F.col("part").isNull()).select(*done).unionByName(finished).select(
        "doc_id",
        "n_chars",
        F.col("sha").alias("edited_sha256"),
        F.col("own").alias("fingerprint"),
        F.col("new").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
