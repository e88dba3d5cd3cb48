"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, counted over a corpus.

Both encode the same text. Byte offsets where a token of each ends cut their tokens into groups;
every token of one side is linked with every token of the other side of its group. A pair's count is
the number of documents that hold it linked.

Counting is external. A task aligns documents and spills records (pair, document, times) in sorted
runs, one per radix of the first side's id, compressed with zstd. Runs of a radix are merged by a
heap over their next id of the first side, a bounded number at a time: merged runs hold counts
alone, so their size is bounded by the vocabularies and not by the corpus. The last merge passes the
first side's ids in order, all pairs of an id at once, so it knows each id's highest count as it
goes. Counts then meet the records again, radix by radix in cells of a bounded number of runs,
and what each record contributes to its document is streamed back and summed per block of documents.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterline.llm.bpe import broadcast_tokenizer
from blotterline.llm.byte_level import byte_level, token_bytes
from blotterline.llm.common import materialize

#: Radixes of the first side's ids (a power of two), links of a block of documents (or one
#: document), runs that one merge or cell takes (on average).
RADIXES, BLOCK_LINKS, RUNS = 32, 3_000_000, 48
FRAME_CHARS = 1_000_000
#: A pair is first id << ID_BITS | second id; a record is a pair << SLOT_BITS | place of the document.
ID_BITS, SLOT_BITS = 20, 23
#: Groups with more links than this are counted by distinct ids instead of link by link.
LARGE_GROUP = 4_096


class Sides:
    """Both tokenizers: ids of a text, and the bytes that each id stands for."""

    def __init__(self, first_file: str, second_model: bytes):
        self.first = byte_level(first_file, special=False)
        if self.first is None:
            raise ValueError("the first tokenizer must be a plain byte-level BPE file")
        known = {number: token for token, number in token_bytes(json.loads(first_file)).items()}
        self.first_bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second_model)
        self.second_bytes = [self._piece(i) for i in range(self.second.get_piece_size())]
        if max(len(self.first_bytes), len(self.second_bytes)) > 1 << ID_BITS:
            raise ValueError(f"more than {1 << ID_BITS} ids")
        self.first_sizes, self.second_sizes = (
            np.array([len(b) for b in table], np.int64) for table in (self.first_bytes, self.second_bytes)
        )
        # An id with what follows it in the written form of groups.
        self.written = [
            f"{i}{mark}"
            for table, marks in ((self.first_bytes, ",|"), (self.second_bytes, ",;"))
            for mark in marks
            for i in range(len(table))
        ]

    def _piece(self, number: int) -> bytes:
        piece = self.second.id_to_piece(number)
        if self.second.is_byte(number):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides of each text; None where a side's bytes are not a blank and the text."""
        found: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text, second in zip(texts, self.second.encode(texts, num_threads=1), strict=True):
            body = b" " + text.encode("utf-8", "surrogatepass")
            first = self.first.ids(f" {text}") if text else np.zeros(0, np.uint32)
            same = (
                len(text) > 0
                and b"".join(map(self.first_bytes.__getitem__, first.tolist())) == body
                and b"".join(map(self.second_bytes.__getitem__, second)) == body
            )
            found.append((first.astype(np.int64), np.array(second, np.int64)) if same else None)
        return found


_SIDES: dict[tuple[int, int], Sides] = {}


def sides_of(first: Broadcast, second: Broadcast) -> Sides:
    """The worker's tokenizers, made once."""
    key = hash(first.value), hash(second.value)
    if key not in _SIDES:
        _SIDES.clear()
        _SIDES[key] = Sides(first.value, second.value)
    return _SIDES[key]


def broadcast_sides(spark: SparkSession, first: str, second: str) -> tuple[Broadcast, Broadcast]:
    """Both files (a few MB, whatever the corpus) for all executors."""
    with open(second, "rb") as file:
        model = file.read()
    return broadcast_tokenizer(spark, first), spark.sparkContext.broadcast(model)


class Groups:
    """The groups of several texts one after another; texts whose sides differ have none."""

    def __init__(self, sides: Sides, texts: list[str]):
        encoded = sides.encode(texts)
        there = [pair for pair in encoded if pair is not None]
        empty = np.zeros(0, np.int64)
        self.a, self.b = (np.concatenate([empty, *(pair[side] for pair in there)]) for side in (0, 1))
        ends_a, ends_b = np.cumsum(sides.first_sizes[self.a]), np.cumsum(sides.second_sizes[self.b])
        #: Byte offsets, over all texts, where groups end; ends of texts are among them.
        self.ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.of_a, self.of_b = np.searchsorted(self.ends, ends_a), np.searchsorted(self.ends, ends_b)
        count = len(self.ends)
        self.n_a, self.n_b = np.bincount(self.of_a, minlength=count), np.bincount(self.of_b, minlength=count)
        self.first_a, self.first_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        tokens = [(len(pair[0]), len(pair[1])) if pair is not None else (0, 0) for pair in encoded]
        #: Where each text's tokens and groups begin; one entry more for the end.
        self.start_a, self.start_b = (np.cumsum([0, *(n[side] for n in tokens)]) for side in (0, 1))
        self.start = np.concatenate([self.of_a, [count]])[self.start_a]
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.start))  # of each group
        self.sides = sides

    def written(self) -> list[str]:
        """Each text's groups as text: ids of both sides, groups divided by semicolons."""
        last_a = np.arange(len(self.a)) == (self.first_a + self.n_a - 1)[self.of_a]
        last_b = np.arange(len(self.b)) == (self.first_b + self.n_b - 1)[self.of_b]
        n, m = len(self.sides.first_bytes), len(self.sides.second_bytes)
        keys = np.empty(len(self.a) + len(self.b), np.int64)
        keys[np.arange(len(self.a)) + self.first_b[self.of_a]] = self.a + n * last_a
        keys[np.arange(len(self.b)) + (self.first_a + self.n_a)[self.of_b]] = 2 * n + self.b + m * last_b
        bounds = (self.start_a + self.start_b).tolist()
        table = self.sides.written
        return ["".join(map(table.__getitem__, keys[x:y].tolist()))[:-1] for x, y in zip(bounds, bounds[1:])]

    def records(self) -> tuple[np.ndarray, np.ndarray]:
        """(pair, text) of all links as sorted distinct numbers, and how many links each has."""
        links = self.n_a * self.n_b
        usual = (links <= LARGE_GROUP)[self.of_a]
        a, group = np.flatnonzero(usual), self.of_a[usual]
        times = self.n_b[group]
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        second = self.b[np.repeat(self.first_b[group], times) + within]
        pairs = (np.repeat(self.a[a], times) << ID_BITS) | second
        keys, counts = np.unique((pairs << SLOT_BITS) | np.repeat(self.text_of[group], times), return_counts=True)
        large = np.flatnonzero(links > LARGE_GROUP)
        if not len(large):
            return keys, counts
        all_keys, all_counts = [keys], [counts]
        for g in large.tolist():
            own_a, n = np.unique(self.a[self.first_a[g] : self.first_a[g] + self.n_a[g]], return_counts=True)
            own_b, m = np.unique(self.b[self.first_b[g] : self.first_b[g] + self.n_b[g]], return_counts=True)
            pairs = ((own_a[:, None] << ID_BITS) | own_b[None, :]).ravel()
            all_keys.append((pairs << SLOT_BITS) | int(self.text_of[g]))
            all_counts.append((n[:, None] * m[None, :]).ravel())
        keys, place = np.unique(np.concatenate(all_keys), return_inverse=True)
        summed = np.zeros(len(keys), np.int64)
        np.add.at(summed, place, np.concatenate(all_counts))
        return keys, summed


# --- runs ----------------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers as one zstd frame; sorted ones are stored as differences."""
    pieces = []
    for array in arrays:
        array = np.asarray(array, np.int64)
        rising = len(array) > 0 and bool((np.diff(array) >= 0).all())
        body = np.diff(array, prepend=0) if rising else array
        width = 4 if len(body) == 0 or (body.min() >= 0 and body.max() < 1 << 32) else 8
        pieces.append(struct.pack("<QBB", len(array), rising, width))
        pieces.append(body.astype(np.uint32 if width == 4 else np.int64).tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(pieces))


def unpack(frame: bytes) -> list[np.ndarray]:
    body, at, found = zstandard.ZstdDecompressor().decompress(frame), 0, []
    while at < len(body):
        count, rising, width = struct.unpack_from("<QBB", body, at)
        at += 10
        array = np.frombuffer(body, np.uint32 if width == 4 else np.int64, count, at).astype(np.int64)
        at += count * width
        found.append(np.cumsum(array) if rising else array)
    return found


def merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs and counts of several sorted runs, all pairs of one first id at a time, in order."""
    cuts = []
    for pairs, _ in runs:
        firsts = pairs >> ID_BITS
        starts = np.flatnonzero(np.diff(firsts, prepend=-1))
        cuts.append((firsts[starts].tolist(), [*starts.tolist(), len(pairs)]))
    heap = [(firsts[0], run, 0) for run, (firsts, _) in enumerate(cuts) if firsts]
    heapq.heapify(heap)
    while heap:
        now, pieces = heap[0][0], []
        while heap and heap[0][0] == now:
            _, run, at = heap[0]
            firsts, starts = cuts[run]
            pairs, counts = runs[run]
            pieces.append((pairs[starts[at] : starts[at + 1]], counts[starts[at] : starts[at + 1]]))
            if at + 1 < len(firsts):
                heapq.heapreplace(heap, (firsts[at + 1], run, at + 1))
            else:
                heapq.heappop(heap)
        if len(pieces) == 1:
            yield pieces[0]
            continue
        pairs, place = np.unique(np.concatenate([p for p, _ in pieces]), return_inverse=True)
        total = np.zeros(len(pairs), np.int64)
        np.add.at(total, place, np.concatenate([c for _, c in pieces]))
        yield pairs, total


class Spill:
    """Records of the documents of one block; gives a sorted run per radix."""

    def __init__(self):
        self.keys, self.times, self.links, self.documents = [], [], 0, 0

    def add(self, groups: Groups, texts: int) -> None:
        keys, times = groups.records()
        self.keys.append(keys + self.documents)
        self.times.append(times)
        self.links += len(keys)
        self.documents += texts

    def runs(self) -> Iterator[tuple[int, bytes, bytes]]:
        """radix, pairs with their number of documents, and documents with their number of links."""
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        radix = (keys >> (SLOT_BITS + ID_BITS)) & (RADIXES - 1)
        for own in range(RADIXES):
            some = radix == own
            if some.any():
                pairs, counts = np.unique(keys[some] >> SLOT_BITS, return_counts=True)
                slots = keys[some] & ((1 << SLOT_BITS) - 1)
                yield own, pack(pairs, counts), pack(slots, times[some])


# --- documents, on Spark -------------------------------------------------------------------------

SPILLED = (
    "block long, slot long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "radix int, pairs binary, records binary"
)


def _frames(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of about ``FRAME_CHARS`` characters, or one text, with their texts; null is empty."""
    texts = [text or "" for text in batch["text"].to_pylist()]
    start = size = 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= FRAME_CHARS or at == len(texts) - 1:
            yield batch.slice(start, at + 1 - start), texts[start : at + 1]
            start, size = at + 1, 0


def spilled(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Rows of two kinds, stored: one per document (doc_id, block, slot, its numbers), and the runs
    of each block (block, radix, pairs, records; doc_id is null)."""
    specs = broadcast_sides(docs.sparkSession, first, second)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, spill = sides_of(*specs), Spill()
        block, own = TaskContext.get().partitionId() << 32, None
        names = [column.split()[0] for column in SPILLED.split(", ")]

        def rows(ids: pa.Array, **columns) -> pa.RecordBatch:
            kinds = [pa.int64()] * 6 + [pa.string(), pa.int32(), pa.binary(), pa.binary()]
            blank = [None] * len(ids)
            made = [pa.array(columns.get(name, blank), kind) for name, kind in zip(names, kinds, strict=True)]
            return pa.record_batch([ids, *made], names=["doc_id", *names])

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal spill, block
            for radix, pairs, records in spill.runs():
                # Run by run, so that no batch holds all of a block's runs.
                yield rows(pa.nulls(1, own), block=[block], radix=[radix], pairs=[pairs], records=[records])
            spill, block = Spill(), block + 1

        for batch in batches:
            own = batch["doc_id"].type
            for frame, texts in _frames(batch):
                if spill.documents + len(texts) >= 1 << SLOT_BITS:
                    yield from flush()
                groups = Groups(sides, texts)
                begin, end = groups.start[:-1], groups.start[1:]
                links = np.concatenate([[0], np.cumsum(groups.n_a * groups.n_b)])
                n_groups = end - begin
                digests = [
                    hashlib.sha256(text.encode()).hexdigest() if n else ""
                    for text, n in zip(groups.written(), n_groups.tolist(), strict=True)
                ]
                yield rows(
                    frame["doc_id"],
                    block=np.full(len(texts), block),
                    slot=spill.documents + np.arange(len(texts)),
                    n_a=np.diff(groups.start_a),
                    n_b=np.diff(groups.start_b),
                    n_groups=n_groups,
                    n_links=links[end] - links[begin],
                    groups_sha256=digests,
                )
                spill.add(groups, len(texts))
                if spill.links >= BLOCK_LINKS:
                    yield from flush()
        if spill.links:
            yield from flush()

    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return materialize(chosen.mapInArrow(run, f"doc_id {id_type}, {SPILLED}"), "aligned")


def _merge(runs: DataFrame, groups: int, last: bool) -> DataFrame:
    """Runs (run, radix, pairs) merged by radix and group; the last merge marks each first id's best."""
    dealt = runs.groupBy("radix", F.pmod(F.xxhash64("run"), F.lit(groups)).alias("run")).agg(F.collect_list("pairs").alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                pieces, best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], [np.zeros(0, np.int64)]
                for pairs, counts in merged([tuple(unpack(frame)) for frame in batch["runs"][at].as_py()]):
                    pieces.append((pairs, counts))
                    if last:
                        best.append((counts == counts.max()).astype(np.int64))
                arrays = [np.concatenate([piece[side] for piece in pieces]) for side in (0, 1)]
                frame = pack(*arrays, np.concatenate(best)) if last else pack(*arrays)
                yield pa.record_batch([batch["radix"].slice(at, 1), batch["run"].slice(at, 1), pa.array([frame], pa.binary())], names=["radix", "run", "pairs"])

    return dealt.select("radix", "run", "runs").mapInArrow(run, "radix int, run long, pairs binary")


def _counted(runs: DataFrame, blocks: int) -> DataFrame:
    """radix and ``counts``: all its pairs in order, their counts, and whether a count is the highest
    of its first id. One row per radix, bounded by the vocabularies."""
    now, groups = runs.select(F.col("block").alias("run"), "radix", "pairs"), -(-blocks // RUNS)
    while groups > 1:
        now = materialize(_merge(now, groups, last=False), "merged-runs")
        groups = -(-groups // RUNS)
    return materialize(_merge(now, 1, last=True).select("radix", F.col("pairs").alias("counts")), "pair-counts")


def pair_counts(docs: DataFrame, first: str, second: str) -> DataFrame:
    """a, b, n_docs, is_best of every linked pair of ids: in how many documents it is linked, and
    whether that is the most for its ``a`` (ties: all)."""
    runs = spilled(docs, first, second).where(F.col("radix").isNotNull())
    blocks = runs.select("block").distinct().count()
    counted = _counted(runs, max(1, blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for frame in batch["counts"]:
                pairs, counts, best = unpack(frame.as_py())
                columns = pairs >> ID_BITS, pairs & ((1 << ID_BITS) - 1), counts, best.astype(bool)
                for at in range(0, len(pairs), 100_000):
                    yield pa.record_batch([pa.array(c[at : at + 100_000]) for c in columns], names=["a", "b", "n_docs", "is_best"])

    return counted.select("counts").mapInArrow(run, "a long, b long, n_docs long, is_best boolean")


def spans(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, start, stop, a_ids, b_ids of every group: byte offsets in a blank and the text. No shuffle."""
    specs = broadcast_sides(docs.sparkSession, first, second)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = sides_of(*specs)
        for batch in batches:
            for frame, texts in _frames(batch):
                found = Groups(sides, texts)
                starts = np.concatenate([[0], found.ends])[:-1]
                # Offsets run over all texts of the frame: each text's begin where its first group does.
                begin = np.concatenate([starts, [0]])[found.start[:-1]]
                own = begin[found.text_of]
                ids = frame["doc_id"].take(pa.array(found.text_of))
                offsets = [pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()) for n in (found.n_a, found.n_b)]
                lists = [pa.ListArray.from_arrays(o, pa.array(x)) for o, x in zip(offsets, (found.a, found.b), strict=True)]
                yield pa.record_batch([ids, pa.array(starts - own), pa.array(found.ends - own), *lists], names=["doc_id", "start", "stop", "a_ids", "b_ids"])

    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(run, f"doc_id {id_type}, start long, stop long, a_ids array<long>, b_ids array<long>")


def alignments(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Per document n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``n_best`` are links whose pair's count is the highest of its first id over all documents (ties
    included), ``count_sum`` is the sum of the pairs' counts over the links. A text that is null or
    empty, or whose tokens are not a blank and the text, has zeros and an empty digest. Every row is
    a document: repeated rows and ids count as often as they occur. An empty table gives no rows;
    other columns are not read.
    """
    stored = spilled(docs, first, second)
    documents = stored.where(F.col("radix").isNull()).drop("radix", "pairs", "records")
    runs = stored.where(F.col("radix").isNotNull()).select("block", "radix", "pairs", "records")
    blocks = runs.select("block").distinct().count()
    zero = F.lit(0).cast("long")
    if not blocks:
        found = documents.withColumn("n_best", zero).withColumn("count_sum", zero)
    else:
        counted = _counted(runs, blocks)
        # Runs of a radix meet its counts in cells of a bounded number of runs.
        cells = -(-blocks // RUNS)
        left = runs.withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(cells)).cast("int"))
        right = counted.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))

        def cell(some: pa.Table, counts: pa.Table) -> pa.Table:
            pairs, totals, best = unpack(counts["counts"][0].as_py())
            made = []
            for own, records in zip(some["pairs"], some["records"], strict=True):
                wanted, n = unpack(own.as_py())
                slots, times = unpack(records.as_py())
                place = np.repeat(np.searchsorted(pairs, wanted), n)
                order = np.argsort(slots, kind="stable")
                starts = np.flatnonzero(np.diff(slots[order], prepend=-1))
                sums = (np.add.reduceat((times * x[place])[order], starts) for x in (best, totals))
                made.append(pack(slots[order][starts], *sums))
            return pa.table([some["block"], pa.array(made, pa.binary())], names=["block", "sums"])

        keys = ["radix", "cell"]
        shares = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "block long, sums binary")

        def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    parts = [unpack(frame) for frame in batch["sums"][at].as_py()]
                    slots, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                    sums = np.zeros((2, len(slots)), np.int64)
                    for side in (0, 1):
                        np.add.at(sums[side], place, np.concatenate([p[side + 1] for p in parts]))
                    block = np.full(len(slots), batch["block"][at].as_py())
                    yield pa.record_batch([pa.array(x) for x in (block, slots, *sums)], names=["block", "slot", "n_best", "count_sum"])

        by_block = shares.groupBy("block").agg(F.collect_list("sums").alias("sums"))  # one per radix
        sums = by_block.mapInArrow(total, "block long, slot long, n_best long, count_sum long")
        found = documents.join(sums, ["block", "slot"], "left")
    return found.select(
        "doc_id",
        *(F.coalesce(name, zero).alias(name) for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
        "groups_sha256",
    )
