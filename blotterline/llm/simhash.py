"""SimHash near-duplicates: fingerprints in Gray order under a hierarchy of masked bit patterns.

Sorted by their rank in the reflected Gray code, neighbours share most bits. Runs of the sorted
fingerprints are groups; a group keeps the bits that all members share (mask and pattern), and
groups of groups keep the bits that those share. For two nodes, the differences among bits that
both share are differences of every pair below them, so a pair of nodes with more than the
allowed number is dropped with all pairs below it.

Spark walks the upper levels as joins of node pairs with their children. Groups have a bounded
number of distinct fingerprints, however dense a cloud of near copies is. The lowest levels of a
pair of groups are walked inside one task on arrays, which returns a spanning forest of the links
it finds; no list of all pairs is made. Components of these links follow over several rounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from blotterline.llm.common import bound_batches, map_frames, materialize, numbered_rows, small_frames
from blotterline.llm.components import components, connect

MOST_DIFFERENT = 4
SHINGLE_WORDS = 4
#: Distinct fingerprints per group, children per upper node, and the same inside a group.
GROUP = 8_192
FAN_OUT = 16
LEAF, LEAVES = 64, 8
AT_ONCE = 256  # leaf pairs
#: Pairs of groups share tasks beyond half this number of them.
MOST_TASKS = 20_000
SHINGLES_AT_ONCE = 100_000


def simhash(text: str, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a whole text as a signed 64-bit integer.

    A-Z become lower case, words are runs without ASCII white space, shingles are joined by a
    blank and repeats count. A bit is set if it is in more than half of the hashes (XXH64, seed
    42). Fewer words are one shingle; no words give zero.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    count = max(1, len(words) - words_per_shingle + 1)
    if not words:
        return 0
    body = b" ".join(words)
    stops = np.cumsum(np.array([len(w) + 1 for w in words], np.int64)) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    ends = stops[min(words_per_shingle, len(words)) - 1 :]
    set_in = np.zeros(64, np.int64)
    for at in range(0, count, SHINGLES_AT_ONCE):
        spans = zip(starts[at : at + SHINGLES_AT_ONCE].tolist(), ends[at : at + SHINGLES_AT_ONCE].tolist())
        hashes = b"".join(map(xxh64_digest, [body[a:b] for a, b in spans], repeat(42)))
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        set_in += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > count).tobytes(), "big", signed=True)


def with_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint`` (long). Null text is the empty one. No shuffle."""
    bound_batches(docs.sparkSession)
    docs = docs.drop("fingerprint")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, text):
            texts = frame[text].fillna("").tolist()
            yield frame.assign(fingerprint=[simhash(t) for t in texts])

    return map_frames(docs, run, docs.select("*", F.lit(0).cast("long").alias("fingerprint")).schema)


def gray_rank(code: Column) -> Column:
    """The place of a 64-bit word in Gray order, as a signed integer in the same order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code.bitwiseXOR(F.lit(-(1 << 63)))


def _shared_differences(a: Column, b: Column) -> Column:
    """Differences among the bits that all members of ``a`` and all members of ``b`` share."""
    fixed = F.bitwise_not(a["all"].bitwiseXOR(a["any"])).bitwiseAND(
        F.bitwise_not(b["all"].bitwiseXOR(b["any"]))
    )
    return F.bit_count(a["all"].bitwiseXOR(b["all"]).bitwiseAND(fixed))


def _parents(nodes: DataFrame) -> DataFrame:
    """Nodes of the next level: id, shared bits, and children as an array."""
    child = F.struct("id", "all", "any")
    return nodes.groupBy(F.floor(F.col("id") / FAN_OUT).cast("long").alias("id")).agg(
        F.bit_and("all").alias("all"),
        F.bit_or("any").alias("any"),
        F.collect_list(child).alias("children"),
    )


def group_pairs(groups: DataFrame, count: int, most: int) -> DataFrame:
    """Pairs (a, b), a <= b, of ``groups`` (id, all, any) that may hold a link."""
    levels, width = [], count
    nodes = groups
    while True:
        nodes = materialize(_parents(nodes), "gray-nodes")
        levels.append(nodes)
        width = -(-width // FAN_OUT)
        if width <= 1:
            break
    pairs = levels[-1].select(F.col("id").alias("a"), F.col("id").alias("b"))
    for nodes in reversed(levels):
        left = nodes.select(F.col("id").alias("a"), F.col("children").alias("left"))
        right = nodes.select(F.col("id").alias("b"), F.col("children").alias("right"))

        met = pairs.join(left, "a").join(right, "b")
        found = F.flatten(
            F.transform(
                "left",
                lambda x: F.transform(
                    F.filter(
                        "right",
                        lambda y: ((F.col("a") < F.col("b")) | (x["id"] <= y["id"]))
                        & (_shared_differences(x, y) <= most),
                    ),
                    lambda y: F.struct(x["id"].alias("a"), y["id"].alias("b")),
                ),
            )
        )
        pairs = met.select(F.explode(found).alias("_pair")).select("_pair.a", "_pair.b")
    return pairs


def patterns(values: np.ndarray, sizes: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shared bits (mask, pattern) of runs of the sorted values, for each run length."""
    result = []
    for size in sizes:
        starts = np.arange(0, len(values), size)
        every = np.bitwise_and.reduceat(values, starts)
        some = np.bitwise_or.reduceat(values, starts)
        result.append((~(every ^ some), every))
    return result


def links(x: np.ndarray, y: np.ndarray, same: bool, most: int) -> np.ndarray:
    """Roots of a spanning forest of all pairs of ``x`` and ``y`` with at most ``most`` differing
    bits: entry i is the root of value i of ``x`` followed by ``y`` (``x`` alone if ``same``).

    Both are in Gray order; the walk goes from runs of 512 to runs of 64 to values.
    """
    parent = np.arange(len(x) if same else len(x) + len(y))
    offset = 0 if same else len(x)
    sizes = (LEAF * LEAVES, LEAF)
    left, right = patterns(x, sizes), patterns(y, sizes)
    i, j = (g.ravel() for g in np.meshgrid(np.arange(len(left[0][0])), np.arange(len(right[0][0])), indexing="ij"))
    for level in range(2):
        if level:
            children = np.arange(LEAVES)
            i, j = (
                np.broadcast_to((i * LEAVES)[:, None, None] + children[:, None], (len(i), LEAVES, LEAVES)).ravel(),
                np.broadcast_to((j * LEAVES)[:, None, None] + children[None, :], (len(j), LEAVES, LEAVES)).ravel(),
            )
            there = (i < len(left[1][0])) & (j < len(right[1][0]))
            i, j = i[there], j[there]
        if same:
            i, j = i[i <= j], j[i <= j]
        (mask_x, pattern_x), (mask_y, pattern_y) = left[level], right[level]
        differ = np.bitwise_count((pattern_x[i] ^ pattern_y[j]) & mask_x[i] & mask_y[j])
        i, j = i[differ <= most], j[differ <= most]
    own = np.arange(LEAF)
    for start in range(0, len(i), AT_ONCE):
        rows = i[start : start + AT_ONCE, None] * LEAF + own
        columns = j[start : start + AT_ONCE, None] * LEAF + own
        row_there, column_there = rows < len(x), columns < len(y)
        rows, columns = np.minimum(rows, len(x) - 1), np.minimum(columns, len(y) - 1)
        close = np.bitwise_count(x[rows][:, :, None] ^ y[columns][:, None, :]) <= most
        close &= row_there[:, :, None] & column_there[:, None, :]
        pair, r, c = np.nonzero(close)
        a, b = rows[pair, r], columns[pair, c] + offset
        parent = connect(parent, a, b)
    return parent


def fingerprint_links(distinct: DataFrame, most: int = MOST_DIFFERENT) -> DataFrame:
    """Edges (u, v) of spanning forests that together connect whatever ``distinct`` (a column
    fingerprint without repeats) links: at most ``most`` differing bits."""
    spark = distinct.sparkSession
    bound_batches(spark)
    ranked, count = numbered_rows(
        distinct.select("fingerprint", gray_rank(F.col("fingerprint")).alias("rank")), "rank"
    )
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    if not count:
        return spark.createDataFrame([], "u long, v long")
    groups = materialize(
        ranked.groupBy(F.expr(f"row_number div {GROUP}").alias("id")).agg(
            F.bit_and("fingerprint").alias("all"),
            F.bit_or("fingerprint").alias("any"),
            F.transform(
                F.sort_array(F.collect_list(F.struct("rank", "fingerprint"))), lambda m: m["fingerprint"]
            ).alias("members"),
        ),
        "gray-groups",
    )
    pairs = materialize(group_pairs(groups.drop("members"), -(-count // GROUP), most), "gray-pairs")
    # Few rows with much work each: the number of tasks is given, as adaptive execution goes by bytes.
    tasks = max(1, min(MOST_TASKS, 2 * pairs.count()))
    members = groups.select("id", "members")
    cells = (
        pairs.join(members.select(F.col("id").alias("a"), F.col("members").alias("x")), "a")
        .join(members.select(F.col("id").alias("b"), F.col("members").alias("y")), "b")
        .repartition(tasks, "a", "b")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a, b = batch["a"][row].as_py(), batch["b"][row].as_py()
                x, y = (
                    batch[name][row].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    for name in ("x", "y")
                )
                parent = links(x, y, a == b, most)
                values = x if a == b else np.concatenate([x, y])
                linked = np.flatnonzero(parent != np.arange(len(parent)))
                yield pa.record_batch(
                    [values[linked].view(np.int64), values[parent[linked]].view(np.int64)], schema=schema
                )

    return cells.select("a", "b", "x", "y").mapInArrow(search, "u long, v long")


def near_duplicates(
    docs: DataFrame, most: int = MOST_DIFFERENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every document with its fingerprint (long) and component_id.

    Documents are linked if their fingerprints differ in at most ``most`` bits, and a component
    is what links reach; its id is its smallest doc_id. Null, empty and blank texts have
    fingerprint 0 and are linked like others. Documents with one fingerprint are one entry of the
    search, so copies cost no pairs. Repeated rows stay; an empty table gives no rows; other
    columns are not read.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    marked = materialize(with_fingerprint(chosen).select("doc_id", "fingerprint"), "fingerprints")
    return classes(marked, most).select("doc_id", "fingerprint", "component_id")


def classes(marked: DataFrame, most: int = MOST_DIFFERENT) -> DataFrame:
    """``marked`` (doc_id, fingerprint, others) with ``component``, the least fingerprint linked,
    and ``component_id``, the smallest doc_id linked."""
    distinct = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    linked = components(fingerprint_links(distinct.select("fingerprint"), most))
    owner = distinct.join(
        linked.select(F.col("node").alias("fingerprint"), "component"), "fingerprint", "left"
    ).withColumn("component", F.coalesce("component", "fingerprint"))
    named = owner.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = materialize(
        owner.join(named, "component").select("fingerprint", "component", "component_id"), "classes"
    )
    return marked.join(of_print, "fingerprint")


def one_of_each(docs: DataFrame, most: int = MOST_DIFFERENT) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    Rows with the same doc_id and text are one document, so one of them stays.
    """
    key = [
        F.xxhash64("doc_id", "text").alias("_key"),
        F.coalesce(F.octet_length("text"), F.lit(-1)).alias("_size"),
    ]
    marked = with_fingerprint(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    marked = materialize(marked.select("doc_id", "fingerprint", *key), "fingerprints")
    kept = classes(marked, most).groupBy("component").agg(
        F.min(F.struct("doc_id", "_size", "_key")).alias("_one")
    )
    kept = kept.select("_one._key", "_one._size")
    found = docs.select(F.struct("*").alias("row"), *key).join(kept, ["_key", "_size"], "left_semi")
    return found.dropDuplicates(["_key", "_size"]).select("row.*")


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
