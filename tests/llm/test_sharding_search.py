from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from blotterline.llm.sharding import ROUNDS, permuted, shard_rows
from blotterline.llm.vector_search import quantised, search_block, top_k

DOCS = "doc_id long, text string, size string, shard string, slot string"


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def spark_xxhash(x: int, i: int, seed: int) -> int:
    state = xxhash.xxh64_intdigest(struct.pack("<q", x), seed=42)
    state = xxhash.xxh64_intdigest(struct.pack("<i", i), seed=state)
    return signed(xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=state))


def feistel(number: int, total: int, seed: int) -> int:
    """The permutation in plain Python."""
    bits = max(2, (total - 1).bit_length())
    low = bits // 2
    while True:
        for i in range(ROUNDS):
            if i % 2 == 0:
                number ^= (spark_xxhash(number & ((1 << low) - 1), i, seed) & ((1 << (bits - low)) - 1)) << low
            else:
                number ^= spark_xxhash(number >> low, i, seed) & ((1 << low) - 1)
        if number < total:
            return number


@pytest.mark.parametrize("total", [1, 2, 3, 5, 64, 65, 1000])
def test_permutation_is_one_to_one_and_equals_plain_python(spark, total):
    rows = spark.range(total).select("id", permuted(F.col("id"), total, 3).alias("to")).collect()
    assert sorted(r["to"] for r in rows) == list(range(total))
    assert all(r["to"] == feistel(r["id"], total, 3) for r in rows[:50])


def test_shards_hold_every_row_once(spark):
    texts = ["same"] * 40 + [None, "", "é" * 5000] + [f"text {i}" for i in range(60)]
    docs = spark.createDataFrame([(i // 2 if i < 90 else None, t, "a", "b", "c") for i, t in enumerate(texts)], DOCS)
    got = shard_rows(docs, shards=7).toPandas()
    assert len(got) == len(texts)
    sizes = got.groupby("shard")["slot"].agg(["count", "max", "nunique"])
    assert sizes["count"].max() - sizes["count"].min() <= 1
    assert (sizes["max"] + 1 == sizes["count"]).all() and (sizes["nunique"] == sizes["count"]).all()
    assert sorted(got["size"]) == sorted(len((t or "").encode()) + 1 for t in texts)
    assert sorted(got["text_crc32"]) == sorted(zlib.crc32((t or "").encode()) for t in texts)
    assert got["grown_shard"].isna().all() and set(got["law"]) == {"rows"}
    again = shard_rows(docs.repartition(5), shards=7).toPandas()
    columns = ["text_crc32", "shard", "slot"]
    assert sorted(map(tuple, got[columns].values)) == sorted(map(tuple, again[columns].values))


def test_empty_table_has_no_shards(spark):
    assert shard_rows(spark.createDataFrame([], DOCS)).count() == 0


VECTORS = "vec_id long, embedding array<float>, score string, rank string"


def brute(rows: list[tuple], queries: list[tuple], k: int) -> list[tuple]:
    found = []
    for query_id, q in queries:
        scored = sorted((-sum(a * b for a, b in zip(q, x)), i) for i, x in rows if i != query_id and len(x) == len(q))
        found += [(query_id, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(found)


def test_top_k_equals_brute_force_with_ties_and_dirt(spark):
    draw = np.random.default_rng(0)
    rows = [(i, draw.normal(size=24).round(1).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 24) for i in range(100)]  # one common vector
    rows += [(7, rows[7][1]), (500, [1.0] * 5), (550, [2.0] * 5), (600, None), (650, [float("nan")] * 24)]
    rows += [(651, [1.0, None] * 12), (652, [float("inf")] * 24), (700, [])]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], VECTORS)
    whole = quantised(frame)
    clean = [(r["vec_id"], r["vector"]) for r in whole.collect()]
    assert {600, 650, 651, 652}.isdisjoint(i for i, _ in clean)
    assert all(v == [int(np.floor(256 * float(np.float32(x)))) for x in dict(rows)[i]] for i, v in clean)
    got = top_k(whole, whole.where("vec_id % 50 = 0"), k=5)
    expected = brute(clean, [(i, v) for i, v in clean if i % 50 == 0], 5)
    assert sorted(map(tuple, got.collect())) == expected


def test_few_candidates_and_empty_tables(spark):
    frame = spark.createDataFrame([(0, [1.0], "", ""), (1, [2.0], "", "")], VECTORS)
    whole = quantised(frame)
    assert sorted(map(tuple, top_k(whole, whole, 5).collect())) == [(0, 1, 1, 131072), (1, 1, 0, 131072)]
    assert top_k(whole.limit(0), whole.limit(0), 5).count() == 0


def test_block_search_is_exact_for_large_components():
    draw = np.random.default_rng(1)
    x = draw.integers(-(10**9), 10**9, (200, 16))
    found = search_block(x[:5], np.arange(5), x, np.arange(200), np.ones(200, int), 3)
    for q, (places, scores) in enumerate(found):
        exact = sorted((-sum(int(a) * int(b) for a, b in zip(x[q], x[i])), i) for i in range(200) if i != q)[:3]
        assert [(int(-s), int(p)) for p, s in zip(places, scores)] == [(s, i) for s, i in exact]
