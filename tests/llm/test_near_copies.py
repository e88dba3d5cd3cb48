from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from blotterline.llm import edit_fingerprint as ef
from blotterline.llm import simhash as sh
from blotterline.llm.components import components

DOCS = "doc_id long, text string, fingerprint string, component_id string"


def brute_fingerprint(text: str) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for white in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(white, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union_find(count: int, pairs) -> list[int]:
    parent = list(range(count))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


@pytest.mark.parametrize("text", ["", " \n", "One", "a B c", "Ünder ÀB c d e", "a\x1cb\x85c d e f", "x " * 500])
def test_fingerprint_of_small_texts(text):
    assert sh.simhash(text) % (1 << 64) == brute_fingerprint(text)


def test_long_texts_are_hashed_whole(monkeypatch):
    draw = random.Random(0)
    text = " ".join(draw.choices(["aa", "bb", "cc", "dd"], k=700))
    monkeypatch.setattr(sh, "SHINGLES_AT_ONCE", 50)
    assert sh.simhash(text) % (1 << 64) == brute_fingerprint(text)


def test_gray_rank(spark):
    codes = [0, 1, 3, 2, 6, -1, -(1 << 63), 1 << 62]
    frame = spark.createDataFrame([(c,) for c in codes], "code long")
    got = [r[0] for r in frame.select(sh.gray_rank(F.col("code"))).collect()]
    for code, rank in zip(codes, got, strict=True):
        place = (rank ^ -(1 << 63)) % (1 << 64)
        assert (place ^ (place >> 1)) == code % (1 << 64)


@pytest.mark.parametrize("same", [True, False])
def test_links_equal_all_pairs(same):
    draw = np.random.default_rng(2)
    centres = draw.integers(0, 1 << 63, 40, np.uint64)
    flips = [sum(1 << int(b) for b in set(draw.integers(0, 64, draw.integers(0, 4)))) for _ in range(1600)]
    cloud = np.array([int(c) ^ f for c, f in zip(np.repeat(centres, 40), flips)], np.uint64)
    values = np.unique(cloud)
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    values = values[np.argsort(rank)]
    x, y = (values, values) if same else (values[:700], values[700:])
    got = sh.links(x, y, same, 4)
    if same:
        pairs = [(i, int(j)) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 4)]
        expected = union_find(len(x), pairs)
    else:
        pairs = [(i, len(x) + int(j)) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(y ^ x[i]) <= 4)]
        expected = union_find(len(x) + len(y), pairs)
    assert got.tolist() == expected


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sh, "GROUP", 16)
    monkeypatch.setattr(sh, "FAN_OUT", 2)
    draw = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(draw.choices(words, k=60)) for _ in range(25)]
    texts = [None, "", " \t", "same text"] + ["same text"] * 20 + base
    for text in base:
        for _ in range(4):
            parts = text.split()
            parts[draw.randrange(len(parts))] = "changed"
            texts.append(" ".join(parts))
    rows = [(1000 - i, t, "x", "y") for i, t in enumerate(texts)] + [(1000, None, "x", "y")]
    got = sh.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    prints = [brute_fingerprint(t or "") for _, t, *_ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = union_find(len(rows), pairs)
    least: dict[int, int] = {}
    for root, (doc, *_) in zip(roots, rows, strict=True):
        least[root] = min(doc, least.get(root, doc))
    expected = sorted((doc, p, least[r]) for (doc, *_), p, r in zip(rows, prints, roots, strict=True))
    assert sorted((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in got) == expected
    kept = sh.one_of_each(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(least.values()))
    assert kept[0].asDict().keys() == {"doc_id", "text", "fingerprint", "component_id"}


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert sh.near_duplicates(empty).count() == 0
    assert sh.one_of_each(empty).count() == 0


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(250)]
    edges += [(1000, 1001 + i) for i in range(200)] + [(2000 + i, 2001 + i) for i in range(60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    place = {n: i for i, n in enumerate(nodes)}
    roots = union_find(len(nodes), [(place[a], place[b]) for a, b in edges])
    assert all(got.get(n, n) == nodes[r] for n, r in zip(nodes, roots, strict=True))
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_walk(text: str) -> list[int]:
    step, ends, table = 0, [], ef.stays()
    for c in text:
        kind = ((ord(c) * 0x9E3779B97F4A7C15 % (1 << 64)) >> 40) % ef.CLASSES
        step += int(table[kind, step % ef.PERIOD])
        ends.append(step)
    return ends


def test_walks_side_by_side_and_alone(monkeypatch):
    draw = random.Random(5)
    texts = ["", "a", "é🙂" * 40] + ["".join(draw.choices("abcdefgh ", k=draw.randrange(1, 300))) for _ in range(20)]
    for width in (4096, 16):
        monkeypatch.setattr(ef, "SIDE_BY_SIDE", width)
        assert [e.tolist() for e in ef.walk(texts)] == [plain_walk(t) for t in texts]


def test_edits_change_fingerprints_little():
    draw = random.Random(6)
    text = "".join(draw.choices("etaoin shrdlu", k=3000))
    other = "".join(draw.choices("etaoin shrdlu", k=3000))
    small = text[:1500] + "X" + text[1501:2000] + text[2001:]
    half = ef.edited(text, other)
    prints = ef.embed([text, text, small, half, other, ""])
    near = [ef.likeness(prints[:1], prints[i : i + 1])[0] for i in range(6)]
    assert near[1] == 1 and near[2] > 0.85 and 0.4 < near[3] < 0.75 and near[4] < 0.35 and near[5] == 0


def test_edited_fingerprints_follow_by_doc_id(spark):
    import hashlib

    texts = {i: t for i, t in enumerate(["", None, "abc", "é" * 9, "long " * 400, "abc", "x"])}
    docs = spark.createDataFrame([(i * 10, t, "q") for i, t in texts.items()], "doc_id long, text string, part string")
    got = {r["doc_id"]: r for r in ef.edited_fingerprints(docs.repartition(3)).collect()}
    for i, text in texts.items():
        text, following = text or "", texts[(i + 1) % len(texts)] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        row = got[i * 10]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        own, edit, after = ef.embed([text, new, following])
        assert row["fingerprint"] == own.tobytes().hex() and row["edited_fingerprint"] == edit.tobytes().hex()
        assert row["near_edited"] == pytest.approx((own == edit).mean())
        assert row["near_next"] == pytest.approx((own == after).mean())
    assert ef.edited_fingerprints(docs.limit(0)).count() == 0
    alone = ef.edited_fingerprints(docs.where("doc_id = 20")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1


def test_similar_documents(spark, monkeypatch):
    monkeypatch.setattr(ef, "BUCKET_BLOCK", 4)
    draw = random.Random(7)
    base = ["".join(draw.choices("etaoin shrdlu", k=800)) for _ in range(6)]
    texts = [*base, *base, None, ""]
    texts += [t[:k] + "Z" + t[k + 1 :] for t in base for k in range(50, 750, 50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in ef.similar_documents(docs, 0.8).collect()}
    prints = ef.embed([t or "" for t in texts])
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] == prints[j]).mean() >= 0.8]
    assert [got[i] for i in range(len(texts))] == union_find(len(texts), pairs)


def test_bands_cannot_miss():
    draw = random.Random(8)
    for least in (0.5, 0.8, 0.9, 1.0):
        bands = ef.bands_for(least)
        differing = int((1 - least) * ef.SLOTS + 1e-9)
        slots = [set(range(b, ef.SLOTS, bands)) for b in range(bands)]
        assert set().union(*slots) == set(range(ef.SLOTS)) and sum(map(len, slots)) == ef.SLOTS
        for _ in range(200):
            apart = set(draw.sample(range(ef.SLOTS), differing))
            assert any(not (own & apart) for own in slots)


def test_edit_classes_equal_brute_force(spark):
    from blotterline.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = sorted(docs)
    prints = ef.embed([docs[i] for i in ids])
    pairs = [(i, j) for i in range(len(ids)) for j in range(i) if (prints[i] == prints[j]).mean() >= 0.8]
    assert len(pairs) > 3
    roots = union_find(len(ids), pairs)
    got = {r["doc_id"]: (r["class_id"], r["fingerprint"]) for r in QUERIES["edit_classes"](spark, folder).collect()}
    assert got == {d: (ids[root], p.tobytes().hex()) for d, root, p in zip(ids, roots, prints)}
