from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from blotterline.llm import bpe
from blotterline.llm import packing as pk
from blotterline.llm.bpe import Codec, code_digests, decode, encode, merge_word
from blotterline.llm.packing import best_fit, evolve, fills, pack, pack_documents

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")
DIRT = [
    "", " ", "\n", "  two  blanks ", "\t\r\n x", "ΣΑΣ Σ", "İI ǅ ﬁ", "a" * 300 + "bcd" * 90, "don't I'LL we've",
    "<|endoftext|>x<|startoftext|> y", "½ 𝟘 12 345", "ȩ́ 한국어 각", "\x1c\x1d\x85\xa0a​b", "日本語" * 150,
    "a\0b c", "new \U000323b0 letters ՘x", "é ́x", "''s 's", "x \n y\n z  \n", "🙂👍🏽 ok",
]


@pytest.fixture(scope="module", params=[WORD_FILE, BYTE_FILE])
def both(request):
    with open(request.param, encoding="utf-8") as file:
        return Codec(file.read()), Tokenizer.from_file(request.param)


def test_codec_equals_the_library(both):
    codec, library = both
    draw = random.Random(1)
    letters = [chr(c) for c in [*range(1, 0x3000), *range(0xAC00, 0xAC40), *range(0x1F600, 0x1F620)]]
    texts = [*DIRT, *("".join(draw.choices(letters, k=80)) for _ in range(200))]
    texts += ["".join(draw.choices("abcdefghij' ", k=300)) for _ in range(50)]
    ids = codec.encode(texts)
    for text, packed in zip(texts, ids, strict=True):
        own = np.frombuffer(packed, "<u4").tolist()
        assert own == library.encode(text, add_special_tokens=False).ids, repr(text)
    lists = [np.frombuffer(p, "<u4").tolist() for p in ids]
    assert codec.decode(ids) == [library.decode(i, skip_special_tokens=False) for i in lists]


def test_units_and_memory_do_not_change_ids(both, monkeypatch):
    codec, _ = both
    text = " ".join(f"word{i} Other,{i % 7}" for i in range(500)) + "\n" + "z" * 200
    whole = codec.encode([text])
    for name, value in (("LONGEST", 50), ("GROUP", 10), ("MOST_UNITS", 20), ("MOST_WORDS", 20), ("SIDE_BY_SIDE", 64)):
        monkeypatch.setattr(bpe, name, value)
    fresh = Codec(codec.spec_json)
    assert fresh.encode([text, "", text]) == [whole[0], b"", whole[0]]


def test_array_and_single_forms_of_the_tree_agree(both):
    codec, _ = both
    draw = random.Random(2)
    words = {"".join(draw.choices("etaoinshr", k=draw.randrange(1, 60))) for _ in range(300)}
    rows = codec._encode_words(words)
    for word in words:
        body = np.frombuffer(word.encode(), np.uint8)
        symbols = [*codec.inner[body[:-1]].tolist(), int(codec.final[body[-1]])]
        assert merge_word(symbols, codec.pairs) == np.frombuffer(rows[word], "<u4").tolist()


def test_encode_and_decode_frames(spark):
    library = Tokenizer.from_file(WORD_FILE)
    rows = [(i, t, "x", 1) for i, t in enumerate([*DIRT, None, "same", "same"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = {r["doc_id"]: r for r in code_digests(docs, WORD_FILE).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    assert decode(encode(docs, WORD_FILE), WORD_FILE).count() == len(rows)
    assert code_digests(docs.limit(0), WORD_FILE).count() == 0


def check_packing(rows, capacity):
    by_sequence: dict[int, list] = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packed_documents(spark):
    library = Tokenizer.from_file(BYTE_FILE)
    draw = random.Random(4)
    texts = [None, "", "x", "x"] + [" ".join(draw.choices(["alpha", "beta", "gamma"], k=draw.randrange(1, 90))) for _ in range(120)]
    docs = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, piece string")
    got = pack_documents(docs, BYTE_FILE, capacity=64).collect()
    count = check_packing(got, 64)
    tokens = 0
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        tokens += len(ids)
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        at = 0
        for r in own:
            assert r["start"] == at and (r["length"] == 64 or r["piece"] == 0)
            piece = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(piece)
            at += r["length"]
        assert at == len(ids)
    assert count <= -(-tokens // 64) + 2
    assert pack_documents(docs.limit(0), BYTE_FILE).count() == 0


def test_packing_over_several_blocks_and_levels(spark, monkeypatch):
    from blotterline.llm import packing

    monkeypatch.setattr(packing, "BLOCK_PIECES", 100)
    draw = random.Random(5)
    lengths = [draw.randrange(1, 101) for _ in range(1000)] + [50] * 300
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long")
    got = pack(pieces, capacity=100).collect()
    assert sorted(r["id"] for r in got) == list(range(len(lengths)))
    assert check_packing(got, 100) <= 1.06 * sum(lengths) / 100 + 1


def test_islands_never_lose_pieces_and_never_get_worse():
    draw = np.random.default_rng(0)
    lengths = draw.integers(1, 1000, 400)
    start = best_fit(lengths, np.argsort(-lengths, kind="stable"), 2048)
    done = evolve(lengths, [], 2048, seed=1)
    assert done[0].max() <= start.max()
    for packing in done:
        filled = fills(packing, lengths)
        assert len(packing) == 400 and filled.max() <= 2048 and filled.min() > 0
        assert filled.sum() == lengths.sum()


def test_crossover_beats_the_packings_it_starts_from(monkeypatch):
    """Where best fit is not optimal, whole well-filled sequences put together are; without mutation."""
    monkeypatch.setattr(pk, "POPULATION", 8)
    monkeypatch.setattr(pk, "OFFSPRING", 60)
    with_crossover, alone = 0, 0
    for seed in range(15):
        lengths = np.random.default_rng(seed).integers(150, 600, 40)
        monkeypatch.setattr(pk, "OFFSPRING", 0)
        start = pk.evolve(lengths, [], 1000, seed * 10)
        before = min(int(p.max()) + 1 for p in start)
        monkeypatch.setattr(pk, "OFFSPRING", 60)
        with_crossover += int(pk.evolve(lengths, [], 1000, seed * 10)[0].max()) + 1 < before
        with monkeypatch.context() as only:
            only.setattr(pk, "mutation", lambda packing, *_: packing)
            alone += int(pk.evolve(lengths, [], 1000, seed * 10)[0].max()) + 1 < before
    assert with_crossover >= 1 and alone >= 1
