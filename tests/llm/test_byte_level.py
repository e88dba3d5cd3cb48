from __future__ import annotations

import json
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from blotterline.llm.byte_level import ByteLevel, byte_level, is_ranked

PATH = public_tokenizers.path("byte_bpe_50k.json")
FILE = open(PATH, encoding="utf-8").read()


def test_ids_equal_the_librarys():
    draw = random.Random(1)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 7 == 0]
    texts = ["", "a", "<|endoftext|> x<|endoftext|>", "a" * 5000, " \t\n  b'll \r\n", "é" * 999]
    texts += [f"a{c}b 1{c} {c}" for c in every]
    texts += ["".join(draw.choices("abcé 12'\n!ß中 ", k=draw.randrange(400))) for _ in range(200)]
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    for special, library in ((True, Tokenizer.from_file(PATH)), (False, plain)):
        own = byte_level(FILE, special)
        expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        got = [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)]
        assert got == expected
    for text in texts:
        assert own.sizes[own.ids(text)].sum() == len(text.encode())


def test_files_of_another_kind_are_told_apart():
    spec = json.loads(FILE)
    assert is_ranked(spec)
    spec["model"]["merges"][5], spec["model"]["merges"][900] = spec["model"]["merges"][900], spec["model"]["merges"][5]
    assert not is_ranked(spec)
    other = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    assert byte_level(other) is None
    assert isinstance(byte_level(FILE), ByteLevel)
