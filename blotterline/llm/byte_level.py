"""Encoding with byte-level BPE files at the speed of a compiled encoder.

The tokenizer file (JSON) states the vocabulary; where it is a plain byte-level BPE whose merges
stand in the order of their ids, the ids alone rank the merges and ``tiktoken`` gives the same ids.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import tiktoken

#: Fixed: how byte-level BPE cuts a text before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the others in order for U+0100 and on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + at): b for at, b in enumerate(others)}


def token_bytes(spec: dict) -> dict[bytes, int]:
    """The id of each token's bytes; added tokens are left out."""
    table = byte_of_character()
    return {bytes(table[c] for c in token): number for token, number in spec["model"]["vocab"].items()}


def is_ranked(spec: dict) -> bool:
    """Whether the ids of ``spec`` rank its merges and nothing else changes a text."""
    cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = (
        model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and spec.get("normalizer") is None
        and cut.get("type") == "ByteLevel"
        and not cut.get("add_prefix_space")
        and cut.get("use_regex", True)
        and all(not a["normalized"] and not a["single_word"] and not a["lstrip"] and not a["rstrip"] for a in spec["added_tokens"])
    )
    if not plain:
        return False
    vocab = model["vocab"]
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    ids = [vocab.get(a + b, -1) for a, b in pairs]
    singles = [vocab.get(c, -1) for c in byte_of_character()]
    return min(singles) >= 0 and len(vocab) == len(ids) + 256 and all(a < b for a, b in zip([max(singles), *ids], ids))


class ByteLevel:
    """Texts to ids. ``special``: whether special tokens' names in a text are those tokens."""

    def __init__(self, spec: dict, special: bool = True):
        ranks = token_bytes(spec)
        added = {a["content"]: a["id"] for a in spec["added_tokens"]} if special else {}
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.special = set(added)
        #: Bytes of each id's token.
        self.sizes = np.zeros(max([*ranks.values(), *added.values()]) + 1, np.int64)
        for token, number in ranks.items():
            self.sizes[number] = len(token)

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, unsigned 32-bit."""
        return self.encoding.encode_to_numpy(text, allowed_special=self.special, disallowed_special=())

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return [self.ids(text).astype("<u4", copy=False).tobytes() for text in texts]


_MADE: dict[tuple[str, bool], ByteLevel | None] = {}


def byte_level(file: str, special: bool = True) -> ByteLevel | None:
    """The encoder of a tokenizer file's content, made once in a process; None if it is of another kind."""
    key = hashlib.sha256(file.encode()).hexdigest(), special
    if key not in _MADE:
        spec = json.loads(file)
        _MADE[key] = ByteLevel(spec, special) if is_ranked(spec) else None
    return _MADE[key]
