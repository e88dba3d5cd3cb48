"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of a word's tree hold, for each live symbol, the rank of the pair it forms with the
next live symbol, together with its place. An inner node holds the least of its two children, so
the root names the leftmost of the lowest-ranked pairs. Merging it changes three leaves: the pair
itself, the pair that starts at the swallowed symbol (gone) and the pair before. Each change is a
walk from leaf to root. When the root holds no rank, the word is done.

A text is cut into units no word crosses (mostly at blanks), and units are remembered with their
ids. Words of up to 64 bytes are merged side by side as rows of one array, one merge per word and
step; longer ones one by one, in time proportional to n * log(n).
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterline.llm.common import bound_batches, map_frames, small_frames

NONE = np.int64(1) << 62
SIDE_BY_SIDE = 64  # longest word, in bytes, of the array form
AT_ONCE = 32_768  # words per array
MOST_UNITS = 500_000  # units of text whose ids a worker remembers
MOST_WORDS = 600_000  # words whose ids a worker remembers
GROUP = 150_000  # units that are looked up at once
LONGEST = 1_000_000  # characters of a text that are cut into units at once
BLANK_RUN = re.compile(r" \s")
WHITE = regex.compile(r"\s+")
SAFE_CUT = regex.compile(r"[^\s](?= [^\s])")

# Fixed value: the word pattern that a byte-level pre-tokenizer with use_regex stands for.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is printable, else the next one from 256."""
    spare = iter(range(256, 512))
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class PairRanks:
    """Rank and merged symbol of each pair of symbols."""

    def __init__(self, merges: list[tuple[int, int, int]], size: int):
        self.size = size
        firsts, seconds, self.merged = (np.array(c, np.int64) for c in zip(*merges, strict=True))
        keys = firsts * size + seconds
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.ranks = {(a, b): rank for rank, (a, b, _) in enumerate(merges)}

    def of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        key = first * self.size + second
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NONE)


def merge_rows(
    symbols: np.ndarray, ranks: np.ndarray, lengths: np.ndarray, pairs: PairRanks
) -> np.ndarray:
    """Merge each row of ``symbols`` (its first ``lengths`` count) in place; gone symbols are -1.

    The number of columns is a power of two. ``ranks`` has the rank of each symbol with the next.
    """
    rows, width = symbols.shape
    places = np.arange(width)
    following = np.where(places + 1 < lengths[:, None], places + 1, width)
    before = np.tile(places - 1, (rows, 1))
    tree = np.full((rows, 2 * width), NONE, np.int64)
    tree[:, width:] = np.where(ranks < NONE, ranks * width + places, NONE)
    level = width // 2
    while level:
        below = tree[:, 2 * level : 4 * level]
        tree[:, level : 2 * level] = np.minimum(below[:, ::2], below[:, 1::2])
        level //= 2
    nodes = tree.ravel()

    def put(row: np.ndarray, leaf: np.ndarray, rank: np.ndarray) -> None:
        base = row * 2 * width
        node = leaf + width
        nodes[base + node] = np.where(rank < NONE, rank * width + leaf, NONE)
        for _ in range(width.bit_length() - 1):
            node >>= 1
            left = base + 2 * node
            nodes[base + node] = np.minimum(nodes[left], nodes[left + 1])

    row = np.flatnonzero(tree[:, 1] < NONE)
    while len(row):
        rank, at = np.divmod(tree[row, 1], width)
        gone = following[row, at]
        after = following[row, gone]
        first = before[row, at]
        symbol = pairs.merged[rank]
        symbols[row, at], symbols[row, gone] = symbol, -1
        following[row, at] = after
        has_after, has_first = after < width, first >= 0
        before[row[has_after], after[has_after]] = at[has_after]
        right = np.full(len(row), NONE)
        right[has_after] = pairs.of(symbol[has_after], symbols[row[has_after], after[has_after]])
        put(row, gone, np.full(len(row), NONE))
        put(row, at, right)
        rows_first = row[has_first]
        left = pairs.of(symbols[rows_first, first[has_first]], symbol[has_first])
        put(rows_first, first[has_first], left)
        row = row[tree[row, 1] < NONE]
    return symbols


def merge_word(symbols: list[int], pairs: PairRanks) -> list[int]:
    """The same for a single word of any length."""
    count = len(symbols)
    width = 1 << max(1, (count - 1).bit_length())
    none = int(NONE)
    ranks, merged = pairs.ranks, pairs.merged
    tree = [none] * (2 * width)

    def key(at: int, first: int, second: int) -> int:
        rank = ranks.get((first, second))
        return none if rank is None else rank * width + at

    for at in range(count - 1):
        tree[width + at] = key(at, symbols[at], symbols[at + 1])
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(at: int, value: int) -> None:
        node = width + at
        tree[node] = value
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    symbols = list(symbols)
    following, before = list(range(1, count + 1)), list(range(-1, count - 1))
    while tree[1] < none:
        rank, at = divmod(tree[1], width)
        gone, first = following[at], before[at]
        after = following[gone]
        symbols[at], symbols[gone] = int(merged[rank]), -1
        following[at] = after
        put(gone, none)
        if after < count:
            before[after] = at
            put(at, key(at, symbols[at], symbols[after]))
        else:
            put(at, none)
        if first >= 0:
            put(first, key(first, symbols[first], symbols[at]))
    return [s for s in symbols if s >= 0]


class Codec:
    """Ids of whole texts and back, after a tokenizer's JSON file.

    Understands byte-level BPE with one word pattern, with or without a word-end suffix, and the
    normalizers NFC, white space to blanks and lower case; anything else is refused.
    """

    def __init__(self, spec_json: str):
        spec = json.loads(spec_json)
        self.spec_json, self.library = spec_json, None
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        unsupported = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        if model.get("type", "BPE") != "BPE" or any(model.get(name) for name in unsupported):
            raise ValueError("only plain byte-level BPE is supported")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = PairRanks([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], 1 + max(vocab.values()))
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int64)
        self.final = np.array([vocab[x + suffix] for x in letters], np.int64)
        # Ranks of pairs of bytes, inside a word and at its end.
        self.inner_ranks = self.pairs.of(self.inner[:, None], self.inner[None, :])
        self.final_ranks = self.pairs.of(self.inner[:, None], self.final[None, :])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        tokens = {**vocab, **self.special}
        self.pieces: list[bytes] = [b""] * (1 + max(tokens.values()))
        for token, i in tokens.items():
            self.pieces[i] = token.encode()
        longest_first = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.special_pattern = regex.compile("|".join(longest_first)) if longest_first else None
        self.steps = self._normalizers(spec.get("normalizer"))
        pattern = self._pattern(spec["pre_tokenizer"])
        self.pattern, self.blank_leads = regex.compile(pattern), pattern == BYTE_LEVEL_PATTERN
        self._decoder = (spec.get("decoder") or {}).get("type")
        self.letter_bytes = {x: bytes([b]) for b, x in enumerate(letters)}
        self.ids: dict[str, bytes] = {}
        self.word_ids: dict[str, bytes] = {}
        self.familiar: set[str] = set(map(chr, range(128)))

    @staticmethod
    def _normalizers(spec: dict | None) -> list[str]:
        parts = [] if spec is None else spec.get("normalizers", [spec])
        names = [p["type"] for p in parts]
        blank = {"pattern": {"Regex": r"\s+"}, "content": " "}
        for part in parts:
            known = part["type"] in ("NFC", "Lowercase") or blank.items() <= part.items()
            if not known:
                raise ValueError(f"normalizer {part['type']} is not supported")
        return names

    @staticmethod
    def _pattern(spec: dict) -> str:
        if spec["type"] == "ByteLevel" and spec.get("use_regex", True) and not spec["add_prefix_space"]:
            return BYTE_LEVEL_PATTERN
        split, level = spec.get("pretokenizers", [{}, {}])
        # Words hold no white space, or a unit could not end at a blank.
        if split.get("type") == "Split" and r"[^\s" in split["pattern"]["Regex"] and split["invert"] and split["behavior"] == "Removed" and not (
            level.get("use_regex", True) or level["add_prefix_space"]
        ):
            return split["pattern"]["Regex"]
        raise ValueError("this pre-tokenizer is not supported")

    def _familiar(self, text: str) -> bool:
        """Whether all characters are assigned in the Unicode version of this Python.

        The pattern library may know later ones, which the tokenizer's own library does not.
        """
        if text.isascii():
            return True
        new = set(text) - self.familiar
        if any(unicodedata.category(c) == "Cn" for c in new):
            return False
        self.familiar |= new
        return True

    def _words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not self._familiar(text):
            return self._library_words(text)
        return self.pattern.findall(self._normal(text))

    def _normal(self, text: str) -> str:
        for step in self.steps:
            text = self._step(step, text)
        return text

    @staticmethod
    def _step(step: str, text: str) -> str:
        if step == "NFC":
            return unicodedata.normalize("NFC", text)
        if step == "Replace":
            return WHITE.sub(" ", text)
        return text.replace("Σ", "σ").lower()  # letter by letter: a final sigma is like any other

    def _words_of(self, units: list[str]) -> list[list[str]]:
        """The words of each unit."""
        if not units:
            return []
        if not self._familiar("".join(units)):
            return [self._words(unit) for unit in units]
        find = self.pattern.findall
        if self.blank_leads and self.steps:
            return list(map(find, map(self._normal, units)))
        if self.blank_leads:
            # A blank and letters are one word; a comma or full stop after them is another.
            return [
                (u,)
                if u[1:].isalpha() and (u[0] == " " or u[0].isalpha())
                else (u[:-1], u[-1])
                if u[1:-1].isalpha() and u[-1] in ",." and (u[0] == " " or u[0].isalpha())
                else find(u)
                for u in units
            ]
        # These units hold no blank, and white space is in no word: all are normalized at once.
        text = " ".join(units)
        for step in self.steps:
            text = text if step == "Replace" else self._step(step, text)
        return [(u,) if u.isalpha() else find(u) for u in text.split(" ")]

    def _library_words(self, text: str) -> list[str]:
        """Words as the tokenizer's own library cuts them."""
        from tokenizers import Tokenizer

        self.library = self.library or Tokenizer.from_str(self.spec_json)
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        words = (word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text))
        return [b"".join(map(self.letter_bytes.__getitem__, word)).decode() for word in words]

    def _units(self, text: str) -> list[str]:
        """The text cut where no word crosses, so that each unit is encoded without the others."""
        if self.blank_leads:
            # A blank belongs to the word after it, unless more white space follows.
            if BLANK_RUN.search(text) or "\0" in text:
                return self._words(text)
            return text.replace(" ", "\0 ").split("\0")
        return text.replace("\n", " ").split(" ")

    def _slices(self, text: str) -> Iterator[list[str] | int]:
        """The text as lists of units and ids of special tokens."""
        at = 0
        for match in self.special_pattern.finditer(text) if self.special_pattern else ():
            yield from self._lists(text[at : match.start()])
            yield self.special[match[0]]
            at = match.end()
        yield from self._lists(text[at:] if at else text)

    def _lists(self, text: str) -> Iterator[list[str]]:
        """Units of stretches of bounded length, as far as there are places to cut."""
        while len(text) > LONGEST:
            cut = SAFE_CUT.search(text, LONGEST - 1)
            if not cut:
                break
            yield self._units(text[: cut.end()])
            text = text[cut.end() :]
        if text:
            yield self._units(text)

    def learn(self, units: set[str]) -> None:
        """Encode units that are not known yet."""
        new = units.difference(self.ids)
        if len(self.ids) + len(new) > MOST_UNITS:
            self.ids.clear()
            new = units
        new = list(new)
        words_of = self._words_of(new)
        words = set(chain.from_iterable(words_of))
        if len(self.word_ids) + len(words) > MOST_WORDS:
            self.word_ids = {}
        ids = self.word_ids
        ids.update(self._encode_words(words.difference(ids)))
        known = ids.__getitem__
        self.ids.update(
            (unit, known(words[0]) if len(words) == 1 else b"".join(map(known, words)))
            for unit, words in zip(new, words_of, strict=True)
        )

    def _encode_words(self, words: set[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        new = list(words)
        encoded = [w.encode() for w in new]
        sizes = np.array([len(e) for e in encoded], np.int64)
        for width in (2, 4, 8, 16, 32, SIDE_BY_SIDE):
            chosen = np.flatnonzero((sizes <= width) & (sizes > (width // 2 if width > 2 else 0)))
            for start in range(0, len(chosen), AT_ONCE):
                part = chosen[start : start + AT_ONCE]
                rows = self._merge_rows([encoded[i] for i in part], sizes[part], width)
                found.update(zip((new[i] for i in part), rows, strict=True))
        for i in np.flatnonzero(sizes > SIDE_BY_SIDE):
            body = np.frombuffer(encoded[i], np.uint8)
            symbols = [*self.inner[body[:-1]].tolist(), int(self.final[body[-1]])]
            found[new[i]] = np.array(merge_word(symbols, self.pairs), "<u4").tobytes()
        return found

    def _merge_rows(self, encoded: list[bytes], sizes: np.ndarray, width: int) -> list[bytes]:
        body = np.frombuffer(b"".join(encoded), np.uint8)
        ids = self.inner[body]
        ends = np.cumsum(sizes) - 1
        ids[ends] = self.final[body[ends]]
        following = self.inner_ranks[body, np.append(body[1:], 0)]
        following[ends - 1] = self.final_ranks[body[ends - 1], body[ends]]
        following[ends] = NONE
        inside = np.arange(width) < sizes[:, None]
        symbols = np.full((len(encoded), width), -1, np.int64)
        symbols[inside] = ids
        ranks = np.full((len(encoded), width), NONE, np.int64)
        ranks[inside] = following
        merge_rows(symbols, ranks, sizes, self.pairs)
        kept = symbols >= 0
        packed = symbols[kept].astype("<u4").tobytes()
        stops = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [packed[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        collecting = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and each collection would walk all remembered units
        try:
            return self._encode(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        result = []
        for group in _groups(texts, self._slices):
            units = (x for x in chain.from_iterable(group) if not isinstance(x, int))
            self.learn(set(chain.from_iterable(units)))
            known = self.ids.__getitem__
            for slices in group:
                parts = [
                    x.to_bytes(4, "little") if isinstance(x, int) else b"".join(map(known, x)) for x in slices
                ]
                result.append(parts[0] if len(parts) == 1 else b"".join(parts))
        return result

    def decode(self, packed: list[bytes]) -> list[str]:
        """The texts of the ids, as the library gives them with skip_special_tokens=False."""
        result = []
        for ids in packed:
            tokens = [self.pieces[i] for i in np.frombuffer(ids, "<u4").tolist()]
            if self._decoder is None:
                result.append(b" ".join(tokens).decode())
            elif self._decoder == "ByteLevel":
                letters = b"".join(tokens).decode()
                body = b"".join(self.letter_bytes.get(x) or x.encode() for x in letters)
                result.append(body.decode(errors="replace"))
            else:
                raise ValueError(f"decoder {self._decoder} is not supported")
        return result


def _groups(texts: list[str], slices) -> Iterator[list[list]]:
    """Texts as slices, so many at a time that their units fit the memory of units.

    A text of more than ``GROUP`` units comes alone and is still whole.
    """
    group, held = [], 0
    for text in texts:
        own = list(slices(text))
        size = sum(1 if isinstance(x, int) else len(x) for x in own)
        if group and held + size > GROUP:
            yield group
            group, held = [], 0
        group.append(own)
        held += size
    if group:
        yield group


_CODECS: dict[str, Codec] = {}


def codec_of(spec: Broadcast) -> Codec:
    """The worker's codec for a broadcast tokenizer file, made once."""
    key = hashlib.sha256(spec.value.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(spec.value)
    return _CODECS[key]


def broadcast_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """A tokenizer file (a few MB, whatever the corpus) for all executors."""
    bound_batches(spark)
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``ids`` of each whole text: little-endian unsigned 32-bit integers, packed.

    Null is encoded as the empty text, without ids. Each row is encoded by itself: repeated rows
    and ids stay as they are, an empty table gives no rows, other columns are not read. A special
    token's name in a text is that token, as in the library. No shuffle.
    """
    spec = broadcast_tokenizer(docs.sparkSession, path)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(spec)
        for frame in small_frames(frames, "text", 2_000_000):
            texts = frame["text"].fillna("").tolist()
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": codec.encode(texts)})

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_frames(chosen, run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with its ``text``; null ids give null."""
    spec = broadcast_tokenizer(encoded.sparkSession, path)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(spec)
        for frame in frames:
            for start in range(0, len(frame), 500):
                part = frame.iloc[start : start + 500].reset_index(drop=True)
                there = part["ids"].notna()
                part["text"] = None
                part.loc[there, "text"] = codec.decode(part.loc[there, "ids"].tolist())
                yield part

    return map_frames(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, ids binary, text string")


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids and the text decoded from them: ``encode`` and ``decode`` in one worker."""
    spec = broadcast_tokenizer(docs.sparkSession, path)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(spec)
        for frame in small_frames(frames, "text", 2_000_000):
            ids = codec.encode(frame["text"].fillna("").tolist())
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": ids, "text": codec.decode(ids)})

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_frames(chosen, run, f"doc_id {kind}, ids binary, text string")


def code_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the decoded text."""
    return round_trip(docs, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
