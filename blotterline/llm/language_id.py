"""Language identification by bit-sliced Bloom filters over letter n-grams.

Each language has a set of n-grams typical of it. All sets are Bloom filters of one size and with
the same hash functions, stored bit by bit side by side: row i holds bit i of every language's
filter as one mask. The conjunction of an n-gram's rows is then the set of all languages that hold
it, whatever their number. Popcounts of the masks per language, less what the filters report
falsely, decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotterline.llm.common import (
    bound_batches,
    crc32_of,
    map_frames,
    materialize,
    numbered_rows,
    small_frames,
)
from blotterline.llm.models import LETTER, UPPER, character_classes, code_points, sums_by_text

#: Languages that are learned: those with the most labelled texts.
MOST_LANGUAGES = 256
#: Rows of the filters times their words of 64 languages. Filters of more n-grams get denser instead
#: of larger: they hold all of them, and the rate of false reports, which judgments subtract, rises.
MOST_WORDS = 1 << 24
#: An n-gram is typical of a language if it is there at least this part as frequent as where it
#: is most frequent.
TYPICAL = 0.25
HASHES = 3
#: A text is in a known language if its own language holds at least this part of the share of
#: n-grams that all but ``UNUSUAL`` of the held-out texts reach, and leads the second language by
#: this part of their lead. A lead is an estimate from few n-grams: it is allowed an error that falls
#: with their number, ``DOUBT`` over it.
LEAST_SHARE, LEAST_LEAD = 0.5, 0.1
UNUSUAL = 0.01
DOUBT = 2.0
FRAME_CHARS = 500_000
UNKNOWN = "und"


def ngram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all letter trigrams, their number per text, and the letters per text.

    A run of other characters is one blank; texts begin and end with one. Trigrams with a blank
    in the middle are left out.
    """
    points, lengths = code_points([f" {t.lower()} " for t in texts])
    kind = character_classes()[np.minimum(points, 0x10FFFF)]
    letter = (kind == LETTER) | (kind == UPPER)
    letters = sums_by_text(letter, lengths)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    keep = letter.copy()
    keep[1:] |= letter[:-1] != letter[1:]  # the first of a run of other characters
    starts = np.cumsum(lengths) - lengths
    keep[starts] = True
    symbols = np.where(letter, points, 32)[keep].astype(np.uint64)
    text_of, letter = text_of[keep], letter[keep]
    whole = (text_of[2:] == text_of[:-2]) & letter[1:-1]
    a, b, c = symbols[:-2][whole], symbols[1:-1][whole], symbols[2:][whole]
    mixed = (a << np.uint64(42)) ^ (b << np.uint64(21)) ^ c
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed, np.bincount(text_of[:-2][whole], minlength=len(texts)), letters


class LanguageFilters:
    """The filters of all languages, bit-sliced: ``rows[i, w]`` has bit i of 64 languages."""

    def __init__(self, languages: list[str], ngrams: dict[str, np.ndarray], usual: str):
        self.languages, self.usual = languages, usual
        most = max([1, *(len(n) for n in ngrams.values())])
        words = -(-max(1, len(languages)) // 64)
        self.bits = 1 << min(int(16 * most - 1).bit_length(), (MOST_WORDS // words).bit_length() - 1)
        self.rows = np.zeros((self.bits, words), np.uint64)
        for at, language in enumerate(languages):
            flag = np.uint64(1 << (at % 64))
            for rows in self._places(ngrams[language]):
                np.bitwise_or.at(self.rows[:, at // 64], rows, flag)
        filled = [
            float(np.mean((self.rows[:, at // 64] >> np.uint64(at % 64)) & np.uint64(1)))
            for at in range(len(languages))
        ]
        self.false_rate = np.array(filled) ** HASHES

    def _places(self, hashes: np.ndarray) -> list[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        mask = np.uint64(self.bits - 1)
        return [((hashes + np.uint64(i) * step) & mask).astype(np.int64) for i in range(HASHES)]

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram the languages that hold it, as bits."""
        first, *others = self._places(hashes)
        found = self.rows[first]
        for rows in others:
            found = found & self.rows[rows]
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, score, _ = self._judge(texts)
        return names, score

    def evidence(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: the share of its n-grams that the best language holds, and its lead over the
        share of the second with what few n-grams leave open. The number of languages does not matter."""
        return self._judge(texts)[2]

    def _judge(self, texts: list[str | None]):
        hashes, counts, letters = ngram_hashes([t or "" for t in texts])
        found = self.masks(hashes)
        held = np.stack(
            [
                sums_by_text((found[:, at // 64] >> np.uint64(at % 64)) & np.uint64(1), counts)
                for at in range(len(self.languages))
            ]
            or [np.zeros(len(texts))],
            axis=1,
        )
        if not self.languages:
            nothing = np.zeros(len(texts))
            return [UNKNOWN] * len(texts), nothing, (nothing, nothing)
        true = (held - counts[:, None] * self.false_rate) / (1 - self.false_rate)
        true = np.maximum(true, 0)
        best, total = true.argmax(axis=1), true.sum(axis=1)
        score = np.where(total > 0, true.max(axis=1) / np.maximum(total, 1e-9), 0.0)
        names = [
            UNKNOWN if not letters[i] else self.languages[best[i]] if total[i] > 0 else self.usual
            for i in range(len(texts))
        ]
        shares = np.sort(true, axis=1) / np.maximum(counts, 1)[:, None]
        lead = shares[:, -1] - shares[:, -2] if shares.shape[1] > 1 else shares[:, -1]
        return names, np.where(letters > 0, score, 0.0), (shares[:, -1], lead + DOUBT / np.maximum(counts, 1))


def fit_filters(
    training: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id"
) -> LanguageFilters:
    """Filters from the text and the language of ``training``; rows without a language or a doc_id are
    left out.

    All texts of at most ``MOST_LANGUAGES`` languages are counted, in Spark; the driver gets the
    n-grams that are typical of each, no more than there are distinct letter trigrams.
    """
    spark = training.sparkSession
    bound_batches(spark)
    labelled = _labelled(training, text, lang, doc_id)
    most = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    learned = [row["lang"] for row in most.collect()]
    labelled = labelled.where(F.col("lang").isin(learned) & F.col("doc_id").isNotNull())

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "text", FRAME_CHARS):
            for language, part in frame.groupby("lang"):
                hashes, _, _ = ngram_hashes(part["text"].fillna("").tolist())
                found, times = np.unique(hashes.view(np.int64), return_counts=True)
                yield pd.DataFrame({"lang": language, "ngram": found, "times": times})

    counts = materialize(
        labelled.select("text", "lang").mapInPandas(count, "lang string, ngram long, times long")
        .groupBy("lang", "ngram")
        .agg(F.sum("times").alias("times")),
        "ngrams",
    )
    totals = counts.groupBy("lang").agg(F.sum("times").alias("total"))
    shares = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("times") / F.col("total"))
    typical = F.col("share") >= TYPICAL * F.max("share").over(Window.partitionBy("ngram"))
    kept = shares.withColumn("_typical", typical).where("_typical").select("lang", "ngram").toArrow()
    found = kept["lang"].combine_chunks().dictionary_encode()
    code, hashes = found.indices.to_numpy(), kept["ngram"].to_numpy().view(np.uint64)
    ngrams = {language: hashes[code == at] for at, language in enumerate(found.dictionary.to_pylist())}
    return LanguageFilters(sorted(ngrams), ngrams, learned[0] if learned else UNKNOWN)


def _labelled(rows: DataFrame, text: str, lang: str, doc_id: str) -> DataFrame:
    """doc_id, text, lang of the rows that have a language."""
    return rows.where(F.col(lang).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")
    )


def with_language(docs: DataFrame, filters: LanguageFilters, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score`` (0 to 1); columns so named are replaced.

    Null texts and texts without a letter are ``und`` with score 0. A text none of whose n-grams is
    known has the most usual language of the training rows, with score 0. The score is the share
    of the language's n-grams among those of all languages. Rows are judged one by one: no
    shuffle, repeated rows stay, an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "lang_score")
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, text, FRAME_CHARS):
            texts = [x if isinstance(x, str) else None for x in frame[text]]
            names, score = shared.value.predict(texts)
            yield frame.assign(lang_pred=names, lang_score=score)

    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("lang_score")).schema
    return map_frames(docs, run, schema)


def fit_bounds(
    labelled: DataFrame, filters: LanguageFilters, text: str = "text", lang: str = "lang", doc_id: str = "doc_id"
) -> tuple[float, float]:
    """Least share and least lead of a text in a known language, from rows ``filters`` never saw.

    Judged on all texts of each language that ``filters`` know; the language with the lowest shares
    or leads sets the bound. No rows give bounds of 0.
    """
    bound_batches(labelled.sparkSession)
    rows = _labelled(labelled, text, lang, doc_id)
    rows = rows.where(F.col("lang").isin(filters.languages) & F.col("doc_id").isNotNull())
    shared = labelled.sparkSession.sparkContext.broadcast(filters)

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, "text", FRAME_CHARS):
            share, lead = shared.value.evidence(frame["text"].fillna("").tolist())
            yield pd.DataFrame({"lang": frame["lang"], "share": share, "lead": lead})

    judged = materialize(rows.select("text", "lang").mapInPandas(judge, "lang string, share double, lead double"), "evidence")
    usual = percentiles(judged, "lang", ["share", "lead"], UNUSUAL)
    found = {row["name"]: row["least"] for row in usual.groupBy("name").agg(F.min("value").alias("least")).collect()}
    return LEAST_SHARE * (found.get("share") or 0.0), LEAST_LEAD * (found.get("lead") or 0.0)


def percentiles(rows: DataFrame, by: str, columns: list[str], part: float) -> DataFrame:
    """``by``, name (of the column), value: the exact percentile of each column for each value of ``by``.

    As ``F.percentile``, which holds all values of a group in one task; here the values are sorted
    and numbered by ranges, and the two beside the place are looked up. Values that are null count
    nowhere.
    """
    entries = [F.struct(F.lit(name).alias("name"), F.col(name).cast("double").alias("value")) for name in columns]
    values = rows.select(by, F.inline(F.array(*entries))).where(F.col("value").isNotNull())
    numbered, _ = numbered_rows(values, by, "name", "value", column="_at")
    place = (F.count(F.lit(1)) - 1) * F.lit(part)
    groups = numbered.groupBy(by, "name").agg(F.min("_at").alias("_first"), place.alias("_place"))
    at = F.col("_at") - F.col("_first")
    beside = numbered.join(F.broadcast(groups), [by, "name"]).where((at >= F.floor("_place")) & (at <= F.ceil("_place")))
    low, high, over = F.min("value"), F.max("value"), F.first(F.col("_place") - F.floor("_place"))
    return beside.groupBy(by, "name").agg(((1 - over) * low + over * high).alias("value"))


def in_known_language(
    docs: DataFrame, filters: LanguageFilters, bounds: tuple[float, float], text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose text has a letter and reaches ``bounds`` (share, lead). No shuffle."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    least_share, least_lead = bounds

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, text, FRAME_CHARS):
            texts = [x if isinstance(x, str) else None for x in frame[text]]
            names, _, (share, lead) = shared.value._judge(texts)
            known = (share >= least_share) & (lead >= least_lead)
            yield frame[known & (np.array(names, object) != UNKNOWN)]

    return map_frames(docs, run, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """Rows that language filters of the registered query never learn from."""
    return crc32_of(F.col(doc_id)) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for ``documents``, learned from rows not held out."""
    filters = fit_filters(docs.where(~held_out()))
    return with_language(docs.select("doc_id", "text"), filters).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )
