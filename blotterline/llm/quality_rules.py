"""Quality rules: a decision list learned from labelled statistics of texts.

Each text gets whole-number statistics (words, symbols, repeated lines and so on); shares of them
are what rules look at. Sequential covering learns an ordered list: a rule is grown condition by
condition on one part of the labelled rows not yet covered (information gain), pruned on the rest,
and the rows it covers are taken away before the next is learned. A rule is a conjunction of a few
thresholds and gives a verdict, reject or keep; what no rule covers has the list's default. The
list is one Spark conditional expression, so judging rows is built-in code.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterline.llm.common import bound_batches, map_frames, small_frames
from blotterline.llm.models import DIGIT, UPPER, bounded_sample, character_classes, code_points, sums_by_text

#: Labelled documents per class that the list is learned from (chosen by a hash of doc_id).
SAMPLE_PER_CLASS = 4_000
FRAME_CHARS = 1_000_000
#: Fixed: what separates words, and what counts as a symbol.
BLANKS, SYMBOLS, MARKS = " \t\n\v\f\r", "#*$%&|<>", "!?"
#: Texts that fail these are rejected whatever the list says.
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; per cent of the words

STATISTICS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_distinct_words",
    "n_top_word",
    "n_stutters",
)
#: Shares that rules look at: a statistic over another one, damped for short texts.
SHARES = {
    "words": ("n_words", None, 0),
    "word_length": ("word_chars", "n_words", 1),
    "symbols": ("n_symbols", "n_words", 10),
    "dup_lines": ("n_dup_lines", "n_lines", 3),
    "repeated": ("n_repeat_words", "n_words", 20),
    "upper": ("n_upper", "word_chars", 30),
    "digits": ("n_digits", "word_chars", 30),
    "marks": ("n_marks", "n_words", 10),
    "distinct": ("n_distinct_words", "n_words", 10),
    "top_word": ("n_top_word", "n_words", 20),
    "stutters": ("n_stutters", "n_words", 10),
    "line_words": ("n_words", "n_lines", 1),
}
#: Conditions per rule, rules per list, cuts tried per share, and what a rule must reach.
MOST_CONDITIONS, MOST_RULES, CUTS = 3, 24, 48
LEAST_PRECISION, LEAST_COVER = 0.9, 5


def repeated_words(words: list) -> int:
    """Words that lie in a window of three words which the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered = np.zeros(len(words), bool)
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered[at : at + 3] = True
    return int(covered.sum())


def statistics(texts: list[str]) -> pd.DataFrame:
    """``STATISTICS`` of each whole text."""
    points, lengths = code_points(texts)
    kind = character_classes()[np.minimum(points, 0x10FFFF)]
    counts = {
        "word_chars": ~np.isin(points, [ord(c) for c in BLANKS]),
        "n_symbols": np.isin(points, [ord(c) for c in SYMBOLS]),
        "n_marks": np.isin(points, [ord(c) for c in MARKS]),
        "n_upper": kind == UPPER,
        "n_digits": kind == DIGIT,
    }
    made = {name: sums_by_text(there, lengths) for name, there in counts.items()}
    rows = []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII blanks alone
        lines = [line for line in text.split("\n") if line.strip(BLANKS)]
        times = Counter(words)
        rows.append(
            (
                len(words),
                len(lines) - len(set(lines)),
                repeated_words(words),
                len(lines),
                len(times),
                max(times.values(), default=0),
                sum(map(bytes.__eq__, words, words[1:])),
            )
        )
    names = ["n_words", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_top_word", "n_stutters"]
    table = pd.DataFrame(rows, columns=names, dtype=np.int64).assign(**made)
    return table[list(STATISTICS)].astype(np.int64)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``STATISTICS`` (long); columns so named are replaced. Null is the empty text.

    Rows are read one by one: no shuffle, repeated rows stay, an empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    docs = docs.drop(*STATISTICS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_frames(frames, text, FRAME_CHARS):
            found = statistics(frame[text].fillna("").tolist())
            yield frame.assign(**{name: found[name].to_numpy() for name in STATISTICS})

    added = [F.lit(0).cast("long").alias(name) for name in STATISTICS]
    return map_frames(docs, run, docs.select("*", *added).schema)


def base_failed() -> Column:
    """Whether a row of statistics is too short or repeats itself too much."""
    repeats = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | repeats


def share(name: str) -> Column:
    above, below, damping = SHARES[name]
    top = F.col(above).cast("double")
    return top if below is None else top / (F.col(below).cast("double") + F.lit(float(damping)))


@dataclass(frozen=True)
class Condition:
    """A share that is at least, or below, a threshold."""

    share: str
    at_least: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return (x[self.share] >= self.threshold) == self.at_least

    def column(self) -> Column:
        value = share(self.share)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.share} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction and its verdict, with the labelled rows it covered when it was learned."""

    conditions: tuple[Condition, ...]
    keep: bool
    right: int = 0
    wrong: int = 0

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        held = [c.holds(x) for c in self.conditions]
        return np.logical_and.reduce(held) if held else np.ones(len(next(iter(x.values()))), bool)

    def __str__(self) -> str:
        told = " and ".join(map(str, self.conditions))
        return f"{'keep' if self.keep else 'reject'} if {told} ({self.right} right, {self.wrong} wrong)"


@dataclass
class DecisionList:
    """Rules in order and the verdict on what none of them covers."""

    rules: list[Rule] = field(default_factory=list)
    default: bool = True

    def verdict(self) -> Column:
        """The list as one conditional expression over the columns ``STATISTICS``."""
        chosen = None
        for rule in self.rules:
            met = rule.conditions[0].column()
            for condition in rule.conditions[1:]:
                met = met & condition.column()
            chosen = F.when(met, F.lit(rule.keep)) if chosen is None else chosen.when(met, F.lit(rule.keep))
        return F.lit(self.default) if chosen is None else chosen.otherwise(F.lit(self.default))

    def __str__(self) -> str:
        return "\n".join([*map(str, self.rules), f"{'keep' if self.default else 'reject'} otherwise"])


def _cuts(values: np.ndarray) -> np.ndarray:
    """Thresholds halfway between neighbouring values, spread over the rows."""
    found = np.unique(values)
    if len(found) > CUTS:
        found = np.unique(np.quantile(values, np.linspace(0, 1, CUTS), method="nearest"))
    return (found[1:] + found[:-1]) / 2


def _information(right: np.ndarray, wrong: np.ndarray) -> np.ndarray:
    return np.log2((right + 1e-9) / (right + wrong + 1e-9))


def grow(x: dict[str, np.ndarray], hit: np.ndarray) -> list[Condition]:
    """Conditions added one by one, each with the greatest information gain for rows of ``hit``."""
    inside, found = np.ones(len(hit), bool), []
    while len(found) < MOST_CONDITIONS and (inside & ~hit).any():
        right, wrong = float((inside & hit).sum()), float((inside & ~hit).sum())
        before = math.log2((right + 1e-9) / (right + wrong + 1e-9))
        best = (1e-6, None)
        for name, values in x.items():
            own, is_hit = values[inside], hit[inside]
            cuts = _cuts(own)
            if not len(cuts):
                continue
            place = np.searchsorted(cuts, own, side="right")  # how many cuts a row reaches
            hits = np.bincount(place[is_hit], minlength=len(cuts) + 1)[::-1].cumsum()[::-1][1:]
            all_above = np.bincount(place, minlength=len(cuts) + 1)[::-1].cumsum()[::-1][1:]
            for at_least, p, n in (
                (True, hits, all_above - hits),
                (False, right - hits, wrong - (all_above - hits)),
            ):
                gains = p * (_information(p, n) - before)
                at = int(np.argmax(gains))
                if gains[at] > best[0]:
                    best = (float(gains[at]), Condition(name, at_least, float(cuts[at])))
        if best[1] is None:
            break
        found.append(best[1])
        inside &= best[1].holds(x)
    return found


def _worth(conditions: list[Condition], x: dict[str, np.ndarray], hit: np.ndarray) -> float:
    covered = Rule(tuple(conditions), True).covers(x)
    right, wrong = int((covered & hit).sum()), int((covered & ~hit).sum())
    return (right - wrong) / (right + wrong) if right + wrong else -1.0


def prune(conditions: list[Condition], x: dict[str, np.ndarray], hit: np.ndarray) -> list[Condition]:
    """The beginning of ``conditions`` that does best on rows it was not grown on; the shorter on ties."""
    return max((conditions[:n] for n in range(1, len(conditions) + 1)), key=lambda c: _worth(c, x, hit))


def learn(x: dict[str, np.ndarray], good: np.ndarray, seed: int = 42) -> DecisionList:
    """A decision list by sequential covering of labelled rows.

    ``x`` has a value per row for each share, ``good`` the label. At each step both verdicts are
    tried, and the rule with the better precision (Laplace) over all rows left is taken. No rows,
    or none that a rule tells apart: the list is the default, the more frequent label (ties: keep).
    """
    made, left = DecisionList(), np.arange(len(good))
    part = np.random.default_rng(seed).random(len(good)) < 2 / 3
    while len(made.rules) < MOST_RULES and len(left):
        now, label = {name: values[left] for name, values in x.items()}, good[left]
        if label.all() or not label.any():
            break
        growing = part[left]
        best = None
        for keep in (False, True):
            hit = label == keep
            conditions = grow({n: v[growing] for n, v in now.items()}, hit[growing])
            if not conditions:
                continue
            conditions = prune(conditions, {n: v[~growing] for n, v in now.items()}, hit[~growing])
            rule = Rule(tuple(conditions), keep)
            covered = rule.covers(now)
            right, wrong = int((covered & hit).sum()), int((covered & ~hit).sum())
            precision = (right + 1) / (right + wrong + 2)
            # A rule has to beat the share that its verdict has among the rows left anyway.
            if right + wrong < LEAST_COVER or precision < max(LEAST_PRECISION, hit.mean()):
                continue
            if best is None or (precision, right) > best[0]:
                best = ((precision, right), Rule(tuple(conditions), keep, right, wrong), covered)
        if best is None:
            break
        made.rules.append(best[1])
        left = left[~best[2]]
    made.default = bool(good[left].mean() >= 0.5) if len(left) else True
    return made


def fit_rules(docs: DataFrame, labels: DataFrame) -> DecisionList:
    """The list from ``labels`` (doc_id, quality 0 or 1) and the texts they belong to.

    At most ``SAMPLE_PER_CLASS`` documents of each class, whole texts; a repeated doc_id counts
    once. Labels that are null or have no document are left out, and so are texts that the base
    rules reject: the list judges only what passes those.
    """
    bound_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    chosen = bounded_sample(known, SAMPLE_PER_CLASS, "quality")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # A bounded number of rows: two classes of SAMPLE_PER_CLASS ids.
    sample = with_statistics(texts.join(F.broadcast(chosen), "doc_id"))
    shares = [share(name).alias(name) for name in SHARES]
    rows = sample.where(~base_failed()).select("doc_id", "quality", *shares).dropDuplicates(["doc_id", "quality"])
    # Sorted here, as a distributed sort would read the texts twice.
    table = rows.drop("doc_id").toPandas().sort_values(["quality", *SHARES], ignore_index=True)
    x = {name: table[name].to_numpy(float) for name in SHARES}
    return learn(x, table["quality"].to_numpy(int) == 1)


def judge(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """``docs`` with ``STATISTICS``, ``base_failed`` and ``kept``; columns so named are replaced.

    ``kept`` is false for what the base rules reject, else the list's verdict. Null and empty texts
    have no words and are rejected. Repeated rows stay; an empty table gives no rows.
    """
    marked = with_statistics(docs.drop("base_failed", "kept"), text).withColumn("base_failed", base_failed())
    return marked.withColumn("kept", ~F.col("base_failed") & rules.verdict())
