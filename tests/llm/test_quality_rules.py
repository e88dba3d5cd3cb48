from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from blotterline.llm import quality_rules as qr
from blotterline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORDS = re.compile("[^\\x20\\x09-\\x0D]+")


def plain(text: str | None) -> tuple[int, int, int, int, int]:
    """The five statistics of the contract, word by word."""
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_statistics_equal_the_plain_ones():
    draw = random.Random(3)
    texts = ["", " \t\n\v\f\r", "a", "a b c a b c", "x x x x", "\x1c\x85\xa0 é b", "#*$ %&|<>", "l\nl\nl \n\n \nl"]
    texts += ["".join(draw.choices(["a", "b", "é", " ", "\n", "\t", "#", "\xa0"], k=draw.randrange(300))) for _ in range(300)]
    texts += ["one two three four " * 5000]
    found = qr.statistics(texts)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert [tuple(r) for r in found[names].to_numpy().tolist()] == [plain(t) for t in texts]


def test_the_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = QUERIES["op11_quality_rules"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for row in got:
        words, chars, symbols, dup, repeats = own = plain(docs[row["doc_id"]])
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == own
        assert row["base_failed"] == (words < 50 or 100 * repeats > 50 * words)
        assert not (row["base_failed"] and row["kept"])


def table(n: int, seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    return {name: draw.random(n) for name in qr.SHARES}


def test_planted_rules_are_learned_with_exceptions():
    x, fresh = table(3000, 1), table(3000, 2)

    def good(t):
        return ~((t["symbols"] >= 0.8) | ((t["upper"] >= 0.6) & (t["marks"] >= 0.7)))

    made = qr.learn(x, good(x))
    assert 2 <= len(made.rules) <= qr.MOST_RULES and all(len(r.conditions) <= qr.MOST_CONDITIONS for r in made.rules)
    verdict = np.full(3000, made.default)
    open_rows = np.ones(3000, bool)
    for rule in made.rules:
        covered = rule.covers(fresh) & open_rows
        verdict[covered], open_rows = rule.keep, open_rows & ~covered
    assert (verdict == good(fresh)).mean() > 0.98
    assert "symbols >= 0.8" in str(made) or "symbols >= 0.79" in str(made)


def test_labels_at_random_give_the_default():
    x = table(2000, 3)
    noise = np.random.default_rng(4).random(2000) < 0.7
    made = qr.learn(x, noise)
    assert made.default and sum(r.right + r.wrong for r in made.rules) < 100
    assert qr.learn({n: v[:0] for n, v in x.items()}, noise[:0]) == qr.DecisionList([], True)
    assert qr.learn(x, np.zeros(2000, bool)) == qr.DecisionList([], False)


def test_pruning_drops_what_only_fits_the_growing_rows():
    x = table(400, 5)
    hit = x["digits"] >= 0.5
    conditions = [qr.Condition("digits", True, 0.5), qr.Condition("words", True, 0.9)]
    assert qr.prune(conditions, x, hit) == conditions[:1]


def test_the_expression_decides_as_the_list(spark):
    rules = qr.DecisionList(
        [
            qr.Rule((qr.Condition("symbols", True, 0.5), qr.Condition("words", False, 100.0)), False),
            qr.Rule((qr.Condition("symbols", True, 0.4),), True),
            qr.Rule((qr.Condition("upper", True, 0.2),), False),
        ]
    )
    texts = ["# " * 60, "# " * 200, "word " * 60 + "A" * 90, "quiet word here now " * 20]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    marked = qr.with_statistics(docs)
    got = {r["doc_id"]: r["v"] for r in marked.select("doc_id", rules.verdict().alias("v")).collect()}
    assert got == {0: False, 1: True, 2: False, 3: True}


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rules = qr.fit_rules(docs, labels.where(~held))
    got = qr.judge(docs, rules).join(labels.where(held), "doc_id").where("NOT base_failed").toPandas()
    clean, junk = got[got["quality"] == 1], got[got["quality"] == 0]
    assert len(clean) > 300 and len(junk) > 30
    assert clean["kept"].mean() >= 0.99, str(rules)
    assert junk["kept"].mean() <= 0.1, str(rules)


def test_dirt(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, 5, "a"), (1, text, 5, "a"), (2, None, None, None), (None, "", 1, "b"), (3, "x" * 300_000, 2, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (9, 0), (2, None)], "doc_id long, quality int")
    rules = qr.fit_rules(docs, labels)
    got = qr.judge(docs, rules).collect()
    assert len(got) == 5 and got[0]["n_words"] == 80
    assert [r["doc_id"] for r in got if r["kept"]] == [1, 1]
    assert qr.judge(docs.limit(0), qr.fit_rules(docs.limit(0), labels.limit(0))).count() == 0
