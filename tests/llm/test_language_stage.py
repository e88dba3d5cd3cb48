from __future__ import annotations

import random

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string"
LICENCE = "This work is licensed under the GNU General Public License, version 3."


def words(draw: random.Random, letters: str, count: int) -> str:
    return " ".join("".join(draw.choices(letters, k=draw.randint(2, 9))) for _ in range(count))


def kept(spark, rows) -> set[int]:
    stage = dict(corpus_pipeline.STAGES)["language"]
    return {r["doc_id"] for r in stage(spark, spark.createDataFrame(rows, COLUMNS), "").collect()}


def test_texts_in_no_known_language_go(spark):
    draw = random.Random(9)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()
    rows = [tuple(r) for r in docs if any(c.isalpha() for c in r["text"])]
    known = {r[0] for r in rows}
    own = {lang: next(t for _, t, x in rows if x == lang) for lang in ("de", "en", "es", "fr")}
    short = [(10_000 + i, f"{t[:60]} {LICENCE}", None) for i, t in enumerate(own.values())]
    strange = [words(draw, "abcdefghijklmnopqrstuvwxyz", 100) for _ in range(10)]
    strange += ["Минуло багато років відтоді як вони бачилися востаннє", "Η γλώσσα αυτή δεν είναι γνωστή εδώ"]
    strange += ["Tämä on suomenkielinen lause jota kukaan ei osaa lukea", "12 34", "", None]
    rows += short + [(20_000 + i, t, None) for i, t in enumerate(strange)]
    assert kept(spark, rows) == known | {r[0] for r in short}


def test_ten_alike_languages_stay(spark):
    draw = random.Random(10)
    shared = [words(draw, "aeioulnrst", 1) for _ in range(300)]
    rows = []
    for lang in range(10):
        own = [words(draw, "aeioulnrst", 1) for _ in range(15)]
        for _ in range(20):
            text = " ".join(draw.choices(shared + own, k=200))
            rows.append((len(rows), text, f"l{lang}"))
    strange = [(1000 + i, words(draw, "bcdfghjkmpqvwxyz", 100), None) for i in range(10)]
    assert kept(spark, rows + strange) == {r[0] for r in rows}
