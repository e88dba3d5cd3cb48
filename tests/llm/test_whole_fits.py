"""Counts, models and thresholds of the pipeline come from all rows, however many there are."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotterline.llm import language_id as li
from blotterline.llm import quality as qu

PLAIN, ODD = "the cat sat on the mat and looked at the dog", "the xyz cat qqq zzzv jjj on kkkw the vvvb"


def ids_by_hash(spark, count: int) -> list[int]:
    """Ids in the order in which a sample by a hash of the id would take them."""
    return [r["id"] for r in spark.range(count).orderBy(F.xxhash64("id"), "id").collect()]


def test_percentiles_are_those_of_spark(spark):
    draw = random.Random(3)
    rows = [(f"l{i % 3}", round(draw.random(), 2), draw.random()) for i in range(900)]
    rows += [("one", 0.5, 0.25), (None, 1.0, None), (None, 3.0, 7.0)]
    frame = spark.createDataFrame(rows, "g string, a double, b double").repartition(5)
    for part in (0.0, 0.01, 0.5, 1.0):
        got = {(r["g"], r["name"]): r["value"] for r in li.percentiles(frame.where("g is not null"), "g", ["a", "b"], part).collect()}
        own = frame.where("g is not null").groupBy("g").agg(F.percentile("a", F.lit(part)).alias("a"), F.percentile("b", F.lit(part)).alias("b"))
        wanted = {(r["g"], c): r[c] for r in own.collect() for c in ("a", "b")}
        assert got == pytest.approx(wanted, abs=1e-15)


def test_bounds_and_filters_see_more_than_any_sample(spark):
    ids = ids_by_hash(spark, 2_500)
    rows = [(i, ODD if at >= 2_100 else PLAIN, "en") for at, i in enumerate(ids)]
    rows += [(10_000 + i, "der hund und die katze sind nicht hier", "de") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = li.fit_filters(docs)
    hashes, *_ = li.ngram_hashes(["zzzv"])
    at = whole.languages.index("en")
    assert (whole.masks(hashes)[:, 0] >> np.uint64(at) & np.uint64(1)).all()

    some = li.fit_filters(docs.where(~F.col("text").contains("zzzv")))
    (share, lead), texts = some.evidence([PLAIN, ODD])[:2], [PLAIN, ODD]
    assert share[1] < share[0] and len(texts) == 2
    least_share, least_lead = li.fit_bounds(docs.where("lang = 'en'"), some)
    assert least_share == pytest.approx(li.LEAST_SHARE * share[1])
    assert least_lead == pytest.approx(li.LEAST_LEAD * min(lead))


def test_filters_of_very_many_ngrams_hold_all_of_them(monkeypatch):
    monkeypatch.setattr(li, "MOST_WORDS", 1 << 12)
    draw = np.random.default_rng(0)
    ngrams = {"a": draw.integers(0, 1 << 62, 1_000).astype(np.uint64)}
    filters = li.LanguageFilters(["a"], ngrams, "a")
    assert len(filters.rows) == 1 << 12 and (filters.masks(ngrams["a"]) == 1).all()
    assert 0 < filters.false_rate[0] < 1


def test_quality_is_fitted_on_all_labelled_documents(spark):
    ids = ids_by_hash(spark, 9_000)
    texts = {i: ("WOW !!! BUY 123 " * 3 if at % 2 else PLAIN + (" AAA" * 9 if at > 8_500 else "")) for at, i in enumerate(ids)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, (at + 1) % 2) for at, i in enumerate(ids)] + [(99_999, 1)], "doc_id long, quality int")
    model = qu.fit_quality(docs, labels.unionByName(labels.limit(9)))
    x = qu.features(list(texts.values()))
    assert model.centre == pytest.approx(x.mean(axis=0), abs=1e-12)
    assert model.spread == pytest.approx(x.std(axis=0) + 1e-9, abs=1e-9)
    y = np.array([(at + 1) % 2 for at in range(9_000)], float)
    from blotterline.llm.models import fit_logistic

    wanted = fit_logistic((x - model.centre) / model.spread, y)
    assert model.weights[:-1] == pytest.approx(wanted[:-1], abs=1e-6)
