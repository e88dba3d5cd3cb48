"""Ids and columns that are only passed on come back as they went in."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from blotterline.llm import bpe, edit_fingerprint, html_text, language_id, packing, quality, simhash, toxicity
from blotterline.llm.common import map_frames
from blotterline.llm.vector_search import quantised, top_k

tokenizers = pytest.importorskip("public_tokenizers")

BIG = 2**53 + 1
TEXT = "A plain text of quite a few words, with a full stop. And a second sentence follows here."


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(BIG, TEXT, "en", "a", BIG), (None, TEXT + " More.", "en", None, None), (3, None, None, "b", -BIG)]
    names = "doc_id long, text string, lang string, source string, host long"
    return spark.createDataFrame(rows, names).coalesce(1)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(BIG, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")


def ids(df, name="doc_id"):
    return sorted((r[name] for r in df.collect()), key=lambda x: (x is None, x))


def test_ids_beside_a_null_id(spark, docs, labels):
    every = [3, BIG, None]
    path, words = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("word_bpe_49k.json")
    near = simhash.near_duplicates(docs)
    assert ids(near) == every
    assert ids(simhash.one_of_each(docs)) == every
    assert ids(edit_fingerprint.fingerprints(docs)) == every
    assert ids(edit_fingerprint.edited_fingerprints(docs)) == every
    assert ids(packing.token_pieces(docs, path)) == every
    assert ids(bpe.code_digests(docs, words)) == every
    assert ids(bpe.decode(bpe.encode(docs, words), words)) == every
    assert ids(toxicity.with_toxicity(docs, toxicity.fit_grammar(docs, labels))) == every
    filters = language_id.fit_filters(docs)
    assert ids(language_id.with_language(docs, filters)) == every
    assert ids(language_id.in_known_language(docs, filters, (0.0, 0.0))) == [BIG, None]
    pages = docs.select("doc_id", F.lit("http://a/b").alias("url"), F.col("text").alias("html"))
    assert ids(html_text.extract(pages, "doc_id"), "page_id") == every


def test_other_columns_are_left_alone(spark, docs, labels):
    model = quality.fit_quality(docs, labels)
    before = {tuple(r) for r in docs.collect()}
    kept = quality.good(docs, model, least=0.0)
    assert kept.schema == docs.schema and {tuple(r) for r in kept.collect()} == before
    clashing = docs.withColumn("_key", F.lit("k")).withColumn("_size", F.lit(1)).withColumn("row", F.lit(2))
    single = simhash.one_of_each(clashing)
    assert single.columns == clashing.columns
    assert {(r["_key"], r["_size"], r["row"]) for r in single.collect()} == {("k", 1, 2)}
    filters = language_id.fit_filters(docs)
    known = language_id.in_known_language(docs, filters, (0.0, 0.0))
    assert {tuple(r) for r in known.collect()} == {r for r in before if r[1] is not None}


def test_values_of_all_kinds_pass_through(spark):
    rows = [
        (BIG, [BIG, None], {"a": BIG}, (None, "x"), Decimal("1.10"), float("nan"), b"\x00", True, "t"),
        (None, None, None, None, None, None, None, None, None),
    ]
    kinds = (
        "n long, a array<long>, m map<string,long>, s struct<i:long,t:string>, d decimal(20,2), f double, "
        "b binary, z boolean, text string"
    )
    df = spark.createDataFrame(rows, kinds).coalesce(1)
    df = df.withColumn("at", F.lit("2024-05-06 07:08:09.123456").cast("timestamp"))
    df = df.withColumn("day", F.col("at").cast("date")).withColumn("ntz", F.col("at").cast("timestamp_ntz"))
    same = map_frames(df, lambda frames: (f for f in frames), df.schema)
    shown = lambda x: sorted(map(str, x.collect()))
    assert same.schema == df.schema and shown(same) == shown(df)


def test_search_leaves_null_ids_out(spark):
    rows = [(1, [0.5, 0.5]), (2, [0.25, 0.5]), (None, [1.0, 1.0])]
    vectors = quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = top_k(vectors, vectors, k=5).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in found) == [(1, 2), (2, 1)]
