from __future__ import annotations

import corpus_pipeline
from blotterline.llm.simhash import near_duplicates

SF = "/root/testdata/sf0.001"


def test_each_stage_does_its_work_on_all_its_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "language", "near_dedup", "packing"]
    before = {r["doc_id"]: r for r in docs.collect()}

    good = stages["quality"](spark, docs, SF)
    kept = {r["doc_id"] for r in good.collect()}
    assert good.columns == docs.columns
    assert sum(labels[i] for i in labels if i in kept) == sum(labels.values())
    assert sum(1 for i in labels if i in kept and not labels[i]) <= 1

    known = stages["language"](spark, good, SF)
    assert known.columns == docs.columns
    assert {r["doc_id"] for r in known.collect()} == {i for i in kept if any(c.isalpha() for c in before[i]["text"])}

    classes = {r["doc_id"]: r["component_id"] for r in near_duplicates(known).collect()}
    single = stages["near_dedup"](spark, known, SF)
    assert single.columns == docs.columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(classes.values()))

    packed = stages["packing"](spark, single, SF)
    assert {r["doc_id"] for r in packed.collect()} == set(classes.values())


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None
