"""The registered queries. Each takes ``(spark, sf_dir)`` and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import blotterline as bl
from blotterline.functions import percent_bucket
from blotterline.schema import FIELD_TO_HEADER, GOLD_SCHEMA, SILVER_SCHEMA
from blotterline.session import work_folder
from blotterline.sources import as_envelope
from verification.feed import arrivals, incident_feed, landed, message_feed

Query = Callable[[SparkSession, str], DataFrame]


# --- feed, sources and sinks -------------------------------------------------


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as CSV with its published headers and scanned back."""
    path = work_folder(spark, "csv")
    feed = incident_feed(spark, sf_dir)
    (
        feed.select(*[F.col(f).alias(h) for f, h in FIELD_TO_HEADER.items()])
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return bl.read_incident_csv(spark, path)


def json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed published as JSON lines, read back and parsed."""
    path = work_folder(spark, "json")
    bl.publish(incident_feed(spark, sf_dir), path=path)
    return bl.parse_payload(bl.read_messages(spark, path))


# --- layers, batch -----------------------------------------------------------


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.to_silver(bl.parse_payload(as_envelope(message_feed(spark, sf_dir))))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.to_gold(silver(spark, sf_dir))


def gold_of_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold straight from the feed, which has no repeated records: what analysis scans."""
    return bl.to_gold(bl.clean_records(incident_feed(spark, sf_dir)))


def backfill_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers written by the batch job; gold read back."""
    base = work_folder(spark, "backfill")
    bl.backfill(as_envelope(message_feed(spark, sf_dir)), base)
    return bl.read_layer(spark, f"{base}/gold", on_missing="empty", schema=GOLD_SCHEMA)


# --- layers, streaming -------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, **options: str) -> str:
    """Run the streaming job over the landed messages; gives the base of its layers."""
    base = work_folder(spark, "stream")
    message_feed(spark, sf_dir).write.text(f"{base}/landing")
    queries = bl.start_medallion(
        bl.file_source(spark, f"{base}/landing"),
        f"{base}/layers",
        f"{base}/checkpoints",
        trigger={"availableNow": True},
        **options,
    )
    bl.drain(queries)
    return f"{base}/layers"


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bl.read_layer(spark, f"{_stream(spark, sf_dir)}/bronze")
    return bronze.select(
        F.col("value").cast("string").alias("payload"),
        F.col("ingested_at").isNotNull().alias("stamped"),
    )


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_stream(spark, sf_dir)}/silver"
    return bl.read_layer(spark, path, on_missing="empty", schema=SILVER_SCHEMA)


def stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.read_layer(spark, f"{_stream(spark, sf_dir)}/gold")


def stream_default_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of a job without a trigger: batches follow each other until all messages are in."""
    base = work_folder(spark, "endless")
    message_feed(spark, sf_dir).write.text(f"{base}/landing")
    source = bl.file_source(spark, f"{base}/landing", max_files_per_trigger=4)
    queries = bl.start_medallion(source, f"{base}/layers", f"{base}/checkpoints")
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    return bl.read_layer(spark, f"{base}/layers/gold")


def stream_silver_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_silver`` with bounded state; all copies here are close in time."""
    return bl.read_layer(spark, f"{_stream(spark, sf_dir, delay='2 days')}/silver")


def _arrive(spark: SparkSession, base: str, messages: DataFrame, **options) -> None:
    """Land messages as several files and run the streaming job until it has read them, as one batch."""
    messages.write.mode("append").text(f"{base}/landing")
    queries = bl.start_medallion(
        bl.file_source(spark, f"{base}/landing"),
        f"{base}/layers",
        f"{base}/checkpoints",
        trigger={"availableNow": True},
        **options,
    )
    bl.drain(queries)


def _history_arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """History, and two later arrivals with overlapping IDs."""
    third = F.col("event_id") % 3
    chosen = (third != 2, third != 0, F.lit(True))
    return [landed(spark, sf_dir, some, f"file {number}") for number, some in enumerate(chosen)]


def _history_then_stream(spark: SparkSession, sf_dir: str, **options) -> str:
    """Three arrivals in three runs of one checkpoint, so that two of them are restarts. Gives the
    base of the layers."""
    base = work_folder(spark, "history")
    for messages in _history_arrivals(spark, sf_dir):
        _arrive(spark, base, messages, **options)
    return f"{base}/layers"


def history_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver: of each ID the record that arrived first."""
    return bl.read_layer(spark, f"{_history_then_stream(spark, sf_dir)}/silver")


def history_then_stream_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.read_layer(spark, f"{_history_then_stream(spark, sf_dir)}/gold")


def history_then_stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of the three files, as counts by their text's length."""
    bronze = bl.read_layer(spark, f"{_history_then_stream(spark, sf_dir)}/bronze")
    return bronze.groupBy(F.length(F.col("value").cast("string")).alias("size")).count()


def compacted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after its finished batches were rewritten into few files."""
    path = f"{_history_then_stream(spark, sf_dir)}/silver"
    bl.compact_layer(spark, path)
    return bl.read_layer(spark, path)


def stream_old_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver where half of the records are in files that look a year old."""
    base = work_folder(spark, "old-files")
    half = F.col("event_id") % 2
    for number in range(2):
        files = landed(spark, sf_dir, half == number, "file 0")
        files.write.mode("append").text(f"{base}/landing")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/landing")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if number == 0:
            for status in fs.listStatus(path):
                year = 365 * 24 * 3600 * 1000
                fs.setTimes(status.getPath(), status.getModificationTime() - year, -1)
    queries = bl.start_medallion(
        bl.file_source(spark, f"{base}/landing"),
        f"{base}/layers",
        f"{base}/checkpoints",
        trigger={"availableNow": True},
    )
    bl.drain(queries)
    return bl.read_layer(spark, f"{base}/layers/silver").select("ID", "Block")


def _bounded_late(spark: SparkSession, sf_dir: str) -> str:
    """Bounded state with a moving watermark, in two runs of one checkpoint: the second one brings
    the half of the records with the lower numbers. Gives the folder of the job."""
    base = work_folder(spark, "late")
    half = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("event_id")).head()[0] // 2
    for number, chosen in enumerate((F.col("event_id") > half, F.col("event_id") <= half)):
        # Which copies come together decides how many are late, so these are dealt out as messages.
        messages = arrivals(spark, sf_dir, chosen, f"file {number}").repartition(4)
        _arrive(spark, base, messages, delay="2 days")
    return base


def stream_bounded_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records silver has and how many came too late for it."""
    base = _bounded_late(spark, sf_dir)
    counts = [
        bl.row_count(df).scalar()
        for df in (bl.read_layer(spark, f"{base}/layers/silver"), bl.late_records(spark, f"{base}/layers"))
    ]
    return spark.range(1).select(counts[0].alias("silver_rows"), counts[1].alias("late_rows"))


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records themselves that came too late for silver."""
    return bl.late_records(spark, f"{_bounded_late(spark, sf_dir)}/layers").drop("Block")


def bounded_state_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The IDs that bounded state still remembers at the end, and when it forgets them."""
    state = bl.dedup_state(spark, f"{_bounded_late(spark, sf_dir)}/checkpoints")
    return state.select("ID", F.col("expires").cast("timestamp_ntz").alias("expires"))


def dedup_state_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The IDs that the deduplication remembers after three arrivals and two restarts."""
    base = work_folder(spark, "state")
    for messages in _history_arrivals(spark, sf_dir):
        _arrive(spark, base, messages)
    return bl.dedup_state(spark, f"{base}/checkpoints").select("ID")


def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why messages do not get to silver and rows of gold not to training, with what was taken."""
    both = arrivals(spark, sf_dir, F.lit(True), "file 0").unionByName(message_feed(spark, sf_dir))
    messages = bl.reason_counts(bl.judge_messages(as_envelope(both)), "messages")
    rows = bl.reason_counts(bl.judge_features(gold_of_feed(spark, sf_dir)), "features")
    return messages.unionByName(rows)


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects that a stream stored over two restarts, by reason, and what bronze has besides."""
    base = _history_then_stream(spark, sf_dir, rejects=True)
    rejected = bl.read_layer(spark, f"{base}/rejects")
    by_reason = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("count"))
    taken = bl.row_count(bl.clean_records(bl.parse_payload(bl.read_layer(spark, f"{base}/bronze"))))
    return by_reason.unionByName(taken.select(F.lit("accepted").alias("reason"), F.col("rows").alias("count")))


def report_refreshes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard report after each of three arrivals, from the counts of new batches alone."""
    base = work_folder(spark, "refreshes")
    view, reports = bl.CountsView(spark, f"{base}/layers/counts"), None
    for number, messages in enumerate(_history_arrivals(spark, sf_dir)):
        _arrive(spark, base, messages, counts=True)
        report = bl.materialize(view.refresh(), "report").select(F.lit(number).alias("arrival"), "*")
        reports = report if reports is None else reports.unionByName(report)
    return reports


def period_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard report of one week, from gold whose finished batches were cut by day."""
    path = f"{_history_then_stream(spark, sf_dir)}/gold"
    bl.compact_layer(spark, path)
    return bl.dashboard_report(bl.read_period(spark, path, date(2024, 1, 8), date(2024, 1, 14)))


def silver_differing_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch deduplication of copies that differ: the smallest in column order stays."""
    both = arrivals(spark, sf_dir, F.lit(True), "file 1").unionByName(
        arrivals(spark, sf_dir, F.col("event_id") % 3 != 2, "file 0")
    )
    return bl.to_silver(bl.parse_payload(as_envelope(both)))


def absent_layer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard report before there is a layer, and after its records have come."""
    path = work_folder(spark, "absent")

    def report(state: str) -> DataFrame:
        layer = bl.read_layer(spark, path, on_missing="empty", schema=GOLD_SCHEMA)
        return bl.dashboard_report(layer).select(F.lit(state).alias("state"), "*")

    before = bl.materialize(report("before"), "absent")
    gold_of_feed(spark, sf_dir).write.parquet(path)
    return before.unionByName(report("after"))


def refreshed_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a layer, and after records were appended to it."""
    path = work_folder(spark, "refreshed")
    records = gold_of_feed(spark, sf_dir)
    records.write.parquet(path)
    before = bl.materialize(bl.row_count(bl.read_layer(spark, path)), "refreshed")
    records.write.mode("append").parquet(path)
    after = bl.row_count(bl.read_layer(spark, path))
    return before.select(F.lit("before").alias("state"), "*").unionByName(
        after.select(F.lit("after").alias("state"), "*")
    )


# --- features and split ------------------------------------------------------


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.derive_features(gold_of_feed(spark, sf_dir))


def features_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = features(spark, sf_dir)
    return derived.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def day_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.day_name(gold_of_feed(spark, sf_dir)).select("ID", "day_name")


def weekend_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bl.weekend_label(gold_of_feed(spark, sf_dir)).select("ID", "period")


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = bl.split_by_hash(features(spark, sf_dir))
    parts = train.select("ID", F.lit("train").alias("part")).unionAll(
        test.select("ID", F.lit("test").alias("part"))
    )
    return parts


def hash_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_train = percent_bucket(F.col("ID")) < 80
    return incident_feed(spark, sf_dir).agg(
        F.count_if(in_train).alias("train_rows"), F.count_if(~in_train).alias("test_rows")
    )


def random_split_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The random parts together are the whole frame, without repeats."""
    train, test = bl.split_random(incident_feed(spark, sf_dir))
    both = train.select("ID").unionAll(test.select("ID"))
    return both.groupBy("ID").count().agg(
        F.sum("count").alias("rows"), F.count(F.lit(1)).alias("ids")
    )


def encoded_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the fitted preparation puts each record's categories, and what it assembles."""
    derived = features(spark, sf_dir)
    train, _ = bl.split_by_hash(derived)
    vectors = bl.fit_prep(train).transform(derived)
    slots = vector_to_array("features")

    def one_hot_slot(name: str) -> Column:
        # 1-based, 0 when the vector is all zeros.
        return F.array_position(vector_to_array(name), 1.0).cast("int")

    return vectors.select(
        "ID",
        F.col("Type_Indexed").cast("int").alias("type_index"),
        F.col("Loc_Indexed").cast("int").alias("location_index"),
        one_hot_slot("Type_Vec").alias("type_slot"),
        one_hot_slot("Loc_Vec").alias("location_slot"),
        F.size(slots).alias("width"),
        *[slots[i].alias(f"slot_{i}") for i in range(5)],
        F.aggregate(slots, F.lit(0.0), lambda s, x: s + x).alias("slot_sum"),
    )


# --- measures on tables that SQL can check -------------------------------------


def label_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.select(F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    positive = F.col("event_type").isin("error", "click")
    return events.select(F.col("value").alias("score"), positive.cast("int").alias("label"))


def rule_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run rows of three hand-made rules that predict arrests from one feature each."""
    derived = bl.materialize(features(spark, sf_dir), "features")
    rules = {
        "evening": (F.col("Hour"), F.col("Hour") >= 18),
        "weekend": (F.col("IsWeekend"), F.col("IsWeekend") == 1),
        "north": (F.col("Latitude"), F.col("Latitude") > 41.7),
    }
    runs = None
    for name, (score, predicted) in rules.items():
        predictions = derived.select(
            "label",
            score.cast("double").alias("score"),
            predicted.cast("double").alias("prediction"),
        )
        tally = bl.score_tally(predictions, "score")
        measures = [
            bl.accuracy(tally, "rows"),
            bl.weighted_f1(tally, "rows"),
            bl.auc(tally, "score", "rows"),
        ]
        run = spark.range(1).select(
            F.lit(name).alias("classifier"),
            *[m.scalar().alias(m.columns[0]) for m in measures],
        )
        runs = run if runs is None else runs.unionByName(run)
    return runs


# --- models --------------------------------------------------------------------


def _trained(spark: SparkSession, sf_dir: str, names: list[str] | None = None):
    derived = bl.materialize(features(spark, sf_dir), "features")
    train, test = bl.split_by_hash(derived)
    runs, models = bl.train_all(train, test, names, parallelism=5)
    return runs, models, test


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five classifiers, by way of the stored run table."""
    runs, _, _ = _trained(spark, sf_dir)
    path = work_folder(spark, "runs")
    bl.append_runs(runs, path)
    return bl.metrics_long(bl.read_layer(spark, path))


def importances_by_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, models, _ = _trained(spark, sf_dir, ["RandomForest"])
    return bl.importances(models["RandomForest"])


def importances_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, models, _ = _trained(spark, sf_dir, ["GBTClassifier"])
    return bl.importances(models["GBTClassifier"], by="source")


def _planted(spark: SparkSession, sf_dir: str, names: list[str]):
    """The classifiers on a label that is a rule of the hour, which a tree can learn exactly."""
    derived = features(spark, sf_dir).withColumn("label", (F.col("Hour") >= 18).cast("int"))
    train, test = bl.split_by_hash(bl.materialize(derived, "planted"))
    runs, models = bl.train_all(train, test, names, parallelism=2)
    return runs, models, test


def planted_tree_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, _, _ = _planted(spark, sf_dir, ["DecisionTree", "GBTClassifier"])
    path = work_folder(spark, "planted-runs")
    bl.append_runs(runs, path)
    return bl.metrics_long(bl.read_layer(spark, path))


def planted_tree_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, models, test = _planted(spark, sf_dir, ["DecisionTree"])
    return bl.confusion(models["DecisionTree"].transform(test))


def planted_gbt_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, models, test = _planted(spark, sf_dir, ["GBTClassifier"])
    return bl.confusion(models["GBTClassifier"].transform(test))


def planted_tree_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance per slot: all of it on the hour."""
    _, models, _ = _planted(spark, sf_dir, ["DecisionTree"])
    return bl.importances(models["DecisionTree"]).select("slot", "importance")


def planted_tree_importances_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, models, _ = _planted(spark, sf_dir, ["DecisionTree"])
    return bl.importances(models["DecisionTree"], by="source")


def classifier_measure_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows, and by how much our measures of LogisticRegression and RandomForest differ from
    those of Spark's evaluators, to nine digits."""
    names = ["LogisticRegression", "RandomForest"]
    runs, models, test = _trained(spark, sf_dir, names)
    count = test.count()
    rows = []
    for run in runs.collect():
        predictions = models[run["classifier"]].transform(test).persist()
        stock = {
            name: MulticlassClassificationEvaluator(metricName=name).evaluate(predictions)
            for name in ("accuracy", "f1")
        }
        stock["auc"] = BinaryClassificationEvaluator(
            rawPredictionCol="probability", numBins=0
        ).evaluate(predictions)
        predictions.unpersist()
        rows += [
            (run["classifier"], name, count, round(abs(run[name] - value), 9))
            for name, value in stock.items()
        ]
    return spark.createDataFrame(
        rows, "classifier string, metric string, rows bigint, difference double"
    )


def auc_one_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null: one class has no ranking."""
    return bl.auc(event_scores(spark, sf_dir).where("label = 1"), "score")


def gaps_in_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measures where labels and predictions have gaps and a third class occurs."""
    rows = label_predictions(spark, sf_dir)
    gaps = rows.select(
        F.when(F.col("label") == 0, None).otherwise(F.col("label")).alias("label"), "prediction"
    )
    more = rows.select(F.lit(2).alias("label"), F.col("prediction"))
    none = rows.select("label", F.lit(None).cast("int").alias("prediction"))
    dirty = gaps.unionByName(more).unionByName(none)
    cells = bl.confusion(dirty).select(
        F.concat_ws("/", "label", "prediction").alias("item"), F.col("count").cast("double").alias("value")
    )
    accuracy = bl.accuracy(dirty).select(F.lit("accuracy").alias("item"), F.col("accuracy").alias("value"))
    return cells.unionByName(accuracy)


def naive_bayes_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, models, test = _trained(spark, sf_dir, ["NaiveBayes"])
    return bl.confusion(models["NaiveBayes"].transform(test))


def saved_model_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planted rule as a saved and reloaded tree predicts it."""
    _, models, test = _planted(spark, sf_dir, ["DecisionTree"])
    path = work_folder(spark, "model")
    bl.save_model(models["DecisionTree"], path)
    return bl.confusion(PipelineModel.load(path).transform(test))


def saved_model_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows and how many of them a saved and reloaded model predicts differently."""
    _, models, test = _trained(spark, sf_dir, ["DecisionTree"])
    path = work_folder(spark, "model")
    bl.save_model(models["DecisionTree"], path)
    first = models["DecisionTree"].transform(test).withColumnRenamed("prediction", "first")
    again = PipelineModel.load(path).transform(first.select(*test.columns, "first"))
    return again.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("first") != F.col("prediction")).alias("different"),
    )


def tree_table_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows, and how many of them a classifier's table of nodes predicts differently."""
    _, models, test = _trained(spark, sf_dir, ["DecisionTree", "RandomForest", "GBTClassifier"])
    parts = []
    for name, model in models.items():
        both = bl.predict_from_nodes(model.transform(test), bl.node_table(model), bl.kind_of(model))
        same = F.col("prediction").eqNullSafe(F.col("table_prediction"))
        parts.append(both.agg(F.lit(name).alias("classifier"), F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("different")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def importance_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of the vector, and by how much importances differ from those computed again, to nine
    digits: the forest's from its nodes' statistics, the boosted trees' from the training rows."""
    _, models, _ = _trained(spark, sf_dir, ["RandomForest", "GBTClassifier"])
    train, _ = bl.split_by_hash(features(spark, sf_dir))
    parts = []
    for name, model in models.items():
        nodes, kind = bl.node_table(model), bl.kind_of(model)
        if kind == "margin":
            nodes = bl.boosted_stats(model.transform(train).select("features", "label"), bl.materialize(nodes, "nodes"))
        again = bl.importances_from_nodes(nodes, kind)
        own = model.stages[-1].featureImportances.toArray()
        table = spark.createDataFrame([(i, float(x)) for i, x in enumerate(own)], "feature int, own double")
        apart = F.abs(F.col("own") - F.coalesce("importance", F.lit(0.0)))
        both = table.join(again, "feature", "left")
        parts.append(both.agg(F.lit(name).alias("classifier"), F.count(F.lit(1)).alias("slots"), F.round(F.max(apart), 9).alias("difference")))
    return parts[0].unionByName(parts[1])


def logistic_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gradient of the fitted logistic regression's loss, to two digits: the fit stops when its loss
    improves by less than a millionth, at gradients below 0.005 here."""
    _, models, _ = _trained(spark, sf_dir, ["LogisticRegression"])
    train, _ = bl.split_by_hash(features(spark, sf_dir))
    found = bl.logistic_gradient(models["LogisticRegression"], train)
    return found.select("slot", F.round(F.abs("gradient"), 2).alias("gradient"))


QUERIES: dict[str, Query] = {
    "incident_feed": incident_feed,
    "csv_scan": csv_scan,
    "json_messages": json_messages,
    "silver_clean": silver,
    "gold_projection": gold,
    "backfill_gold": backfill_gold,
    "stream_bronze": stream_bronze,
    "stream_silver": stream_silver,
    "stream_gold": stream_gold,
    "stream_default_trigger": stream_default_trigger,
    "stream_silver_bounded": stream_silver_bounded,
    "history_then_stream": history_then_stream,
    "history_then_stream_gold": history_then_stream_gold,
    "history_then_stream_bronze": history_then_stream_bronze,
    "compacted_silver": compacted_silver,
    "stream_old_files": stream_old_files,
    "stream_bounded_late": stream_bounded_late,
    "late_rows": late_rows,
    "bounded_state_ids": bounded_state_ids,
    "dedup_state_ids": dedup_state_ids,
    "rejects_by_reason": rejects_by_reason,
    "stream_rejects": stream_rejects,
    "report_refreshes": report_refreshes,
    "period_report": period_report,
    "silver_differing_copies": silver_differing_copies,
    "absent_layer_report": absent_layer_report,
    "refreshed_layer": refreshed_layer,
    "features": features_shown,
    "day_names": day_names,
    "weekend_labels": weekend_labels,
    "incident_count": lambda s, d: bl.row_count(gold_of_feed(s, d)),
    "hourly_counts": lambda s, d: bl.hourly_counts(gold_of_feed(s, d)),
    "arrest_share": lambda s, d: bl.arrest_share(gold_of_feed(s, d)),
    "location_counts": lambda s, d: bl.value_counts(
        gold_of_feed(s, d), "Location_Description", share=True
    ),
    "top_types": lambda s, d: bl.top_k(gold_of_feed(s, d), "Primary_Type"),
    "top_locations": lambda s, d: bl.top_k(gold_of_feed(s, d), "Location_Description", share=True),
    "weekend_counts": lambda s, d: bl.weekend_counts(gold_of_feed(s, d)),
    "weekend_counts_dated": lambda s, d: bl.weekend_counts(gold_of_feed(s, d), bad_date="drop"),
    "dashboard_report": lambda s, d: bl.dashboard_report(gold_of_feed(s, d)),
    "hash_split": hash_split,
    "hash_split_sizes": hash_split_sizes,
    "random_split_total": random_split_total,
    "encoded_features": encoded_features,
    "accuracy": lambda s, d: bl.accuracy(label_predictions(s, d)),
    "weighted_f1": lambda s, d: bl.weighted_f1(label_predictions(s, d)),
    "confusion": lambda s, d: bl.confusion(label_predictions(s, d)),
    "auc": lambda s, d: bl.auc(event_scores(s, d), "score"),
    "auc_by_range": lambda s, d: bl.auc(event_scores(s, d), "score", ranges=7),
    "roc_points": lambda s, d: bl.roc_points(event_scores(s, d), score="score"),
    "roc_points_thinned": lambda s, d: bl.roc_points(
        event_scores(s, d), 101, "score", ranges=7
    ),
    "rule_metrics": lambda s, d: bl.metrics_long(rule_runs(s, d)),
    "best_rule": lambda s, d: bl.best_model(
        rule_runs(s, d).withColumn("run_ts", F.current_timestamp())
    ).drop("run_ts"),
    "model_metrics": model_metrics,
    "importances": importances_by_slot,
    "importances_by_source": importances_by_source,
    "tree_table_differences": tree_table_differences,
    "importance_differences": importance_differences,
    "logistic_gradient": logistic_gradient,
    "auc_one_class": auc_one_class,
    "gaps_in_predictions": gaps_in_predictions,
    "planted_tree_metrics": planted_tree_metrics,
    "planted_tree_confusion": planted_tree_confusion,
    "planted_gbt_confusion": planted_gbt_confusion,
    "planted_tree_importances": planted_tree_importances,
    "planted_tree_importances_by_source": planted_tree_importances_by_source,
    "classifier_measure_differences": classifier_measure_differences,
    "naive_bayes_confusion": naive_bayes_confusion,
    "saved_model_confusion": saved_model_confusion,
    "saved_model_agreement": saved_model_agreement,
}
