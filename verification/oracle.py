"""SQL counterparts of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from blotterline.schema import ENCODED, FIELDS, GOLD_FIELDS, INCIDENT_SCHEMA

# The adapter of verification/feed.py, written again in SQL.
_MADE = {
    "ID": "CAST(event_id AS VARCHAR)",
    "Date": """CASE WHEN event_id % 101 = 0 THEN NULL
                    WHEN event_id % 103 = 0 THEN 'bad date'
                    ELSE strftime(ts, '%m/%d/%Y %I:%M:%S %p') END""",
    "Primary_Type": """CASE WHEN event_id % 107 = 0 THEN NULL
                            WHEN event_id % 109 = 0 THEN '  '
                            ELSE event_type END""",
    "Description": """'said "' || event_type || '",' || chr(10) || 'unit '
                      || CAST(user_id AS VARCHAR)""",
    "Location_Description": """CASE WHEN event_id % 89 = 0 THEN ''
                                    ELSE 'SITE_' || CAST(event_id % 23 AS VARCHAR) END""",
    "Arrest": """CASE WHEN value > 60 THEN 'true'
                      WHEN event_id % 113 = 0 THEN 'TRUE'
                      WHEN event_id % 127 = 0 THEN NULL
                      ELSE 'false' END""",
    "Domestic": "CASE WHEN event_id % 7 = 0 THEN 'true' ELSE 'false' END",
    "District": "CAST(user_id % 25 + 1 AS VARCHAR)",
    "Year": "CAST(year(ts) AS VARCHAR)",
    "Latitude": """CASE WHEN event_id % 97 = 0 THEN ''
                        WHEN event_id % 131 = 0 THEN 'Infinity'
                        WHEN event_id % 137 = 0 THEN '1e400'
                        WHEN event_id % 139 = 0 THEN 'NaN'
                        WHEN event_id % 149 = 0 THEN '41.8f'
                        ELSE '41.' || CAST(user_id % 400 + 600 AS VARCHAR) END""",
    "Longitude": "'-87.' || CAST(user_id % 300 + 500 AS VARCHAR)",
}


def _made(name: str) -> str:
    return _MADE.get(name, "CAST(NULL AS VARCHAR)")


def _quoted(names: list[str], form: str = "{0}") -> str:
    return ", ".join(form.format(f'"{name}"') for name in names)


FEED = "feed AS (SELECT {}, user_id, props FROM events)".format(
    ", ".join(f'{_made(name)} AS "{name}"' for name in FIELDS)
)

SILVER = """silver AS (
  SELECT {} FROM feed
  WHERE "ID" IS NOT NULL AND "Date" IS NOT NULL AND "Primary_Type" IS NOT NULL)""".format(
    ", ".join(
        f"coalesce(\"{name}\" = 'true', false) AS \"{name}\""
        if name in ("Arrest", "Domestic")
        else f'"{name}"'
        for name in FIELDS
    )
)

GOLD = f"gold AS (SELECT {_quoted(GOLD_FIELDS)} FROM silver)"

DATED = """dated AS (
  SELECT *, try_strptime("Date", '%m/%d/%Y %I:%M:%S %p') AS parsed FROM gold)"""

FEATURES = """features AS (
  SELECT "ID", "Date",
         CASE WHEN trim("Primary_Type") = '' THEN 'UNKNOWN' ELSE "Primary_Type" END
           AS "Primary_Type",
         CASE WHEN "Location_Description" IS NULL OR trim("Location_Description") = ''
              THEN 'UNKNOWN' ELSE "Location_Description" END AS "Location_Description",
         "Arrest", "Domestic", "District", "Year",
         TRY_CAST(trim("Latitude") AS DOUBLE) AS "Latitude",
         TRY_CAST(trim("Longitude") AS DOUBLE) AS "Longitude",
         parsed AS ts,
         CAST(hour(parsed) AS INTEGER) AS "Hour",
         CAST(dayofweek(parsed) + 1 AS INTEGER) AS "DayOfWeek",
         CASE WHEN dayofweek(parsed) IN (0, 6) THEN 1 ELSE 0 END AS "IsWeekend",
         CAST("Arrest" AS INTEGER) AS label
  FROM dated
  WHERE parsed IS NOT NULL
    AND isfinite(TRY_CAST(trim("Latitude") AS DOUBLE))
    AND isfinite(TRY_CAST(trim("Longitude") AS DOUBLE)))"""

BUCKET = "CAST('0x' || substr(md5(\"ID\"), 1, 8) AS BIGINT) % 100"

TO_GOLD = f"WITH {FEED}, {SILVER}, {GOLD}, {DATED}"
TO_FEATURES = f"{TO_GOLD}, {FEATURES}"

PERIOD = "CASE WHEN dayofweek(parsed) IN (0, 6) THEN 'weekend' ELSE 'weekday' END"


def _top(column: str, rows: int) -> str:
    return f"""SELECT "{column}", count(*) AS "count" FROM gold
               WHERE "{column}" IS NOT NULL
               GROUP BY "{column}" ORDER BY "count" DESC, "{column}" LIMIT {rows}"""


SILVER_ROWS = f"WITH {FEED}, {SILVER} SELECT {_quoted(FIELDS)} FROM silver"
GOLD_ROWS = f"WITH {FEED}, {SILVER}, {GOLD} SELECT * FROM gold"

BRONZE_ROWS = """WITH {feed},
full_text AS (
  SELECT user_id, CAST(json_object({pairs}) AS VARCHAR) AS payload FROM feed)
SELECT payload, true AS stamped
FROM (SELECT payload, unnest(range(user_id % 3 + 1)) AS copy FROM full_text)
UNION ALL
SELECT props, true FROM feed""".format(
    feed=FEED, pairs=", ".join(f"'{name}', \"{name}\"" for name in FIELDS)
)

DASHBOARD = f"""{TO_GOLD}
SELECT 'rows' AS section, 'all' AS item, count(*) AS "count" FROM gold
UNION ALL
SELECT 'hour', CAST(hour(parsed) AS VARCHAR), count(*) FROM dated
WHERE parsed IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'arrest', CAST("Arrest" AS VARCHAR), count(*) FROM gold GROUP BY 2
UNION ALL
SELECT 'type', * FROM ({_top("Primary_Type", 10)})
UNION ALL
SELECT 'period', {PERIOD}, count(*) FROM dated GROUP BY 2
UNION ALL
SELECT 'location', * FROM ({_top("Location_Description", 10)})"""


def _index(column: str) -> str:
    """Category -> position by train frequency, ties by name."""
    return f"""SELECT "{column}" AS category,
        CAST(row_number() OVER (ORDER BY count(*) DESC, "{column}") - 1 AS INTEGER) AS position
      FROM features WHERE {BUCKET} < 80 GROUP BY "{column}" """


_TYPE, _LOCATION = (source for _, source in ENCODED.values())

INDEXES = f"""types AS ({_index(_TYPE)}),
locations AS ({_index(_LOCATION)})"""

ENCODED_ROWS = f"""{TO_FEATURES}, {INDEXES}
SELECT f."ID",
  coalesce(t.position, (SELECT CAST(count(*) AS INTEGER) FROM types)) AS type_index,
  coalesce(l.position, (SELECT CAST(count(*) AS INTEGER) FROM locations)) AS location_index,
  coalesce(t.position + 1, 0) AS type_slot,
  coalesce(l.position + 1, 0) AS location_slot,
  CAST(5 + (SELECT count(*) FROM types) + (SELECT count(*) FROM locations) AS INTEGER) AS width,
  CAST("Hour" AS DOUBLE) AS slot_0, CAST("DayOfWeek" AS DOUBLE) AS slot_1,
  CAST("IsWeekend" AS DOUBLE) AS slot_2, "Latitude" AS slot_3, "Longitude" AS slot_4,
  CAST("Hour" AS DOUBLE) + "DayOfWeek" + "IsWeekend" + "Latitude" + "Longitude"
    + CASE WHEN t.position IS NULL THEN 0 ELSE 1 END
    + CASE WHEN l.position IS NULL THEN 0 ELSE 1 END AS slot_sum
FROM features f
LEFT JOIN types t ON f."Primary_Type" = t.category
LEFT JOIN locations l ON f."Location_Description" = l.category"""

LABEL_ROWS = "SELECT quality AS label, toxic AS prediction FROM labels"
SCORE_ROWS = """SELECT value AS score,
  CASE WHEN event_type IN ('error', 'click') THEN 1 ELSE 0 END AS label FROM events"""


def _f1(rows: str) -> str:
    """Weighted F1 of a relation with ``label`` and ``prediction``."""
    return f"""(SELECT sum(actual * f) / sum(actual) FROM (
      SELECT actual, 2 * hits / CAST(actual + predicted AS DOUBLE) AS f
      FROM (
        SELECT k.class,
          (SELECT count(*) FROM {rows} WHERE label = k.class) AS actual,
          (SELECT count(*) FROM {rows} WHERE prediction = k.class) AS predicted,
          (SELECT count(*) FROM {rows} WHERE prediction = k.class AND label = k.class) AS hits
        FROM (SELECT DISTINCT label AS class FROM {rows}
              UNION SELECT DISTINCT prediction FROM {rows}) k)))"""


def _auc(rows: str) -> str:
    """Area under ROC of a relation with ``score`` and ``label``."""
    return f"""(SELECT CAST(sum(p * (2 * (negatives - fp) + n)) AS DOUBLE)
          / CAST(max(2 * positives * negatives) AS DOUBLE)
      FROM (
        SELECT p, n, sum(n) OVER (ORDER BY score DESC) AS fp,
               sum(p) OVER () AS positives, sum(n) OVER () AS negatives
        FROM (SELECT score, sum(label) AS p, sum(1 - label) AS n
              FROM {rows} GROUP BY score)))"""


ROC_STEPS = f"""steps AS (
  SELECT score, tp, fp, step, max(tp) OVER () AS p, max(fp) OVER () AS n,
         max(step) OVER () AS last
  FROM (
    SELECT score, sum(sum(label)) OVER (ORDER BY score DESC) AS tp,
           sum(sum(1 - label)) OVER (ORDER BY score DESC) AS fp,
           row_number() OVER (ORDER BY score DESC) AS step
    FROM ({SCORE_ROWS}) GROUP BY score))"""


def _roc(keep: str) -> str:
    return f"""WITH {ROC_STEPS}
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS BIGINT) AS tp, CAST(0 AS BIGINT) AS fp,
       CAST(0 AS DOUBLE) AS tpr, CAST(0 AS DOUBLE) AS fpr
UNION ALL
SELECT score, CAST(tp AS BIGINT), CAST(fp AS BIGINT),
       CAST(tp AS DOUBLE) / CAST(p AS DOUBLE), CAST(fp AS DOUBLE) / CAST(n AS DOUBLE)
FROM steps WHERE {keep}"""


_RULES = {
    "evening": ('"Hour"', '"Hour" >= 18'),
    "weekend": ('"IsWeekend"', '"IsWeekend" = 1'),
    "north": ('"Latitude"', '"Latitude" > 41.7'),
}

RULE_RUNS = "{}, {},\nruns AS ({})".format(
    TO_FEATURES,
    ", ".join(
        f"""{name} AS (SELECT label, {score} AS score,
              CASE WHEN {predicted} THEN 1 ELSE 0 END AS prediction FROM features)"""
        for name, (score, predicted) in _RULES.items()
    ),
    " UNION ALL ".join(
        f"""SELECT '{name}' AS classifier,
              (SELECT CAST(count(*) FILTER (label = prediction) AS DOUBLE) / count(*)
               FROM {name}) AS accuracy,
              {_f1(name)} AS f1, {_auc(name)} AS auc"""
        for name in _RULES
    ),
)


def _naive_bayes() -> str:
    """Gaussian naive Bayes over the feature vector, with its confusion on the test part.

    Mean and variance of a one-hot slot follow from counts; the variances are raised by
    1e-9 of the largest variance of any slot.
    """
    numeric = ["Hour", "DayOfWeek", "IsWeekend", "Latitude", "Longitude"]
    unpivoted = " UNION ALL ".join(
        f"SELECT \"ID\", label, '{c}' AS slot, CAST(\"{c}\" AS DOUBLE) AS x, train FROM parts"
        for c in numeric
    )
    one_hot = " UNION ALL ".join(
        f"""SELECT p."ID", p.label, '{c}_' || k.category AS slot,
              CASE WHEN p."{c}" = k.category THEN 1.0 ELSE 0.0 END AS x, p.train
            FROM parts p CROSS JOIN (
              SELECT DISTINCT "{c}" AS category FROM parts WHERE train) k"""
        for c in (_TYPE, _LOCATION)
    )
    return f"""{TO_FEATURES},
parts AS (SELECT *, {BUCKET} < 80 AS train FROM features),
slots AS ({unpivoted} UNION ALL {one_hot}),
spread AS (
  SELECT max(v) AS largest FROM (
    SELECT var_pop(x) AS v FROM slots WHERE train GROUP BY slot)),
fitted AS (
  SELECT label AS class, slot, avg(x) AS mean,
         var_pop(x) + 1e-9 * (SELECT largest FROM spread) AS var
  FROM slots WHERE train GROUP BY label, slot),
prior AS (SELECT label AS class, ln(count(*)) AS weight FROM parts WHERE train GROUP BY label),
scored AS (
  SELECT s."ID", s.label, f.class,
         sum(-0.5 * ln(f.var) - (s.x - f.mean) * (s.x - f.mean) / (2 * f.var)) AS fit
  FROM slots s JOIN fitted f ON s.slot = f.slot
  WHERE NOT s.train GROUP BY s."ID", s.label, f.class),
predicted AS (
  SELECT s."ID", s.label, arg_max(s.class, s.fit + p.weight) AS prediction
  FROM scored s JOIN prior p ON s.class = p.class GROUP BY s."ID", s.label),
cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS c(label, prediction))
SELECT c.label, c.prediction, count(p."ID") AS "count"
FROM cells c LEFT JOIN predicted p ON p.label = c.label AND p.prediction = c.prediction
GROUP BY c.label, c.prediction"""


def _silver_with_block(block: str) -> str:
    """Silver with an expression for ``Block`` over ``ID``."""
    columns = ", ".join(f'{block} AS "Block"' if c == "Block" else f'"{c}"' for c in FIELDS)
    return f"WITH {FEED}, {SILVER} SELECT {columns} FROM silver"


_EVENT = 'CAST("ID" AS BIGINT)'
FIRST_ARRIVALS = _silver_with_block(f"CASE WHEN {_EVENT} % 3 <> 2 THEN 'file 0' ELSE 'file 1' END")

ARRIVED = """WITH {feed},
files AS (
  SELECT *, 'file 0' AS arrived FROM feed WHERE CAST("ID" AS BIGINT) % 3 <> 2
  UNION ALL SELECT *, 'file 1' FROM feed WHERE CAST("ID" AS BIGINT) % 3 <> 0
  UNION ALL SELECT *, 'file 2' FROM feed),
texts AS (SELECT CAST("ID" AS BIGINT) AS event_id, CAST(json_object({pairs}) AS VARCHAR) AS text
          FROM files),
messages AS (
  SELECT text FROM texts
  UNION ALL
  SELECT CASE WHEN event_id % 50 = 0 THEN substr(text, 1, 40)
              WHEN event_id % 51 = 0 THEN 'no json' ELSE 'null' END
  FROM texts WHERE event_id % 50 = 0 OR event_id % 51 = 0 OR event_id % 53 = 0)
SELECT CAST(length(text) AS INTEGER) AS size, count(*) AS "count" FROM messages GROUP BY 1""".format(
    feed=FEED,
    pairs=", ".join(f"'{c}', {'arrived' if c == 'Block' else chr(34) + c + chr(34)}" for c in FIELDS),
)

DASHBOARD_BY_ARRIVAL = " UNION ALL ".join(
    f"""SELECT CAST({number} AS INTEGER) AS arrival, * FROM (
      {DASHBOARD.replace("FROM silver)", f"FROM silver WHERE {_EVENT} % 3 <> {number or 2} OR {number} > 0)")})"""
    for number in range(3)
)

# What arrives as one message per record, and the dirt beside it.
_REASON = """CASE WHEN "Date" IS NULL THEN 'no Date'
                    WHEN "Primary_Type" IS NULL THEN 'no Primary_Type' ELSE 'accepted' END"""
_DIRT = """CASE WHEN {0} % 50 = 0 OR {0} % 51 = 0 THEN 'malformed JSON'
                WHEN {0} % 53 = 0 THEN 'no record' END"""


def _arrived_reasons(where: str) -> str:
    """Reasons of the messages of the chosen records."""
    dirt = _DIRT.format(_EVENT)
    return f"""SELECT {_REASON} AS reason FROM feed WHERE {where}
      UNION ALL SELECT {dirt} FROM feed WHERE ({where}) AND {dirt} IS NOT NULL"""


REJECTS = f"""{TO_GOLD},
messages AS ({_arrived_reasons("true")}
  UNION ALL SELECT {_REASON} FROM (SELECT *, unnest(range(user_id % 3 + 1)) AS copy FROM feed)
  UNION ALL SELECT 'no ID' FROM feed),
rows AS (
  SELECT CASE WHEN trim("Latitude") = '' THEN 'blank Latitude'
              WHEN parsed IS NULL THEN 'unreadable Date'
              WHEN NOT coalesce(isfinite(TRY_CAST(trim("Latitude") AS DOUBLE)), false)
                THEN 'no number in Latitude'
              ELSE 'accepted' END AS reason FROM dated)
SELECT 'messages' AS stage, reason, count(*) AS "count" FROM messages GROUP BY 2
UNION ALL
SELECT 'features', reason, count(*) FROM rows GROUP BY 2"""

STREAM_REJECTS = f"""WITH {FEED},
messages AS ({_arrived_reasons(f"{_EVENT} % 3 <> 2")}
  UNION ALL {_arrived_reasons(f"{_EVENT} % 3 <> 0")}
  UNION ALL {_arrived_reasons("true")})
SELECT reason, count(*) AS "count" FROM messages GROUP BY 1"""

# The second half of the records arrives first; what is two days behind its newest is late then.
LATE = f"""half AS (SELECT max(event_id) // 2 AS h FROM events),
parsed_silver AS (
  SELECT *, try_strptime("Date", '%m/%d/%Y %I:%M:%S %p') AS parsed,
         {_EVENT} <= (SELECT h FROM half) AS second FROM silver),
marked AS (
  SELECT *, coalesce(second AND parsed <= (
    SELECT max(parsed) FROM parsed_silver WHERE NOT second) - INTERVAL 2 DAY, false) AS is_late
  FROM parsed_silver)"""

PLANTED = f"""{TO_FEATURES},
planted AS (SELECT CASE WHEN "Hour" >= 18 THEN 1 ELSE 0 END AS label FROM features
            WHERE {BUCKET} >= 80),
cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS c(label, prediction))
SELECT c.label, c.prediction, count(p.label) AS "count"
FROM cells c LEFT JOIN planted p ON p.label = c.label AND p.label = c.prediction
GROUP BY c.label, c.prediction"""

ORACLE: dict[str, str] = {
    "incident_feed": f"WITH {FEED} SELECT {_quoted(FIELDS)} FROM feed",
    "csv_scan": "WITH {} SELECT {} FROM feed".format(
        FEED, ", ".join(f"coalesce(\"{name}\", '') AS \"{name}\"" for name in FIELDS)
    ),
    "json_messages": f"WITH {FEED} SELECT {_quoted(FIELDS)} FROM feed",
    "silver_clean": SILVER_ROWS,
    "gold_projection": GOLD_ROWS,
    "backfill_gold": GOLD_ROWS,
    "stream_bronze": BRONZE_ROWS,
    "stream_silver": SILVER_ROWS,
    "stream_gold": GOLD_ROWS,
    "stream_default_trigger": GOLD_ROWS,
    "stream_silver_bounded": SILVER_ROWS,
    "history_then_stream": FIRST_ARRIVALS,
    "history_then_stream_gold": GOLD_ROWS,
    "history_then_stream_bronze": ARRIVED,
    "compacted_silver": FIRST_ARRIVALS,
    "stream_old_files": """SELECT CAST(event_id AS VARCHAR) AS "ID", 'file 0' AS "Block"
        FROM events WHERE event_id % 101 <> 0 AND event_id % 107 <> 0""",
    "stream_bounded_late": f"""WITH {FEED}, {SILVER}, {LATE}
        SELECT count(*) FILTER (NOT is_late) AS silver_rows,
               count(*) FILTER (is_late) AS late_rows FROM marked""",
    "late_rows": f"""WITH {FEED}, {SILVER}, {LATE}
        SELECT {_quoted([c for c in FIELDS if c != "Block"])} FROM marked WHERE is_late""",
    "bounded_state_ids": f"""WITH {FEED}, {SILVER}, {LATE}
        SELECT "ID", parsed + INTERVAL 2 DAY AS expires FROM marked
        WHERE NOT is_late AND parsed + INTERVAL 4 DAY > (SELECT max(parsed) FROM marked)""",
    "dedup_state_ids": f'WITH {FEED}, {SILVER} SELECT "ID" FROM silver',
    "rejects_by_reason": REJECTS,
    "stream_rejects": STREAM_REJECTS,
    "report_refreshes": DASHBOARD_BY_ARRIVAL,
    "period_report": DASHBOARD.replace(
        "FROM silver)",
        """FROM silver WHERE CAST(try_strptime("Date", '%m/%d/%Y %I:%M:%S %p') AS DATE)
           BETWEEN DATE '2024-01-08' AND DATE '2024-01-14')""",
    ),
    "silver_differing_copies": _silver_with_block(
        f"CASE WHEN {_EVENT} % 3 <> 2 THEN 'file 0' ELSE 'file 1' END"
    ),
    "absent_layer_report": f"""SELECT 'after' AS state, * FROM ({DASHBOARD})
        UNION ALL SELECT 'before', 'rows', 'all', 0""",
    "refreshed_layer": f"""{TO_GOLD}
        SELECT 'before' AS state, count(*) AS "rows" FROM gold
        UNION ALL SELECT 'after', 2 * count(*) FROM gold""",
    "auc_one_class": "SELECT CAST(NULL AS DOUBLE) AS auc",
    "gaps_in_predictions": f"""WITH rows_ AS ({LABEL_ROWS}),
        dirty AS (SELECT nullif(label, 0) AS label, prediction FROM rows_
                  UNION ALL SELECT 2, prediction FROM rows_
                  UNION ALL SELECT label, NULL FROM rows_),
        whole AS (SELECT * FROM dirty WHERE label IS NOT NULL AND prediction IS NOT NULL),
        cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS c(label, prediction)
                  UNION SELECT label, prediction FROM whole)
        SELECT c.label || '/' || c.prediction AS item, CAST(count(w.label) AS DOUBLE) AS "value"
        FROM cells c LEFT JOIN whole w ON w.label = c.label AND w.prediction = c.prediction
        GROUP BY 1
        UNION ALL
        SELECT 'accuracy', CAST(count(*) FILTER (label = prediction) AS DOUBLE) / count(*)
        FROM whole""",
    "planted_tree_metrics": """SELECT c AS classifier, m AS metric, CAST(1 AS DOUBLE) AS "value"
        FROM (VALUES ('DecisionTree'), ('GBTClassifier')) AS c(c),
             (VALUES ('accuracy'), ('f1'), ('auc')) AS m(m)""",
    "planted_tree_confusion": PLANTED,
    "planted_gbt_confusion": PLANTED,
    "planted_tree_importances": f"""{TO_FEATURES}, {INDEXES}
        SELECT slot, CASE WHEN slot = 'Hour' THEN 1.0 ELSE 0.0 END::DOUBLE AS importance FROM (
          SELECT unnest(['Hour', 'DayOfWeek', 'IsWeekend', 'Latitude', 'Longitude']) AS slot
          UNION ALL SELECT 'Type_Vec_' || category FROM types
          UNION ALL SELECT 'Loc_Vec_' || category FROM locations)""",
    "planted_tree_importances_by_source": """
        SELECT source, CASE WHEN source = 'Hour' THEN 1.0 ELSE 0.0 END::DOUBLE AS importance
        FROM (SELECT unnest(['Hour', 'DayOfWeek', 'IsWeekend', 'Latitude', 'Longitude',
                             'Primary_Type', 'Location_Description']) AS source)""",
    "classifier_measure_differences": f"""{TO_FEATURES}
        SELECT c AS classifier, m AS metric, count(*) AS "rows", CAST(0 AS DOUBLE) AS difference
        FROM features, (VALUES ('LogisticRegression'), ('RandomForest')) AS c(c),
             (VALUES ('accuracy'), ('f1'), ('auc')) AS m(m)
        WHERE {BUCKET} >= 80 GROUP BY ALL""",
    "tree_table_differences": f"""{TO_FEATURES}
        SELECT c AS classifier, count(*) AS "rows", CAST(0 AS BIGINT) AS different
        FROM features, (VALUES ('DecisionTree'), ('RandomForest'), ('GBTClassifier')) AS c(c)
        WHERE {BUCKET} >= 80 GROUP BY ALL""",
    "importance_differences": f"""{TO_FEATURES}, {INDEXES}
        SELECT c AS classifier, 5 + (SELECT count(*) FROM types) + (SELECT count(*) FROM locations)
          AS slots, CAST(0 AS DOUBLE) AS difference
        FROM (VALUES ('RandomForest'), ('GBTClassifier')) AS c(c)""",
    "logistic_gradient": f"""{TO_FEATURES}, {INDEXES}
        SELECT slot, CAST(0 AS DOUBLE) AS gradient FROM (
          SELECT unnest(['intercept', 'Hour', 'DayOfWeek', 'IsWeekend', 'Latitude', 'Longitude']) AS slot
          UNION ALL SELECT 'Type_Vec_' || category FROM types
          UNION ALL SELECT 'Loc_Vec_' || category FROM locations)""",
    "features": f"{TO_FEATURES} SELECT * FROM features",
    "day_names": f'{TO_GOLD} SELECT "ID", dayname(parsed) AS day_name FROM dated',
    "weekend_labels": f'{TO_GOLD} SELECT "ID", {PERIOD} AS period FROM dated',
    "incident_count": f'{TO_GOLD} SELECT count(*) AS "rows" FROM gold',
    "hourly_counts": f"""{TO_GOLD}
        SELECT CAST(hour(parsed) AS INTEGER) AS "Hour", count(*) AS "count"
        FROM dated WHERE parsed IS NOT NULL GROUP BY 1 ORDER BY 1""",
    "arrest_share": f"""{TO_GOLD}
        SELECT CASE WHEN "Arrest" THEN 'arrested' ELSE 'not arrested' END AS outcome,
               count(*) AS "count",
               CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM gold) AS share
        FROM gold GROUP BY 1""",
    "location_counts": f"""{TO_GOLD}
        SELECT "Location_Description", count(*) AS "count",
               CAST(count(*) AS DOUBLE) / (SELECT count("Location_Description") FROM gold)
                 AS share
        FROM gold WHERE "Location_Description" IS NOT NULL GROUP BY 1""",
    "top_types": f"{TO_GOLD} {_top('Primary_Type', 10)}",
    "top_locations": f"""{TO_GOLD}
        SELECT *, CAST("count" AS DOUBLE) / sum("count") OVER () AS share
        FROM ({_top("Location_Description", 10)})""",
    "weekend_counts": f"""{TO_GOLD}
        SELECT {PERIOD} AS period, count(*) AS "count" FROM dated GROUP BY 1""",
    "weekend_counts_dated": f"""{TO_GOLD}
        SELECT {PERIOD} AS period, count(*) AS "count" FROM dated
        WHERE parsed IS NOT NULL GROUP BY 1""",
    "dashboard_report": DASHBOARD,
    "hash_split": f"""{TO_FEATURES}
        SELECT "ID", CASE WHEN {BUCKET} < 80 THEN 'train' ELSE 'test' END AS part
        FROM features""",
    "hash_split_sizes": f"""WITH {FEED}
        SELECT count(*) FILTER ({BUCKET} < 80) AS train_rows,
               count(*) FILTER ({BUCKET} >= 80) AS test_rows FROM feed""",
    "random_split_total": """SELECT count(*) AS "rows", count(DISTINCT event_id) AS ids
        FROM events""",
    "encoded_features": ENCODED_ROWS,
    "accuracy": """SELECT CAST(count(*) FILTER (quality = toxic) AS DOUBLE) / count(*)
        AS accuracy FROM labels""",
    "weighted_f1": f"WITH rows_ AS ({LABEL_ROWS}) SELECT {_f1('rows_')} AS f1",
    "confusion": f"""WITH rows_ AS ({LABEL_ROWS}),
        cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS c(label, prediction))
        SELECT c.label, c.prediction, count(r.label) AS "count"
        FROM cells c LEFT JOIN rows_ r
          ON r.label = c.label AND r.prediction = c.prediction
        GROUP BY c.label, c.prediction""",
    "auc": f"WITH rows_ AS ({SCORE_ROWS}) SELECT {_auc('rows_')} AS auc",
    "auc_by_range": f"WITH rows_ AS ({SCORE_ROWS}) SELECT {_auc('rows_')} AS auc",
    "roc_points": _roc("true"),
    "roc_points_thinned": _roc("step % CAST(ceil(last / 100.0) AS BIGINT) = 0 OR step = last"),
    "rule_metrics": f"""{RULE_RUNS}
        SELECT classifier, 'accuracy' AS metric, accuracy AS "value" FROM runs
        UNION ALL SELECT classifier, 'f1', f1 FROM runs
        UNION ALL SELECT classifier, 'auc', auc FROM runs""",
    "best_rule": f"""{RULE_RUNS}
        SELECT * FROM runs ORDER BY auc DESC NULLS LAST, classifier LIMIT 1""",
    "naive_bayes_confusion": _naive_bayes(),
    "saved_model_confusion": PLANTED,
    "saved_model_agreement": f"""{TO_FEATURES}
        SELECT count(*) AS "rows", CAST(0 AS BIGINT) AS different
        FROM features WHERE {BUCKET} >= 80""",
}

assert set(_MADE) <= set(INCIDENT_SCHEMA.names)
