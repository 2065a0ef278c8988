"""Predicate, rule, gate and projection queries."""

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.aggregates import LABELLED, labelled
from millrace.catalog.registry import query, r6, table, texts
from millrace.operators import aggregates as a
from millrace.operators import filters as f

FRAMES = f"""{v.TELEMETRY}, frames AS (
  SELECT event_id, user_id, ts, value AS battery_pct, k / 5.0 AS motor_current_A, value / 20 AS linear_accel_mps2,
    k / 100.0 AS obstacle_dist_m, event_type = 'error' AS has_fatal_log, k % 2 AS restart_count, value * 0.8 AS motor_temp_C,
    k = 7 AS nav_stuck, k AS cpu_temp_C, k <> 9 AS slam_localized, value / 300 AS battery_drain_rate, -k AS wifi_rssi
  FROM telemetry)"""


def frame_columns():
    value, k = F.col("value"), F.col("k")
    return [
        value.alias("battery_pct"), (k / 5.0).alias("motor_current_A"), (value / 20).alias("linear_accel_mps2"),
        (k / 100.0).alias("obstacle_dist_m"), (F.col("event_type") == "error").alias("has_fatal_log"), (k % 2).alias("restart_count"),
        (value * 0.8).alias("motor_temp_C"), (k == 7).alias("nav_stuck"), k.alias("cpu_temp_C"), (k != 9).alias("slam_localized"),
        (value / 300).alias("battery_drain_rate"), (-k).alias("wifi_rssi"),
    ]


def frames(spark, sf):
    return v.telemetry(spark, sf).select("event_id", "user_id", "ts", *frame_columns())


RULE_TABLE = """rules AS (SELECT * FROM (VALUES
  ('battery_critical', 0, 50, 30, 0), ('motor_overcurrent', 0, 50, 10, 5), ('collision_imu', 0, 50, 5, 10),
  ('lidar_near_obstacle', 0, 50, 5, 5), ('fatal_log', 0, 50, 0, 30), ('unexpected_restart', 0, 50, 60, 30),
  ('high_motor_temp', 0, 50, 60, 10), ('nav_stuck', 1, 35, 10, 15), ('battery_low', 1, 35, 10, 0),
  ('motor_temp_elevated', 1, 35, 30, 5), ('high_cpu_temp', 1, 35, 20, 5), ('slam_lost', 1, 35, 30, 30),
  ('battery_discharging_fast', 2, 35, 5, 5), ('wifi_poor', 2, 35, 0, 0)) AS r(rule, priority, score, pre_sec, post_sec)),
hits AS (SELECT frames.*, rules.* FROM frames CROSS JOIN rules WHERE CASE rule
  WHEN 'battery_critical' THEN battery_pct < 15 WHEN 'motor_overcurrent' THEN motor_current_A > 12
  WHEN 'collision_imu' THEN linear_accel_mps2 > 8 WHEN 'lidar_near_obstacle' THEN obstacle_dist_m < 0.1
  WHEN 'fatal_log' THEN has_fatal_log WHEN 'unexpected_restart' THEN restart_count > 0
  WHEN 'high_motor_temp' THEN motor_temp_C > 80 WHEN 'nav_stuck' THEN nav_stuck WHEN 'battery_low' THEN battery_pct < 25
  WHEN 'motor_temp_elevated' THEN motor_temp_C > 60 WHEN 'high_cpu_temp' THEN cpu_temp_C > 70
  WHEN 'slam_lost' THEN NOT slam_localized WHEN 'battery_discharging_fast' THEN battery_drain_rate > 0.3
  WHEN 'wifi_poor' THEN wifi_rssi < -75 END)"""


@query("flt_1_drop_incomplete", f"""WITH {LABELLED}, g AS (SELECT source, quality, count(*) AS n FROM labelled GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_distinct, count(*) FILTER (quality IS NOT NULL AND source IS NOT NULL) AS rows_out,
  CAST(sum(n) - count(*) FILTER (quality IS NOT NULL AND source IS NOT NULL) AS BIGINT) AS removed FROM g""")
def _(spark, sf):
    return f.removed_counts(labelled(spark, sf), ["source"], ["source", "quality"])


@query("flt_1_complete_rows", f"""WITH {LABELLED} SELECT doc_id, quality, toxic FROM labelled WHERE quality IS NOT NULL AND toxic IS NOT NULL""")
def _(spark, sf):
    return f.drop_incomplete(labelled(spark, sf), ["quality", "toxic"]).select("doc_id", "quality", "toxic")


@query("flt_2_rule_events", f"""WITH {FRAMES}, {RULE_TABLE}
SELECT event_id, rule, CAST(priority AS INT) AS priority, CAST(score AS DOUBLE) AS score, CAST(pre_sec AS DOUBLE) AS pre_sec,
  CAST(post_sec AS DOUBLE) AS post_sec FROM hits""")
def _(spark, sf):
    return f.rule_events(frames(spark, sf)).select("event_id", "rule", "priority", "score", "pre_sec", "post_sec")


@query("flt_3_score_priority", """
SELECT p_partkey, CAST(CASE WHEN p_size * 2 >= 90 THEN 0 WHEN p_size * 2 >= 60 THEN 1 WHEN p_size * 2 >= 30 THEN 2 ELSE 3 END AS INT) AS priority FROM part""")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", f.priority_of_score(F.col("p_size") * 2).alias("priority"))


@query("flt_4_flag_membership", f"""WITH {v.TELEMETRY}, {v.FLEET}
SELECT robot_id, hour, CAST(len(anomaly_flags) AS INT) AS flags FROM fleet WHERE list_contains(anomaly_flags, 'error') AND len(anomaly_flags) > 0""")
def _(spark, sf):
    flags = F.col("anomaly_flags")
    return v.fleet(spark, sf).where(f.has_flag(flags, "error") & (F.size(flags) > 0)).select(
        "robot_id", "hour", F.size(flags).alias("flags")
    )


@query("flt_5_recent", """
SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOURS""")
def _(spark, sf):
    return table(spark, sf, "events").where(f.since(F.col("ts"), "2024-01-31 00:00:00", "48 HOURS")).select("event_id", "user_id")


GATE = f"""{v.SCORED}, c AS (SELECT lang, count(*) FILTER (truth = predicted) / count(*) AS accuracy,
  count(*) FILTER (truth = 1 AND predicted = 1) AS tp, count(*) FILTER (predicted = 1) AS called, count(*) FILTER (truth = 1) AS pos
  FROM scored GROUP BY 1),
m AS (SELECT lang, accuracy, CASE WHEN called = 0 THEN 0 ELSE tp / called END AS precision, CASE WHEN pos = 0 THEN 0 ELSE tp / pos END AS recall FROM c)"""


def model_metrics(spark, sf):
    hit = (F.col("truth") == 1) & (F.col("predicted") == 1)
    per = v.scored(spark, sf).groupBy(F.col("lang").alias("model")).agg(
        a.safe_ratio(F.count_if(F.col("truth") == F.col("predicted")), F.count(F.lit(1))).alias("accuracy"),
        a.safe_ratio(F.count_if(hit), F.count_if(F.col("predicted") == 1)).alias("precision"),
        a.safe_ratio(F.count_if(hit), F.count_if(F.col("truth") == 1)).alias("recall"),
    )
    return per.unpivot(["model"], ["accuracy", "precision", "recall"], "metric", "value")


@query("flt_6_threshold_gate", f"""WITH {GATE},
x AS (SELECT lang AS model, concat_ws(',', CASE WHEN accuracy < 0.6 THEN 'accuracy' END, CASE WHEN precision < 0.7 THEN 'precision' END,
  CASE WHEN recall < 0.5 THEN 'recall' END) AS failed FROM m)
SELECT model, failed, failed = '' AS passes FROM x""")
def _(spark, sf):
    return f.threshold_gate(model_metrics(spark, sf), {"accuracy": 0.6, "precision": 0.7, "recall": 0.5}, "model")


@query("flt_6_missing_metric", f"""WITH {GATE}
SELECT lang AS model, concat_ws(',', CASE WHEN accuracy < 0.1 THEN 'accuracy' END, 'f1') AS failed, false AS passes FROM m""")
def _(spark, sf):
    return f.threshold_gate(model_metrics(spark, sf), {"accuracy": 0.1, "f1": 0.7}, "model")


@query("flt_7_rename_cast", """
SELECT event_id, TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS DOUBLE) AS duration_ms, TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS INT) + 200 AS status_code,
  event_type = 'error' AS is_error, 'telemetry' AS service FROM events""")
def _(spark, sf):
    raw = table(spark, sf, "events").withColumn("parsed", F.from_json("props", "k string"))
    return raw.selectExpr(
        "event_id", "try_cast(parsed.k AS double) AS duration_ms", "try_cast(parsed.k AS int) + 200 AS status_code",
        "event_type = 'error' AS is_error", "'telemetry' AS service", "props", "user_id",
    ).drop("props", "user_id")


@query("flt_8_tags", """
SELECT event_id, concat_ws(',', CASE WHEN event_type = 'error' THEN 'error' END, CASE WHEN event_type IN ('click', 'view') THEN 'ml' END,
  CASE WHEN event_type IN ('click', 'view') THEN 'prediction' END, CASE WHEN value * 10 > 1000 THEN 'slow_request' END) AS tags FROM events""")
def _(spark, sf):
    e = F.col("event_type")
    tags = f.tag_when(error=e == "error", prediction=e.isin("click", "view"), ml=e.isin("click", "view"), slow_request=F.col("value") * 10 > 1000)
    return table(spark, sf, "events").select("event_id", F.array_join(tags, ",").alias("tags"))


@query("flt_9_priority_label", f"""WITH {v.MANIFEST}
SELECT file_id, CASE priority WHEN 0 THEN 'P0 Critical' WHEN 1 THEN 'P1 High' WHEN 2 THEN 'P2 Normal' WHEN 3 THEN 'P3 Low/Bulk' END AS label FROM manifest""")
def _(spark, sf):
    return v.manifest(spark, sf).select("file_id", f.priority_label(F.col("priority")).alias("label"))


@query("flt_10_min_length", """
SELECT doc_id, n_chars FROM documents WHERE length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\\S+@\\S+', '', 'g'), ' +', ' ', 'g'), '\\n\\n+', E'\\n\\n', 'g'), '^\\s+|\\s+$', '', 'g')) >= 10""")
def _(spark, sf):
    from millrace.functions.text import clean_text

    return f.long_enough(texts(spark, sf), clean_text(F.col("text"))).select("doc_id", "n_chars")


@query("flt_12_recommendations", f"""WITH {v.TELEMETRY}, {v.USAGE},
p AS (SELECT 'gpu' AS component, sum(gpu_cost) AS amount FROM usage UNION ALL SELECT 'vector_db', sum(vector_cost) FROM usage
  UNION ALL SELECT 'network', sum(network_cost) FROM usage),
s AS (SELECT component, amount / sum(amount) OVER () * 100 AS percentage FROM p)
SELECT component, round(percentage, 6) AS percentage, CASE component WHEN 'gpu' THEN 'GPU' WHEN 'vector_db' THEN 'Vector Database' ELSE 'Network' END AS category,
  CAST(CASE component WHEN 'gpu' THEN 3 WHEN 'vector_db' THEN 2 ELSE 1 END AS INT) AS priority
FROM s WHERE percentage > CASE component WHEN 'gpu' THEN 70 WHEN 'vector_db' THEN 20 ELSE 10 END""")
def _(spark, sf):
    sums = v.usage(spark, sf).agg(
        F.sum("gpu_cost").alias("gpu"), F.sum("vector_cost").alias("vector_db"), F.sum("network_cost").alias("network")
    )
    parts = sums.unpivot([], ["gpu", "vector_db", "network"], "component", "amount")
    limits = {"gpu": (70.0, "GPU", 3), "vector_db": (20.0, "Vector Database", 2), "network": (10.0, "Network", 1)}
    out = f.recommendations(a.cost_shares(parts, "component", "amount"), "component", limits)
    return out.withColumn("percentage", r6("percentage"))


@query("flt_13_missing_fields", """
SELECT event_id, 'priority,region' AS missing FROM events WHERE props LIKE '%"k"%'""")
def _(spark, sf):
    missing = f.missing_fields(F.col("props"), ["k", "region", "priority"])
    return table(spark, sf, "events").select("event_id", F.array_join(F.array_sort(missing), ",").alias("missing"))


@query("agg_38_missing_counters", """
WITH j AS (SELECT CASE WHEN event_type = 'error' THEN '{"k": 1, "region": 2}' ELSE props END AS props FROM events)
SELECT 'region' AS feature, count(*) FILTER (props NOT LIKE '%"region"%') AS missing FROM j
UNION ALL SELECT 'priority', count(*) FROM j""")
def _(spark, sf):
    record = F.when(F.col("event_type") == "error", '{"k": 1, "region": 2}').otherwise(F.col("props"))
    rows = table(spark, sf, "events").select(record.alias("record"))
    return f.missing_field_counts(rows, "record", ["k", "region", "priority"])


@query("flt_14_copy_decision", f"""WITH {v.LISTING}
SELECT a.key, CASE WHEN b.key IS NULL THEN 'copy' WHEN a.size <> b.size THEN 'copy' WHEN a.etag <> b.etag THEN 'conflict' ELSE 'skip' END AS action
FROM listing_a a LEFT JOIN listing_b b ON a.key = b.key""")
def _(spark, sf):
    return f.copy_decision(*v.listings(spark, sf))
