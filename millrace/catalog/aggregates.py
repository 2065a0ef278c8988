"""Aggregation queries."""

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.registry import cents, query, r4, r6, table
from millrace.operators import aggregates as a


@query("agg_1_cost_breakdown", f"""WITH {v.COST}
SELECT 'provider' AS dimension, provider AS member, CAST(sum(amount) AS DOUBLE) AS amount FROM cost GROUP BY ALL
UNION ALL SELECT 'region', region, CAST(sum(amount) AS DOUBLE) FROM cost GROUP BY ALL
UNION ALL SELECT 'service', service, CAST(sum(amount) AS DOUBLE) FROM cost GROUP BY ALL
UNION ALL SELECT 'total', 'all', CAST(sum(amount) AS DOUBLE) FROM cost""")
def _(spark, sf):
    out = a.cost_breakdown(v.cost_rows(spark, sf), ["provider", "region", "service"])
    return out.withColumn("amount", F.col("amount").cast("double"))


@query("agg_2_daily_totals", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) AS amount
FROM orders GROUP BY 1""")
def _(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    out = a.sums_by(table(spark, sf, "orders"), [day], amount=cents("o_totalprice"))
    return out.withColumn("amount", F.col("amount").cast("double"))


@query("agg_3_storage_by_priority", """
WITH f AS (SELECT CASE WHEN n_chars > 8000 THEN 0 WHEN n_chars > 4000 THEN 1 WHEN n_chars > 1000 THEN 2 ELSE 3 END AS priority,
  n_chars * 1000000 AS size_bytes FROM documents)
SELECT CAST(priority AS INT) AS priority, count(*) AS files, round(sum(size_bytes) / 1e9, 6) AS size_gb,
  round(sum(size_bytes) / 1e9 * 0.023, 2) AS monthly_cost FROM f GROUP BY 1""")
def _(spark, sf):
    n = F.col("n_chars")
    files = table(spark, sf, "documents").select(
        F.when(n > 8000, 0).when(n > 4000, 1).when(n > 1000, 2).otherwise(3).alias("priority"),
        (n * 1000000).alias("size_bytes"),
    )
    return a.storage_by_priority(files).withColumn("size_gb", r6("size_gb"))


@query("agg_4_version_inventory", f"""WITH {v.TELEMETRY}, {v.FLEET}
SELECT firmware_ver, schema_version, count(*) AS files, epoch_us(min(time_end)) AS first_seen,
  epoch_us(max(time_end)) AS last_seen FROM fleet GROUP BY ALL""")
def _(spark, sf):
    out = a.version_inventory(v.fleet(spark, sf), "time_end")
    return out.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("first_seen", "last_seen")})


@query("agg_5_flag_summary", f"""WITH {v.TELEMETRY}, {v.FLEET},
x AS (SELECT robot_id, unnest(anomaly_flags) AS flag, size_bytes, time_start FROM fleet)
SELECT robot_id, flag, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS bytes, epoch_us(max(time_start)) AS latest
FROM x GROUP BY ALL""")
def _(spark, sf):
    out = a.flag_summary(v.fleet(spark, sf))
    return out.withColumn("latest", F.unix_micros(F.col("latest").cast("timestamp")))


@query("agg_6_embedding_coverage", """
SELECT count(*) AS rows, count(embedding) AS embedded,
  round(avg(CASE WHEN embedding IS NULL THEN 0 ELSE 1 END) * 100, 6) AS coverage_pct
FROM documents LEFT JOIN embeddings ON vec_id = doc_id""")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    rows = table(spark, sf, "documents").select("doc_id").join(vectors, F.col("vec_id") == F.col("doc_id"), "left")
    return a.embedding_coverage(rows, "embedding").withColumn("coverage_pct", r6("coverage_pct"))


@query("agg_7_state_priority", f"""WITH {v.MANIFEST}
SELECT priority, count(*) FILTER (state = 'PENDING') AS "PENDING", count(*) FILTER (state = 'UPLOADING') AS "UPLOADING",
  count(*) FILTER (state = 'UPLOADED') AS "UPLOADED" FROM manifest GROUP BY 1""")
def _(spark, sf):
    return a.state_priority_counts(v.manifest(spark, sf), ["PENDING", "UPLOADING", "UPLOADED"])


@query("agg_8_daily_bytes", f"""WITH {v.TELEMETRY}, {v.FLEET}
SELECT robot_id, strftime(time_start, '%Y-%m-%d') AS day, CAST(sum(size_bytes) AS BIGINT) AS bytes_uploaded, count(*) AS file_count,
  CAST(sum(CASE WHEN priority = 0 THEN size_bytes ELSE 0 END) AS BIGINT) AS p0_bytes,
  CAST(sum(CASE WHEN priority = 1 THEN size_bytes ELSE 0 END) AS BIGINT) AS p1_bytes,
  CAST(sum(CASE WHEN priority = 2 THEN size_bytes ELSE 0 END) AS BIGINT) AS p2_bytes,
  CAST(sum(CASE WHEN priority = 3 THEN size_bytes ELSE 0 END) AS BIGINT) AS p3_bytes
FROM fleet GROUP BY 1, 2""")
def _(spark, sf):
    return a.daily_bytes(v.fleet(spark, sf), F.date_format("time_start", "yyyy-MM-dd"))


@query("agg_9_entity_registry", f"""WITH {v.TELEMETRY}, {v.FLEET}
SELECT robot_id, epoch_us(max(time_end)) AS last_seen, epoch_us(max(time_start)) AS last_upload, count(*) AS total_files,
  CAST(sum(size_bytes) AS BIGINT) AS total_bytes,
  CASE WHEN max(time_end) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOURS THEN 'stale' ELSE 'active' END AS status
FROM fleet GROUP BY 1""")
def _(spark, sf):
    out = a.entity_registry(v.fleet(spark, sf), "2024-01-31 00:00:00", 24)
    return out.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("last_seen", "last_upload")})


@query("agg_10_distribution", """
SELECT l_returnflag, count(*) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_pop(l_extendedprice), 4) AS std,
  min(l_extendedprice) AS min, max(l_extendedprice) AS max,
  round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
  round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90,
  round(quantile_cont(l_extendedprice, 0.95), 4) AS p95, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99,
  round(quantile_cont(l_extendedprice, 0.999), 4) AS p999
FROM lineitem GROUP BY 1""")
def _(spark, sf):
    out = a.distribution_summary(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return out.withColumns({c: r4(c) for c in ["mean", "std", *a.PERCENTILES]})


@query("agg_11_weighted_meter", """
SELECT l_returnflag, round(sum(l_discount * l_quantity), 4) AS total, round(sum(l_quantity), 4) AS n, min(l_discount) AS min, max(l_discount) AS max,
  arg_max(l_discount, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS last,
  round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS avg FROM lineitem GROUP BY 1""")
def _(spark, sf):
    step = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = a.weighted_meter(table(spark, sf, "lineitem"), ["l_returnflag"], "l_discount", "l_quantity", step)
    return out.withColumns({"total": r4("total"), "n": r4("n"), "avg": r6("avg")})


@query("agg_12_timing", """
SELECT event_type, round(avg(value), 6) AS mean, round(coalesce(stddev_samp(value), 0), 6) AS std, min(value) AS min,
  max(value) AS max, round(sum(value), 4) AS total, count(*) AS n FROM events GROUP BY 1""")
def _(spark, sf):
    out = a.timing_summary(table(spark, sf, "events"), "event_type", "value")
    return out.withColumns({"mean": r6("mean"), "std": r6("std"), "total": r4("total")})


@query("agg_13_throughput", f"""WITH {v.TELEMETRY}, {v.REQUESTS}
SELECT endpoint, count(*) AS requests, count(*) FILTER (success) AS succeeded,
  round(count(*) FILTER (success) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) AS qps,
  round(count(*) FILTER (success) / count(*), 6) AS success_rate,
  round(avg(latency) FILTER (success), 6) AS mean_latency,
  round(quantile_cont(latency, 0.5) FILTER (success), 6) AS p50, round(quantile_cont(latency, 0.95) FILTER (success), 6) AS p95,
  round(quantile_cont(latency, 0.99) FILTER (success), 6) AS p99 FROM requests GROUP BY 1""")
def _(spark, sf):
    out = a.throughput_summary(v.requests(spark, sf), ["endpoint"])
    return out.withColumns({c: r6(c) for c in ("qps", "success_rate", "mean_latency", "p50", "p95", "p99")})


@query("agg_14_request_stats", f"""WITH {v.TELEMETRY}, {v.REQUESTS}
SELECT variant, endpoint, count(*) AS request_count, count(*) FILTER (success) AS success_count,
  count(*) FILTER (NOT success) AS error_count, round(count(*) FILTER (success) / count(*), 6) AS success_rate,
  round(coalesce(avg(latency) FILTER (success), 0), 6) AS average_latency, round(coalesce(avg(feedback), 0), 6) AS average_feedback
FROM requests GROUP BY ALL""")
def _(spark, sf):
    out = a.request_stats(v.requests(spark, sf), ["variant", "endpoint"])
    return out.withColumns({c: r6(c) for c in ("success_rate", "average_latency", "average_feedback")})


CELLS = f"""WITH {v.SCORED}, cls AS (SELECT DISTINCT c FROM (SELECT truth3 AS c FROM scored UNION ALL SELECT predicted3 FROM scored)),
cells AS (SELECT t.c AS truth, p.c AS predicted, count(s.doc_id) AS n FROM cls t CROSS JOIN cls p
  LEFT JOIN scored s ON s.truth3 = t.c AND s.predicted3 = p.c GROUP BY 1, 2)"""


@query("agg_15_confusion_matrix", f"{CELLS} SELECT CAST(truth AS INT) AS truth, CAST(predicted AS INT) AS predicted, n FROM cells")
def _(spark, sf):
    return a.confusion_matrix(v.scored(spark, sf), "truth3", "predicted3")


@query("agg_16_classification_report", f"""{CELLS},
per AS (SELECT c AS label, (SELECT coalesce(sum(n), 0) FROM cells WHERE truth = c) AS support,
  (SELECT coalesce(sum(n), 0) FROM cells WHERE predicted = c) AS called,
  (SELECT coalesce(sum(n), 0) FROM cells WHERE truth = c AND predicted = c) AS hit FROM cls),
m AS (SELECT *, CASE WHEN called = 0 THEN 0 ELSE hit / called END AS p, CASE WHEN support = 0 THEN 0 ELSE hit / support END AS r FROM per),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM m)
SELECT CAST(label AS VARCHAR) AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'macro', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM f""")
def _(spark, sf):
    out = a.classification_report(a.confusion_matrix(v.scored(spark, sf), "truth3", "predicted3"))
    return out.withColumns({c: r6(c) for c in ("precision", "recall", "f1")})


@query("agg_17_roc_auc", f"""WITH {v.SCORED},
r AS (SELECT truth, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM scored)
SELECT count(*) FILTER (truth = 1) AS positives, count(*) FILTER (truth <> 1) AS negatives,
  round((sum(rk) FILTER (truth = 1) - count(*) FILTER (truth = 1) * (count(*) FILTER (truth = 1) + 1) / 2.0)
    / (count(*) FILTER (truth = 1) * count(*) FILTER (truth <> 1)), 6) AS auc FROM r""")
def _(spark, sf):
    return a.roc_auc(v.scored(spark, sf), "score", "truth").withColumn("auc", r6("auc"))


@query("agg_18_roc_curve", f"""WITH {v.SCORED},
c AS (SELECT score, count(*) FILTER (truth = 1) AS p, count(*) FILTER (truth <> 1) AS n FROM scored GROUP BY 1)
SELECT round(score, 6) AS threshold, round(sum(n) OVER (ORDER BY score DESC) / sum(n) OVER (), 6) AS fpr,
  round(sum(p) OVER (ORDER BY score DESC) / sum(p) OVER (), 6) AS tpr FROM c""")
def _(spark, sf):
    out = a.roc_curve(v.scored(spark, sf), "score", "truth")
    return out.withColumns({c: r6(c) for c in out.columns})


@query("agg_19_value_distribution", """
SELECT o_orderpriority AS value, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY 1""")
def _(spark, sf):
    return a.value_distribution(table(spark, sf, "orders"), "o_orderpriority").withColumn("share", r6("share"))


LABELLED = """labelled AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, quality, toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
LABELLED_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


def labelled(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left").select(*LABELLED_COLUMNS)


@query("agg_20_null_counts", f"""WITH {LABELLED},
c AS (SELECT unnest(['doc_id', 'lang', 'source', 'n_chars', 'quality', 'toxic']) AS col,
  unnest([count(*) - count(doc_id), count(*) - count(lang), count(*) - count(source), count(*) - count(n_chars),
   count(*) - count(quality), count(*) - count(toxic)]) AS nulls, count(*) AS n FROM labelled),
s AS (SELECT *, sum(nulls) OVER () / (n * 6) AS share FROM c)
SELECT col AS "column", nulls, round(share, 6) AS null_share,
  CASE WHEN share > 0.1 THEN 'error' WHEN share > 0.05 THEN 'warning' ELSE 'ok' END AS level FROM s WHERE nulls > 0""")
def _(spark, sf):
    return a.null_counts(labelled(spark, sf), LABELLED_COLUMNS).withColumn("null_share", r6("null_share"))


@query("agg_21_duplicate_rows", """
WITH g AS (SELECT lang, source, text, count(*) AS n FROM documents GROUP BY ALL),
t AS (SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicates FROM g)
SELECT rows, duplicates, round(duplicates / rows, 6) AS share,
  CASE WHEN duplicates / rows > 0.05 THEN 'error' WHEN duplicates > 0 THEN 'warning' ELSE 'ok' END AS level FROM t""")
def _(spark, sf):
    out = a.duplicate_rows(table(spark, sf, "documents"), ["lang", "source", "text"])
    return out.withColumn("share", r6("share"))


@query("agg_22_range_checks", """
WITH m AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, min(l_extendedprice) AS price,
  bool_and(l_linestatus IN ('O', 'F')) AS ok FROM lineitem)
SELECT 'quantity_range' AS rule, 'warning' AS level, lo < 0 OR hi > 45 AS broken FROM m
UNION ALL SELECT 'negative_price', 'error', price < 0 FROM m
UNION ALL SELECT 'status_values', 'error', NOT ok FROM m""")
def _(spark, sf):
    rules = {
        "quantity_range": ((F.min("l_quantity") < 0) | (F.max("l_quantity") > 45), "warning"),
        "negative_price": (F.min("l_extendedprice") < 0, "error"),
        "status_values": (~F.bool_and(F.col("l_linestatus").isin("O", "F")), "error"),
    }
    return a.range_checks(table(spark, sf, "lineitem"), rules)


@query("agg_23_class_balance", """
WITH s AS (SELECT quality, count(*) / sum(count(*)) OVER () AS share FROM labels GROUP BY 1)
SELECT count(*) AS classes, round(min(share), 6) AS smallest_share,
  CASE WHEN count(*) < 2 THEN 'error' WHEN min(share) < 0.05 THEN 'severe' WHEN min(share) < 0.2 THEN 'warning' ELSE 'ok' END AS level FROM s""")
def _(spark, sf):
    out = a.class_balance(table(spark, sf, "labels"), "quality")
    return out.withColumn("smallest_share", r6("smallest_share"))


@query("agg_24_quality_score", f"""WITH {LABELLED},
g AS (SELECT count(*) AS n, (CASE WHEN quality IS NULL THEN 1 ELSE 0 END) + (CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) AS nulls
  FROM labelled GROUP BY doc_id, lang, source, n_chars, quality, toxic),
t AS (SELECT sum(n) AS rows, count(*) AS d, sum(nulls * n) AS nulls FROM g),
s AS (SELECT rows, 1 - nulls / (rows * 6) AS c, d / rows AS u FROM t)
SELECT CAST(rows AS BIGINT) AS rows, round(c, 6) AS completeness, round(u, 6) AS uniqueness,
  round(0.4 * c + 0.3 * u + 0.3, 3) AS score, c >= 0.9 AND u >= 0.95 AND 0.4 * c + 0.3 * u + 0.3 >= 0.7 AS valid FROM s""")
def _(spark, sf):
    out = a.quality_score(labelled(spark, sf), LABELLED_COLUMNS, True)
    return out.withColumns({"completeness": r6("completeness"), "uniqueness": r6("uniqueness")})


@query("agg_25_schema_report", """
WITH s AS (SELECT count(TRY_CAST(p_partkey AS DOUBLE)) / count(*) AS k, count(TRY_CAST(p_name AS DOUBLE)) / count(*) AS n,
  count(TRY_CAST(p_size AS DOUBLE)) / count(*) AS z, count(TRY_CAST(p_brand AS DOUBLE)) / count(*) AS b FROM part)
SELECT 'p_partkey' AS "column", 'numeric' AS expected, 'numeric' AS found, round(k, 6) AS numeric_share, 'ok' AS level FROM s
UNION ALL SELECT 'p_name', 'numeric', 'categorical', round(n, 6), 'warning' FROM s
UNION ALL SELECT 'p_size', 'numeric', 'numeric', round(z, 6), 'ok' FROM s
UNION ALL SELECT 'p_brand', 'categorical', 'categorical', round(b, 6), 'ok' FROM s
UNION ALL SELECT 'p_weight', 'numeric', 'missing', NULL, 'error' FROM s""")
def _(spark, sf):
    expected = {"p_partkey": "numeric", "p_name": "numeric", "p_size": "numeric", "p_brand": "categorical", "p_weight": "numeric"}
    out = a.schema_report(table(spark, sf, "part"), expected)
    return out.withColumn("numeric_share", r6("numeric_share"))


COST_COLUMNS = """round(sum(gpu_cost), 6) AS gpu_cost, round(sum(vector_cost), 6) AS vector_cost,
  round(sum(network_cost), 6) AS network_cost, round(sum(token_cost), 6) AS token_cost,
  round(sum(gpu_cost + vector_cost + network_cost + token_cost), 6) AS total_cost, count(*) AS num_requests,
  CAST(sum(tokens) AS BIGINT) AS total_tokens,
  round(sum(gpu_cost + vector_cost + network_cost + token_cost) / count(*), 6) AS cost_per_request,
  round(sum(gpu_cost + vector_cost + network_cost + token_cost) / sum(tokens) * 1000, 6) AS cost_per_1k_tokens,
  epoch_us(min(ts)) AS start_time, epoch_us(max(ts)) AS end_time"""


def cost_columns(df):
    money = ["gpu_cost", "vector_cost", "network_cost", "token_cost", "total_cost", "cost_per_request", "cost_per_1k_tokens"]
    times = {c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("start_time", "end_time")}
    return df.withColumns({**{c: r6(c) for c in money}, **times})


@query("agg_26_request_cost", f"WITH {v.TELEMETRY}, {v.USAGE} SELECT {COST_COLUMNS} FROM usage")
def _(spark, sf):
    return cost_columns(a.request_cost(v.usage(spark, sf), []))


@query("agg_27_hourly_cost", f"""WITH {v.TELEMETRY}, {v.USAGE}
SELECT strftime(ts, '%Y-%m-%d %H') AS period, {COST_COLUMNS} FROM usage GROUP BY 1
UNION ALL SELECT strftime(ts, '%Y-%m-%d') AS period, {COST_COLUMNS} FROM usage GROUP BY 1""")
def _(spark, sf):
    use = v.usage(spark, sf)
    hour = a.request_cost(use, [F.date_format("ts", "yyyy-MM-dd HH").alias("period")])
    day = a.request_cost(use, [F.date_format("ts", "yyyy-MM-dd").alias("period")])
    return cost_columns(hour.unionByName(day))


@query("agg_28_monthly_estimate", f"""WITH {v.TELEMETRY}, {v.USAGE},
d AS (SELECT CAST(ts AS DATE) AS day, sum(gpu_cost + vector_cost + network_cost + token_cost) AS cost FROM usage
  WHERE CAST(ts AS DATE) > DATE '2024-01-30' - 7 AND CAST(ts AS DATE) <= DATE '2024-01-30' GROUP BY 1)
SELECT count(*) AS days, round(coalesce(avg(cost), 0) * 30 + 100 * 0.1, 6) AS monthly_cost FROM d""")
def _(spark, sf):
    return a.monthly_estimate(v.usage(spark, sf), "2024-01-30").withColumn("monthly_cost", r6("monthly_cost"))


@query("agg_29_cost_shares", f"""WITH {v.COST}
SELECT service, CAST(sum(amount) AS DOUBLE) AS amount,
  round(CAST(sum(amount) AS DOUBLE) / CAST(sum(sum(amount)) OVER () AS DOUBLE) * 100, 6) AS percentage FROM cost GROUP BY 1""")
def _(spark, sf):
    out = a.cost_shares(v.cost_rows(spark, sf), "service", "amount")
    return out.select("service", F.col("amount").cast("double").alias("amount"), r6("percentage").alias("percentage"))


@query("agg_30_token_prices", """
WITH t AS (SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 'large' WHEN conv_id % 3 = 1 THEN 'small' ELSE 'self-hosted' END AS model,
  sum(CASE WHEN role <> 'assistant' THEN len(string_split(text, ' ')) ELSE 0 END) AS pt,
  sum(CASE WHEN role = 'assistant' THEN len(string_split(text, ' ')) ELSE 0 END) AS ct, count(*) / 60.0 AS gh FROM conversations GROUP BY ALL),
p AS (SELECT * FROM (VALUES ('large', 0.03, 0.06, 0.0), ('small', 0.0015, 0.002, 0.0), ('self-hosted', 0.0, 0.0, 1.0)) AS x(model, pp, cp, hp)),
s AS (SELECT model, count(*) AS requests, sum(pt) / 1000 * any_value(CAST(pp AS DOUBLE)) AS prompt_cost, sum(ct) / 1000 * any_value(CAST(cp AS DOUBLE)) AS completion_cost,
  sum(gh) * any_value(CAST(hp AS DOUBLE)) AS gpu_cost FROM t JOIN p USING (model) GROUP BY 1)
SELECT model, requests, round(prompt_cost, 6) AS prompt_cost, round(completion_cost, 6) AS completion_cost,
  round(CAST(gpu_cost AS DOUBLE), 6) AS gpu_cost, round(prompt_cost + completion_cost + gpu_cost, 6) AS total_cost,
  round((prompt_cost + completion_cost + gpu_cost) / requests, 6) AS cost_per_request FROM s""")
def _(spark, sf):
    words = F.size(F.split("text", " "))
    said = F.col("role") == "assistant"
    model = F.when(F.col("conv_id") % 3 == 0, "large").when(F.col("conv_id") % 3 == 1, "small").otherwise("self-hosted")
    use = (
        table(spark, sf, "conversations")
        .groupBy("conv_id", model.alias("model"))
        .agg(
            F.sum(F.when(~said, words).otherwise(0)).alias("prompt_tokens"),
            F.sum(F.when(said, words).otherwise(0)).alias("completion_tokens"),
            (F.count(F.lit(1)) / 60.0).alias("gpu_hours"),
        )
    )
    # fixed values: prices per 1000 prompt tokens, per 1000 completion tokens, per gpu hour
    prices = spark.createDataFrame(
        [("large", 0.03, 0.06, 0.0), ("small", 0.0015, 0.002, 0.0), ("self-hosted", 0.0, 0.0, 1.0)],
        "model string, prompt_price double, completion_price double, hour_price double",
    )
    out = a.token_price_estimate(use, prices)
    return out.withColumns({c: r6(c) for c in out.columns if c.endswith("cost") or c == "cost_per_request"})


@query("agg_31_global_metrics", f"""WITH {v.TELEMETRY}, {v.REQUESTS},
r AS (SELECT region, count(*) / 86400.0 AS rate, count(*) FILTER (NOT success) / count(*) AS err,
  quantile_cont(latency, 0.99) AS p99 FROM requests GROUP BY 1)
SELECT round(sum(CAST(rate AS DOUBLE)), 6) AS request_rate, round(avg(err), 6) AS error_rate, round(avg(p99), 6) AS p99 FROM r""")
def _(spark, sf):
    from millrace.plans.quantiles import exact_quantiles

    req = v.requests(spark, sf)
    rates = req.groupBy("region").agg(
        (F.count(F.lit(1)) / 86400.0).alias("request_rate"),
        (F.count_if(~F.col("success")) / F.count(F.lit(1))).alias("error_rate"),
    )
    out = a.global_metrics(rates.join(exact_quantiles(req, ["region"], "latency", {"p99": 0.99}), "region"))
    return out.select(*[r6(c).alias(c) for c in out.columns])


@query("agg_32_recovery_stats", """
WITH r AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'in_progress' ELSE 'failed' END AS status,
  o_orderpriority IN ('1-URGENT', '2-HIGH') AS auto FROM orders)
SELECT count(*) AS total, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'failed') AS failed,
  count(*) FILTER (status = 'in_progress') AS in_progress, count(*) FILTER (auto) AS automated,
  round(count(*) FILTER (status = 'completed') / count(*) * 100, 6) AS success_rate FROM r""")
def _(spark, sf):
    s = F.col("o_orderstatus")
    runs = table(spark, sf, "orders").select(
        F.when(s == "F", "completed").when(s == "O", "in_progress").otherwise("failed").alias("status"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("auto"),
    )
    return a.recovery_stats(runs, "status", "auto").withColumn("success_rate", r6("success_rate"))


@query("agg_33_worst_status", f"""WITH {v.TELEMETRY},
c AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_type = 'error' AND value > 80 THEN 'unhealthy' WHEN event_type = 'error' THEN 'degraded'
  WHEN event_type = 'view' THEN 'unknown' ELSE 'healthy' END AS status FROM telemetry)
SELECT user_id, day, CASE WHEN bool_or(status = 'unhealthy') THEN 'unhealthy' WHEN bool_or(status = 'degraded') THEN 'degraded'
  WHEN bool_or(status = 'unknown') THEN 'unknown' ELSE 'healthy' END AS overall,
  count(*) FILTER (status = 'healthy') AS healthy, count(*) FILTER (status = 'unknown') AS unknown,
  count(*) FILTER (status = 'degraded') AS degraded, count(*) FILTER (status = 'unhealthy') AS unhealthy FROM c GROUP BY 1, 2""")
def _(spark, sf):
    e = F.col("event_type")
    status = (
        F.when((e == "error") & (F.col("value") > 80), "unhealthy").when(e == "error", "degraded")
        .when(e == "view", "unknown").otherwise("healthy")
    )
    checks = v.telemetry(spark, sf).select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), status.alias("status"))
    return a.worst_status(checks, ["user_id", "day"])


@query("agg_35_dataset_checksum", """
WITH f AS (SELECT source, source || '/' || doc_id AS path, n_chars, sha256(text) AS h FROM documents)
SELECT source AS dataset, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS bytes, sha256(string_agg(h, '' ORDER BY path)) AS checksum
FROM f GROUP BY 1""")
def _(spark, sf):
    files = table(spark, sf, "documents").select(
        F.col("source").alias("dataset"), F.concat_ws("/", "source", "doc_id").alias("path"),
        F.sha2("text", 256).alias("digest"), F.col("n_chars").alias("size"),
    )
    return a.dataset_checksum(files, "dataset", "path", "digest", "size")


@query("agg_37_distinct_classes", """
SELECT count(*) AS rows, count(DISTINCT p_brand) AS classes, count(DISTINCT p_brand) >= 2 AND count(*) >= 100 AS passes FROM part""")
def _(spark, sf):
    return a.distinct_classes(table(spark, sf, "part"), "p_brand")


@query("agg_39_collection_sizes", """
SELECT label, count(*) AS vectors FROM embeddings GROUP BY ROLLUP (label)""")
def _(spark, sf):
    return a.collection_sizes(table(spark, sf, "embeddings"), "label")
