"""Sink and merge queries."""

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.registry import query, r6, table
from millrace.session import new_path
from millrace.sources import sinks as k


@query("snk_1_raw_csv", """
SELECT count(*) AS record_count, CAST(6 AS INT) AS column_count, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns,
  '2024-01-31' AS saved_at, true AS has_size FROM orders""")
def _(spark, sf):
    path = new_path(spark, "raw")
    k.save_raw(table(spark, sf, "orders"), path, "2024-01-31")
    return k.read_sidecar(spark, path).select(
        "record_count", "column_count", F.array_join("columns", ",").alias("columns"), "saved_at", (F.col("file_size_bytes") > 0).alias("has_size")
    )


SPLIT = """r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey || '-42'), c_custkey) AS rk, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer),
s AS (SELECT c_custkey, c_mktsegment, CASE WHEN rk <= ceil(n * CAST(0.2 AS DOUBLE)) THEN 'test' WHEN rk <= ceil(n * CAST(0.2 AS DOUBLE)) + ceil((n - ceil(n * CAST(0.2 AS DOUBLE))) * 0.125) THEN 'val' ELSE 'train' END AS split FROM r)"""


def customer_split(spark, sf):
    from millrace.operators.features import stratified_split

    return stratified_split(table(spark, sf, "customer"), "c_custkey", "c_mktsegment")


@query("snk_3_split_sink", f"WITH {SPLIT} SELECT split, count(*) AS record_count, CAST(2 AS INT) AS columns FROM s GROUP BY 1")
def _(spark, sf):
    return k.save_splits(customer_split(spark, sf), new_path(spark, "splits"))


@query("snk_4_upsert", """
WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0),
u AS (SELECT o_orderkey, o_custkey + 1 AS o_custkey, 'X' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(t.o_orderkey, u.o_orderkey) AS o_orderkey, coalesce(t.o_custkey, u.o_custkey) AS o_custkey, coalesce(u.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
  coalesce(t.o_totalprice, u.o_totalprice) AS o_totalprice FROM t FULL JOIN u ON t.o_orderkey = u.o_orderkey""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    updates = orders.where("o_orderkey % 2 = 0").withColumns({"o_custkey": F.col("o_custkey") + 1, "o_orderstatus": F.lit("X")})
    return k.upsert(orders.where("o_orderkey % 3 <> 0"), updates, "o_orderkey", ["o_orderstatus"])


@query("snk_5_insert_or_ignore", """
WITH t AS (SELECT DISTINCT md5(text) AS h FROM documents WHERE doc_id % 4 = 0), b AS (SELECT doc_id, md5(text) AS h FROM documents WHERE doc_id % 4 <> 0)
SELECT min(doc_id) AS doc_id, h FROM b WHERE h NOT IN (SELECT h FROM t) GROUP BY h""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"))
    return k.insert_or_ignore(docs.where("doc_id % 4 = 0"), docs.where("doc_id % 4 <> 0"), ["h"], "doc_id")


@query("snk_6_counter_upsert", f"""WITH {v.TELEMETRY}
SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(sum(CAST(round(value * 1000) AS BIGINT)) AS BIGINT) AS bytes_sent,
  CAST(sum(CASE WHEN k % 4 = 0 THEN CAST(round(value * 1000) AS BIGINT) ELSE 0 END) AS BIGINT) AS p0_bytes FROM telemetry GROUP BY 1""")
def _(spark, sf):
    size = F.round(F.col("value") * 1000).cast("bigint")
    rows = v.telemetry(spark, sf).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), size.alias("bytes_sent"),
        F.when(F.col("k") % 4 == 0, size).otherwise(0).alias("p0_bytes"),
    )
    per_day = lambda df: df.groupBy("day").agg(F.sum("bytes_sent").alias("bytes_sent"), F.sum("p0_bytes").alias("p0_bytes"))
    old, delta = per_day(rows.where("event_id % 3 <> 0")), per_day(rows.where("event_id % 3 = 0"))
    return k.add_counters(old, delta, ["day"], ["bytes_sent", "p0_bytes"])


@query("snk_7_update_vectors", """
SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN 'updated ' || label ELSE 'old' END AS description,
  md5('[' || array_to_string(list_transform(CASE WHEN vec_id % 5 = 0 THEN list_reverse(embedding) ELSE embedding END, lambda x: printf('%.8f', CAST(x AS DOUBLE))), ',') || ']') AS vector FROM embeddings""")
def _(spark, sf):
    rows = table(spark, sf, "embeddings")
    target = rows.select("vec_id", F.lit("old").alias("description"), "embedding")
    updates = rows.where("vec_id % 5 = 0").select(
        "vec_id", F.concat(F.lit("updated "), "label").alias("description"), F.reverse("embedding").alias("embedding")
    )
    out = k.update_vectors(target, updates, "vec_id", ["description", "embedding"])
    return out.select("vec_id", "description", F.md5(k.vector_text(F.col("embedding"))).alias("vector"))


@query("snk_8_vector_store", """
WITH t AS (SELECT vec_id, label, embedding[1] AS first FROM embeddings WHERE vec_id % 3 <> 0),
u AS (SELECT vec_id, label + 100 AS label, embedding[2] AS first FROM embeddings WHERE vec_id % 2 = 0),
m AS (SELECT coalesce(u.vec_id, t.vec_id) AS vec_id, coalesce(u.label, t.label) AS label, coalesce(u.first, t.first) AS first FROM t FULL JOIN u ON t.vec_id = u.vec_id)
SELECT vec_id, CAST(label AS INT) AS label, round(CAST(first AS DOUBLE), 6) AS first FROM m WHERE vec_id % 7 <> 0""")
def _(spark, sf):
    rows = table(spark, sf, "embeddings")
    at = lambda i: F.get("embedding", F.lit(i))
    target = rows.where("vec_id % 3 <> 0").select("vec_id", "label", at(0).alias("first"))
    updates = rows.where("vec_id % 2 = 0").select("vec_id", (F.col("label") + 100).alias("label"), at(1).alias("first"))
    merged = k.upsert(target, updates, "vec_id", ["label", "first"])
    return k.delete_keys(merged, rows.where("vec_id % 7 = 0"), "vec_id").withColumn("first", r6("first"))


@query("snk_8_scalar_metadata", r"""
SELECT event_id, 'k=' || regexp_extract(props, '(\d+)', 1) || ',tags=["a"]' AS kept FROM events""")
def _(spark, sf):
    record = F.concat(F.lit('{"tags": ["a"], "nested": {"x": 1}, "none": null, '), F.expr("substring(props, 2)"))
    kept = F.array_sort(F.map_entries(k.scalar_metadata(record)))
    return table(spark, sf, "events").select(
        "event_id", F.array_join(F.transform(kept, lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("kept")
    )


@query("snk_9_daily_log", "SELECT strftime(ts, '%Y.%m.%d') AS day, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    path = new_path(spark, "daily")
    k.write_daily(table(spark, sf, "events"), "ts", path, "event_id")
    stored = spark.read.schema("event_id bigint, day string").parquet(path)
    return stored.groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("snk_10_metric_jsonl", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def _(spark, sf):
    path = new_path(spark, "jsonl")
    rows = table(spark, sf, "events").select("event_type", F.create_map(F.lit("value"), F.col("value")).alias("values"), F.col("event_id").alias("step"))
    k.append_metrics(rows.where("event_id % 2 = 0"), path)
    k.append_metrics(rows.where("event_id % 2 = 1"), path)
    back = spark.read.schema("event_type string, values map<string,double>, step bigint").json(path)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("values")["value"]), 4).alias("total"))


@query("snk_11_report_csv", f"""WITH {v.COST}
SELECT provider, CAST(sum(amount) AS DOUBLE) AS amount FROM cost GROUP BY 1 UNION ALL SELECT 'Total', CAST(sum(amount) AS DOUBLE) FROM cost""")
def _(spark, sf):
    return k.report_rows(v.cost_rows(spark, sf)).withColumn("amount", F.col("amount").cast("double"))


@query("snk_11_report_json")
def _(spark, sf):
    limits = {"O": (40.0, "Provider", 2), "F": (40.0, "Provider", 1)}
    return k.report_document(v.cost_rows(spark, sf), "1995-01-01", "2001-12-31", limits)


STATES = """log AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'click' THEN 'UPLOADING' WHEN 'view' THEN 'VERIFYING' WHEN 'purchase' THEN 'UPLOADED' ELSE 'ERROR' END AS state FROM events)"""


def state_log(spark, sf):
    e = F.col("event_type")
    state = F.when(e == "signup", "PENDING").when(e == "click", "UPLOADING").when(e == "view", "VERIFYING").when(e == "purchase", "UPLOADED").otherwise("ERROR")
    return table(spark, sf, "events").select("event_id", "user_id", "ts", state.alias("state"))


@query("snk_12_transitions", f"""WITH {STATES}, l AS (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old_state FROM log)
SELECT event_id, old_state, state, old_state IS NULL OR old_state || '>' || state IN ('PENDING>UPLOADING', 'UPLOADING>VERIFYING', 'UPLOADING>PENDING', 'UPLOADING>ERROR',
  'VERIFYING>UPLOADED', 'VERIFYING>ERROR', 'ERROR>PENDING') AS valid FROM l""")
def _(spark, sf):
    return k.audit_transitions(state_log(spark, sf), "user_id", ["ts", "event_id"]).select("event_id", "old_state", "state", "valid")


@query("snk_12_current_state", f"""WITH {STATES}
SELECT user_id, arg_max(state, (ts, event_id)) AS state, epoch_us(max(ts) FILTER (state = 'UPLOADED')) AS uploaded_at FROM log GROUP BY 1""")
def _(spark, sf):
    out = k.current_state(state_log(spark, sf), "user_id", ["ts", "event_id"], "ts")
    return out.select("user_id", "state", F.unix_micros(F.col("uploaded_at").cast("timestamp")).alias("uploaded_at"))
