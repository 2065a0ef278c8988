"""Window, ordering and set queries."""

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.functions import folded
from millrace.catalog.registry import query, r4, r6, table, texts
from millrace.operators import sets as s
from millrace.operators import topk as k
from millrace.operators import windows as w

ZSCORE = """z AS (SELECT *, CASE WHEN n >= 30 THEN abs(value - m) / (coalesce(sd, 0) + 1e-9) ELSE 0 END AS z FROM (
  SELECT event_id, user_id, ts, value, avg(value) OVER f AS m, stddev_samp(value) OVER f AS sd, count(*) OVER f AS n FROM events
  WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 299 PRECEDING AND CURRENT ROW)) q)"""


@query("win_1_rolling_zscore", f"WITH {ZSCORE} SELECT event_id, round(z, 6) AS z, z > 3 AS is_anomaly FROM z")
def _(spark, sf):
    out = w.rolling_zscore(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], "value")
    return out.select("event_id", r6("z").alias("z"), "is_anomaly")


@query("win_2_channel_events", """
WITH l AS (UNPIVOT (SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice / 1000 AS price, l_discount * l_discount * l_discount AS cubed FROM lineitem)
  ON l_quantity, price, cubed INTO NAME channel VALUE value),
q AS (SELECT *, avg(value) OVER f AS m, stddev_samp(value) OVER f AS sd, count(*) OVER f AS n FROM l
  WINDOW f AS (PARTITION BY l_suppkey, channel ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey ROWS BETWEEN 299 PRECEDING AND CURRENT ROW)),
z AS (SELECT *, abs(value - m) / (sd + 1e-9) AS z FROM q WHERE n >= 30)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, channel, round(z, 6) AS z, round(least(100, 50 + 10 * z), 6) AS score,
  CAST(CASE WHEN least(100, 50 + 10 * z) < 80 THEN 1 ELSE 0 END AS INT) AS priority FROM z WHERE z > 2.4""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        (F.col("l_extendedprice") / 1000).alias("price"), (F.col("l_discount") * F.col("l_discount") * F.col("l_discount")).alias("cubed"),
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
    out = w.channel_events(rows, "l_suppkey", order, ["l_quantity", "price", "cubed"], limit=2.4)
    return out.select("l_suppkey", *order[1:], "channel", r6("z").alias("z"), r6("score").alias("score"), "priority")


@query("win_3_group_outliers", f"""WITH {v.COST},
p AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, power(CAST(amount AS DOUBLE) / 30000, 4) AS load FROM cost),
g AS (SELECT l_suppkey, avg(load) AS m, stddev_pop(load) AS sd FROM p GROUP BY 1 HAVING count(*) >= 3)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, round(load, 6) AS load, round(m, 4) AS average, round(sd, 4) AS std_dev,
  CASE WHEN abs(load - m) > 3 * sd THEN 'high' ELSE 'medium' END AS severity FROM p JOIN g USING (l_suppkey) WHERE abs(load - m) > 2 * sd""")
def _(spark, sf):
    rows = v.cost_rows(spark, sf).select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.pow(F.col("amount").cast("double") / 30000, 4).alias("load")
    )
    return w.group_outliers(rows, "l_suppkey", "load").withColumns(
        {"load": r6("load"), "average": r4("average"), "std_dev": r4("std_dev")}
    )


@query("win_4_trend", """
WITH d AS (SELECT o_orderdate AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(38,6))) AS DOUBLE) AS cost, row_number() OVER (ORDER BY o_orderdate DESC) AS rn FROM orders GROUP BY 1),
o AS (SELECT max(cost) FILTER (rn = 1) AS l, max(cost) FILTER (rn = 7) AS f, sum(cost) FILTER (rn <= 7) AS w, sum(cost) FILTER (rn BETWEEN 8 AND 14) AS p FROM d)
SELECT round((l - f) / f * 100, 6) AS daily_change, round((w - p) / p * 100, 6) AS weekly_change FROM o""")
def _(spark, sf):
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(38,6)")).cast("double").alias("cost")
    )
    return w.trend(daily, "day", "cost").select(r6("daily_change").alias("daily_change"), r6("weekly_change").alias("weekly_change"))


@query("win_5_sequence_gaps", """
WITH q AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq FROM events),
g AS (SELECT user_id, seq, lag(seq) OVER (PARTITION BY user_id ORDER BY seq) AS p FROM q WHERE event_id % 10 <> 0)
SELECT user_id, p + 1 AS expected_seq, seq AS found_seq FROM g WHERE seq <> p + 1""")
def _(spark, sf):
    from millrace.plans.ordered import Ordered

    numbered = Ordered(table(spark, sf, "events").select("user_id", "event_id"), ["user_id"], ["event_id"]).running(seq=("count", F.lit(1)))
    return w.sequence_gaps(numbered.where("event_id % 10 <> 0"), "user_id", "seq")


@query("win_6_version_changes", f"""WITH {v.TELEMETRY},
g AS (SELECT user_id, event_id, 'v' || (k // 34) AS ver, lag('v' || (k // 34)) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM telemetry)
SELECT user_id, event_id, p AS old_version, ver AS new_version FROM g WHERE p <> ver""")
def _(spark, sf):
    rows = v.telemetry(spark, sf).select("user_id", "event_id", F.concat(F.lit("v"), F.floor(F.col("k") / 34)).alias("ver"))
    return w.version_changes(rows, "user_id", ["event_id"], "ver")


@query("win_7_last_n_stats", """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.5), 6) AS median,
  round(quantile_cont(value, 0.99), 6) AS p99 FROM r WHERE rn <= 1000 GROUP BY 1""")
def _(spark, sf):
    last = w.newest(table(spark, sf, "events"), "event_type", ["ts", "event_id"], 1000)
    # at most a thousand rows per group are left
    return last.groupBy("event_type").agg(
        F.count("value").alias("n"), r6(F.avg("value")).alias("mean"), r6(F.stddev_pop("value")).alias("std"),
        r6(F.percentile("value", F.lit(0.5))).alias("median"), r6(F.percentile("value", F.lit(0.99))).alias("p99"),
    )


@query("win_8_latest", """
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus FROM orders GROUP BY 1""")
def _(spark, sf):
    return w.latest(table(spark, sf, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus"])


@query("win_9_retention", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey DESC) AS b FROM orders)
SELECT o_orderkey, o_custkey, rn <= 3 OR b = 1 AS keep FROM r""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return w.retention(rows, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 3).select("o_orderkey", "o_custkey", "keep")


@query("win_10_eviction", """
WITH f AS (SELECT doc_id, n_chars AS size, doc_id % 4 AS p, doc_id % 23 = 0 AS expired, 1700000000 - doc_id * 7 % 1000 AS made FROM documents),
t AS (SELECT sum(size) AS used, sum(size) / 0.9 AS quota FROM f),
c AS (SELECT *, sum(size) OVER (ORDER BY CASE WHEN expired THEN 0 ELSE 1 END, CASE WHEN expired THEN 0 ELSE -p END, made, doc_id) AS freed FROM f WHERE expired OR p >= 1)
SELECT doc_id AS file_id, CAST(freed AS BIGINT) AS freed, CASE WHEN expired THEN 'expired' ELSE 'evicted' END AS reason FROM c, t WHERE used - (freed - size) >= 0.6 * quota""")
def _(spark, sf):
    d = F.col("doc_id")
    files = table(spark, sf, "documents").select(
        d.alias("file_id"), F.col("n_chars").alias("size"), (d % 4).alias("priority"), (d % 23 == 0).alias("expired"),
        (F.lit(1700000000) - d * 7 % 1000).alias("created_at"),
    )
    quota = files.agg(F.sum("size") / 0.9).scalar()
    return w.eviction(files, quota)


STREAKS = """g AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM (SELECT event_id, user_id, ts, event_type NOT IN ('error', 'view', 'click') AS ok, value FROM events) e),
streaks AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS streak FROM g)"""


@query("win_11_failure_streaks", f"WITH {STREAKS} SELECT event_id, CAST(streak AS BIGINT) AS streak, streak >= 3 AS unhealthy FROM streaks")
def _(spark, sf):
    checks = table(spark, sf, "events").withColumn("ok", ~F.col("event_type").isin("error", "view", "click"))
    return w.failure_streaks(checks, "user_id", ["ts", "event_id"], "ok").select("event_id", "streak", "unhealthy")


@query("win_12_neighbour_context", r"""
WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents),
x AS (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM s)
SELECT doc_id, CAST(i - 1 AS INT) AS position, md5(array_to_string(s[greatest(i - 1, 1):i + 1], ' ')) AS digest FROM x""")
def _(spark, sf):
    out = w.neighbour_context(texts(spark, sf), "doc_id", F.split("text", r"(?<=[.!?])\s+"))
    return out.select("doc_id", "position", F.md5("context").alias("digest"))


@query("win_14_variants", f"""
WITH b AS (SELECT DISTINCT user_id, {folded("md5(CAST(user_id AS VARCHAR))", 10000)} / 100 AS bucket FROM events)
SELECT user_id, round(bucket, 6) AS bucket, CASE WHEN bucket <= 50 THEN 'control' WHEN bucket <= 80 THEN 'a' ELSE 'b' END AS variant FROM b""")
def _(spark, sf):
    users = table(spark, sf, "events").select("user_id").distinct()
    out = w.assign_variant(users, F.col("user_id"), [("control", 50.0), ("a", 30.0), ("b", 20.0)])
    return out.withColumn("bucket", r6("bucket"))


@query("win_15_ranking", """
WITH m AS (SELECT p_brand AS model, round(avg(p_retailprice), 6) AS f1 FROM part GROUP BY 1)
SELECT model, f1, row_number() OVER (ORDER BY f1 DESC, model) AS rank FROM m""")
def _(spark, sf):
    per = table(spark, sf, "part").groupBy(F.col("p_brand").alias("model")).agg(r6(F.avg("p_retailprice")).alias("f1"))
    return w.ranking(per, "f1", "model")


@query("win_16_throughput", f"""WITH {v.TELEMETRY},
r AS (SELECT *, epoch_us(ts) AS us, k / ((epoch_us(ts) - lag(epoch_us(ts)) OVER o) / 1e6) AS rate FROM telemetry WINDOW o AS (PARTITION BY user_id ORDER BY event_id)),
x AS (SELECT *, avg(rate) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS recent,
  sum(k) OVER o AS done, min(us) OVER o AS st FROM r WINDOW o AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id, round(recent, 6) AS recent, round(CASE WHEN us > st THEN done / ((us - st) / 1e6) END, 6) AS overall,
  round(CASE WHEN us > st AND done > 0 THEN greatest(10000 - done, 0) / (done / ((us - st) / 1e6)) END, 2) AS eta FROM x""")
def _(spark, sf):
    steps = v.telemetry(spark, sf).withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    out = w.throughput(steps, "user_id", ["event_id"], "us", "k", 10000.0)
    eta = F.when(F.col("eta") != float("inf"), F.round("eta", 2))
    return out.withColumns({"recent": r6("recent"), "overall": r6("overall"), "eta": eta})


@query("win_17_peaks", """
WITH g AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events)
SELECT event_id, CAST(p AS BIGINT) AS period, max(value) OVER (PARTITION BY user_id, p ORDER BY event_id) AS peak FROM g""")
def _(spark, sf):
    out = w.peaks(table(spark, sf, "events"), "user_id", ["event_id"], "value", F.col("event_type") == "signup")
    return out.select("event_id", "period", "peak")


@query("ord_1_upload_queue", f"""WITH {v.MANIFEST}
SELECT file_id, priority, size_bytes % 1000 AS score FROM manifest WHERE state = 'PENDING' AND priority >= 1 ORDER BY priority, score DESC, file_id LIMIT 100""")
def _(spark, sf):
    files = v.manifest(spark, sf).withColumn("score", F.col("size_bytes") % 1000)
    return k.upload_queue(files, 100, 1).select("file_id", "priority", "score")


@query("ord_2_request_order", f"""WITH {v.TELEMETRY} SELECT event_id, row_number() OVER (ORDER BY k DESC, event_id) AS place FROM telemetry""")
def _(spark, sf):
    return k.request_order(v.telemetry(spark, sf).select("event_id", "k"), "k", "event_id").select("event_id", "place")


@query("ord_4_top_recommendations", """
SELECT p_partkey, p_size, p_retailprice FROM part ORDER BY p_size DESC, p_retailprice DESC, p_partkey LIMIT 5""")
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return k.top_n(parts, 5, F.desc("p_size"), F.desc("p_retailprice"), F.col("p_partkey"))


@query("ord_5_top_classes", """
WITH e AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(0, len(embedding))) AS c FROM embeddings),
s AS (SELECT vec_id, c, exp(x) / sum(exp(x)) OVER (PARTITION BY vec_id) AS p, row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, c) AS rn FROM e)
SELECT vec_id, CAST(rn AS INT) AS rank, CAST(c AS INT) AS class, round(p, 6) AS probability FROM s WHERE rn <= 5""")
def _(spark, sf):
    out = k.top_classes(table(spark, sf, "embeddings"), "vec_id", F.col("embedding"))
    return out.withColumn("probability", r6("probability"))


@query("ord_6_least_latency", f"""WITH {v.TELEMETRY}, {v.REQUESTS}
SELECT endpoint, round(avg(latency), 6) AS latency FROM requests WHERE success GROUP BY 1 ORDER BY 2, 1 LIMIT 1""")
def _(spark, sf):
    return k.least_latency(v.requests(spark, sf), "endpoint").withColumn("latency", r6("latency"))


@query("ord_6_failover_target", f"""WITH {v.TELEMETRY}, {v.REQUESTS},
r AS (SELECT region, CASE WHEN avg(CASE WHEN success THEN 0 ELSE 1 END) > 0.5 THEN 'unhealthy' WHEN region = 'region-1' THEN 'healthy' ELSE 'degraded' END AS health, round(avg(latency), 6) AS response_ms FROM requests GROUP BY 1)
SELECT * FROM r WHERE health <> 'unhealthy' ORDER BY CASE health WHEN 'healthy' THEN 0 ELSE 1 END, response_ms, region LIMIT 1""")
def _(spark, sf):
    bad = F.avg((~F.col("success")).cast("int")) > 0.5
    regions = v.requests(spark, sf).groupBy("region").agg(
        F.when(bad, "unhealthy").when(F.col("region") == "region-1", "healthy").otherwise("degraded").alias("health"),
        r6(F.avg("latency")).alias("response_ms"),
    )
    return k.failover_target(regions)


@query("set_1_union", """
WITH u AS (SELECT 'customer' AS provider, c_nationkey AS nation, c_acctbal AS amount, c_mktsegment AS segment FROM customer
  UNION ALL SELECT 'supplier', s_nationkey, s_acctbal, NULL FROM supplier)
SELECT provider, nation, segment, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(38,6))) AS DOUBLE) AS amount FROM u GROUP BY ALL""")
def _(spark, sf):
    customers = lambda: table(spark, sf, "customer").select(
        F.lit("customer").alias("provider"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = lambda: table(spark, sf, "supplier").select(
        F.lit("supplier").alias("provider"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("amount")
    )
    broken = lambda: table(spark, sf, "no_such_provider")
    return s.union_available([customers, broken, suppliers]).groupBy("provider", "nation", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("amount").cast("decimal(38,6)")).cast("double").alias("amount")
    )


@query("set_2_key_overlap", """
WITH a AS (SELECT o_orderkey AS key FROM orders), b AS (SELECT DISTINCT l_orderkey + 50 AS key FROM lineitem)
SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'source_only' WHEN a.key IS NULL THEN 'target_only' ELSE 'common' END AS kind FROM a FULL JOIN b ON a.key = b.key""")
def _(spark, sf):
    left = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"))
    right = table(spark, sf, "lineitem").select((F.col("l_orderkey") + 50).alias("key"))
    return s.key_overlap(left, right, "key")


@query("set_3_distinct_rows", """
SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, CASE WHEN l_discount > 0.05 THEN l_tax END AS tax FROM lineitem""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("tax", F.when(F.col("l_discount") > 0.05, F.col("l_tax")))
    return s.distinct_rows(rows, ["l_returnflag", "l_linestatus", "l_quantity", "tax"])


@query("set_4_first_per_text", r"""
SELECT min(doc_id) AS doc_id FROM documents GROUP BY lower(regexp_replace(text, '^\s+|\s+$', '', 'g'))""")
def _(spark, sf):
    return s.first_per_text(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", F.col("text")).select("doc_id")


@query("set_5_fuzzy_dedup", """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, row_number() OVER (ORDER BY vec_id) AS i FROM embeddings),
n AS MATERIALIZED (SELECT a.i, list(b.i) FILTER (b.i IS NOT NULL) AS near FROM e a LEFT JOIN e b ON b.i < a.i AND list_cosine_similarity(a.v, b.v) >= 0.5 GROUP BY 1),
g(i, kept) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
  SELECT n.i, CASE WHEN list_has_any(kept, coalesce(near, CAST([] AS BIGINT[]))) THEN kept ELSE list_append(kept, n.i) END FROM g JOIN n ON n.i = g.i + 1),
f AS (SELECT kept FROM g ORDER BY i DESC LIMIT 1)
SELECT vec_id, list_contains(kept, i) AS kept FROM e, f""")
def _(spark, sf):
    return s.fuzzy_dedup(table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding", 0.5)
