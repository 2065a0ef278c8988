"""Streaming queries: bounded runs over the event table, and their batch forms."""

from functools import reduce

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.filters import FRAMES, RULE_TABLE, frame_columns, frames
from millrace.catalog.registry import query, r6, table
from millrace.catalog.timeseries import ALERTS, rates
from millrace.catalog.windows import STREAKS, ZSCORE
from millrace.operators import experiments as e
from millrace.operators import filters as f
from millrace.operators import timeseries as t
from millrace.operators import windows as w
from millrace.plans.quantiles import exact_quantiles
from millrace.session import new_path
from millrace.streaming import keyed as k
from millrace.streaming import ledger, polling, uploads
from millrace.streaming import stateful as s
from millrace.streaming.jobs import replayed_lateness, run_available, stream_table, with_end


def live(spark, sf, files_per_trigger=None):
    """Events as a stream, with event time and the time in microseconds."""
    rows = stream_table(spark, sf, "events", files_per_trigger).withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.withColumns({"us": F.unix_micros("ts"), "k": F.get_json_object("props", "$.k").cast("bigint")})


def still(spark, sf):
    rows = v.telemetry(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.withColumn("us", F.unix_micros("ts"))


#: files of a table that a trigger of a keyed stream reads
FILES = 8


def run_live(spark, sf, shape, key, step, schema, idle=None, tick=None):
    """A keyed step over the event stream, a bounded number of files at a time, none of their rows too late."""
    late = replayed_lateness(table(spark, sf, "events"), "ts")
    return k.run_keyed(shape(live(spark, sf, FILES)), [key], ["us", "event_id"], step, schema, late, idle=idle, tick=tick)


@query("str_1_rule_stream", f"WITH {FRAMES}, {RULE_TABLE} SELECT event_id, rule, CAST(priority AS INT) AS priority, CAST(score AS DOUBLE) AS score FROM hits")
def _(spark, sf):
    seen = live(spark, sf).select("event_id", *frame_columns())
    return run_available(f.rule_events(seen).select("event_id", "rule", "priority", "score"))


@query("str_2_zscore_stream", f"WITH {ZSCORE} SELECT event_id, round(z, 6) AS z, z > 3 AS is_anomaly FROM z")
def _(spark, sf):
    step = s.zscore_step("value", ["event_id"])
    rows = lambda df: df.select("user_id", "event_id", "us", "value")
    out = run_live(spark, sf, rows, "user_id", step, "event_id bigint, z double, is_anomaly boolean")
    return out.withColumn("z", r6("z"))


COOLDOWN = f"""
WITH RECURSIVE {FRAMES}, {RULE_TABLE},
o AS MATERIALIZED (SELECT user_id, rule, event_id, epoch_us(ts) AS us, greatest(pre_sec + post_sec, 5) * 40000000000 AS wait, row_number() OVER (PARTITION BY user_id, rule ORDER BY ts, event_id) AS rn FROM hits),
g(user_id, rule, rn, event_id, last, fired) AS (SELECT user_id, rule, rn, event_id, us, true FROM o WHERE rn = 1
  UNION ALL SELECT o.user_id, o.rule, o.rn, o.event_id, CASE WHEN us - last >= wait THEN us ELSE last END, us - last >= wait FROM g JOIN o ON o.user_id = g.user_id AND o.rule = g.rule AND o.rn = g.rn + 1)
SELECT event_id, rule FROM g WHERE fired"""

KEEP = {"event_id": "bigint", "rule": "string"}


def cooldown_column():
    return (F.greatest(F.col("pre_sec") + F.col("post_sec"), F.lit(5.0)) * 40000000000).cast("bigint")


@query("str_3_cooldown", COOLDOWN)
def _(spark, sf):
    hits = f.rule_events(frames(spark, sf)).withColumns({"us": F.unix_micros(F.col("ts").cast("timestamp")), "wait": cooldown_column()})
    hits = hits.select("user_id", "rule", "event_id", "us", "wait")
    return s.cooldown_batch(hits, ["user_id", "rule"], ["us", "event_id"], "us", "wait", KEEP)


@query("str_3_cooldown_stream", COOLDOWN)
def _(spark, sf):
    seen = lambda df: df.select("event_id", "user_id", "us", *frame_columns())
    hits = lambda df: f.rule_events(seen(df)).select("user_id", "event_id", "us", "rule", cooldown_column().alias("wait"))
    step = s.cooldown_step("us", "wait", list(KEEP), part="rule")
    return run_live(spark, sf, hits, "user_id", step, "event_id bigint, rule string")


MAX_BYTES, MAX_AGE = 300_000, 86_400_000_000

ROTATION = f"""
WITH RECURSIVE o AS MATERIALIZED (SELECT user_id, event_id, epoch_us(ts) AS us, CAST(round(value * 1000) AS BIGINT) AS size, event_type = 'error' AS bad, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
g(user_id, rn, event_id, opened, used, frames, why, us) AS (
  SELECT user_id, rn, event_id, us, size, CAST(1 AS BIGINT), CASE WHEN bad THEN 'anomaly' WHEN size >= {MAX_BYTES} THEN 'size' END, us FROM o WHERE rn = 1
  UNION ALL
  SELECT user_id, rn, event_id, op, us_, fr, CASE WHEN bad THEN 'anomaly' WHEN us_ >= {MAX_BYTES} THEN 'size' WHEN us - op >= {MAX_AGE} THEN 'time' END, us FROM (
    SELECT o.user_id, o.rn, o.event_id, o.bad, o.us, CASE WHEN why IS NULL THEN opened ELSE g.us END AS op, CASE WHEN why IS NULL THEN used ELSE 0 END + size AS us_,
      CASE WHEN why IS NULL THEN frames ELSE 0 END + 1 AS fr FROM g JOIN o ON o.user_id = g.user_id AND o.rn = g.rn + 1) x)
SELECT user_id, event_id, why AS reason, used AS bytes, frames, CAST(CASE WHEN why = 'anomaly' THEN 0 ELSE 3 END AS INT) AS priority FROM g WHERE why IS NOT NULL"""

FRAME = {"user_id": "bigint", "event_id": "bigint"}


def sized(df):
    return df.select(
        "user_id", "event_id", "us", F.round(F.col("value") * 1000).cast("bigint").alias("size"), (F.col("event_type") == "error").alias("bad")
    )


@query("str_4_rotation", ROTATION)
def _(spark, sf):
    return s.rotation_batch(sized(still(spark, sf)), ["user_id"], ["us", "event_id"], "us", "size", "bad", FRAME, MAX_BYTES, MAX_AGE)


@query("str_4_rotation_stream", ROTATION)
def _(spark, sf):
    step = s.rotation_step("us", "size", "bad", list(FRAME), MAX_BYTES, MAX_AGE)
    schema = "user_id bigint, event_id bigint, " + s.ROTATION
    return run_live(spark, sf, sized, "user_id", step, schema)


@query("str_5_hourly_rollup", f"""WITH {v.TELEMETRY}, {v.USAGE}
SELECT epoch_us(date_trunc('hour', ts)) AS hour, round(sum(gpu_cost + vector_cost + network_cost + token_cost), 6) AS cost, count(*) AS requests, CAST(sum(tokens) AS BIGINT) AS tokens FROM usage GROUP BY 1""")
def _(spark, sf):
    return cost_rollup(spark, sf, "1 hour").withColumnRenamed("start", "hour")


def cost_rollup(spark, sf, size):
    """Costs, requests and tokens of closed windows of one size."""
    tokens = F.floor(F.col("value") * 10)
    cost = F.col("value") / 3600 * v.GPU_HOUR + (F.col("k") % 5) * v.VECTOR_QUERY + F.col("k") / 1000 * v.NETWORK_GB + tokens / 1000 * v.THOUSAND_TOKENS
    end = new_path(spark, "end")
    sums = with_end(live(spark, sf), "ts", end).withWatermark("ts", "1 hour").groupBy(F.window("ts", size)).agg(
        F.sum(cost).alias("cost"), F.count(F.lit(1)).alias("requests"), F.sum(tokens).alias("tokens")
    )
    out = run_available(sums, end=end)
    return out.select(F.unix_micros("window.start").alias("start"), r6("cost").alias("cost"), "requests", "tokens")


@query("str_5_daily_rollup", f"""WITH {v.TELEMETRY}, {v.USAGE}
SELECT epoch_us(date_trunc('day', ts)) AS day, round(sum(gpu_cost + vector_cost + network_cost + token_cost), 6) AS cost, count(*) AS requests, CAST(sum(tokens) AS BIGINT) AS tokens FROM usage GROUP BY 1""")
def _(spark, sf):
    return cost_rollup(spark, sf, "1 day").withColumnRenamed("start", "day")


MAX_BATCH, TIMEOUT = 8, 600_000_000


def arrivals(df):
    return df.select((F.col("user_id") % 5).alias("endpoint"), "event_id", "us")


REQUEST = {"endpoint": "bigint", "event_id": "bigint", "us": "bigint"}

BATCHES = f"""
WITH RECURSIVE o AS MATERIALIZED (SELECT user_id % 5 AS endpoint, event_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id % 5 ORDER BY ts, event_id) AS rn FROM events),
g(endpoint, last_rn, n, flushed, why) AS (
  SELECT DISTINCT endpoint, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST('' AS VARCHAR) FROM o
  UNION ALL
  SELECT endpoint, last_rn + least(cnt, {MAX_BATCH}), least(cnt, {MAX_BATCH}), CASE WHEN cnt >= {MAX_BATCH} THEN full_at ELSE due END, CASE WHEN cnt >= {MAX_BATCH} THEN 'size' ELSE 'timeout' END FROM (
    SELECT g.endpoint, g.last_rn, greatest(any_value(h.us), coalesce(any_value(g.flushed) + {TIMEOUT}, 0)) AS due,
      count(*) FILTER (o.us <= greatest(h.us, coalesce(g.flushed + {TIMEOUT}, 0))) AS cnt, max(o.us) FILTER (o.rn = g.last_rn + {MAX_BATCH}) AS full_at
    FROM g JOIN o h ON h.endpoint = g.endpoint AND h.rn = g.last_rn + 1 JOIN o ON o.endpoint = g.endpoint AND o.rn BETWEEN g.last_rn + 1 AND g.last_rn + {MAX_BATCH} GROUP BY g.endpoint, g.last_rn) x),
b AS (SELECT endpoint, last_rn - n + 1 AS lo, last_rn AS hi, n, flushed, why FROM g WHERE n > 0)"""


@query("str_6_batching", f"{BATCHES} SELECT o.event_id, b.flushed AS flushed_at, b.why AS reason, b.n AS size FROM o JOIN b ON b.endpoint = o.endpoint AND o.rn BETWEEN lo AND hi")
def _(spark, sf):
    from pyspark.sql import Window

    out = s.batching_batch(arrivals(still(spark, sf)), ["endpoint"], ["us", "event_id"], "us", REQUEST, MAX_BATCH, TIMEOUT)
    # at most MAX_BATCH rows per batch
    size = F.count(F.lit(1)).over(Window.partitionBy("endpoint", "segment", "batch"))
    return out.select("event_id", "flushed_at", "reason", size.alias("size"))


@query("str_6_batching_stream", f"""{BATCHES}, last AS (SELECT endpoint, max(hi) AS top FROM b GROUP BY 1)
SELECT o.event_id, b.flushed AS flushed_at, b.why AS reason FROM o JOIN b ON b.endpoint = o.endpoint AND o.rn BETWEEN lo AND hi JOIN last ON last.endpoint = b.endpoint WHERE hi < top OR why = 'size'""")
def _(spark, sf):
    # the last queue of an endpoint stays open until a later request settles it
    step = s.batching_step("us", ["event_id", "us"], MAX_BATCH, TIMEOUT)
    out = run_live(spark, sf, arrivals, "endpoint", step, "event_id bigint, us bigint, " + s.BATCHING)
    return out.select("event_id", "flushed_at", "reason")


@query("agg_34_batch_statistics", f"""{BATCHES}, w AS (SELECT b.endpoint, b.lo, any_value(b.n) AS n, any_value(b.why) AS why, sum((flushed - us) / 1e6) AS wait, max((flushed - us) / 1e6) AS longest
  FROM o JOIN b ON b.endpoint = o.endpoint AND o.rn BETWEEN lo AND hi GROUP BY 1, 2)
SELECT endpoint, count(*) AS batches, round(avg(n), 6) AS avg_size, max(n) AS max_size, round(sum(wait) / sum(n), 6) AS avg_wait, round(max(longest), 6) AS max_wait,
  count(*) FILTER (why = 'size') AS by_size, count(*) FILTER (why = 'timeout') AS by_timeout FROM w GROUP BY 1""")
def _(spark, sf):
    batched = s.batching_batch(arrivals(still(spark, sf)), ["endpoint"], ["us", "event_id"], "us", REQUEST, MAX_BATCH, TIMEOUT)
    out = s.batch_statistics(batched, ["endpoint"], "us")
    return out.withColumns({c: r6(c) for c in ("avg_size", "avg_wait", "max_wait")})


@query("str_7_sliding_rate", """
WITH c AS (SELECT event_type, unnest(range(0, 6)) AS i, ts FROM events)
SELECT event_type, epoch_us(date_trunc('hour', ts)) - 3600000000 * i AS start, count(*) AS n, round(count(*) / 21600, 6) AS rate FROM c GROUP BY 1, 2""")
def _(spark, sf):
    end = new_path(spark, "end")
    rows = with_end(live(spark, sf), "ts", end).withWatermark("ts", "6 hours").groupBy("event_type", F.window("ts", "6 hours", "1 hour")).agg(F.count(F.lit(1)).alias("n"))
    out = run_available(rows, end=end)
    return out.select("event_type", F.unix_micros("window.start").alias("start"), "n", r6(F.col("n") / 21600).alias("rate"))


LIMIT, SPAN = 2, 172_800_000_000

LIMITED = f"""
WITH RECURSIVE o AS MATERIALIZED (SELECT user_id, event_id, epoch_us(ts) AS us, event_type = 'signup' AS free, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
g(user_id, rn, event_id, recent, ok) AS (SELECT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[]), false FROM (SELECT DISTINCT user_id FROM o) u
  UNION ALL SELECT user_id, rn, event_id, CASE WHEN NOT free AND len(r) < {LIMIT} THEN list_append(r, us) ELSE r END, free OR len(r) < {LIMIT} FROM (
    SELECT o.user_id, o.rn, o.event_id, o.us, o.free, list_filter(g.recent, lambda x: o.us - x < {SPAN}) AS r FROM g JOIN o ON o.user_id = g.user_id AND o.rn = g.rn + 1) x)
SELECT event_id, ok AS accepted FROM g WHERE rn > 0"""


def clients(df):
    return df.select("user_id", "event_id", "us", (F.col("event_type") == "signup").alias("free"))


@query("str_8_rate_limit", LIMITED)
def _(spark, sf):
    return s.rate_limit_batch(clients(still(spark, sf)), ["user_id"], ["us", "event_id"], "us", "free", {"event_id": "bigint"}, LIMIT, SPAN)


@query("str_8_rate_limit_stream", LIMITED)
def _(spark, sf):
    step = s.rate_limit_step("us", "free", ["event_id"], LIMIT, SPAN)
    # a window after its last request a client's memory is empty
    return run_live(spark, sf, clients, "user_id", step, "event_id bigint, accepted boolean", idle=SPAN)


HEALTH = f"""WITH {STREAKS}, h AS (SELECT event_id, streak, CASE WHEN ok AND value < 50 THEN 'healthy' WHEN ok THEN 'degraded' WHEN streak >= 3 THEN 'unhealthy' ELSE 'degraded' END AS health,
  avg(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS err FROM streaks)"""


def checks(df):
    return df.withColumn("ok", ~F.col("event_type").isin("error", "view", "click"))


@query("str_9_health", f"""{HEALTH} SELECT event_id, CAST(streak AS BIGINT) AS streak, health, CASE WHEN health = 'unhealthy' THEN 'primary_unhealthy' WHEN health = 'degraded' AND streak >= 5 THEN 'primary_degraded'
  WHEN err > 0.1 THEN 'high_error_rate' END AS reason FROM h""")
def _(spark, sf):
    from millrace.plans.ordered import Ordered

    streaks = w.failure_streaks(checks(still(spark, sf)), "user_id", ["us", "event_id"], "ok")
    counted = Ordered(streaks, ["user_id"], ["us", "event_id"]).running(_bad=("sum", (~F.col("ok")).cast("bigint")), _n=("count", F.lit(1)))
    out = s.health_states(counted, "ok", "value", 3, 50.0)
    return out.select("event_id", "streak", "health", s.failover_reason(F.col("health"), F.col("streak"), F.col("_bad") / F.col("_n")).alias("reason"))


@query("str_9_health_stream", f"{HEALTH} SELECT event_id, CAST(streak AS BIGINT) AS streak, health FROM h")
def _(spark, sf):
    step = s.health_step("ok", "value", ["event_id"], 3, 50.0)
    rows = lambda df: checks(df).select("user_id", "event_id", "us", "ok", "value")
    return run_live(spark, sf, rows, "user_id", step, "event_id bigint, streak bigint, health string")


def rollout(df):
    return df.select(
        (F.col("user_id") % 5).alias("deployment"), "event_id", "us", (F.col("user_id") % 2 == 1).alias("new"),
        (~((F.col("event_type") == "error") & (F.col("k") > 40))).alias("ok"), F.col("value").alias("ms"),
    )


ROLLOUT_SCHEMA = "deployment bigint, event_id bigint, " + s.ROLLOUT


def rollout_step():
    return s.rollout_step("us", "new", "ok", "ms", ["deployment", "event_id"])


ROLLOUT = """
WITH RECURSIVE req AS (SELECT user_id % 5 AS deployment, event_id, epoch_us(ts) AS us, user_id % 2 = 1 AS new,
  NOT (event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS BIGINT) > 40) AS ok, CAST(value AS DOUBLE) AS ms FROM events),
run AS MATERIALIZED (SELECT deployment, event_id, us, row_number() OVER w AS pos, count(*) FILTER (new) OVER w AS n, count(*) FILTER (new AND NOT ok) OVER w AS bad,
  coalesce(sum(ms) FILTER (new) OVER w, 0) AS ms, count(*) FILTER (NOT new) OVER w AS base, coalesce(sum(ms) FILTER (NOT new) OVER w, 0) AS base_ms
  FROM req WINDOW w AS (PARTITION BY deployment ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)),
stage(deployment, step, d) AS (
  SELECT deployment, 0, {'event_id': CAST(NULL AS BIGINT), 'pos': CAST(0 AS BIGINT), 'us': min(us), 'n': CAST(0 AS BIGINT), 'bad': CAST(0 AS BIGINT), 'ms': CAST(0 AS DOUBLE), 'base': CAST(0 AS BIGINT),
    'base_ms': CAST(0 AS DOUBLE), 'action': 'promote', 'requests': CAST(0 AS BIGINT), 'error_rate': CAST(0 AS DOUBLE), 'latency_ratio': CAST(0 AS DOUBLE)} FROM run GROUP BY 1
  UNION ALL
  SELECT deployment, step + 1, arg_min({'event_id': event_id, 'pos': pos, 'us': us, 'n': n, 'bad': bad, 'ms': ms, 'base': base, 'base_ms': base_ms, 'action': action, 'requests': rn, 'error_rate': er, 'latency_ratio': slow}, pos)
  FROM (SELECT *, CASE WHEN rn >= 10 AND (er > 0.05 OR slow > 1.5) THEN 'rollback' WHEN rn >= 100 AND us - since >= 300000000 AND NOT (er > 0.05 OR slow > 1.5) THEN 'promote' END AS action
    FROM (SELECT r.*, s.step, s.d.us AS since, r.n - s.d.n AS rn, CASE WHEN r.n > s.d.n THEN (r.bad - s.d.bad) / (r.n - s.d.n) ELSE 0 END AS er,
      CASE WHEN r.n > s.d.n AND r.base > s.d.base AND r.base_ms > s.d.base_ms THEN ((r.ms - s.d.ms) / (r.n - s.d.n)) / ((r.base_ms - s.d.base_ms) / (r.base - s.d.base)) ELSE 0 END AS slow
      FROM stage s JOIN run r ON r.deployment = s.deployment AND r.pos > s.d.pos WHERE s.step < 5 AND s.d.action = 'promote') x) y
  WHERE action IS NOT NULL GROUP BY deployment, step)
SELECT CAST(deployment AS BIGINT) AS deployment, d.event_id AS event_id, d.action AS action, [10, 25, 50, 75, 100][step] AS traffic, d.requests AS requests,
  round(d.error_rate, 6) + 0 AS error_rate, round(d.latency_ratio, 6) + 0 AS latency_ratio FROM stage WHERE step > 0"""


@query("str_10_rollout", ROLLOUT)
def _(spark, sf):
    out = e.rollout_stages(rollout(still(spark, sf)), ["deployment"], ["us", "event_id"], "us", "new", "ok", "ms", ["deployment", "event_id"])
    return out.withColumns({"error_rate": r6("error_rate"), "latency_ratio": r6("latency_ratio")})


@query("str_10_rollout_stream", ROLLOUT)
def _(spark, sf):
    out = run_live(spark, sf, rollout, "deployment", rollout_step(), ROLLOUT_SCHEMA)
    return out.withColumns({"error_rate": r6("error_rate"), "latency_ratio": r6("latency_ratio")})


@query("str_11_drain", """
WITH rows AS (SELECT event_id, user_id, value, ts, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS batch FROM events),
placed AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY ts, event_id) - 1 AS n FROM rows)
SELECT event_id, user_id, value, CAST(batch AS BIGINT) AS batch, n // 1000 AS drain, n % 1000 AS place FROM placed""")
def _(spark, sf):
    """All events are buffered in two steps and drained after each; a third drain finds nothing."""
    buffer, target = new_path(spark, "buffer"), new_path(spark, "drained")
    rows = table(spark, sf, "events").select("event_id", "user_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    runs = []
    for step in (rows.where("event_id % 3 <> 0"), rows.where("event_id % 3 = 0"), None):
        if step is not None:
            step.write.mode("append").parquet(buffer)
        runs.append(ledger.drain(spark.readStream.schema(rows.schema).parquet(buffer), ["ts", "event_id"], target))
    return reduce(lambda a, b: a.unionByName(b), runs).drop("ts")


@query("str_12_sync_poll", """
WITH e AS (
  SELECT 'a' AS region, source || '/' || doc_id AS key, CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 1 END AS poll FROM documents
  UNION ALL SELECT 'b', CASE WHEN doc_id % 17 = 0 THEN 'extra/' || doc_id ELSE source || '/' || doc_id END, CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END FROM documents
  UNION ALL SELECT 'c', source || '/' || doc_id, 1 FROM documents WHERE doc_id % 2 = 0),
first AS (SELECT key, min(poll) AS poll FROM e GROUP BY key),
held AS (SELECT first.key, first.poll, list(DISTINCT region) AS regions, min(region) AS source FROM first JOIN e ON e.key = first.key AND e.poll <= first.poll GROUP BY 1, 2)
SELECT poll, key, source, r.region, 'copy' AS action FROM held, (VALUES ('a'), ('b'), ('c')) r(region) WHERE NOT list_contains(regions, r.region)""")
def _(spark, sf):
    """Listings of three regions, some of whose entries come between two polls."""
    a, b = v.listings(spark, sf)
    d = F.regexp_extract("key", r"(\d+)$", 1).cast("bigint")
    later = lambda df, n: df.select("key", F.when(d % n == 0, 2).otherwise(1).alias("poll"))
    entries = later(a, 5).withColumn("region", F.lit("a")).unionByName(later(b, 7).withColumn("region", F.lit("b")))
    entries = entries.unionByName(a.where(d % 2 == 0).select("key", F.lit(1).alias("poll"), F.lit("c").alias("region")))
    listing, target, polls = new_path(spark, "listing"), new_path(spark, "polls"), []
    for n in (1, 2):
        entries.where(F.col("poll") == n).select("key", "region").write.mode("append").parquet(listing)
        stream = spark.readStream.schema("key string, region string").parquet(listing)
        polls.append(polling.poll(stream, ["a", "b", "c"], target).withColumn("poll", F.lit(n)))
    return polls[0].unionByName(polls[1])


@query("str_13_alert_stream", f"""WITH {ALERTS}
SELECT bucket, step, since AS active_since, CASE WHEN NOT "on" THEN 'inactive' WHEN step - since >= 7200 THEN 'firing' ELSE 'pending' END AS state FROM a""")
def _(spark, sf):
    points = t.ratio_of(rates(spark, sf), ["bucket"], F.col("event_type") == "error", "rate")
    path = new_path(spark, "points")
    points.select("bucket", "step", F.coalesce(F.col("ratio") > 0.05, F.lit(False)).alias("on")).write.parquet(path)
    stream = spark.readStream.schema("bucket bigint, step bigint, on boolean").option("maxFilesPerTrigger", FILES).parquet(path)
    step = s.alert_step("on", "step", ["bucket", "step"], 7200)
    schema = "bucket bigint, step bigint, active_since bigint, state string"
    time = F.timestamp_seconds("step")
    return k.run_keyed(stream, ["bucket"], ["step"], step, schema, replayed_lateness(spark.read.parquet(path), time), time)


LINES = """raw AS (SELECT user_id, event_id, CASE WHEN event_type IN ('view', 'click') AND row_number() OVER (PARTITION BY user_id ORDER BY event_id) > 1 THEN '    at ' || event_type || ' ' || event_id
  ELSE 'ERROR ' || event_type || ' ' || event_id END AS line FROM events)"""


def raw_lines(spark, sf):
    from millrace.plans.ordered import Ordered

    numbered = Ordered(table(spark, sf, "events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"]).running(n=("count", F.lit(1)))
    inner = F.col("event_type").isin("view", "click") & (F.col("n") > 1)
    head = F.when(inner, "    at ").otherwise("ERROR ")
    return numbered.select("user_id", "event_id", F.concat(head, "event_type", F.lit(" "), "event_id").alias("line"))


@query("str_14_stitch", f"""WITH {LINES}, g AS (SELECT *, sum(CASE WHEN line LIKE ' %' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS m FROM raw)
SELECT user_id, CAST(m AS BIGINT) AS message_no, md5(string_agg(line, chr(10) ORDER BY event_id)) AS digest, count(*) AS lines FROM g GROUP BY 1, 2""")
def _(spark, sf):
    out = s.stitch_batch(raw_lines(spark, sf), ["user_id"], ["event_id"], "line")
    return out.select("user_id", "message_no", F.md5("message").alias("digest"), "lines")


@query("str_14_stitch_stream", f"""WITH {LINES}, g AS (SELECT *, sum(CASE WHEN line LIKE ' %' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS m FROM raw),
c AS (SELECT user_id, m, md5(string_agg(line, chr(10) ORDER BY event_id)) AS digest, max(m) OVER (PARTITION BY user_id) AS top FROM g GROUP BY 1, 2)
SELECT user_id, digest FROM c WHERE m < top""")
def _(spark, sf):
    path = new_path(spark, "lines")
    raw_lines(spark, sf).write.parquet(path)
    stream = spark.readStream.schema("user_id bigint, event_id bigint, line string").option("maxFilesPerTrigger", FILES).parquet(path)
    # lines are numbered from 0, not timed: the number takes the place of microseconds
    time, step = F.timestamp_micros(F.col("event_id") + 1), s.stitch_step("line", ["user_id"])
    late = replayed_lateness(spark.read.parquet(path), time)
    out = k.run_keyed(stream, ["user_id"], ["event_id"], step, "user_id bigint, message string", late, time, grid=100_000)
    return out.select("user_id", F.md5("message").alias("digest"))


@query("str_15_dedup", "SELECT event_id, user_id FROM events")
def _(spark, sf):
    rows = live(spark, sf).select("event_id", "user_id")
    return run_available(rows.unionByName(rows), once=["event_id"])


@query("str_16_upload_life", f"""WITH {v.TELEMETRY},
p AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS retries, arg_max(event_type, event_id) AS last, count(*) FILTER (event_type = 'purchase') AS uploads FROM telemetry GROUP BY 1)
SELECT user_id, retries, CASE WHEN retries >= 10 THEN 'STUCK' WHEN last = 'purchase' THEN 'UPLOADED' WHEN last = 'view' THEN 'VERIFYING' WHEN last = 'click' THEN 'UPLOADING' WHEN last = 'error' THEN 'ERROR' ELSE 'PENDING' END AS state,
  uploads FROM p""")
def _(spark, sf):
    e = F.col("event_type")
    state = F.when(e == "purchase", "UPLOADED").when(e == "view", "VERIFYING").when(e == "click", "UPLOADING").when(e == "error", "ERROR").otherwise("PENDING")
    log = v.telemetry(spark, sf).select("user_id", "event_id", state.alias("state"))
    return upload_life(log, "user_id", "event_id")


def upload_life(log, key, order, max_retries=10):
    """Latest state per file; too many errors leave it stuck."""
    per = log.groupBy(key).agg(
        F.count_if(F.col("state") == "ERROR").alias("retries"), F.max_by("state", order).alias("last"),
        F.count_if(F.col("state") == "UPLOADED").alias("uploads"),
    )
    return per.select(key, "retries", F.when(F.col("retries") >= max_retries, "STUCK").otherwise(F.col("last")).alias("state"), "uploads")


RETRIES = """
WITH o AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
c AS (SELECT *, count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id ORDER BY rn) AS bad, count(*) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY rn) AS up FROM o),
s AS (SELECT user_id, up, min(us) AS since FROM c WHERE event_type = 'error' AND bad >= 10 GROUP BY 1, 2),
e AS (SELECT user_id, up - 1 AS up, min(us) AS closed FROM c WHERE event_type = 'purchase' GROUP BY 1, 2),
r AS (SELECT user_id, since, closed, CAST(unnest(range(0, 25)) AS INT) AS attempt FROM s LEFT JOIN e USING (user_id, up))
SELECT user_id, since + attempt * 3600000000 AS us, CASE WHEN attempt = 0 THEN 'stuck' WHEN attempt < 24 THEN 'retry' ELSE 'given_up' END AS action, attempt
FROM r WHERE attempt = 0 OR closed IS NULL OR since + attempt * 3600000000 < closed"""


def upload_log(df):
    e = F.col("event_type")
    return df.select("user_id", "event_id", "us", F.when(e == "error", "ERROR").when(e == "purchase", "UPLOADED").otherwise("UPLOADING").alias("state"))


@query("str_16_stuck_retries", RETRIES)
def _(spark, sf):
    return uploads.retries_batch(upload_log(still(spark, sf)), "user_id", "us", ["us", "event_id"], "state")


@query("str_16_stuck_retries_stream", RETRIES)
def _(spark, sf):
    step, tick = uploads.retry_step("user_id", "us", "state"), uploads.retry_tick("user_id", "us")
    return run_live(spark, sf, upload_log, "user_id", step, "user_id bigint, us bigint, " + uploads.ACTIONS, tick=tick)


@query("str_16_upload_latency", f"""WITH {v.TELEMETRY}
SELECT CAST(k % 4 AS INT) AS priority, count(*) AS uploads, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.99), 6) AS p99 FROM telemetry WHERE event_type = 'purchase' GROUP BY 1""")
def _(spark, sf):
    done = v.telemetry(spark, sf).where("event_type = 'purchase'").select((F.col("k") % 4).cast("int").alias("priority"), "value")
    counts = done.groupBy("priority").agg(F.count(F.lit(1)).alias("uploads"))
    tails = exact_quantiles(done, ["priority"], "value", {"p50": 0.5, "p99": 0.99})
    return counts.join(tails, "priority").withColumns({"p50": r6("p50"), "p99": r6("p99")})


@query("str_17_response_metrics", """
WITH r AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, min(epoch_us(ts)) AS st, max(epoch_us(ts)) AS en, min(epoch_us(ts)) FILTER (event_type = 'view') AS ft, count(*) AS n FROM events GROUP BY 1, 2)
SELECT user_id, day, coalesce((ft - st + 5) // 10, 0) / 100 AS ttft_ms, ((en - st + 5) // 10) / 100 AS total_latency_ms, round(CASE WHEN en > st THEN n / ((en - st) / 1e6) ELSE 0 END, 6) AS tokens_per_second, n AS total_tokens FROM r""")
def _(spark, sf):
    rows = still(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return response_metrics(rows, ["user_id", "day"], "us", F.col("event_type") == "view")


def response_metrics(tokens, keys, us, first):
    """Time to the first token, total time and tokens per second of each response."""
    per = tokens.groupBy(*keys).agg(
        F.min(us).alias("_st"), F.max(us).alias("_en"), F.min(F.when(first, F.col(us))).alias("_ft"), F.count(F.lit(1)).alias("total_tokens")
    )
    seconds = (F.col("_en") - F.col("_st")) / 1e6
    return per.select(
        *keys, F.round(F.coalesce((F.col("_ft") - F.col("_st")) / 1000, F.lit(0.0)), 2).alias("ttft_ms"),
        F.round((F.col("_en") - F.col("_st")) / 1000, 2).alias("total_latency_ms"),
        r6(F.when(seconds > 0, F.col("total_tokens") / seconds).otherwise(0.0)).alias("tokens_per_second"), "total_tokens",
    )
