"""Metric queries over samples derived from the events."""

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.registry import query, r6, table
from millrace.operators import timeseries as t
from millrace.plans.ordered import Ordered
from millrace.plans.quantiles import exact_quantiles

HOUR, WINDOW = 3600, 6 * 3600
SERIES = ["event_type", "bucket"]

SAMPLES = """samples AS (SELECT event_id, event_type, user_id % 5 AS bucket, epoch_us(ts) AS ts, CAST(ceil(epoch_us(ts) / 3600000000) * 3600 AS BIGINT) AS step,
  CAST(row_number() OVER (PARTITION BY event_type, user_id % 5 ORDER BY event_id) % 100 AS DOUBLE) AS value, value AS gauge FROM events)"""

RATES = f"""{SAMPLES}, lagged AS (SELECT *, lag(value) OVER (PARTITION BY event_type, bucket ORDER BY event_id) AS prev FROM samples),
inc AS (SELECT *, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS increase FROM lagged),
rates AS (SELECT event_type, bucket, s AS step, sum(increase) AS increase, sum(increase) / 21600 AS rate
  FROM (SELECT event_type, bucket, increase, unnest(range(step, step + 21600, 3600)) AS s FROM inc) x GROUP BY 1, 2, 3)"""


def samples(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "event_type", (F.col("user_id") % 5).alias("bucket"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), F.col("value").alias("gauge")
    )
    counted = Ordered(rows, SERIES, ["event_id"]).running(n=("count", F.lit(1)))
    return counted.withColumn("value", (F.col("n") % 100).cast("double")).drop("n")


def rates(spark, sf):
    return t.rates(samples(spark, sf), SERIES, ["event_id"], WINDOW, HOUR)


@query("tsq_1_rate", f"WITH {RATES} SELECT event_type, bucket, step, increase, round(rate, 6) AS rate FROM rates")
def _(spark, sf):
    return rates(spark, sf).withColumn("rate", r6("rate"))


@query("tsq_2_by_label", f"WITH {RATES} SELECT bucket, step, round(sum(rate), 6) AS total, round(avg(rate), 6) AS average FROM rates GROUP BY 1, 2")
def _(spark, sf):
    return t.by_label(rates(spark, sf), ["bucket"], "rate").withColumns({"total": r6("total"), "average": r6("average")})


@query("tsq_3_error_ratio", f"""WITH {RATES}
SELECT bucket, step, round(CASE WHEN sum(rate) <> 0 THEN sum(CASE WHEN event_type = 'error' THEN rate ELSE 0 END) / sum(rate) END, 6) AS ratio FROM rates GROUP BY 1, 2""")
def _(spark, sf):
    return t.ratio_of(rates(spark, sf), ["bucket"], F.col("event_type") == "error", "rate").withColumn("ratio", r6("ratio"))


BOUNDS = [1, 5, 10, 30, 60, 120, 300]
BUCKETED = """le AS (SELECT unnest([1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0, 'Infinity'::DOUBLE]) AS le),
cum AS (SELECT event_type, CAST(le AS DOUBLE) AS le, count(*) FILTER (value <= le) AS n FROM events, le GROUP BY 1, 2)"""


def bucketed(spark, sf):
    return t.cumulative_buckets(table(spark, sf, "events"), ["event_type"], "value", BOUNDS)


@query("tsq_4_histogram_quantile", f"""WITH {BUCKETED},
w AS (SELECT *, lag(n, 1, 0) OVER o AS pn, lag(le, 1, CAST(0 AS DOUBLE)) OVER o AS ple, 0.95 * max(n) OVER (PARTITION BY event_type) AS rk FROM cum WINDOW o AS (PARTITION BY event_type ORDER BY le)),
h AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY le) AS i FROM w WHERE n >= rk)
SELECT event_type, round(CASE WHEN isinf(le) THEN ple ELSE ple + (le - ple) * (rk - pn) / (n - pn) END, 6) AS quantile FROM h WHERE i = 1""")
def _(spark, sf):
    return t.histogram_quantile(bucketed(spark, sf), ["event_type"], 0.95).withColumn("quantile", r6("quantile"))


@query("tsq_5_buckets", f"WITH {BUCKETED} SELECT event_type, CASE WHEN isinf(le) THEN -1 ELSE le END AS le, n AS count FROM cum")
def _(spark, sf):
    out = bucketed(spark, sf)
    return out.withColumn("le", F.when(F.col("le") == float("inf"), F.lit(-1.0)).otherwise(F.col("le")))


@query("tsq_6_slope", f"""WITH {SAMPLES}, c AS (SELECT event_type, bucket, ts, gauge, unnest(range(step, step + 21600, 3600)) AS s FROM samples)
SELECT event_type, bucket, s AS step, round(regr_slope(gauge, ts / 1e6 - s), 6) + 0 AS slope FROM c GROUP BY 1, 2, 3 HAVING count(*) >= 2""")
def _(spark, sf):
    gauges = samples(spark, sf).drop("value").withColumnRenamed("gauge", "value")
    return t.slope(gauges, SERIES, WINDOW, HOUR).withColumns({"step": F.col("step").cast("bigint"), "slope": r6("slope")})


@query("tsq_7_average_over_time", f"""WITH {SAMPLES}, i AS (SELECT bucket, step, avg(gauge) AS a FROM samples GROUP BY 1, 2),
c AS (SELECT bucket, a, unnest(range(step, step + 21600, 3600)) AS s FROM i) SELECT bucket, s AS step, round(avg(a), 6) AS average FROM c GROUP BY 1, 2""")
def _(spark, sf):
    return t.average_over_time(samples(spark, sf), ["bucket"], "gauge", WINDOW, HOUR).withColumn("average", r6("average"))


@query("tsq_8_absent", f"""WITH {SAMPLES}, p AS (SELECT DISTINCT event_type, bucket, step FROM samples), s AS (SELECT DISTINCT event_type, bucket FROM p),
g AS (SELECT unnest(range((SELECT min(step) FROM p), (SELECT max(step) FROM p) + 3600, 3600)) AS step)
SELECT s.event_type, s.bucket, g.step FROM s, g WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.event_type = s.event_type AND p.bucket = s.bucket AND p.step = g.step)""")
def _(spark, sf):
    return t.absent(samples(spark, sf), SERIES, HOUR)


@query("tsq_8_targets_up", f"""WITH {SAMPLES} SELECT event_type, step, count(DISTINCT bucket) AS up FROM samples GROUP BY 1, 2""")
def _(spark, sf):
    present = samples(spark, sf).withColumn("step", t.step_end(F.col("ts"), HOUR))
    return t.targets_up(present, ["event_type"], "bucket")


ALERTS = f"""{RATES}, q AS (SELECT bucket, step, sum(CASE WHEN event_type = 'error' THEN rate ELSE 0 END) / nullif(sum(rate), 0) AS ratio FROM rates GROUP BY 1, 2),
o AS (SELECT *, coalesce(ratio > 0.05, false) AS "on" FROM q), r AS (SELECT *, sum(CASE WHEN "on" THEN 0 ELSE 1 END) OVER (PARTITION BY bucket ORDER BY step) AS run FROM o),
a AS (SELECT *, CASE WHEN "on" THEN min(step) FILTER ("on") OVER (PARTITION BY bucket, run) END AS since FROM r)"""


@query("tsq_9_alerts", f"""WITH {ALERTS}
SELECT bucket, step, since AS active_since, CASE WHEN NOT "on" THEN 'inactive' WHEN step - since >= 7200 THEN 'firing' ELSE 'pending' END AS state, 'critical' AS severity FROM a""")
def _(spark, sf):
    points = t.ratio_of(rates(spark, sf), ["bucket"], F.col("event_type") == "error", "rate")
    return t.alert_states(points, ["bucket"], F.col("ratio") > 0.05, 7200, "critical")


@query("tsq_10_budget_burn", f"""WITH {SAMPLES}, c AS (SELECT bucket, event_type, unnest(range(step, step + 21600, 3600)) AS s FROM samples),
e AS (SELECT bucket, s, 1 - count(*) FILTER (event_type <> 'error') / count(*) AS x FROM c GROUP BY 1, 2)
SELECT bucket, s AS step, round(x, 6) + 0 AS error_share, x > 0.02 AS over, x > 0.02 * 4 AS fast_burn FROM e""")
def _(spark, sf):
    rows = samples(spark, sf).withColumn("success", F.col("event_type") != "error")
    return t.burn(rows, ["bucket"], WINDOW, HOUR, 0.02, 4.0).withColumn("error_share", r6("error_share"))


@query("tsq_11_objectives", f"""WITH {v.TELEMETRY}, {v.REQUESTS},
o AS (SELECT 'availability' AS objective, CAST(0.95 AS DOUBLE) AS target, count(*) FILTER (success) / count(*) AS a FROM requests
  UNION ALL SELECT 'latency', CAST(0.9 AS DOUBLE), count(*) FILTER (latency <= 100) / count(*) FROM requests UNION ALL SELECT 'correct', CAST(0.85 AS DOUBLE), count(*) FILTER (k < 80) / count(*) FROM requests)
SELECT objective, target, round(a, 6) AS attained, a >= target AS met, round(1 - (1 - a) / (1 - target), 6) AS budget_left FROM o""")
def _(spark, sf):
    rules = {"availability": (F.col("success"), 0.95), "latency": (F.col("latency") <= 100, 0.9), "correct": (F.col("k") < 80, 0.85)}
    out = t.objectives(v.requests(spark, sf), rules)
    return out.withColumns({"attained": r6("attained"), "budget_left": r6("budget_left")})


@query("tsq_12_class_mix", f"WITH {RATES} SELECT event_type, step, sum(increase) AS increase FROM rates GROUP BY 1, 2")
def _(spark, sf):
    return rates(spark, sf).groupBy("event_type", "step").agg(F.sum("increase").alias("increase"))


@query("tsq_13_region_row", f"""WITH {v.TELEMETRY}, {v.REQUESTS}
SELECT region, round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) AS request_rate, round(count(*) FILTER (NOT success) / count(*), 6) AS error_rate,
  round(quantile_cont(latency, 0.5) * 1000, 6) AS p50_ms, round(quantile_cont(latency, 0.95) * 1000, 6) AS p95_ms, round(quantile_cont(latency, 0.99) * 1000, 6) AS p99_ms,
  round(avg(k), 6) AS cpu_pct, CAST(max(k) AS DOUBLE) AS memory_pct, count(DISTINCT endpoint) AS pods FROM requests GROUP BY 1""")
def _(spark, sf):
    req, us = v.requests(spark, sf), F.unix_micros(F.col("ts").cast("timestamp"))
    base = req.groupBy("region").agg(
        r6(F.count(F.lit(1)) / ((F.max(us) - F.min(us)) / 1e6)).alias("request_rate"), r6(F.avg((~F.col("success")).cast("int"))).alias("error_rate"),
        r6(F.avg("k")).alias("cpu_pct"), r6(F.max("k")).alias("memory_pct"), F.count_distinct("endpoint").alias("pods"),
    )
    tails = exact_quantiles(req, ["region"], "latency", {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99})
    return base.join(tails, "region").withColumns({c: r6(F.col(c) * 1000) for c in ("p50_ms", "p95_ms", "p99_ms")})


@query("tsq_14_usage_ratio", f"""WITH {SAMPLES},
g AS (SELECT bucket, step, arg_max(gauge, ts) FILTER (event_type = 'click') AS used, arg_max(gauge, ts) FILTER (event_type = 'view') AS total FROM samples GROUP BY 1, 2)
SELECT bucket, step, round(used, 6) AS used, round(total, 6) AS total, round(used / total, 6) AS ratio, used / total > 0.9 AS alert FROM g WHERE used / total IS NOT NULL""")
def _(spark, sf):
    name = F.when(F.col("event_type") == "click", "used").when(F.col("event_type") == "view", "total").otherwise("other")
    rows = samples(spark, sf).select("bucket", t.step_end(F.col("ts"), HOUR).alias("step"), "ts", name.alias("name"), F.col("gauge").alias("value"))
    out = t.usage_ratio(rows, ["bucket"], "used", "total", 0.9)
    return out.withColumns({c: r6(c) for c in ("used", "total", "ratio")})


@query("tsq_15_alert_life", f"""WITH {v.TELEMETRY},
e AS (SELECT user_id AS alert_id, event_id, epoch_us(ts) AS ts, CASE WHEN event_type = 'error' THEN 'fire' ELSE 'resolve' END AS action, CASE WHEN k > 50 THEN 'critical' ELSE 'warning' END AS severity
  FROM telemetry WHERE event_type IN ('error', 'purchase')),
p AS (SELECT alert_id, arg_max(severity, event_id) AS severity, arg_max(action, event_id) AS last, max(ts) FILTER (action = 'fire') AS fired_at, max(ts) FILTER (action = 'resolve') AS resolved,
  count(*) FILTER (action = 'fire') AS times FROM e GROUP BY 1)
SELECT alert_id, severity, fired_at, CASE WHEN last <> 'fire' THEN resolved END AS resolved_at, last = 'fire' AS active, times FROM p WHERE fired_at IS NOT NULL""")
def _(spark, sf):
    rows = v.telemetry(spark, sf).where(F.col("event_type").isin("error", "purchase")).select(
        F.col("user_id").alias("alert_id"), "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"),
        F.when(F.col("event_type") == "error", "fire").otherwise("resolve").alias("action"),
        F.when(F.col("k") > 50, "critical").otherwise("warning").alias("severity"),
    )
    return t.alert_life(rows, "alert_id", ["event_id"])


@query("tsq_16_over_budget", f"""WITH {v.COST},
b AS (SELECT service, provider, CAST(sum(amount) AS DOUBLE) / 82 AS budget FROM cost GROUP BY 1, 2),
m AS (SELECT service, provider, strftime(ts, '%Y-%m') AS month, CAST(sum(amount) AS DOUBLE) AS cost FROM cost GROUP BY 1, 2, 3)
SELECT m.service, m.provider, month, cost, round(budget, 4) AS budget, cost > budget AS over FROM m JOIN b ON m.service = b.service AND m.provider = b.provider""")
def _(spark, sf):
    costs = v.cost_rows(spark, sf)
    budgets = costs.groupBy("service", "provider").agg((F.sum("amount").cast("double") / 82).alias("budget"))
    out = t.over_budget(costs.withColumn("amount", F.col("amount")), budgets, ["service", "provider"])
    return out.withColumns({"cost": F.col("cost").cast("double"), "budget": F.round("budget", 4)})
