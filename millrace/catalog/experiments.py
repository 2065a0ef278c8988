"""Experiment queries on the request log."""

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.registry import query, r6
from millrace.operators import experiments as e
from millrace.operators.aggregates import request_stats

LOG = f"{v.TELEMETRY}, {v.REQUESTS}"


def area(density, top):
    """SQL: integral of ``density``, where {} is the place, from 0 to ``top`` by Simpson's rule."""
    at = density.format(*[f"(i * {top} / 2000)"] * density.count("{}"))
    return f"list_sum(list_transform(range(0, 2001), lambda i: (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * {at})) * {top} / 6000"


# two-sided p-values of z and of t with df degrees of freedom
NORMAL = f"greatest(0, 1 - sqrt(2 / pi()) * {area('exp(-{} * {} / 2)', 'least(abs(z), 12)')})"
STUDENT = f"greatest(0, 1 - 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi()) * {area('pow(cos({}), df - 1)', 'atan(abs(t) / sqrt(df))')})"


def decided(columns, better):
    """SQL: the test's columns, its p-value and the winner at 95 % confidence."""
    return f"""SELECT {columns}, round(p, 6) + 0 AS p_value, coalesce(p < 0.05, false) AS has_winner,
  CASE WHEN p < 0.05 THEN CASE WHEN {better} THEN 'baseline' ELSE 'canary' END END AS winner FROM tested"""


RATES = f"""WITH {LOG},
s AS (SELECT count(*) FILTER (variant = 'baseline') AS n1, count(*) FILTER (variant = 'canary') AS n2, count(*) FILTER (variant = 'baseline' AND success) AS s1,
  count(*) FILTER (variant = 'canary' AND success) AS s2 FROM requests),
p AS (SELECT *, (s1 + s2) / (n1 + n2) AS pool FROM s)"""


@query("exp_2_proportion_test", f"""{RATES}
SELECT round(s1 / n1, 6) AS rate1, round(s2 / n2, 6) AS rate2, round((s1 / n1 - s2 / n2) / sqrt(pool * (1 - pool) * (1 / n1 + 1 / n2)), 6) + 0 AS z FROM p""")
def _(spark, sf):
    out = e.proportion_test(v.requests(spark, sf), "variant", "baseline", "canary")
    return out.select(*[r6(c).alias(c) for c in ("rate1", "rate2", "z")])


@query("exp_2_proportion_decision", f"""{RATES},
z AS (SELECT s1 / n1 AS rate1, s2 / n2 AS rate2, (s1 / n1 - s2 / n2) / sqrt(pool * (1 - pool) * (1 / n1 + 1 / n2)) AS z FROM p), tested AS (SELECT *, {NORMAL} AS p FROM z)
{decided("round(rate1, 6) AS rate1, round(rate2, 6) AS rate2, round(z, 6) + 0 AS z", "rate1 > rate2")}""")
def _(spark, sf):
    out = e.proportion_test(v.requests(spark, sf), "variant", "baseline", "canary")
    return out.withColumns({c: r6(c) for c in ("rate1", "rate2", "z", "p_value")})


RANKS = f"""WITH {LOG},
r AS (SELECT variant, latency, rank() OVER (ORDER BY latency) + (count(*) OVER (PARTITION BY latency) - 1) / 2.0 AS rk FROM requests),
u AS (SELECT count(*) FILTER (variant = 'baseline') AS n1, count(*) FILTER (variant = 'canary') AS n2, sum(CAST(rk AS DOUBLE)) FILTER (variant = 'baseline') AS r1 FROM r),
t AS (SELECT sum(n * n * n - n) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM requests GROUP BY latency) g),
x AS (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2 AS u, n1 * n2 / 2 AS mu, sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / (CAST(n1 + n2 AS DOUBLE) * (n1 + n2 - 1)))) AS sd FROM u, t)"""


@query("exp_3_rank_sum", f"""{RANKS}
SELECT n1, n2, round(u, 6) AS u, round(greatest(abs(u - mu) - 0.5, 0) / sd, 6) AS z FROM x""")
def _(spark, sf):
    out = e.rank_sum_test(v.requests(spark, sf), "variant", "latency", "baseline", "canary")
    return out.select("n1", "n2", r6("u").alias("u"), r6("z").alias("z"))


@query("exp_3_rank_sum_decision", f"""{RANKS},
m AS (SELECT avg(latency) FILTER (variant = 'baseline') AS mean1, avg(latency) FILTER (variant = 'canary') AS mean2 FROM requests),
z AS (SELECT n1, n2, u, greatest(abs(u - mu) - 0.5, 0) / sd AS z, mean1, mean2 FROM x, m), tested AS (SELECT *, {NORMAL} AS p FROM z)
{decided("n1, n2, round(u, 6) AS u, round(z, 6) AS z", "mean1 < mean2")}""")
def _(spark, sf):
    out = e.rank_sum_test(v.requests(spark, sf), "variant", "latency", "baseline", "canary")
    return out.withColumns({c: r6(c) for c in ("u", "z", "p_value")})


MEANS = f"""WITH {LOG},
s AS (SELECT count(feedback) FILTER (variant = 'baseline') AS n1, count(feedback) FILTER (variant = 'canary') AS n2, avg(feedback) FILTER (variant = 'baseline') AS m1,
  avg(feedback) FILTER (variant = 'canary') AS m2, var_samp(feedback) FILTER (variant = 'baseline') AS v1, var_samp(feedback) FILTER (variant = 'canary') AS v2 FROM requests)"""


@query("exp_4_mean_test", f"""{MEANS}
SELECT round(m1, 6) AS m1, round(m2, 6) AS m2, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)), 6) + 0 AS t, CAST(n1 + n2 - 2 AS DOUBLE) AS df FROM s""")
def _(spark, sf):
    out = e.mean_test(v.requests(spark, sf), "variant", "feedback", "baseline", "canary")
    return out.select(r6("m1").alias("m1"), r6("m2").alias("m2"), r6("t").alias("t"), "df")


@query("exp_4_mean_decision", f"""{MEANS},
t AS (SELECT m1, m2, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)) AS t, CAST(n1 + n2 - 2 AS DOUBLE) AS df FROM s),
tested AS (SELECT *, {STUDENT} AS p FROM t)
{decided("round(m1, 6) AS m1, round(m2, 6) AS m2, round(t, 6) + 0 AS t, df", "m1 > m2")}""")
def _(spark, sf):
    out = e.mean_test(v.requests(spark, sf), "variant", "feedback", "baseline", "canary")
    return out.withColumns({c: r6(c) for c in ("m1", "m2", "t", "p_value")})


@query("exp_5_sample_gate", f"""WITH {LOG}, s AS (SELECT variant || '/' || endpoint AS variant, count(*) AS n FROM requests GROUP BY 1)
SELECT bool_and(n >= 1000) AS ready, coalesce(string_agg(variant, ',' ORDER BY variant) FILTER (n < 1000), '') AS too_small, CAST(sum(n) AS BIGINT) AS requests,
  CASE WHEN bool_and(n >= 1000) THEN 'enough samples' ELSE 'insufficient samples' END AS reason FROM s""")
def _(spark, sf):
    named = v.requests(spark, sf).withColumn("variant", F.concat_ws("/", "variant", "endpoint"))
    return e.sample_gate(request_stats(named, ["variant"]), 1000)


STAGES = """st AS (SELECT endpoint, strftime(ts, '%Y-%m-%d') AS stage, variant, count(*) AS requests, count(*) FILTER (NOT success AND k > 70) AS errors, avg(latency) AS latency,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds FROM requests GROUP BY ALL),
c AS (SELECT endpoint, stage, coalesce(max(requests) FILTER (variant = 'canary'), 0) AS n, max(errors) FILTER (variant = 'canary') AS err, max(latency) FILTER (variant = 'canary') AS lat,
  max(seconds) FILTER (variant = 'canary') AS sec, max(latency) FILTER (variant = 'baseline') AS base FROM st GROUP BY ALL),
d AS (SELECT endpoint, stage, n, CASE WHEN n > 0 THEN err / n ELSE 0 END AS er, CASE WHEN base > 0 AND lat > 0 THEN lat / base ELSE 0 END AS ratio, sec FROM c)"""


@query("exp_6_canary_decision", f"""WITH {LOG}, {STAGES}
SELECT endpoint, stage, n AS requests, round(er, 6) AS error_rate, round(ratio, 6) AS latency_ratio,
  CASE WHEN n >= 10 AND (er > 0.05 OR ratio > 1.5) THEN 'rollback' WHEN n >= 20 AND sec >= 300 AND NOT (er > 0.05 OR ratio > 1.5) THEN 'promote' ELSE 'wait' END AS action FROM d""")
def _(spark, sf):
    t = F.col("ts").cast("timestamp")
    stats = v.requests(spark, sf).groupBy("endpoint", F.date_format("ts", "yyyy-MM-dd").alias("stage"), F.col("variant").alias("version")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(~F.col("success") & (F.col("k") > 70)).alias("errors"), F.avg("latency").alias("latency"),
        ((F.unix_micros(F.max(t)) - F.unix_micros(F.min(t))) / 1e6).alias("seconds"),
    )
    out = e.canary_decision(stats, ["endpoint", "stage"], min_promote=20)
    return out.withColumns({"error_rate": r6("error_rate"), "latency_ratio": r6("latency_ratio")})


@query("exp_7_index_percentile", f"""WITH {LOG},
r AS (SELECT endpoint, latency, row_number() OVER (PARTITION BY endpoint ORDER BY latency) AS rn, count(*) OVER (PARTITION BY endpoint) AS n FROM requests)
SELECT endpoint, latency AS percentile FROM r WHERE rn = CAST(floor(n * CAST(0.99 AS DOUBLE)) AS BIGINT) + 1""")
def _(spark, sf):
    return e.index_percentile(v.requests(spark, sf), ["endpoint"], "latency")


@query("exp_8_side_by_side", f"""WITH {LOG},
m AS (SELECT variant AS run, CAST(count(*) AS DOUBLE) AS requests, avg(latency) AS latency, max(latency) AS worst FROM requests GROUP BY 1),
u AS (UNPIVOT m ON requests, latency, worst INTO NAME metric VALUE value)
SELECT metric, round(max(value) FILTER (run = 'baseline'), 6) AS baseline, round(max(value) FILTER (run = 'canary'), 6) AS canary FROM u GROUP BY 1""")
def _(spark, sf):
    per = v.requests(spark, sf).groupBy(F.col("variant").alias("run")).agg(
        F.count(F.lit(1)).cast("double").alias("requests"), F.avg("latency").alias("latency"), F.max("latency").alias("worst")
    )
    out = e.side_by_side(per.unpivot(["run"], ["requests", "latency", "worst"], "metric", "value"), ["baseline", "canary"])
    return out.withColumns({"baseline": r6("baseline"), "canary": r6("canary")})
