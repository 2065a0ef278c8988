"""Drift queries: even order keys against odd ones, with one shifted feature."""

from pyspark.sql import functions as F

from millrace.catalog.registry import query, r4, r6, table
from millrace.operators import drift as d

FEATURES = ["quantity", "price", "discount"]

HALVES = """ref AS (SELECT l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount FROM lineitem WHERE l_orderkey % 2 = 0),
cur AS (SELECT l_quantity + 7 AS quantity, l_extendedprice AS price, l_discount AS discount FROM lineitem WHERE l_orderkey % 2 = 1),
sides AS (SELECT feature, value, 1 AS r, 0 AS c FROM (UNPIVOT ref ON quantity, price, discount INTO NAME feature VALUE value)
  UNION ALL SELECT feature, value, 0, 1 FROM (UNPIVOT cur ON quantity, price, discount INTO NAME feature VALUE value))"""

KS = f"""{HALVES}, g AS (SELECT feature, value, sum(r) AS r, sum(c) AS c FROM sides GROUP BY 1, 2),
w AS (SELECT feature, sum(r) OVER (PARTITION BY feature ORDER BY value) AS cr, sum(c) OVER (PARTITION BY feature ORDER BY value) AS cc,
  sum(r) OVER (PARTITION BY feature) AS n, sum(c) OVER (PARTITION BY feature) AS m FROM g),
ks AS (SELECT feature, any_value(n) AS n, any_value(m) AS m, max(abs(cr / n - cc / m)) AS statistic FROM w GROUP BY 1)"""


def halves(spark, sf):
    li = table(spark, sf, "lineitem")
    pick = lambda shift: [(F.col("l_quantity") + shift).alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount")]
    return li.where("l_orderkey % 2 = 0").select(*pick(0)), li.where("l_orderkey % 2 = 1").select(*pick(7))


@query("drf_1_ks_statistic", f"WITH {KS} SELECT feature, CAST(n AS BIGINT) AS n, CAST(m AS BIGINT) AS m, round(statistic, 6) AS statistic, statistic > 0.1 AS drift FROM ks")
def _(spark, sf):
    return d.ks_drift(d.ks_statistic(*halves(spark, sf), FEATURES)).withColumn("statistic", r6("statistic"))


@query("drf_2_ks_decision", f"""WITH {KS},
l AS (SELECT feature, statistic, sqrt(CAST(n AS DOUBLE) * CAST(m AS DOUBLE) / (n + m)) * statistic AS lam FROM ks),
p AS (SELECT feature, statistic, CASE WHEN lam < 0.2 THEN 1 ELSE least(1, greatest(0, 2 * list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0 * k * k * lam * lam))))) END AS p FROM l)
SELECT feature, round(statistic, 6) AS statistic, round(p, 6) + 0 AS p_value, p < 0.05 AS drift FROM p""")
def _(spark, sf):
    out = d.ks_decision(d.ks_statistic(*halves(spark, sf), FEATURES))
    return out.select("feature", r6("statistic").alias("statistic"), r6("p_value").alias("p_value"), "drift")


ORDERS = """l AS (SELECT o_orderpriority || CASE WHEN o_custkey % 50 = 0 THEN '*' ELSE '' END AS c FROM orders WHERE o_orderkey % 2 = 0),
r AS (SELECT o_orderpriority AS c FROM orders WHERE o_orderkey % 2 = 1),
f AS (SELECT coalesce(a.c, b.c) AS c, coalesce(a.s, 0) AS p, coalesce(b.s, 0) AS q FROM (SELECT c, count(*) / (SELECT count(*) FROM l) AS s FROM l GROUP BY 1) a
  FULL JOIN (SELECT c, count(*) / (SELECT count(*) FROM r) AS s FROM r GROUP BY 1) b ON a.c = b.c)"""


def order_halves(spark, sf):
    o = table(spark, sf, "orders")
    odd = F.concat("o_orderpriority", F.when(F.col("o_custkey") % 50 == 0, "*").otherwise(""))
    return o.where("o_orderkey % 2 = 0").select(odd.alias("c")), o.where("o_orderkey % 2 = 1").select(F.col("o_orderpriority").alias("c"))


@query("drf_3_categorical_distance", f"WITH {ORDERS} SELECT round(max(abs(p - q)), 6) AS distance FROM f")
def _(spark, sf):
    return d.categorical_distance(*order_halves(spark, sf), "c").withColumn("distance", r6("distance"))


@query("drf_4_jensen_shannon", f"""WITH {HALVES},
s AS (SELECT feature, min(value) AS lo, max(value) AS hi, sum(r) AS n, sum(c) AS m FROM sides GROUP BY 1),
b AS (SELECT sides.feature, least(floor((value - lo) / ((hi - lo) / 29)), 28) AS bin, sum(r) AS r, sum(c) AS c FROM sides JOIN s ON s.feature = sides.feature GROUP BY 1, 2),
e AS (SELECT s.feature, coalesce(r, 0) / n + 1e-10 AS p, coalesce(c, 0) / m + 1e-10 AS q FROM (SELECT *, unnest(range(0, 29)) AS bin FROM s) s LEFT JOIN b ON b.feature = s.feature AND b.bin = s.bin),
x AS (SELECT feature, p / sum(p) OVER (PARTITION BY feature) AS p, q / sum(q) OVER (PARTITION BY feature) AS q FROM e)
SELECT feature, round(sqrt(sum(0.5 * (p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))))), 6) AS distance FROM x GROUP BY 1""")
def _(spark, sf):
    return d.jensen_shannon_numeric(*halves(spark, sf), FEATURES).withColumn("distance", r6("distance"))


@query("drf_5_jensen_shannon_categorical", f"""WITH {ORDERS}, g AS (SELECT CASE WHEN p = 0 THEN 1e-10 ELSE p END AS p, CASE WHEN q = 0 THEN 1e-10 ELSE q END AS q FROM f),
x AS (SELECT p / sum(p) OVER () AS p, q / sum(q) OVER () AS q FROM g)
SELECT round(sqrt(sum(0.5 * (p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))))), 6) AS distance FROM x""")
def _(spark, sf):
    return d.jensen_shannon_categorical(*order_halves(spark, sf), "c").withColumn("distance", r6("distance"))


@query("drf_6_stability_index", f"""WITH {HALVES},
s AS (SELECT feature, min(value) FILTER (r = 1) AS lo, max(value) FILTER (r = 1) AS hi, sum(r) AS n, sum(c) AS m FROM sides GROUP BY 1),
b AS (SELECT sides.feature, least(floor((value - lo) / ((hi - lo) / 10)), 9) AS bin, sum(r) AS r, sum(c) AS c FROM sides JOIN s ON s.feature = sides.feature WHERE value BETWEEN lo AND hi GROUP BY 1, 2),
e AS (SELECT s.feature, CASE WHEN coalesce(r, 0) = 0 THEN 1e-10 ELSE r / n END AS p, CASE WHEN coalesce(c, 0) = 0 THEN 1e-10 ELSE c / m END AS q
  FROM (SELECT *, unnest(range(0, 10)) AS bin FROM s) s LEFT JOIN b ON b.feature = s.feature AND b.bin = s.bin)
SELECT feature, round(sum((q - p) * ln(q / p)), 6) AS psi, sum((q - p) * ln(q / p)) > 0.25 AS drift FROM e GROUP BY 1""")
def _(spark, sf):
    return d.stability_index(*halves(spark, sf), FEATURES).withColumn("psi", r6("psi"))


@query("drf_7_prediction_drift_classes", """
WITH a AS (SELECT quality AS x FROM labels WHERE doc_id % 2 = 0), b AS (SELECT quality AS x FROM labels WHERE doc_id % 2 = 1),
f AS (SELECT c, (SELECT count(*) FROM a WHERE x = c) / (SELECT count(*) FROM a) AS p, (SELECT count(*) FROM b WHERE x = c) / (SELECT count(*) FROM b) AS q FROM (VALUES (0), (1)) v(c))
SELECT 'jensen_shannon' AS method, round(sqrt(sum(0.5 * (p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))))), 6) AS score,
  (SELECT round(avg(x), 6) FROM a) AS reference_mean, (SELECT round(stddev_pop(x), 6) FROM a) AS reference_std,
  (SELECT round(avg(x), 6) FROM b) AS current_mean, (SELECT round(stddev_pop(x), 6) FROM b) AS current_std FROM f""")
def _(spark, sf):
    rows = table(spark, sf, "labels")
    out = d.prediction_drift(rows.where("doc_id % 2 = 0").select("quality"), rows.where("doc_id % 2 = 1").select("quality"), "quality")
    return out.withColumns({c: r6(c) for c in out.columns if c != "method"})


@query("drf_7_prediction_drift_scores", """
WITH a AS (SELECT n_chars AS x FROM documents WHERE doc_id % 2 = 0), b AS (SELECT n_chars AS x FROM documents WHERE doc_id % 2 = 1),
g AS (SELECT x, sum(r) AS r, sum(c) AS c FROM (SELECT x, 1 AS r, 0 AS c FROM a UNION ALL SELECT x, 0, 1 FROM b) u GROUP BY 1),
w AS (SELECT sum(r) OVER (ORDER BY x) / sum(r) OVER () AS p, sum(c) OVER (ORDER BY x) / sum(c) OVER () AS q FROM g)
SELECT 'ks' AS method, round(max(abs(p - q)), 6) AS score, (SELECT round(avg(x), 6) FROM a) AS reference_mean, (SELECT round(stddev_pop(x), 4) FROM a) AS reference_std,
  (SELECT round(avg(x), 6) FROM b) AS current_mean, (SELECT round(stddev_pop(x), 4) FROM b) AS current_std FROM w""")
def _(spark, sf):
    rows = table(spark, sf, "documents")
    out = d.prediction_drift(rows.where("doc_id % 2 = 0").select("n_chars"), rows.where("doc_id % 2 = 1").select("n_chars"), "n_chars")
    return out.withColumns({
        **{c: r6(c) for c in ("score", "reference_mean", "current_mean")}, **{c: r4(c) for c in ("reference_std", "current_std")}
    })


@query("drf_8_summary", f"""WITH {KS}
SELECT bool_or(statistic > 0.1) AS any_drift, count(*) FILTER (statistic > 0.1) AS drifted, coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (statistic > 0.1), '') AS names,
  round(avg(CASE WHEN statistic > 0.1 THEN 1 ELSE 0 END) * 100, 6) AS percentage,
  string_agg(feature || '=' || CAST(round(statistic * 10000) AS BIGINT), ',' ORDER BY feature) AS scores FROM ks""")
def _(spark, sf):
    out = d.drift_summary(d.ks_drift(d.ks_statistic(*halves(spark, sf), FEATURES)))
    score = lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 10000).cast("bigint"))
    scores = F.array_join(F.transform(F.array_sort(F.map_entries("scores")), score), ",")
    return out.withColumn("percentage", r6("percentage")).withColumn("scores", scores)


@query("drf_9_accuracy_degradation", """
WITH p AS (SELECT CASE WHEN n_chars >= 2000 THEN 1 ELSE 0 END AS predicted, quality AS truth FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
m AS (SELECT count(*) AS samples, avg(CASE WHEN predicted = truth THEN 1 ELSE 0 END) AS a, count(*) FILTER (predicted = 1 AND truth = 1) / count(*) FILTER (predicted = 1) AS pr,
  count(*) FILTER (predicted = 1 AND truth = 1) / count(*) FILTER (truth = 1) AS re FROM p)
SELECT samples, round(a, 6) AS accuracy, round(pr, 6) AS precision, round(re, 6) AS recall, round(2 * pr * re / (pr + re), 6) AS f1, samples >= 100 AND 0.9 - a > 0.1 AS degraded FROM m""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") >= 2000, 1).otherwise(0).alias("predicted"))
    pairs = docs.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("truth")), "doc_id")
    out = d.accuracy_degradation(pairs, 0.9)
    return out.withColumns({c: r6(c) for c in ("accuracy", "precision", "recall", "f1")})
