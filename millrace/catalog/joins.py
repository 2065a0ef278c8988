"""Join queries."""

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.registry import query, r6, table
from millrace.operators import joins as j


@query("jon_1_predictions", """
WITH p AS (SELECT d.doc_id, CASE WHEN n_chars >= 2000 THEN 1 ELSE 0 END AS predicted, quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
SELECT count(*) AS samples, count(*) >= 100 AS enough, CASE WHEN count(*) >= 100 THEN round(avg(CASE WHEN predicted = quality THEN 1 ELSE 0 END), 6) END AS accuracy FROM p""")
def _(spark, sf):
    pred = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") >= 2000, 1).otherwise(0).alias("predicted"))
    truth = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("truth"))
    return j.pair_predictions(pred, truth, "doc_id").withColumn("accuracy", r6("accuracy"))


@query("jon_2_orphans_ghosts", """
WITH m AS (SELECT o_orderkey AS file_id, CASE o_orderstatus WHEN 'F' THEN 'DELETED' WHEN 'O' THEN 'PENDING' ELSE 'UPLOADED' END AS state FROM orders),
d AS (SELECT DISTINCT l_orderkey + 50 AS file_id FROM lineitem)
SELECT file_id, 'orphan' AS kind, 'PENDING' AS new_state FROM d WHERE file_id NOT IN (SELECT file_id FROM m)
UNION ALL SELECT file_id, 'ghost', 'EVICTED' FROM m WHERE state NOT IN ('DELETED', 'EVICTED') AND file_id NOT IN (SELECT file_id FROM d)""")
def _(spark, sf):
    s = F.col("o_orderstatus")
    manifest = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("file_id"), F.when(s == "F", "DELETED").when(s == "O", "PENDING").otherwise("UPLOADED").alias("state")
    )
    disk = table(spark, sf, "lineitem").select((F.col("l_orderkey") + 50).alias("file_id"))
    return j.orphans_and_ghosts(manifest, disk, "file_id")


COMPARED = f"""{v.LISTING}, c AS (SELECT coalesce(a.key, b.key) AS key, CASE WHEN b.key IS NULL THEN 'missing_in_target'
  WHEN a.key IS NULL THEN 'extra_in_target' WHEN a.size <> b.size THEN 'size_mismatch' END AS kind FROM listing_a a FULL JOIN listing_b b ON a.key = b.key)"""


@query("jon_3_listing_compare", f"WITH {COMPARED} SELECT key, kind FROM c WHERE kind IS NOT NULL")
def _(spark, sf):
    return j.compare_listings(*v.listings(spark, sf))


@query("jon_3_sync_report", f"""WITH {COMPARED}
SELECT count(*) FILTER (kind = 'missing_in_target') AS missing_in_target, count(*) FILTER (kind = 'extra_in_target') AS extra_in_target,
  count(*) FILTER (kind = 'size_mismatch') AS size_mismatch, count(kind) = 0 AS in_sync FROM c""")
def _(spark, sf):
    return j.sync_report(*v.listings(spark, sf))


CAPTURE = f"""{v.TELEMETRY}, files AS (SELECT user_id, event_id AS file_id, epoch_us(ts) AS at, CAST(k % 4 AS INT) AS priority FROM telemetry WHERE event_type IN ('view', 'click')),
alarms AS (SELECT user_id, epoch_us(ts) AS at, CASE WHEN k % 2 = 0 THEN 3600000000 ELSE 7200000000 END AS pre,
  CASE WHEN k % 2 = 0 THEN 1800000000 ELSE 0 END AS post, CAST(k % 2 AS INT) AS priority FROM telemetry WHERE event_type = 'error')"""


def capture(spark, sf):
    t = v.telemetry(spark, sf).withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    even = F.col("k") % 2 == 0
    files = t.where(F.col("event_type").isin("view", "click")).select(
        "user_id", F.col("event_id").alias("file_id"), "at", (F.col("k") % 4).cast("int").alias("priority")
    )
    alarms = t.where(F.col("event_type") == "error").select(
        "user_id", "event_id", "at", F.when(even, 3600000000).otherwise(7200000000).alias("pre"),
        F.when(even, 1800000000).otherwise(0).alias("post"), (F.col("k") % 2).cast("int").alias("priority"),
    )
    return files, alarms


@query("jon_4_interval_promotion", f"""WITH {CAPTURE}
SELECT f.user_id, f.file_id, f.priority, min(a.priority) AS new_priority, CAST(100 AS DOUBLE) AS score
FROM files f JOIN alarms a ON a.user_id = f.user_id AND f.at BETWEEN a.at - a.pre AND a.at + a.post AND a.priority < f.priority
WHERE CASE WHEN f.file_id % 5 = 0 THEN 'UPLOADED' WHEN f.file_id % 7 > 0 THEN 'PENDING' END = 'PENDING' GROUP BY ALL""")
def _(spark, sf):
    files, alarms = capture(spark, sf)
    state = F.when(F.col("file_id") % 5 == 0, "UPLOADED").when(F.col("file_id") % 7 > 0, "PENDING")
    return j.promote_in_windows(files.withColumn("state", state), alarms, "user_id", state="state")


@query("jon_5_category_union", """
WITH l AS (SELECT o_orderpriority || CASE WHEN o_custkey % 50 = 0 THEN '*' ELSE '' END AS c FROM orders WHERE o_orderkey % 2 = 0),
r AS (SELECT o_orderpriority AS c FROM orders WHERE o_orderkey % 2 = 1),
a AS (SELECT c, count(*) / (SELECT count(*) FROM l) AS s FROM l GROUP BY 1), b AS (SELECT c, count(*) / (SELECT count(*) FROM r) AS s FROM r GROUP BY 1)
SELECT coalesce(a.c, b.c) AS category, round(coalesce(a.s, 0), 6) AS reference, round(coalesce(b.s, 0), 6) AS current FROM a FULL JOIN b ON a.c = b.c""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    odd = F.concat("o_orderpriority", F.when(F.col("o_custkey") % 50 == 0, "*").otherwise(""))
    left = o.where("o_orderkey % 2 = 0").select(odd.alias("c"))
    right = o.where("o_orderkey % 2 = 1").select(F.col("o_orderpriority").alias("c"))
    out = j.category_frequencies(left, right, "c")
    return out.withColumns({"reference": r6("reference"), "current": r6("current")})


REPLICAS = """copies AS (SELECT doc_id, 'us' AS region, 1700000000 + doc_id * 60 AS modified FROM documents
  UNION ALL SELECT doc_id, 'eu', 1700000000 + doc_id * 60 + doc_id % 500 FROM documents WHERE doc_id % 7 <> 0
  UNION ALL SELECT doc_id, 'ap', 1700000000 + doc_id * 60 - doc_id % 90 FROM documents WHERE doc_id % 5 <> 0)"""


def replicas(spark, sf):
    d = F.col("doc_id")
    held = F.array(
        F.struct(F.lit("us").alias("region"), (F.lit(1700000000) + d * 60).alias("modified")),
        F.when(d % 7 != 0, F.struct(F.lit("eu").alias("region"), (F.lit(1700000000) + d * 60 + d % 500).alias("modified"))),
        F.when(d % 5 != 0, F.struct(F.lit("ap").alias("region"), (F.lit(1700000000) + d * 60 - d % 90).alias("modified"))),
    )
    rows = table(spark, sf, "documents").select("doc_id", F.explode(held).alias("h")).where("h is not null")
    return rows.select("doc_id", "h.region", "h.modified")


@query("jon_6_replication_lag", f"""WITH {REPLICAS}
SELECT s.doc_id, s.region AS source, t.region AS target, abs(s.modified - t.modified) AS lag FROM copies s JOIN copies t ON s.doc_id = t.doc_id AND s.region <> t.region""")
def _(spark, sf):
    return j.replication_lag(replicas(spark, sf), "doc_id")


@query("jon_7_compare_runs", """
WITH m AS (SELECT l_returnflag AS run, avg(l_quantity) AS quantity, avg(l_discount) AS discount, avg(l_tax) AS tax, 0.0 AS zero FROM lineitem GROUP BY 1),
x AS (UNPIVOT (SELECT run, quantity, discount, tax, CAST(zero AS DOUBLE) AS zero FROM m) ON quantity, discount, tax, zero INTO NAME metric VALUE value)
SELECT a.metric, round(a.value, 6) AS a, round(b.value, 6) AS b, round(b.value - a.value, 6) + 0 AS difference,
  CASE WHEN a.value = 0 THEN 0 ELSE round((b.value - a.value) / a.value * 100, 6) + 0 END AS percent_change
FROM x a JOIN x b ON a.metric = b.metric WHERE a.run = 'A' AND b.run = 'R'""")
def _(spark, sf):
    per = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("run")).agg(
        F.avg("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"), F.lit(0.0).alias("zero")
    )
    out = j.compare_runs(per.unpivot(["run"], ["quantity", "discount", "tax", "zero"], "metric", "value"), "A", "R")
    return out.withColumns({c: r6(c) for c in ("a", "b", "difference", "percent_change")})


@query("jon_8_missing_copies", """
WITH p AS (SELECT DISTINCT l_partkey AS p_partkey, s_nationkey AS n_nationkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
SELECT t.p_partkey, n.n_nationkey, (SELECT min(n_nationkey) FROM p WHERE p.p_partkey = t.p_partkey) AS source
FROM part t CROSS JOIN nation n WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.p_partkey = t.p_partkey AND p.n_nationkey = n.n_nationkey)""")
def _(spark, sf):
    present = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("s_suppkey") == F.col("l_suppkey")).select(
        F.col("l_partkey").alias("p_partkey"), F.col("s_nationkey").alias("n_nationkey")
    )
    return j.missing_copies(table(spark, sf, "part"), table(spark, sf, "nation"), present, "p_partkey", "n_nationkey")


@query("jon_9_config_compare", """
WITH c AS (SELECT c_nationkey AS region, c_mktsegment AS name, count(*) % 3 AS version, CASE WHEN c_nationkey % 6 <> 5 THEN
  sha256('{"size":"' || (count(*) % 2) || '","tier":"' || (CASE WHEN c_nationkey % 4 = 3 THEN 'b' ELSE 'a' END) || '"}') END AS checksum FROM customer GROUP BY 1, 2)
SELECT c.region, c.name, CASE WHEN c.checksum IS NULL OR r.checksum IS NULL THEN 'missing' WHEN c.version = r.version AND c.checksum = r.checksum THEN 'in_sync' ELSE 'conflict' END AS state
FROM c LEFT JOIN c r ON r.region = 0 AND r.name = c.name WHERE c.region <> 0""")
def _(spark, sf):
    n = F.count(F.lit(1))
    tier = F.when(F.col("c_nationkey") % 4 == 3, "b").otherwise("a")
    counted = table(spark, sf, "customer").groupBy(F.col("c_nationkey"), F.col("c_mktsegment").alias("name")).agg(n.alias("n"))
    settings = F.create_map(F.lit("tier"), tier, F.lit("size"), (F.col("n") % 2).cast("string"))
    configs = counted.select(
        F.col("c_nationkey").alias("region"), "name", (F.col("n") % 3).alias("version"),
        F.when(F.col("c_nationkey") % 6 != 5, j.config_checksum(settings)).alias("checksum"),
    )
    return j.compare_config(configs, 0)


@query("jon_10_range_lookup", f"""WITH {v.TELEMETRY}
SELECT event_id, user_id * 100 + k AS ip, n_name AS geo FROM telemetry LEFT JOIN nation ON user_id * 100 + k BETWEEN n_nationkey * 600 AND n_nationkey * 600 + 499""")
def _(spark, sf):
    n = F.col("n_nationkey").cast("bigint")
    ranges = table(spark, sf, "nation").select((n * 600).alias("start"), (n * 600 + 499).alias("end"), F.col("n_name").alias("geo"))
    points = v.telemetry(spark, sf).select("event_id", (F.col("user_id") * 100 + F.col("k")).alias("ip"))
    return j.range_lookup(points, ranges, "ip", 8)


@query("jon_11_newest_version", """
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, o_orderkey)) AS o_orderkey,
  arg_max(o_orderstatus, (o_orderdate, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, o_orderkey)) AS o_orderstatus FROM orders GROUP BY 1""")
def _(spark, sf):
    copies = table(spark, sf, "orders").withColumn("primary", F.col("o_orderstatus") == "F")
    return j.newest_version(copies, "o_custkey", "o_orderdate", "primary", "o_orderkey", ["o_orderkey", "o_orderstatus"])


@query("jon_12_resolve_conflicts", f"""WITH {v.LISTING},
d AS (SELECT key, CASE length(key) % 3 WHEN 0 THEN 'source_wins' WHEN 1 THEN 'target_wins' ELSE 'manual' END AS strategy FROM listing_a WHERE dataset <> 'src3')
SELECT a.key, CASE WHEN strategy IS NULL THEN 'unresolved' WHEN strategy = 'manual' THEN 'manual' ELSE 'resolved' END AS status,
  CASE strategy WHEN 'source_wins' THEN a.etag WHEN 'target_wins' THEN b.etag END AS etag
FROM listing_a a JOIN listing_b b ON a.key = b.key LEFT JOIN d ON d.key = a.key WHERE a.etag <> b.etag""")
def _(spark, sf):
    a, b = v.listings(spark, sf)
    n = F.length("key") % 3
    decisions = a.where("dataset <> 'src3'").select(
        "key", F.when(n == 0, "source_wins").when(n == 1, "target_wins").otherwise("manual").alias("strategy")
    )
    return j.resolve_conflicts(a, b, decisions)
