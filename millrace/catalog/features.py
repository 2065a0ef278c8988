"""Feature queries."""

from pyspark.sql import functions as F

from millrace.catalog.registry import query, r6, table
from millrace.catalog.sinks import SPLIT, customer_split
from millrace.operators import features as f
from millrace.session import materialise


@query("fea_1_impute", """
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS size, CASE WHEN p_partkey % 11 <> 0 THEN p_brand END AS brand FROM part)
SELECT p_partkey, coalesce(CAST(size AS DOUBLE), (SELECT quantile_cont(size, 0.5) FROM p)) AS size,
  coalesce(brand, (SELECT brand FROM p WHERE brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, brand LIMIT 1)) AS brand FROM p""")
def _(spark, sf):
    key = F.col("p_partkey")
    rows = table(spark, sf, "part").select(
        "p_partkey", F.when(key % 7 != 0, F.col("p_size").cast("double")).alias("size"), F.when(key % 11 != 0, F.col("p_brand")).alias("brand")
    )
    return f.impute(rows, ["size"], ["brand"])


@query("fea_2_fixed_bins", """
SELECT p_partkey, CASE WHEN p_size * 2 - 2 > 0 AND p_size * 2 - 2 <= 12 THEN '(0, 12]' WHEN p_size * 2 - 2 > 12 AND p_size * 2 - 2 <= 24 THEN '(12, 24]'
  WHEN p_size * 2 - 2 > 24 AND p_size * 2 - 2 <= 48 THEN '(24, 48]' WHEN p_size * 2 - 2 > 48 AND p_size * 2 - 2 <= 72 THEN '(48, 72]' ELSE 'nan' END AS bin FROM part""")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", f.fixed_bins(F.col("p_size") * 2 - 2, [0, 12, 24, 48, 72]).alias("bin"))


@query("fea_3_equal_width", """
WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(greatest(ceil((l_quantity - lo) * 4 / (hi - lo)) - 1, 0) AS INT) AS bin FROM lineitem, s""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return f.equal_width_bins(rows, "l_quantity", 4).drop("l_quantity")


@query("fea_4_ratios", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity / (l_extendedprice + 1), 6) AS ratio,
  round(l_discount + l_tax + CASE WHEN l_linenumber > 3 THEN 0 ELSE l_quantity END, 6) AS score FROM lineitem""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("q", F.when(F.col("l_linenumber") <= 3, F.col("l_quantity")))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6(f.ratio(F.col("l_quantity"), F.col("l_extendedprice"))).alias("ratio"),
        r6(f.present_sum(["l_discount", "l_tax", "q"])).alias("score"),
    )


@query("fea_5_label_encode", """
WITH m AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS code FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY') d)
SELECT c_custkey, c.c_mktsegment, CAST(coalesce(code, 0) AS INT) AS c_mktsegment_code FROM customer c LEFT JOIN m ON m.c_mktsegment = c.c_mktsegment""")
def _(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    mapping = f.fit_labels(rows.where("c_mktsegment <> 'MACHINERY'"), "c_mktsegment")
    return f.encode_labels(rows, "c_mktsegment", mapping)


@query("fea_6_standard_scale", """
WITH s AS (SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(l_extendedprice) AS pm, stddev_pop(l_extendedprice) AS ps FROM lineitem WHERE l_orderkey % 2 = 0)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_quantity - qm) / qs, 6) + 0 AS l_quantity, round((l_extendedprice - pm) / ps, 6) + 0 AS l_extendedprice FROM lineitem, s""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    columns = ["l_quantity", "l_extendedprice"]
    fitted = materialise(f.fit_scaler(rows.where("l_orderkey % 2 = 0"), columns), "scaler")
    return f.scale(rows, columns, fitted).withColumns({c: r6(c) for c in columns})


@query("fea_7_stratified_split", f"WITH {SPLIT} SELECT c_custkey, c_mktsegment, split FROM s")
def _(spark, sf):
    return customer_split(spark, sf)


@query("fea_10_shards", """
WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position, count(*) OVER () AS total FROM documents),
p AS (SELECT doc_id, position FROM n UNION ALL SELECT doc_id, position + total FROM n WHERE position < ceil(total / 7.0) * 7 - total)
SELECT doc_id, position, CAST(position % 7 AS INT) AS rank FROM p""")
def _(spark, sf):
    return f.shard(table(spark, sf, "documents"), "doc_id", 7)


@query("fea_10_shards_drop_last", """
WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position, count(*) OVER () AS total FROM documents)
SELECT doc_id, position, CAST(position % 7 AS INT) AS rank FROM n WHERE position < floor(total / 7.0) * 7""")
def _(spark, sf):
    return f.shard(table(spark, sf, "documents"), "doc_id", 7, drop_last=True)


@query("fea_11_channels", """
WITH e AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(0, len(embedding))) AS c FROM embeddings),
s AS (SELECT c, avg(x) AS m, stddev_pop(x) AS sd FROM e GROUP BY 1)
SELECT vec_id, CAST(e.c AS INT) AS channel, round((x - m) / sd, 6) + 0 AS value FROM e JOIN s ON s.c = e.c""")
def _(spark, sf):
    rows = table(spark, sf, "embeddings")
    stats = f.channel_stats(rows, "embedding", 64)
    fitted = stats.select(F.struct("mean", "std")).scalar()
    scaled = rows.withColumn("s", fitted).select(
        "vec_id", F.posexplode(f.normalise_channels(F.col("embedding"), F.col("s.mean"), F.col("s.std"))).alias("channel", "value")
    )
    return scaled.withColumn("value", r6("value"))
