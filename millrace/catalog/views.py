"""The operational tables the operators work on, mapped from the given tables.

Each view has a DataFrame form and the same thing as SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.catalog.registry import table

# -- cost rows ---------------------------------------------------------------

COST = """
cost AS (
  SELECT l_returnflag AS service, r_name AS region, l_linestatus AS provider,
         CAST(l_extendedprice AS DECIMAL(38,6)) AS amount,
         CAST(l_shipdate AS DATE) AS day, l_shipdate AS ts,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)
"""


def cost_rows(spark: SparkSession, sf: str) -> DataFrame:
    place = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
        .join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
        .select("s_suppkey", "r_name")
    )
    return (
        table(spark, sf, "lineitem")
        .join(place, F.col("s_suppkey") == F.col("l_suppkey"))
        .select(
            F.col("l_returnflag").alias("service"),
            F.col("r_name").alias("region"),
            F.col("l_linestatus").alias("provider"),
            F.col("l_extendedprice").cast("decimal(38,6)").alias("amount"),
            F.to_date("l_shipdate").alias("day"),
            F.col("l_shipdate").alias("ts"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        )
    )


# -- file manifest -----------------------------------------------------------

MANIFEST = """
manifest AS (
  SELECT o_orderkey AS file_id, o_custkey AS session_id,
         CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'UPLOADING' ELSE 'UPLOADED' END AS state,
         CAST(least(CAST(substr(o_orderpriority, 1, 1) AS INT) - 1, 3) AS INT) AS priority,
         CAST(round(o_totalprice * 100) AS BIGINT) AS size_bytes,
         o_orderdate AS created_at
  FROM orders)
"""


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("file_id"),
        F.col("o_custkey").alias("session_id"),
        F.when(status == "O", "PENDING").when(status == "P", "UPLOADING").otherwise("UPLOADED").alias("state"),
        F.least(F.substring("o_orderpriority", 1, 1).cast("int") - 1, F.lit(3)).alias("priority"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("size_bytes"),
        F.col("o_orderdate").alias("created_at"),
    )


# -- telemetry ---------------------------------------------------------------

TELEMETRY = """
telemetry AS (
  SELECT event_id, user_id, ts, event_type, value,
         CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k
  FROM events)
"""


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "user_id", "ts", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


# -- fleet index: one indexed file per robot and hour --------------------------

FLEET = """
fleet AS (
  SELECT 'robot-' || user_id AS robot_id, strftime(date_trunc('hour', ts), '%Y%m%d%H') AS hour,
         min(ts) AS time_start, max(ts) AS time_end,
         list_sort(list_distinct(list(event_type))) AS anomaly_flags,
         CAST(sum(CAST(round(value * 1000) AS BIGINT)) AS BIGINT) AS size_bytes,
         CAST(min(k) % 4 AS INT) AS priority,
         'v' || (max(k) % 3) AS schema_version, 'fw-' || (min(k) // 25) AS firmware_ver
  FROM telemetry GROUP BY ALL)
"""


def fleet(spark: SparkSession, sf: str) -> DataFrame:
    return (
        telemetry(spark, sf)
        .groupBy(
            F.concat(F.lit("robot-"), F.col("user_id")).alias("robot_id"),
            F.date_format("ts", "yyyyMMddHH").alias("hour"),
        )
        .agg(
            F.min("ts").alias("time_start"),
            F.max("ts").alias("time_end"),
            # at most one entry per event type
            F.array_sort(F.collect_set("event_type")).alias("anomaly_flags"),
            F.sum(F.round(F.col("value") * 1000).cast("bigint")).alias("size_bytes"),
            (F.min("k") % 4).cast("int").alias("priority"),
            F.concat(F.lit("v"), F.max("k") % 3).alias("schema_version"),
            F.concat(F.lit("fw-"), F.floor(F.min("k") / 25)).alias("firmware_ver"),
        )
    )


# -- request log ---------------------------------------------------------------

REQUESTS = """
requests AS (
  SELECT event_id, user_id, ts, CASE WHEN user_id % 2 = 0 THEN 'baseline' ELSE 'canary' END AS variant,
         'endpoint-' || (user_id % 5) AS endpoint, 'region-' || (user_id % 3) AS region,
         event_type <> 'error' AS success, value AS latency, event_type,
         CASE WHEN event_type = 'purchase' THEN k / 20.0 END AS feedback, k
  FROM telemetry)
"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry(spark, sf).select(
        "event_id", "user_id", "ts",
        F.when(F.col("user_id") % 2 == 0, "baseline").otherwise("canary").alias("variant"),
        F.concat(F.lit("endpoint-"), F.col("user_id") % 5).alias("endpoint"),
        F.concat(F.lit("region-"), F.col("user_id") % 3).alias("region"),
        (F.col("event_type") != "error").alias("success"),
        F.col("value").alias("latency"), "event_type",
        F.when(F.col("event_type") == "purchase", F.col("k") / F.lit(20.0)).alias("feedback"), "k",
    )


# -- scored documents ------------------------------------------------------------

SCORED = """
scored AS (
  SELECT d.doc_id, quality AS truth, n_chars / (n_chars + 2000.0) AS score,
         CASE WHEN n_chars >= 2000 THEN 1 ELSE 0 END AS predicted,
         quality + toxic AS truth3,
         CASE WHEN n_chars < 1000 THEN 0 WHEN n_chars < 4000 THEN 1 ELSE 2 END AS predicted3,
         lang, source, n_chars, toxic
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars")
    return (
        table(spark, sf, "documents")
        .join(table(spark, sf, "labels"), "doc_id")
        .select(
            "doc_id",
            F.col("quality").alias("truth"),
            (n / (n + F.lit(2000.0))).alias("score"),
            F.when(n >= 2000, 1).otherwise(0).alias("predicted"),
            (F.col("quality") + F.col("toxic")).alias("truth3"),
            F.when(n < 1000, 0).when(n < 4000, 1).otherwise(2).alias("predicted3"),
            "lang", "source", "n_chars", "toxic",
        )
    )


# -- object listings of two regions ------------------------------------------------

LISTING = """
listing_a AS (
  SELECT source || '/' || doc_id AS key, source AS dataset, n_chars AS size, md5(text) AS etag,
         1700000000 + doc_id * 60 AS modified
  FROM documents),
listing_b AS (
  SELECT CASE WHEN doc_id % 17 = 0 THEN 'extra/' || doc_id ELSE source || '/' || doc_id END AS key,
         CASE WHEN doc_id % 17 = 0 THEN 'extra' ELSE source END AS dataset,
         CASE WHEN doc_id % 11 = 0 THEN n_chars + 1 ELSE n_chars END AS size,
         CASE WHEN doc_id % 13 = 0 THEN md5(lang || text) ELSE md5(text) END AS etag,
         1700000000 + doc_id * 60 + doc_id % 500 AS modified
  FROM documents)
"""


def listings(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf, "documents")
    key = F.concat_ws("/", "source", "doc_id")
    d = F.col("doc_id")
    a = docs.select(
        key.alias("key"), F.col("source").alias("dataset"), F.col("n_chars").alias("size"),
        F.md5("text").alias("etag"), (F.lit(1700000000) + d * 60).alias("modified"),
    )
    b = docs.select(
        F.when(d % 17 == 0, F.concat_ws("/", F.lit("extra"), d)).otherwise(key).alias("key"),
        F.when(d % 17 == 0, F.lit("extra")).otherwise(F.col("source")).alias("dataset"),
        F.when(d % 11 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("size"),
        F.when(d % 13 == 0, F.md5(F.concat("lang", "text"))).otherwise(F.md5("text")).alias("etag"),
        (F.lit(1700000000) + d * 60 + d % 500).alias("modified"),
    )
    return a, b


# -- cost of serving requests --------------------------------------------------------

# fixed values: price per gpu hour, vector query, GB sent, 1000 tokens, GB-month stored
GPU_HOUR, VECTOR_QUERY, NETWORK_GB, THOUSAND_TOKENS, STORAGE_GB = 1.0, 0.0001, 0.12, 0.002, 0.10

USAGE = f"""
usage AS (
  SELECT event_id, ts, value / 3600 * {GPU_HOUR} AS gpu_cost, (k % 5) * CAST({VECTOR_QUERY} AS DOUBLE) AS vector_cost,
         k / 1000 * CAST({NETWORK_GB} AS DOUBLE) AS network_cost, CAST(floor(value * 10) AS BIGINT) AS tokens,
         floor(value * 10) / 1000 * {THOUSAND_TOKENS} AS token_cost
  FROM telemetry)
"""


def usage(spark: SparkSession, sf: str) -> DataFrame:
    tokens = F.floor(F.col("value") * 10)
    return telemetry(spark, sf).select(
        "event_id", "ts",
        (F.col("value") / 3600 * GPU_HOUR).alias("gpu_cost"),
        ((F.col("k") % 5) * VECTOR_QUERY).alias("vector_cost"),
        (F.col("k") / 1000 * NETWORK_GB).alias("network_cost"),
        tokens.cast("bigint").alias("tokens"),
        (tokens / 1000 * THOUSAND_TOKENS).alias("token_cost"),
    )
