"""Scan queries. Files are written from the given tables into the shared folder and read back."""

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.registry import query, r6, table, texts
from millrace.session import new_path
from millrace.sources import scans as s


@query("src_1_csv_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, epoch_us(o_orderdate) AS o_orderdate, o_orderpriority FROM orders")
def _(spark, sf):
    path = new_path(spark, "csv")
    orders = table(spark, sf, "orders")
    orders.write.option("header", True).csv(path)
    schema = ", ".join(f"{n} {t}" for n, t in orders.dtypes)
    return s.csv_scan(spark, path, schema).withColumn("o_orderdate", F.unix_micros(F.col("o_orderdate").cast("timestamp")))


@query("src_2_json_records", "SELECT event_id, user_id, event_type, value, props FROM events")
def _(spark, sf):
    path = new_path(spark, "json")
    table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props").write.json(path)
    return s.json_records(spark, path, "event_id bigint, user_id bigint, event_type string, value double, props string", lines=True)


@query("src_3_sql_source", """
SELECT n_name, count(*) AS customers, round(avg(c_acctbal), 6) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def _(spark, sf):
    sql = "SELECT n_name, count(*) AS customers, avg(c_acctbal) AS balance FROM {c} JOIN {n} ON c_nationkey = n_nationkey GROUP BY 1"
    out = s.sql_source(spark, sql, c=table(spark, sf, "customer"), n=table(spark, sf, "nation"))
    return out.withColumn("balance", r6("balance"))


def write_documents(spark, sf, path):
    """One text file per source and slot, documents in order, written in balanced tasks."""
    docs = table(spark, sf, "documents").withColumn("slot", F.col("doc_id") % 8)
    docs.repartition("source", "slot").sortWithinPartitions("source", "slot", "doc_id").select(
        "text", "source", "slot"
    ).write.partitionBy("source", "slot").text(path)


@query("src_4_directory_loader", """
WITH files AS (SELECT string_agg(text, chr(10) ORDER BY doc_id) || chr(10) AS text FROM documents GROUP BY source, doc_id % 8),
rows AS (SELECT 'p_partkey: ' || p_partkey || ' | p_name: ' || p_name || ' | p_brand: ' || p_brand || ' | p_type: ' || p_type || ' | p_size: ' || p_size || ' | p_retailprice: ' || p_retailprice AS text FROM part)
SELECT 'txt' AS file_type, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(0 AS BIGINT) AS errors FROM files
UNION ALL SELECT 'csv', count(*), CAST(sum(length(text)) AS BIGINT), 0 FROM rows""")
def _(spark, sf):
    path = new_path(spark, "mixed")
    write_documents(spark, sf, f"{path}/text")
    table(spark, sf, "part").write.option("header", True).csv(f"{path}/rows")
    table(spark, sf, "nation").agg(F.to_json(F.sort_array(F.collect_list(F.struct("*")))).alias("j")).select("j").write.text(f"{path}/skip_me")
    docs = s.load_directory(spark, path, exclude=["skip_me"])
    kind = F.element_at("metadata", "file_type")
    return docs.groupBy(kind.alias("file_type")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("chars"), F.count("error").alias("errors")
    )


@query("src_5_whole_text", """
SELECT source, doc_id % 8 AS slot, md5(string_agg(text, chr(10) ORDER BY doc_id) || chr(10)) AS digest, 'text' AS file_type FROM documents GROUP BY ALL""")
def _(spark, sf):
    path = new_path(spark, "text")
    write_documents(spark, sf, path)
    docs = s.whole_text(spark, path)
    return docs.select(
        F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"), F.regexp_extract("path", "slot=([0-9]+)/", 1).cast("bigint").alias("slot"),
        F.md5("text").alias("digest"), F.element_at("metadata", "file_type").alias("file_type"),
    )


@query("src_6_html_regex", r"""
WITH b AS (SELECT page_id, html, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', chr(10), 'g') AS t FROM pages)
SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, md5(regexp_replace(regexp_replace(t, '[ \t]*\n\s*', chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS digest FROM b""")
def _(spark, sf):
    parts = s.html_documents_regex(F.col("html"))
    return table(spark, sf, "pages").select("page_id", parts["title"].alias("title"), F.md5(parts["text"]).alias("digest"))


@query("src_6_html_parser", r"""
WITH b AS (SELECT page_id, url, html, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', chr(1), 'g'), '(?s)<!--.*?-->', chr(1), 'g'), '</?[a-zA-Z!][^>]*>', chr(1), 'g') AS t FROM pages),
p AS (SELECT page_id, url, html, list_filter(list_transform(string_split(t, chr(1)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS p FROM b),
x AS (SELECT page_id, url, nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '') AS title, array_to_string(p, chr(10)) AS text FROM p),
d AS (SELECT page_id, url, replace(replace(title, '&quot;', '"'), '&copy;', '©') AS title, replace(replace(replace(text, '&quot;', '"'), '&copy;', '©'), '&middot;', '·') AS text FROM x)
SELECT page_id, coalesce(regexp_replace(title, '&amp;?', '&', 'g'), url) AS title, regexp_replace(text, '&amp;?', '&', 'g') AS text FROM d""")
def _(spark, sf):
    return s.html_documents(table(spark, sf, "pages"), "page_id", "html", F.col("url"))


@query("src_7_markdown", r"""
WITH m AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE 'intro' || chr(10) || '# Heading ' || doc_id || chr(10) || '# Second' || chr(10) || text END AS text, 'file-' || doc_id AS f FROM documents)
SELECT doc_id, coalesce(nullif(regexp_extract(text, '(?m)^# (.*)$', 1), ''), f) AS title, md5(text) AS digest FROM m""")
def _(spark, sf):
    d = F.col("doc_id")
    head = F.concat(F.lit("intro\n# Heading "), d, F.lit("\n# Second\n"), "text")
    docs = table(spark, sf, "documents").select("doc_id", F.when(d % 3 == 0, F.col("text")).otherwise(head).alias("text"))
    title = s.markdown_title(F.col("text"), F.concat(F.lit("file-"), d))
    return docs.select("doc_id", title.alias("title"), F.md5("text").alias("digest"))


@query("src_8_csv_documents", """
SELECT 'part_' || p_partkey AS doc_id, 'p_partkey: ' || p_partkey || ' | p_name: ' || p_name || ' | p_brand: ' || p_brand || ' | p_type: ' || p_type || ' | p_size: ' || p_size AS text,
  CAST(p_partkey AS VARCHAR) AS row_number, p_brand AS brand FROM part""")
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    docs = s.csv_row_documents(rows, "part", F.col("p_partkey"))
    return docs.select("doc_id", "text", F.col("metadata")["row_number"].alias("row_number"), F.col("metadata")["p_brand"].alias("brand"))


@query("src_9_json_documents", r"""
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'event ' || event_type ELSE props END AS text, regexp_extract(props, '(\d+)', 1) AS k FROM events
UNION ALL SELECT event_id, 'second', NULL FROM events WHERE event_id % 10 = 0""")
def _(spark, sf):
    record = F.when(
        F.col("event_id") % 2 == 0,
        F.concat(F.lit('{"text": "event '), "event_type", F.lit('", '), F.expr("substring(props, 2)")),
    ).otherwise(F.col("props"))
    several = F.concat(F.lit("["), record, F.lit(', {"text": "second"}]'))
    records = F.when(F.col("event_id") % 10 == 0, several).otherwise(record)
    items = table(spark, sf, "events").select("event_id", F.explode(s.json_items(records)).alias("item"))
    parts = s.json_documents(F.col("item"), "text")
    return items.select("event_id", parts["text"].alias("text"), parts["metadata"]["k"].alias("k"))


@query("src_10_object_listing", """
SELECT source, doc_id % 8 AS slot, CAST(sum(strlen(text) + 1) AS BIGINT) AS size FROM documents GROUP BY ALL""")
def _(spark, sf):
    path = new_path(spark, "objects")
    write_documents(spark, sf, path)
    listed = s.object_listing(spark, path).where("size > 0 and key like '%part-%'")
    return listed.select(
        F.regexp_extract("key", "source=([^/]+)/", 1).alias("source"), F.regexp_extract("key", "slot=([0-9]+)/", 1).cast("bigint").alias("slot"), "size"
    )


NAMES = f"""{v.TELEMETRY}, names AS (SELECT event_id, k, event_type, user_id,
  CASE event_id % 4 WHEN 0 THEN 'up/raw/robot-' || user_id || '/s' || user_id || '/r_' || epoch_us(ts) // 1000 || '_x_p' || (k % 4) || '_' || event_type || '.mcap'
   WHEN 1 THEN 'robot-' || user_id || '_' || epoch_us(ts) // 1000 || '_s' || user_id || '_p' || (k % 4) || '_anomaly-' || event_type || '_12.mcap.zst'
   WHEN 2 THEN 'X_' || epoch_us(ts) // 1000 || '_s' || user_id || '_pz_collision.mcap' ELSE 'robot-' || user_id || '.mcap' END AS name FROM telemetry)"""


def names(spark, sf):
    e, ms = F.col("event_id") % 4, F.unix_millis(F.col("ts").cast("timestamp"))
    robot, session = F.concat(F.lit("robot-"), "user_id"), F.concat(F.lit("s"), "user_id")
    prio = F.concat(F.lit("p"), F.col("k") % 4)
    deep = F.concat(F.lit("up/raw/"), robot, F.lit("/"), session, F.lit("/r_"), ms, F.lit("_x_"), prio, F.lit("_"), "event_type", F.lit(".mcap"))
    flat = F.concat(robot, F.lit("_"), ms, F.lit("_"), session, F.lit("_"), prio, F.lit("_anomaly-"), "event_type", F.lit("_12.mcap.zst"))
    odd = F.concat(F.lit("X_"), ms, F.lit("_"), session, F.lit("_pz_collision.mcap"))
    name = F.when(e == 0, deep).when(e == 1, flat).when(e == 2, odd).otherwise(F.concat(robot, F.lit(".mcap")))
    return v.telemetry(spark, sf).select("event_id", "k", "event_type", "user_id", name.alias("name"))


@query("src_11_object_names", rf"""WITH {NAMES}
SELECT event_id, CASE event_id % 4 WHEN 2 THEN 'unknown' ELSE 'robot-' || user_id END AS robot_id, CASE event_id % 4 WHEN 3 THEN 'unknown' ELSE 's' || user_id END AS session_id,
  CAST(CASE WHEN event_id % 4 < 2 THEN k % 4 ELSE 3 END AS INT) AS priority, CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'anomaly-' || event_type ELSE 'unknown' END AS data_type,
  CASE event_id % 4 WHEN 1 THEN 'anomaly-' || event_type ELSE '' END AS flags, CASE WHEN event_id % 4 < 2 THEN CAST(regexp_extract(name, '_(\d+)_', 1) AS BIGINT) END AS start_ms FROM names""")
def _(spark, sf):
    p = s.parse_object_name(F.col("name"))
    return names(spark, sf).select(
        "event_id", *[p[c].alias(c) for c in ("robot_id", "session_id", "priority", "data_type", "start_ms")],
        F.array_join(p["anomaly_flags"], ",").alias("flags"),
    )


@query("src_12_trailer_merge", f"""WITH {NAMES}
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'tr-' || k WHEN event_id % 4 = 2 THEN 'unknown' ELSE 'robot-' || user_id END AS robot_id,
  CASE WHEN event_id % 5 = 0 THEN 'blob' WHEN event_id % 4 = 3 THEN 'unknown' ELSE 's' || user_id END AS session_id,
  CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'anomaly-' || event_type ELSE 'unknown' END AS data_type FROM names""")
def _(spark, sf):
    e = F.col("event_id")
    trailer = F.when(e % 3 == 0, F.concat(F.lit('\u0001\u0002{"robot_id": "tr-'), "k", F.lit('", "n": 1}\u0000'))).otherwise('xx{"other": 1}')
    blob = F.when(e % 5 == 0, F.create_map(F.lit("session_id"), F.lit("blob")))
    merged = s.merge_metadata(F.col("name"), blob, trailer)
    return names(spark, sf).select("event_id", *[c.alias(n) for n, c in merged.items()])


@query("src_13_billing_scan", f"""WITH {v.COST}
SELECT service, CASE WHEN region = 'ASIA' THEN 'global' ELSE region END AS region, 'USD' AS currency,
  CAST(sum(CASE WHEN service = 'N' THEN -amount ELSE amount END) AS DOUBLE) AS amount FROM cost
WHERE ts >= TIMESTAMP '1996-01-01' AND ts <= TIMESTAMP '1999-12-31' GROUP BY ALL HAVING sum(CASE WHEN service = 'N' THEN -amount ELSE amount END) > 0""")
def _(spark, sf):
    billing = v.cost_rows(spark, sf).select(
        "service", F.when(F.col("region") != "ASIA", F.col("region")).alias("region"), F.lit("USD").alias("currency"), "ts",
        F.when(F.col("service") == "N", -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
    )
    return s.billing_scan(billing, "1996-01-01 00:00:00", "1999-12-31 00:00:00").withColumn("amount", F.col("amount").cast("double"))


@query("src_14_metric_log", r"""
SELECT event_id AS step, 'loss' AS name, value FROM events UNION ALL SELECT event_id, 'k', CAST(regexp_extract(props, '(\d+)', 1) AS DOUBLE) FROM events WHERE event_type = 'click'""")
def _(spark, sf):
    from millrace.sources.sinks import append_metrics

    path = new_path(spark, "metrics")
    t = v.telemetry(spark, sf)
    rows = t.select(
        F.col("value").alias("loss"), F.when(F.col("event_type") == "click", F.col("k")).alias("k"), F.col("event_id").alias("step"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("double").alias("timestamp"),
    )
    append_metrics(rows, path)
    return s.metric_log(spark, path, ["loss", "k"]).select("step", "name", "value")


@query("src_15_embedding_source", """
SELECT d.doc_id, e.vec_id IS NOT NULL AS supplied FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id WHERE e.vec_id IS NOT NULL OR length(d.text) > 100""")
def _(spark, sf):
    from millrace.functions.udfs import hashing_embedder

    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    docs = texts(spark, sf).select("doc_id", "text").join(vectors, "doc_id", "left")
    docs = docs.withColumn("supplied", F.col("embedding").isNotNull())
    embed = hashing_embedder(64)
    fill = lambda df: df.withColumn("embedding", F.when(F.length("text") > 100, embed(F.col("text"))))
    return s.with_embeddings(docs, "embedding", fill).select("doc_id", "supplied")
