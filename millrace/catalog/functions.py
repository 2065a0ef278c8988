"""Scalar function queries."""

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.registry import query, r6, table, texts
from millrace.functions import text as t
from millrace.functions import values as val


def docs_with(spark, sf, *extra):
    """Documents with a literal appended, so that the function has something to do."""
    return texts(spark, sf).select("doc_id", F.concat(F.col("text"), *extra).alias("text"))


def digest(df, column):
    return df.select("doc_id", F.md5(column).alias("digest"), F.length(column).cast("bigint").alias("chars"))


SHAPE = "md5(x) AS digest, length(x) AS chars"


@query("fun_1_whitespace", rf"""
WITH d AS (SELECT doc_id, '  ' || text || '   A  b' || chr(10) || chr(10) || chr(10) || 'c   ' AS text FROM documents),
c AS (SELECT doc_id, lower(regexp_replace(regexp_replace(regexp_replace(text, ' +', ' ', 'g'), '\n\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS x FROM d)
SELECT doc_id, {SHAPE} FROM c""")
def _(spark, sf):
    docs = texts(spark, sf).select("doc_id", F.concat(F.lit("  "), "text", F.lit("   A  b\n\n\nc   ")).alias("text"))
    return digest(docs, t.clean_whitespace(F.col("text"), lower=True))


@query("fun_2_remove_urls", rf"""
WITH d AS (SELECT doc_id, text || ' see http://host.example.com/a?x=' || doc_id || '&y=%20z or https://b.example/~c end' AS text FROM documents),
c AS (SELECT doc_id, regexp_replace(text, 'http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+', '', 'g') AS x FROM d)
SELECT doc_id, {SHAPE} FROM c""")
def _(spark, sf):
    docs = docs_with(spark, sf, F.lit(" see http://host.example.com/a?x="), F.col("doc_id"), F.lit("&y=%20z or https://b.example/~c end"))
    return digest(docs, t.remove_urls(F.col("text")))


@query("fun_2_page_urls", r"""
SELECT page_id, regexp_replace('at ' || url || ' ok', 'http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+', '', 'g') AS rest FROM pages""")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", t.remove_urls(F.concat(F.lit("at "), "url", F.lit(" ok"))).alias("rest"))


@query("fun_3_remove_emails", rf"""
WITH c AS (SELECT doc_id, regexp_replace(text || ' mail a.b@c.org now', '\S+@\S+', '', 'g') AS x FROM documents) SELECT doc_id, {SHAPE} FROM c""")
def _(spark, sf):
    return digest(docs_with(spark, sf, F.lit(" mail a.b@c.org now")), t.remove_emails(F.col("text")))


@query("fun_4_text_metadata", r"""
WITH w AS (SELECT doc_id, text, list_filter(string_split_regex(lower(text), '\s+'), lambda x: x <> '') AS ws FROM documents)
SELECT doc_id, CAST(length(text) AS INT) AS char_count, CAST(len(ws) AS INT) AS word_count,
  CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS INT) AS line_count,
  CAST(len(regexp_extract_all(text, '[.!?]+')) AS INT) AS sentence_count,
  CASE WHEN len(ws) > 0 THEN len(list_filter(ws, lambda x: x IN ('the', 'a', 'an', 'and', 'or', 'but', 'in', 'on', 'at'))) / len(ws) > 0.05 END AS likely_english FROM w""")
def _(spark, sf):
    meta = t.text_metadata(F.col("text"))
    return texts(spark, sf).select("doc_id", *[c.alias(n) for n, c in meta.items()])


@query("fun_5_nfkc", f"WITH c AS (SELECT doc_id, nfc_normalize(text) || ' fine ABC 1' AS x FROM documents) SELECT doc_id, {SHAPE} FROM c")
def _(spark, sf):
    docs = docs_with(spark, sf, F.lit(" ﬁne ＡＢＣ ①"))
    return digest(docs, t.nfkc("text"))


@query("fun_6_remove_accents", f"WITH c AS (SELECT doc_id, strip_accents(text) AS x FROM documents) SELECT doc_id, {SHAPE} FROM c")
def _(spark, sf):
    return digest(texts(spark, sf), t.remove_accents("text"))


def contractions_sql(column):
    for short, long in t.CONTRACTIONS.items():
        column = f"regexp_replace({column}, '{short.replace(chr(39), chr(39) * 2)}', '{long}', 'gi')"
    return column


TAILS = [" I can't and DON'T; they'll see it's what's left.", " We've won't You're shouldn't", " nothing here"]


@query("fun_7_contractions", f"""
WITH d AS (SELECT doc_id, text || CASE doc_id % 3 WHEN 0 THEN '{TAILS[0].replace(chr(39), chr(39) * 2)}'
  WHEN 1 THEN '{TAILS[1].replace(chr(39), chr(39) * 2)}' ELSE '{TAILS[2]}' END AS text FROM documents),
c AS (SELECT doc_id, {contractions_sql("text")} AS x FROM d) SELECT doc_id, {SHAPE} FROM c""")
def _(spark, sf):
    tail = F.when(F.col("doc_id") % 3 == 0, TAILS[0]).when(F.col("doc_id") % 3 == 1, TAILS[1]).otherwise(TAILS[2])
    return digest(docs_with(spark, sf, tail), t.expand_contractions(F.col("text")))


@query("fun_8_redact", rf"""
WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text || ' password=p' || doc_id || ' api_key=k1 token=t/2 x', 'password=\S+', 'password=[REDACTED]', 'g'),
  'api_key=\S+', 'api_key=[REDACTED]', 'g'), 'token=\S+', 'token=[REDACTED]', 'g') AS x FROM documents) SELECT doc_id, {SHAPE} FROM c""")
def _(spark, sf):
    docs = docs_with(spark, sf, F.lit(" password=p"), F.col("doc_id"), F.lit(" api_key=k1 token=t/2 x"))
    return digest(docs, t.redact_secrets(F.col("text")))


@query("fun_9_mask_connection", """
SELECT c_custkey, regexp_replace('postgresql://' || c_name || ':pw' || c_custkey || '@db:5432/x', ':([^@]+)@', ':***@', 'g') AS masked FROM customer""")
def _(spark, sf):
    url = F.concat(F.lit("postgresql://"), "c_name", F.lit(":pw"), "c_custkey", F.lit("@db:5432/x"))
    return table(spark, sf, "customer").select("c_custkey", t.mask_connection(url).alias("masked"))


LINES = """lines AS (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' [' || CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END || '] ' ||
  CASE WHEN event_type = 'view' THEN 'cache refreshed' ELSE 'request_id=' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 9, 4)
   || '-' || substr(md5(CAST(event_id AS VARCHAR)), 13, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 17, 4) || '-' || substr(md5(CAST(event_id AS VARCHAR)), 21, 12)
   || ' endpoint=/' || event_type || ' duration=' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS line FROM events)"""


def log_lines(spark, sf):
    m = F.md5(F.col("event_id").cast("string"))
    uuid = F.concat_ws("-", *[F.substring(m, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    request = F.concat(
        F.lit("request_id="), uuid, F.lit(" endpoint=/"), "event_type", F.lit(" duration="),
        F.round(F.col("value") * 100).cast("bigint"),
    )
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" ["),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO"), F.lit("] "),
        F.when(F.col("event_type") == "view", "cache refreshed").otherwise(request),
    )
    return table(spark, sf, "events").select("event_id", line.alias("line"))


@query("fun_10_log_lines", rf"""WITH {LINES},
m AS (SELECT event_id, regexp_extract(line, '^(\S+ \S+) \[(\w+)\] (.*)$', 1) AS timestamp, regexp_extract(line, '^(\S+ \S+) \[(\w+)\] (.*)$', 2) AS log_level,
  regexp_extract(line, '^(\S+ \S+) \[(\w+)\] (.*)$', 3) AS log_message FROM lines)
SELECT *, nullif(regexp_extract(log_message, 'request_id=(\S+)', 1), '') AS request_id, nullif(regexp_extract(log_message, 'endpoint=(\S+)', 1), '') AS endpoint,
  TRY_CAST(regexp_extract(log_message, 'duration=(\S+)', 1) AS DOUBLE) AS duration_ms FROM m""")
def _(spark, sf):
    parts = t.parse_log_line(F.col("line"))
    return log_lines(spark, sf).select("event_id", *[c.alias(n) for n, c in parts.items()])


@query("fun_11_json_lines", r"""
WITH m AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN 'plain ' || props ELSE '{broken' END AS message FROM events)
SELECT event_id, CASE WHEN regexp_matches(message, '^\{.*\}$') THEN CAST(regexp_extract(message, '(\d+)', 1) AS BIGINT) END AS k FROM m""")
def _(spark, sf):
    e = F.col("event_id") % 3
    message = F.when(e == 0, F.col("props")).when(e == 1, F.concat(F.lit("plain "), "props")).otherwise("{broken")
    return table(spark, sf, "events").select("event_id", t.parse_json_line(message, "k bigint")["k"].alias("k"))


@query("fun_12_timestamps", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE epoch_us(date_trunc('second', ts)) END AS iso_us, epoch_us(date_trunc('millisecond', ts)) AS epoch_us FROM events""")
def _(spark, sf):
    ts = F.col("ts").cast("timestamp")
    iso = F.when(F.col("event_id") % 5 == 0, "not a time").otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, sf, "events").select(
        "event_id", F.unix_micros(val.parse_time(iso)).alias("iso_us"),
        F.unix_micros(val.from_epoch_ms(F.unix_millis(ts))).alias("epoch_us"),
    )


@query("fun_13_units", """
SELECT event_id, round(value / 1000, 6) AS seconds, round(value * 1000, 6) AS millis, round(value * 1e6 / 1048576, 6) AS mib, round(value * 1e6 / 1e9, 6) AS gb,
  round(value / 500 * 100, 6) AS pct FROM events""")
def _(spark, sf):
    x = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", r6(x / 1000).alias("seconds"), r6(x * 1000).alias("millis"), r6(x * 1e6 / 1048576).alias("mib"),
        r6(x * 1e6 / 1e9).alias("gb"), r6(x / 500 * 100).alias("pct"),
    )


@query("fun_14_prompts", """
SELECT conv_id, turn, md5(text) AS completion,
 md5('Context:' || chr(10) || text || chr(10) || chr(10) || 'Question: ' || role || chr(10) || chr(10) || 'Answer:') AS rag,
 md5('Task: ' || role || chr(10) || chr(10) || 'Requirements:' || chr(10) || text || chr(10) || chr(10) || 'Code:') AS code,
 md5('Summarize the following text:' || chr(10) || chr(10) || text || chr(10) || chr(10) || 'Summary:') AS summarize FROM conversations""")
def _(spark, sf):
    text, role = F.col("text"), F.col("role")
    fill = {
        "completion": dict(prompt=text), "rag": dict(context=text, query=role),
        "code": dict(task=role, requirements=text), "summarize": dict(text=text),
    }
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", *[F.md5(t.fill_template(t.TEMPLATES[n], **c)).alias(n) for n, c in fill.items()]
    )


@query("fun_15_chat_history", """
SELECT conv_id, md5(string_agg(CASE role WHEN 'user' THEN 'Human' WHEN 'assistant' THEN 'Assistant' ELSE 'System' END || ': ' || text, chr(10) || chr(10) ORDER BY turn)
  || chr(10) || chr(10) || 'Human: go on' || chr(10) || chr(10) || 'Assistant:') AS prompt, count(*) AS turns FROM conversations GROUP BY 1""")
def _(spark, sf):
    who = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "Assistant").otherwise("System")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(who, F.lit(": "), "text").alias("said"))
    # the prompt of a dialogue is one output value, so its turns do meet in one row
    history = rows.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "said"))), lambda s: s["said"]), "\n\n").alias("h"),
        F.count(F.lit(1)).alias("turns"),
    )
    return history.select("conv_id", F.md5(t.chat_prompt(F.col("h"), F.lit("go on"))).alias("prompt"), "turns")


def folded(m, mod):
    parts = [f"(CAST(('0x' || substr({m}, {i + 1}, {min(8, 32 - i)})) AS BIGINT) % {mod})" for i in range(0, 32, 8)]
    out = "0"
    for p in parts:
        out = f"(({out} * {16 ** 8 % mod} + {p}) % {mod})"
    return out


@query("fun_16_hashes", f"""
SELECT event_id, CAST({folded("md5(CAST(user_id AS VARCHAR))", 10000)} AS BIGINT) AS bucket, sha256(props) AS digest, substr(md5(props), 1, 8) AS hash8 FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", val.hex_modulus(F.md5(F.col("user_id").cast("string")), 10000).alias("bucket"),
        F.sha2("props", 256).alias("digest"), F.substring(F.md5("props"), 1, 8).alias("hash8"),
    )


@query("fun_17_vector_math", """
WITH d AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS a, list_reverse(CAST(embedding AS DOUBLE[])) AS b FROM embeddings)
SELECT vec_id, round(sqrt(list_dot_product(a, a)), 6) + 0 AS norm, round(list_dot_product(a, b), 6) + 0 AS dot, round(list_cosine_similarity(a, b), 6) + 0 AS cosine,
  round(a[1] / sqrt(list_dot_product(a, a)), 6) + 0 AS first FROM d""")
def _(spark, sf):
    a = F.col("embedding")
    b = F.reverse(a)
    return table(spark, sf, "embeddings").select(
        "vec_id", r6(val.norm(a)).alias("norm"), r6(val.dot(a, b)).alias("dot"), r6(val.cosine(a, b)).alias("cosine"),
        r6(F.element_at(val.normalise(a), 1)).alias("first"),
    )


@query("fun_18_file_names", f"""WITH {v.TELEMETRY}
SELECT event_id, '/data/staging/robot-' || user_id || '/' || strftime(ts, '%Y/%m/%d') || '/' ||
  CASE k % 4 WHEN 0 THEN 'p0_critical' WHEN 1 THEN 'p1_high' ELSE 'p2_normal' END || '/' || strftime(ts, '%Y%m%dT%H%M%SZ') || '_' || (epoch_us(ts) // 1000) || '_s' || user_id || '_p' || (k % 4)
  || '_' || event_type || '_' || CAST(floor(value) AS BIGINT) || '_' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) || '.mcap' AS path FROM telemetry""")
def _(spark, sf):
    ts, priority = F.col("ts"), F.col("k") % 4
    name = val.file_name(
        ts, F.concat(F.lit("s"), "user_id"), priority, F.col("event_type"), F.floor("value"), F.md5(F.col("event_id").cast("string"))
    )
    return v.telemetry(spark, sf).select(
        "event_id", val.file_path("/data", F.concat(F.lit("robot-"), "user_id"), ts, priority, name).alias("path")
    )


@query("fun_19_metadata", r"""
SELECT event_id, 'doc_id=' || event_id || ',k=' || regexp_extract(props, '(\d+)', 1) AS metadata FROM events""")
def _(spark, sf):
    meta = F.map_concat(
        F.from_json(F.concat(F.lit('{"id": 1, "text": "x", '), F.expr("substring(props, 2)")), "map<string,string>"),
        F.map_from_arrays(F.array(F.lit("doc_id")), F.array(F.col("event_id").cast("string"))),
    )
    kept = val.without_keys(meta, "text", "id")
    pairs = F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return table(spark, sf, "events").select("event_id", F.array_join(pairs, ",").alias("metadata"))


@query("fun_20_transfer_cost", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 20 * l_discount * 10 + l_quantity * 2 + 10 * (l_linenumber % 4) AS cost, l_quantity * 2 AS temp, l_linenumber % 4 AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(cost, 6) AS cost, CASE WHEN p = 0 THEN 'pass' WHEN temp >= 85 THEN 'thermal_block' WHEN round(cost, 6) > 100 THEN 'backoff' ELSE 'pass' END AS decision FROM c""")
def _(spark, sf):
    priority, temp = F.col("l_linenumber") % 4, F.col("l_quantity") * 2
    cost = r6(val.transfer_cost(F.col("l_discount") * 10, temp, priority))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cost.alias("cost"),
        val.transfer_decision(cost, temp, priority).alias("decision"),
    )
