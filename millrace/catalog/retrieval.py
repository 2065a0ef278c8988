"""Chunking, vector and model-hook queries. Search queries are the mean vectors of the labels."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from millrace.catalog.registry import query, r4, r6, table, texts
from millrace.functions import udfs
from millrace.operators import chunking as c
from millrace.operators import retrieval as r

CHUNKS = r"""
WITH RECURSIVE g(doc_id, n, start, fin, last, chunk) AS (
  SELECT doc_id, length(text), CAST(0 AS BIGINT), CASE WHEN 512 < length(text) AND length(regexp_extract(substring(text, 413, 100), '(?s)^.*[.!?]\s+')) > 0
    THEN 412 + length(regexp_extract(substring(text, 413, 100), '(?s)^.*[.!?]\s+')) ELSE 512 END, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM documents WHERE length(text) > 0
  UNION ALL
  SELECT doc_id, n, s, CASE WHEN s + 512 < n AND length(m) > 0 THEN s + 412 + length(m) ELSE s + 512 END, s, chunk + 1 FROM (
    SELECT g.doc_id, n, chunk, CASE WHEN fin - 50 <= last THEN fin ELSE fin - 50 END AS s,
      regexp_extract(substring(d.text, CAST(CASE WHEN fin - 50 <= last THEN fin ELSE fin - 50 END + 413 AS BIGINT), 100), '(?s)^.*[.!?]\s+') AS m
    FROM g JOIN documents d ON d.doc_id = g.doc_id) x WHERE s < n)
SELECT g.doc_id, CAST(chunk AS INT) AS chunk_id, md5(regexp_replace(substring(d.text, start + 1, fin - start), '^\s+|\s+$', '', 'g')) AS digest, CAST(start AS INT) AS start_idx, CAST(fin AS INT) AS end_idx
FROM g JOIN documents d ON d.doc_id = g.doc_id"""

CORPUS = CHUNKS.partition("SELECT g.doc_id, CAST(chunk")[0] + r"""
SELECT g.doc_id || '_chunk_' || chunk AS id, g.doc_id, CAST(length(regexp_replace(substring(d.text, start + 1, fin - start), '^\s+|\s+$', '', 'g')) AS INT) AS chars, CAST(64 AS INT) AS dimensions, d.lang
FROM g JOIN documents d ON d.doc_id = g.doc_id"""


def digested(df, *columns):
    return df.select(*columns[:1], "chunk_id", F.md5("text").alias("digest"), *columns[1:])


@query("chk_1_fixed_chunks", CHUNKS)
def _(spark, sf):
    return digested(c.fixed_chunks(texts(spark, sf), "doc_id", "text"), "doc_id", "start_idx", "end_idx")


@query("udf_7_chunk_function", CHUNKS)
def _(spark, sf):
    c.register_chunk_function(spark)
    return spark.sql(
        "SELECT doc_id, chunk_id, md5(k.text) AS digest, start_idx, end_idx FROM {d} d, LATERAL sentence_chunks(d.text) k", d=texts(spark, sf)
    )


@query("chk_2_sentence_chunks", r"""
WITH s AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents),
g AS (SELECT doc_id, text, s, unnest(range(0, len(s), 5)) AS i FROM s),
j AS (SELECT doc_id, i // 5 AS chunk, array_to_string(s[i + 1:i + 5], ' ') AS t, strpos(text, s[i + 1]) - 1 AS pos FROM g)
SELECT doc_id, CAST(chunk AS INT) AS chunk_id, md5(t) AS digest, CAST(pos AS INT) AS start_idx, CAST(pos + length(t) AS INT) AS end_idx FROM j""")
def _(spark, sf):
    return digested(c.sentence_chunks(texts(spark, sf), "doc_id", "text"), "doc_id", "start_idx", "end_idx")


@query("chk_3_separator_chunks", r"""
WITH t AS (SELECT conv_id, '  ' || string_agg(text, chr(10) || chr(10) || ' ' ORDER BY turn) || chr(10) || chr(10) || chr(10) || chr(10) || 'end ' AS text FROM conversations GROUP BY 1),
p AS (SELECT conv_id, string_split(text, chr(10) || chr(10)) AS p FROM t), x AS (SELECT conv_id, p, unnest(range(1, len(p) + 1)) AS i FROM p),
y AS (SELECT conv_id, i, regexp_replace(p[i], '^\s+|\s+$', '', 'g') AS body, list_sum(list_transform(p[1:i - 1], lambda z: length(z) + 2)) AS before, length(p[i]) - length(regexp_replace(p[i], '^\s+', '')) AS lead FROM x),
z AS (SELECT conv_id, i, body, coalesce(before, 0) + lead AS pos FROM y WHERE body <> '')
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY i) - 1 AS INT) AS chunk_id, md5(body) AS digest, CAST(pos AS INT) AS start_idx, CAST(pos + length(body) AS INT) AS end_idx FROM z""")
def _(spark, sf):
    turns = table(spark, sf, "conversations")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]), "\n\n ")
    docs = turns.groupBy("conv_id").agg(F.concat(F.lit("  "), joined, F.lit("\n\n\n\nend ")).alias("text"))
    return digested(c.separator_chunks(docs, "conv_id", "text"), "conv_id", "start_idx", "end_idx")


@query("chk_4_token_chunks", r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(0, len(w), 462)) AS s FROM w)
SELECT doc_id, CAST(s // 462 AS INT) AS chunk_id, md5(array_to_string(w[s + 1:s + 512], ' ')) AS digest, CAST(s AS INT) AS start_idx, CAST(s + 512 AS INT) AS end_idx,
  CAST(len(w[s + 1:s + 512]) AS INT) AS token_count FROM g""")
def _(spark, sf):
    return digested(c.word_chunks(texts(spark, sf), "doc_id", "text"), "doc_id", "start_idx", "end_idx", "token_count")


@query("chk_5_corpus_chunks", CORPUS)
def _(spark, sf):
    meta = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    out = c.corpus_chunks(texts(spark, sf), "doc_id", "text", udfs.hashing_embedder(64), meta)
    return out.select("id", "doc_id", F.length("text").alias("chars"), F.size("embedding").alias("dimensions"), F.col("metadata")["lang"].alias("lang"))


CENTRES = """e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, unnest(v) AS x, unnest(range(0, len(v))) AS i FROM e), a AS (SELECT label, i, avg(x) AS m FROM x GROUP BY 1, 2),
q AS (SELECT label AS query, list(m ORDER BY i) AS v FROM a GROUP BY 1)"""

RANKED = f"""{CENTRES}, s AS (SELECT query, vec_id, label, list_cosine_similarity(q.v, e.v) AS score FROM q CROSS JOIN e),
k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 12) DESC, vec_id) AS rank FROM s)"""


def centres(spark, sf):
    at = lambda i: F.avg(F.get("embedding", F.lit(i)).cast("double"))
    return table(spark, sf, "embeddings").groupBy(F.col("label").cast("bigint").alias("query")).agg(F.array(*[at(i) for i in range(64)]).alias("v"))


def ranked(spark, sf, k=5):
    return r.top_k(table(spark, sf, "embeddings"), centres(spark, sf), "vec_id", "embedding", "query", "v", k)


@query("vec_1_exact_top_k", f"WITH {RANKED} SELECT CAST(query AS BIGINT) AS query, vec_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM k WHERE rank <= 5")
def _(spark, sf):
    return ranked(spark, sf).withColumn("score", r6("score"))


def neighbours(found):
    """Five best rows beside the query itself."""
    w = Window.partitionBy("query").orderBy("rank")
    others = found.where("vec_id <> query").withColumn("rank", F.row_number().over(w))
    return others.where("rank <= 5")


def asked(spark, sf):
    return table(spark, sf, "embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("v"))


def near_rows(spark, sf):
    index = r.CellIndex(table(spark, sf, "embeddings"), "vec_id", "embedding", 5)
    return neighbours(index.search(asked(spark, sf), "query", "v", 6))


@query("vec_2_cell_search")
def _(spark, sf):
    return near_rows(spark, sf).withColumn("score", r6("score"))


@query("vec_2_recall", """SELECT count(*) AS queries, 5 * count(*) AS pairs, true AS passed FROM embeddings WHERE vec_id % 20 = 0""")
def _(spark, sf):
    # the very search of vec_2_cell_search against the exact one
    exact = neighbours(r.tile_search(table(spark, sf, "embeddings"), asked(spark, sf), "vec_id", "embedding", "query", "v", 6))
    near = near_rows(spark, sf).select("query", "vec_id", F.lit(1).alias("found"))
    found = F.coalesce(F.avg(F.coalesce("found", F.lit(0))), F.lit(1.0))
    both = exact.join(near, ["query", "vec_id"], "left")
    return both.agg(F.countDistinct("query").alias("queries"), F.count(F.lit(1)).alias("pairs"), (found >= 0.9).alias("passed"))


@query("vec_3_threshold", f"WITH {RANKED} SELECT CAST(query AS BIGINT) AS query, vec_id, round(score, 6) AS score FROM k WHERE rank <= 5 AND score >= 0.36")
def _(spark, sf):
    return ranked(spark, sf).where("score >= 0.36").select("query", "vec_id", r6("score").alias("score"))


PACKED = f"""{RANKED}, h AS (SELECT query, rank, text, length(text) AS n, sum(length(text)) OVER (PARTITION BY query ORDER BY rank) AS cum FROM k JOIN documents ON doc_id = vec_id WHERE rank <= 5),
f AS (SELECT *, cum > 6000 AS over, coalesce(sum(CASE WHEN cum > 6000 THEN 1 ELSE 0 END) OVER (PARTITION BY query ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM h),
p AS (SELECT query, rank, CASE WHEN NOT over THEN text WHEN 6000 - (cum - n) > 100 THEN substring(text, 1, CAST(6000 - (cum - n) AS BIGINT)) || '...' END AS piece FROM f WHERE earlier = 0),
ctx AS (SELECT query, coalesce(string_agg(piece, chr(10) || chr(10) ORDER BY rank) FILTER (piece IS NOT NULL), '') AS context, count(piece) AS pieces FROM p GROUP BY 1)"""


def packed(spark, sf):
    hits = ranked(spark, sf).join(table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text"), "vec_id")
    return r.pack_context(hits, "query", "text", 6000)


@query("win_13_context", f"WITH {PACKED} SELECT CAST(query AS BIGINT) AS query, md5(context) AS digest, CAST(pieces AS INT) AS pieces FROM ctx")
def _(spark, sf):
    return packed(spark, sf).select("query", F.md5("context").alias("digest"), "pieces")


@query("vec_4_prompts", f"""WITH {PACKED}
SELECT CAST(q.query AS BIGINT) AS query, CASE WHEN context <> '' THEN md5('You are a helpful assistant. Answer the question based on the provided context. If the answer cannot be found in the context, say so.'
  || chr(10) || chr(10) || 'Context:' || chr(10) || context || chr(10) || chr(10) || 'Question: about ' || q.query || chr(10) || chr(10) || 'Answer:') END AS prompt,
  CASE WHEN coalesce(context, '') = '' THEN 'No relevant information found.' END AS answer FROM q LEFT JOIN ctx ON ctx.query = q.query""")
def _(spark, sf):
    asked = centres(spark, sf).select("query", F.concat(F.lit("about "), "query").alias("question"))
    return r.prompts(asked, packed(spark, sf), "query", "question").withColumn("prompt", F.md5("prompt"))


@query("vec_5_quality", f"""WITH {RANKED}, t AS (SELECT label, count(*) AS total FROM e GROUP BY 1),
p AS (SELECT query, count(*) FILTER (rank <= 1 AND label = query) AS h1, count(*) FILTER (rank <= 3 AND label = query) AS h3, count(*) FILTER (rank <= 5 AND label = query) AS h5,
  coalesce(max(1.0 / rank) FILTER (label = query), 0) AS rr, avg(score) AS sim FROM k WHERE rank <= 5 GROUP BY 1)
SELECT round(avg(h1), 6) AS precision_at_1, round(avg(h3 / 3), 6) AS precision_at_3, round(avg(h5 / 5), 6) AS precision_at_5, round(avg(h3 / total), 6) AS recall_at_3,
  round(avg(h5 / total), 6) AS recall_at_5, round(avg(CAST(rr AS DOUBLE)), 6) AS mrr, round(avg(sim), 6) AS mean_similarity FROM p JOIN t ON t.label = p.query""")
def _(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label")
    totals = rows.groupBy(F.col("label").cast("bigint").alias("query")).agg(F.count(F.lit(1)).alias("relevant_total"))
    out = r.retrieval_quality(ranked(spark, sf).join(rows, "vec_id"), "query", F.col("label") == F.col("query"), totals)
    return out.select(*[r6(c).alias(c) for c in out.columns])


@query("vec_6_filtered_search", f"""WITH {CENTRES}, s AS (SELECT query, vec_id, label, list_cosine_similarity(q.v, e.v) AS score FROM q CROSS JOIN e WHERE label >= 5),
k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 12) DESC, vec_id) AS rank FROM s)
SELECT CAST(query AS BIGINT) AS query, vec_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM k WHERE rank <= 3""")
def _(spark, sf):
    some = table(spark, sf, "embeddings").where("label >= 5")
    return r.top_k(some, centres(spark, sf), "vec_id", "embedding", "query", "v", 3).withColumn("score", r6("score"))


@query("udf_1_embedding")
def _(spark, sf):
    embed = udfs.hashing_embedder(64)
    out = texts(spark, sf).select("doc_id", embed("text").alias("embedding"))
    return out.select("doc_id", F.size("embedding").alias("dimensions"), r4(F.element_at("embedding", 1)).alias("first"))


@query("udf_2_batch_inference", "SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 4) + 0 AS total FROM embeddings")
def _(spark, sf):
    model = udfs.batch_inference(lambda m: m.astype("float64").sum(axis=1), DoubleType())
    return table(spark, sf, "embeddings").select("vec_id", r4(model("embedding")).alias("total"))
