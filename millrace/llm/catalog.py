"""Queries of this package over the given tables, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    html_text, importance, mixing, packing, pii, quality, ranked_search, repeats, secret_scans, simhash, token_counts, toxicity,
    winnowing,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learning_fold():
    """Rows that labels may be learnt from: crc32 of the id as text is not a multiple of 5."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0


@query("op1_pii_feistel")
def op1(spark, sf_dir):
    # in production the key comes from a secret store
    return pii.pseudonymise(table(spark, sf_dir, "documents"), key="example key of this query")


@query("op2_quality_rules")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model)


@query("op3_html_extraction")
def op3(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op4_secret_scans")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secret_scans.scan(docs, secret_scans.train_on(docs))


def toxicity_model(docs, spark, sf_dir):
    return toxicity.train(docs, table(spark, sf_dir, "labels"), usable=learning_fold())


@query("op5_toxicity")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, spark, sf_dir))
    held_out = F.coalesce(~learning_fold(), F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op6_winnowing")
def op6(spark, sf_dir):
    return winnowing.compare_with_next(table(spark, sf_dir, "documents"))


def quality_weights(spark, sf_dir):
    """Documents labelled good weigh 2, those labelled bad a half; others get 1 from the operator."""
    labels = table(spark, sf_dir, "labels").where("doc_id is not null and quality is not null")
    return labels.groupBy("doc_id").agg((F.lit(0.5) + F.lit(1.5) * F.avg("quality")).alias("weight"))


OP7_SQL = r"""
WITH weighed AS (
  SELECT doc_id, 0.5 + 1.5 * avg(quality) AS weight FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), docs AS (
  SELECT d.doc_id, d.source, CAST(coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5('7:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
      / coalesce(w.weight, 1.0) AS key
  FROM documents d LEFT JOIN weighed w ON d.doc_id = w.doc_id
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source
), named AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
    [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sources
), levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM named)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM named
), targets AS (
  SELECT source, source_size,
    least(cap, weight * coalesce((SELECT max(level) FROM levels WHERE level * weight <= cap), 'inf'::DOUBLE)) AS target
  FROM levels
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, CAST(round(target - epochs * source_size) AS BIGINT) - before)) AS BIGINT) AS taken
FROM placed
"""


@query("op7_mixing", OP7_SQL)
def op7(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), quality=quality_weights(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def tokenizer_files() -> dict[str, str]:
    """The public tokenizer that the packing queries use; the library brings its files."""
    import public_tokenizers

    return {
        "vocabulary": str(public_tokenizers.path("byte_bpe_50k.json")),
        "ranks": str(public_tokenizers.path("byte_bpe_50k.tiktoken")),
        "pattern": public_tokenizers.PATTERN,
    }


@query("op9_packing")
def op9(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_files())


@query("op8_simhash_near_dedup")
def op8(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "copies")


@query("op10_suffix_array_dedup")
def op10(spark, sf_dir):
    left = repeats.deduplicate(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


OP11_SQL = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), wanted AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), lengths AS (
  SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
), corpus AS (
  SELECT count(*) AS N_docs, CAST(sum(n) AS BIGINT) AS L FROM lengths
), held AS (
  SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * N_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM held, corpus GROUP BY term, N_docs
), impacts AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * N_docs) // L)) AS impact
  FROM held JOIN lengths USING (doc_id), corpus
), scores AS (
  SELECT item_id, doc_id, CAST(sum(w * impact) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN impacts USING (term) GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query("op11_ranked_search", OP11_SQL)
def op11(spark, sf_dir):
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@query("op12_token_counts")
def op12(spark, sf_dir):
    """From an empty cache, so that a run does not depend on the runs before it; production names a lasting folder."""
    import public_tokenizers

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), str(public_tokenizers.path("piece_bpe_32k.model")))


OP13_SQL = r"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
  )
), all_texts AS (
  SELECT doc_id AS id, text, true AS ours FROM documents UNION ALL SELECT item_id, text, false FROM benchmark
), features AS (
  SELECT id, ours, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM all_texts
), spelt AS (
  SELECT word, list_transform(range(length(hex(encode(word))) // 2), lambda k: CAST('0x' || substr(hex(encode(word)), 2 * k + 1, 2) AS BIGINT)) AS bytes
  FROM (SELECT DISTINCT word FROM features)
), hashed AS (
  SELECT word, xor(list_reduce(list_concat([4294967295], bytes), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM spelt, crc
), counts AS (
  SELECT bucket, count(*) FILTER (ours) AS s, count(*) FILTER (NOT ours) AS t FROM features JOIN hashed USING (word) GROUP BY bucket
), totals AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM counts, totals
), weights AS (
  SELECT id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM features JOIN hashed USING (word) JOIN gains USING (bucket) WHERE ours GROUP BY id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights ON id = doc_id
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CAST(rank AS BIGINT) AS rank
FROM scored s LEFT JOIN (SELECT * FROM ranked WHERE rank <= n // 10) r ON s.doc_id = r.doc_id
"""


@query("op13_importance_resampling", OP13_SQL)
def op13(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10)
