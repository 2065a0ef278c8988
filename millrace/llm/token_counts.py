"""Token counts with a cache of digests: each distinct text is encoded once, ever."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import byte_slices
from millrace.session import materialise, new_path

CACHE = "tokenizer string, digest binary, n_tokens bigint"
#: a digest with more than this share of all rows is joined by broadcast: fewer than so many digests can have it
HOT = 4096
#: what is counted, besides the model; another rule needs another name
RULE = "sentencepiece encode, no added tokens"


def piece_form(text: Column) -> Column:
    """The form of a text by which it is looked up: the library writes a space as U+2581, so both count alike."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("▁"), F.lit(" "))


def plain_form(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def version(model_file: str) -> str:
    """Digest of the rule and of the tokenizer's file: counts of another version are never used."""
    with open(model_file, "rb") as file:
        return hashlib.sha256(RULE.encode() + b"\0" + file.read()).hexdigest()


@lru_cache(1)
def _processor(model_file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def encode_counts(texts: DataFrame, model_file: str) -> DataFrame:
    """(digest, n_tokens) of rows (digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _processor(model_file).encode
        for whole in batches:
            for batch in byte_slices(whole, 1):
                counts = [len(ids) for ids in encode(batch.column(1).to_pylist(), num_threads=1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    return texts.mapInArrow(run, "digest binary, n_tokens bigint")


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache in the folder ``path``, which is made if it is not there."""
    spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(path)
    return spark.read.schema(CACHE).parquet(path)


def known_counts(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; runs side by side may have stored a digest twice."""
    held = open_cache(spark, path).where(F.col("tokenizer") == tokenizer)
    return held.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    df: DataFrame, model_file: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    form: Callable[[Column], Column] = piece_form, limit: int = 4096, few: int = 50_000,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    ``cache`` is a folder that all executors share and that outlives the run;
    without it the run has one of its own. Texts meet as SHA-256 digests of
    their ``form``. Digests that the cache does not hold for this tokenizer
    version are the misses; one text of each is encoded, and the counts are
    appended in one commit. A run that fails before it leaves the cache as it
    was, so it can simply run again.

    Copies of a text are dropped in each task before texts move. With at most
    ``few`` misses, digests of 32 bytes that are sent to all tasks, texts are
    filtered by them first and only missing ones move. Each row then finds its count by
    digest; the few digests that each have more than a 4,096th of all rows
    are sent to the rows instead, so no task gets all copies of a text.

    A null text counts as empty and has no tokens; null and repeated ids stay
    as they are; other columns are not read.
    """
    spark, tokenizer = df.sparkSession, version(model_file)
    cache = cache or new_path(spark, "token-counts")
    texts = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # a digest of the bytes, as a hash column of bytes joins and shuffles half as much as hexadecimal digits
    digest = F.unhex(F.sha2(form(F.col("text")), 256))
    rows = materialise(texts.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), digest.alias("digest")), "digests")
    copies = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
    known = known_counts(spark, cache, tokenizer)
    misses = materialise(copies.join(known.select("digest"), "digest", "left_anti").select("digest"), "misses")

    candidates = texts.select(digest.alias("digest"), "text")
    one_each = lambda found: found.groupBy("digest").agg(F.first("text").alias("text"))
    if misses.count() <= few:
        distinct = one_each(candidates.join(F.broadcast(misses), "digest", "left_semi"))
    else:
        distinct = one_each(candidates).join(misses, "digest", "left_semi")
    made = encode_counts(distinct.select("digest", "text"), model_file)
    made.withColumn("tokenizer", F.lit(tokenizer)).write.mode("append").partitionBy("tokenizer").parquet(cache)

    counts = known_counts(spark, cache, tokenizer)
    total = rows.count()
    frequent = copies.where(F.col("copies") * HOT > total).select("digest")
    # fewer than HOT rows, whatever the size of the table
    hot = materialise(counts.join(F.broadcast(frequent), "digest", "left_semi"), "hot-counts")
    marked = rows.join(F.broadcast(hot.withColumnRenamed("n_tokens", "_hot")), "digest", "left")
    found = marked.where("_hot is not null").withColumnRenamed("_hot", "n_tokens").unionByName(
        marked.where("_hot is null").drop("_hot").join(counts, "digest")
    )
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

