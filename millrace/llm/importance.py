"""Importance resampling towards a target distribution, over n-grams whose checksums come from running ones."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import byte_slices, narrow
from millrace.session import materialise

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_POLYNOMIAL = 0xEDB88320
_SPACE = np.uint32(crc32(b" "))
#: lengths with a table of their own; longer ones are sums of powers of two times this
_SHORT = 64


@lru_cache(1)
def _shift_tables() -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """(one byte's table, tables for lengths below 64, tables for 64 times powers of two, inverse by top byte).

    A table [4, 256] gives the checksum of a text followed by so many zero
    bytes, less what the zeros alone add, as the exclusive or of one entry for
    each byte of the text's checksum: over GF(2) that is linear.
    """
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(_POLYNOMIAL), one >> 1).astype(np.uint32)
    identity = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32)[:, None])).astype(np.uint32)
    short = [identity]
    for _ in range(_SHORT):
        short.append(one[short[-1] & 0xFF] ^ (short[-1] >> 8))
    long, by = [], short.pop()
    for _ in range(32):
        long.append(by)
        by = _apply(by, by)
    inverse = np.empty(256, np.uint32)
    inverse[one >> 24] = np.arange(256, dtype=np.uint32)
    return one, np.array(short), long, inverse


def _apply(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    return table[0][values & 0xFF] ^ table[1][values >> 8 & 0xFF] ^ table[2][values >> 16 & 0xFF] ^ table[3][values >> 24]


def shift(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums of prefixes, moved over so many bytes: crc(ab) = shift(crc(a), len(b)) ^ crc(b)."""
    _, short, long, _ = _shift_tables()
    rest, out = lengths % _SHORT, 0
    for byte in range(4):
        out = out ^ short[rest, byte, (values >> np.uint32(8 * byte)) & np.uint32(0xFF)]
    over, bit = lengths // _SHORT, 0
    while over.any():
        odd = (over & 1).astype(bool)
        out[odd] = _apply(long[bit], out[odd])
        over, bit = over >> 1, bit + 1
    return out


def drop_space(values: np.ndarray) -> np.ndarray:
    """The checksums of texts from those of the texts with a space behind."""
    one, _, _, inverse = _shift_tables()
    values = values ^ _SPACE
    byte = inverse[values >> np.uint32(24)]
    return ((values ^ one[byte]) << np.uint32(8)) | byte


def words(raw: bytes) -> list[bytes]:
    """Runs of digits, ASCII letters and characters beyond ASCII, A-Z lower-cased."""
    return raw.translate(_LOWER).split()


def gram_checksums(found: list[bytes], most: int) -> np.ndarray:
    """crc32 of all runs of 1 to ``most`` words joined by one space.

    The words, each with a space behind, are scanned once; the running
    checksums S at the words' starts are all that is kept. A run from word i
    to j with its space is S[j + 1] less S[i] shifted over the run.
    """
    if not found:
        return np.zeros(0, np.uint32)
    running = accumulate([w + b" " for w in found], lambda crc, w: crc32(w, crc), initial=0)
    prefix = np.fromiter(running, np.uint32, len(found) + 1)
    start = np.zeros(len(found) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1, out=start[1:])
    sizes = range(1, min(most, len(found)) + 1)
    return np.concatenate([drop_space(prefix[n:] ^ shift(prefix[:-n], start[n:] - start[:-n])) for n in sizes])


def feature_buckets(df: DataFrame, most: int, buckets: int) -> DataFrame:
    """(doc_id, n_words, n_features, buckets) of rows (doc_id, text)."""
    kind, width = df.schema["doc_id"].dataType.simpleString(), _width(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, 1):
                found = [words(raw) for raw in batch.column(1).to_pylist()]
                slots = [gram_checksums(w, most) % np.uint32(buckets) for w in found]
                columns = [[len(w) for w in found], [len(s) for s in slots], [s.astype(width).tobytes() for s in slots]]
                arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["doc_id", "n_words", "n_features", "buckets"])

    return df.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, buckets binary")


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket; ``buckets`` numbers are all that the driver gets."""
    width = _width(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in byte_slices(whole, 0):
                counts += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), width), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["bucket", "n"])

    found = features.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    table, out = found.toArrow(), np.zeros(buckets, np.int64)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(odds of the target)) of each bucket, one added to every count."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    odds = [(t + 1) * (s_all + n) / ((s + 1) * (t_all + n)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(x)) for x in odds], np.int64)


def weigh(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``features`` with the sum of gains in place of the buckets."""
    told, width = features.sparkSession.sparkContext.broadcast(gain), _width(len(gain))
    schema = features.withColumn("buckets", F.lit(0).cast("bigint")).withColumnRenamed("buckets", "weight").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = told.value
        for batch in batches:
            sums = [int(gain[np.frombuffer(raw, width)].sum()) for raw in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=schema.names)

    return features.select("doc_id", "n_words", "n_features", "buckets").mapInArrow(run, schema)


def resample(
    df: DataFrame, target: DataFrame, percent: int = 10, id_col: str = "doc_id", text_col: str = "text",
    target_text_col: str = "text", most: int = 1, buckets: int = 10_000, least_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``df``.

    A feature is a run of 1 to ``most`` words, its bucket the run's crc32
    modulo ``buckets``. Buckets are counted over all rows and over all texts
    of ``target``; a document's weight is the sum of its features' gains. The
    score adds Gumbel noise drawn from ``seed`` and the id, so reruns agree.
    Of the N documents with ``least_words`` words, floor(percent * N / 100)
    are drawn, highest score first, equal scores by smaller id; rank counts
    them from 1 and is null for all others.

    Ranks need no single sorted place: rows are cut by (score, id) into as
    many slices as there are shuffle partitions, and one row per slice carries
    the counts before it.

    A null or empty text has no words: weight 0, never drawn unless
    ``least_words`` is 0. A null id has the noise of an empty one and comes
    last among equal scores. Repeated rows are scored and drawn one by one,
    in either order. Other columns are not read.
    """
    spark = df.sparkSession
    features = materialise(feature_buckets(narrow(df, id_col, text_col), most, buckets), "features")
    # all texts of the target are read in the same way; their ids are of no use
    aims = feature_buckets(narrow(target.withColumn("_none", F.lit(0)).select("_none", target_text_col), "_none", target_text_col), most, buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(aims, buckets))
    drawn_from = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(drawn_from, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = weigh(features, gain).withColumn("score", F.col("weight") + noise.cast("bigint"))
    scored = scored.withColumn("eligible", F.col("n_words") >= least_words)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # rows that agree in all of these are spread by where they stand
    written = materialise(scored, "scores").withColumn("place", F.monotonically_increasing_id())
    cut = materialise(written.repartitionByRange(parts, *order, "place").withColumn("slice", F.spark_partition_id()), "slices")
    sizes = cut.groupBy("slice").agg(F.count_if("eligible").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("slice")) - F.col("n")
    # one row for each slice
    sizes = sizes.select("slice", before.alias("before"), F.floor(total * F.lit(percent) / F.lit(100)).alias("drawn"))
    within = F.row_number().over(Window.partitionBy("slice").orderBy(*order, "place"))
    ranked = cut.withColumn("nth", within).join(F.broadcast(sizes), "slice")
    rank = F.when(F.col("eligible") & (F.col("nth") + F.col("before") <= F.col("drawn")), F.col("nth") + F.col("before"))
    return ranked.select("doc_id", "n_features", "weight", "score", rank.cast("bigint").alias("rank"))
