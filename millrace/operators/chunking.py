"""Documents to chunks: one row in, one row per chunk out.

Chunk rows hold chunk_id, text, start_idx and end_idx (end exclusive).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType

from millrace.functions.text import strip, words
from millrace.plans.layout import byte_slices, spread

SENTENCE_END = re.compile(r"[.!?]\s+", re.ASCII)
BLANK = " \t\n\r\x0b\x0c"
LOOK_BACK = 100
#: chunks that a task hands on together
CHUNKS_AT_ONCE = 2048


def sentence_aware_chunks(text: str, size: int = 512, overlap: int = 50) -> Iterator[tuple[int, str, int, int]]:
    """Windows of ``size`` characters that end after a sentence when one ends near the edge.

    All sentence ends of the document are found once; each window then looks
    up the last one that starts in its final stretch.
    """
    if size <= overlap:
        raise ValueError("the chunk size has to exceed the overlap")
    ends = [m.span() for m in SENTENCE_END.finditer(text)]
    begins = [b for b, _ in ends]
    start, chunk, last = 0, 0, None
    while start < len(text):
        end = start + size
        if end < len(text):
            # a stop needs one blank inside the window, so it begins two before the edge at most
            i = bisect_left(begins, end - 1) - 1
            if i >= 0 and begins[i] >= max(end - LOOK_BACK, start):
                end = min(ends[i][1], end)
        piece = text[start:end].strip(BLANK)
        if piece:
            yield chunk, piece, start, end
            chunk, last = chunk + 1, start
        start = end - overlap
        if last is not None and start <= last:
            start = end


def fixed_chunks(docs: DataFrame, key: str, text: str, size: int = 512, overlap: int = 50, keep: Sequence[str] = ()) -> DataFrame:
    """Chunks of about ``size`` characters that end with a sentence; ``keep`` names columns that go with each chunk."""
    own = [key, *keep]
    rows = spread(docs.select(*own, text), key)
    schema = StructType([*rows.schema.fields[:-1], *StructType.fromDDL("chunk_id int, text string, start_idx int, end_idx int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)

        def made(batch, rows, chunks):
            kept = [batch.column(i).take(pa.array(rows, pa.int32())).cast(out.field(i).type) for i in range(len(own))]
            parts = zip(*chunks)
            return pa.RecordBatch.from_arrays([*kept, *[pa.array(p, out.field(len(own) + i).type) for i, p in enumerate(parts)]], schema=out)

        for whole in batches:
            for batch in byte_slices(whole, len(own), size=1 << 20):
                places, chunks = [], []
                for n, t in enumerate(batch.column(len(own)).to_pylist()):
                    for chunk in sentence_aware_chunks(t or "", size, overlap):
                        places.append(n)
                        chunks.append(chunk)
                        if len(chunks) == CHUNKS_AT_ONCE:
                            yield made(batch, places, chunks)
                            places, chunks = [], []
                if chunks:
                    yield made(batch, places, chunks)

    return rows.mapInArrow(run, schema)


def register_chunk_function(spark: SparkSession, name: str = "sentence_chunks") -> None:
    """The same as a table function for SQL: ``LATERAL sentence_chunks(text)``."""

    class SentenceChunks:
        def eval(self, text: str):
            if text:
                yield from sentence_aware_chunks(text)

    spark.udtf.register(name, udtf(SentenceChunks, returnType="chunk_id int, text string, start_idx int, end_idx int"))


def sentences(text: Column) -> Column:
    parts = F.transform(F.split(text, r"(?<=[.!?])\s+"), strip)
    return F.filter(parts, lambda s: s != "")


def sentence_chunks(docs: DataFrame, key: str, text: str, per_chunk: int = 5) -> DataFrame:
    """Groups of sentences; start_idx is the first place the first sentence occurs."""
    s = docs.select(key, F.col(text).alias("_t"), sentences(F.col(text)).alias("_s")).where(F.size("_s") > 0)
    starts = F.sequence(F.lit(1), F.size("_s"), F.lit(per_chunk))
    groups = F.transform(starts, lambda i: F.slice("_s", i, per_chunk))
    rows = s.select(key, "_t", F.posexplode(groups).alias("chunk_id", "_g"))
    at = F.expr("instr(_t, _g[0])") - 1
    joined = F.array_join("_g", " ")
    return rows.select(key, "chunk_id", joined.alias("text"), at.alias("start_idx"), (at + F.length(joined)).alias("end_idx"))


def separator_chunks(docs: DataFrame, key: str, text: str, separator: str = "\n\n") -> DataFrame:
    """Sections between separators, stripped, with their place in the text."""
    width = len(separator)
    pieces = F.split(text, "\\Q" + separator + "\\E", -1)
    empty = F.array().cast("array<struct<text:string,start_idx:int>>")

    def step(acc, piece):
        body = strip(piece)
        lead = F.length(piece) - F.length(F.regexp_replace(piece, r"^\s+", ""))
        found = F.array(F.struct(body.alias("text"), (acc["at"] + lead).cast("int").alias("start_idx")))
        return F.struct(
            (acc["at"] + F.length(piece) + width).alias("at"),
            F.when(body == "", acc["out"]).otherwise(F.concat(acc["out"], found)).alias("out"),
        )

    folded = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda a: a["out"])
    rows = docs.select(key, F.posexplode(folded).alias("chunk_id", "c"))
    return rows.select(
        key, "chunk_id", "c.text", "c.start_idx", (F.col("c.start_idx") + F.length("c.text")).alias("end_idx")
    )


def token_chunks(docs: DataFrame, key: str, tokens: Column, size: int = 512, overlap: int = 50) -> DataFrame:
    """Windows over a token array; a last window of only the overlap is kept."""
    t = docs.select(key, tokens.alias("_w")).where(F.size("_w") > 0)
    starts = F.sequence(F.lit(0), F.size("_w") - 1, F.lit(size - overlap))
    windows = F.transform(starts, lambda s: F.struct(s.alias("start_idx"), F.slice("_w", s + 1, size).alias("w")))
    rows = t.select(key, F.posexplode(windows).alias("chunk_id", "c"))
    return rows.select(
        key, "chunk_id", F.array_join("c.w", " ").alias("text"), "c.start_idx", (F.col("c.start_idx") + size).alias("end_idx"),
        F.size("c.w").alias("token_count"),
    )


def word_chunks(docs: DataFrame, key: str, text: str, size: int = 512, overlap: int = 50) -> DataFrame:
    return token_chunks(docs, key, words(F.col(text)), size, overlap)


def corpus_chunks(docs: DataFrame, key: str, text: str, embed, metadata: Column) -> DataFrame:
    """Chunks with id ``{doc}_chunk_{n}``, vector and the document's metadata; empty texts are skipped."""
    # the metadata goes with the chunk, so that rows of one id keep to their own
    full = docs.where(F.length(text) > 0).select(F.col(key), F.col(text), metadata.alias("_meta"))
    return fixed_chunks(full, key, text, keep=["_meta"]).select(
        F.concat(F.col(key).cast("string"), F.lit("_chunk_"), "chunk_id").alias("id"), key, "text",
        embed(F.col("text")).alias("embedding"), F.col("_meta").alias("metadata"),
    )
