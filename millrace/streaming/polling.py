"""Incremental sync: each poll reads the new listing entries only and copies what is newly missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import new_path
from millrace.streaming.jobs import batch_counts
from millrace.streaming.keyed import rocksdb

COPY = "key string, source string, region string, action string"


def poll(listing: DataFrame, regions: Sequence[str], target: str, progress: list | None = None) -> DataFrame:
    """Copies (key, source, region, action) that one poll of the stream ``listing`` (key, region) asks for.

    The files that earlier polls have read are in the checkpoint under
    ``target``, and the regions of each key are in the state: the cost of a
    poll goes with the entries that are new. A poll is one batch, so entries of
    a key in several regions are seen together; the source is the first of
    ``regions`` that holds the key. A key is copied in the batch that first
    names one of ``regions`` for it, and all of them hold it from then on.
    ``progress`` gets (batch, rows read, 0).
    """
    spark = listing.sparkSession
    # a folder for each poll: a repeated batch of a poll that failed replaces its own rows
    out = new_path(spark, "copies")
    spark.createDataFrame([], COPY).write.parquet(f"{out}/batch=-1")
    known = listing.where(F.col("key").isNotNull() & F.col("region").isin(*regions)).select("key", "region", F.current_timestamp().alias("at"))
    held = [F.max(F.col("region") == r).alias(f"r{i}") for i, r in enumerate(regions)]
    # the time is that of the batch, also if the batch is repeated: a key seen before began at another one
    state = known.groupBy("key").agg(*held, F.min("at").alias("first"), F.max("at").alias("last"))
    present = F.filter(F.array(*[F.when(F.col(f"r{i}"), F.lit(r)) for i, r in enumerate(regions)]), lambda r: r.isNotNull())

    def write(df: DataFrame, batch: int) -> None:
        new = df.where("first = last").select("key", present.alias("present"))
        asked = new.select(
            "key", F.col("present")[0].alias("source"),
            F.explode(F.array_except(F.array(*[F.lit(r) for r in regions]), F.col("present"))).alias("region"), F.lit("copy").alias("action"),
        )
        asked.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    with rocksdb(spark):
        query = (
            state.writeStream.outputMode("update").option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True)
            .foreachBatch(write).start()
        )
        query.awaitTermination()
    if progress is not None:
        progress.extend(map(batch_counts, query.recentProgress))
    return spark.read.schema(COPY).option("basePath", out).parquet(out).drop("batch")
