"""Exactly-once drain of a buffer: rows are delivered in time order and marked by an entry in a ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.ordered import Ordered

ENTRY = "batch bigint, rows bigint, first struct<{0}>, last struct<{0}>"


def committed(spark: SparkSession, target: str, order_types: str) -> DataFrame:
    """The ledger: one row for each batch that has been delivered and marked."""
    spark.createDataFrame([], "batch bigint").write.mode("append").parquet(f"{target}/ledger")
    return spark.read.schema(ENTRY.format(order_types)).option("recursiveFileLookup", "true").parquet(f"{target}/ledger")


def deliver(rows: DataFrame, target: str, batch: int) -> None:
    """All rows of a batch, in place of what an attempt before this one may have left."""
    rows.write.mode("overwrite").parquet(f"{target}/rows/batch={batch}")


def mark(entry: DataFrame, target: str, batch: int) -> None:
    """The entry that makes a delivered batch count; it is one file, which is there as a whole or not at all."""
    entry.coalesce(1).write.mode("overwrite").parquet(f"{target}/ledger/batch-{batch}")


def drain(buffer: DataFrame, order: Sequence[str], target: str, limit: int = 1000) -> DataFrame:
    """Rows of the stream ``buffer`` that no earlier drain into ``target`` delivered, as this one delivers them.

    Adds ``batch``, ``drain`` and ``place``: rows come in ``order``, over all
    new files together, in drains of ``limit`` rows. The checkpoint lists the
    files of a batch before it starts and the ledger gets its entry, the number
    of rows and the keys of the first and last, after its rows are written. An
    attempt that ends in between is repeated with the same files under the same
    batch number, so its rows replace the ones it left; a batch in the ledger
    is not written again. Readers take the batches that the ledger names.
    Files that come later hold rows that are drained later, whatever their time.
    """
    spark = buffer.sparkSession
    types = ", ".join(f"{n} {buffer.schema[n].dataType.simpleString()}" for n in order)
    key = F.struct(*order)

    def write(df: DataFrame, batch: int) -> None:
        if committed(spark, target, types).where(F.col("batch") == batch).take(1):
            return
        placed = Ordered(df, [], order).running(_n=("count", F.lit(1)))
        rows = placed.select(*df.columns, F.floor((F.col("_n") - 1) / limit).alias("drain"), ((F.col("_n") - 1) % limit).alias("place"))
        deliver(rows, target, batch)
        held = spark.read.parquet(f"{target}/rows/batch={batch}")
        entry = held.agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))
        mark(entry.select(F.lit(batch).cast("bigint").alias("batch"), "rows", "first", "last"), target, batch)

    before = committed(spark, target, types).agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]
    query = buffer.writeStream.option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return delivered(spark, target, types, buffer).where(F.col("batch") > before)


def delivered(spark: SparkSession, target: str, order_types: str, buffer: DataFrame) -> DataFrame:
    """Rows of all batches in the ledger."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in buffer.schema.fields)
    entries = committed(spark, target, order_types).select("batch")
    # the folder is there from the first batch on
    spark.createDataFrame([], f"{fields}, drain bigint, place bigint").write.mode("append").parquet(f"{target}/rows/batch=-1")
    rows = spark.read.schema(f"{fields}, drain bigint, place bigint, batch bigint").option("basePath", f"{target}/rows").parquet(f"{target}/rows")
    # a row for each batch, not for each row
    return rows.join(F.broadcast(entries), "batch")
