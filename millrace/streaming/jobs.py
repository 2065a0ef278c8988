"""Running streams: a bounded run over what is there, written once per batch."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.session import new_path

#: a time behind that of any row
END = "TIMESTAMP '2261-01-01 00:00:00'"


def stream_table(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The parquet table ``folder/name.parquet`` (a file or a folder of files) as a stream."""
    path = f"{folder}/{name}.parquet"
    batch = spark.read.parquet(path)
    single = batch.select("_metadata.file_name").first()
    reader = spark.readStream.schema(batch.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if single is not None and single[0] == f"{name}.parquet":
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(path)


def with_end(stream: DataFrame, time: str, end: str) -> DataFrame:
    """``stream`` and the rows of the folder ``end``, marked by ``row_end``: none until ``run_available`` ends the input.

    The one row that it writes there stands behind all others in the column
    ``time``, so the watermark passes whatever rows, windows and keys wait for it.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], f"{time} timestamp").write.mode("append").parquet(end)
    last = spark.readStream.schema(f"{time} timestamp").parquet(end).withColumn("row_end", F.lit(True))
    return stream.withColumn("row_end", F.lit(False)).unionByName(last, allowMissingColumns=True)


def batch_counts(progress) -> tuple[int, int, int]:
    """(batch, rows read, rows that came behind the watermark and were dropped) of a query's progress."""
    told = json.loads(progress.json)
    dropped = sum(o.get("numRowsDroppedByWatermark", 0) for o in told["stateOperators"])
    return told["batchId"], told["numInputRows"], dropped


def replayed_lateness(table: DataFrame, time: str | Column, least: str = "1 hour") -> str:
    """How late rows of a written table come, if its files are read one after the other as the file stream does.

    Files are read in the order of their modification time and path. One row
    for each file, as the driver lists them, is compared with the latest time
    in the files before it.
    """
    moment = F.unix_micros((F.col(time) if isinstance(time, str) else time).cast("timestamp"))
    files = table.groupBy(F.unix_millis("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("path")).agg(
        F.min(moment).alias("first"), F.max(moment).alias("last")
    )
    # files of one moment may be read in any order
    before = Window.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    behind = files.select("path", (F.max("last").over(before) - F.col("first")).alias("us"))
    n, most = behind.agg(F.count(F.lit(1)), F.max("us")).first()
    return least if n < 2 or (most or 0) <= 0 else f"{most // 1000 + 1} milliseconds"


def run_available(
    stream: DataFrame, checkpoint: str | None = None, target: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None, end: str | None = None, once: Sequence[str] = (),
    progress: list | None = None,
) -> DataFrame:
    """Process all available input and return the written table.

    Each batch replaces its own folder, so a repeated batch leaves no second
    copy. ``end`` is the folder of ``with_end``: when all input is processed,
    the input is declared over, and what waits for the watermark comes out. A
    run that goes on later leaves it away. Of the rows that agree in the
    columns ``once``, those of the first batch that has them are written, one of them.
    ``progress`` gets a (batch, rows read, rows dropped as late) for each batch.
    """
    spark = stream.sparkSession
    target = target or new_path(spark, "stream")
    checkpoint = checkpoint or new_path(spark, "checkpoint")

    def write(df: DataFrame, batch: int) -> None:
        out = transform(df) if transform else df
        if once:
            out = out.dropDuplicates(list(once))
            if batch > 0:
                # the batches before this one, whose folders no longer change
                written = spark.read.schema(StructType([*out.schema.fields, StructField("batch", LongType())])).parquet(target)
                known = written.where(F.col("batch") < batch).select(*[F.col(c).alias(f"_{c}") for c in once])
                match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in once]
                out = out.join(known, match, "left_anti")
        out.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if end:
        # one start for the input and its end, as a start costs more than a batch
        query = writer.start()
        try:
            query.processAllAvailable()
            column = spark.read.parquet(end).columns[0]
            spark.sql(f"SELECT {END} AS {column}").write.mode("append").parquet(end)
            query.processAllAvailable()
        finally:
            query.stop()
    else:
        query = writer.trigger(availableNow=True).start()
        # ends by itself when all input is processed, and raises what ended it otherwise
        query.awaitTermination()
    if progress is not None:
        progress.extend(map(batch_counts, query.recentProgress))
    return spark.read.option("basePath", target).parquet(target).drop("batch")
