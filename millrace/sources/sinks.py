"""Writes and merges. Tables are immutable parquet; a merge gives the new version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.aggregates import cost_shares
from millrace.operators.filters import recommendations
from millrace.operators.windows import group_outliers, trend
from millrace.plans.ordered import Ordered


def save_raw(df: DataFrame, path: str, saved_at: str) -> DataFrame:
    """CSV plus a one-row JSON sidecar."""
    spark = df.sparkSession
    df.write.option("header", True).csv(f"{path}/data")
    # what was written is counted; the input may differ when it is computed again
    rows = spark.read.options(header=True, multiLine=True).csv(f"{path}/data").count()
    size = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(f"{path}/data").agg(F.sum("length")).first()[0]
    meta = spark.createDataFrame(
        [(path.rsplit("/", 1)[-1], rows, len(df.columns), df.columns, saved_at, size)], SIDECAR
    )
    meta.write.json(f"{path}/metadata")
    return meta


SIDECAR = "filename string, record_count bigint, column_count int, columns array<string>, saved_at string, file_size_bytes bigint"


def read_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """Sidecar of a saved file, empty when there is none."""
    try:
        return spark.read.schema(SIDECAR).json(f"{path}/metadata")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SIDECAR)


def save_splits(df: DataFrame, path: str, split: str = "split") -> DataFrame:
    df.write.partitionBy(split).parquet(path)
    saved = df.sparkSession.read.parquet(path)
    columns = [c for c in saved.columns if c != split]
    return saved.groupBy(split).agg(F.count(F.lit(1)).alias("record_count")).withColumn("columns", F.lit(len(columns)))


def upsert(target: DataFrame, updates: DataFrame, key: str, replace: Sequence[str]) -> DataFrame:
    """Insert new keys; on existing ones only the ``replace`` columns change."""
    u = updates.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in target.columns if c != key])
    both = target.withColumn("_old", F.lit(True)).join(u, F.col(key) == F.col("_key"), "full_outer")
    old, new = F.col("_old").isNotNull(), F.col("_key").isNotNull()
    pick = lambda c: F.when(new & (F.lit(c in replace) | ~old), F.col(f"_{c}")).otherwise(F.col(c))
    return both.select(
        *[(F.coalesce(key, "_key") if c == key else pick(c)).alias(c) for c in target.columns]
    )


def insert_or_ignore(target: DataFrame, batch: DataFrame, unique: Sequence[str], order: str) -> DataFrame:
    """Rows of the batch to insert: the first per unique key that the target does not have."""
    first = batch.groupBy(*unique).agg(F.min(order).alias(order))
    fresh = first.join(target.select(*unique), list(unique), "left_anti").select(order)
    return batch.join(fresh, order, "left_semi")


def add_counters(target: DataFrame, delta: DataFrame, keys: Sequence[str], counters: Sequence[str]) -> DataFrame:
    return target.unionByName(delta).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])


def update_vectors(target: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """New values of ``columns`` on the keys of ``updates``, nulls included; other rows stay."""
    u = updates.select(key, F.lit(True).alias("_met"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = target.join(u, key, "left")
    new = lambda c: F.when(F.col("_met"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
    return joined.select(*[new(c) if c in columns else c for c in target.columns])


def vector_text(vector: Column) -> Column:
    """``[a,b,...]`` with eight decimals."""
    return F.concat(F.lit("["), F.array_join(F.transform(vector, lambda x: F.format_string("%.8f", x.cast("double"))), ","), F.lit("]"))


def delete_keys(target: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return target.join(gone.select(key), key, "left_anti")


def scalar_metadata(record: Column) -> Column:
    """Entries of a JSON object that are no nested object and not null."""
    return F.map_filter(F.from_json(record, "map<string,string>"), lambda k, v: v.isNotNull() & ~v.startswith("{"))


def write_daily(df: DataFrame, ts: str, path: str, spread: str) -> None:
    """One folder per calendar day; rows are range partitioned on (day, ``spread``),
    so that a busy day is written by several tasks and a quiet one by a single task."""
    dated = df.withColumn("day", F.date_format(ts, "yyyy.MM.dd"))
    dated.repartitionByRange("day", spread).write.partitionBy("day").parquet(path)


def append_metrics(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def report_rows(costs: DataFrame) -> DataFrame:
    """CSV form of a cost report: a total row and one row per provider."""
    per = costs.groupBy("provider").agg(F.sum("amount").alias("amount"))
    total = per.agg(F.sum("amount").alias("amount")).select(F.lit("Total").alias("provider"), "amount")
    return total.unionByName(per)


def report_document(costs: DataFrame, start: str, end: str, limits: dict[str, tuple[float, str, int]] | None = None) -> DataFrame:
    """One JSON document: period, total, a map per dimension, anomalies, trends and recommendations.

    ``costs``: provider, region, service, day, amount; only days from ``start``
    to ``end`` count. Anomalies are the days on which a service's cost lies
    more than two deviations from its mean, trends compare the last days,
    and ``limits`` are rules on the shares of providers. All lists are
    bounded by the days of the period, the services and the rules.
    """
    costs = costs.where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    daily = costs.groupBy("service", "day").agg(F.sum("amount").cast("double").alias("amount"))
    odd = group_outliers(daily, "service", "amount").select("day", "service", "amount", "average", "std_dev", "severity")
    days = daily.groupBy("day").agg(F.sum("amount").alias("amount"))
    trends = trend(days, "day", "amount").select(F.struct("daily_change", "weekly_change")).scalar()
    advice = recommendations(cost_shares(costs, "provider", "amount"), "provider", limits or {"": (100.0, "", 0)})

    def listed(df):
        return df.agg(F.array_sort(F.collect_list(F.struct(*df.columns)))).scalar()

    dims = ["provider", "region", "service"]
    cells = costs.groupBy(*dims).agg(F.sum("amount").alias("amount"))

    def breakdown(d):
        # one entry per member of a short dimension
        sums = cells.groupBy(d).agg(F.sum("amount").cast("double").alias("amount"))
        return sums.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(d, "amount"))))).scalar()

    total = cells.agg(F.sum("amount").cast("double").alias("total"))
    return total.select(
        F.to_json(
            F.struct(
                F.struct(F.lit(start).alias("start"), F.lit(end).alias("end")).alias("period"),
                F.struct("total").alias("summary"), *[breakdown(d).alias(f"by_{d}") for d in dims],
                listed(odd).alias("anomalies"), trends.alias("trends"), listed(advice).alias("recommendations"),
            )
        ).alias("report")
    )


# fixed values: states of a file and the moves between them
STATES = ["PENDING", "UPLOADING", "VERIFYING", "UPLOADED", "DELETED", "EVICTED", "STUCK", "ERROR", "CORRUPTED"]
MOVES = [
    ("PENDING", "UPLOADING"), ("PENDING", "EVICTED"), ("UPLOADING", "VERIFYING"), ("UPLOADING", "PENDING"),
    ("UPLOADING", "ERROR"), ("UPLOADING", "STUCK"), ("VERIFYING", "UPLOADED"), ("VERIFYING", "ERROR"),
    ("VERIFYING", "CORRUPTED"), ("ERROR", "PENDING"), ("ERROR", "STUCK"), ("STUCK", "PENDING"), ("UPLOADED", "DELETED"),
]


def audit_transitions(log: DataFrame, key: str, order: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Each state event with the state before it and whether the move is allowed."""
    lagged = Ordered(log, [key], order, hot_rows).lag(old_state=F.col("state"))
    move = F.concat_ws(">", "old_state", "state")
    allowed = F.col("state").isin(*STATES) & (F.col("old_state").isNull() | move.isin(*[f"{a}>{b}" for a, b in MOVES]))
    return lagged.withColumn("valid", allowed)


def current_state(log: DataFrame, key: str, order: Sequence[str], at: str) -> DataFrame:
    """Latest state per file, with the times it was last uploaded and deleted."""
    stamp = lambda s: F.max(F.when(F.col("state") == s, F.col(at)))
    return log.groupBy(key).agg(
        F.max_by("state", F.struct(*order)).alias("state"),
        stamp("UPLOADED").alias("uploaded_at"), stamp("DELETED").alias("deleted_at"),
    )
