"""Ordering, limits and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import bind
from millrace.plans.ordered import Ordered


def upload_queue(files: DataFrame, limit: int, min_priority: int = 0) -> DataFrame:
    """Most urgent priority first, best score first within it."""
    rows = files.where((F.col("state") == "PENDING") & (F.col("priority") >= min_priority))
    return rows.orderBy("priority", F.desc("score"), "file_id").limit(limit)


def request_order(requests: DataFrame, priority: str, arrival: str, hot_rows: int | None = None) -> DataFrame:
    """Place in the queue: high priority first, then by arrival."""
    down = requests.withColumn("_down", -F.col(priority))
    return Ordered(down, [], ["_down", arrival], hot_rows).running(place=("count", F.lit(1))).drop("_down")


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def softmax(logits: Column) -> Column:
    total = lambda raised: F.aggregate(raised, F.lit(0.0), lambda s, x: s + x)
    shares = lambda raised: bind(total(raised), lambda t: F.transform(raised, lambda x: x / t))
    raise_ = lambda peak: F.transform(logits, lambda x: F.exp(x.cast("double") - peak))
    return bind(bind(F.array_max(logits).cast("double"), raise_), shares)


def top_classes(df: DataFrame, key: str, logits: Column, k: int = 5) -> DataFrame:
    indexed = F.transform(softmax(logits), lambda p, i: F.struct(p.alias("p"), (-i).alias("i")))
    best = F.slice(F.sort_array(indexed, asc=False), 1, k)
    return df.select(key, F.posexplode(best).alias("rank", "b")).select(
        key, (F.col("rank") + 1).alias("rank"), (-F.col("b.i")).alias("class"), F.col("b.p").alias("probability")
    )


def least_latency(requests: DataFrame, endpoint: str) -> DataFrame:
    """Endpoint with the lowest mean latency among those with a success."""
    per = requests.where("success").groupBy(endpoint).agg(F.avg("latency").alias("latency"))
    return per.agg(F.min_by(F.struct(endpoint, "latency"), F.struct("latency", endpoint)).alias("b")).select("b.*")


def failover_target(regions: DataFrame) -> DataFrame:
    """Healthy before degraded, then the fastest response."""
    rank = F.when(F.col("health") == "healthy", 0).when(F.col("health") == "degraded", 1)
    usable = regions.where(rank.isNotNull())
    order = F.struct(rank, F.col("response_ms"), F.col("region"))
    return usable.agg(F.min_by(F.struct("region", "health", "response_ms"), order).alias("b")).select("b.*")
