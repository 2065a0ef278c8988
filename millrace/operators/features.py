"""Feature engineering: fit gives a small parameter table, transform applies it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.layout import join_null_safe
from millrace.plans.ordered import Ordered
from millrace.plans.quantiles import exact_quantiles


def smallest_mode(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value, the smallest of equally frequent ones."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias(column))


def impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    fills = {c: exact_quantiles(df, [], c, {"m": 0.5}).scalar() for c in numeric}
    fills.update({c: smallest_mode(df, c).scalar() for c in categorical})
    return df.withColumns({c: F.coalesce(F.col(c), fill) for c, fill in fills.items()})


def fixed_bins(value: Column, edges: Sequence[float]) -> Column:
    """Right-closed intervals; values outside them become the text ``nan``."""
    out = F.lit("nan")
    for low, high in zip(edges, edges[1:]):
        out = F.when((value > low) & (value <= high), f"({low}, {high}]").otherwise(out)
    return out


def equal_width_bins(df: DataFrame, column: str, bins: int, name: str = "bin") -> DataFrame:
    """Right-closed bins of equal width over the range; the minimum is in the first."""
    span = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    place = F.ceil((F.col(column) - span["lo"]) * bins / (span["hi"] - span["lo"])) - 1
    return df.withColumn(name, F.greatest(place, F.lit(0)).cast("int"))


def ratio(a: Column, b: Column) -> Column:
    return a / (b + 1)


def present_sum(columns: Sequence[str]) -> Column:
    return sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))


def fit_labels(df: DataFrame, column: str, hot_rows: int | None = None) -> DataFrame:
    """value -> index in sorted order."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("value")).distinct()
    return Ordered(values, [], ["value"], hot_rows).running(n=("count", F.lit(1))).select(
        "value", (F.col("n") - 1).cast("int").alias("code")
    )


def encode_labels(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Unseen values take class 0."""
    m = mapping.select(F.col("value").alias(column), F.col("code").alias(f"{column}_code"))
    return df.join(m, column, "left").na.fill(0, [f"{column}_code"])


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of mean and population deviation per column; a zero deviation becomes one."""
    std = lambda c: F.stddev_pop(c)
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[F.when(std(c) == 0, 1.0).otherwise(std(c)).alias(f"{c}_std") for c in columns],
    )


def scale(df: DataFrame, columns: Sequence[str], fitted: DataFrame) -> DataFrame:
    row = fitted.select(F.struct("*")).scalar()
    scaled = {c: (F.col(c) - row[f"{c}_mean"]) / row[f"{c}_std"] for c in columns}
    return df.withColumns(scaled)


def stratified_split(
    df: DataFrame, key: str, label: str, test: float = 0.2, validation: float = 0.1, seed: int = 42,
    hot_rows: int | None = None,
) -> DataFrame:
    """test, val and train rows in proportion per class, by a hash order of the key.

    Only key, label and hash are ranked; a class with most of the rows is
    ranked in slices.
    """
    order = F.md5(F.concat_ws("-", F.col(key), F.lit(seed)))
    rows = df.select(key, label, order.alias("_h"))
    ranked = Ordered(rows, [label], ["_h", key], hot_rows).running(_rank=("count", F.lit(1)))
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    n_test = F.ceil(F.col("_n") * F.lit(test))
    n_val = F.ceil((F.col("_n") - n_test) * F.lit(validation / (1 - test)))
    split = F.when(F.col("_rank") <= n_test, "test").when(F.col("_rank") <= n_test + n_val, "val").otherwise("train")
    return join_null_safe(ranked, sizes, [label], "inner").select(key, label, split.alias("split"))


def shard(df: DataFrame, key: str, world: int, drop_last: bool = False, hot_rows: int | None = None) -> DataFrame:
    """Row i goes to rank i mod ``world``; ranks are made equal by padding or dropping."""
    numbered = Ordered(df.select(key), [], [key], hot_rows).running(_n=("count", F.lit(1)))
    rows = numbered.select(key, (F.col("_n") - 1).alias("position"))
    total = df.agg(F.count(F.lit(1))).scalar()
    if drop_last:
        rows = rows.where(F.col("position") < F.floor(total / world) * world)
    else:
        first = rows.where(F.col("position") < F.ceil(total / world) * world - total)
        rows = rows.unionByName(first.withColumn("position", F.col("position") + total))
    return rows.withColumn("rank", (F.col("position") % world).cast("int"))


def channel_stats(df: DataFrame, vector: str, channels: int) -> DataFrame:
    """Mean and population deviation per vector position, in one pass without exploding."""
    at = lambda i: F.get(F.col(vector), F.lit(i)).cast("double")
    return df.agg(
        F.array(*[F.avg(at(i)) for i in range(channels)]).alias("mean"),
        F.array(*[F.stddev_pop(at(i)) for i in range(channels)]).alias("std"),
    )


def normalise_channels(vector: Column, mean: Column, std: Column) -> Column:
    centred = F.zip_with(vector, mean, lambda x, m: x.cast("double") - m)
    return F.zip_with(centred, std, lambda x, s: x / s)
