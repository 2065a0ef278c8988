"""Exact quantiles by rank, linear between neighbours or by index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans import ordered


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    by_index: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per key with a column per entry of ``quantiles``.

    ``by_index`` takes the element at ``int(n * q)`` of the sorted values
    instead of interpolating. Groups that fit one task use the built-in
    ``percentile``; larger ones are counted per distinct value, scanned by
    rank in slices and read off with conditional aggregates.
    """
    keys = list(keys)
    df = df.where(F.col(value).isNotNull())
    limit = ordered.HOT_ROWS if hot_rows is None else hot_rows
    top, _ = ordered.largest_group(df, keys)
    if top <= limit and not by_index:
        # one aggregate keeps one table of values for all quantiles
        wanted = F.percentile(value, F.array(*[F.lit(float(q)) for q in quantiles.values()]))
        found = df.groupBy(*keys).agg(wanted.alias("_q"))
        return found.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(quantiles)])
    ranked = ordered.running_total_over_groups(df, keys, value, limit)
    totals = df.groupBy(*[F.col(k).alias(f"_g{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    if keys:
        on = [ranked[k].eqNullSafe(totals[f"_g{k}"]) for k in keys]
        ranked = ranked.join(totals, on)
    else:
        ranked = ranked.withColumn("_rows", totals.scalar())

    def position(q: float) -> list[Column]:
        if by_index:
            return [F.least(F.floor(F.col("_rows") * F.lit(float(q))), F.col("_rows") - 1)]
        place = (F.col("_rows") - 1) * F.lit(float(q))
        return [F.floor(place), F.ceil(place)]

    picks = []
    for name, q in quantiles.items():
        for i, pos in enumerate(position(q)):
            picks.append(F.min(F.when(F.col("cum") > pos, F.col(value))).alias(f"_{name}_{i}"))
    found = ranked.groupBy(*keys).agg(F.max("_rows").alias("_rows"), *picks)
    columns = []
    for name, q in quantiles.items():
        if by_index:
            columns.append(F.col(f"_{name}_0").alias(name))
        else:
            place = (F.col("_rows") - 1) * F.lit(float(q))
            low, high = F.col(f"_{name}_0"), F.col(f"_{name}_1")
            columns.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*keys, *columns)
