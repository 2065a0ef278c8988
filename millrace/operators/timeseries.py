"""Metric queries over samples (series columns, ts in microseconds, value).

A rate is the reset-corrected increase inside (step - window, step] divided by
the window; nothing is extrapolated to the window's edges. Samples are reduced
to one partial result per series and step before any window is formed, so the
rows of a series are bounded by its steps however often it is scraped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.ordered import Ordered

SECOND = 1_000_000


def step_end(ts_us: Column, step: int) -> Column:
    """Second of the first evaluation step at or after a time."""
    return (F.ceil(ts_us / F.lit(step * SECOND)) * step).cast("bigint")


def spread(partials: DataFrame, window: int, step: int) -> DataFrame:
    """Copy each per-step partial to the steps whose window covers it."""
    ahead = F.sequence(F.lit(0), F.lit(window - step), F.lit(step))
    return partials.select("*", F.explode(ahead).alias("_ahead")).withColumn("step", F.col("step") + F.col("_ahead")).drop("_ahead")


def increments(samples: DataFrame, series: Sequence[str], order: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Growth since the previous sample; after a reset the new value itself."""
    prev = F.col("_prev")
    lagged = Ordered(samples, series, order, hot_rows).lag(_prev=F.col("value"))
    grown = F.when(prev.isNull(), 0.0).when(F.col("value") < prev, F.col("value")).otherwise(F.col("value") - prev)
    return lagged.withColumn("increase", grown).drop("_prev")


def rates(samples: DataFrame, series: Sequence[str], order: Sequence[str], window: int, step: int, hot_rows: int | None = None) -> DataFrame:
    """(series, step, increase, rate)."""
    inc = increments(samples, series, order, hot_rows)
    per_step = inc.groupBy(*series, step_end(F.col("ts"), step).alias("step")).agg(F.sum("increase").alias("increase"))
    out = spread(per_step, window, step).groupBy(*series, "step").agg(F.sum("increase").alias("increase"))
    return out.withColumn("rate", F.col("increase") / window)


def by_label(points: DataFrame, labels: Sequence[str], value: str) -> DataFrame:
    return points.groupBy(*labels, "step").agg(F.sum(value).alias("total"), F.avg(value).alias("average"))


def ratio_of(points: DataFrame, labels: Sequence[str], part: Column, value: str) -> DataFrame:
    """Share of the rows matching ``part`` in the sum of all."""
    return points.groupBy(*labels, "step").agg(
        F.try_divide(F.sum(F.when(part, F.col(value)).otherwise(0.0)), F.sum(value)).alias("ratio")
    )


# fixed values: bucket bounds in seconds or as shares
BUCKETS = {
    "request": [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0],
    "inference": [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0],
    "confidence": [0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0],
    "llm": [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0],
    "upload": [1, 5, 10, 30, 60, 120, 300, 600, 1800, 3600],
}


def cumulative_buckets(df: DataFrame, keys: Sequence[str], value: str, bounds: Sequence[float]) -> DataFrame:
    """(keys, le, count) with an infinite last bucket; all bounds in one pass."""
    wide = df.groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(bounds)], F.count(value).alias(f"b{len(bounds)}")
    )
    entries = [F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate([*bounds, float("inf")])]
    return wide.select(*keys, F.explode(F.array(*entries)).alias("b")).select(*keys, "b.le", F.col("b.n").alias("count"))


def histogram_quantile(buckets: DataFrame, keys: Sequence[str], q: float) -> DataFrame:
    """Linear interpolation in the bucket holding rank q * total.

    A group has one row per bucket bound, so its list is short.
    """
    per = buckets.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("le", "count"))).alias("b"))
    total = F.element_at("b", -1)["count"]
    rank = F.lit(q) * total
    hit = F.array_position(F.transform("b", lambda x: x["count"] >= rank), True).cast("int")
    top = hit == F.size("b")
    low = F.when(hit == 1, 0.0).otherwise(F.try_element_at("b", hit - 1)["le"])
    before = F.when(hit == 1, 0).otherwise(F.try_element_at("b", hit - 1)["count"])
    here = F.try_element_at("b", hit)
    inside = low + (here["le"] - low) * F.try_divide(rank - before, (here["count"] - before).cast("double"))
    per = per.where(F.element_at("b", -1)["count"] > 0)
    return per.select(*keys, F.when(top, low).otherwise(inside).alias("quantile"))


def slope(samples: DataFrame, series: Sequence[str], window: int, step: int) -> DataFrame:
    """Least-squares slope per second in the window before each step.

    Sums are kept relative to the step end and shifted, which avoids the loss
    of digits that absolute times would bring.
    """
    end = step_end(F.col("ts"), step)
    t = F.col("ts") / SECOND - end
    v = F.col("value")
    part = samples.groupBy(*series, end.alias("step")).agg(
        F.count(v).cast("double").alias("n"), F.sum(t).alias("st"), F.sum(v).alias("sv"), F.sum(t * t).alias("stt"), F.sum(t * v).alias("stv")
    )
    moved = part.select("*", F.explode(F.sequence(F.lit(0), F.lit(window - step), F.lit(step))).alias("a"))
    a = -F.col("a").cast("double")
    sums = moved.groupBy(*series, (F.col("step") + F.col("a")).alias("step")).agg(
        F.sum("n").alias("n"), F.sum(F.col("st") + F.col("n") * a).alias("st"), F.sum("sv").alias("sv"),
        F.sum(F.col("stt") + 2 * a * F.col("st") + F.col("n") * a * a).alias("stt"), F.sum(F.col("stv") + a * F.col("sv")).alias("stv"),
    )
    top = F.col("n") * F.col("stv") - F.col("st") * F.col("sv")
    bottom = F.col("n") * F.col("stt") - F.col("st") * F.col("st")
    return sums.where("n >= 2").select(*series, "step", F.try_divide(top, bottom).alias("slope"))


def average_over_time(points: DataFrame, labels: Sequence[str], value: str, window: int, step: int) -> DataFrame:
    """Mean over the window of the per-step mean."""
    inner = points.groupBy(*labels, step_end(F.col("ts"), step).alias("step")).agg(F.avg(value).alias("value"))
    return spread(inner, window, step).groupBy(*labels, "step").agg(F.avg("value").alias("average"))


def absent(samples: DataFrame, series: Sequence[str], step: int) -> DataFrame:
    """(series, step) without any sample between the first and the last step of all."""
    present = samples.select(*series, step_end(F.col("ts"), step).alias("step")).distinct()
    span = present.agg(F.struct(F.min("step").alias("lo"), F.max("step").alias("hi"))).scalar()
    expected = present.select(*series).distinct().withColumn("_span", span).select(
        *series, F.explode(F.sequence(F.col("_span.lo"), F.col("_span.hi"), F.lit(step).cast("bigint"))).alias("step")
    )
    return expected.join(present, [*series, "step"], "left_anti")


def targets_up(present: DataFrame, labels: Sequence[str], target: str) -> DataFrame:
    return present.groupBy(*labels, "step").agg(F.count_distinct(target).alias("up"))


def alert_states(points: DataFrame, series: Sequence[str], condition: Column, hold: int, severity: str) -> DataFrame:
    """pending from the first step of a run, firing once it has lasted ``hold`` seconds.

    Steps without a point end a run only through a false condition; one row per
    series and step bounds the window.
    """
    w = Window.partitionBy(*series).orderBy("step")
    flagged = points.withColumn("_on", F.coalesce(condition, F.lit(False)))
    run = flagged.withColumn("_run", F.sum((~F.col("_on")).cast("int")).over(w))
    inside = Window.partitionBy(*series, "_run", "_on").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    since = F.when(F.col("_on"), F.min("step").over(inside))
    held = run.withColumn("active_since", since)
    state = F.when(~F.col("_on"), "inactive").when(F.col("step") - F.col("active_since") >= hold, "firing").otherwise("pending")
    return held.select(*series, "step", "active_since", state.alias("state"), F.lit(severity).alias("severity"))


def burn(requests: DataFrame, labels: Sequence[str], window: int, step: int, budget: float = 0.001, factor: float = 14.4) -> DataFrame:
    """Error share over the window against the budget and its strict multiple."""
    per = requests.groupBy(*labels, step_end(F.col("ts"), step).alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("success").alias("ok")
    )
    sums = spread(per, window, step).groupBy(*labels, "step").agg(F.sum("n").alias("n"), F.sum("ok").alias("ok"))
    share = 1 - F.col("ok") / F.col("n")
    return sums.select(*labels, "step", share.alias("error_share"), (share > budget).alias("over"), (share > budget * factor).alias("fast_burn"))


def objectives(requests: DataFrame, rules: dict[str, tuple[Column, float]]) -> DataFrame:
    """``rules``: name -> (good event, objective). Bad events are total minus good."""
    n = F.count(F.lit(1))
    once = requests.agg(n.alias("_n"), *[F.count_if(good).alias(k) for k, (good, _) in rules.items()])
    entries = []
    for k, (_, target) in rules.items():
        share = F.col(k) / F.col("_n")
        left = 1 - (1 - share) / F.lit(1 - target)
        entries.append(
            F.struct(
                F.lit(k).alias("objective"), F.lit(float(target)).alias("target"), share.alias("attained"),
                (share >= target).alias("met"), left.alias("budget_left"),
            )
        )
    return once.select(F.explode(F.array(*entries)).alias("o")).select("o.*")


def usage_ratio(samples: DataFrame, labels: Sequence[str], used: str, total: str, limit: float) -> DataFrame:
    """``used / total`` of two gauges per label and step, latest sample of each."""
    latest = lambda n: F.max_by(F.when(F.col("name") == n, F.col("value")), F.when(F.col("name") == n, F.col("ts")))
    both = samples.groupBy(*labels, "step").agg(latest(used).alias("used"), latest(total).alias("total"))
    out = both.withColumn("ratio", F.try_divide("used", "total")).where("ratio is not null")
    return out.withColumn("alert", F.col("ratio") > limit)


def alert_life(events: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Per alert: last fire, the resolve after it if any, and whether it is active."""
    fired = F.max(F.when(F.col("action") == "fire", F.col("ts")))
    resolved = F.max(F.when(F.col("action") == "resolve", F.col("ts")))
    per = events.groupBy(key).agg(
        F.max_by("severity", F.struct(*order)).alias("severity"), F.max_by("action", F.struct(*order)).alias("last"),
        fired.alias("fired_at"), resolved.alias("resolved"), F.count_if(F.col("action") == "fire").alias("times"),
    ).where("fired_at is not null")
    active = F.col("last") == "fire"
    return per.select(key, "severity", "fired_at", F.when(~active, F.col("resolved")).alias("resolved_at"), active.alias("active"), "times")


def over_budget(costs: DataFrame, budgets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Monthly cost per key against its monthly budget."""
    monthly = costs.groupBy(*keys, F.date_format("ts", "yyyy-MM").alias("month")).agg(F.sum("amount").alias("cost"))
    return monthly.join(budgets, list(keys)).withColumn("over", F.col("cost") > F.col("budget"))
