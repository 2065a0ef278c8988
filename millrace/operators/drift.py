"""Distances between a reference and a current sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.stats import kolmogorov_tail
from millrace.operators.joins import category_frequencies
from millrace.plans.ordered import Ordered
from millrace.session import materialise


def sided(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long form: (feature, value, r, c) with one flag per side, nulls dropped."""
    long = lambda df, r, c: df.select(*[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        [], list(features), "feature", "value"
    ).select("feature", "value", F.lit(r).alias("r"), F.lit(c).alias("c"))
    return long(reference, 1, 0).unionByName(long(current, 0, 1)).where("value is not null")


def ks_statistic(reference: DataFrame, current: DataFrame, features: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """Largest distance of the two empirical distributions per feature, with sample sizes.

    Rows are counted per distinct value first; the running counts over those
    are taken in slices when a feature has very many values.
    """
    sums = sided(reference, current, features).groupBy("feature", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    counts = materialise(sums, "counts")
    totals = counts.groupBy("feature").agg(F.sum("r").alias("n"), F.sum("c").alias("m"))
    run = Ordered(counts, ["feature"], ["value"], hot_rows).running(cr=("sum", F.col("r")), cc=("sum", F.col("c")))
    # one row per feature
    gaps = run.join(F.broadcast(totals), "feature")
    gap = F.abs(F.try_divide(F.col("cr"), F.col("n")) - F.try_divide(F.col("cc"), F.col("m")))
    return gaps.groupBy("feature").agg(
        F.first("n").alias("n"), F.first("m").alias("m"), F.coalesce(F.max(gap), F.lit(0.0)).alias("statistic")
    )


def ks_drift(stats: DataFrame, threshold: float = 0.1) -> DataFrame:
    return stats.withColumn("drift", F.col("statistic") > threshold)


def ks_decision(stats: DataFrame, alpha: float = 0.05) -> DataFrame:
    p = kolmogorov_tail(F.col("statistic"), F.col("n").cast("double"), F.col("m").cast("double"))
    return stats.withColumn("p_value", p).withColumn("drift", F.col("p_value") < alpha)


def categorical_distance(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    both = category_frequencies(reference, current, column)
    return both.agg(F.max(F.abs(F.col("reference") - F.col("current"))).alias("distance"))


def _jensen_shannon(p: Column, q: Column) -> Column:
    """Square root of the divergence, natural logarithm; p and q need not add up to one."""
    return F.sqrt(F.greatest(F.sum(F.lit(0.5) * (p * F.ln(p / ((p + q) / 2)) + q * F.ln(q / ((p + q) / 2)))), F.lit(0.0)))


def jensen_shannon_categorical(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    both = category_frequencies(reference, current, column, fill=1e-10)
    sums = both.agg(F.struct(F.sum("reference").alias("p"), F.sum("current").alias("q"))).scalar()
    scaled = both.select((F.col("reference") / sums["p"]).alias("p"), (F.col("current") / sums["q"]).alias("q"))
    return scaled.agg(_jensen_shannon(F.col("p"), F.col("q")).alias("distance"))


def with_range(long: DataFrame, reference_only: bool) -> DataFrame:
    side = F.when(F.col("r") == 1, F.col("value")) if reference_only else F.col("value")
    span = long.groupBy("feature").agg(F.min(side).alias("lo"), F.max(side).alias("hi"), F.sum("r").alias("n"), F.sum("c").alias("m"))
    # one row per feature
    return long.join(F.broadcast(span), "feature")


def _binned(reference, current, features, bins, reference_only):
    long = with_range(sided(reference, current, features), reference_only)
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.least(F.floor(F.try_divide(F.col("value") - F.col("lo"), width)), F.lit(bins - 1))
    inside = long.where(F.col("value").between(F.col("lo"), F.col("hi")))
    counts = inside.groupBy("feature", place.alias("bin")).agg(
        F.sum("r").alias("r"), F.sum("c").alias("c"), F.first("n").alias("n"), F.first("m").alias("m")
    )
    # bins + 1 rows per feature at most: add the empty bins
    every = counts.groupBy("feature").agg(F.first("n").alias("n"), F.first("m").alias("m")).select(
        "feature", "n", "m", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin")
    )
    return every.join(counts.select("feature", "bin", "r", "c"), ["feature", "bin"], "left").na.fill(0, ["r", "c"])


def jensen_shannon_numeric(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 29) -> DataFrame:
    cells = _binned(reference, current, features, bins, False)
    p, q = F.col("r") / F.col("n") + 1e-10, F.col("c") / F.col("m") + 1e-10
    sums = cells.select("feature", p.alias("p"), q.alias("q"))
    totals = sums.groupBy("feature").agg(F.sum("p").alias("sp"), F.sum("q").alias("sq"))
    scaled = sums.join(totals, "feature").select("feature", (F.col("p") / F.col("sp")).alias("p"), (F.col("q") / F.col("sq")).alias("q"))
    return scaled.groupBy("feature").agg(_jensen_shannon(F.col("p"), F.col("q")).alias("distance"))


def stability_index(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10, limit: float = 0.25) -> DataFrame:
    """Bins come from the reference; current values outside them are dropped, not the denominators."""
    cells = _binned(reference, current, features, bins, True)
    share = lambda n, total: F.when(n == 0, 1e-10).otherwise(n / total)
    r, c = share(F.col("r"), F.col("n")), share(F.col("c"), F.col("m"))
    out = cells.groupBy("feature").agg(F.sum((c - r) * F.ln(c / r)).alias("psi"))
    return out.withColumn("drift", F.col("psi") > limit)


def side_moments(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    sides = sided(reference, current, [column])
    pick = lambda flag: F.when(F.col(flag) == 1, F.col("value"))
    return sides.agg(
        F.avg(pick("r")).alias("reference_mean"), F.stddev_pop(pick("r")).alias("reference_std"),
        F.avg(pick("c")).alias("current_mean"), F.stddev_pop(pick("c")).alias("current_std"),
        F.count_distinct("value").alias("values"),
    )


def prediction_drift(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Jensen-Shannon distance of class shares for two classes or fewer, else the KS statistic."""
    moments = side_moments(reference, current, column)
    shares = jensen_shannon_categorical(reference, current, column).scalar()
    ks = ks_statistic(reference, current, [column]).select("statistic").scalar()
    binary = F.col("values") <= 2
    return moments.select(
        F.when(binary, "jensen_shannon").otherwise("ks").alias("method"), F.when(binary, shares).otherwise(ks).alias("score"),
        "reference_mean", "reference_std", "current_mean", "current_std",
    )


def drift_summary(decisions: DataFrame) -> DataFrame:
    """``decisions``: feature, drift, statistic. One row over the features, ``scores`` a map by feature."""
    names = F.array_sort(F.filter(F.collect_list(F.when(F.col("drift"), F.col("feature"))), lambda x: x.isNotNull()))
    return decisions.agg(
        F.bool_or("drift").alias("any_drift"), F.count_if("drift").alias("drifted"),
        F.array_join(names, ",").alias("names"), (F.avg(F.col("drift").cast("int")) * 100).alias("percentage"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "statistic")))).alias("scores"),
    )


def accuracy_degradation(pairs: DataFrame, baseline: float, min_samples: int = 100, limit: float = 0.1) -> DataFrame:
    hit = (F.col("predicted") == 1) & (F.col("truth") == 1)
    ratio = lambda a, b: F.coalesce(F.try_divide(F.count_if(a), F.count_if(b)), F.lit(0.0))
    out = pairs.agg(
        F.count(F.lit(1)).alias("samples"),
        F.avg((F.col("predicted") == F.col("truth")).cast("int")).alias("accuracy"),
        ratio(hit, F.col("predicted") == 1).alias("precision"), ratio(hit, F.col("truth") == 1).alias("recall"),
    )
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    drop = F.lit(baseline) - F.col("accuracy")
    return out.withColumn("f1", f1).withColumn("degraded", (F.col("samples") >= min_samples) & (drop > limit))
