"""Comparison of variants: tests, gates and rollout decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.stats import normal_two_sided, t_two_sided
from millrace.plans.ordered import Ordered
from millrace.plans.quantiles import exact_quantiles
from millrace.session import materialise


def _sides(name, first, second, **aggs):
    pick = lambda side, c: F.when(F.col(name) == side, c)
    return [fn(pick(side, c)).alias(f"{n}{i}") for i, side in ((1, first), (2, second)) for n, (fn, c) in aggs.items()]


def _winner(out: DataFrame, confidence: float, first: str, second: str, first_better) -> DataFrame:
    won = F.coalesce(F.col("p_value") < 1 - confidence, F.lit(False))
    return out.withColumn("has_winner", won).withColumn("winner", F.when(won, F.when(first_better, first).otherwise(second)))


def proportion_test(requests: DataFrame, variant: str, first: str, second: str, confidence: float = 0.95) -> DataFrame:
    """Pooled two-proportion z test on success rates; no variance, no winner."""
    ok = F.col("success").cast("int")
    sums = requests.agg(*_sides(variant, first, second, n=(F.count, F.lit(1)), s=(F.sum, ok)))
    p1, p2 = F.col("s1") / F.col("n1"), F.col("s2") / F.col("n2")
    pool = (F.col("s1") + F.col("s2")) / (F.col("n1") + F.col("n2"))
    se = F.sqrt(pool * (1 - pool) * (1 / F.col("n1") + 1 / F.col("n2")))
    out = sums.select(p1.alias("rate1"), p2.alias("rate2"), F.when(se > 0, F.try_divide(p1 - p2, se)).alias("z"))
    out = out.withColumn("p_value", normal_two_sided("z"))
    return _winner(out, confidence, first, second, F.col("rate1") > F.col("rate2"))


def rank_sum_test(
    requests: DataFrame, variant: str, value: str, first: str, second: str, confidence: float = 0.95, hot_rows: int | None = None
) -> DataFrame:
    """Mann-Whitney U, two-sided with tie and continuity correction; the lower mean wins.

    U needs only the counts per distinct value and their running total.
    """
    rows = requests.where(F.col(variant).isin(first, second) & F.col(value).isNotNull())
    side = lambda v: F.count_if(F.col(variant) == v)
    counts = materialise(rows.groupBy(F.col(value).alias("v")).agg(side(first).alias("a"), side(second).alias("b")), "counts")
    run = Ordered(counts, [], ["v"], hot_rows).running(below=("sum", F.col("b")))
    # doubles: cubes and products of counts leave the range of bigint
    t = (F.col("a") + F.col("b")).cast("double")
    sums = run.agg(
        F.sum("a").alias("n1"), F.sum("b").alias("n2"),
        (F.sum(F.col("a").cast("double") * (2 * F.col("below") - F.col("b"))) / 2).alias("u"),
        F.sum(t * t * t - t).alias("ties"),
        (F.sum(F.col("a") * F.col("v")) / F.sum("a")).alias("mean1"), (F.sum(F.col("b") * F.col("v")) / F.sum("b")).alias("mean2"),
    )
    n = (F.col("n1") + F.col("n2")).cast("double")
    product = F.col("n1").cast("double") * F.col("n2")
    sd = F.sqrt(product / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    away = F.abs(F.col("u") - product / 2) - 0.5
    out = sums.withColumn("z", F.coalesce(F.try_divide(F.greatest(away, F.lit(0.0)), sd), F.lit(0.0))).withColumn("p_value", normal_two_sided("z"))
    out = _winner(out, confidence, first, second, F.col("mean1") < F.col("mean2"))
    return out.select("n1", "n2", "u", "z", "p_value", "has_winner", "winner")


def mean_test(requests: DataFrame, variant: str, value: str, first: str, second: str, confidence: float = 0.95) -> DataFrame:
    """Student t with pooled variance; the higher mean wins."""
    c = F.col(value)
    s = requests.agg(*_sides(variant, first, second, n=(F.count, c), m=(F.avg, c), v=(F.var_samp, c)))
    df = F.col("n1") + F.col("n2") - 2
    pooled = ((F.col("n1") - 1) * F.col("v1") + (F.col("n2") - 1) * F.col("v2")) / df
    t = (F.col("m1") - F.col("m2")) / F.sqrt(pooled * (1 / F.col("n1") + 1 / F.col("n2")))
    out = s.select("m1", "m2", t.alias("t"), df.cast("double").alias("df")).withColumn("p_value", t_two_sided("t", "df"))
    return _winner(out, confidence, first, second, F.col("m1") > F.col("m2"))


def sample_gate(stats: DataFrame, min_samples: int = 100) -> DataFrame:
    """``stats``: variant, request_count. Ready only when every variant has enough requests."""
    short = F.col("request_count") < min_samples
    names = F.array_sort(F.filter(F.collect_list(F.when(short, F.col("variant"))), lambda x: x.isNotNull()))
    out = stats.agg(F.bool_and(~short).alias("ready"), F.array_join(names, ",").alias("too_small"), F.sum("request_count").alias("requests"))
    return out.withColumn("reason", F.when(F.col("ready"), "enough samples").otherwise("insufficient samples"))


# fixed values: traffic share per rollout stage
STAGES = [10, 25, 50, 75, 100]


def canary_decision(
    stats: DataFrame, keys: Sequence[str], error_limit: float = 0.05, latency_limit: float = 1.5,
    min_rollback: int = 10, min_promote: int = 100, min_seconds: float = 300.0,
) -> DataFrame:
    """``stats``: keys, version (baseline or canary), requests, errors, latency, seconds."""
    side = lambda v, c: F.max(F.when(F.col("version") == v, F.col(c)))
    one = stats.groupBy(*keys).agg(
        side("canary", "requests").alias("requests"), side("canary", "errors").alias("errors"),
        side("canary", "latency").alias("latency"), side("canary", "seconds").alias("seconds"),
        side("baseline", "latency").alias("base"),
    )
    n = F.coalesce(F.col("requests"), F.lit(0))
    error_rate = F.coalesce(F.try_divide(F.col("errors"), F.col("requests")), F.lit(0.0))
    ratio = F.when((F.col("base") > 0) & (F.col("latency") > 0), F.col("latency") / F.col("base")).otherwise(0.0)
    bad = (error_rate > error_limit) | (ratio > latency_limit)
    action = (
        F.when((n >= min_rollback) & bad, "rollback")
        .when((n >= min_promote) & (F.col("seconds") >= min_seconds) & ~bad, "promote")
        .otherwise("wait")
    )
    return one.select(*keys, n.alias("requests"), error_rate.alias("error_rate"), ratio.alias("latency_ratio"), action.alias("action"))


def index_percentile(df: DataFrame, keys: Sequence[str], value: str, q: float = 0.99, hot_rows: int | None = None) -> DataFrame:
    """Element at ``int(n * q)`` of the sorted values."""
    return exact_quantiles(df, keys, value, {"percentile": q}, by_index=True, hot_rows=hot_rows)


def side_by_side(metrics: DataFrame, runs: Sequence[str]) -> DataFrame:
    """``metrics``: run, metric, value; one column per run."""
    return metrics.groupBy("metric").pivot("run", list(runs)).agg(F.first("value"))


def rollout_stages(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, canary: str, ok: str, latency: str, keep: Sequence[str],
    stages: Sequence[int] = (10, 25, 50, 75, 100), error_limit: float = 0.05, latency_limit: float = 1.5,
    min_rollback: int = 10, min_promote: int = 100, min_age: int = 300_000_000, hot_rows: int | None = None, salts: int = 16,
) -> DataFrame:
    """Promotions and the rollback of staged rollouts: one row each, at the request that decides it.

    Running counts of a key are taken once; a stage's counts are those less
    what stood there when the stage began. So a stage costs one pass, whose
    first deciding request of each key is a minimum, and there are at most as
    many passes as stages; no task holds the requests of a key. Keys meet the
    begin of their stage in ``salts`` parts. Keys must not be null; a request
    whose outcome is null has failed, one without a latency adds none. Latencies are
    summed as doubles, so a ratio at the limit itself may differ in its last digit.
    """
    new, ms = F.coalesce(F.col(canary), F.lit(False)), F.coalesce(F.col(latency).cast("double"), F.lit(0.0))
    bad = new & ~F.coalesce(F.col(ok), F.lit(False))
    sums = {
        "_n": new.cast("bigint"), "_bad": bad.cast("bigint"), "_ms": F.when(new, ms).otherwise(0.0),
        "_base": (~new).cast("bigint"), "_base_ms": F.when(new, 0.0).otherwise(ms),
    }
    rows = Ordered(df, keys, order, hot_rows).running(**{n: ("sum", c) for n, c in sums.items()})
    place = F.struct(*order)
    own = [c for c in dict.fromkeys([*order, ts, *keep]) if c not in keys]
    part = F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int")
    rows = materialise(rows.select(*keys, *own, place.alias("_at"), part.alias("_part"), *sums), "requests")
    first = rows.groupBy(*keys).agg(F.min("_at").alias("_from"), F.min_by(ts, "_at").alias("_since"))
    begin = first.select(*keys, F.lit(None).cast(rows.schema["_at"].dataType).alias("_from"), "_since", *[F.lit(0).alias(f"_0{n}") for n in sums])
    done = None
    for i, traffic in enumerate(stages):
        parts = begin.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        seen = rows.join(parts, [*keys, "_part"]).where(F.col("_from").isNull() | (F.col("_at") > F.col("_from")))
        n, wrong, spent, base, base_spent = (F.col(s) - F.col(f"_0{s}") for s in sums)
        error = F.when(n > 0, wrong / n).otherwise(0.0)
        slow = F.when((n > 0) & (base > 0) & (base_spent > 0), (spent / n) / (base_spent / base)).otherwise(0.0)
        harmful = (error > error_limit) | (slow > latency_limit)
        ready = (n >= min_promote) & (F.col(ts) - F.col("_since") >= min_age)
        action = F.when((n >= min_rollback) & harmful, "rollback").when(ready & ~harmful, "promote")
        told = seen.select(
            *keys, *own, "_at", *sums, action.alias("action"), F.lit(traffic).alias("traffic"),
            n.alias("requests"), error.alias("error_rate"), slow.alias("latency_ratio"),
        ).where("action IS NOT NULL")
        values = F.struct(*[c for c in told.columns if c not in keys])
        events = materialise(told.groupBy(*keys).agg(F.min_by(values, "_at").alias("e")).select(*keys, "e.*"), "decisions")
        done = events if done is None else done.unionByName(events)
        promoted = events.where("action = 'promote'")
        begin = promoted.select(*keys, F.col("_at").alias("_from"), F.col(ts).alias("_since"), *[F.col(s).alias(f"_0{s}") for s in sums])
        if i + 1 < len(stages) and promoted.isEmpty():
            break
    return done.select(*keep, "action", "traffic", "requests", "error_rate", "latency_ratio")
