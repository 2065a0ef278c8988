"""Analytic operators over ordered rows.

All of them go through ``Ordered``, aggregates or rank limits, so that a key
with very many rows does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import traffic_bucket
from millrace.plans.ordered import Ordered
from millrace.plans.sequential import Ranges, fold_sorted


def rolling_zscore(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, size: int = 300, warm_up: int = 30,
    limit: float = 3.0, hot_rows: int | None = None,
) -> DataFrame:
    """z of each value against its last ``size`` values, itself included.

    A window function folds every frame anew, value by value; here the sorted
    rows stream through vectorised frames instead. Hot keys come in slices,
    each led by the rows its first frames reach back to.
    """
    ordered = Ordered(df, keys, order, hot_rows)
    rows = ordered.with_halo(size - 1) if ordered.sliced else ordered.df
    parts = [*(["_slice"] if ordered.sliced else []), *keys]

    def step(memory: dict, batch: pd.DataFrame, ranges: Ranges) -> pd.DataFrame:
        z = np.empty(len(batch))
        values = batch[value].to_numpy("float64")
        before = np.empty(0) if ranges[0][2] else memory["tail"]
        line = np.concatenate([before, values])
        # rows of the same key up to and including each row, at most one frame
        depth = np.concatenate([np.arange(b - a) for a, b, _ in ranges]) + 1
        depth[: ranges[0][1]] += len(before)
        depth = np.minimum(depth, size)
        padded = np.concatenate([np.full(size - 1, np.nan), line])
        frames = sliding_window_view(padded, size)[len(before):]
        for at in range(0, len(batch), FRAMES):
            z[at : at + FRAMES] = frame_scores(frames[at : at + FRAMES], depth[at : at + FRAMES], warm_up)
        memory["tail"] = line[len(line) - min(int(depth[-1]), size - 1):] if size > 1 else np.empty(0)
        return batch.assign(z=z, is_anomaly=z > limit)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", z double, is_anomaly boolean"
    out = fold_sorted(rows, parts, order, step, schema)
    return out.where(~F.col("_halo")).drop("_halo", "_slice") if ordered.sliced else out


FRAMES = 4096


def frame_scores(frames: np.ndarray, depth: np.ndarray, warm_up: int) -> np.ndarray:
    """z of the last value of each frame among its last ``depth`` values, nulls left out."""
    size = frames.shape[1]
    used = (np.arange(size) >= size - depth[:, None]) & ~np.isnan(frames)
    n = used.sum(axis=1)
    values = np.where(used, frames, 0.0)
    mean = values.sum(axis=1) / np.maximum(n, 1)
    away = np.where(used, frames - mean[:, None], 0.0)
    std = np.sqrt((away * away).sum(axis=1) / np.maximum(n - 1, 1))
    z = np.abs(frames[:, -1] - mean) / (std + 1e-9)
    return np.where((n >= warm_up) & ~np.isnan(frames[:, -1]), z, 0.0)


def channel_events(df: DataFrame, entity: str, order: Sequence[str], channels: Sequence[str], **kw) -> DataFrame:
    """Anomalous values of several channels with score, priority and capture window."""
    long = df.unpivot([entity, *order], list(channels), "channel", "value")
    z = rolling_zscore(long, [entity, "channel"], order, "value", **kw).where("is_anomaly")
    score = F.least(F.lit(100.0), 50 + 10 * F.col("z"))
    return z.select(
        entity, *order, "channel", "value", "z", score.alias("score"),
        F.when(score < 80, 1).otherwise(0).alias("priority"), F.lit(15.0).alias("pre_sec"), F.lit(5.0).alias("post_sec"),
    )


def group_outliers(df: DataFrame, key: str, value: str, min_rows: int = 3) -> DataFrame:
    """Rows more than two population deviations from their group's mean."""
    stats = df.groupBy(key).agg(
        F.avg(value).alias("average"), F.stddev_pop(value).alias("std_dev"), F.count(value).alias("_n")
    ).where(F.col("_n") >= min_rows).drop("_n")
    away = F.abs(F.col(value) - F.col("average"))
    return df.join(stats, key).where(away > 2 * F.col("std_dev")).withColumn(
        "severity", F.when(away > 3 * F.col("std_dev"), "high").otherwise("medium")
    )


def trend(daily: DataFrame, day: str, amount: str) -> DataFrame:
    """Change over the last seven days and of the last week against the one before.

    ``daily`` has one row per calendar day, which bounds it.
    """
    newest = daily.select(amount, F.row_number().over(Window.orderBy(F.col(day).desc())).alias("rn")).where("rn <= 14")
    pick = lambda lo, hi: F.sum(F.when(F.col("rn").between(lo, hi), F.col(amount)))
    one = newest.agg(
        F.count(F.lit(1)).alias("n"), pick(1, 1).alias("last"),
        F.max_by(amount, F.when(F.col("rn") <= 7, F.col("rn"))).alias("first"),
        pick(1, 7).alias("week"), pick(8, 14).alias("previous"),
    )
    pct = lambda a, b: F.when(b > 0, (a - b) / b * 100).otherwise(0.0)
    return one.select(
        F.when(F.col("n") >= 2, pct(F.col("last"), F.col("first"))).otherwise(0.0).alias("daily_change"),
        F.when(F.col("n") >= 14, pct(F.col("week"), F.col("previous"))).otherwise(0.0).alias("weekly_change"),
    )


def sequence_gaps(df: DataFrame, key: str, seq: str, hot_rows: int | None = None) -> DataFrame:
    lagged = Ordered(df, [key], [seq], hot_rows).lag(_prev=F.col(seq))
    return lagged.where(F.col(seq) != F.col("_prev") + 1).select(
        key, (F.col("_prev") + 1).alias("expected_seq"), F.col(seq).alias("found_seq")
    )


def version_changes(df: DataFrame, key: str, order: Sequence[str], version: str, hot_rows: int | None = None) -> DataFrame:
    lagged = Ordered(df, [key], order, hot_rows).lag(old_version=F.col(version))
    return lagged.where(F.col("old_version") != F.col(version)).select(
        key, *order, "old_version", F.col(version).alias("new_version")
    )


def newest(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows per key; the rank limit is applied before the shuffle as well."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, key: str, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(F.struct(*keep), F.struct(*order)).alias("_r")).select(key, "_r.*")


def retention(df: DataFrame, key: str, order: Sequence[str], best: str, n: int) -> DataFrame:
    """Keep the newest ``n`` and the best row per key, mark the rest for deletion.

    The n-th newest row is found with a rank limit; every row is then compared
    with that one boundary instead of being ranked.
    """
    place = F.struct(*order)
    cut = newest(df, key, order, n).groupBy(key).agg(F.min(place).alias("_cut"))
    top = df.groupBy(key).agg(F.max_by(place, F.struct(F.col(best), place)).alias("_best"))
    keep = (place >= F.col("_cut")) | (place == F.col("_best"))
    return df.join(cut.join(top, key), key).select(*df.columns, keep.alias("keep"))


def eviction(files: DataFrame, quota: Column, low_water: float = 0.60, trigger: float = 0.75, hot_rows: int | None = None) -> DataFrame:
    """Files to delete, in order, until usage falls below the low-water mark.

    ``files``: file_id, size, priority, created_at, expired. Expired files go
    first, then low priorities, oldest first; priority 0 is never deleted.
    """
    used = files.agg(F.sum("size")).scalar()
    candidates = files.where(F.col("expired") | (F.col("priority") >= 1)).select(
        "file_id", "size", "created_at",
        F.when(F.col("expired"), 0).otherwise(1).alias("step"),
        F.when(F.col("expired"), 0).otherwise(-F.col("priority")).alias("rank"),
    )
    ordered = Ordered(candidates, [], ["step", "rank", "created_at", "file_id"], hot_rows)
    freed = ordered.running(freed=("sum", F.col("size")))
    before = used - (F.col("freed") - F.col("size"))
    return freed.where((used >= trigger * quota) & (before >= low_water * quota)).select(
        "file_id", "freed", F.when(F.col("step") == 0, "expired").otherwise("evicted").alias("reason")
    )


def failure_streaks(df: DataFrame, key: str, order: Sequence[str], ok: str, threshold: int = 3, hot_rows: int | None = None) -> DataFrame:
    """Failures in a row up to each check; unhealthy from the third on."""
    rows = Ordered(df, [key], order, hot_rows)
    counted = rows.running(_pos=("count", F.lit(1)))
    marked = Ordered(counted, [key], order, hot_rows, rows.sizes).running(_ok=("max", F.when(F.col(ok), F.col("_pos"))))
    streak = F.col("_pos") - F.coalesce(F.col("_ok"), F.lit(0))
    return marked.withColumn("streak", streak).withColumn("unhealthy", streak >= threshold).drop("_pos", "_ok")


def neighbour_context(docs: DataFrame, key: str, sentences: Column, k: int = 1) -> DataFrame:
    """Each sentence with ``k`` neighbours on both sides; a document is one row."""
    s = docs.select(key, sentences.alias("_s"))
    around = F.transform(
        F.col("_s"),
        lambda x, i: F.array_join(
            F.slice(F.col("_s"), F.greatest(i - k + 1, F.lit(1)), F.least(i, F.lit(k)) + k + 1), " "
        ),
    )
    return s.select(key, F.posexplode(around).alias("position", "context"))


def assign_variant(df: DataFrame, user: Column, variants: Sequence[tuple[str, float]]) -> DataFrame:
    """First variant whose cumulative share reaches the user's bucket, the last as fallback."""
    if len(variants) < 2:
        raise ValueError("an experiment needs two variants or more")
    if not 99.9 <= sum(share for _, share in variants) <= 100.1:
        raise ValueError("the shares have to add up to 100")
    bucket = traffic_bucket(user)
    choice, upper = F.lit(variants[-1][0]), sum(share for _, share in variants)
    for name, share in reversed(variants):
        choice = F.when(F.col("bucket") <= upper, name).otherwise(choice)
        upper -= share
    return df.withColumn("bucket", bucket).withColumn("variant", choice)


def ranking(df: DataFrame, score: str, name: str, hot_rows: int | None = None) -> DataFrame:
    down = df.withColumn("_down", -F.col(score))
    return Ordered(down, [], ["_down", name], hot_rows).running(rank=("count", F.lit(1))).drop("_down")


def throughput(
    df: DataFrame, key: str, order: Sequence[str], ts_us: str, samples: str, total: float, size: int = 50,
    hot_rows: int | None = None,
) -> DataFrame:
    """Recent and overall samples per second and the seconds left, per step."""
    rows = Ordered(df, [key], order, hot_rows)
    with_prev = rows.lag(_prev=F.col(ts_us))
    seconds = (F.col(ts_us) - F.col("_prev")) / 1e6
    rated = with_prev.withColumn("_rate", F.try_divide(F.col(samples).cast("double"), seconds))
    recent = Ordered(rated, [key], order, hot_rows, rows.sizes).rolling(size, recent=lambda w: F.avg("_rate").over(w))
    done = Ordered(recent, [key], order, hot_rows, rows.sizes).running(_done=("sum", F.col(samples)), _start=("min", F.col(ts_us)))
    overall = F.try_divide(F.col("_done").cast("double"), (F.col(ts_us) - F.col("_start")) / 1e6)
    left = F.greatest(F.lit(total) - F.col("_done"), F.lit(0.0))
    eta = F.when(F.coalesce(overall, F.lit(0.0)) > 0, left / overall).otherwise(F.lit(float("inf")))
    return done.select(key, *order, "recent", overall.alias("overall"), eta.alias("eta"))


def peaks(df: DataFrame, key: str, order: Sequence[str], value: str, reset: Column, hot_rows: int | None = None) -> DataFrame:
    """Running maximum that starts over at every reset row."""
    rows = Ordered(df, [key], order, hot_rows)
    grouped = rows.running(period=("sum", reset.cast("int")))
    # a period is never larger than its key
    sizes = None if rows.sliced else rows.sizes
    return Ordered(grouped, [key, "period"], order, hot_rows, sizes).running(peak=("max", F.col(value)))
