"""Joins: pairing, comparison of listings, interval promotion, range lookup, conflicts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.ordered import Ordered


def pair_predictions(predictions: DataFrame, truth: DataFrame, key: str, min_samples: int = 100) -> DataFrame:
    """Accuracy over matched rows; null until enough of them match."""
    pairs = predictions.join(truth, key)
    out = pairs.agg(F.count(F.lit(1)).alias("samples"), F.avg((F.col("predicted") == F.col("truth")).cast("int")).alias("a"))
    enough = F.col("samples") >= min_samples
    return out.select("samples", enough.alias("enough"), F.when(enough, F.col("a")).alias("accuracy"))


def orphans_and_ghosts(
    manifest: DataFrame, on_disk: DataFrame, key: str, gone: Sequence[str] = ("DELETED", "EVICTED")
) -> DataFrame:
    """Files on disk only (insert) and manifest entries without a file (evict), in one join."""
    listed = manifest.select(key, "state").withColumn("_listed", F.lit(True))
    found = on_disk.select(key).distinct().withColumn("_found", F.lit(True))
    both = listed.join(found, key, "full_outer")
    orphan = F.col("_listed").isNull()
    ghost = F.col("_found").isNull() & ~F.col("state").isin(*gone)
    return both.where(orphan | ghost).select(
        key, F.when(orphan, "orphan").otherwise("ghost").alias("kind"),
        F.when(orphan, "PENDING").otherwise("EVICTED").alias("new_state"),
    )


def compare_listings(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per differing key: missing_in_target, extra_in_target or size_mismatch."""
    t = target.select("key", F.col("size").alias("t_size"))
    kind = (
        F.when(F.col("t_size").isNull(), "missing_in_target")
        .when(F.col("size").isNull(), "extra_in_target")
        .when(F.col("size") != F.col("t_size"), "size_mismatch")
    )
    return source.select("key", "size").join(t, "key", "full_outer").select("key", kind.alias("kind")).where("kind is not null")


def sync_report(source: DataFrame, target: DataFrame) -> DataFrame:
    kinds = ["missing_in_target", "extra_in_target", "size_mismatch"]
    counts = compare_listings(source, target).agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    return counts.withColumn("in_sync", reduce(lambda a, b: a & b, [F.col(k) == 0 for k in kinds]))


def promote_in_windows(
    files: DataFrame, events: DataFrame, key: str, hot_rows: int | None = None, levels: int = 4, state: str | None = None
) -> DataFrame:
    """Files created inside the capture window of an event of the same session.

    ``files``: key, file_id, at, priority; ``events``: key, event_id, at, pre, post, priority
    (``at``, ``pre`` and ``post`` in microseconds). Each event opens its window
    and closes it again on the time line of its session; a file looks at how
    many windows of each priority are open. No (file, event) pairs are built,
    so a session with many of both stays linear. With ``state``, the column of
    a file's state, only files that still wait for their upload are promoted.
    Event priorities run from 0 to ``levels`` - 1; any other is an error, and an
    event without one opens no window.
    """
    level = F.col("priority")
    unknown = F.raise_error(F.concat(F.lit("unknown event priority "), level.cast("string"))).cast("int")
    checked = F.when(level.isNull() | level.between(0, levels - 1), level.cast("int")).otherwise(unknown)
    events = events.withColumn("priority", checked)
    if state:
        files = files.where(F.col(state) == "PENDING")
    opened = [F.when(F.col("priority") == p, 1).otherwise(0).alias(f"d{p}") for p in range(levels)]
    closed = [F.when(F.col("priority") == p, -1).otherwise(0).alias(f"d{p}") for p in range(levels)]
    none = [F.lit(0).alias(f"d{p}") for p in range(levels)]
    empty = F.lit(None).cast("int").alias("priority")
    line = (
        files.select(key, "at", F.lit(1).alias("kind"), F.col("file_id").alias("id"), "priority", *none)
        .unionByName(
            events.select(
                key, (F.col("at") - F.col("pre")).alias("at"), F.lit(0).alias("kind"), F.col("event_id").alias("id"), empty, *opened
            )
        )
        .unionByName(
            events.select(
                key, (F.col("at") + F.col("post")).alias("at"), F.lit(2).alias("kind"), F.col("event_id").alias("id"), empty, *closed
            )
        )
    )
    open_now = Ordered(line, [key], ["at", "kind", "id"], hot_rows).running(
        **{f"open{p}": ("sum", F.col(f"d{p}")) for p in range(levels)}
    )
    best = F.coalesce(*[F.when(F.col(f"open{p}") > 0, F.lit(p)) for p in range(levels)])
    return open_now.where("kind = 1").select(
        key, F.col("id").alias("file_id"), "priority", best.alias("new_priority"), F.lit(100.0).alias("score")
    ).where("new_priority < priority")


def category_frequencies(left: DataFrame, right: DataFrame, column: str, fill: float = 0.0) -> DataFrame:
    """Shares of both sides over the union of their categories."""
    counts = (
        left.select(F.col(column).alias("category"), F.lit(1).alias("l"), F.lit(0).alias("r"))
        .unionByName(right.select(F.col(column).alias("category"), F.lit(0).alias("l"), F.lit(1).alias("r")))
        .where("category is not null")
        .groupBy("category")
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    )
    totals = counts.agg(F.struct(F.sum("l").alias("l"), F.sum("r").alias("r"))).scalar()
    share = lambda n, total: F.when(n > 0, n / total).otherwise(F.lit(float(fill)))
    return counts.select(
        "category", share(F.col("l"), totals["l"]).alias("reference"), share(F.col("r"), totals["r"]).alias("current")
    )


def replication_lag(copies: DataFrame, item: str) -> DataFrame:
    """Lag of every ordered pair of regions holding an item.

    The regions of one item form a short list, so the pairs come from one row
    per item rather than from a self join.
    """
    held = copies.groupBy(item, "region").agg(F.max("modified").alias("modified"))
    per = held.groupBy(item).agg(F.collect_list(F.struct("region", "modified")).alias("held"))
    pairs = per.select(item, "held", F.explode("held").alias("s")).select(item, "s", F.explode("held").alias("t"))
    return pairs.where("s.region <> t.region").select(
        item, F.col("s.region").alias("source"), F.col("t.region").alias("target"),
        F.abs(F.col("s.modified") - F.col("t.modified")).alias("lag"),
    )


def compare_runs(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """``metrics``: run, metric, value; change of each metric both runs have."""
    value = lambda run: F.max(F.when(F.col("run") == run, F.col("value")))
    both = metrics.where(F.col("run").isin(first, second)).groupBy("metric").agg(value(first).alias("a"), value(second).alias("b"))
    change = F.when(F.col("a") == 0, 0.0).otherwise(F.try_divide(F.col("b") - F.col("a"), F.col("a")) * 100)
    return both.where("a is not null and b is not null").select(
        "metric", "a", "b", (F.col("b") - F.col("a")).alias("difference"), change.alias("percent_change")
    )


def missing_copies(items: DataFrame, regions: DataFrame, present: DataFrame, item: str, region: str) -> DataFrame:
    """(item, region) pairs without a copy, with the first region that holds the item.

    ``regions`` is a short dimension and travels as one array.
    """
    every = regions.agg(F.array_sort(F.collect_set(region))).scalar()
    # at most one entry per region
    held = present.select(item, region).distinct().groupBy(item).agg(F.array_sort(F.collect_set(region)).alias("held"))
    joined = items.select(item).distinct().join(held, item, "left").withColumn("every", every)
    absent = F.coalesce(F.array_except("every", "held"), F.col("every"))
    return joined.select(item, F.explode(absent).alias(region), F.array_min("held").alias("source"))


def config_checksum(settings: Column) -> Column:
    return F.sha2(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(settings)))), 256)


def compare_config(configs: DataFrame, reference: str) -> DataFrame:
    """Each region's config against the reference region: in_sync, conflict or missing."""
    base = configs.where(F.col("region") == reference).select(
        "name", F.col("version").alias("ref_version"), F.col("checksum").alias("ref_checksum")
    )
    same = (F.col("version") == F.col("ref_version")) & (F.col("checksum") == F.col("ref_checksum"))
    state = F.when(F.col("checksum").isNull() | F.col("ref_checksum").isNull(), "missing").when(same, "in_sync").otherwise("conflict")
    return configs.where(F.col("region") != reference).join(base, "name", "left").select("region", "name", state.alias("state"))


def range_lookup(points: DataFrame, ranges: DataFrame, at: str, width_bits: int = 16) -> DataFrame:
    """Attach the range (start, end, geo) a value falls in.

    Ranges are cut into blocks of equal width and joined on the block number;
    the size of the range table decides by itself whether it is broadcast.
    """
    block = lambda c: F.shiftright(c, width_bits)
    cut = ranges.select("start", "end", "geo", F.explode(F.sequence(block(F.col("start")), block(F.col("end")))).alias("_block"))
    on = (block(F.col(at)) == F.col("_block")) & F.col(at).between(F.col("start"), F.col("end"))
    return points.join(cut, on, "left").drop("_block", "start", "end")


def newest_version(copies: DataFrame, key: str, updated: str, primary: str, tie: str, keep: Sequence[str]) -> DataFrame:
    """Newest copy wins; the primary region wins a tie."""
    order = F.struct(F.col(updated), F.col(primary).cast("int"), F.col(tie))
    return copies.groupBy(key).agg(F.max_by(F.struct(*keep), order).alias("w")).select(key, "w.*")


def resolve_conflicts(source: DataFrame, target: DataFrame, decisions: DataFrame) -> DataFrame:
    """Apply source_wins, target_wins or manual to keys whose etags differ."""
    t = target.select("key", F.col("etag").alias("t_etag"))
    conflicts = source.select("key", "etag").join(t, "key").where("etag <> t_etag").join(decisions, "key", "left")
    s = F.col("strategy")
    chosen = (
        F.when(s == "source_wins", F.col("etag"))
        .when(s == "target_wins", F.col("t_etag"))
        .when(s.isNull() | (s == "manual"), F.lit(None).cast("string"))
        .otherwise(F.raise_error(F.concat(F.lit("unknown strategy "), s)).cast("string"))
    )
    status = F.when(s.isNull(), "unresolved").when(s == "manual", "manual").otherwise("resolved")
    return conflicts.select("key", status.alias("status"), chosen.alias("etag"))
