"""Aggregations: reports, validation, evaluation metrics and cost roll-ups.

Everything here is partial aggregation first, so a group that holds a large
share of the rows shrinks before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.layout import join_null_safe
from millrace.plans.ordered import Ordered
from millrace.plans.quantiles import exact_quantiles
from millrace.plans.sequential import fold_sorted
from millrace.session import materialise

PERCENTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999}


def safe_ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(empty))


# -- sums ----------------------------------------------------------------------


def cost_breakdown(costs: DataFrame, dimensions: Sequence[str], amount: str = "amount") -> DataFrame:
    """Total and per-dimension sums in one pass: (dimension, member, amount).

    The rows are first reduced to the distinct combinations, so the grouping
    sets expand a small table.
    """
    combos = costs.groupBy(*dimensions).agg(F.sum(amount).alias(amount))
    grouped = combos.groupingSets([[d] for d in dimensions] + [[]], *dimensions).agg(
        F.sum(amount).alias(amount), *[F.grouping(d).alias(f"_g{d}") for d in dimensions]
    )
    name = F.coalesce(*[F.when(F.col(f"_g{d}") == 0, F.lit(d)) for d in dimensions], F.lit("total"))
    member = F.coalesce(*[F.when(F.col(f"_g{d}") == 0, F.col(d)) for d in dimensions], F.lit("all"))
    return grouped.select(name.alias("dimension"), member.alias("member"), amount)


def sums_by(df: DataFrame, keys: Sequence[str | Column], **sums: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def storage_by_priority(files: DataFrame, price_per_gb: float = 0.023) -> DataFrame:
    gb = F.sum("size_bytes") / F.lit(1e9)
    return files.groupBy("priority").agg(
        F.count(F.lit(1)).alias("files"),
        gb.alias("size_gb"),
        F.round(gb * price_per_gb, 2).alias("monthly_cost"),
    )


def version_inventory(files: DataFrame, indexed_at: str) -> DataFrame:
    return files.groupBy("firmware_ver", "schema_version").agg(
        F.count(F.lit(1)).alias("files"),
        F.min(indexed_at).alias("first_seen"),
        F.max(indexed_at).alias("last_seen"),
    )


def flag_summary(files: DataFrame) -> DataFrame:
    return (
        files.select("robot_id", F.explode("anomaly_flags").alias("flag"), "size_bytes", "time_start")
        .groupBy("robot_id", "flag")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("size_bytes").alias("bytes"),
            F.max("time_start").alias("latest"),
        )
    )


def embedding_coverage(rows: DataFrame, embedding: str) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(embedding).alias("embedded"),
        (F.avg(F.col(embedding).isNotNull().cast("int")) * 100).alias("coverage_pct"),
    )


def state_priority_counts(files: DataFrame, states: Sequence[str]) -> DataFrame:
    """Files per priority and state; a state that is not listed is an error, rows without one are not counted."""
    state = F.col("state")
    unknown = F.raise_error(F.concat(F.lit("unknown state "), state)).cast("string")
    files = files.withColumn("state", F.when(state.isNull() | state.isin(*states), state).otherwise(unknown))
    return files.groupBy("priority").pivot("state", list(states)).count().na.fill(0, list(states))


def daily_bytes(files: DataFrame, day: Column) -> DataFrame:
    """Bytes per robot and day, in all and by priority; priorities of 3 and more count as 3."""
    per_priority = [
        F.sum(F.when(F.least("priority", F.lit(3)) == p, F.col("size_bytes")).otherwise(0)).alias(f"p{p}_bytes")
        for p in range(4)
    ]
    return files.groupBy("robot_id", day.alias("day")).agg(
        F.sum("size_bytes").alias("bytes_uploaded"), F.count(F.lit(1)).alias("file_count"), *per_priority
    )


def entity_registry(files: DataFrame, as_of: str, stale_hours: int) -> DataFrame:
    seen = files.groupBy("robot_id").agg(
        F.max("time_end").alias("last_seen"),
        F.max("time_start").alias("last_upload"),
        F.count(F.lit(1)).alias("total_files"),
        F.sum("size_bytes").alias("total_bytes"),
    )
    limit = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {stale_hours} HOURS")
    return seen.withColumn("status", F.when(F.col("last_seen") < limit, "stale").otherwise("active"))


# -- distributions ---------------------------------------------------------------


def distribution_summary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    stats = df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return join_null_safe(stats, exact_quantiles(df, keys, value, PERCENTILES), keys, "left")


def weighted_meter(df: DataFrame, keys: Sequence[str], value: str, weight: str, step: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(F.col(value) * F.col(weight)).alias("total"),
        F.sum(weight).alias("n"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.max_by(F.col(value), F.struct(*step)).alias("last"),
    ).withColumn("avg", F.try_divide(F.col("total"), F.col("n")))


def timing_summary(df: DataFrame, name: str, seconds: str) -> DataFrame:
    return df.groupBy(name).agg(
        F.avg(seconds).alias("mean"),
        F.coalesce(F.stddev_samp(seconds), F.lit(0.0)).alias("std"),
        F.min(seconds).alias("min"),
        F.max(seconds).alias("max"),
        F.sum(seconds).alias("total"),
        F.count(seconds).alias("n"),
    )


def throughput_summary(requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    elapsed = (F.unix_micros(F.max(F.col("ts").cast("timestamp"))) - F.unix_micros(F.min(F.col("ts").cast("timestamp")))) / 1e6
    ok = F.count_if("success")
    base = requests.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"),
        ok.alias("succeeded"),
        safe_ratio(ok, elapsed).alias("qps"),
        safe_ratio(ok, F.count(F.lit(1))).alias("success_rate"),
        F.avg(F.when(F.col("success"), F.col("latency"))).alias("mean_latency"),
    )
    tails = exact_quantiles(
        requests.where("success"), keys, "latency", {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    )
    return join_null_safe(base, tails, keys, "left")


def request_stats(requests: DataFrame, keys: Sequence[str], empty_rate: float = 0.0) -> DataFrame:
    """Counts, success share and averages per variant or endpoint."""
    return requests.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("request_count"),
        F.count_if("success").alias("success_count"),
        F.count_if(~F.col("success")).alias("error_count"),
        safe_ratio(F.count_if("success"), F.count(F.lit(1)), empty_rate).alias("success_rate"),
        F.coalesce(F.avg(F.when(F.col("success"), F.col("latency"))), F.lit(0.0)).alias("average_latency"),
        F.coalesce(F.avg("feedback"), F.lit(0.0)).alias("average_feedback"),
    )


# -- evaluation --------------------------------------------------------------------


def confusion_matrix(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, n) with a row for every pair of classes, zeros included."""
    cells = df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # one row holding the class list; its size is the square root of the output
    classes = cells.select(F.explode(F.array("truth", "predicted")).alias("c")).agg(
        F.array_sort(F.collect_set("c")).alias("classes")
    )
    grid = classes.select("classes", F.explode("classes").alias("truth")).select(
        "truth", F.explode("classes").alias("predicted")
    )
    return grid.join(cells, ["truth", "predicted"], "left").na.fill(0, ["n"])


def classification_report(cells: DataFrame) -> DataFrame:
    """Per class, macro, weighted and overall metrics from a confusion matrix."""
    same = F.col("truth") == F.col("predicted")
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called"),
                    F.when(same, F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called"),
                    F.lit(0).cast("bigint").alias("hit"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    per = (
        sides.groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit"))
        .withColumn("precision", safe_ratio(F.col("hit"), F.col("called")))
        .withColumn("recall", safe_ratio(F.col("hit"), F.col("support")))
        .withColumn(
            "f1", safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
        )
    )
    names = ["precision", "recall", "f1"]
    weighted = [safe_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in names]
    hit_rate = safe_ratio(F.sum("hit"), F.sum("support"))
    total = F.sum("support").alias("support")
    rows = [
        per.select(F.col("label").cast("string").alias("label"), *names, "support"),
        per.agg(*[F.avg(m).alias(m) for m in names], total).select(F.lit("macro").alias("label"), *names, "support"),
        per.agg(*weighted, total).select(F.lit("weighted").alias("label"), *names, "support"),
        per.agg(*[hit_rate.alias(m) for m in names], total).select(
            F.lit("accuracy").alias("label"), *names, "support"
        ),
    ]
    out = rows[0]
    for other in rows[1:]:
        out = out.unionByName(other)
    return out


def score_counts(df: DataFrame, score: str, truth: str) -> DataFrame:
    positive = F.col(truth) == 1
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def roc_auc(df: DataFrame, score: str, truth: str, hot_rows: int | None = None) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counted half."""
    counts = materialise(score_counts(df, score, truth), "scores")
    ranked = Ordered(counts, [], ["score"], hot_rows).running(below=("sum", F.col("neg")))
    # doubles: products of counts leave the range of bigint
    pairs = F.sum(F.col("pos").cast("double") * (2 * F.col("below") - F.col("neg")))
    return ranked.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.try_divide(pairs, F.sum("pos").cast("double") * F.sum("neg") * 2).alias("auc"),
    )


def roc_curve(df: DataFrame, score: str, truth: str, hot_rows: int | None = None) -> DataFrame:
    counts = materialise(score_counts(df, score, truth).withColumn("_down", -F.col("score")), "scores")
    total = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    points = Ordered(counts, [], ["_down"], hot_rows).running(
        tp=("sum", F.col("pos")), fp=("sum", F.col("neg"))
    )
    return points.select(
        F.col("score").alias("threshold"),
        safe_ratio(F.col("fp"), total["n"]).alias("fpr"),
        safe_ratio(F.col("tp"), total["p"]).alias("tpr"),
    )


# -- validation ----------------------------------------------------------------------


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.where(F.col(column).isNotNull()).agg(F.count(F.lit(1))).scalar()
    return counts.where("value is not null").select("value", "n", safe_ratio(F.col("n"), total).alias("share"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with nulls, and the level of the overall null share."""
    once = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = F.col("rows") * len(columns)
    share = safe_ratio(sum((F.col(c) for c in columns), F.lit(0)), cells)
    level = F.when(share > 0.10, "error").when(share > 0.05, "warning").otherwise("ok")
    long = once.select(
        share.alias("null_share"), level.alias("level"),
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])
        ).alias("x"),
    )
    return long.select("x.column", "x.nulls", "null_share", "level").where("nulls > 0")


def row_digest(columns: Sequence[str]) -> Column:
    """Digest of whole rows in which nulls are equal; 64 bytes instead of the row are shuffled."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    groups = df.groupBy(row_digest(columns).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    out = groups.agg(F.sum("n").alias("rows"), (F.sum("n") - F.count(F.lit(1))).alias("duplicates"))
    share = safe_ratio(F.col("duplicates"), F.col("rows"))
    level = F.when(share > 0.05, "error").when(share > 0, "warning").otherwise("ok")
    return out.select("rows", "duplicates", share.alias("share"), level.alias("level"))


def range_checks(df: DataFrame, rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """``rules``: name -> (aggregate that is true when the rule is broken, level)."""
    once = df.agg(*[F.coalesce(broken, F.lit(False)).alias(n) for n, (broken, _) in rules.items()])
    entries = [
        F.struct(F.lit(n).alias("rule"), F.lit(level).alias("level"), F.col(n).alias("broken"))
        for n, (_, level) in rules.items()
    ]
    return once.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def class_balance(df: DataFrame, column: str) -> DataFrame:
    per = value_distribution(df, column)
    out = per.agg(F.count(F.lit(1)).alias("classes"), F.min("share").alias("smallest_share"))
    level = (
        F.when(F.col("classes") < 2, "error")
        .when(F.col("smallest_share") < 0.05, "severe")
        .when(F.col("smallest_share") < 0.2, "warning")
        .otherwise("ok")
    )
    return out.withColumn("level", level)


def schema_report(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """One row per expected column: declared kind, found kind, numeric share, level."""
    from pyspark.sql.types import NumericType

    kinds = {f.name: "numeric" if isinstance(f.dataType, NumericType) else "categorical" for f in df.schema}
    present = [c for c in expected if c in kinds]
    as_number = lambda c: F.expr(f"try_cast(`{c}` AS double)")
    once = df.agg(*[safe_ratio(F.count(as_number(c)), F.count(c)).alias(c) for c in present])
    entries = []
    for c, want in expected.items():
        found = kinds.get(c, "missing")
        level = "error" if found == "missing" else "ok" if found == want else "warning"
        share = F.col(c) if c in kinds else F.lit(None).cast("double")
        entries.append(
            F.struct(
                F.lit(c).alias("column"), F.lit(want).alias("expected"), F.lit(found).alias("found"),
                share.alias("numeric_share"), F.lit(level).alias("level"),
            )
        )
    return once.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def quality_score(df: DataFrame, columns: Sequence[str], schema_ok: bool) -> DataFrame:
    """0.4 completeness + 0.3 uniqueness + 0.3 schema, rounded to three places."""
    width = len(columns)
    nulls = sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))
    once = (
        df.select(row_digest(columns).alias("digest"), nulls.alias("nulls"))
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("nulls").alias("nulls"))
        .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_rows"), F.sum("nulls").alias("nulls"))
    )
    complete = 1 - safe_ratio(F.col("nulls"), F.col("rows") * width)
    unique = safe_ratio(F.col("distinct_rows"), F.col("rows"))
    score = F.round(0.4 * complete + 0.3 * unique + F.lit(0.3 * (1.0 if schema_ok else 0.5)), 3)
    errors = (1 - complete > 0.10).cast("int") + (1 - unique > 0.05).cast("int") + F.lit(0 if schema_ok else 1)
    return once.select(
        "rows", complete.alias("completeness"), unique.alias("uniqueness"), score.alias("score"),
        ((errors == 0) & (score >= 0.7)).alias("valid"),
    )


def distinct_classes(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    out = df.agg(F.count(F.lit(1)).alias("rows"), count.alias("classes"))
    return out.withColumn("passes", (F.col("classes") >= 2) & (F.col("rows") >= 100))


# -- cost of serving -----------------------------------------------------------------


def request_cost(usage: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    parts = ["gpu_cost", "vector_cost", "network_cost", "token_cost"]
    total = F.sum(sum((F.col(p) for p in parts[1:]), F.col(parts[0])))
    return usage.groupBy(*keys).agg(
        *[F.sum(p).alias(p) for p in parts],
        total.alias("total_cost"),
        F.count(F.lit(1)).alias("num_requests"),
        F.sum("tokens").alias("total_tokens"),
        safe_ratio(total, F.count(F.lit(1))).alias("cost_per_request"),
        (safe_ratio(total, F.sum("tokens")) * 1000).alias("cost_per_1k_tokens"),
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
    )


def monthly_estimate(usage: DataFrame, as_of: str, storage_gb: float = 100.0, storage_rate: float = 0.10) -> DataFrame:
    """Mean of the last seven daily totals, times 30, plus storage."""
    cost = F.col("gpu_cost") + F.col("vector_cost") + F.col("network_cost") + F.col("token_cost")
    day = F.to_date("ts")
    recent = usage.where((day > F.date_sub(F.lit(as_of).cast("date"), 7)) & (day <= F.lit(as_of).cast("date")))
    days = recent.groupBy(day.alias("day")).agg(F.sum(cost).alias("cost"))
    return days.agg(
        F.count(F.lit(1)).alias("days"),
        (F.coalesce(F.avg("cost"), F.lit(0.0)) * 30 + storage_gb * storage_rate).alias("monthly_cost"),
    )


def cost_shares(parts: DataFrame, name: str, amount: str) -> DataFrame:
    sums = parts.groupBy(name).agg(F.sum(amount).alias(amount))
    total = parts.agg(F.sum(amount)).scalar()
    return sums.select(name, amount, (safe_ratio(F.col(amount), total) * 100).alias("percentage"))


def token_price_estimate(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """``usage``: model, prompt_tokens, completion_tokens, gpu_hours; prices per 1000 tokens."""
    per = usage.groupBy("model").agg(
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("gpu_hours").alias("gpu_hours"),
        F.count(F.lit(1)).alias("requests"),
    )
    prompt = F.col("prompt_tokens") / 1000 * F.col("prompt_price")
    completion = F.col("completion_tokens") / 1000 * F.col("completion_price")
    gpu = F.col("gpu_hours") * F.col("hour_price")
    total = prompt + completion + gpu
    return per.join(prices, "model").select(
        "model", "requests", prompt.alias("prompt_cost"), completion.alias("completion_cost"),
        gpu.alias("gpu_cost"), total.alias("total_cost"), (total / F.col("requests")).alias("cost_per_request"),
    )


# -- fleet ---------------------------------------------------------------------------


def global_metrics(per_region: DataFrame) -> DataFrame:
    """Traffic adds up; error rate and tail latency are plain means over regions."""
    return per_region.agg(
        F.sum("request_rate").alias("request_rate"),
        F.avg("error_rate").alias("error_rate"),
        F.avg("p99").alias("p99"),
    )


def recovery_stats(runs: DataFrame, status: str, automated: str) -> DataFrame:
    done = F.count_if(F.col(status) == "completed")
    return runs.agg(
        F.count(F.lit(1)).alias("total"),
        done.alias("completed"),
        F.count_if(F.col(status) == "failed").alias("failed"),
        F.count_if(F.col(status) == "in_progress").alias("in_progress"),
        F.count_if(automated).alias("automated"),
        (safe_ratio(done, F.count(F.lit(1))) * 100).alias("success_rate"),
    )


def worst_status(checks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """unhealthy > degraded > unknown > healthy, with a count of each."""
    # fixed values: severity order of the states
    ranks = ["healthy", "unknown", "degraded", "unhealthy"]
    rank = F.array_position(F.array(*[F.lit(r) for r in ranks]), F.col("status"))
    return checks.groupBy(*keys).agg(
        F.element_at(F.array(*[F.lit(r) for r in ranks]), F.max(rank).cast("int")).alias("overall"),
        *[F.count_if(F.col("status") == r).alias(r) for r in ranks],
    )


def dataset_checksum(files: DataFrame, dataset: str, path: str, digest: str, size: str) -> DataFrame:
    """sha256 over the file digests joined in path order, per dataset.

    The outer hash is a stream over sorted digests: rows arrive sorted and are
    fed to the hash batch by batch, nothing is collected.
    """
    import hashlib

    def step(memory, rows, ranges):
        if ranges[0][2]:
            memory.update(hash=hashlib.sha256(), files=0, size=0)
        memory["hash"].update("".join(rows[digest]).encode())
        memory["files"] += len(rows)
        memory["size"] += int(rows[size].sum())

    def finish(key, memory):
        return pd.DataFrame(
            {dataset: [key[0]], "files": [memory["files"]], "bytes": [memory["size"]], "checksum": [memory["hash"].hexdigest()]}
        )

    return fold_sorted(
        files.select(dataset, path, digest, size), [dataset], [path], step,
        f"{dataset} string, files bigint, bytes bigint, checksum string", finish,
    )


def collection_sizes(vectors: DataFrame, collection: str) -> DataFrame:
    return vectors.rollup(collection).agg(F.count(F.lit(1)).alias("vectors"))
