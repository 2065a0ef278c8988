"""Predicates, rules, gates, tags and projections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    id: str
    trigger: str
    promote_to: int
    pre_sec: float
    post_sec: float

    @property
    def score(self) -> float:
        """Type weight 1.0 for priority 0 and 0.7 otherwise, doubled, times 25, at most 100."""
        return min(100.0, max(0.0, (1.0 if self.promote_to == 0 else 0.7) * 2.0 * 25))


# fixed values: rule id, trigger, target priority, seconds kept before and after
RULES = [
    Rule("battery_critical", "battery_pct < 15", 0, 30, 0),
    Rule("motor_overcurrent", "motor_current_A > 12", 0, 10, 5),
    Rule("collision_imu", "linear_accel_mps2 > 8", 0, 5, 10),
    Rule("lidar_near_obstacle", "obstacle_dist_m < 0.1", 0, 5, 5),
    Rule("fatal_log", "has_fatal_log", 0, 0, 30),
    Rule("unexpected_restart", "restart_count > 0", 0, 60, 30),
    Rule("high_motor_temp", "motor_temp_C > 80", 0, 60, 10),
    Rule("nav_stuck", "nav_stuck", 1, 10, 15),
    Rule("battery_low", "battery_pct < 25", 1, 10, 0),
    Rule("motor_temp_elevated", "motor_temp_C > 60", 1, 30, 5),
    Rule("high_cpu_temp", "cpu_temp_C > 70", 1, 20, 5),
    Rule("slam_lost", "slam_localized == False", 1, 30, 30),
    Rule("battery_discharging_fast", "battery_drain_rate > 0.3", 2, 5, 5),
    Rule("wifi_poor", "wifi_rssi < -75", 2, 0, 0),
]


def rules_from_yaml(text: str) -> list[Rule]:
    """Rules of a YAML document; prefixes such as ``telemetry.`` are dropped."""
    import re

    import yaml

    out = []
    for r in yaml.safe_load(text)["rules"]:
        trigger = re.sub(r"(telemetry|imu|lidar|odometry|log)\.", "", r["trigger"])
        level = int(str(r.get("promote_to", 1)).replace("p", ""))
        out.append(Rule(r["id"], trigger, level, float(r.get("capture_pre_sec", 10)), float(r.get("capture_post_sec", 5))))
    return out


def priority_of_score(score: Column) -> Column:
    return F.when(score >= 90, 0).when(score >= 60, 1).when(score >= 30, 2).otherwise(3)


def rule_events(frames: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per frame and matching rule.

    A rule that names a column the frames do not have never matches; null
    triggers do not match either.
    """

    def holds(rule: Rule) -> Column:
        condition = F.expr(rule.trigger).cast("boolean")
        try:
            frames.select(condition)
        except AnalysisException:
            return F.lit(False)
        return F.coalesce(condition, F.lit(False))

    hits = [
        F.when(
            holds(r),
            F.struct(
                F.lit(r.id).alias("rule"), F.lit(r.promote_to).alias("priority"), F.lit(r.score).alias("score"),
                F.lit(float(r.pre_sec)).alias("pre_sec"), F.lit(float(r.post_sec)).alias("post_sec"),
            ),
        )
        for r in rules
    ]
    matched = F.filter(F.array(*hits), lambda x: x.isNotNull())
    return frames.select("*", F.explode(matched).alias("_hit")).select(*frames.columns, "_hit.*")


def drop_incomplete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(required))


def removed_counts(df: DataFrame, keys: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Rows in, rows after de-duplication and rows with every required column."""
    distinct = df.groupBy(*keys, *[c for c in required if c not in keys]).agg(F.count(F.lit(1)).alias("n"))
    whole = F.lit(True)
    for c in required:
        whole = whole & F.col(c).isNotNull()
    return distinct.agg(
        F.sum("n").alias("rows_in"), F.count(F.lit(1)).alias("rows_distinct"), F.count_if(whole).alias("rows_out")
    ).withColumn("removed", F.col("rows_in") - F.col("rows_out"))


def has_flag(flags: Column, flag: str) -> Column:
    return F.array_contains(flags, flag)


def since(ts: Column, as_of: str, interval: str) -> Column:
    return ts > F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {interval}")


def threshold_gate(metrics: DataFrame, minimums: dict[str, float], model: str) -> DataFrame:
    """Per model: the metrics that are missing or below their minimum, and whether it passes."""
    wanted = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(v).alias("minimum")) for m, v in minimums.items()])
    # metric names are a fixed short list, so the map holds a handful of entries
    values = metrics.groupBy(model).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("values")
    )
    failed = F.array_sort(
        F.transform(
            F.filter(wanted, lambda w: F.coalesce(F.try_element_at(F.col("values"), w["metric"]) < w["minimum"], F.lit(True))),
            lambda w: w["metric"],
        )
    )
    return values.select(model, F.array_join(failed, ",").alias("failed"), (F.size(failed) == 0).alias("passes"))


def tag_when(**conditions: Column) -> Column:
    """Sorted array of the names whose condition holds."""
    tags = [F.when(c, F.lit(n)) for n, c in conditions.items()]
    return F.array_sort(F.filter(F.array(*tags), lambda t: t.isNotNull()))


# fixed values: label per priority
PRIORITY_LABELS = {0: "P0 Critical", 1: "P1 High", 2: "P2 Normal", 3: "P3 Low/Bulk"}


def priority_label(priority: Column) -> Column:
    out = F.lit("unknown")
    for p, label in PRIORITY_LABELS.items():
        out = F.when(priority == p, label).otherwise(out)
    return out


def long_enough(df: DataFrame, text: Column, min_length: int = 10) -> DataFrame:
    return df.where(F.length(text) >= min_length)


def missing_fields(record: Column, expected: Sequence[str]) -> Column:
    """Expected names a JSON record does not have."""
    return F.array_except(F.array(*[F.lit(e) for e in expected]), F.json_object_keys(record))


def missing_field_counts(df: DataFrame, record: str, expected: Sequence[str]) -> DataFrame:
    return (
        df.select(F.explode(missing_fields(F.col(record), expected)).alias("feature"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("missing"))
    )


def recommendations(shares: DataFrame, component: str, limits: dict[str, tuple[float, str, int]]) -> DataFrame:
    """``limits``: component -> (share that must be passed, category, priority)."""
    rule = F.coalesce(*[
        F.when(
            (F.col(component) == name) & (F.col("percentage") > limit),
            F.struct(F.lit(category).alias("category"), F.lit(level).alias("priority")),
        )
        for name, (limit, category, level) in limits.items()
    ])
    return shares.select(component, "percentage", rule.alias("r")).where("r is not null").select(
        component, "percentage", "r.category", "r.priority"
    )


def copy_decision(source: DataFrame, target: DataFrame, full: bool = False) -> DataFrame:
    """Per key: copy when missing, of other size or on full sync; conflict on another etag."""
    t = target.select("key", F.col("size").alias("t_size"), F.col("etag").alias("t_etag"))
    action = (
        F.when(F.lit(full) | F.col("t_size").isNull(), "copy")
        .when(F.col("size") != F.col("t_size"), "copy")
        .when(F.col("etag") != F.col("t_etag"), "conflict")
        .otherwise("skip")
    )
    return source.join(t, "key", "left").select("key", action.alias("action"))
