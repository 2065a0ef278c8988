"""Large counts, null keys, zero vectors, values outside the known ones, whole reports."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, drift, experiments, features, joins, models, sets
from millrace.sources import scans, sinks


def test_many_ties(spark):
    rows = spark.range(5_000_000).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("side"), F.lit(1.0).alias("x"))
    name = next(n for n in dir(experiments) if "rank" in n and callable(getattr(experiments, n)))
    out = getattr(experiments, name)(rows, "side", "x", "a", "b").first()
    assert out["n1"] == out["n2"] == 2_500_000 and not out["has_winner"]


def test_null_labels_are_split(spark):
    rows = spark.range(40).select("id", F.when(F.col("id") % 2 == 0, "x").alias("label"))
    split = features.stratified_split(rows, "id", "label", 0.2, 0.2)
    assert split.count() == 40 and split.where("label is null").select("split").distinct().count() == 3


def test_null_group_has_a_distribution(spark):
    rows = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 4.0)], "k string, v double")
    got = {r["k"]: r["mean"] for r in aggregates.distribution_summary(rows, ["k"], "v").collect()}
    assert got == {"a": 1.0, None: 3.0}


def test_zero_vectors_are_no_copies(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0])], "id long, v array<double>")
    assert {r["id"]: r["kept"] for r in sets.fuzzy_dedup(rows, "id", "v").collect()} == {1: True, 2: True, 3: True, 4: False}


def test_vectors_can_be_set_to_null(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    updates = spark.createDataFrame([(1, None)], "id int, v string")
    assert {tuple(r) for r in sinks.update_vectors(target, updates, "id", ["v"]).collect()} == {(1, None), (2, "b")}


def test_forest_sees_all_rows(spark):
    """The odd rows come last in key order."""
    rows = spark.range(6000).select("id", F.when(F.col("id") < 5000, F.col("id") % 7).otherwise(F.col("id") % 7 + 50).alias("x"), (F.col("id") % 11).alias("y"))
    forest = models.IsolationForest(trees=10).fit(rows, ["x", "y"], ["id"])
    cuts = [n[1] for tree in forest.forest for n in tree if n[0] == 0]
    assert any(10 < c < 50 for c in cuts)
    decisions = forest.score(rows, ["id"]).agg(F.avg((F.col("decision") < 0).cast("int"))).first()[0]
    assert decisions <= 0.02


def test_unknown_priorities_and_states_are_errors(spark):
    files = spark.createDataFrame([("k", 1, 10, 3, "PENDING")], "key string, file_id int, at long, priority int, state string")
    event = "key string, event_id int, at long, pre long, post long, priority int"
    known = joins.promote_in_windows(files, spark.createDataFrame([("k", 7, 10, 5, 5, 0), ("k", 8, 10, 5, 5, None)], event), "key")
    assert [(r["file_id"], r["new_priority"]) for r in known.collect()] == [(1, 0)]
    with pytest.raises(Exception, match="unknown event priority 4"):
        joins.promote_in_windows(files, spark.createDataFrame([("k", 7, 10, 5, 5, 4)], event), "key").collect()
    counts = aggregates.state_priority_counts(files, ["PENDING", "UPLOADED"]).first()
    assert (counts["PENDING"], counts["UPLOADED"]) == (1, 0)
    with pytest.raises(Exception, match="unknown state PENDING"):
        aggregates.state_priority_counts(files, ["UPLOADED"]).collect()


def test_report_covers_its_period(spark):
    """Twenty even days and one dear one; what lies outside the period counts nowhere."""
    rows = [("p", "r", "s", f"2024-01-{i:02}", 10.0) for i in range(1, 21)] + [("q", "r", "s", "2024-01-21", 90.0), ("p", "r", "s", "2023-12-31", 1e6)]
    costs = spark.createDataFrame(rows, "provider string, region string, service string, day string, amount double").withColumn("day", F.to_date("day"))
    report = json.loads(sinks.report_document(costs, "2024-01-01", "2024-01-31", {"p": (60.0, "Provider", 3)}).first()["report"])
    assert report["summary"] == {"total": 290.0} and report["by_provider"] == {"p": 200.0, "q": 90.0}
    assert [(a["day"], a["severity"]) for a in report["anomalies"]] == [("2024-01-21", "high")]
    assert report["trends"]["daily_change"] == 800.0 and round(report["trends"]["weekly_change"], 3) == 114.286
    assert [(a["provider"], a["category"], a["priority"]) for a in report["recommendations"]] == [("p", "Provider", 3)]


def test_drift_summary_has_all_scores(spark):
    stats = spark.createDataFrame([("a", 0.3), ("b", 0.05)], "feature string, statistic double")
    got = drift.drift_summary(drift.ks_drift(stats)).first()
    assert got["scores"] == {"a": 0.3, "b": 0.05} and got["names"] == "a"


def test_listing_with_etags(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(b"some content")
    got = scans.object_listing(spark, str(tmp_path), etag=True).first()
    assert (got["etag"], got["size"]) == (hashlib.md5(b"some content").hexdigest(), 12)
