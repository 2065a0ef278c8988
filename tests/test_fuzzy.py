"""Greedy removal of near copies against a loop over all rows."""

import numpy as np
import pytest

from millrace.operators.sets import fuzzy_dedup

SCHEMA = "id long, v array<double>"


def greedy(rows, threshold):
    kept = []
    for key, v in sorted(rows):
        v = np.array(v)
        if not any(v @ o / (np.linalg.norm(v) * np.linalg.norm(o)) >= threshold for _, o in kept):
            kept.append((key, v))
    return {k for k, _ in kept}


def circle(degrees):
    return [float(np.cos(np.radians(degrees))), float(np.sin(np.radians(degrees)))]


def shapes():
    rng = np.random.default_rng(7)
    order = rng.permutation(36)
    groups = rng.normal(size=(5, 8))
    return {
        # every row is close to its two neighbours only; ids in order, in reverse, mixed
        "chain": [(i, circle(i * 4.0)) for i in range(36)],
        "mixed chain": [(int(order[i]), circle(i * 4.0)) for i in range(36)],
        # a third of the rows are different members of one group, which begins late
        "late group": [(i, rng.normal(size=8).tolist()) for i in range(80)]
        + [(100 + i, (groups[0] + rng.normal(size=8) / 40).tolist()) for i in range(40)],
        "groups": [(i, (groups[i % 5] + rng.normal(size=8) / 3).tolist()) for i in range(120)],
    }


@pytest.mark.parametrize("name", ["chain", "mixed chain", "late group", "groups"])
def test_small_prefixes_lists_and_stretches(spark, name):
    rows = shapes()[name]
    got = fuzzy_dedup(spark.createDataFrame(rows, SCHEMA), "id", "v", 0.99 if "chain" in name else 0.95, first=16, listed=2, stretch=8)
    assert {r["id"] for r in got.collect() if r["kept"]} == greedy(rows, 0.99 if "chain" in name else 0.95)


def test_whole_table_in_one_prefix(spark):
    rows = shapes()["groups"]
    got = fuzzy_dedup(spark.createDataFrame(rows, SCHEMA), "id", "v").collect()
    assert len(got) == len(rows) and {r["id"] for r in got if r["kept"]} == greedy(rows, 0.95)


def test_empty_missing_and_equal_vectors(spark):
    assert fuzzy_dedup(spark.createDataFrame([], SCHEMA), "id", "v").count() == 0
    rows = [(1, None), (2, [1.0, 0.0]), (3, None), (4, [1.0, 0.0]), (5, [2.0, 0.0]), (6, [0.0, 0.0])]
    got = fuzzy_dedup(spark.createDataFrame(rows, SCHEMA), "id", "v").collect()
    assert {r["id"] for r in got if r["kept"]} == {1, 2, 3, 6}
