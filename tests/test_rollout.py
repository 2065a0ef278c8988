"""Staged rollouts by passes over stages against the fold over single requests."""

import numpy as np

from millrace.operators.experiments import rollout_stages
from millrace.plans.sequential import fold_sorted
from millrace.streaming.stateful import ROLLOUT, rollout_step

SCHEMA = "k int, id bigint, us bigint, new boolean, ok boolean, ms double"
LIMITS = {"min_promote": 12, "min_age": 15, "min_rollback": 5, "error_limit": 0.3, "latency_limit": 1.4}


def requests():
    """Key 0 holds a third; keys fail or slow down at different times, some never."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1500):
        k = 0 if i % 3 == 0 else int(rng.integers(1, 12))
        late = i > 130 * k
        new = bool(rng.random() < 0.5)
        good = bool(rng.random() > (0.45 if late and k % 3 == 1 and new else 0.02))
        # whole numbers: sums are exact in whichever order they are taken
        ms = float(rng.integers(50, 150) + (60 if late and k % 3 == 2 and new else 0))
        rows.append((k, i, i // 2, new, good, ms))
    return rows


def rounded(df):
    return sorted((r["k"], r["id"], r["action"], r["traffic"], r["requests"], round(r["error_rate"], 8), round(r["latency_ratio"], 8)) for r in df.collect())


def test_stages_equal_the_fold(spark):
    rows = spark.createDataFrame(requests(), SCHEMA)
    step = rollout_step("us", "new", "ok", "ms", ["k", "id"], **LIMITS)
    want = rounded(fold_sorted(rows, ["k"], ["us", "id"], step, "k int, id bigint, " + ROLLOUT))
    names = ["us", "new", "ok", "ms", ["k", "id"]]
    for hot in (100_000, 100):
        assert rounded(rollout_stages(rows, ["k"], ["us", "id"], *names, hot_rows=hot, **LIMITS)) == want
    actions = {(a, t) for _, _, a, t, *_ in want}
    assert ("promote", 100) in actions and ("promote", 10) in actions and len({t for a, t in actions if a == "rollback"}) > 1


def test_no_requests(spark):
    rows = spark.createDataFrame([], SCHEMA)
    assert rollout_stages(rows, ["k"], ["us", "id"], "us", "new", "ok", "ms", ["k", "id"]).count() == 0
