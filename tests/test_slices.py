"""Busy keys without idle gaps: slices folded at once against one fold."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.streaming import stateful as s

SCHEMA = "k int, id bigint, us bigint, bad boolean, size bigint"
ORDER, KEEP = ["us", "id"], {"k": "int", "id": "bigint"}


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds half of the rows; no two of its rows are further apart than any limit below.
    Some rows have no key."""
    rng = random.Random(5)
    made = [(1 if i % 2 else rng.choice([2, 3, None]), i, i * 3 + rng.randrange(3), rng.random() < 0.01, rng.randrange(1, 30)) for i in range(1200)]
    return spark.createDataFrame(made, SCHEMA)


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


RULES = {
    "cooldown": lambda rows, hot: s.cooldown_batch(rows.withColumn("wait", F.lit(25)), ["k"], ORDER, "us", "wait", KEEP, hot),
    "rotation": lambda rows, hot: s.rotation_batch(rows, ["k"], ORDER, "us", "size", "bad", KEEP, 300, 400, hot),
    "rate limit": lambda rows, hot: s.rate_limit_batch(rows, ["k"], ORDER, "us", "bad", KEEP, 7, 90, hot),
}


@pytest.mark.parametrize("rule", RULES)
def test_slices_equal_one_fold(rows, rule):
    same(RULES[rule](rows, 100_000), RULES[rule](rows, 150))


def test_one_key_is_many_tasks(spark):
    """A step that never forgets: each slice needs the exact memory of the one before."""
    from millrace.plans.sequential import fold_sliced, fold_sorted

    def step(memory, rows, ranges):
        totals = []
        for a, b, new in ranges:
            total = 0 if new else memory["total"]
            for x in rows["id"].tolist()[a:b]:
                total += x
                totals.append(total)
            memory["total"] = total
        return rows[["id"]].assign(total=totals)

    rows = spark.range(1000).select("id", F.lit("a").alias("k"))
    schema = "id bigint, total bigint"
    same(fold_sorted(rows, ["k"], ["id"], step, schema), fold_sliced(rows, ["k"], ["id"], step, schema, 250))
