"""The sliced plan for hot keys gives the rows of the plain window plan."""

import pytest
from pyspark.sql import functions as F

from millrace.plans.ordered import Ordered
from millrace.plans.quantiles import exact_quantiles


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def events(spark):
    # user 1 holds a third of all rows, one value repeats
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("user"),
        (F.hash("id") % 50).cast("long").alias("v"),
        F.when(F.col("id") % 7 == 0, F.col("id")).alias("sparse"),
    )


@pytest.mark.parametrize("keys", [["user"], []])
def test_running(events, keys):
    cols = dict(
        s=("sum", F.col("v")), m=("max", F.col("v")), lo=("min", F.col("v")),
        c=("count", F.col("sparse")), z=("last", F.col("sparse")),
    )
    names = ["id", *cols]
    plain = Ordered(events, keys, ["id"], 10**9)
    cut = Ordered(events, keys, ["id"], 150)
    assert not plain.sliced and cut.sliced
    assert _rows(plain.running(**cols), names) == _rows(cut.running(**cols), names)


def test_null_prefix(spark):
    df = spark.range(400).select("id", F.when(F.col("id") > 350, F.col("id")).alias("v"))
    a = Ordered(df, [], ["id"], 10**9).running(x=("sum", F.col("v"))).collect()
    b = Ordered(df, [], ["id"], 50).running(x=("sum", F.col("v"))).collect()
    key = lambda r: r["id"]
    assert [r["x"] for r in sorted(a, key=key)] == [r["x"] for r in sorted(b, key=key)]


@pytest.mark.parametrize("keys", [["user"], []])
def test_lag(events, keys):
    a = Ordered(events, keys, ["id"], 10**9).lag(p=F.col("v"), q=F.col("sparse"))
    b = Ordered(events, keys, ["id"], 150).lag(p=F.col("v"), q=F.col("sparse"))
    key = lambda r: (r[0],)
    left = sorted(map(tuple, a.select("id", "p", "q").collect()), key=key)
    assert left == sorted(map(tuple, b.select("id", "p", "q").collect()), key=key)


@pytest.mark.parametrize("size,hot", [(5, 150), (300, 100), (40, 30)])
@pytest.mark.parametrize("keys", [["user"], []])
def test_rolling(events, keys, size, hot):
    cols = dict(a=lambda w: F.sum("v").over(w), n=lambda w: F.count("v").over(w))
    a = Ordered(events, keys, ["id"], 10**9).rolling(size, **cols)
    b = Ordered(events, keys, ["id"], hot).rolling(size, **cols)
    assert _rows(a, ["id", "a", "n"]) == _rows(b, ["id", "a", "n"])


@pytest.mark.parametrize("by_index", [True, False])
@pytest.mark.parametrize("keys", [["user"], []])
def test_quantiles(events, keys, by_index):
    qs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    a = exact_quantiles(events, keys, "v", qs, by_index, 10**9)
    b = exact_quantiles(events, keys, "v", qs, by_index, 20)
    assert [tuple(round(x, 9) for x in r) for r in _rows(a, keys + list(qs))] == [
        tuple(round(x, 9) for x in r) for r in _rows(b, keys + list(qs))
    ]
