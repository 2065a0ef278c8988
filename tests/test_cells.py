"""Tiled and cell-wise vector search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import retrieval as r

SCHEMA = "id bigint, v array<float>, extra string"


def brute(rows, asked, k):
    unit = lambda v: np.asarray(v, "float32").astype("float64") / (np.linalg.norm(np.asarray(v, "float32").astype("float64")) or 1)
    out = set()
    for q, qv in asked:
        scored = sorted((-round(float(unit(v) @ unit(qv)), 9), i) for i, v, _ in rows if i is not None and v is not None)
        out |= {(q, i, at + 1) for at, (_, i) in enumerate(scored[:k])}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def ask(spark, asked):
    return spark.createDataFrame(asked, "q bigint, qv array<float>")


def found(df):
    return {tuple(x) for x in df.select("q", "id", "rank").collect()}


def cloud(n, seed=1, groups=12):
    """Rows about a few centres, a third of them one vector."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, 8)) * 4
    rows = []
    for i in range(n):
        v = centres[0] if i % 3 == 0 else centres[rng.integers(groups)] + rng.normal(size=8)
        rows.append((i, [float(x) for x in np.float32(v)], "x"))
    return rows


@pytest.mark.parametrize(("piece", "block"), [(4096, 8192), (7, 3)])
def test_tiles_give_the_exact_rows(spark, piece, block):
    rows = cloud(90) + [(None, [1.0] * 8, "no id"), (900, None, "no vector"), (901, [0.0] * 8, "zero")]
    asked = [(i, rows[i][1]) for i in range(0, 90, 9)] + [(500, [0.0] * 8)]
    got = r.tile_search(frame(spark, rows), ask(spark, asked + [(501, None)]), "id", "v", "q", "qv", 4, piece_rows=piece, block_rows=block)
    assert found(got) == brute(rows, asked, 4)


def test_tiles_stay_within_their_cell(spark):
    rows = frame(spark, cloud(60)).withColumn("cell", (F.col("id") % 2).cast("int"))
    asked = ask(spark, [(1, [1.0] * 8), (2, [-1.0] * 8)]).withColumn("cell", (F.col("q") % 2).cast("int"))
    got = r.tile_search(rows, asked, "id", "v", "q", "qv", 3, "cell", 5, 1).collect()
    assert len(got) == 6 and all(x["q"] % 2 == x["id"] % 2 for x in got)


def test_index_reaches_its_recall_and_looks_at_all_rows(spark):
    rows = cloud(900)
    index = r.CellIndex(frame(spark, rows), "id", "v", 5, 0.95, trial_queries=200)
    assert index.cells > 1 and index.probe <= index.cells
    # of the copies of one vector the lowest keys, of all others each row
    kept = {x["id"] for x in index.table.select("id").collect()}
    assert kept == {i for i in range(900) if i % 3 or i < 18}
    asked = [(i, rows[i][1]) for i in range(0, 900, 20)]
    want = brute(rows, asked, 5)
    got = found(index.search(ask(spark, asked), "q", "qv", 5))
    assert len(got) == len(want)
    pairs = lambda s: {x[:2] for x in s}
    assert len(pairs(got) & pairs(want)) >= 0.9 * len(want)
    # all cells: exact
    assert found(index.search(ask(spark, asked), "q", "qv", 5, probe=index.cells)) == want


def test_small_tables(spark):
    asked = ask(spark, [(1, [1.0] * 8)])
    assert r.CellIndex(frame(spark, []), "id", "v").search(asked, "q", "qv").collect() == []
    nulls = frame(spark, [(1, None, "a"), (None, [1.0] * 8, "b")])
    assert r.CellIndex(nulls, "id", "v").search(asked, "q", "qv").collect() == []
    same = r.CellIndex(frame(spark, [(i, [2.0] * 8, "c") for i in range(40)]), "id", "v", 3)
    assert found(same.search(asked, "q", "qv")) == {(1, 0, 1), (1, 1, 2), (1, 2, 3)}
    assert same.search(asked.where("q = 9"), "q", "qv").collect() == []
    with pytest.raises(ValueError, match="built for 3"):
        same.search(asked, "q", "qv", 5)


def test_keys_may_be_words(spark):
    rows = spark.createDataFrame([(f"w{i}", v) for i, v, _ in cloud(20)], "id string, v array<float>")
    asked = rows.where("id in ('w1', 'w4')").withColumnsRenamed({"id": "q", "v": "qv"})
    got = r.tile_search(rows, asked, "id", "v", "q", "qv", 1)
    assert found(got) == {("w1", "w1", 1), ("w4", "w4", 1)}
