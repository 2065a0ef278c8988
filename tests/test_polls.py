"""Drains, polls and retries over several runs, and runs that fail on the way."""

import time

import pytest
from pyspark.sql import functions as F

from millrace.streaming import ledger, polling, uploads
from millrace.streaming.keyed import run_keyed

HOUR = uploads.HOUR


def append(spark, path, rows, schema):
    time.sleep(0.05)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def drained(df):
    return [(r["id"], r["drain"], r["place"]) for r in df.orderBy("batch", "drain", "place").collect()]


def test_drain_fails_between_delivery_and_mark(spark, tmp_path, monkeypatch):
    buffer, target, schema = str(tmp_path / "buffer"), str(tmp_path / "out"), "id int, ts bigint, metric string"
    stream = lambda: spark.readStream.schema(schema).parquet(buffer)
    append(spark, buffer, [(1, 50, "a"), (2, 10, "b")], schema)
    append(spark, buffer, [(3, 30, "a"), (4, 10, None), (5, 60, "c")], schema)
    whole = ledger.mark

    def broken(entry, target, batch):
        raise RuntimeError("lost before the mark")

    monkeypatch.setattr(ledger, "mark", broken)
    with pytest.raises(Exception, match="lost before the mark"):
        ledger.drain(stream(), ["ts", "id"], target, limit=2)
    # delivered, but not in the ledger: nobody reads it
    assert ledger.delivered(spark, target, "ts bigint, id int", stream()).count() == 0
    monkeypatch.setattr(ledger, "mark", whole)
    append(spark, buffer, [(6, 20, "late")], schema)
    # the batch that failed keeps its files; the new file is the next batch
    got = drained(ledger.drain(stream(), ["ts", "id"], target, limit=2))
    assert got == [(2, 0, 0), (4, 0, 1), (3, 1, 0), (1, 1, 1), (5, 2, 0), (6, 0, 0)]
    assert drained(ledger.drain(stream(), ["ts", "id"], target, limit=2)) == []
    everything = ledger.delivered(spark, target, "ts bigint, id int", stream())
    assert sorted(r["id"] for r in everything.collect()) == [1, 2, 3, 4, 5, 6]
    entries = ledger.committed(spark, target, "ts bigint, id int").orderBy("batch").collect()
    assert [(e["batch"], e["rows"], e["first"]["id"], e["last"]["id"]) for e in entries] == [(0, 5, 2, 5), (1, 1, 6, 6)]


def test_drain_fails_before_the_checkpoint_is_told(spark, tmp_path, monkeypatch):
    """A batch in the ledger that Spark runs again is not written again."""
    buffer, target, schema = str(tmp_path / "buffer"), str(tmp_path / "out"), "id int, ts bigint"
    stream = lambda: spark.readStream.schema(schema).parquet(buffer)
    append(spark, buffer, [(1, 5), (2, 4)], schema)
    whole = ledger.mark

    def late(entry, target, batch):
        whole(entry, target, batch)
        raise RuntimeError("lost behind the mark")

    monkeypatch.setattr(ledger, "mark", late)
    with pytest.raises(Exception, match="lost behind the mark"):
        ledger.drain(stream(), ["ts", "id"], target)
    monkeypatch.setattr(ledger, "mark", whole)
    written = []
    monkeypatch.setattr(ledger, "deliver", lambda *a: written.append(a))
    assert drained(ledger.drain(stream(), ["ts", "id"], target)) == [] and written == []
    assert drained(ledger.delivered(spark, target, "ts bigint, id int", stream())) == [(2, 0, 0), (1, 0, 1)]


def test_polls_read_new_entries_only(spark, tmp_path):
    listing, target, schema = str(tmp_path / "listing"), str(tmp_path / "polls"), "key string, region string"

    def poll():
        progress = []
        stream = spark.readStream.schema(schema).parquet(listing)
        got = polling.poll(stream, ["a", "b"], target, progress).collect()
        return sorted(tuple(r) for r in got), sum(n for _, n, _ in progress)

    append(spark, listing, [("x", "a"), ("x", "b"), ("y", "b"), ("y", "b"), (None, "a"), ("w", "elsewhere")], schema)
    assert poll() == ([("y", "b", "a", "copy")], 6)
    assert poll() == ([], 0)
    # y came to its region meanwhile, z is new, w is now where it can be copied from
    append(spark, listing, [("y", "a"), ("z", "a"), ("w", "a")], schema)
    assert poll() == ([("w", "a", "b", "copy"), ("z", "a", "b", "copy")], 3)


def test_retries_every_hour_until_given_up(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "file int, id bigint, us bigint, state string"
    minute = HOUR // 60
    rows = [(1, i, (i + 1) * minute, "ERROR") for i in range(10)]  # stuck at minute 10
    rows += [(2, 20 + i, (i + 1) * minute, "ERROR") for i in range(11)] + [(2, 40, 10 * minute + 2 * HOUR, "UPLOADED")]  # uploaded at the time of a retry
    rows += [(2, 41, 30 * HOUR, "ERROR"), (2, 42, 30 * HOUR + 1, "ERROR"), (2, 43, 32 * HOUR, "UPLOADED")]  # one more error is enough
    rows += [(3, 60 + i, (i + 1) * minute, "ERROR") for i in range(9)]  # never stuck
    rows += [(1, 80, 40 * HOUR, "ERROR"), (None, 90, 5, "UPLOADED")]  # given up: no second cycle
    append(spark, path, sorted(rows, key=lambda r: r[2]), schema)
    at = 10 * minute
    want = [(1, at, "stuck", 0), *((1, at + n * HOUR, "retry", n) for n in range(1, 24)), (1, at + 24 * HOUR, "given_up", 24)]
    want += [(2, at, "stuck", 0), (2, at + HOUR, "retry", 1), (2, 30 * HOUR, "stuck", 0), (2, 31 * HOUR, "retry", 1)]
    batch = uploads.retries_batch(spark.read.parquet(path), "file", "us", ["us", "id"], "state")
    assert sorted(tuple(r) for r in batch.collect()) == sorted(want)
    step, tick = uploads.retry_step("file", "us", "state"), uploads.retry_tick("file", "us")
    stream = spark.readStream.schema(schema).parquet(path)
    live = run_keyed(stream, ["file"], ["us", "id"], step, "file int, us bigint, action string, attempt int", tick=tick)
    assert sorted(tuple(r) for r in live.collect()) == sorted(want)


def test_poll_calls_no_python_for_each_key(spark, tmp_path, monkeypatch):
    from pyspark.sql.group import GroupedData

    def refused(*args, **more):
        raise AssertionError("one call for each key")

    monkeypatch.setattr(GroupedData, "transformWithStateInPandas", refused)
    listing, target, schema = str(tmp_path / "listing"), str(tmp_path / "polls"), "key string, region string"
    append(spark, listing, [(f"k{i}", "b") for i in range(50)] + [("all", r) for r in "abc"] + [("none", None)], schema)
    got = polling.poll(spark.readStream.schema(schema).parquet(listing), ["a", "b", "c"], target).collect()
    assert sorted(map(tuple, got)) == sorted((f"k{i}", "b", r, "copy") for i in range(50) for r in "ac")
