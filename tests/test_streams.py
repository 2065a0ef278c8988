"""Streams fed file by file give the result of the batch form."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.streaming import stateful as s
from millrace.streaming.jobs import replayed_lateness, run_available, with_end
from millrace.streaming.keyed import OrderedSteps, run_keyed

ORDER = ["us", "id"]
SCHEMA = "k int, id bigint, us bigint, size bigint, bad boolean, ok boolean, ms double"


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Each batch starts a Python worker for each partition of the state."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def rows(spark):
    rng, t, out = random.Random(2), 0, []
    for i in range(400):
        t += rng.choice([1, 3, 10, 60])
        out.append((1 if i % 3 else rng.randrange(4), i, t, rng.randrange(100), rng.random() < 0.05, rng.random() < 0.6, rng.random() * 100))
    return spark.createDataFrame(out, SCHEMA)


@pytest.fixture(scope="module")
def stream(spark, rows, tmp_path_factory):
    """Five files in event order, one per trigger."""
    import time

    folder = tmp_path_factory.mktemp("rows")
    for part in range(5):
        rows.where((F.col("id") >= part * 80) & (F.col("id") < part * 80 + 80)).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    return lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def same(a, b):
    key = lambda df: sorted(map(repr, (tuple(r) for r in df.select(*a.columns).collect())))
    left = key(a)
    assert left and left == key(b)


KEEP = {"k": "int", "id": "bigint"}
KEPT = "k int, id bigint, "


def test_cooldown(rows, stream):
    batch = s.cooldown_batch(rows.withColumn("wait", F.lit(25)), ["k"], ORDER, "us", "wait", KEEP, hot_rows=50)
    live = run_keyed(stream().withColumn("wait", F.lit(25)), ["k"], ORDER, s.cooldown_step("us", "wait", list(KEEP)), "k int, id bigint")
    same(batch, live)
    fired, last = [], {}
    for r in rows.orderBy("us", "id").collect():
        if r["k"] not in last or r["us"] - last[r["k"]] >= 25:
            last[r["k"]] = r["us"]
            fired.append(r["id"])
    assert sorted(r["id"] for r in batch.collect()) == fired


def test_rotation(rows, stream):
    batch = s.rotation_batch(rows, ["k"], ORDER, "us", "size", "bad", KEEP, 300, 90, hot_rows=50)
    live = run_keyed(stream(), ["k"], ORDER, s.rotation_step("us", "size", "bad", list(KEEP), 300, 90), KEPT + s.ROTATION)
    same(batch, live)
    assert {r["reason"] for r in batch.collect()} == {"anomaly", "size", "time"}


def test_rate_limit(rows, stream):
    batch = s.rate_limit_batch(rows, ["k"], ORDER, "us", "bad", KEEP, 3, 60, hot_rows=50)
    live = run_keyed(stream(), ["k"], ORDER, s.rate_limit_step("us", "bad", list(KEEP), 3, 60), KEPT + "accepted boolean")
    same(batch, live)


def test_batching_covers_every_request(rows):
    out = s.batching_batch(rows, ["k"], ORDER, "us", {**KEEP, "us": "bigint"}, 4, 20, hot_rows=50)
    assert out.count() == 400
    sizes = out.groupBy("k", "segment", "batch").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("us") - F.col("flushed_at")).alias("late"))
    top = sizes.agg(F.max("n"), F.max("late")).first()
    assert top[0] == 4 and top[1] <= 0


def test_batching_in_pieces(rows, stream):
    """A queue that spans two files is the same queue."""
    keep = {**KEEP, "us": "bigint"}
    step = s.batching_step("us", list(keep), 4, 20)
    live = run_keyed(stream(), ["k"], ORDER, step, KEPT + "us bigint, " + s.BATCHING).select("id", "flushed_at", "reason")
    got = {r["id"]: (r["flushed_at"], r["reason"]) for r in live.collect()}
    batch = s.batching_batch(rows, ["k"], ORDER, "us", keep, 4, 20, hot_rows=50)
    want = {r["id"]: (r["flushed_at"], r["reason"]) for r in batch.collect()}
    queue, last, flushed = {}, {}, {}
    for r in rows.orderBy("us", "id").collect():
        k, t = r["k"], r["us"]
        q = queue.setdefault(k, [])
        due = None if not q else max(q[0][1], last.get(k, -10**9) + 20)
        if q and t > due:
            flushed.update({i: (due, "timeout") for i, _ in q})
            last[k], queue[k] = due, []
            q = queue[k]
        q.append((r["id"], t))
        if len(q) == 4:
            flushed.update({i: (t, "size") for i, _ in q})
            last[k], queue[k] = t, []
    assert got == flushed
    open_rows = {i for q in queue.values() for i, _ in q}
    assert {i: v for i, v in want.items() if i not in open_rows} == flushed and set(want) == set(flushed) | open_rows


@pytest.mark.parametrize("records", ["7", "64"])
def test_folds_do_not_depend_on_arrow_batches(spark, rows, records):
    runs = {
        "cooldown": lambda: s.cooldown_batch(rows.withColumn("wait", F.lit(25)), ["k"], ORDER, "us", "wait", KEEP),
        "rotation": lambda: s.rotation_batch(rows, ["k"], ORDER, "us", "size", "bad", KEEP, 300, 90),
        "limit": lambda: s.rate_limit_batch(rows, ["k"], ORDER, "us", "bad", KEEP, 3, 60),
        "queue": lambda: s.batching_batch(rows, ["k"], ORDER, "us", {**KEEP, "us": "bigint"}, 4, 20),
    }
    from millrace.operators.windows import rolling_zscore

    runs["zscore"] = lambda: rolling_zscore(rows, ["k"], ORDER, "ms", size=40, limit=1.5).select("id", F.round("z", 9), "is_anomaly")
    collect = lambda: {n: sorted(map(repr, f().collect())) for n, f in runs.items()}
    whole, name = collect(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, records)
    try:
        assert collect() == whole
    finally:
        spark.conf.set(name, before)


def test_zscore_state(rows, stream):
    from millrace.operators.windows import rolling_zscore

    batch = rolling_zscore(rows, ["k"], ORDER, "ms", size=40, limit=1.5, hot_rows=50).select("id", F.round("z", 8).alias("z"), "is_anomaly")
    live = run_keyed(stream(), ["k"], ORDER, s.zscore_step("ms", ["id"], 40, limit=1.5), "id bigint, z double, is_anomaly boolean")
    same(batch, live.withColumn("z", F.round("z", 8)))


def test_health(rows, stream):
    from millrace.operators.windows import failure_streaks

    batch = s.health_states(failure_streaks(rows, "k", ORDER, "ok", hot_rows=50), "ok", "ms", fast=50.0).select("id", "streak", "health")
    live = run_keyed(stream(), ["k"], ORDER, s.health_step("ok", "ms", ["id"], fast=50.0), "id bigint, streak bigint, health string")
    same(batch, live)


def test_rollout_resets_on_promotion(rows, stream):
    step = lambda: s.rollout_step("us", "bad", "ok", "ms", ["id"], min_promote=3, min_age=20, error_limit=0.95, latency_limit=9.0, min_rollback=2)
    from millrace.plans.sequential import fold_sorted

    batch = fold_sorted(rows, ["k"], ORDER, step(), "id bigint, " + s.ROLLOUT)
    same(batch, run_keyed(stream(), ["k"], ORDER, step(), "id bigint, " + s.ROLLOUT))


def test_late_rows_are_dropped(spark, tmp_path):
    import time

    make = lambda times: spark.createDataFrame([(t,) for t in times], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
    for times in ([0, 100], [10_000], [20_000], [50]):
        make(times).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    rows = spark.readStream.schema("ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sums = rows.withWatermark("ts", "1 minute").groupBy(F.window("ts", "1 hour")).agg(F.count(F.lit(1)).alias("n"))
    out = run_available(sums).select(F.unix_seconds("window.start").alias("at"), "n").collect()
    assert {r["at"]: r["n"] for r in out}[0] == 2


def test_repeated_run_adds_nothing(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "in"))
    run = lambda: run_available(
        spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), checkpoint=str(tmp_path / "cp"), target=str(tmp_path / "out")
    )
    assert run().count() == 400 and run().count() == 400


@pytest.fixture(scope="module")
def shuffled(spark, rows, tmp_path_factory):
    """Files whose rows come from anywhere in the event times, one per trigger."""
    import time

    folder = tmp_path_factory.mktemp("shuffled")
    for part in range(4):
        rows.where(F.pmod(F.xxhash64("id"), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    return lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_cut_of_batches_does_not_matter(rows, shuffled):
    from millrace.operators.windows import failure_streaks, rolling_zscore
    from millrace.plans.sequential import fold_sorted

    run = lambda step, schema, idle=None: run_keyed(shuffled().withColumn("wait", F.lit(25)), ["k"], ORDER, step, schema, "1 minute", idle=idle)
    waits = rows.withColumn("wait", F.lit(25))
    same(s.cooldown_batch(waits, ["k"], ORDER, "us", "wait", KEEP), run(s.cooldown_step("us", "wait", list(KEEP)), "k int, id bigint", 25))
    same(s.rotation_batch(rows, ["k"], ORDER, "us", "size", "bad", KEEP, 300, 90), run(s.rotation_step("us", "size", "bad", list(KEEP), 300, 90), KEPT + s.ROTATION))
    same(s.rate_limit_batch(rows, ["k"], ORDER, "us", "bad", KEEP, 3, 60), run(s.rate_limit_step("us", "bad", list(KEEP), 3, 60), KEPT + "accepted boolean", 60))
    health = s.health_states(failure_streaks(rows, "k", ORDER, "ok"), "ok", "ms", fast=50.0).select("id", "streak", "health")
    same(health, run(s.health_step("ok", "ms", ["id"], fast=50.0), "id bigint, streak bigint, health string"))
    scores = rolling_zscore(rows, ["k"], ORDER, "ms", size=40, limit=1.5).select("id", F.round("z", 8).alias("z"), "is_anomaly")
    same(scores, run(s.zscore_step("ms", ["id"], 40, limit=1.5), "id bigint, z double, is_anomaly boolean").withColumn("z", F.round("z", 8)))
    step = lambda: s.rollout_step("us", "bad", "ok", "ms", ["id"], min_promote=3, min_age=20, error_limit=0.95, latency_limit=9.0, min_rollback=2)
    same(fold_sorted(rows, ["k"], ORDER, step(), "id bigint, " + s.ROLLOUT), run(step(), "id bigint, " + s.ROLLOUT))


def test_rows_behind_the_watermark_are_dropped(spark, rows, tmp_path):
    """The second hundred comes when the watermark is past it: the result is that of the others."""
    import time

    from millrace.operators.windows import failure_streaks

    for part in (0, 2, 3, 1):
        rows.where(F.floor(F.col("id") / 100) == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    step = s.health_step("ok", "ms", ["id"], fast=50.0)
    live = run_keyed(stream, ["k"], ORDER, step, "id bigint, streak bigint, health string", "0 seconds", F.timestamp_millis("us"))
    left = rows.where(F.floor(F.col("id") / 100) != 1)
    same(s.health_states(failure_streaks(left, "k", ORDER, "ok"), "ok", "ms", fast=50.0).select("id", "streak", "health"), live)


def test_closed_windows_come_out_once(spark, shuffled, rows, tmp_path):
    end = str(tmp_path / "end")
    timed = with_end(shuffled().withColumn("ts", F.timestamp_millis("us")), "ts", end).withWatermark("ts", "1 minute")
    sums = timed.groupBy(F.window("ts", "1 second")).agg(F.count(F.lit(1)).alias("n"))
    got = run_available(sums, end=end).select(F.unix_seconds("window.start").alias("at"), "n")
    same(rows.groupBy(F.floor(F.col("us") / 1000).alias("at")).agg(F.count(F.lit(1)).alias("n")).select("at", "n"), got.select("at", "n"))


def test_replayed_rows_are_written_once(rows, shuffled):
    out = run_available(shuffled().select("id", "k").unionByName(shuffled().select("id", "k")), once=["id"])
    same(rows.select("id", "k"), out.select("id", "k"))


def test_queues_do_not_depend_on_the_cut(stream, shuffled):
    step = s.batching_step("us", ["k", "id", "us"], 4, 20)
    run = lambda rows: run_keyed(rows, ["k"], ORDER, step, KEPT + "us bigint, " + s.BATCHING, "1 minute")
    same(run(stream()), run(shuffled()))


class Store:
    """A key's state in plain dictionaries, for the processor without Spark."""

    def __init__(self):
        self.values, self.entries, self.timers, self.largest = {}, {}, set(), 0

    def getMapState(self, name, *_):
        return self

    def getValueState(self, name, *_):
        return Value(self.values, name)

    def registerTimer(self, at):
        self.timers.add(at)

    def updateValue(self, key, value):
        self.entries[key], self.largest = value, max(self.largest, len(value[0]))

    def getValue(self, key):
        return self.entries[key]

    def removeKey(self, key):
        del self.entries[key]


class Value:
    def __init__(self, values, name):
        self.values, self.name = values, name

    def exists(self):
        return self.name in self.values

    def get(self):
        return self.values[self.name]

    def update(self, value):
        self.values[self.name] = value

    def clear(self):
        self.values.pop(self.name, None)


class At:
    def __init__(self, millis):
        self.millis = millis

    def getCurrentWatermarkInMs(self):
        return self.millis


def test_backlog_of_a_busy_key_is_read_piece_by_piece():
    """300,000 rows of one key over five hours in no order: no call and no state value holds more than a part of them."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    n, hour = 300_000, 3_600_000_000
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"id": np.arange(n), "ok": rng.random(n) < 0.6, "row_us": 1_000_000 + np.arange(n) * (5 * hour // n)})
    frame["row_end"] = False
    steps = OrderedSteps(s.health_step("ok", "id", ["id"]), ["row_us", "id"], pa.Schema.from_pandas(frame.drop(columns="row_end"), preserve_index=False), None, hour)
    store, held, taken = Store(), [], []
    steps.init(store)
    read = steps._take
    steps._take = lambda number: taken.append(len(rows := read(number))) or rows
    inner = steps._sorted
    steps._sorted = lambda rows: held.append(len(rows)) or inner(rows)
    mixed = frame.iloc[rng.permutation(n)]
    assert list(steps.handleInputRows(("k",), (mixed[i : i + 10_000] for i in range(0, n, 10_000)), At(0))) == []
    assert max(held) <= 70_000 and store.largest < 4096 * 40 + 2000
    held.clear()
    out = []
    for millis in (1, hour // 1000 * 2 + 77, hour // 1000 * 6):  # nothing, a part that ends inside a chunk, the rest
        for part in steps.handleExpiredTimer(("k",), At(millis), None):
            out.append(part)
    got = pd.concat(out, ignore_index=True)
    assert got["id"].tolist() == list(range(n)) and max(held) <= n // 5 + 2 * 4096
    streak, want = 0, []
    for ok in frame["ok"]:
        streak = 0 if ok else streak + 1
        want.append(streak)
    assert got["streak"].tolist() == want
    assert not store.entries


@pytest.mark.parametrize("files", [1, None])
def test_hot_key_by_files_and_at_once(spark, tmp_path, files):
    """A key with a third of the rows, four files in event order: one file per trigger and all in one give the batch rows."""
    import time

    rows = spark.range(24_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("int").alias("k"), "id",
        (F.col("id") * 400_000 + 1_000_000).alias("us"), (F.xxhash64("id") % 3 != 0).alias("ok"), F.lit(1.0).alias("ms"),
    )
    for part in range(4):
        rows.where(f"id >= {part * 6000} and id < {part * 6000 + 6000}").repartition(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    written = spark.read.parquet(str(tmp_path / "in"))
    late = replayed_lateness(written, F.timestamp_micros("us"))
    assert 2_390_000 <= int(late.split()[0]) <= 2_400_001  # a file's own span, as files of one moment come in any order
    reader = spark.readStream.schema(written.schema)
    stream = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(str(tmp_path / "in"))
    progress = []
    got = run_keyed(stream, ["k"], ORDER, s.health_step("ok", "ms", ["id"]), "id bigint, streak bigint, health string", late, progress=progress)
    want, streaks = {}, {}
    for r in rows.orderBy("us").collect():
        streaks[r["k"]] = 0 if r["ok"] else streaks.get(r["k"], 0) + 1
        want[r["id"]] = streaks[r["k"]]
    assert {r["id"]: r["streak"] for r in got.collect()} == want
    read = [n for _, n, _ in progress if n > 1]
    assert read == ([6000] * 4 if files else [24_000]) and sum(d for _, _, d in progress) == 0


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    """A batch drops rows behind the watermark up to which the batch before it has stepped."""
    import time

    for part in ([(1, i, i * 1_000_000, True) for i in range(1, 100)], [(1, 100, 100_000_000, True)], [(1, 200, 5_000_000, True), (1, 201, 95_000_000, True), (1, 202, 120_000_000, True)]):
        spark.createDataFrame(part, "k int, id bigint, us bigint, ok boolean").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    stream = spark.readStream.schema("k int, id bigint, us bigint, ok boolean").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    progress = []
    got = run_keyed(stream, ["k"], ORDER, s.health_step("ok", "us", ["id"]), "id bigint, streak bigint, health string", "10 seconds", progress=progress)
    assert sorted(r["id"] for r in got.collect()) == [*range(1, 101), 201, 202]
    assert sum(dropped for _, _, dropped in progress) == 1


def test_rows_in_order_are_not_sorted_again(monkeypatch):
    """A key's rows that come in order are stored and stepped as they are."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    from millrace.streaming.keyed import OrderedSteps
    from millrace.streaming.stateful import zscore_step

    calls = []

    class State:
        def __init__(self):
            self.held = {}

        def exists(self):
            calls.append("exists")
            return None in self.held

        def get(self):
            return self.getValue(None)

        def update(self, value):
            self.updateValue(None, value)

        def getValue(self, key):
            calls.append("get")
            return self.held.get(key)

        def updateValue(self, key, value):
            calls.append("update")
            self.held[key] = value

        def removeKey(self, key):
            calls.append("remove")
            self.held.pop(key)

    class Handle:
        getMapState = getValueState = staticmethod(lambda *names: State())
        registerTimer = staticmethod(lambda at: calls.append("timer"))

    class Timer:
        getCurrentWatermarkInMs = staticmethod(lambda: 10**13)

    columns = pa.schema([("id", pa.int64()), ("us", pa.int64()), ("value", pa.float64()), ("row_us", pa.int64())])
    rows = pd.DataFrame({"id": range(60), "us": range(60), "value": np.arange(60.0), "row_us": range(60), "row_end": False})
    work = OrderedSteps(zscore_step("value", ["id"]), ["us", "id"], columns, None, 3_600_000_000)
    work.init(Handle())
    monkeypatch.setattr(pd.DataFrame, "sort_values", None)
    assert list(work.handleInputRows((1,), iter([rows]), None)) == []
    out = pd.concat(work.handleExpiredTimer((1,), Timer(), None))
    assert out["id"].tolist() == list(range(60)) and (out["z"][:29] == 0).all() and out["z"][29] > 0
