"""Known answers."""

import math
import random
import unicodedata
import weakref

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.functions import text as t
from millrace.functions import values as val
from millrace.operators import aggregates as a
from millrace.operators import chunking as c
from millrace.operators import drift as d
from millrace.operators import experiments as e
from millrace.operators import features as fe
from millrace.operators import filters as f
from millrace.operators import joins as j
from millrace.operators import retrieval as r
from millrace.operators import sets as s
from millrace.operators import timeseries as ts
from millrace.operators import windows as w
from millrace.sources import scans, sinks


def one(df, *cols):
    return tuple(df.select(*cols).first()) if cols else tuple(df.first())


def test_battery_rule(spark):
    frame = spark.createDataFrame([(1, 10.0)], "id int, battery_pct double")
    hits = {r["rule"]: (r["priority"], r["score"]) for r in f.rule_events(frame).collect()}
    assert hits == {"battery_critical": (0, 50.0), "battery_low": (1, 35.0)}


def test_normal_frame_has_no_event(spark):
    frame = spark.createDataFrame([(80.0, 2.0, None)], "battery_pct double, motor_current_A double, nav_stuck boolean")
    assert f.rule_events(frame).count() == 0


def test_rules_from_yaml():
    rules = f.rules_from_yaml("rules:\n  - {id: x, trigger: telemetry.cpu_temp_C > 70, promote_to: p1}\n")
    assert (rules[0].trigger, rules[0].promote_to, rules[0].pre_sec, rules[0].post_sec) == ("cpu_temp_C > 70", 1, 10.0, 5.0)


@pytest.mark.parametrize("hot", [10**9, 10])
def test_zscore_spike_and_warm_up(spark, hot):
    rows = [(1, i, 50.0 + (i % 3) * 0.1) for i in range(35)] + [(1, 35, 200.0)]
    df = spark.createDataFrame(rows, "k int, i int, v double")
    z = {r["i"]: r for r in w.rolling_zscore(df, ["k"], ["i"], "v", hot_rows=hot).collect()}
    assert z[35]["z"] > 3 and z[35]["is_anomaly"]
    assert all(z[i]["z"] == 0.0 for i in range(29))


def test_zscore_hot_key_matches_plain(spark):
    rng = random.Random(1)
    rows = [(1 if i % 3 else i % 20, i, None if i % 17 == 0 else rng.gauss(0, 1)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, i int, v double")
    get = lambda hot: {r["i"]: round(r["z"], 9) for r in w.rolling_zscore(df, ["k"], ["i"], "v", size=60, hot_rows=hot).collect()}
    plain = get(10**9)
    assert plain == get(200) and len(plain) == 3000


def test_score_to_priority(spark):
    df = spark.createDataFrame([(95,), (70,), (40,), (10,)], "s int")
    assert [r[0] for r in df.orderBy(F.desc("s")).select(f.priority_of_score(F.col("s"))).collect()] == [0, 1, 2, 3]


def test_counter_upsert_adds(spark):
    make = lambda n: spark.createDataFrame([("d", n)], "day string, bytes int")
    assert one(sinks.add_counters(make(1024), make(2048), ["day"], ["bytes"]), "bytes") == (3072,)


def test_clean_data_scores_high(spark):
    df = spark.range(100).select("id", F.lit("x").alias("c"))
    row = a.quality_score(df, ["id", "c"], True).first()
    assert row["score"] > 0.9 and row["valid"]


def test_nulls_and_repeats_lower_the_score(spark):
    rows = [(None if i < 101 else float(i), i % 1000 if i < 1000 else i - 1000) for i in range(1050)]
    df = spark.createDataFrame([(r[0], r[1], *[1] * 14) for r in rows], ", ".join(["a double", "b int", *[f"c{i} int" for i in range(14)]]))
    out = a.quality_score(df, df.columns, True).first()
    assert out["rows"] == 1050 and 0.9 < out["score"] < 1.0


def test_range_bins_and_modes(spark):
    df = spark.createDataFrame([(0,), (12,), (13,), (72,), (73,)], "v int")
    got = [r[0] for r in df.orderBy("v").select(fe.fixed_bins(F.col("v"), [0, 12, 24, 48, 72])).collect()]
    assert got == ["nan", "(0, 12]", "(12, 24]", "(48, 72]", "nan"]
    modes = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "m string")
    assert fe.smallest_mode(modes, "m").first()[0] == "a"


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r[0] for r in fe.scale(df, ["x"], fe.fit_scaler(df, ["x"])).collect()] == [0.0, 0.0]


def test_hash_modulus(spark):
    import hashlib

    words = ["a", "user-17", "", "ü"]
    df = spark.createDataFrame([(x,) for x in words], "u string")
    got = {r["u"]: r["m"] for r in df.select("u", val.hex_modulus(F.md5("u"), 10000).alias("m")).collect()}
    assert got == {x: int(hashlib.md5(x.encode()).hexdigest(), 16) % 10000 for x in words}


def test_variant_shares_are_checked(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        w.assign_variant(df, F.col("id"), [("a", 100.0)])
    with pytest.raises(ValueError):
        w.assign_variant(df, F.col("id"), [("a", 50.0), ("b", 40.0)])


def test_text_functions(spark):
    df = spark.createDataFrame([("I DON'T know, it's password=x1 http://a.b/c?d x@y.z",)], "s string")
    run = lambda c: df.select(c).first()[0]
    assert run(t.expand_contractions(F.col("s"))).startswith("I do not know, it is password")
    assert run(t.redact_secrets(F.col("s"))).count("[REDACTED]") == 1
    assert run(t.clean_text(F.col("s"))) == "I DON'T know, it's password=x1"
    assert run(t.nfkc(F.lit("ﬁ①"))) == "fi1" and run(t.remove_accents(F.lit("éñ"))) == "en"
    assert run(t.mask_connection(F.lit("db://u:p@h"))) == "db:***@h"


def brute_chunks(text, size, overlap):
    """Slow statement of the chunk rule, window by window."""
    import re

    out, start, last = [], 0, None
    while start < len(text):
        end = start + size
        if end < len(text):
            lo = max(end - 100, start)
            hits = [m.end() for m in re.finditer(r"[.!?]\s+", text[lo:end], re.ASCII)]
            end = lo + hits[-1] if hits else end
        piece = text[start:end].strip(" \t\n\r\x0b\x0c")
        if piece:
            out.append((len(out), piece, start, end))
            last = start
        start = end - overlap if last is None or end - overlap > last else end
    return out


def test_chunks_match_the_rule():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice("abc .!?\n  ") for _ in range(rng.randrange(1, 1500)))
        assert list(c.sentence_aware_chunks(text, 120, 20)) == brute_chunks(text, 120, 20)
    with pytest.raises(ValueError):
        list(c.sentence_aware_chunks("x", 10, 10))


def test_mail_names_go_with_their_run_of_characters(spark):
    import re
    import time

    draw = random.Random(5)
    rows = ["".join(draw.choice("@@ab. \n") for _ in range(draw.randrange(12))) for _ in range(300)]
    got = spark.createDataFrame([(x,) for x in rows], "x string").select("x", t.remove_emails(F.col("x")).alias("y")).collect()
    assert all(r_["y"] == re.sub(r"\S+@\S+", "", r_["x"]) for r_ in got)
    start = time.perf_counter()
    long = spark.range(1).select(t.remove_emails(F.repeat(F.lit("ab."), 400_000)).alias("y"))
    assert long.select(F.length("y")).first()[0] == 1_200_000 and time.perf_counter() - start < 20


def test_chunks_of_rows_with_one_id_keep_their_metadata(spark):
    rows = spark.createDataFrame([(1, "one text", "a"), (1, "another text", "b"), (2, None, "c"), (2, "", "d")], "id bigint, text string, lang string")
    out = c.corpus_chunks(rows, "id", "text", F.length, F.create_map(F.lit("lang"), F.col("lang"))).collect()
    assert sorted((x["id"], x["text"], x["metadata"]["lang"]) for x in out) == [("1_chunk_0", "another text", "b"), ("1_chunk_0", "one text", "a")]


def test_empty_text_has_no_chunks(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "One. Two.")], "id int, text string")
    assert [r["id"] for r in c.fixed_chunks(docs, "id", "text").collect()] == [3]
    assert [r["text"] for r in c.sentence_chunks(docs, "id", "text", 1).orderBy("chunk_id").collect()] == ["One.", "Two."]


def test_html_and_markdown(spark):
    body, title = scans.page_text("<html><title>T &amp; U</title><script>x()</script><p>a<b>b</b></p></html>")
    assert title == "T & U" and body.split("\n") == ["T & U", "a", "b"]
    df = spark.createDataFrame([("x\n# Head\n# No",), ("plain",)], "s string")
    assert sorted(r[0] for r in df.select(scans.markdown_title(F.col("s"), F.lit("f"))).collect()) == ["Head", "f"]


def test_directory_loader(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes(b"caf\xc3\xa9 \xff!")
    (tmp_path / "sub" / "b.MD").write_text("# Title\nbody")
    (tmp_path / "c.html").write_text("<title>t</title><p>x</p>")
    (tmp_path / "d.csv").write_text("k,v\n1,2\n3,4\n")
    (tmp_path / "e.json").write_text('[{"text": "hi", "n": 1}, 5]')
    (tmp_path / "bad.json").write_text("{oops")
    (tmp_path / "skip.log").write_text("x")
    (tmp_path / "private.txt").write_text("x")
    docs = {r["doc_id"]: r for r in scans.load_directory(spark, str(tmp_path), exclude=["private"]).collect()}
    assert set(docs) == {"a", "b", "c", "d_0", "d_1", "e_0", "e_1", "bad"}
    assert docs["a"]["text"] == "café !" and docs["b"]["metadata"]["title"] == "Title"
    assert docs["d_1"]["text"] == "k: 3 | v: 4" and docs["e_0"]["metadata"]["n"] == "1"
    assert docs["bad"]["text"] is None and docs["bad"]["error"].startswith("JSONDecodeError")


def test_sidecar_is_empty_when_absent(spark, tmp_path):
    assert sinks.read_sidecar(spark, str(tmp_path / "nothing")).count() == 0


def test_fuzzy_dedup_blocks(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        if i % 3 == 0 or not rows:
            v = [rng.gauss(0, 1) for _ in range(6)]
        else:
            v = [x + rng.gauss(0, 0.15) for x in rng.choice(rows)[1]]
        rows.append((i, v))
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    kept = []
    for i, v in rows:
        if all(cos(v, rows[k][1]) < 0.95 for k in kept):
            kept.append(i)
    df = spark.createDataFrame(rows, "id int, v array<double>")
    for block in (7, 1000):
        got = sorted(r["id"] for r in s.fuzzy_dedup(df, "id", "v", 0.95, block).where("kept").collect())
        assert got == kept


def test_top_k_blocks_and_ties(spark):
    df = spark.createDataFrame([(i, [1.0, float(i % 4)]) for i in range(40)], "id bigint, v array<double>")
    q = spark.createDataFrame([(n, [1.0, float(n)]) for n in range(5)], "q bigint, qv array<double>")
    get = lambda block: sorted(map(tuple, r.top_k(df.repartition(3), q, "id", "v", "q", "qv", 3, block).select("q", "id", "rank").collect()))
    assert get(2) == get(100)
    assert [x for x in get(100) if x[0] == 1] == [(1, 1, 1), (1, 5, 2), (1, 9, 3)]


def test_context_stops_at_first_overflow(spark):
    hits = [(1, 0.9, 1, "a" * 1900), (1, 0.8, 2, "b" * 500), (1, 0.7, 3, "c" * 10), (2, 0.9, 1, "d" * 2000), (2, 0.8, 2, "e" * 100)]
    df = spark.createDataFrame(hits, "q int, score double, rank int, t string")
    got = {x["q"]: x["context"] for x in r.pack_context(df, "q", "t").collect()}
    assert got == {1: "a" * 1900 + "\n\n" + "b" * 148 + "...", 2: "d" * 2000}


@pytest.mark.parametrize("hot", [10**9, 40])
def test_promotion_matches_all_pairs(spark, hot):
    rng = random.Random(7)
    files = [(rng.choice([1, 1, 2]), i, rng.randrange(1000), rng.randrange(4)) for i in range(150)]
    events = [(rng.choice([1, 1, 2]), i, rng.randrange(1000), rng.randrange(30), rng.randrange(20), rng.randrange(3)) for i in range(80)]
    want = set()
    for k, i, at, p in files:
        hit = [ev[5] for ev in events if ev[0] == k and ev[2] - ev[3] <= at <= ev[2] + ev[4] and ev[5] < p]
        if hit:
            want.add((i, min(hit)))
    fd = spark.createDataFrame(files, "k int, file_id bigint, at bigint, priority int")
    ed = spark.createDataFrame(events, "k int, event_id bigint, at bigint, pre bigint, post bigint, priority int")
    got = {(x["file_id"], x["new_priority"]) for x in j.promote_in_windows(fd, ed, "k", hot).collect()}
    assert got == want


def test_unknown_strategy_fails(spark):
    src = spark.createDataFrame([("k", "e1")], "key string, etag string")
    dst = spark.createDataFrame([("k", "e2")], "key string, etag string")
    bad = spark.createDataFrame([("k", "coin_toss")], "key string, strategy string")
    with pytest.raises(Exception, match="unknown strategy"):
        j.resolve_conflicts(src, dst, bad).collect()


@pytest.mark.parametrize("hot", [10**9, 20])
def test_rank_statistics_in_slices(spark, hot):
    rng = random.Random(11)
    rows = [(round(rng.random(), 2), rng.randrange(2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos, neg = [x for x, y in rows if y], [x for x, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert a.roc_auc(df, "s", "y", hot).first()["auc"] == pytest.approx(wins / len(pos) / len(neg))
    ks = d.ks_statistic(df.where("y = 1").select("s"), df.where("y = 0").select("s"), ["s"], hot).first()["statistic"]
    grid = sorted({x for x, _ in rows})
    share = lambda v, x: sum(i <= x for i in v) / len(v)
    assert ks == pytest.approx(max(abs(share(pos, x) - share(neg, x)) for x in grid))


def test_empty_sides_give_no_drift(spark):
    some = spark.createDataFrame([(1.0,)], "x double")
    row = d.ks_statistic(some, some.where("x > 5"), ["x"]).first()
    assert row["statistic"] == 0.0


def test_tail_probabilities(spark):
    rows = [("a", True)] * 80 + [("a", False)] * 20 + [("b", True)] * 60 + [("b", False)] * 40
    df = spark.createDataFrame(rows, "variant string, success boolean")
    out = e.proportion_test(df, "variant", "a", "b").first()
    assert out["z"] == pytest.approx(3.0861, abs=1e-4) and out["p_value"] == pytest.approx(0.002028, abs=1e-5) and out["winner"] == "a"
    flat = spark.createDataFrame([("a", True), ("b", True)], "variant string, success boolean")
    assert e.proportion_test(flat, "variant", "a", "b").first()["has_winner"] is False
    vals = spark.createDataFrame([("a", float(x)) for x in (1, 2, 3, 4, 5)] + [("b", float(x)) for x in (2, 3, 4, 5, 9)], "variant string, v double")
    t_row = e.mean_test(vals, "variant", "v", "a", "b").first()
    # means 3 and 4.6, variances 2.5 and 7.3; the tail has a closed form for an even number of degrees
    angle = math.atan(1.6 / 1.4 / math.sqrt(8))
    c2 = math.cos(angle) ** 2
    p = 1 - math.sin(angle) * (1 + c2 / 2 + 3 / 8 * c2**2 + 15 / 48 * c2**3)
    assert t_row["t"] == pytest.approx(-1.6 / 1.4) and t_row["p_value"] == pytest.approx(p, abs=1e-9)


def test_histogram_quantile_top_bucket(spark):
    df = spark.createDataFrame([("x", v) for v in (0.2, 0.4, 50.0, 60.0)], "g string, v double")
    b = ts.cumulative_buckets(df, ["g"], "v", [0.25, 0.5, 1.0])
    assert one(ts.histogram_quantile(b, ["g"], 0.99), "quantile") == (1.0,)
    assert one(ts.histogram_quantile(b, ["g"], 0.5), "quantile") == (0.5,)


def test_reset_adds_the_new_value(spark):
    df = spark.createDataFrame([("s", 1, 10.0), ("s", 2, 15.0), ("s", 3, 4.0)], "s string, ts bigint, value double")
    assert [r["increase"] for r in ts.increments(df, ["s"], ["ts"]).orderBy("ts").collect()] == [0.0, 5.0, 4.0]


def test_lossless_layout_for_nulls_in_keys(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), (1, 1, 5.0)], "k int, i int, v double")
    out = w.rolling_zscore(df, ["k"], ["i"], "v", warm_up=2).collect()
    assert len(out) == 3 and {r["k"]: r["z"] for r in out if r["i"] == 2}[None] > 0


def test_frames_without_any_rule_column(spark):
    out = f.rule_events(spark.createDataFrame([(1,)], "speed int"))
    assert out.columns == ["speed", "rule", "priority", "score", "pre_sec", "post_sec"] and out.count() == 0


def test_slices_of_text_functions_chunks_and_files(spark, tmp_path, monkeypatch):
    """Large batches are worked on in slices: the same rows, a bounded number of them held."""
    texts = [None, "", "plain", "é é ñ ิ", "ﬁ①", "x" * (1 << 20) + "é"] * 3
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, text string").coalesce(1)
    got = {r["id"]: (r["a"], r["n"]) for r in rows.select("id", t.remove_accents("text").alias("a"), t.nfkc("text").alias("n")).collect()}
    bare = lambda x: None if x is None else "".join(k for k in unicodedata.normalize("NFD", x) if unicodedata.category(k) != "Mn")
    assert got == {i: (bare(x), None if x is None else unicodedata.normalize("NFKC", x)) for i, x in enumerate(texts)}
    # slices, not the whole batch
    assert max(map(len, t.remove_accents.func(iter([pa.array(["é" * 1000] * 10_000)])))) <= 1024
    docs = spark.createDataFrame([(1, "word. " * 400_000)], "id int, text string")
    with monkeypatch.context() as patch:
        patch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
        run = c.fixed_chunks(docs, "id", "text")
    sizes = [b.num_rows for b in run(iter(docs.toArrow().to_batches()))]
    assert max(sizes) <= c.CHUNKS_AT_ONCE < sum(sizes) == len(list(c.sentence_aware_chunks("word. " * 400_000)))
    (tmp_path / "many.csv").write_text("k,text\n" + "".join(f"{i},t{i}\n" for i in range(3000)))
    (tmp_path / "late.csv").write_text("k,v\n" + "".join(f"{i},t{i}\n" for i in range(3000)) + "x," + "y" * 200_000 + "\n")
    (tmp_path / "odd.txt").write_bytes(b"a\xef\xbf\xbdb\xffc\r\n")
    (tmp_path / "UP.TXT").write_bytes("ä".encode())
    docs = scans.load_directory(spark, str(tmp_path)).collect()
    many = {r["doc_id"]: r["text"] for r in docs if r["path"].endswith("many.csv")}
    assert many == {f"many_{i}": f"t{i}" for i in range(3000)}
    late = [r for r in docs if r["path"].endswith("late.csv")]
    assert len(late) == 1 and late[0]["doc_id"] == "late" and late[0]["text"] is None and late[0]["error"].startswith("Error")
    plain = {r["doc_id"]: (r["text"], r["metadata"]["file_type"], r["error"]) for r in docs if r["path"].lower().endswith("txt")}
    assert plain == {"odd": ("a�bc\r\n", "txt", None), "UP": ("ä", "txt", None)}
    # a task holds a bounded number of a file's documents
    def counted(text):
        live = weakref.WeakSet()

        class Text(str):
            pass

        for i in range(20_000):
            live.add(one := Text(i))
            assert len(live) < 5000
            yield str(i), one, {}

    found = scans.load_directory(spark, str(tmp_path), glob="many.csv", loaders={".csv": counted})
    assert found.where("error is null").count() == 20_000
