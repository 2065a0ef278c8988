"""Ranked search, token counts and importance resampling against plain versions of their rules, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import catalog, importance, ranked_search, token_counts
from millrace.session import new_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, row bigint, item string, n int, part string, score int, digest string, n_tokens int, bucket int, slice int, rank int"
LONG = "word and other words " * 30000
ROWS = [
    (3, "The quick brown fox jumps over the lazy dog, and THEN sleeps for the whole long afternoon in the sun, quick and brown."),
    (3, "The quick brown fox jumps over the lazy dog, and THEN sleeps for the whole long afternoon in the sun, quick and brown."),
    (1, ""),
    (2, None),
    (None, "An idless text of the quick fox and the dog."),
    (4, LONG),
    (5, "äöü Äöü \U0001f600 fox"),
    (6, "x" * 300_000),
    (7, " \n\t.,;"),
    (8, "a quick fox"), (9, "a quick fox"), (-1, "a quick fox"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, *[None] * 10) for i, t in ROWS], SCHEMA)


# -- ranked search ---------------------------------------------------------------------


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    held = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    n_docs = sum(bool(c) for _, c in held)
    length = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, counts in held:
            m = 75 + 25 * sum(counts.values()) * n_docs // length if counts else 75
            score = 0
            for t in plain_terms(text):
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("entries,tile", [(500_000, (64, 4096, 1024)), (7, (2, 3, 4))])
def test_search_by_brute_force(spark, docs, monkeypatch, entries, tile):
    """Also with parts and tiles so small that every item is cut."""
    for name, value in zip(("ITEMS", "COLUMNS", "DOCS"), tile):
        monkeypatch.setattr(ranked_search, name, value)
    items = [("a", "quick fox the dog dog"), ("b", "nothing here zzz"), ("c", None), ("d", ""), (None, "Äöü FOX"), ("e", "quick " * 50 + LONG[:2000])]
    df = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, row int")
    assert rows_of(ranked_search.search(docs, df, k=4, entries=entries)) == plain_search(ROWS, items, 4)


def test_search_of_the_table_by_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows_of(catalog.QUERIES["op11_ranked_search"](spark, SF)) == plain_search(docs, items, 20)


def test_search_without_rows(spark, docs):
    items = spark.createDataFrame([(1, "quick fox"), (1, "quick fox"), (1, "dog")], "item_id int, text string")
    assert ranked_search.search(docs.limit(0), items).collect() == []
    empty = ranked_search.search(docs, items.limit(0))
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]
    # equal rows count once, another text of the same id is ranked by itself
    ranks = [r["rank"] for r in ranked_search.search(docs, items, k=2).collect()]
    assert sorted(ranks) == [1, 1, 2, 2]


def test_weights_beyond_one_digit_are_exact():
    """Items that repeat a term so often that a plain product would pass 2^53."""
    rng = np.random.default_rng(3)
    times = [[int(x) for x in rng.integers(1, 1 << 40, 6)] for _ in range(3)]
    weight = rng.integers(0, 20_000, 6)
    tiles = ranked_search.Tiles([10, 11, 12], [list(range(6))] * 3, times, weight)
    term, doc = np.tile(np.arange(6), 5), np.repeat(np.arange(5), 6)
    impact = rng.integers(0, 1_000_000, 30)
    got = np.concatenate([s for _, s in tiles.scores(term, doc, impact, 5)])
    dense = impact.reshape(5, 6)
    mod = 1 << 64  # sums of 64-bit whole numbers, wherever they end
    want = [[sum(times[i][t] * int(weight[t]) * int(dense[d, t]) for t in range(6)) % mod for d in range(5)] for i in range(3)]
    assert [[int(x) % mod for x in row] for row in got] == want


# -- token counts ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def plain_counts(model, rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    return sorted(((i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in rows), key=str)


def test_counts_by_brute_force(spark, docs, model):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = catalog.QUERIES["op12_token_counts"](spark, SF).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == plain_counts(model, rows)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    special = [(1, "a <s> b </s> <unk>"), (2, "a▁b"), (3, "a b"), (4, "▁"), (5, " "), (6, "\x00 x　y")]
    df = spark.createDataFrame(special, "doc_id int, text string")
    got = token_counts.count_tokens(df, model).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == plain_counts(model, special)


@pytest.mark.parametrize("few", [0, 50_000])
def test_counts_of_odd_rows(docs, model, few):
    got = token_counts.count_tokens(docs, model, few=few).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == plain_counts(model, ROWS)
    assert token_counts.count_tokens(docs.limit(0), model).collect() == []


def test_forms_that_share_a_digest_count_alike(model):
    import sentencepiece

    sp, rng = sentencepiece.SentencePieceProcessor(model_file=model), random.Random(5)
    for _ in range(5000):
        text = "".join(rng.choice("ab ▁é\n\t中.<") for _ in range(rng.randrange(14)))
        assert len(sp.encode(text)) == len(sp.encode(text.replace("▁", " ")))


def test_cache_is_used_and_appended(spark, model, monkeypatch):
    cache, encoded = new_path(spark, "cache"), []
    plain = token_counts.encode_counts

    def watched(texts, file):
        encoded.append(sorted(r.text for r in texts.collect()))
        return plain(texts, file)

    monkeypatch.setattr(token_counts, "encode_counts", watched)
    first = [(1, "one two"), (2, "one two"), (3, "three"), (4, None), (5, "one▁two")]
    second = [(1, "one two"), (6, "four"), (7, "four"), (8, "three")]
    for rows in (first, second, second):
        df = spark.createDataFrame(rows, "doc_id int, text string")
        got = token_counts.count_tokens(df, model, cache=cache).collect()
        assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == plain_counts(model, rows)
    assert encoded[0] in (["", "one two", "three"], ["", "one▁two", "three"]) and encoded[1:] == [["four"], []]
    # a digest stored twice by runs side by side counts once; another version is not used
    held = spark.read.parquet(cache)
    assert held.count() == 4
    twice = held.limit(1).withColumn("tokenizer", held.tokenizer)
    twice.write.mode("append").partitionBy("tokenizer").parquet(cache)
    other = held.selectExpr("digest", "n_tokens + 7 as n_tokens", "'other' as tokenizer")
    other.write.mode("append").partitionBy("tokenizer").parquet(cache)
    got = token_counts.count_tokens(spark.createDataFrame(second, "doc_id int, text string"), model, cache=cache).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == plain_counts(model, second)


# -- importance resampling -------------------------------------------------------------------


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_buckets(text, most, buckets):
    words = plain_words(text)
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, most=1, buckets=10_000, least=20, percent=10, seed=2024):
    found = [(doc_id, len(plain_words(text)), plain_buckets(text, most, buckets)) for doc_id, text in docs]
    s = Counter(b for _, _, f in found for b in f)
    t = Counter(b for text in target for b in plain_buckets(text, most, buckets))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in s}
    rows = []
    for doc_id, n, f in found:
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    out = []
    for place, r in enumerate(order):
        out.append((r[0], *r[2:], place + 1 if place < percent * len(order) // 100 else None))
    out += [(r[0], *r[2:], None) for r in rows if r[1] < least]
    return sorted(out, key=str)


def resampled(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_checksums_of_runs():
    rng = random.Random(2)
    for most in (1, 2, 3, 5):
        words = ["".join(rng.choice("ab9é中") for _ in range(rng.choice((1, 2, 5, 40, 300)))).encode() for _ in range(60)]
        want = [zlib.crc32(b" ".join(words[i : i + n])) for n in range(1, most + 1) for i in range(len(words) - n + 1)]
        assert importance.gram_checksums(words, most).tolist() == want
    assert importance.gram_checksums([], 3).tolist() == []
    assert importance.gram_checksums([b"a" * 1_000_000, b"b"], 5).tolist()[2:] == [zlib.crc32(b"a" * 1_000_000 + b" b")]


def test_resampling_of_the_table_by_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert resampled(catalog.QUERIES["op13_importance_resampling"](spark, SF)) == plain_resample(docs, target)


@pytest.mark.parametrize("options", [{}, {"most": 3, "buckets": 70_000, "least_words": 1, "percent": 50, "seed": 5}, {"buckets": 7, "least_words": 0, "percent": 100}])
def test_resampling_of_odd_rows(spark, docs, options):
    target = [("the quick dog", 1), (None, 2), ("", 3)]
    aims = spark.createDataFrame(target, "text string, _none int")
    plain = {{"least_words": "least"}.get(k, k): v for k, v in options.items()}
    assert resampled(importance.resample(docs, aims, **options)) == plain_resample(ROWS, [t for t, _ in target], **plain)
    none = importance.resample(docs.limit(0), aims.limit(0), **options)
    assert none.collect() == [] and none.columns == ["doc_id", "n_features", "weight", "score", "rank"]
