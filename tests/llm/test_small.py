"""Edge cases of all operators: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import numpy as np
import pytest

from millrace.llm import html_text, mixing, packing, pii, quality, repeats, secret_scans, simhash, toxicity, winnowing
from millrace.llm.catalog import tokenizer_files

SCHEMA = "doc_id bigint, text string, source string, fp string, key string, value int, batch string, row int, label int"
LONG = "word and other words " * 30000
ROWS = [
    (3, "The quick brown fox jumps over the lazy dog and then sleeps for the whole long afternoon.", "b", "x", "k", 1, "q", 1, 1),
    (3, "The quick brown fox jumps over the lazy dog and then sleeps for the whole long afternoon.", "b", "x", "k", 1, "q", 1, 1),
    (1, "", "a", None, None, None, None, None, None),
    (2, None, None, None, None, None, None, None, None),
    (None, "An idless text with a card 4539 1488 0343 6467 in it.", "a", None, None, None, None, None, None),
    (4, LONG, "a", None, None, None, None, None, None),
    (5, "äöü \U0001f600", "c", None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def flat_model():
    return toxicity.ToxicityModel(np.zeros(1 << toxicity.BITS, np.float32), -1.0)


def secrets_model():
    leaf = (np.array([-1]), np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([1.0]))
    return secret_scans.SecretModel([leaf], frozenset())


OPERATORS = {
    "pii": lambda df: pii.pseudonymise(df, "k"),
    "quality": lambda df: quality.judge(df, quality.QualityModel(np.zeros(1 << quality.BITS, np.float32), 3.0)),
    "toxicity": lambda df: toxicity.score(df, flat_model()),
    "toxicity_reject": lambda df: toxicity.reject(df, flat_model()),
    "secrets": lambda df: secret_scans.scan(df, secrets_model()),
    "redact": lambda df: secret_scans.redact(df, secrets_model()),
    "winnowing": winnowing.fingerprints,
    "winnowing_next": winnowing.compare_with_next,
    "mixing": mixing.mix,
    "simhash": simhash.near_duplicates,
    "packing": lambda df: packing.pack(df, tokenizer_files()).where("start = 0"),
    "repeats": repeats.deduplicate,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_comes_back(docs, none, name):
    got = [r["doc_id"] for r in OPERATORS[name](docs).collect()]
    assert sorted(got, key=str) == sorted([r[0] for r in ROWS], key=str)
    empty = OPERATORS[name](none)
    assert empty.collect() == [] and "doc_id" in empty.columns


@pytest.mark.parametrize("name", ["toxicity_reject", "redact"])
def test_filters_keep_all_columns(docs, name):
    assert OPERATORS[name](docs).columns == docs.columns


def test_keep_one(spark, docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # the empty and the null text are one group, the repeated rows another
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "None"]
    assert simhash.keep_one(none).collect() == []


def test_mixed(docs, none):
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and mixing.mixed(none).collect() == []
    assert max(out.groupBy("doc_id", "text").count().toPandas()["count"]) <= 4


def test_pages(spark):
    rows = [
        (1, "http://h/a/1", "<p>menu</p><article><p>One &amp; two</p></article>", "x"),
        (1, "http://h/a/1", "<p>menu</p><article><p>One &amp; two</p></article>", "x"),
        (2, None, "<p>no url", "x"),
        (None, "http://h/a/2", None, "x"),
        (3, "not a url", "", "x"),
        (4, "http://h/a/3", "<div>line</div>" * 3000, "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, page string")
    got = sorted(((r.page_id, r.text) for r in html_text.extract(pages).collect()), key=str)
    want = [(1, "One & two")] * 2 + [(2, "no url"), (3, ""), (4, "\n\n".join(["line"] * 3000)), (None, "")]
    assert got == want
    assert html_text.extract(pages.limit(0)).collect() == []


def test_training_without_rows(docs, none):
    assert toxicity.train(docs, none, label_col="label").bias == 0.0
    assert quality.train(docs, none, label_col="label").probability(np.zeros(0, int), np.zeros(0)) > 0.9
    assert secret_scans.train_on(none).probability(np.zeros((1, len(secret_scans.FEATURES)))) == [0.0]
