"""Model queries: document features against the quality label."""

from pyspark.sql import functions as F

from millrace.catalog import views as v
from millrace.catalog.registry import query, r4, table, texts
from millrace.functions.text import text_metadata
from millrace.operators import models as m
from millrace.operators import topk
from millrace.operators.features import stratified_split
from millrace.session import materialise

FEATURES = ["chars", "words", "lines", "sentences", "english", "toxic"]


def featured(spark, sf):
    meta = text_metadata(F.col("text"))
    docs = texts(spark, sf).select(
        "doc_id", meta["char_count"].alias("chars"), meta["word_count"].alias("words"), meta["line_count"].alias("lines"),
        meta["sentence_count"].alias("sentences"), F.coalesce(meta["likely_english"], F.lit(False)).cast("int").alias("english"),
    )
    rows = docs.join(table(spark, sf, "labels"), "doc_id").select("doc_id", *FEATURES, "quality")
    split = stratified_split(rows, "doc_id", "quality").select("doc_id", "split")
    # training passes over the rows many times
    ready = materialise(rows.join(split, "doc_id"), "features")
    assembled = m.assemble(ready, FEATURES)
    return assembled.where("split <> 'test'"), assembled.where("split = 'test'")


@query("ml_1_train")
def _(spark, sf):
    train, test = featured(spark, sf)
    return m.train_all(train, test, "doc_id", "quality")[1]


@query("ml_2_cross_validate")
def _(spark, sf):
    return m.cross_validate(featured(spark, sf)[0], "quality", "logistic_regression")


@query("ml_3_importance")
def _(spark, sf):
    train, _ = featured(spark, sf)
    model = m.candidates("quality")["random_forest"].fit(train)
    return m.importances(spark, model, FEATURES).orderBy(F.desc("importance"), "feature")


@query("ord_7_top_features")
def _(spark, sf):
    train, _ = featured(spark, sf)
    model = m.candidates("quality")["random_forest"].fit(train)
    return topk.top_n(m.importances(spark, model, FEATURES), 15, F.desc("importance"), F.col("feature"))


@query("ml_4_batch_scores")
def _(spark, sf):
    train, test = featured(spark, sf)
    model = m.candidates("quality")["logistic_regression"].fit(train)
    return m.score(model, train.unionByName(test), "doc_id")


@query("ml_5_select_best")
def _(spark, sf):
    train, test = featured(spark, sf)
    metrics = m.train_all(train, test, "doc_id", "quality")[1]
    # fixed values: minimum of each quality measure
    return m.select_best(metrics, {"accuracy": 0.75, "precision": 0.70, "recall": 0.70, "f1": 0.70})


@query("ml_6_isolation_forest")
def _(spark, sf):
    rows = v.telemetry(spark, sf).withColumn("hour", F.hour(F.col("ts").cast("timestamp")))
    forest = m.IsolationForest().fit(rows, ["value", "k", "hour"], ["event_id"])
    return forest.score(rows, ["event_id"]).withColumns({"decision": r4("decision"), "score": r4("score")})
