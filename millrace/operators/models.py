"""Training, selection and scoring of classifiers, and an isolation forest."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.aggregates import roc_auc, safe_ratio
from millrace.plans.quantiles import exact_quantiles
from millrace.session import materialise

SEED = 42


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def candidates(label: str) -> dict[str, Estimator]:
    common = {"labelCol": label, "featuresCol": "features"}
    return {
        "logistic_regression": LogisticRegression(maxIter=1000, **common),
        "random_forest": RandomForestClassifier(seed=SEED, numTrees=100, **common),
        "gradient_boosting": GBTClassifier(seed=SEED, maxIter=20, **common),
    }


# fixed values: search space per candidate
SEARCH = {
    "logistic_regression": {"regParam": [0.1, 1.0, 10.0]},
    "random_forest": {"numTrees": [100, 200], "maxDepth": [10, 20]},
    "gradient_boosting": {"maxIter": [100, 200], "stepSize": [0.01, 0.1], "maxDepth": [3, 5]},
}


def score(model: Model, df: DataFrame, key: str) -> DataFrame:
    """Class and probability of the positive class per row."""
    out = model.transform(df)
    return out.select(key, F.col("prediction").cast("int").alias("predicted"), F.get(vector_to_array("probability"), F.lit(1)).alias("probability"))


def evaluate(model: Model, df: DataFrame, key: str, label: str) -> DataFrame:
    """One row of accuracy, precision, recall, f1 and auc."""
    rows = score(model, df, key).join(df.select(key, F.col(label).alias("truth")), key)
    hit = (F.col("predicted") == 1) & (F.col("truth") == 1)
    counts = rows.agg(
        F.avg((F.col("predicted") == F.col("truth")).cast("int")).alias("accuracy"),
        safe_ratio(F.count_if(hit), F.count_if(F.col("predicted") == 1)).alias("precision"),
        safe_ratio(F.count_if(hit), F.count_if(F.col("truth") == 1)).alias("recall"),
    )
    f1 = safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    auc = roc_auc(rows, "probability", "truth").select("auc").scalar()
    return counts.select("accuracy", "precision", "recall", f1.alias("f1"), auc.alias("auc"))


def train_all(train: DataFrame, test: DataFrame, key: str, label: str) -> tuple[dict[str, Model], DataFrame]:
    """Fitted candidates and their metrics on ``test``."""
    models, rows = {}, None
    for name, estimator in candidates(label).items():
        models[name] = estimator.fit(train)
        row = evaluate(models[name], test, key, label).withColumn("model", F.lit(name))
        rows = row if rows is None else rows.unionByName(row)
    return models, rows.select("model", "accuracy", "precision", "recall", "f1", "auc")


def cross_validate(train: DataFrame, label: str, name: str, tries: int = 10, folds: int = 5, parallelism: int = 4) -> DataFrame:
    """f1 mean and deviation over the folds for a random draw from the search space."""
    estimator = candidates(label)[name]
    builder = ParamGridBuilder()
    for param, values in SEARCH[name].items():
        builder = builder.addGrid(estimator.getParam(param), values)
    grid = builder.build()
    picked = np.random.default_rng(SEED).permutation(len(grid))[:tries]
    grid = [grid[i] for i in sorted(picked)]
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
    fitted = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=SEED, parallelism=parallelism
    ).fit(train)
    rows = [
        (name, ",".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), float(a), float(s))
        for m, a, s in zip(grid, fitted.avgMetrics, fitted.stdMetrics)
    ]
    return train.sparkSession.createDataFrame(rows, "model string, params string, f1_mean double, f1_std double")


def importances(spark, model: Model, features: Sequence[str]) -> DataFrame:
    values = model.featureImportances.toArray() if hasattr(model, "featureImportances") else np.abs(model.coefficients.toArray())
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def select_best(metrics: DataFrame, minimums: dict[str, float]) -> DataFrame:
    """Highest f1 (first by name on a tie) and the stage it may enter."""
    best = metrics.agg(F.min_by(F.struct(*metrics.columns), F.struct(-F.col("f1"), F.col("model"))).alias("b")).select("b.*")
    passes = F.lit(True)
    for name, least in minimums.items():
        passes = passes & (F.col(name) >= least)
    return best.withColumn("stage", F.when(passes, "Staging").otherwise("None"))


# -- isolation forest -----------------------------------------------------------------


def _path_norm(n: float) -> float:
    """Mean depth of an unsuccessful search in a tree of n points."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (feature, threshold, left, right, depth value); feature -1 marks a leaf."""
    nodes, todo = [None], [(0, points, 0)]
    while todo:
        at, rows, depth = todo.pop()
        spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
        if depth >= limit or len(spread) == 0:
            nodes[at] = (-1, 0.0, 0, 0, depth + _path_norm(len(rows)))
            continue
        feature = int(rng.choice(spread))
        cut = float(rng.uniform(rows[:, feature].min(), rows[:, feature].max()))
        left = rows[:, feature] < cut
        nodes += [None, None]
        nodes[at] = (feature, cut, len(nodes) - 2, len(nodes) - 1, 0.0)
        todo += [(len(nodes) - 2, rows[left], depth + 1), (len(nodes) - 1, rows[~left], depth + 1)]
    return nodes


@dataclass
class IsolationForest:
    """Trees grown by Spark tasks, each on a sample of its own of all rows; scoring is vectorised.

    A tree's sample is the ``samples`` rows with the smallest hash of seed, tree
    and key. The model has at most ``trees * (2 * samples)`` nodes, so it travels
    with the tasks. Scores below ``offset`` are the ``contamination`` share of
    all rows.
    """

    trees: int = 50
    samples: int = 256
    contamination: float = 0.01
    seed: int = SEED

    def fit(self, df: DataFrame, features: Sequence[str], order: Sequence[str]) -> "IsolationForest":
        self.features = list(features)
        point = F.array(*[F.col(f).cast("double") for f in features])
        rows = df.select(point.alias("x"), F.xxhash64(F.lit(self.seed), *order).alias("h"))
        trees, samples = self.trees, self.samples
        mixed = np.random.default_rng(self.seed).integers(0, 1 << 62, trees, np.uint64) * np.uint64(2) + np.uint64(1)

        def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """The rows of a task that can be in a sample."""
            best: list[tuple[np.ndarray, list]] = [(np.zeros(0, np.uint64), [])] * trees
            for b in batches:
                h, x = b["h"].to_numpy().view(np.uint64), b["x"].tolist()
                for t in range(trees):
                    turned = (h ^ (h >> np.uint64(31))) * mixed[t]
                    turned ^= turned >> np.uint64(29)
                    ranks, held = np.concatenate([best[t][0], turned]), len(best[t][1])
                    keep = np.argsort(ranks, kind="stable")[:samples]
                    best[t] = ranks[keep], [best[t][1][i] if i < held else x[i - held] for i in keep.tolist()]
            for t, (ranks, x) in enumerate(best):
                if len(x):
                    yield pd.DataFrame({"tree": t, "rank": (ranks >> np.uint64(1)).astype(np.int64), "x": x})

        rank = Window.partitionBy("tree").orderBy("rank", "x")
        chosen = rows.mapInPandas(least, "tree int, rank bigint, x array<double>")
        chosen = chosen.withColumn("n", F.row_number().over(rank)).where(F.col("n") <= samples)
        seed = self.seed

        def grow(b: pd.DataFrame) -> pd.DataFrame:
            tree = int(b["tree"].iloc[0])
            points = np.array(b.sort_values("n")["x"].tolist())
            nodes = _grow(points, np.random.default_rng([seed, tree]), math.ceil(math.log2(max(len(points), 2))))
            out = pd.DataFrame(nodes, columns=["feature", "cut", "lo", "hi", "depth"])
            return out.assign(tree=tree, node=range(len(nodes)), size=len(points))

        schema = "feature int, cut double, lo int, hi int, depth double, tree int, node int, size int"
        table = chosen.groupBy("tree").applyInPandas(grow, schema).toPandas().sort_values(["tree", "node"])
        self.forest = [g[["feature", "cut", "lo", "hi", "depth"]].to_numpy() for _, g in table.groupby("tree")]
        self.norm = _path_norm(int(table["size"].max()))
        self.offset = 0.0
        raw = materialise(self.score(df, list(order)).select("decision"), "raw_scores")
        self.offset = float(exact_quantiles(raw, [], "decision", {"q": self.contamination}).first()["q"])
        return self

    def _raw(self, x: np.ndarray) -> np.ndarray:
        """Negated anomaly score of every row."""
        total = np.zeros(len(x))
        for nodes in self.forest:
            at = np.zeros(len(x), int)
            while True:
                feature = nodes[at, 0].astype(int)
                inner = np.flatnonzero(feature >= 0)
                if len(inner) == 0:
                    break
                n = at[inner]
                low = x[inner, feature[inner]] < nodes[n, 1]
                at[inner] = np.where(low, nodes[n, 2], nodes[n, 3]).astype(int)
            total += nodes[at, 4]
        return -np.exp2(-total / (len(self.forest) * self.norm))

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """decision, is_anomaly (decision < -0.1), score 0..100, priority."""
        features, keep = self.features, list(keep)
        kinds = dict(df.dtypes)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    decision = self._raw(b[features].to_numpy("float64")) - self.offset
                    yield b[keep].assign(decision=decision)

        out = df.select(*keep, *[f for f in features if f not in keep]).mapInPandas(
            run, ", ".join(f"{k} {kinds[k]}" for k in keep) + ", decision double"
        )
        value = F.least(F.lit(100.0), F.greatest(F.lit(0.0), (0.1 - F.col("decision")) * 200))
        return out.select(
            "*", (F.col("decision") < -0.1).alias("is_anomaly"), value.alias("score"), F.when(value > 80, 0).otherwise(1).alias("priority")
        )
