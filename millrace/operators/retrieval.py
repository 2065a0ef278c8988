"""Vector search, context packing and retrieval quality."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import rag_prompt
from millrace.functions.udfs import unit_rows
from millrace.functions.values import normalise
from millrace.session import materialise, new_path

NO_CONTEXT = "No relevant information found."


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, lowest id first among equal ones."""
    if len(scores) > k:
        edge = np.partition(scores, -k)[-k]
        above, level = np.flatnonzero(scores > edge), np.flatnonzero(scores == edge)
        need = k - len(above)
        if len(level) > need:
            level = level[np.argpartition(ids[level], need - 1)[:need]]
        return np.concatenate([above, level])
    return np.arange(len(scores))


def query_blocks(queries: DataFrame, key: str, block: int) -> Iterator[pd.DataFrame]:
    """Queries in blocks of a bounded number of rows."""
    last = None
    while True:
        rest = queries if last is None else queries.where(F.col(key) > F.lit(last))
        head = rest.orderBy(key).limit(block).toPandas()
        if len(head):
            yield head
        if len(head) < block:
            return
        last = head[key].iloc[-1].item() if hasattr(head[key].iloc[-1], "item") else head[key].iloc[-1]


def _search_block(vectors, head, key, vector, query_key, query_vector, k):
    """Each task scores its vectors against one block of queries and emits its own best k."""
    q = unit_rows(np.stack(head[query_vector].to_numpy()).astype("float64"))
    names = head[query_key].to_list()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = [np.empty(0, "int64")] * len(names)
        best = [np.empty(0)] * len(names)
        for b in batches:
            if b.empty:
                continue
            scores = np.round(unit_rows(np.stack(b[vector].to_numpy()).astype("float64")) @ q.T, 12)
            own = b[key].to_numpy()
            for i in range(len(names)):
                s, n = np.concatenate([best[i], scores[:, i]]), np.concatenate([ids[i], own])
                take = _best(s, n, k)
                best[i], ids[i] = s[take], n[take]
        for name, s, n in zip(names, best, ids):
            if len(n):
                yield pd.DataFrame({query_key: [name] * len(n), key: n, "score": s})

    kinds = dict(vectors.dtypes)
    name_kind = "string" if head[query_key].dtype == object else "bigint"
    return vectors.select(key, vector).mapInPandas(run, f"{query_key} {name_kind}, {key} {kinds[key]}, score double")


def top_k(
    vectors: DataFrame, queries: DataFrame, key: str, vector: str, query_key: str, query_vector: str, k: int = 5,
    block: int = 1024,
) -> DataFrame:
    """Exact cosine top-k per query: (query, id, score, rank).

    Vectors stay where they are; only queries travel, in blocks of bounded
    size, and only k rows per query and task come back to be ranked.
    """
    parts = None
    for head in query_blocks(queries.select(query_key, query_vector), query_key, block):
        found = _search_block(vectors, head, key, vector, query_key, query_vector, k)
        parts = found if parts is None else parts.unionByName(found)
    w = Window.partitionBy(query_key).orderBy(F.desc("score"), key)
    return parts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def tile_search(
    vectors: DataFrame, queries: DataFrame, key: str, vector: str, query_key: str, query_vector: str, k: int = 5,
    cell: str | None = None, piece_rows: int = 4096, block_rows: int = 8192,
) -> DataFrame:
    """Cosine top-k of many queries against the vectors of the same ``cell``: (query, id, score, rank).

    Without ``cell`` every query meets every vector. The vectors of a cell are
    dealt to pieces and its queries to blocks; a task scores one piece against
    one block by a matrix product and returns its best k. So neither a large
    cell nor one that many queries ask for is work of one task, and nothing
    passes the driver. Only the counts per cell are broadcast. Rows without a
    vector or an id are left out; equal scores go by the lower id.
    """
    place = F.lit(0) if cell is None else F.col(cell)
    rows = vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(
        place.alias("_cell"), F.col(key).alias("_id"), F.col(vector).alias("_v")
    )
    asked = queries.where(F.col(query_vector).isNotNull()).select(
        place.alias("_cell"), F.col(query_key).alias("_query"), F.col(query_vector).alias("_q")
    )
    parts = lambda df, size, name: df.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    tiles = parts(rows, piece_rows, "_pieces").join(parts(asked, block_rows, "_blocks"), "_cell").where("_pieces >= 1 AND _blocks >= 1")
    tiles = materialise(tiles, "tiles")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n, *of: F.pmod(F.xxhash64(*of), F.col(n)).cast("int")
    left = rows.join(F.broadcast(tiles), "_cell").select(
        "_cell", deal("_pieces", "_id", "_v").alias("_piece"), every("_blocks").alias("_block"), "_id", "_v"
    )
    right = asked.join(F.broadcast(tiles), "_cell").select(
        "_cell", every("_pieces").alias("_piece"), deal("_blocks", "_query", "_q").alias("_block"), "_query", "_q"
    )

    def score(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(ask):
            v, ids = unit_rows(np.stack(own["_v"].to_numpy()).astype("float64")), own["_id"].to_numpy()
            for at in range(0, len(ask), 512):
                some = ask.iloc[at : at + 512]
                scores = np.round(unit_rows(np.stack(some["_q"].to_numpy()).astype("float64")) @ v.T, 12)
                for name, line in zip(some["_query"], scores):
                    take = _best(line, ids, k)
                    found.append(pd.DataFrame({query_key: [name] * len(take), key: ids[take], "score": line[take]}))
        return pd.concat(found) if found else pd.DataFrame({query_key: [], key: [], "score": []})

    names = ["_cell", "_piece", "_block"]
    kinds = dict(left.dtypes) | dict(right.dtypes)
    best = left.groupBy(*names).cogroup(right.groupBy(*names)).applyInPandas(
        score, f"`{query_key}` {kinds['_query']}, `{key}` {kinds['_id']}, score double"
    )
    w = Window.partitionBy(query_key).orderBy(F.desc("score"), key)
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _nearest_cells(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Cells of each vector, nearest first."""
    return np.argsort(-(unit_rows(vectors.astype("float64")) @ centres.T), axis=1, kind="stable")


class CellIndex:
    """Cells by k-means; a search ranks only the vectors of the cells nearest to a query.

    The number of cells is the square root of the number of vectors, at most
    ``max_cells``; centres are fitted on about ``fit_per_cell`` rows for each,
    and every row is indexed. ``probe``, the number of cells a search looks
    at, is measured while the index is built: ``trial_queries`` rows are
    searched exactly, and the fewest cells that hold the share ``recall`` of
    their ``k`` neighbours (themselves left out) are taken. So recall holds for
    queries distributed like the vectors, at any size; others may need more cells.
    Only centres and trial rows are held by the driver, both of bounded size.

    Of equal vectors the ``k + 1`` lowest keys are kept, the only ones that a
    search for k neighbours, or k beside the query itself, can return. Rows
    without a vector or a key are not indexed; an empty table gives an empty index.
    """

    def __init__(
        self, vectors: DataFrame, key: str, vector: str, k: int = 5, recall: float = 0.97, max_cells: int = 4096,
        fit_per_cell: int = 64, trial_queries: int = 512, seed: int = 42,
    ):
        self.key, self.vector, self.k = key, vector, k
        spark = vectors.sparkSession
        first = Window.partitionBy("_v").orderBy("_id")
        rows = vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col(vector).alias("_v"))
        rows = rows.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= k + 1).drop("_nth")
        rows = materialise(rows, "vectors")
        count = rows.count()
        self.cells = min(max_cells, max(1, math.isqrt(count)))
        self.centres = self._fit(rows, min(1.0, self.cells * fit_per_cell / max(count, 1)), seed)
        path = new_path(spark, "cells")
        placed = self._near(rows, "_v", 1).withColumnsRenamed({"_id": key, "_v": vector})
        # range partitioned on (cell, key): a large cell becomes several files
        placed.repartitionByRange("cell", key).write.partitionBy("cell").parquet(path)
        self.table = spark.read.schema(placed.schema).parquet(path)
        self.probe = self._measure(recall, trial_queries, seed)

    def _fit(self, rows: DataFrame, share: float, seed: int) -> np.ndarray:
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        ready = rows if share >= 1 else rows.sample(share, seed)
        # a written table, as a sample is drawn again in every round of the fit; points once,
        # since the fit needs several different ones for each centre
        points = materialise(ready.select(normalise(F.col("_v")).alias("_f")).distinct(), "sample")
        self.cells = max(1, min(self.cells, points.count() // 4))
        if self.cells == 1:
            return np.zeros((1, 1))
        kmeans = KMeans(k=self.cells, seed=seed, featuresCol="_f", maxIter=10, initSteps=5)
        model = kmeans.fit(points.select(array_to_vector("_f").alias("_f")))
        centres = unit_rows(np.stack(model.clusterCenters()))
        self.cells = len(centres)
        return centres

    def _near(self, rows: DataFrame, vector: str, probe: int) -> DataFrame:
        """One row for each of the ``probe`` cells nearest to a row's vector."""
        centres = self.centres
        if self.cells == 1:
            return rows.withColumn("cell", F.lit(0))

        @F.pandas_udf("array<int>")
        def near(column: pd.Series) -> pd.Series:
            found = []
            for at in range(0, len(column), 512):
                some = column.iloc[at : at + 512]
                found += _nearest_cells(np.stack(some.to_numpy()), centres)[:, :probe].astype("int32").tolist()
            return pd.Series(found, dtype=object)

        return rows.withColumn("cell", F.explode(near(F.col(vector))))

    def _measure(self, recall: float, trials: int, seed: int) -> int:
        """Fewest cells that hold the share ``recall`` of the neighbours of the trial rows."""
        if self.cells == 1:
            return 1
        drawn = F.xxhash64(F.lit(seed), self.key, self.vector)
        asked = self.table.select(F.col(self.key).alias("_query"), F.col(self.vector).alias("_q")).orderBy(drawn, "_query").limit(trials)
        asked = materialise(asked, "trial")
        found = tile_search(self.table, asked, self.key, self.vector, "_query", "_q", self.k + 1)
        found = found.where(~F.col(self.key).eqNullSafe(F.col("_query")))
        w = Window.partitionBy("_query").orderBy("rank")
        found = found.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= self.k)
        cells = found.select("_query", F.col(self.key)).join(self.table.select(self.key, "cell"), self.key)
        cells = cells.groupBy("_query").agg(F.collect_list("cell").alias("cells")).join(asked, "_query").toPandas()
        if cells.empty:
            return 1
        order = _nearest_cells(np.stack(cells["_q"].to_numpy()), self.centres)
        at = np.argsort(order, axis=1)
        ranks = np.sort(np.concatenate([at[i, list(held)] for i, held in enumerate(cells["cells"])]))
        return int(ranks[min(len(ranks), math.ceil(recall * len(ranks))) - 1]) + 1

    def search(self, queries: DataFrame, query_key: str, query_vector: str, k: int | None = None, probe: int | None = None) -> DataFrame:
        """Top ``k`` of the ``probe`` nearest cells: (query, id, score, rank), ranked exactly inside."""
        k = self.k if k is None else k
        if k > self.k + 1:
            raise ValueError(f"the index was built for {self.k} neighbours")
        asked = queries.where(F.col(query_vector).isNotNull()).select(query_key, query_vector)
        asked = materialise(self._near(asked, query_vector, min(probe or self.probe, self.cells)), "asked")
        return tile_search(self.table, asked, self.key, self.vector, query_key, query_vector, k, "cell")


def pack_context(hits: DataFrame, query_key: str, text: str, limit: int = 2048) -> DataFrame:
    """Best texts first while they fit; the first that does not is cut if over 100 characters remain.

    A query has k hits, so its list is short.
    """
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("rank"), F.col(text).alias("t"))))
    start = F.struct(F.lit(0).alias("used"), F.lit(False).alias("full"), F.array().cast("array<string>").alias("parts"))

    def step(acc, hit):
        size, left = F.length(hit["t"]), F.lit(limit) - acc["used"]
        fits = ~acc["full"] & (size <= left)
        cut = ~acc["full"] & (size > left) & (left > 100)
        piece = F.when(fits, F.array(hit["t"])).when(cut, F.array(F.concat(F.substr(hit["t"], F.lit(1), left), F.lit("..."))))
        return F.struct(
            (acc["used"] + F.when(fits, size).otherwise(0)).alias("used"),
            (acc["full"] | (size > left)).alias("full"),
            F.concat(acc["parts"], F.coalesce(piece, F.array().cast("array<string>"))).alias("parts"),
        )

    packed = F.aggregate(F.col("_hits"), start, step)
    rows = hits.groupBy(query_key).agg(ordered.alias("_hits")).select(query_key, packed.alias("p"))
    return rows.select(query_key, F.array_join("p.parts", "\n\n").alias("context"), F.size("p.parts").alias("pieces"))


def prompts(queries: DataFrame, contexts: DataFrame, query_key: str, question: str, generate=None) -> DataFrame:
    """Prompt per query, or the fixed answer when nothing was found; ``generate`` is a column function."""
    both = queries.select(query_key, question).join(contexts, query_key, "left")
    found = F.col("context").isNotNull() & (F.col("context") != "")
    out = both.select(
        query_key, F.when(found, rag_prompt(F.col(question), F.col("context"))).alias("prompt"), F.when(~found, NO_CONTEXT).alias("answer")
    )
    return out.withColumn("answer", F.coalesce("answer", generate(F.col("prompt")))) if generate else out


def retrieval_quality(ranked: DataFrame, query_key: str, relevant: Column, totals: DataFrame, cuts: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Means over queries of precision and recall at the cuts, reciprocal rank and similarity.

    ``totals``: query, relevant_total.
    """
    hit = relevant.cast("int")
    within = lambda n: F.sum(F.when(F.col("rank") <= n, hit).otherwise(0))
    per = ranked.groupBy(query_key).agg(
        *[within(n).alias(f"h{n}") for n in cuts],
        F.coalesce(F.max(F.when(relevant, 1 / F.col("rank"))), F.lit(0.0)).alias("rr"), F.avg("score").alias("similarity"),
    ).join(totals, query_key)
    recall = lambda n: F.coalesce(F.try_divide(F.col(f"h{n}").cast("double"), F.col("relevant_total").cast("double")), F.lit(0.0))
    return per.agg(
        *[F.avg(F.col(f"h{n}") / n).alias(f"precision_at_{n}") for n in cuts],
        *[F.avg(recall(n)).alias(f"recall_at_{n}") for n in cuts if n > 1],
        F.avg("rr").alias("mrr"), F.avg("similarity").alias("mean_similarity"),
    )
