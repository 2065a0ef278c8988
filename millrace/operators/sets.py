"""Set operations and de-duplication."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import strip
from millrace.functions.udfs import unit_rows
from millrace.plans.ordered import Ordered
from millrace.session import materialise, new_path

log = logging.getLogger(__name__)


def union_available(sources: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """Union by name of the sources that can be read; a failing one is logged and left out."""
    out = None
    for source in sources:
        try:
            df = source()
        except Exception as exc:
            log.warning("source left out: %s", exc)
            continue
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise RuntimeError("no source could be read")
    return out


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every key once, with the side or sides that have it."""
    sides = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    both = sides.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    kind = F.when(F.col("r") == 0, "source_only").when(F.col("l") == 0, "target_only").otherwise("common")
    return both.select(key, kind.alias("kind"))


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select(*(columns or df.columns)).dropDuplicates()


def first_per_text(df: DataFrame, key: str, text: Column) -> DataFrame:
    """The first row of every normalised text, by ``key``.

    Copies meet as digests under a partial minimum, so a text with very many
    copies costs no more than any other.
    """
    digest = F.sha2(F.lower(strip(text)), 256)
    first = df.groupBy(digest.alias("_d")).agg(F.min(key).alias(key)).select(key)
    return df.join(first, key, "left_semi")


def fuzzy_dedup(
    df: DataFrame, key: str, vector: str, threshold: float = 0.95, first: int = 4096, listed: int = 32, stretch: int = 32768
) -> DataFrame:
    """Keep a row unless its cosine with an earlier kept row reaches ``threshold``: (key, kept).

    The rule is greedy in ``key`` order. Rows get their position in that order
    and are decided in prefixes of ``first`` positions, then twice as many and
    so on, so the rounds grow with the logarithm of the rows. Kept rows of a
    prefix clear all later rows close to them before the next prefix begins,
    so a large group of copies is gone after its first kept row. Vectors meet
    in tiles (``_links``) and never pass the driver; it sees counts only.

    Equal vectors are one row; a row without a vector and a zero vector are
    close to no other and kept. Keys must not be null.
    """
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    lone = F.when(squares.isNull() | (squares == 0), F.col(key))
    same = df.groupBy(F.col(vector).alias("_v"), lone.alias("_lone")).agg(F.min(key).alias(key))
    # at most about 4,096 slices of at least 4,096 rows
    size = df.count()
    placed = Ordered(same, [], [key], max(4096, size // 4096), (size, size)).running(_at=("count", F.lit(1)))
    rows = materialise(placed, "placed")
    kept_path = new_path(df.sparkSession, "kept")
    rows.where("_lone IS NOT NULL").select(key).write.parquet(kept_path)
    left, end, last = rows.where("_lone IS NULL").select("_at", key, "_v"), first, rows.agg(F.max("_at")).first()[0] or 0
    while True:
        head = left.where(F.col("_at") <= end)
        keep = _first_independent(head.select("_at", "_v"), threshold, listed, stretch)
        kept = head.join(keep, "_at", "left_semi")
        kept.select(key).write.mode("append").parquet(kept_path)
        if end >= last:
            break
        rest = left.where(F.col("_at") > end)
        near = _links(rest, kept, threshold, 1).select(F.col("row").alias("_at")).distinct()
        left, end = materialise(rest.join(near, "_at", "left_anti"), "undecided"), 2 * end
    names = df.sparkSession.read.schema(rows.select(key).schema).parquet(kept_path)
    return df.select(key).join(names.withColumn("kept", F.lit(True)), key, "left").na.fill(False, ["kept"])


def _links(rows: DataFrame, others: DataFrame, threshold: float, most: int, piece: int = 4096) -> DataFrame:
    """(row, near): the ``most`` earliest of the earlier ``others`` that are close to each row.

    Rows and others are dealt to pieces of about ``piece`` vectors; a task
    compares one piece with one other by matrix products.
    """
    pieces = lambda d: max(1, -(-d.count() // piece))
    across, down = pieces(rows), pieces(others)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n: F.pmod(F.xxhash64("_at"), F.lit(n)).cast("int")
    mine = rows.select(deal(across).alias("_a"), every(down).alias("_b"), "_at", "_v")
    theirs = others.select(every(across).alias("_a"), deal(down).alias("_b"), F.col("_at").alias("_near"), F.col("_v").alias("_w"))

    def close(own: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"row": np.zeros(0, "int64"), "near": np.zeros(0, "int64")})]
        if len(own) and len(other):
            other = other.sort_values("_near")
            at, before = own["_at"].to_numpy(), other["_near"].to_numpy()
            v, o = (unit_rows(np.stack(x.to_numpy()).astype("float64")) for x in (own["_v"], other["_w"]))
            for i in range(0, len(at), 512):
                hit = (np.round(v[i : i + 512] @ o.T, 12) >= threshold) & (before < at[i : i + 512, None])
                r, c = np.nonzero(hit & (np.cumsum(hit, axis=1) <= most))
                found.append(pd.DataFrame({"row": at[i + r], "near": before[c]}))
        return pd.concat(found)

    by = ["_a", "_b"]
    pairs = mine.groupBy(*by).cogroup(theirs.groupBy(*by)).applyInPandas(close, "row bigint, near bigint")
    nth = F.row_number().over(Window.partitionBy("row").orderBy("near"))
    return pairs.withColumn("nth", nth).where(F.col("nth") <= most)


def _first_independent(rows: DataFrame, threshold: float, listed: int, stretch: int) -> DataFrame:
    """Positions (_at) that the greedy rule keeps among ``rows``.

    Every open row lists its ``listed`` earliest close rows. It goes as soon as
    one of them is kept and stays once all of them are gone and it has no
    further ones; otherwise it waits. A round takes the rows in stretches of
    positions, each in order, so a chain is followed through a whole stretch
    at once. Rows that wait for close rows beyond their list get a new one
    among the rows still in the race.
    """
    state = materialise(rows.select("_at", F.lit(None).cast("boolean").alias("kept")), "state")

    def settle(b: pd.DataFrame) -> pd.DataFrame:
        known: dict[int, int] = {}
        b = b.sort_values(["row", "near"])
        for row, near, more, was in zip(b["row"].tolist(), b["near"].tolist(), b["more"].tolist(), b["was"].tolist()):
            now, other = known.get(row, 1), known.get(near, was)
            if now:
                known[row] = 0 if other == 1 else -1 if other < 0 or more else now
        return pd.DataFrame({"_at": list(known), "now": list(known.values())}, dtype="int64")

    while True:
        waiting = state.where("kept IS NULL").select("_at")
        racing = state.where("kept IS NULL OR kept").select("_at")
        links = _links(rows.join(waiting, "_at", "left_semi"), rows.join(racing, "_at", "left_semi"), threshold, listed + 1)
        links = materialise(links.select("row", "near", (F.col("nth") > listed).alias("more")), "links")
        linked = links.select(F.col("row").alias("_at")).distinct().withColumn("linked", F.lit(True))
        state = state.join(linked, "_at", "left").select("_at", F.coalesce("kept", F.when(F.col("linked").isNull(), True)).alias("kept"))
        state, count = materialise(state, "state"), None
        while True:
            waiting = state.where("kept IS NULL").select(F.col("_at").alias("row"))
            left, count = count, waiting.count()
            if count in (0, left):
                break
            was = F.coalesce(F.col("kept").cast("int"), F.lit(-1)).alias("was")
            seen = links.join(waiting, "row", "left_semi").join(state.select(F.col("_at").alias("near"), was), "near")
            now = seen.groupBy(F.floor(F.col("row") / stretch)).applyInPandas(settle, "_at bigint, now bigint")
            decided = now.where("now >= 0").select("_at", (F.col("now") == 1).alias("new"))
            state = state.join(decided, "_at", "left").select("_at", F.coalesce("kept", "new").alias("kept"))
            state = materialise(state, "state")
        if count == 0:
            return state.where("kept").select("_at")
