"""Order-dependent folds: one small Python state per key, rows streamed in order.

Rows are hash partitioned by key, sorted inside each partition (Spark spills
the sort) and handed over in Arrow batches, so no group is ever collected.
Callers first cut a key into segments wherever the state is known to reset
(``segments_by_gap``); a busy key then becomes many independent segments.
A segment that is still too large is folded in slices at once (``fold_sliced``).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.plans.ordered import Ordered
from millrace.session import materialise


def segments_by_gap(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    starts: Callable[[Column], Column],
    previous: Column,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add ``segment``: a running number that grows where ``starts(previous)`` holds."""
    rows = Ordered(df, keys, order, hot_rows)
    lagged = rows.lag(_prev=previous)
    first = F.col("_prev").isNull() | starts(F.col("_prev"))
    marked = lagged.withColumn("_start", F.coalesce(first, F.lit(True)).cast("long"))
    numbered = Ordered(marked, keys, order, hot_rows, rows.sizes).running(segment=("sum", F.col("_start")))
    return numbered.drop("_prev", "_start")


# Ranges of a batch that belong to one key: (first row, end, whether the key starts here).
Ranges = list[tuple[int, int, bool]]
# step(memory, rows, ranges): rows of one or more keys in order, memory of the first range's key
Step = Callable[[dict, pd.DataFrame, Ranges], pd.DataFrame]


def fold_sorted(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Step,
    schema: str,
    finish: Callable[[tuple, dict], pd.DataFrame] | None = None,
    close: Callable[[dict], pd.DataFrame] | None = None,
) -> DataFrame:
    """Apply ``step(memory, rows, ranges)`` to sorted rows, one Arrow batch at a time.

    ``memory`` is the state of the last key seen; a step clears it for every
    range that starts a key. With ``finish(key, memory)`` each range is stepped
    on its own, and rows may be added after the last row of a key; ``close(memory)``
    may add rows after the last row of a task.
    """
    keys = list(keys)

    def key_at(batch: pd.DataFrame, i: int) -> tuple:
        return tuple(None if pd.isna(v) else v for v in (batch[k].iloc[i] for k in keys))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, memory = None, {}
        for batch in batches:
            if batch.empty:
                continue
            here, before = batch[keys], batch[keys].shift()
            changed = ((here != before) & ~(here.isna() & before.isna())).any(axis=1).to_numpy()
            first = key_at(batch, 0)
            starts = [0, *(i for i in np.flatnonzero(changed).tolist() if i)]
            ranges = [(a, b, a > 0 or first != current) for a, b in zip(starts, [*starts[1:], len(batch)])]
            if finish is None:
                out = step(memory, batch, ranges)
                if len(out):
                    yield out
            else:
                for a, b, new in ranges:
                    if new and current is not None:
                        yield finish(current, memory)
                    current = key_at(batch, a)
                    step(memory, batch.iloc[a:b], [(0, b - a, new)])
            current = key_at(batch, -1)
        if finish and current is not None:
            yield finish(current, memory)
        if close and current is not None:
            yield close(memory)

    spread = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return spread.mapInPandas(run, schema)


def fold_sliced(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], step: Step, schema: str, hot_rows: int | None = None
) -> DataFrame:
    """``fold_sorted`` for steps that keep no rows back, with a large key spread over many tasks.

    Where a key exceeds ``hot_rows`` the rows are cut into even slices of
    (keys, order), all folded at once. A slice that begins inside a key is
    folded again from the memory with which the slice before it ended, and
    once more whenever that one changes, until all agree; slices whose entry
    stays the same keep their rows. The result is that of one fold in any
    case. Rules that forget, as all here do, settle after a few rounds, each
    of which runs the changed slices in parallel; at worst there are as many
    rounds as slices. The driver holds one memory per slice.
    """
    rows = Ordered(df, keys, order, hot_rows)
    if not rows.sliced:
        return fold_sorted(df, keys, order, step, schema)
    keys, marks = list(keys), ["_slice", *keys]
    names = StructType.fromDDL(schema).names
    slices = rows.df.agg(F.max("_slice")).first()[0] + 1

    def folded(entries: dict[int, bytes] | None) -> tuple[DataFrame, dict[int, tuple]]:
        """Rows of all slices, or of the key that the slices of ``entries`` begin in, and a note
        per slice: its first and last key, and the memory of the last one."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            at, begins, first, memory = None, None, True, {}

            def note():
                end = pickle.dumps((begins, at[1:], pickle.dumps(memory)))
                return pd.DataFrame(None, index=[0], columns=names, dtype=object).assign(_slice=at[0], _first=True, _end=end)

            for batch in batches:
                here = [tuple(None if pd.isna(v) else v for v in k) for k in batch[marks].drop_duplicates().itertuples(index=False, name=None)]
                codes = batch.groupby(marks, sort=False, dropna=False).ngroup().to_numpy()
                cuts = np.searchsorted(codes, np.arange(len(here) + 1)).tolist()
                for mark, a, b in zip(here, cuts[:-1], cuts[1:]):
                    new = mark != at
                    if new:
                        first = at is None or mark[0] != at[0]
                        if entries is not None and not first:
                            continue
                        if first:
                            if at is not None:
                                yield note()
                            begins = mark[1:]
                        at, memory = mark, {}
                        if entries is not None:
                            memory, new = pickle.loads(entries[mark[0]]), False
                    out = step(memory, batch.iloc[a:b].reset_index(drop=True), [(0, b - a, new)])
                    yield out.assign(_slice=mark[0], _first=first, _end=None)
            if at is not None:
                yield note()

        some = rows.df if entries is None else rows.df.where(F.col("_slice").isin(list(entries)))
        spread = some.repartition(slices if entries is None else len(entries), "_slice").sortWithinPartitions(*marks, *order)
        out = materialise(spread.mapInPandas(run, f"{schema}, _slice int, _first boolean, _end binary"), "folded")
        notes = out.where("_end IS NOT NULL").select("_slice", "_end").collect()
        return out.where("_end IS NULL").drop("_end"), {n["_slice"]: pickle.loads(n["_end"]) for n in notes}

    first_fold, notes = folded(None)
    places = sorted(notes)
    inside = {s: p for p, s in zip(places, places[1:]) if notes[s][0] == notes[p][1]}
    entered: dict[int, bytes] = {}
    latest: dict[int, int] = {}
    again: list[DataFrame] = []
    while True:
        entries = {s: notes[p][2] for s, p in inside.items() if entered.get(s) != notes[p][2]}
        if not entries:
            break
        out, ends = folded(entries)
        again.append(out)
        for s, (begins, _, memory) in ends.items():
            entered[s], latest[s] = entries[s], len(again) - 1
            if notes[s][0] == notes[s][1]:
                notes[s] = (begins, begins, memory)
    result = first_fold.where(~(F.col("_first") & F.col("_slice").isin(list(latest))))
    for i, out in enumerate(again):
        valid = [s for s, n in latest.items() if n == i]
        if valid:
            result = result.unionByName(out.where(F.col("_slice").isin(valid)))
    return result.drop("_slice", "_first")
