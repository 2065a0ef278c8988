"""Placement of rows over tasks, and of a task's rows over slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash rows on a unique key over all cores when the input has too few splits.

    Meant ahead of work that costs far more per row than a shuffle. An input
    with as many splits as there are cores, the usual case on a cluster, is
    left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def join_null_safe(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Join on columns whose nulls are a value like any other; they are returned once."""
    if not names:
        return left.crossJoin(right)
    renamed = right.withColumnsRenamed({n: f"_r{n}" for n in names})
    on = reduce(lambda a, b: a & b, [left[n].eqNullSafe(renamed[f"_r{n}"]) for n in names])
    return left.join(renamed, on, how).drop(*[f"_r{n}" for n in names])


def byte_slices(batch: pa.RecordBatch, column: int, rows: int = 1024, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``rows`` rows and about ``size`` bytes in ``column``, or one row that is larger."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    at = 0
    while at < batch.num_rows:
        fits = int(np.searchsorted(before, before[at] + size, "right")) - 1
        end = min(max(fits, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end
