"""Running, lagged and rolling values over ordered rows, without a hot task.

A window partitioned by a key sorts all rows of that key in one task. When no
key is larger than ``hot_rows`` that is the best plan and it is used as is.
Otherwise the rows are range partitioned on (keys, order) into even slices, so
a hot key is spread over many of them; each slice is scanned on its own and a
carry of at most one row per slice (or one frame of rows for rolling values)
joins the slices together. The result is the same in both plans.

``order`` must be unique within a key: every caller adds a tie-breaker.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.session import materialise

HOT_ROWS = 2_000_000

_FUNCTIONS = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "last": lambda c: F.last(c, ignorenulls=True),
}


def largest_group(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows of the largest key, rows in all); only the key columns are read."""
    if not keys:
        n = df.count()
        return n, n
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.max("n").alias("top"), F.sum("n").alias("all")).first()
    return int(row["top"] or 0), int(row["all"] or 0)


def join_bounded(df: DataFrame, small: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Join on null-safe ``names`` with a side that has at most a few rows per slice."""
    renamed = small.withColumnsRenamed({n: f"_r{n}" for n in names})
    on = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_r{n}")) for n in names])
    return df.join(F.broadcast(renamed), on, how).drop(*[f"_r{n}" for n in names])


class Ordered:
    """Rows of ``df`` per ``keys`` in the total order ``order``."""

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        hot_rows: int | None = None,
        sizes: tuple[int, int] | None = None,
    ):
        """``sizes`` of an earlier look at the same rows and keys saves counting again."""
        self.keys, self.order = list(keys), list(order)
        limit = HOT_ROWS if hot_rows is None else hot_rows
        self.sizes = top, total = sizes or largest_group(df, self.keys)
        self.sliced = top > limit
        if self.sliced:
            slices = max(2, -(-total // limit))
            cut = df.repartitionByRange(slices, *self.keys, *self.order)
            df = materialise(cut.withColumn("_slice", F.spark_partition_id()), "slices")
        self.df = df

    # -- windows ---------------------------------------------------------

    def _window(self, *, descending: bool = False) -> WindowSpec:
        keys = (["_slice"] if self.sliced else []) + self.keys
        order = [F.col(c).desc() if descending else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*keys).orderBy(*order)

    def _carry(self, totals: DataFrame, combine: dict[str, str]) -> DataFrame:
        """Combined values of a key's earlier slices: one row per slice at most."""
        before = (
            Window.partitionBy(*self.keys)
            .orderBy("_slice")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        first = Window.partitionBy(*self.keys).orderBy("_slice")
        return (
            totals.select(
                "*",
                *[_FUNCTIONS[fn](F.col(c)).over(before).alias(f"_c{c}") for c, fn in combine.items()],
                F.row_number().over(first).alias("_nth"),
            )
            .where("_nth > 1")
            .select("_slice", *self.keys, *[f"_c{c}" for c in combine])
        )

    def _join_carry(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        # one row per slice at most, so its size is bounded by the slice count
        return join_bounded(df, carry, ["_slice", *self.keys], "left")

    # -- operations ------------------------------------------------------

    def running(self, **columns: tuple[str, Column]) -> DataFrame:
        """Inclusive running value per output name: ``name=(function, column)``."""
        frame = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = self.df.select(
            "*", *[_FUNCTIONS[fn](c).over(frame).alias(n) for n, (fn, c) in columns.items()]
        )
        if not self.sliced:
            return out
        order = F.struct(*self.order)
        total = {
            "last": lambda c: F.max_by(c, F.when(c.isNotNull(), order)),
        }
        totals = self.df.groupBy("_slice", *self.keys).agg(
            *[total.get(fn, _FUNCTIONS[fn])(c).alias(f"_t{n}") for n, (fn, c) in columns.items()]
        )
        combine = {
            f"_t{n}": {"count": "sum"}.get(fn, fn) for n, (fn, _) in columns.items()
        }
        joined = self._join_carry(out, self._carry(totals, combine))
        merge = {
            "sum": lambda a, b: F.coalesce(a + b, a, b),
            "count": lambda a, b: a + F.coalesce(b, F.lit(0)),
            "min": lambda a, b: F.least(a, b),
            "max": lambda a, b: F.greatest(a, b),
            "last": lambda a, b: F.coalesce(a, b),
        }
        merged = {
            n: merge[fn](F.col(n), F.col(f"_c_t{n}")) for n, (fn, _) in columns.items()
        }
        return joined.withColumns(merged).drop("_slice", *[f"_c_t{n}" for n in columns])

    def lag(self, **columns: Column) -> DataFrame:
        """Value of the previous row of the key, null on its first row."""
        w = self._window()
        out = self.df.select("*", *[F.lag(c).over(w).alias(n) for n, c in columns.items()])
        if not self.sliced:
            return out
        out = out.withColumn("_rn", F.row_number().over(w))
        tails = self.df.groupBy("_slice", *self.keys).agg(
            F.max_by(
                F.struct(*[c.alias(n) for n, c in columns.items()]), F.struct(*self.order)
            ).alias("_tail")
        )
        joined = self._join_carry(out, self._carry(tails, {"_tail": "last"}))
        picked = {
            n: F.when(F.col("_rn") == 1, F.col("_c_tail")[n]).otherwise(F.col(n)) for n in columns
        }
        return joined.withColumns(picked).drop("_slice", "_rn", "_c_tail")

    def rolling(self, size: int, **columns: Callable[[WindowSpec], Column]) -> DataFrame:
        """Values over the last ``size`` rows, the current one included."""
        if not self.sliced:
            frame = self._window().rowsBetween(1 - size, Window.currentRow)
            return self.df.select("*", *[fn(frame).alias(n) for n, fn in columns.items()])
        rows = self.with_halo(size - 1)
        frame = self._window().rowsBetween(1 - size, Window.currentRow)
        out = rows.select("*", *[fn(frame).alias(n) for n, fn in columns.items()])
        return out.where(~F.col("_halo")).drop("_halo", "_slice")

    def with_halo(self, size: int) -> DataFrame:
        """Slices plus, ahead of each, the last ``size`` rows before it of its first key."""
        counts = self.df.groupBy("_slice", *self.keys).agg(F.count(F.lit(1)).alias("_n"))
        per_key = Window.partitionBy(*self.keys).orderBy("_slice")
        through = counts.select(
            "*",
            F.sum("_n").over(per_key).alias("_through"),
            F.row_number().over(per_key).alias("_nth"),
            F.lead("_slice").over(per_key).alias("_next"),
        )
        # a slice feeds those that begin fewer than `size` rows of the key behind its end;
        # positions meet in stretches of `size` rows, so a long key costs its slices once
        stretch = lambda position: F.floor(position / F.lit(max(size, 1)))
        feeding = through.where("_next is not null").select(
            "_slice", *self.keys, "_through", F.explode(F.array(stretch(F.col("_through")), stretch(F.col("_through")) + 1)).alias("_at")
        )
        before = F.col("_through") - F.col("_n")
        targets = through.where("_nth > 1").select(
            F.col("_slice").alias("_to"), *[F.col(k).alias(f"_k{k}") for k in self.keys],
            before.alias("_before"), stretch(before).alias("_in"),
        )
        match = [
            F.col("_at") == F.col("_in"),
            F.col("_slice") < F.col("_to"),
            F.col("_before") - F.col("_through") < size,
            *[F.col(k).eqNullSafe(F.col(f"_k{k}")) for k in self.keys],
        ]
        links = feeding.join(targets, match).select("_slice", *self.keys, "_to")
        spanning = through.where("_next is not null").select("_slice", *self.keys)
        ends = join_bounded(self.df, spanning, ["_slice", *self.keys], "inner")
        newest = F.row_number().over(self._window(descending=True))
        tails = ends.withColumn("_back", newest).where(F.col("_back") <= size)
        # one row per pair of slices no further apart than the frame
        halo = join_bounded(tails, links, ["_slice", *self.keys], "inner").withColumn("_slice", F.col("_to"))
        halo = halo.select(*self.df.columns, F.lit(True).alias("_halo"))
        return self.df.withColumn("_halo", F.lit(False)).unionByName(halo)


def running_total_over_groups(
    df: DataFrame, keys: Sequence[str], value: str, hot_rows: int | None = None
) -> DataFrame:
    """Rows per distinct ``value`` of each key with the count up to and including it."""
    counts = materialise(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n")), "counts")
    return Ordered(counts, keys, [value], hot_rows).running(cum=("sum", F.col("n")))
