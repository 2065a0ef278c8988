"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD
from millrace.session import materialise

#: slices of the key order of a source; each is sorted by a task of its own
SLICES = 1024


def word_count(text: Column) -> Column:
    """Words of a whole text, 0 for a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _uniform(seed: int, *columns: Column) -> Column:
    """A number in (0, 1) that depends on the values alone, so reruns agree."""
    value = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(value), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size) with a row per source.

    Sources in code point order, null last, weigh ``weights``, repeating. They
    share ``share`` times all sizes by weight; no target exceeds ``most``
    times its source's size, and the excess goes to the others by weight
    until none is above. That is the level at which the targets, weight times
    level or the cap, add up; sources are at their cap up to some place in the
    order of cap over weight, so the level is a quotient of running sums.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    repeating = F.array(*[F.lit(float(w)) for w in weights])
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    named = sizes.select(
        "source", "source_size",
        (F.col("source_size") * F.lit(float(most))).alias("cap"), F.element_at(repeating, place).alias("weight"),
    )
    up = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    total = F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing))
    levels = named.withColumn("level", (total * F.lit(float(share)) - before) / rest)
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    # from the first source below its cap on, the quotients fall
    first = F.max(open_level).over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce(first, F.lit(float("inf"))))
    return levels.select("source", "source_size", target.alias("target"))


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality: DataFrame | None = None,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 7,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row.

    ``quality`` holds (doc_id, weight), one row per id; others weigh 1. A
    source first takes all its documents as often as whole epochs fit its
    target. The rest goes to documents in the order of the key
    -ln(u) / weight, u drawn from the id, so that a document comes early with
    a chance in proportion to its weight, until their words fill the target;
    the last of them may be taken in part. The order of a source is summed up
    in ``SLICES`` slices of the key, which a carry of one row per slice joins.

    A null or empty text has size 0 and nothing is taken of it; a null source
    is a source of its own; a null id is an id like any other; rows with equal
    ids or keys are ordered by their text's hash, equal rows in either order.
    """
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("tie"),
    )
    if quality is not None:
        extra = quality.select(F.col("doc_id").alias("_id"), F.col("weight").alias("_weight"))
        rows = rows.join(extra, F.col("doc_id") == F.col("_id"), "left").drop("_id")
    weight = F.coalesce(F.col("_weight"), F.lit(1.0)) if quality is not None else F.lit(1.0)
    rows = rows.withColumn("key", -F.ln(_uniform(seed, F.col("doc_id"))) / weight)
    rows = rows.withColumn("slice", F.floor(F.lit(SLICES) * (F.lit(1.0) - F.exp(-F.col("key")))).cast("int"))
    rows = rows.withColumn("name", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    rows = materialise(rows.select("doc_id", "source", "name", "size", "tie", "key", "slice"), "sizes")

    slices = rows.groupBy("source", "name", "slice").agg(F.sum("size").alias("words"))
    sources = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sources, weights, share, most)
    targets = targets.select("*", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("name")).drop("source")
    earlier = Window.partitionBy("name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = slices.select("name", "slice", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("carry"))
    carry = carry.join(targets, "name")

    within = Window.partitionBy("name", "slice").orderBy("key", "doc_id", "tie")
    before = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = rows.withColumn("before", before).join(carry, ["name", "slice"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.round(F.col("target") - epochs * F.col("source_size")).cast("bigint")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before") - F.col("carry")))
    taken = (epochs * F.col("size") + part).cast("bigint")
    return ordered.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "tie")


def mixed(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality: DataFrame | None = None,
    **options,
) -> DataFrame:
    """The rows of ``df``, with their columns, each as often as the mix takes it.

    Whole texts are repeated: a document taken in part counts if at least half
    of its words are taken. Documents without words stay once, as there is
    nothing of them to weigh. Rows with the same id and text share their number.
    """
    shares = mix(df, id_col, text_col, source_col, quality, **options)
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.round(F.col("taken") / F.col("size"))).cast("int")
    plan = shares.groupBy(
        F.coalesce(F.concat(F.lit("i"), F.col("doc_id").cast("string")), F.lit("n")).alias("_id"), F.col("tie").alias("_tie"),
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_source"),
    ).agg(F.max(times).alias("_times")).where("_times > 0")
    whole = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.lit("n")).alias("_id"),
        F.xxhash64(F.col(text_col)).alias("_tie"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("_source"),
    )
    joined = whole.join(plan, ["_id", "_tie", "_source"])
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("row.*")
