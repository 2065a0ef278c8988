"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.layout import byte_slices, spread
from millrace.session import materialise

#: a word: what the white space characters of ASCII do not part
WORD = r"[^\x20\x09-\x0D]+"


def narrow(df: DataFrame, id_col: str, text_col: str, raw: bool = True) -> DataFrame:
    """Only (doc_id, text), a null text as the empty one, as UTF-8 bytes if ``raw``.

    Selecting by position of meaning keeps extra columns, whatever their names,
    out of every later step.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), (text.cast("binary") if raw else text).alias("text"))
    return spread(rows, "doc_id")


def id_type(df: DataFrame, id_col: str) -> str:
    return df.schema[id_col].dataType.simpleString()


def per_text(
    df: DataFrame, fields: dict[str, str], work: Callable[[], Callable[..., tuple]], size: int | None = None
) -> DataFrame:
    """Replace the last column by the fields that ``work()`` gives for each of its values.

    ``work`` is called once in each task, so it can hold buffers and models;
    the columns before the last are passed on as they are. With ``size``, at
    most so many bytes of the last column are worked on at a time, or one value.
    """
    kept = df.schema.fields[:-1]
    schema = T.StructType([*kept, *T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in fields.items()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, each = to_arrow_schema(schema), work()
        for whole in batches:
            slices = (whole.slice(at, 1024) for at in range(0, whole.num_rows, 1024))
            for batch in byte_slices(whole, len(kept), size=size) if size else slices:
                made = list(zip(*map(each, batch.column(len(kept)).to_pylist())))
                columns = [batch.column(i).cast(out.field(i).type) for i in range(len(kept))]
                columns += [pa.array(c, out.field(len(kept) + i).type) for i, c in enumerate(made)]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    return df.mapInArrow(run, schema)


def with_neighbours(df: DataFrame, order: list[str], payload: list[str]) -> DataFrame:
    """Each row with structs ``prev`` and ``next`` of the payload of the rows beside it in ``order``.

    The rows are cut into as many slices as there are shuffle partitions and
    written; what meets over all slices is one row for each of them. Equal
    rows may stand in any order among themselves.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(parts, *order).withColumn("_slice", F.spark_partition_id())
    cut = materialise(cut, "neighbours")
    beside = Window.partitionBy("_slice").orderBy(*order)
    value = F.struct(*payload)
    rows = cut.select("*", F.lag(value).over(beside).alias("prev"), F.lead(value).over(beside).alias("next"))
    ends = cut.groupBy("_slice").agg(
        F.min_by(value, F.struct(*order)).alias("_first"), F.max_by(value, F.struct(*order)).alias("_last")
    )
    over_slices = Window.orderBy("_slice")
    ends = ends.select(
        "_slice", F.lag("_last").over(over_slices).alias("_before"), F.lead("_first").over(over_slices).alias("_after")
    )
    # one row for each slice
    return rows.join(F.broadcast(ends), "_slice").select(
        *df.columns, F.coalesce("prev", "_before").alias("prev"), F.coalesce("next", "_after").alias("next")
    )
