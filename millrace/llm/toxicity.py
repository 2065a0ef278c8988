"""Toxicity scores: a linear classifier over character n-grams scaled by naive Bayes ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_slices, narrow, per_text
from millrace.llm.ngrams import ENTRIES, Distinct, char_grams, fit_blocks, pack_slots, sigmoid, unpack_slots

BITS = 18
SIZES = (3, 4, 5)


@dataclass(frozen=True)
class ToxicityModel:
    """``weights`` per slot of the hashed n-grams, the ratio already multiplied in."""

    weights: np.ndarray
    bias: float

    def score(self, slots: np.ndarray) -> float:
        return float(sigmoid(np.array(self.weights[slots].sum(dtype=np.float64) + self.bias)))


def slots_of(raw: bytes, distinct: Distinct) -> np.ndarray:
    """Slots of the n-grams that occur in the whole text, each once.

    A-Z are lower-cased and white space runs become one space, also at both ends.
    """
    grams = char_grams(b" " + b" ".join(raw.lower().split()) + b" ", SIZES)
    return distinct(np.concatenate(grams)) if grams else np.zeros(0, np.int64)


def train(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    usable: Column | None = None,
    max_rows: int = 6000,
    smoothing: float = 1.0,
    least_ratio: float = 0.3,
    least_texts: int = 5,
) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled texts, the bound of what the driver gets.

    The rows are those with the smallest hash of their id among ``labels`` rows
    that ``usable`` (a condition on the labels) admits; rows with a null id or
    label are not used, and the largest label counts if an id has several.
    Each n-gram's presence is multiplied by the logarithm of its smoothed
    odds among toxic and other texts; n-grams with a ratio under
    ``least_ratio`` or in fewer than ``least_texts`` texts are left out.
    Without rows of both labels the score is the share of label 1, a half if
    there is no row.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known if usable is None else known.where(usable)
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg((F.max(label_col) > 0).alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # the sample has a fixed bound, so it can be broadcast
    texts = narrow(df, id_col, text_col).where(F.col("doc_id").isNotNull())
    chosen = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")

    def work():
        distinct = Distinct(BITS)
        return lambda raw: (pack_slots(np.sort(slots_of(raw, distinct))),)

    table = per_text(chosen, {"slots": "binary"}, work).toArrow()
    table = table.take(pc.sort_indices(table, [("doc_id", "ascending")]))
    label = table["label"].combine_chunks().to_numpy(zero_copy_only=False).astype(float)

    def texts_slots():
        # views of the table's own memory, unpacked one at a time
        return (unpack_slots(b.as_buffer()) for b in table["slots"])

    width = 1 << BITS
    if len(label) == 0 or label.min() == label.max():
        share = float(np.clip(label.mean(), 0.01, 0.99)) if len(label) else 0.5
        return ToxicityModel(np.zeros(width, np.float32), float(np.log(share / (1 - share))))
    ones, others = np.zeros(width, np.int32), np.zeros(width, np.int32)
    for slots, toxic in zip(texts_slots(), label):
        # a text has a slot once
        (ones if toxic else others)[slots] += 1
    ratio = np.log((ones + smoothing) / (label.sum() + 2 * smoothing)) - np.log(
        (others + smoothing) / (len(label) - label.sum() + 2 * smoothing)
    )
    used = (np.abs(ratio) > least_ratio) & (ones + others >= least_texts)
    place, scale = (np.cumsum(used) - 1).astype(np.int32), ratio[used]
    # the used n-grams of all texts, one text after the other, are all that stays
    index, ends, at = np.empty(int((ones + others)[used].sum()), np.int32), np.zeros(len(label) + 1, np.int64), 0
    for i, slots in enumerate(texts_slots()):
        kept = place[slots[used[slots]]]
        index[at : at + len(kept)] = kept
        ends[i + 1] = at = at + len(kept)
    del table

    def blocks():
        for at in range(0, len(index), ENTRIES):
            part = index[at : at + ENTRIES].astype(np.int64)
            rows = np.repeat(np.arange(len(label)), np.diff(np.clip(ends, at, at + len(part))))
            yield part, rows, scale[part]

    weights, bias = fit_blocks(blocks, label, int(used.sum()), 1e-5, 60)
    full = np.zeros(width, np.float32)
    full[used] = weights * scale
    return ToxicityModel(full, float(bias))


def score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score double, predicted int) for each row, repeated rows included.

    Null and empty texts have no n-grams but those of white space and get the
    score that follows from them; a null id stays null. Other columns are not read.
    """

    def work():
        distinct = Distinct(BITS)
        return lambda raw: (model.score(slots_of(raw, distinct)),)

    scored = per_text(narrow(df, id_col, text_col), {"score": "double"}, work)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject(df: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, with their columns, in one pass."""

    def run(batches):
        distinct = Distinct(BITS)
        for whole in batches:
            place = whole.schema.get_field_index(text_col)
            for batch in byte_slices(whole, place, size=1 << 20):
                texts = batch.column(place).cast(pa.binary()).to_pylist()
                yield batch.filter(pa.array([model.score(slots_of(t or b"", distinct)) < 0.5 for t in texts], pa.bool_()))

    return df.mapInArrow(run, df.schema)
