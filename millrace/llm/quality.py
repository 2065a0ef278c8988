"""Quality rules: counts of a text and a calibrated classifier over hashed n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import narrow, per_text
from millrace.llm.ngrams import char_grams, fit_logistic, sigmoid, word_grams, word_hashes

BITS = 16
CHAR_SIZES = (1, 2)
SYMBOLS = b"#*$%&|<>"
#: words of a window whose repetition counts
WINDOW = 5


@dataclass(frozen=True)
class QualityModel:
    """``slope`` and ``offset`` turn the raw score into a probability of label 1."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, slots: np.ndarray, values: np.ndarray) -> float:
        raw = float(self.weights[slots] @ values) + self.bias
        return float(sigmoid(np.array(self.slope * raw + self.offset)))


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of word and character n-grams with the square roots of their shares."""
    hashes = word_hashes(words)
    grams = char_grams(b" ".join(words), CHAR_SIZES) + [word_grams(hashes, 1), word_grams(hashes, 2)]
    slots = (np.concatenate(grams) >> np.uint64(64 - BITS)).astype(np.int64)
    times = np.bincount(slots)
    found = np.flatnonzero(times)
    return found, np.sqrt(times[found] / max(1, len(slots)))


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words in windows of ``size`` words that the text has twice or more, the first included."""
    if len(words) <= size:
        return 0
    windows = word_grams(word_hashes(words), size)
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def counts(raw: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    joined = b"".join(words)
    chars = len(joined.decode("utf-8", "replace"))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.split()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def train(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    usable: Column | None = None,
    max_rows: int = 6000,
) -> QualityModel:
    """Fit on at most ``max_rows`` labelled texts, the bound of what the driver gets.

    The rows are those with the smallest hash of their id; rows with a null id
    or label are not used, and the largest label counts if an id has several.
    Every fourth row is held back to fit the probabilities (a logistic curve
    over the raw score). Without rows of both labels everything is kept.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known if usable is None else known.where(usable)
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg((F.max(label_col) > 0).alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = narrow(df, id_col, text_col).where(F.col("doc_id").isNotNull())
    chosen = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")

    def work():
        def each(raw):
            slots, values = features(raw.split())
            return slots.astype("<u4").tobytes(), values.astype("<f4").tobytes()

        return each

    table = per_text(chosen, {"slots": "binary", "values": "binary"}, work).toArrow()
    table = table.sort_by([("doc_id", "ascending")])
    label = table["label"].combine_chunks().to_numpy(zero_copy_only=False).astype(float)
    width = 1 << BITS
    held = np.arange(len(label)) % 4 == 3
    if len(label) < 8 or min(len(set(label[held])), len(set(label[~held]))) < 2:
        return QualityModel(np.zeros(width, np.float32), 3.0)
    slots = [np.frombuffer(b, "<u4").astype(np.int64) for b in table["slots"].to_pylist()]
    values = [np.frombuffer(b, "<f4").astype(float) for b in table["values"].to_pylist()]
    fit = [i for i in range(len(label)) if not held[i]]
    rows = np.repeat(np.arange(len(fit)), [len(slots[i]) for i in fit])
    weights, bias = fit_logistic(
        np.concatenate([slots[i] for i in fit]), rows, np.concatenate([values[i] for i in fit]),
        label[~held], width, 0.0, 60, 3.0,
    )
    raw = np.array([weights[slots[i]] @ values[i] + bias for i in np.flatnonzero(held)])
    spread = float(raw.std()) or 1.0
    here = np.arange(len(raw))
    curve, offset = fit_logistic(np.zeros(len(raw), np.int64), here, raw / spread, label[held], 1, 1e-3, 300, 0.5)
    return QualityModel(weights.astype(np.float32), float(bias), max(float(curve[0]), 0.0) / spread, float(offset))


def judge(
    df: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5
) -> DataFrame:
    """Counts, base rule, probability and verdict of each row, repeated rows included.

    base_failed: under ten words, or over a fifth of the words in repeated
    windows. kept: not base_failed and a probability of label 1 of ``least`` or
    more. A null text counts as empty and fails; a null id stays null; other
    columns are not read.
    """
    fields = {
        "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "probability": "double",
    }

    def work():
        def each(raw):
            words = raw.split()
            found = counts(raw, words)
            failed = found[0] < 10 or 100 * found[4] > 20 * found[0]
            return *found, failed, model.probability(*features(words)) if words else 0.0

        return each

    judged = per_text(narrow(df, id_col, text_col), fields, work)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= least))
