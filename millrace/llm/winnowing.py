"""Winnowing: fingerprints of texts from the least k-gram hash of every window."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import per_text
from millrace.llm.ngrams import rolling, sliding_min

#: bytes of a k-gram, and k-grams of a window: texts that share
#: GRAM + WINDOW - 1 bytes in a row share a fingerprint
GRAM, WINDOW = 24, 64
_CHUNK = 1 << 20


def winnow(raw: bytes, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, byte positions) of the chosen k-grams, in order.

    Of each window the least hash is chosen, of equal ones the rightmost; a
    k-gram chosen by several windows is kept once. A text with fewer k-grams
    than a window is one window; one shorter than a k-gram is hashed whole; an
    empty one has no fingerprint.
    """
    if not raw:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = rolling(raw, min(gram, len(raw))) >> np.uint64(24)
    window = min(window, len(hashes))
    chosen = []
    for at in range(0, len(hashes) - window + 1, _CHUNK):
        part = hashes[at : at + _CHUNK + window - 1]
        # a later place makes an equal hash smaller
        late = np.uint64((1 << 24) - 1) - np.arange(len(part), dtype=np.uint64)
        least = sliding_min((part << np.uint64(24)) | late, window)
        first = np.r_[True, least[1:] != least[:-1]]
        chosen.append(at + (1 << 24) - 1 - (least[first] & np.uint64((1 << 24) - 1)).astype(np.int64))
    places = np.concatenate(chosen)
    places = places[np.r_[True, places[1:] != places[:-1]]]
    return hashes[places], places


def told(hashes: np.ndarray, places: np.ndarray) -> str:
    """A fingerprint as text: ``hash@position`` in hex, by spaces."""
    return " ".join([f"{h:x}@{p:x}" for h, p in zip(hashes.tolist(), places.tolist())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes over all hashes of two fingerprints; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; a null text counts as empty."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).alias("doc_id"), raw.alias("text"))
    return per_text(rows, {"fingerprint": "string"}, lambda: lambda text: (told(*winnow(text)),))


def _edited(text: str, following: str) -> str:
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _compared(text: str, following: str) -> tuple:
    """All result columns but the id."""
    new = _edited(text, following)
    mine, theirs, after = winnow(text.encode()), winnow(new.encode()), winnow(following.encode())
    digest = hashlib.sha256(new.encode()).hexdigest()
    return (
        len(text), digest, told(*mine), told(*theirs), likeness(mine[0], theirs[0]), likeness(mine[0], after[0]),
    )


_RESULT = {
    "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
    "near_edited": "double", "near_next": "double",
}


def compare_with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text and how like they and the next text's are.

    The next document is the one that follows in the order of ids (nulls last;
    rows with one id by their text's hash, equal rows in any order), after the
    last one the first. The edited text has the last quarter of the code points,
    rounded down, replaced by the first as many (or all) of the next document.

    Texts are moved once, into ranges of ids. Each task reads its range in order
    and needs one text ahead; the last row of a range meets the first one of
    the next range apart, one row of each range. Null texts count as empty;
    other columns are not read.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).isNull().alias("last"), F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text")
    )
    order = ["last", "doc_id", "tie"]
    ranged = rows.repartitionByRange(parts, *order)
    inside = ranged.sortWithinPartitions(*order).select("doc_id", "text")
    schema = T.StructType([
        inside.schema["doc_id"], *T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in _RESULT.items())).fields
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All rows but the last one."""
        from pyspark.sql.pandas.types import to_arrow_schema

        out, held = to_arrow_schema(schema), None
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                made = []
                for row in zip(*(c.to_pylist() for c in whole.slice(at, 256).columns)):
                    if held is not None:
                        made.append((held[0], *_compared(held[1], row[1])))
                    held = row
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), out)], schema=out)

    # the same exchange of texts serves both
    whole = F.struct("last", "doc_id", "tie", "text")
    ends = ranged.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.min(whole).alias("first"), F.max(whole).alias("end"))
    beside = Window.orderBy("part")
    everything = beside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("first.text").over(beside), F.first("first.text").over(everything))
    met = ends.select(F.col("end.doc_id").alias("doc_id"), F.col("end.text").alias("text"), following.alias("following"))
    met = met.select("doc_id", F.struct("text", "following").alias("value"))
    met = per_text(met, _RESULT, lambda: lambda value: _compared(value["text"], value["following"]))
    return inside.mapInArrow(run, schema).union(met)
