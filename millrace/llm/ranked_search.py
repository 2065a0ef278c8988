"""Ranked lexical search: whole-number BM25 impacts, scored by products of dense tiles."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import byte_slices, narrow
from millrace.session import materialise

#: terms and counts of items that are sent to the tasks at once
ENTRIES = 500_000
#: items, columns and documents of a tile
ITEMS, COLUMNS, DOCS = 64, 4096, 1024
#: digits of item weights: 2^12 columns, digits below 2^20 and impacts below 2^20 add up to less than 2^53
DIGIT = 20
#: constants of the impact: share of the length and saturation in hundredths, scale
LENGTH_SHARE, SATURATION, SCALE = 25, 12, 1_000_000_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(raw: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return raw.translate(_LOWER).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(row, item, terms, times) of the distinct rows (item, text): an item's terms with their counts."""
    rows = items.distinct().withColumn("row", F.monotonically_increasing_id()).select("row", "item", "text")
    kind = rows.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, 2):
                found = [Counter(terms(raw)) for raw in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1),
                        pa.array([list(c) for c in found], pa.list_(pa.binary())),
                        pa.array([list(c.values()) for c in found], pa.list_(pa.int64())),
                    ],
                    names=["row", "item", "terms", "times"],
                )

    return rows.mapInArrow(run, f"row bigint, item {kind}, terms array<binary>, times array<bigint>")


def grouped_items(found: DataFrame, entries: int) -> DataFrame:
    """``found`` with ``part``: items whose terms number at most ``entries`` together, or one item."""
    total = found.agg(F.sum(F.size("terms"))).first()[0] or 0
    # a few more than needed, so that the cut below seldom starts another part
    few = found.repartition(max(1, -(-2 * int(total) // entries) if total > entries else 1))
    schema = f"{', '.join(f'{n} {t}' for n, t in few.dtypes)}, part string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, part, used = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            names = []
            for n in batch.column(2).value_lengths().to_pylist():
                if used and used + n > entries:
                    part, used = part + 1, 0
                used += n
                names.append(f"{task}-{part}")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names)], names=[*batch.schema.names, "part"])

    return few.mapInArrow(run, schema)


class Tiles:
    """The items of one part: for each tile of items its own compact vocabulary and sparse weights."""

    def __init__(self, rows: list[int], vocabulary: list[list[int]], times: list[list[int]], weight: np.ndarray):
        order = sorted(range(len(rows)), key=rows.__getitem__)
        self.rows, self.size, self.tiles = np.array([rows[i] for i in order], np.int64), len(weight), []
        for at in range(0, len(order), ITEMS):
            some = order[at : at + ITEMS]
            item = np.repeat(np.arange(len(some)), [len(vocabulary[i]) for i in some])
            term = np.array([t for i in some for t in vocabulary[i]], np.int64)
            value = np.array([t for i in some for t in times[i]], np.int64) * weight[term]
            used = value > 0
            columns, place = np.unique(term[used], return_inverse=True)
            for first in range(0, max(len(columns), 1), COLUMNS):
                here = (place >= first) & (place < first + COLUMNS)
                self.tiles.append(
                    (at, len(some), columns[first : first + COLUMNS], item[used][here], place[here] - first, value[used][here], first + COLUMNS >= len(columns))
                )

    def scores(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int) -> Iterator[tuple[int, np.ndarray]]:
        """(first item, items x documents) of each tile of items; all sums are exact whole numbers.

        ``impact`` are the impacts of the entries (term, doc) of a tile of documents.
        """
        place, total = np.full(self.size, -1, np.int32), None
        for at, items, columns, item, column, value, last in self.tiles:
            place[columns] = np.arange(len(columns))
            held = place[term]
            here = held >= 0
            dense = np.zeros((len(columns), docs))
            dense[held[here], doc[here]] = impact[here]
            place[columns] = -1
            total = np.zeros((items, docs), np.int64) if total is None else total
            digit = 0
            while len(value) and (int(value.max()) >> digit):
                weights = np.zeros((items, len(columns)))
                weights[item, column] = (value >> digit) & ((1 << DIGIT) - 1)
                total += (weights @ dense).astype(np.int64) << digit
                digit += DIGIT
            if last:
                yield at, total
                total = None


class Best:
    """The ``k`` best documents of each item so far, equal scores by ascending id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.least, self.kept = k, np.ones(items, np.int64), [[] for _ in range(items)]

    def add(self, first: int, scores: np.ndarray, ids: list, place: np.ndarray) -> None:
        """``place`` is the rank of each document's id among ``ids``. Ties with the last kept one stay in until ids decide."""
        hits = scores >= self.least[first : first + len(scores), None]
        for i in np.flatnonzero(hits.any(axis=1)).tolist():
            columns = np.flatnonzero(hits[i])
            best = columns[np.lexsort((place[columns], -scores[i, columns]))[: self.k]]
            found = [(-int(s), ids[d] is None, ids[d]) for d, s in zip(best.tolist(), scores[i, best].tolist())]
            # equal entries compare no further than None with None
            rows = sorted(self.kept[first + i] + found, key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))[: self.k]
            self.kept[first + i] = rows
            if len(rows) == self.k:
                self.least[first + i] = max(1, -rows[-1][0])


def _document_entries(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, terms, times): terms in all, and the numbers and counts of those in the vocabulary."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {t: i for i, t in enumerate(vocabulary.value)}
        for whole in batches:
            for batch in byte_slices(whole, 1):
                n, held, times = [], [], []
                for raw in batch.column(1).to_pylist():
                    words = terms(raw)
                    here = [(known[t], c) for t, c in Counter(words).items() if t in known]
                    n.append(len(words))
                    held.append(np.array([t for t, _ in here], "<u4").tobytes())
                    times.append(np.array([c for _, c in here], "<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(held, pa.binary()), pa.array(times, pa.binary())],
                    names=["doc_id", "n", "terms", "times"],
                )

    return docs.mapInArrow(run, f"doc_id {kind}, n bigint, terms binary, times binary")


def _document_counts(entries: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary, one number for each of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                counts[np.frombuffer(raw, "<u4")] += 1
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], names=["term", "n"])

    found = entries.select("terms").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    table, out = found.toArrow(), np.zeros(size, np.int64)
    out[table.column("term").to_numpy()] = table.column("n").to_numpy()
    return out


def _best_of_tasks(entries: DataFrame, tiles, documents: int, length: int, k: int) -> DataFrame:
    """(row, doc_id, score): the ``k`` best documents that each task finds for each item."""
    kind = entries.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = tiles.value
        best = Best(len(told.rows), k)
        for whole in batches:
            for start in range(0, whole.num_rows, DOCS):
                batch = whole.slice(start, DOCS)
                ids, n, held, times = (c.to_pylist() for c in batch.columns)
                parts = [np.frombuffer(raw, "<u4") for raw in held]
                term = np.concatenate(parts).astype(np.int64)
                if not len(term):
                    continue
                doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                tf = np.frombuffer(b"".join(times), "<u4").astype(np.int64)
                m = 100 - LENGTH_SHARE + LENGTH_SHARE * np.array(n, np.int64) * documents // length
                impact = (SCALE * tf) // (1000 * tf + SATURATION * m[doc])
                by_id = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i]))
                place = np.empty(len(ids), np.int64)
                place[by_id] = np.arange(len(ids))
                for first, scores in told.scores(term, doc, impact, len(ids)):
                    best.add(first, scores, ids, place)
        rows = [(int(told.rows[i]), doc_id, -score) for i, kept in enumerate(best.kept) for score, _, doc_id in kept]
        made = zip(*rows) if rows else ((), (), ())
        fields = [pa.int64(), entries_type, pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, fields)], names=["row", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    entries_type = to_arrow_type(entries.schema["doc_id"].dataType)
    return entries.select("doc_id", "n", "terms", "times").mapInArrow(run, f"row bigint, doc_id {kind}, score bigint")


def search(
    df: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", entries: int = ENTRIES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 for each item.

    Terms, weights and scores are whole numbers: a term of an item weighs
    floor(1000 ln((2 N + 2) / (2 df + 1))), its impact in a document is
    10^9 tf div (1000 tf + 12 m) with m = 75 + (25 n N) div L, and a score is
    the sum of weight times impact over the item's terms, repeats included.

    Items are taken in parts of at most ``entries`` distinct terms, which is
    all that the driver gets and the tasks are sent at once; the documents are
    read once for each part. A part's counts over all documents come first.
    Then a tile of documents becomes a dense matrix of impacts over the
    compact vocabulary of a tile of items, and one product gives all scores of
    the two. Weights are cut into digits of 20 bits and vocabularies into 4,096
    columns, so no partial sum in float64 reaches 2^53: scores are exact. Each
    task keeps its ``k`` best documents of an item, with ties until ids decide,
    and these are merged in two steps.

    A null or empty text has no terms: such documents are not counted and not
    returned, such items have no rows. Documents with equal ids are ranked one
    by one; a null id comes last among equal scores. Rows of ``items`` that
    agree in id and text count once; those that agree in the id alone are
    ranked each by itself. Other columns are not read.
    """
    spark = df.sparkSession
    docs = narrow(df, id_col, text_col)
    wanted = items.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).cast("binary").alias("text"))
    # row numbers are used again below, so they are written
    found = materialise(grouped_items(materialise(item_terms(wanted), "items"), entries), "parts")
    merged = None
    for (part,) in found.select("part").distinct().orderBy("part").collect():
        held = found.where(F.col("part") == part).select("row", "terms", "times").toArrow()
        rows, words, times = (held.column(c).to_pylist() for c in ("row", "terms", "times"))
        vocabulary = sorted({t for some in words for t in some})
        number = {t: i for i, t in enumerate(vocabulary)}
        told = spark.sparkContext.broadcast(vocabulary)
        counted = materialise(_document_entries(docs, told), "entries")
        n, length = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df_of = _document_counts(counted, len(vocabulary)).tolist()
        # a term that no document holds has no impact
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) if d else 0 for d in df_of], np.int64)
        tiles = Tiles(rows, [[number[t] for t in some] for some in words], times, weight)
        best = _best_of_tasks(counted, spark.sparkContext.broadcast(tiles), int(n), max(1, int(length)), k)
        merged = best if merged is None else merged.unionByName(best)
    if merged is None:
        kind = df.schema[id_col].dataType.simpleString()
        merged = spark.createDataFrame([], f"row bigint, doc_id {kind}, score bigint")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # many tasks: their rows of an item meet in up to 64 places first
    some = merged.withColumn("_at", F.spark_partition_id() % 64)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("row", "_at").orderBy(*order))).where(F.col("rank") <= k)
    last = some.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order))).where(F.col("rank") <= k)
    named = found.select("row", F.col("item").alias("item_id"))
    return last.join(named, "row").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
