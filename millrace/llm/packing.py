"""Lexical retrieval packing: documents that share rare tokens fill a window together."""

from __future__ import annotations

import base64
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import per_text
from millrace.session import materialise

WINDOW = 2048
#: documents of a shard of the index
SHARD = 2048
#: documents of the sample for each shard, and numbers of a content sketch
SAMPLE, SKETCH = 16, 64
#: id that ends a document
END = 1
K1, B = 1.2, 0.75


#: white space other than the space and the line feed
_RARE = [chr(c) for c in (*range(9, 10), *range(11, 14), *range(28, 32), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)]
_TAIL = ".,;:!?#$%&*|"


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit numbers.

    Byte-level BPE never joins the pieces of its splitting pattern, and a space
    between characters that are no white space always starts a piece, as does
    punctuation after a letter. So a text is cut at spaces and the ids of a
    word are kept in a table of bounded size. Texts that name the special token
    or have white space beside a space are encoded whole. The ids of every text
    are those of ``tokenizers``.
    """

    def __init__(self, vocabulary: str, ranks: str, pattern: str, special: str, most: int):
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.vocabulary, self.whole, self.special, self.most = vocabulary, None, special, most

        def plain(text: str) -> bytes:
            ids = fast.encode_ordinary(text)
            return struct.pack(f"<{len(ids)}I", *ids)

        class Known(dict):
            """The ids of words, with the space before them; words of the table before it are taken over when they come again."""

            before: dict = {}

            def __missing__(self, word: str) -> bytes:
                ids = self.before.get(word)
                if ids is None:
                    stem = word.rstrip(_TAIL)
                    if stem != word and stem[-1:].isalpha():
                        ids = self[stem] + tails[word[len(stem) :]]
                    else:
                        ids = plain(" " + word)
                self[word] = ids
                return ids

        class Tails(dict):
            def __missing__(self, tail: str) -> bytes:
                return self.setdefault(tail, plain(tail))

        self.plain, self.known, self.fresh, tails = plain, Known(), Known, Tails()

    def __call__(self, text: str) -> bytes:
        if self.special in text:
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.vocabulary)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if "  " in text or " \n" in text or "\n " in text or any(c in text for c in _RARE):
            return self.plain(text)
        first, *words = text.split(" ")
        if len(self.known) > self.most:
            # words that do not come again are forgotten with the table after the next
            last, self.known = self.known, self.fresh()
            last.before, self.known.before = {}, last
        return self.plain(first) + b"".join(map(self.known.__getitem__, words))


@lru_cache(1)
def encoder(vocabulary: str, ranks: str, pattern: str, special: str = "<|endoftext|>", most: int = 600_000) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(vocabulary, ranks, pattern, special, most)


class Index:
    """BM25 postings of one shard's documents over token ids, with the statistics of the whole corpus."""

    def __init__(self, units: list, idf: np.ndarray, mean_length: float):
        """``units``: the ids of each document, or its distinct ids with their counts."""
        terms, docs, counts, lengths = [], [], [], np.zeros(len(units))
        self.queries = []
        for i, unit in enumerate(units):
            found, times = unit if isinstance(unit, tuple) else np.unique(unit, return_counts=True)
            found, times = found.astype(np.int64), times.astype(np.int64)
            lengths[i] = times.sum()
            self.queries.append(found)
            terms.append(found)
            docs.append(np.full(len(found), i))
            counts.append(times)
        term, doc, tf = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (terms, docs, counts))
        norm = K1 * (1 - B + B * lengths / max(mean_length, 1e-9))
        weight = idf[term] * tf * (K1 + 1) / (tf + norm[doc]) if len(term) else np.zeros(0)
        self.size = len(units)
        # terms of many documents are rows of a matrix, whose products give the scores of all seeds at once
        often = np.bincount(term, minlength=len(idf)) > self.size // 32
        rows = np.cumsum(often) - 1
        dense = often[term]
        self.matrix = np.zeros((int(often.sum()), self.size), np.float32)
        self.matrix[rows[term[dense]], doc[dense]] = weight[dense]
        self.rows = [rows[q[often[q]]] for q in self.queries]
        self.queries = [q[~often[q]] for q in self.queries]
        self.blocks: dict[int, np.ndarray] = {}
        term, doc, weight = term[~dense], doc[~dense], weight[~dense]
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = doc[order].astype(np.int32), weight[order].astype(np.float32)
        self.starts = np.searchsorted(term[order], np.arange(len(idf) + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for the tokens of ``seed``."""
        terms = self.queries[seed]
        firsts = self.starts[terms]
        counts = self.starts[terms + 1] - firsts
        # the postings of all terms, one after the other
        places = np.repeat(firsts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return self._often(seed) + np.bincount(self.docs[places], self.weights[places], self.size)

    def _often(self, seed: int) -> np.ndarray:
        """The part of the terms of many documents."""
        block, at = divmod(seed, 256)
        if block not in self.blocks:
            seeds = self.rows[block * 256 : block * 256 + 256]
            asked = np.zeros((len(seeds), len(self.matrix)), np.float32)
            for i, rows in enumerate(seeds):
                asked[i, rows] = 1
            self.blocks[block] = asked @ self.matrix
        return self.blocks[block][at]


def _ranked(scores: np.ndarray, unused: np.ndarray) -> Iterator[int]:
    """Unused units, the highest score first and the first of equal ones; the best few are ranked before all others."""
    scores = np.where(unused, scores, -1.0)
    if len(scores) > 128:
        edge = np.partition(scores, -64)[-64]
        some = np.flatnonzero(scores >= max(edge, 0.0))
        yield from some[np.argsort(-scores[some], kind="stable")].tolist()
        scores[some] = -1.0
    order = np.argsort(-scores, kind="stable")
    yield from order[scores[order] >= 0].tolist()


@lru_cache(1)
def _directions(size: int) -> np.ndarray:
    """A sign for each token id and number of the sketch."""
    return (np.random.default_rng(7).integers(0, 2, (size, SKETCH)) * 2 - 1).astype(np.int8)


def sketch(terms: np.ndarray, times: np.ndarray, idf: np.ndarray, mean_length: float) -> np.ndarray:
    """The BM25 weights of a document, projected to ``SKETCH`` whole numbers, so that near documents have near sketches.

    All sums are sums of whole numbers, which no order of adding changes: a
    task that is run again gives each document the same shard.
    """
    norm = K1 * (1 - B + B * int(times.sum()) / max(mean_length, 1e-9))
    weights = np.rint(idf[terms].astype(float) * times * (K1 + 1) / (times + norm) * 256)
    size = np.sqrt(float(weights @ weights))
    made = weights @ _directions(len(idf))[terms].astype(float)
    return np.rint(made / size * 1024) if size else made


class Tree:
    """Shards by content: halves of a sample along the direction in which it differs most, until each is one shard.

    Documents that no direction tells apart, such as copies, are dealt to as
    many shards as they fill.
    """

    def __init__(self, sample: np.ndarray, each: int, shard: int):
        self.nodes: list[tuple] = []
        self.shards = 0
        self._grow(sample.astype(float), each, shard)

    def _grow(self, rows: np.ndarray, each: int, shard: int) -> int:
        at, parts = len(self.nodes), max(1, -(-len(rows) * each // shard))
        self.nodes.append((None, self.shards, parts, 0))
        if parts > 1:
            centred = rows - rows.mean(axis=0)
            _, vectors = np.linalg.eigh(centred.T @ centred)
            along = np.rint(vectors[:, -1] * 4096)
            places = rows @ along
            ranked = np.sort(places)
            least = ranked[len(rows) * (parts // 2) // parts]
            if least == ranked[0]:
                # the first of many equal ones: cut behind them
                more = ranked[np.searchsorted(ranked, least, "right") :]
                least = more[0] if len(more) else least
            if least > ranked[0]:
                low = self._grow(rows[places < least], each, shard)
                high = self._grow(rows[places >= least], each, shard)
                self.nodes[at] = (along, least, low, high)
                return at
        self.shards += parts
        return at

    def shard(self, sketched: np.ndarray, mark: int) -> int:
        along, least, low, high = self.nodes[0]
        while along is not None:
            along, least, low, high = self.nodes[low if float(sketched @ along) < least else high]
        return least + mark % low


def _fill(
    units: list, lengths: np.ndarray, idf: np.ndarray, mean_length: float, window: int
) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (unit, start, length); ``units`` are all ids of the documents or their counts, ``lengths`` what is left of each.

    Each window starts with a seed, what is left of the last unit that was cut
    or else the first unused unit, and takes the unused neighbours of the seed
    in the order of their score, cutting the last one so that it is full.
    """
    index = Index(units, idf, mean_length)
    unused = lengths > 0
    rest, begun, place = None, 0, 0
    while True:
        if rest is None:
            while place < len(units) and not unused[place]:
                place += 1
            if place == len(units):
                return
            rest, begun = place, 0
            unused[place] = False
        seed, room, pieces = rest, window, []
        take = min(room, int(lengths[seed]) - begun)
        pieces.append((seed, begun, take))
        room -= take
        rest, begun = (seed, begun + take) if begun + take < lengths[seed] else (None, 0)
        if room:
            for unit in _ranked(index.scores(seed), unused):
                if not room:
                    break
                unused[unit] = False
                take = min(room, int(lengths[unit]))
                pieces.append((unit, 0, take))
                room -= take
                if take < lengths[unit]:
                    rest, begun = unit, take
        yield pieces


def _power_parts(pieces: list[tuple[int, int, int]], window: int) -> list[list[tuple[int, int, int]]]:
    """Cut a short window into ones whose lengths are powers of two, which need no padding."""
    left, out = sum(n for _, _, n in pieces), []
    queue = list(pieces)
    while left:
        size = min(window, 1 << (left.bit_length() - 1))
        left -= size
        part = []
        while size:
            unit, start, n = queue.pop(0)
            take = min(size, n)
            part.append((unit, start, take))
            size -= take
            if take < n:
                queue.insert(0, (unit, start + take, n - take))
        out.append(part)
    return out


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds them, which stands in the first byte."""
    most = int(values.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1)


def tokenise(df: DataFrame, files: dict[str, str], id_col: str, text_col: str, window: int) -> DataFrame:
    """(doc_id, tie, doc_tokens, crcs, rest, terms, times).

    Checksums of the full windows from the start, the ids behind these, and
    the distinct ids of the whole document with their counts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    end = np.array([END], "<u4").tobytes()

    def work():
        encode = encoder(**files)

        def each(text):
            ids = encode(text) + end
            full = len(ids) // 4 // window
            crcs = [zlib.crc32(ids[i * window * 4 : (i + 1) * window * 4]) for i in range(full)]
            whole = np.frombuffer(ids, "<u4")
            terms, times = np.unique(whole, return_counts=True)
            return len(whole), crcs, _packed(whole[full * window :]), _packed(terms), _packed(times)

        return each

    fields = {"doc_tokens": "bigint", "crcs": "array<bigint>", "rest": "binary", "terms": "binary", "times": "binary"}
    return per_text(rows, fields, work, size=1 << 20)


def pack(
    df: DataFrame,
    files: dict[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    shard: int = SHARD,
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all rows.

    A text's ids end with id 1. Whole windows from its start are sequences of
    their own; what is left is a unit of the index. Documents are put to shards
    of about ``shard`` documents by content: a tree halves a sample of their
    weighted token ids until each part is one shard, whatever the size of the
    corpus, so that near documents meet. In each shard windows are filled from
    a BM25 index over all token ids of the documents, whose document counts
    and mean length are those of the corpus. Only the last window of a shard
    can be short; it is cut into sequences whose lengths are powers of two.

    A null text counts as empty and is the end id alone; a null id stays null;
    repeated rows are packed as often as they are there, in any order among
    themselves; other columns are not read.
    """
    spark = df.sparkSession
    units = materialise(tokenise(df, files, id_col, text_col, window), "tokens")

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                ids = _unpacked(raw)
                if len(ids) and int(ids[-1]) >= len(counts):
                    counts = np.pad(counts, (0, int(ids[-1]) + 1 - len(counts)))
                counts[ids] += 1
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["term", "n"])

    # one row per token id of the vocabulary: its size bounds what the driver gets and sends
    seen = units.select("terms").mapInArrow(document_counts, "term bigint, n bigint")
    seen = seen.groupBy("term").agg(F.sum("n").alias("n")).toPandas().set_index("term")["n"]
    n, tokens = units.agg(F.count(F.lit(1)), F.coalesce(F.sum("doc_tokens"), F.lit(0))).first()
    idf = np.zeros(int(seen.index.max()) + 1 if len(seen) else 1, np.float32)
    idf[seen.index.to_numpy(int)] = np.log(1 + (n - seen.to_numpy() + 0.5) / (seen.to_numpy() + 0.5))
    mean_length = tokens / max(1, n)
    told = spark.sparkContext.broadcast(idf)

    tree = _tree(units, told, mean_length, n, shard)
    grown = spark.sparkContext.broadcast(tree)

    # only the counts go through Python here, the ids stay where they are
    @F.pandas_udf("bigint")
    def place(terms: pd.Series, times: pd.Series, marks: pd.Series) -> pd.Series:
        tree = grown.value
        if tree.shards <= 1:
            return pd.Series(np.zeros(len(marks), np.int64))
        sketched = (sketch(_unpacked(t), _unpacked(c), told.value, mean_length) for t, c in zip(terms, times))
        return pd.Series([tree.shard(s, int(m)) for s, m in zip(sketched, marks)], dtype="int64")

    placed = units.withColumn("shard", place("terms", "times", _mark()))

    schema = units.select(
        "doc_id", F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("length"),
        F.lit(0).cast("bigint").alias("ids_crc32"), "doc_tokens", F.lit(0).cast("bigint").alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    ).schema

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "tie"], kind="stable", na_position="last").reset_index(drop=True)
        first, out, number = int(rows["shard"].iloc[0]) << 32, [], 0
        ids, totals = rows["doc_id"].tolist(), rows["doc_tokens"].tolist()
        for i, crcs in enumerate(rows["crcs"]):
            for j, crc in enumerate(crcs):
                out.append((ids[i], j * window, window, int(crc), totals[i], first + number, 0))
                number += 1
        units = [(_unpacked(t), _unpacked(c)) for t, c in zip(rows["terms"], rows["times"])]
        heads = [len(crcs) * window for crcs in rows["crcs"]]
        parts = [_unpacked(raw) for raw in rows["rest"]]
        for pieces in _fill(units, np.array([len(p) for p in parts]), told.value, mean_length, window):
            whole = sum(n for _, _, n in pieces) == window
            for sequence in [pieces] if whole else _power_parts(pieces, window):
                offset = 0
                for unit, start, n in sequence:
                    crc = zlib.crc32(parts[unit][start : start + n].astype("<u4").tobytes())
                    out.append((ids[unit], heads[unit] + start, n, crc, totals[unit], first + number, offset))
                    offset += n
                number += 1
        made = pd.DataFrame(out, columns=[f.name for f in schema])
        if len(made) and rows["doc_id"].isna().any():
            made["doc_id"] = made["doc_id"].astype("object").where(made["doc_id"].notna(), None)
        return made

    return placed.groupBy("shard").applyInPandas(fill, schema)


def _mark() -> Column:
    return F.xxhash64(F.col("doc_id").cast("string"), "tie")


def _tree(units: DataFrame, told, mean_length: float, n: int, shard: int) -> Tree:
    """Of a sample with ``SAMPLE`` documents a shard, whose sketches are all that the driver gets."""
    each = max(1, shard // SAMPLE) if n > shard * 16 else 1
    if n <= shard:
        return Tree(np.zeros((n, SKETCH)), 1, shard)

    def work():
        def of(value):
            return (sketch(_unpacked(value["terms"]), _unpacked(value["times"]), told.value, mean_length).astype(int).tolist(),)

        return of

    some = units.where(F.pmod(F.xxhash64(_mark(), F.lit(1)), F.lit(each)) == 0)
    rows = per_text(some.select("tie", F.struct("terms", "times").alias("value")), {"sketch": "array<int>"}, work)
    # in one order, as sums of the same rows give the same tree
    sample = sorted(rows.select("sketch").toArrow().column(0).to_pylist())
    return Tree(np.array(sample).reshape(-1, SKETCH), each, shard)
