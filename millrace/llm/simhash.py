"""SimHash fingerprints of word shingles and the groups that a small bit distance links."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import narrow, per_text
from millrace.session import materialise

#: fingerprints of a tile
TILE = 2048


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint: a bit is set if over half of the shingles' XXH64 have it.

    A-Z are lower-cased; shingles are ``shingle`` words joined by a space, with
    repeats; a shorter text is one shingle, a text without words gives zero.
    """
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, 42)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - shingle].tolist()]
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view("<i8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp bigint) of each row; a null text counts as empty."""
    return per_text(
        narrow(df, id_col, text_col), {"fp": "bigint"}, lambda: lambda raw: (fingerprint(raw, shingle),)
    )


def _segments(n: int) -> int:
    """Parts of a fingerprint whose bit counts name its cell: more for more fingerprints.

    Any number gives the same links; more parts mean smaller cells and more copies.
    """
    return 4 if n < 1 << 22 else 8 if n < 1 << 30 else 16


def _base(segments: int, radius: int) -> int:
    """Base in which bit counts of parts, moved by up to ``radius`` either way, stay apart."""
    return 64 // segments + 1 + 2 * radius


def _cell(segments: int, radius: int) -> Column:
    """The bit counts of all parts, packed into one number."""
    width, base = 64 // segments, _base(segments, radius)
    mask = F.lit((1 << width) - 1 if width < 64 else -1).cast("bigint")
    parts = [F.bit_count(F.shiftrightunsigned("fp", i * width).bitwiseAND(mask)).cast("bigint") for i in range(segments)]
    return reduce(lambda x, y: x + y, [part * F.lit(base**i) for i, part in enumerate(parts)])


def _offsets(segments: int, radius: int) -> list[list[int]]:
    """Differences of bit counts whose sizes add up to ``radius`` at most; of two opposite ones, one."""
    found: list[list[int]] = [[]]
    for _ in range(segments):
        found = [[*o, d] for o in found for d in range(-radius, radius + 1) if sum(map(abs, o)) + abs(d) <= radius]
    return [o for o in found if next((d for d in o if d), 1) > 0]


def _forest(near: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and columns of each class that the matrix links."""
    rows = near.any(1)
    while rows.any():
        new = np.zeros(len(rows), bool)
        new[int(rows.argmax())] = True
        row_in, col_in = new.copy(), np.zeros(near.shape[1], bool)
        while new.any():
            cols = near[new].any(0) & ~col_in
            col_in |= cols
            new = near[:, cols].any(1) & ~row_in if cols.any() else np.zeros(len(rows), bool)
            row_in |= new
        rows &= ~row_in
        yield np.flatnonzero(row_in), np.flatnonzero(col_in)


def _compare(radius: int):
    """Links inside and between tiles, as stars: (a, b) with a the least of a class of the two tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lefts, rights, same = (batch.column(i) for i in range(3))
            one, two = [], []
            for i in range(batch.num_rows):
                a = lefts[i].values.to_numpy().view(np.uint64)
                b = rights[i].values.to_numpy().view(np.uint64)
                near = np.empty((len(a), len(b)), bool)
                for at in range(0, len(a), 256):
                    near[at : at + 256] = np.bitwise_count(a[at : at + 256, None] ^ b[None, :]) <= radius
                if same[i].as_py():
                    np.fill_diagonal(near, False)
                for x, y in _forest(near):
                    group = np.unique(np.concatenate([a[x], b[y]]).view(np.int64))
                    one.append(np.full(len(group) - 1, group[0]))
                    two.append(group[1:])
            if one:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(one)), pa.array(np.concatenate(two))], ["a", "b"])

    return run


def links(distinct: DataFrame, radius: int = 2, segments: int | None = None) -> DataFrame:
    """Stars (a, b) that connect exactly the fingerprints (column fp, distinct) within ``radius`` bits.

    The fingerprints are tiled by the bit counts of their parts. Two of them
    differ in at least as many bits as the counts of their parts do in sum, so
    tile pairs whose counts are further apart than the radius are skipped; all
    others are compared exactly, by exclusive-or and bit counts.
    """
    segments = segments or _segments(distinct.count())
    step = [_base(segments, radius) ** i for i in range(segments)]
    moves = F.array(*[F.lit(sum(s * d for s, d in zip(step, o))).cast("bigint") for o in _offsets(segments, radius)])
    celled = distinct.select("fp", _cell(segments, radius).alias("cell"))
    sizes = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    sizes = materialise(sizes, "cells")
    tiles = celled.join(sizes, "cell").withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    tiles = materialise(tiles.groupBy("cell", "tile").agg(F.array_sort(F.collect_list("fp")).alias("fps")), "tiles")
    # a tile goes to every tile of the cells around, its own and later ones of its own cell included
    sent = tiles.select(F.col("cell").alias("home"), F.col("tile").alias("mine"), F.col("fps").alias("left"), F.explode(moves).alias("move"))
    sent = sent.withColumn("cell", F.col("home") + F.col("move")).join(sizes, "cell")
    sent = sent.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    sent = sent.where((F.col("move") != 0) | (F.col("mine") <= F.col("tile")))
    pairs = sent.join(tiles, ["cell", "tile"])
    same = (F.col("move") == 0) & (F.col("mine") == F.col("tile"))
    return pairs.select("left", "fps", same.alias("same")).mapInArrow(_compare(radius), "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of ``edges`` (a, b); root is the same within a component.

    Each round every node joins its least neighbour and the edges between
    joined nodes go on; the rounds' tables are written, and read back in
    reverse to name the roots. No node's neighbours meet in one task other
    than as partial minima.
    """
    rounds: list[DataFrame] = []
    edges = materialise(edges.where("a != b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        parents = materialise(parents.select("node", F.least("node", "b").alias("up")), "parents")
        rounds.append(parents)
        one = parents.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        two = parents.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        joined = edges.join(one, "a").join(two, "b").where("ua != ub")
        edges = materialise(joined.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds.pop().withColumnRenamed("up", "root")
    while rounds:
        above = found.select(F.col("node").alias("up"), "root")
        found = rounds.pop().join(above, "up", "left").select("node", F.coalesce("root", "up").alias("root"))
    return found


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
    segments: int | None = None,
) -> DataFrame:
    """(doc_id, fp, component_id, copies): the group of each row under links of ``radius`` bits or fewer.

    component_id is the least id that links reach, the row's own included;
    copies is the number of rows of the group. Equal fingerprints are brought
    together first, so a group of copies is one entry from there on. Null and
    empty texts have fingerprint zero and are linked like any other; rows with
    a null id belong to their group and do not name it (a group of such rows
    alone has a null component_id); repeated rows are returned repeated.
    """
    rows = materialise(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    groups, _ = _groups(rows, radius, segments)
    return rows.join(groups, "fp").select("doc_id", "fp", "component_id", "copies")


def _groups(rows: DataFrame, radius: int, segments: int | None) -> tuple[DataFrame, DataFrame]:
    """Of (doc_id, fp) rows: the group of each fingerprint, and (doc_id, fp) of one row of each group."""
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    distinct = materialise(distinct, "distinct")
    roots = materialise(components(links(distinct, radius, segments)), "roots")
    named = distinct.join(roots, distinct.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    order = F.struct(F.col("first").isNull(), "first", "fp")
    groups = named.groupBy("root").agg(
        F.min("first").alias("component_id"), F.sum("n").alias("copies"), F.min_by("fp", order).alias("leader")
    )
    groups = materialise(groups, "groups")
    found = named.select("fp", "root").join(groups, "root").select("fp", "component_id", "copies")
    return found, groups.select(F.col("component_id").alias("doc_id"), F.col("leader").alias("fp"))


def _key(column: Column) -> Column:
    """An id as text that a null one has too, so that it can be joined on."""
    return F.coalesce(F.concat(F.lit("i"), column.cast("string")), F.lit("n"))


def keep_one(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
    segments: int | None = None,
) -> DataFrame:
    """The rows of ``df``, with their columns, of which each group keeps one.

    It is the row with the least id, nulls last. Of rows that repeat its id and
    fingerprint one stays.
    """
    rows = materialise(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    _, kept = _groups(rows, radius, segments)
    kept = kept.select(_key(F.col("doc_id")).alias("key"), "fp")
    whole = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        _key(F.col(id_col)).alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    printed = per_text(whole, {"fp": "bigint"}, lambda: lambda raw: (fingerprint(raw, shingle),))
    return printed.join(kept, ["key", "fp"], "left_semi").dropDuplicates(["key", "fp"]).select("row.*")
