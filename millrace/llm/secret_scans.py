"""Secret scans: candidates in texts and a random forest that removes false ones."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import narrow, per_text
from millrace.plans.layout import byte_slices
from millrace.session import materialise

#: a run of key characters with a digit, or what is assigned to a credential's name
CANDIDATE = re.compile(
    # a name begins where its run of letters, digits, - and _ does, so that a long run is tried once
    r"(?i:(?<![A-Za-z0-9_-])(?:[a-z0-9]*[_-])*(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credentials?))"
    r"[\"']?\s{0,3}(?::=|=>|[:=])\s{0,3}[\"'`]?(?P<assigned>[^\s\"'`,;<>]{6,})"
    r"|(?<![A-Za-z0-9+/_=-])(?P<bare>(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+)(?![A-Za-z0-9+/_=-])"
)
#: words that name a credential
NAMES = re.compile(r"(?i)token|secret|passw|pwd|key|auth|credential|bearer")
#: keys that their provider's format tells
PROVIDERS = re.compile(
    r"A(?:KIA|SIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_\w{22,}|glpat-[\w-]{20,}|npm_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}|sk-[A-Za-z0-9_-]{20,}|AIza[\w-]{35}|hf_[A-Za-z0-9]{30,}|SG\.[\w-]{16,}(?:\.[\w-]{16,})?"
)
#: characters around a candidate that count as its neighbours
AROUND = 40
FEATURES = [
    "length", "transitions", "digits", "lower", "upper", "others", "entropy", "hex", "coverage", "slashes", "dots",
    "in_path", "named", "assigned", "quoted", "words_before", "words_after",
]


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of every candidate, in order."""
    return [m.span(m.lastgroup) for m in CANDIDATE.finditer(text)]


def _class(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def describe(candidate: str, before: str, after: str, path: str, words: frozenset[str]) -> list[float]:
    """The forest's inputs: length, character transitions, dictionary coverage, path, neighbouring words."""
    n = len(candidate) or 1
    kinds = [_class(c) for c in candidate]
    found = Counter(candidate)
    runs = re.findall(r"[^\W\d_]{3,}", candidate.lower())
    covered = sum(len(r) for r in runs if r in words)
    beside = re.findall(r"[^\W\d_]+", before.lower())[-3:], re.findall(r"[^\W\d_]+", after.lower())[:3]
    return [
        float(n),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        *(kinds.count(k) / n for k in range(4)),
        -sum(v / n * math.log2(v / n) for v in found.values()),
        sum(c in "0123456789abcdefABCDEF" for c in candidate) / n,
        covered / n,
        candidate.count("/") / n,
        candidate.count(".") / n,
        float(bool(re.search(r"(?i)secret|cred|config|env|key", path))),
        float(bool(NAMES.search(before[-24:]))),
        float(bool(re.search(r"[:=]\s*[\"'`]?$", before))),
        float(before[-1:] in ("'", '"', "`") and before[-1:] == after[:1]),
        sum(w in words for w in beside[0]) / 3,
        sum(w in words for w in beside[1]) / 3,
    ]


@dataclass(frozen=True)
class SecretModel:
    """Trees as arrays: feature, threshold, left, right, and the chance of a secret at leaves."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    words: frozenset[str]

    def probability(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        here = np.arange(len(rows))
        for feature, threshold, left, right, chance in self.trees:
            node = np.zeros(len(rows), np.int64)
            while (open_ := feature[node] >= 0).any():
                f = np.maximum(feature[node], 0)
                step = np.where(rows[here, f] <= threshold[node], left[node], right[node])
                node = np.where(open_, step, node)
            total += chance[node]
        return total / max(1, len(self.trees))


def _arrays(tree) -> tuple[np.ndarray, ...]:
    """The nodes of a fitted tree, the root first."""
    rows: list[list[float]] = []

    def walk(node) -> int:
        at = len(rows)
        rows.append([-1, 0.0, 0, 0, 0.0])
        if node.subtreeDepth() == 0:
            stats = node.impurityStats().stats()
            values = [float(x) for x in stats]
            rows[at][4] = values[1] / max(sum(values), 1e-12) if len(values) > 1 else 0.0
        else:
            split = node.split()
            rows[at][0], rows[at][1] = split.featureIndex(), split.threshold()
            rows[at][2], rows[at][3] = walk(node.leftChild()), walk(node.rightChild())
        return at

    walk(tree._java_obj.rootNode())
    columns = list(zip(*rows))
    return tuple(np.array(c, float if i in (1, 4) else np.int64) for i, c in enumerate(columns))


def dictionary(words: DataFrame, near: DataFrame, least: int = 2) -> frozenset[str]:
    """Words that stand in ``least`` of all texts or more, of those in ``near``.

    ``words`` holds (word, n), a word in as many rows as parts of the texts have
    it, with ``n`` texts each. ``near`` holds the words (word) that ``describe``
    looks up for any candidate of the texts; it never asks for others, so the
    answers are those of the whole dictionary.
    """
    common = words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return frozenset(common.join(near.distinct(), "word", "left_semi").select("word").toArrow()["word"].to_pylist())


#: findings of a task that fits the forest
FITTED = 20_000


def train(findings: DataFrame, words: frozenset[str], trees: int = 20, depth: int = 6, seed: int = 7) -> SecretModel:
    """Fit on all labelled findings (candidate, before, after, path, label).

    Rows with a null label are not used, other nulls count as empty. The trees
    may split where quantiles of all findings lie, 31 for each input. Findings
    of one label only give a model without trees that takes nothing for a
    secret, or all for label 1.
    """
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("candidate", "before", "after", "path")]
    rows = findings.where("label is not null").select(F.col("label").cast("double").alias("label"), F.struct(*text).alias("value"))

    def described():
        return lambda r: ([float(v) for v in describe(r["candidate"], r["before"], r["after"], r["path"], words)],)

    rows = materialise(per_text(rows, {"values": "array<double>"}, described), "described")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        share = next(iter(counts), 0.0)
        leaf = (np.array([-1]), np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([share]))
        return SecretModel([leaf], words)
    each = rows.select(*[F.col("values")[i].alias(f) for i, f in enumerate(FEATURES)])
    cuts = [np.unique(c) for c in each.approxQuantile(FEATURES, [i / 32 for i in range(1, 32)], 0.001)]

    def binned():
        return lambda values: ([float(np.searchsorted(c, v)) for c, v in zip(cuts, values)],)

    # equal rows are numbered, so that a rerun deals them the same way and many copies go to many tasks
    equal = per_text(rows, {"bins": "array<double>"}, binned).groupBy("label", "bins").agg(F.count(F.lit(1)).alias("n"))
    dealt = equal.select("label", "bins", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("n"))
    dealt = dealt.repartition(-(-total // FITTED), "label", "bins", "n").sortWithinPartitions("label", "bins", "n")
    df = dealt.select("label", array_to_vector("bins").alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(df)

    def measured(tree) -> tuple[np.ndarray, ...]:
        feature, threshold, *rest = _arrays(tree)
        # numbers of bins back to values: a value is in a bin up to n if it is not above cut n
        at = [cuts[f][min(int(t), len(cuts[f]) - 1)] if f >= 0 else 0.0 for f, t in zip(feature, threshold)]
        return feature, np.array(at), *rest

    return SecretModel([measured(t) for t in forest.trees], words)


def _label(found: str, before: str) -> int | None:
    kinds = [_class(c) for c in found]
    turns = sum(x != y for x, y in zip(kinds, kinds[1:]))
    mixed = 0 in kinds and (1 in kinds or 2 in kinds)
    named = bool(re.search(r"[:=]\s*[\"'`]?$", before)) and bool(NAMES.search(before[-24:]))
    if PROVIDERS.fullmatch(found) or (named and mixed and turns >= 2):
        return 1
    return 0 if not named and (not mixed or turns < len(found) / 4) else None


def _looked_up(candidate: str, before: str, after: str) -> list[str]:
    """The words that ``describe`` looks up in the dictionary."""
    beside = re.findall(r"[^\W\d_]+", before.lower())[-3:] + re.findall(r"[^\W\d_]+", after.lower())[:3]
    return re.findall(r"[^\W\d_]{3,}", candidate.lower()) + beside


#: words that a task counts before it hands on the counts
COUNTED = 1 << 17


def _findings(df: DataFrame, id_col: str, text_col: str, path_col: str) -> DataFrame:
    """(doc_id, path, found, near, word, n): findings, and the words of all texts.

    A text with a candidate has a row with its findings and the words looked up
    for them. Rows of their own, with null elsewhere, tell in how many texts a
    word stands, with a candidate or without; a word has one for each part of
    the texts that is counted at once.
    """
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    fields = "found array<struct<candidate:string,before:string,after:string,label:int>>, near array<string>, word string, n bigint"
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.schema.fields[:-1]), *T._parse_datatype_string(fields)])

    def each(text):
        out = []
        for a, b in candidates(text):
            found, before, after = text[a:b], text[max(0, a - AROUND) : a], text[b : b + AROUND]
            label = _label(found, before)
            out.append((found, before, after, label))
            if label:
                plain = re.findall(r"[^\W\d_]{4,}", after + before)
                out += [((plain or ["example"])[0], before, after, 0), (re.sub(r"\D", "0", found)[:16], "", "", 0)]
                out += [(found, "", "", 1)] if len(found) >= 16 else []
        near = {w for c, x, y, _ in out for w in _looked_up(c, x, y)}
        return [{"candidate": c, "before": x, "after": y, "label": v} for c, x, y, v in out], list(near)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out, counts = to_arrow_schema(schema), Counter()

        def made(n, *columns, at=0):
            """A batch of ``n`` rows with ``columns`` from column ``at`` on, the others null."""
            given = dict(enumerate(columns, at))
            return pa.RecordBatch.from_arrays(
                [pa.array(given[i], f.type) if i in given else pa.nulls(n, f.type) for i, f in enumerate(out)], schema=out
            )

        def counted():
            words, n = list(counts), list(counts.values())
            counts.clear()
            for first in range(0, len(words), 16_384):
                part = slice(first, first + 16_384)
                yield made(len(words[part]), words[part], n[part], at=4)

        for whole in batches:
            for batch in byte_slices(whole, 2, size=4 << 20):
                held = []
                for i, text in enumerate(batch.column(2).to_pylist()):
                    counts.update(set(re.findall(r"[^\W\d_]{2,}", text.lower())))
                    found, near = each(text)
                    if found:
                        held.append((i, found, near))
                if held:
                    at, found, near = zip(*held)
                    ids, paths = (batch.column(i).take(pa.array(at)).cast(out.field(i).type) for i in (0, 1))
                    yield made(len(at), ids, paths, found, near)
                if len(counts) >= COUNTED:
                    yield from counted()
        yield from counted()

    return rows.mapInArrow(run, schema)


def labelled_findings(df: DataFrame, id_col: str, text_col: str, path_col: str) -> DataFrame:
    """Findings labelled by rule, for corpora that bring no reviewed ones.

    Label 1: a provider's key format, or assigned to a credential's name with
    letters and digits in turn, whatever the length. Label 0: neither, and
    without letters or with few turns. All others, such as a name's value of
    one kind of characters or a mixed run without a name, are ambiguous and get
    no label. Each label 1 of 16 characters or more appears a second time
    without its neighbours, so that the characters count as well; each label 1
    also with a dictionary-like and a numeric value in its place as label 0.
    """
    return _exploded(_findings(df, id_col, text_col, path_col))


def _exploded(found: DataFrame) -> DataFrame:
    return found.where("found is not null").select("path", F.explode("found").alias("f")).select("f.*", "path")


def _spans(text: str, path: str, model: SecretModel, least: float) -> tuple[int, list[tuple[int, int]]]:
    """The number of candidates and the spans of those that the forest takes for secrets."""
    found = candidates(text)
    if not found:
        return 0, []
    rows = [
        describe(text[a:b], text[max(0, a - AROUND) : a], text[b : b + AROUND], path, model.words) for a, b in found
    ]
    keep = model.probability(np.array(rows)) >= least
    return len(found), [s for s, k in zip(found, keep) if k]


def scan(
    df: DataFrame, model: SecretModel, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", least: float = 0.5
) -> DataFrame:
    """(doc_id, n_candidates, n_secrets, spans) of every row; spans are [start, end) in code points.

    Whole texts are searched. A null or empty text has no candidates, a null
    path counts as empty, a null id stays null, repeated rows are returned
    repeated, other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), F.struct(text.alias("text"), path.alias("path")).alias("value"))

    def work():
        def each(value):
            n, spans = _spans(value["text"], value["path"], model, least)
            return n, len(spans), [list(s) for s in spans]

        return each

    return per_text(rows, {"n_candidates": "bigint", "n_secrets": "bigint", "spans": "array<array<bigint>>"}, work)


def redact(
    df: DataFrame, model: SecretModel, text_col: str = "text", path_col: str = "source", mark: str = "[SECRET]", least: float = 0.5
) -> DataFrame:
    """The rows of ``df``, with their columns, and ``mark`` in place of each secret."""

    def clean(text: str | None, path) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for a, b in _spans(text, str(path or ""), model, least)[1]:
            out += [text[at:a], mark]
            at = b
        return "".join([*out, text[at:]]) if out else text

    def run(batches):
        for whole in batches:
            place = whole.schema.get_field_index(text_col)
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                paths = batch.column(batch.schema.get_field_index(path_col)).to_pylist()
                texts = [clean(t, p) for t, p in zip(batch.column(place).to_pylist(), paths)]
                yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return df.mapInArrow(run, df.schema)


def train_on(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> SecretModel:
    """Label by rule the findings of all texts with a candidate, and fit on them.

    The dictionary has the words that stand in two texts or more, with a
    candidate or without, of those looked up for a candidate of ``df``: it
    grows with the words in and beside candidates, not with the texts. The
    model is for the texts of ``df``.
    """
    found = materialise(_findings(df, id_col, text_col, path_col), "findings")
    near = found.where("near is not null").select(F.explode("near").alias("word"))
    return train(_exploded(found), dictionary(found.where("word is not null").select("word", "n"), near))
