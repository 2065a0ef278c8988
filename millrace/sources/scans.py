"""Scans: files, listings, queries and document loaders.

Every scan takes its schema; nothing is inferred.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from itertools import islice
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DOCUMENT = "path string, doc_id string, text string, metadata map<string,string>, error string"


def csv_scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def json_records(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=not lines)


def sql_source(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Rows of a query over the given tables, named as in the text."""
    return spark.sql(sql, **tables)


def jdbc_source(
    spark: SparkSession, url: str, query: str, column: str, lower: int, upper: int, partitions: int, **options: str
) -> DataFrame:
    """The same from a database, read in parallel ranges of ``column``."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
    reader = reader.options(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions)
    return reader.options(**options).load()


def object_listing(spark: SparkSession, path: str, etag: bool = False) -> DataFrame:
    """Key, size and modification time; the content is read only for an ``etag``, its MD5."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    tag = [F.md5("content").alias("etag")] if etag else []
    return files.select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"), *tag)


# -- documents -------------------------------------------------------------------


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _stem(path: Column) -> Column:
    return F.regexp_replace(_name(path), r"\.[^.]*$", "")


def valid_text(content: Column) -> Column:
    """UTF-8 text with undecodable bytes dropped."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "�", "")


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )
    return files.select(
        "path", _stem(F.col("path")).alias("doc_id"), valid_text(F.col("text")).alias("text"),
        F.create_map(F.lit("source"), F.col("path"), F.lit("filename"), _name(F.col("path")), F.lit("file_type"), F.lit("text")).alias("metadata"),
    )


class _Page(HTMLParser):
    """Text outside script and style, and the title."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text, self.title, self.skip, self.in_title = [], None, 0, False

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        self.in_title = tag == "title" or self.in_title

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style") and self.skip > 0
        self.in_title = self.in_title and tag != "title"

    def handle_data(self, data):
        if self.skip:
            return
        if self.in_title:
            self.title = (self.title or "") + data
        if data.strip():
            self.text.append(data.strip())


def page_text(html: str) -> tuple[str, str | None]:
    page = _Page()
    page.feed(html)
    page.close()
    return "\n".join(page.text), page.title


def html_documents(pages: DataFrame, key: str, html: str, fallback_title: Column) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parsed = [page_text(h) for h in b[html]]
            titles = [t if t is not None else f for (_, t), f in zip(parsed, b["_fallback"])]
            yield pd.DataFrame({key: b[key], "title": titles, "text": [p[0] for p in parsed]})

    kind = dict(pages.dtypes)[key]
    rows = pages.select(key, html, fallback_title.alias("_fallback"))
    return rows.mapInPandas(run, f"{key} {kind}, title string, text string")


def html_documents_regex(html: Column) -> dict[str, Column]:
    """Title and text by patterns, without entity decoding; stays in the JVM."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", "")
    text = F.regexp_replace(F.regexp_replace(bare, r"(?s)<!--.*?-->", ""), r"<[^>]*>", "\n")
    lines = F.regexp_replace(F.regexp_replace(text, r"[ \t]*\n\s*", "\n"), r"^\s+|\s+$", "")
    return {"title": F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1), "text": lines}


def markdown_title(text: Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(text, r"(?m)^# (.*)$", 1), F.lit("")), fallback)


def csv_row_documents(df: DataFrame, stem: str, row_number: Column, text_column: str | None = None) -> DataFrame:
    """One document per row; all columns stay in the metadata."""
    joined = F.concat_ws(" | ", *[F.concat(F.lit(f"{c}: "), F.col(c).cast("string")) for c in df.columns])
    text = F.col(text_column) if text_column in df.columns else joined
    keep = F.map_concat(
        F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(c).cast("string"))]),
        F.create_map(F.lit("row_number"), row_number.cast("string")),
    )
    return df.select(F.concat(F.lit(f"{stem}_"), row_number).alias("doc_id"), text.alias("text"), keep.alias("metadata"))


def json_items(records: Column) -> Column:
    """The objects of a column whose values are one JSON object or a list of them, as an array to explode."""
    listed = F.from_json(records, "array<string>")
    return F.when(F.ltrim(records).startswith("["), listed).otherwise(F.array(records))


def json_documents(records: Column, text_key: str) -> dict[str, Column]:
    """Text and metadata of one JSON object; the whole object is the text when the key is absent."""
    fields = F.from_json(records, "map<string,string>")
    return {
        "text": F.coalesce(F.try_element_at(fields, F.lit(text_key)), records),
        "metadata": F.map_filter(fields, lambda k, v: k != text_key),
    }


Loader = Callable[[str], Iterable[tuple[str | None, str, dict[str, str]]]]


def _lines(text: str) -> Iterator[str]:
    """The lines of a text with their ends, without a second copy of it."""
    at = 0
    while at < len(text):
        end = text.find("\n", at) + 1 or len(text)
        yield text[at:end]
        at = end


def _load_csv(text: str):
    for i, row in enumerate(csv.DictReader(_lines(text))):
        yield str(i), row.get("text") or " | ".join(f"{k}: {v}" for k, v in row.items()), {**row, "row_number": str(i)}


def _load_json(text: str):
    data = json.loads(text)
    for i, item in enumerate(data if isinstance(data, list) else [data]):
        if isinstance(item, dict):
            rest = {k: str(x) for k, x in item.items() if k != "text"}
            yield str(i) if isinstance(data, list) else None, str(item.get("text", item)), rest
        else:
            yield str(i), str(item), {}


def _load_html(text: str):
    body, title = page_text(text)
    yield None, body, {"title": title} if title else {}


def _load_text(text: str):
    yield None, text, {}


def _load_markdown(text: str):
    title = next((line[2:].strip() for line in text.split("\n") if line.startswith("# ")), None)
    yield None, text, {"title": title} if title else {}


LOADERS: dict[str, Loader] = {
    ".txt": _load_text, ".md": _load_markdown, ".html": _load_html, ".htm": _load_html, ".csv": _load_csv, ".json": _load_json,
}


def load_directory(
    spark: SparkSession, path: str, glob: str = "*", exclude: Sequence[str] = (), loaders: dict[str, Loader] | None = None
) -> DataFrame:
    """Documents of all files with a known suffix; a failing file gives a row with ``error``.

    Plain text, a file of which is one document, is decoded without Python if it
    is valid. Of other files a task holds one text and ``LOADED`` of its
    documents at a time: a file with more is gone through once to see that it
    does not fail, and a second time for its documents.
    """
    loaders = loaders or LOADERS
    # conditions on the names alone, so that each file is read by one of the scans only
    name = F.col("_metadata.file_path")
    suffix = F.lower(F.concat(F.lit("."), F.element_at(F.split(_name(name), r"\."), -1)))
    plain = [kind for kind, loader in loaders.items() if loader is _load_text]
    parsed = [kind for kind in loaders if kind not in plain]

    def files(kinds: list[str]) -> DataFrame:
        wanted = suffix.isin(*kinds)
        for part in exclude:
            wanted = wanted & ~F.col("path").contains(part)
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
        return found.where(wanted).select("path", suffix.alias("suffix"), _stem(F.col("path")).alias("stem"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def made(p, kind, stem, found):
            rows = [(p, stem if i is None else f"{stem}_{i}", text, {"source": p, "file_type": kind[1:], **meta}, None) for i, text, meta in found]
            return pd.DataFrame(rows, columns=["path", "doc_id", "text", "metadata", "error"])

        for b in batches:
            for p, kind, stem, content in zip(b["path"], b["suffix"], b["stem"], b["content"]):
                try:
                    text = str(content, "utf-8", "ignore")
                    found = iter(loaders[kind](text))
                    out, more = made(p, kind, stem, islice(found, LOADED)), 0
                    for _ in found:
                        more += 1
                except Exception as exc:
                    error = f"{type(exc).__name__}: {exc}"
                    out, more = pd.DataFrame([(p, stem, None, None, error)], columns=["path", "doc_id", "text", "metadata", "error"]), 0
                yield out
                if more:
                    found = islice(loaders[kind](text), LOADED, None)
                    while len(out := made(p, kind, stem, islice(found, LOADED))):
                        yield out

    whole, valid = files(plain), F.is_valid_utf8(F.col("content").cast("string"))
    text = F.coalesce(F.when(valid, F.col("content").cast("string")), _decoded(F.when(~valid, F.col("content"))))
    about = F.create_map(F.lit("source"), F.col("path"), F.lit("file_type"), F.substring("suffix", 2, 1 << 20))
    texts = whole.select("path", F.col("stem").alias("doc_id"), text.alias("text"), about.alias("metadata"), F.lit(None).cast("string").alias("error"))
    return texts.unionByName(files(parsed).mapInPandas(run, DOCUMENT))


#: documents of one file that a task hands on together
LOADED = 1024


@F.arrow_udf(StringType())
def _decoded(content: pa.Array) -> pa.Array:
    """UTF-8 text with undecodable bytes dropped, as the decoder of Python drops them."""
    return pa.array([None if not c.is_valid else str(c.as_buffer(), "utf-8", "ignore") for c in content], pa.string())


# -- recorded files -----------------------------------------------------------------

# fixed values: words that turn a topic into a flag, and the shape of a robot name
FLAG_WORDS = ("anomaly", "collision", "overcurrent", "critical")
ROBOT_NAME = r"^[a-z0-9][a-z0-9\-]{2,}$"


def parse_object_name(name: Column) -> dict[str, Column]:
    """Fields encoded in an object path; anything unreadable takes its default."""
    segments = F.split(name, "/")
    base = F.regexp_replace(F.element_at(segments, -1), r"\.mcap(\.zst)?", "")
    parts = F.split(base, "_")
    deep = F.size(segments) == 5
    part = lambda i: F.when(F.size(parts) > i, F.get(parts, F.lit(i)))
    number = part(3).isNull() | F.regexp_replace(part(3), "p", "").try_cast("int").isNotNull()
    priority = F.coalesce(F.regexp_replace(part(3), "p", "").try_cast("int"), F.lit(3))
    # an unreadable priority ends the parse, so topic and time keep their defaults too
    topic = F.when(number, part(4))
    flagged = reduce(lambda a, b: a | b, [F.contains(topic, F.lit(w)) for w in FLAG_WORDS])
    robot = F.when(deep, F.get(segments, F.lit(2))).when(F.get(parts, F.lit(0)).rlike(ROBOT_NAME), F.get(parts, F.lit(0)))
    session = F.when(deep, F.get(segments, F.lit(3))).otherwise(part(2))
    return {
        "robot_id": F.coalesce(F.nullif(robot, F.lit("")), F.lit("unknown")),
        "session_id": F.coalesce(F.nullif(session, F.lit("")), F.lit("unknown")),
        "priority": priority,
        "data_type": F.coalesce(topic, F.lit("unknown")),
        "anomaly_flags": F.when(flagged, F.array(topic)).otherwise(F.array().cast("array<string>")),
        "start_ms": F.when(number, part(1).try_cast("bigint")),
    }


def merge_metadata(name: Column, blob: Column, trailer: Column) -> dict[str, Column]:
    """Trailer fields win over blob metadata, which wins over the file name.

    The trailer counts only when its first JSON object names a session or robot.
    """
    fields = F.from_json(F.regexp_extract(trailer, r"(\{[^{}]*\})", 1), "map<string,string>")
    known = F.map_contains_key(fields, "session_id") | F.map_contains_key(fields, "robot_id")
    fields = F.when(known, fields)
    out = {}
    for key, parsed in parse_object_name(name).items():
        if key in ("robot_id", "session_id", "data_type"):
            pick = lambda m: F.try_element_at(m, F.lit(key))
            out[key] = F.coalesce(pick(fields), pick(blob), parsed)
    return out


def billing_scan(billing: DataFrame, start: str, end: str) -> DataFrame:
    """Cost per service, region and currency in a time range, positive sums only."""
    bound = lambda t: F.lit(t).cast("timestamp_ntz")
    inside = billing.where((F.col("ts") >= bound(start)) & (F.col("ts") <= bound(end)))
    return (
        inside.groupBy("service", F.coalesce("region", F.lit("global")).alias("region"), "currency")
        .agg(F.sum("amount").alias("amount"))
        .where("amount > 0")
    )


def metric_log(spark: SparkSession, path: str, metrics: Sequence[str]) -> DataFrame:
    """JSON lines of {metric: value, ..., step, timestamp} as (step, timestamp, name, value)."""
    schema = ", ".join(f"{m} double" for m in metrics) + ", step bigint, timestamp double"
    wide = spark.read.schema(schema).json(path)
    return wide.unpivot(["step", "timestamp"], list(metrics), "name", "value").where("value is not null")


def with_embeddings(docs: DataFrame, embedding: str, embed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Embed only rows that arrive without a vector; drop those still without one."""
    ready = docs.where(F.col(embedding).isNotNull())
    filled = embed(docs.where(F.col(embedding).isNull()))
    return ready.unionByName(filled).where(F.col(embedding).isNotNull())
