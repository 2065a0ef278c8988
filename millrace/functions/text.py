"""Text functions as column expressions.

White space has its ASCII meaning throughout, as in the regular expressions of
the JVM.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.plans.layout import byte_slices

URL = r"https?://[a-z!$-_]+"  # the range $-_ holds digits, capitals and most punctuation
# a run without blanks goes whole if an @ stands inside; tried at the start of a run only, so linear in its length
EMAIL = r"(?<!\S)\S+@\S+"

# fixed values: names of keys
SECRET_KEYS = ("password", "api_key", "token")

# fixed values: words that mark English text
ENGLISH_WORDS = ("the", "a", "an", "and", "or", "but", "in", "on", "at")

# fixed values: contraction and expansion, applied in this order
CONTRACTIONS = {
    "don't": "do not", "doesn't": "does not", "didn't": "did not", "can't": "cannot",
    "won't": "will not", "shouldn't": "should not", "wouldn't": "would not",
    "couldn't": "could not", "isn't": "is not", "aren't": "are not", "wasn't": "was not",
    "weren't": "were not", "haven't": "have not", "hasn't": "has not", "hadn't": "had not",
    "it's": "it is", "that's": "that is", "what's": "what is", "there's": "there is",
    "i'm": "i am", "you're": "you are", "we're": "we are", "they're": "they are",
    "i've": "i have", "you've": "you have", "we've": "we have", "they've": "they have",
    "i'll": "i will", "you'll": "you will", "we'll": "we will", "they'll": "they will",
}


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def clean_whitespace(text: Column, lower: bool = False) -> Column:
    out = F.regexp_replace(text, " +", " ")
    out = strip(F.regexp_replace(out, r"\n\n+", "\n\n"))
    return F.lower(out) if lower else out


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "")


def remove_emails(text: Column) -> Column:
    return F.regexp_replace(text, EMAIL, "")


def clean_text(text: Column, lower: bool = False) -> Column:
    return clean_whitespace(remove_emails(remove_urls(text)), lower)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def text_metadata(text: Column) -> dict[str, Column]:
    common = F.array(*[F.lit(w) for w in ENGLISH_WORDS])
    lowered = words(F.lower(text))
    hits = F.size(F.filter(lowered, lambda w: F.array_contains(common, w)))
    return {
        "char_count": F.length(text),
        "word_count": F.size(words(text)),
        "line_count": F.regexp_count(text, F.lit("\n")) + 1,
        "sentence_count": F.regexp_count(text, F.lit("[.!?]+")),
        "likely_english": F.try_divide(hits.cast("double"), F.size(lowered).cast("double")) > 0.05,
    }


def _by_slices(each: Callable[[str], str]):
    """Column function that applies ``each`` to texts, a bounded size of them at a time; null stays null."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for whole in batches:
            if not len(whole):
                yield pa.array([], pa.string())
            for batch in byte_slices(pa.RecordBatch.from_arrays([whole], ["text"]), 0, size=1 << 20):
                yield pa.array([None if t is None else each(t) for t in batch.column(0).to_pylist()], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, StringType())


def _bare(text: str) -> str:
    if text.isascii():
        return text
    parted = unicodedata.normalize("NFD", text)
    return parted.translate({ord(c): None for c in set(parted) if unicodedata.category(c) == "Mn"})


nfkc = _by_slices(lambda text: text if text.isascii() else unicodedata.normalize("NFKC", text))
remove_accents = _by_slices(_bare)


def expand_contractions(text: Column) -> Column:
    """Every entry in order, any case, no word boundary, lower-case expansion.

    No entry holds a blank, so only pieces with an apostrophe are searched.
    """

    def expand(piece: Column) -> Column:
        for short, long in CONTRACTIONS.items():
            piece = F.regexp_replace(piece, f"(?i){short}", long)
        return piece

    pieces = F.split(text, r"(?<=\s)")
    return F.array_join(F.transform(pieces, lambda p: F.when(F.contains(p, F.lit("'")), expand(p)).otherwise(p)), "")


def redact_secrets(text: Column) -> Column:
    for key in SECRET_KEYS:
        text = F.regexp_replace(text, rf"{key}=\S+", f"{key}=[REDACTED]")
    return text


def mask_connection(text: Column) -> Column:
    """Hides everything from the first colon to the at sign, the user name included."""
    return F.regexp_replace(text, ":([^@]+)@", ":***@")


# fixed values: shape of a log line and of the request fields in its message
LOG_LINE = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?Z?) \[([A-Za-z]+)\] (.*)$"
REQUEST = r"request_id=([0-9a-fA-F-]{36}) endpoint=(/[^ ]*) duration=([0-9.]+)"


def parse_log_line(line: Column) -> dict[str, Column]:
    group = lambda src, pattern, i: F.nullif(F.regexp_extract(src, pattern, i), F.lit(""))
    message = group(line, LOG_LINE, 3)
    return {
        "timestamp": group(line, LOG_LINE, 1),
        "log_level": group(line, LOG_LINE, 2),
        "log_message": message,
        "request_id": group(message, REQUEST, 1),
        "endpoint": group(message, REQUEST, 2),
        "duration_ms": group(message, REQUEST, 3).try_cast("double"),
    }


def chat_prompt(history: Column, message: Column) -> Column:
    return F.concat(history, F.lit("\n\nHuman: "), message, F.lit("\n\nAssistant:"))


# fixed values: system text of the retrieval prompt
RAG_SYSTEM = (
    "You are a helpful assistant. Answer the question based on the provided context. "
    "If the answer cannot be found in the context, say so."
)

# fixed values: prompt templates; names in braces are filled from columns
TEMPLATES = {
    "completion": "{prompt}",
    "rag": "Context:\n{context}\n\nQuestion: {query}\n\nAnswer:",
    "chat": "{chat_history}\n\nHuman: {message}\n\nAssistant:",
    "code": "Task: {task}\n\nRequirements:\n{requirements}\n\nCode:",
    "summarize": "Summarize the following text:\n\n{text}\n\nSummary:",
}


def fill_template(template: str, **values: Column) -> Column:
    """``template`` with each ``{name}`` replaced by its column."""
    import string

    parts = []
    for literal, field, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field:
            parts.append(values[field])
    return F.concat(*parts)


def rag_prompt(query: Column, context: Column, system: str = RAG_SYSTEM) -> Column:
    return F.concat(F.lit(system + "\n\n"), fill_template(TEMPLATES["rag"], context=context, query=query))


def parse_json_line(message: Column, schema: str) -> Column:
    """Struct of a message that looks like one JSON object, null otherwise."""
    return F.when(message.rlike(r"^\{.*\}$"), F.from_json(message, schema))
