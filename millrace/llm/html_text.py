"""Main text of web pages: blocks of the markup, less what the page with the nearest URL shares."""

from __future__ import annotations

import html
import re

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import per_text
from millrace.llm.ngrams import word_hashes
from millrace.session import materialise

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?i)(?<![\w-])(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?![\w-])")
#: elements whose content is no text of the page
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
_BARE = {"nav", "aside", "footer", "form", "button", "select", "dialog", "menu", "svg", "object", "canvas", "head", "fieldset"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
#: words of class and id values that name what is no main text
_WORDS = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert(?:s|isement|ising)?|adsense|adslot|sponsor(?:ed|s)?|promo(?:tion|s)?|nav(?:bar|igation)?|menus?|"
    r"side-?bar|aside|foot(?:er)?|masthead|top-?bar|site-?header|page-?header|bread-?crumbs?|cookies?|consent|gdpr|notices?|alerts?|banners?|"
    r"pop-?up|modal|overlay|newsletter|subscri(?:be|ption)|sign-?up|share|sharing|social|related|recommended|comments?|replies|reply|respond|"
    r"disqus|discussion|widget|pager|pagination|toolbar|skip-?link|hidden|sr-only)(?:$|[\s_-])"
)
#: paragraphs, table cells and list items end where the next one starts
_CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}


def _is_boilerplate(name: str, attrs: str, in_article: bool) -> bool:
    if name in _BARE or (name == "header" and not in_article):
        return True
    if "=" not in attrs and "hidden" not in attrs:
        return False
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id") and name not in ("body", "html", "main") and _WORDS.search(value):
            return True
        if key == "role" and value.lower() in _ROLES:
            return True
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and re.search(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def blocks(page: str) -> list[tuple[str, bool, bool]]:
    """(text, in the article, in boilerplate) of every block with text, in page order.

    Character references are decoded and white space runs become one space.
    An article element inside another one, or marked as a comment, is boilerplate.
    """
    out: list[tuple[str, bool, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, article, boilerplate
    at, state = 0, (False, False)

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((text, *state))

    while at < len(page):
        open_at = page.find("<", at)
        if open_at < 0:
            parts.append(page[at:])
            break
        parts.append(page[at:open_at])
        m = _TOKEN.match(page, open_at)
        if m is None:
            parts.append("<")
            at = open_at + 1
            continue
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in _RAW and not m["end"]:
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in _INLINE or (not m["end"] and _is_boilerplate(name, m["attrs"], state[0])):
            flush()
        if m["end"]:
            if any(n == name for n, _, _ in stack):
                flush_needed = name not in _INLINE
                while stack:
                    top = stack.pop()
                    if top[0] == name:
                        break
                if flush_needed or (stack[-1][1:] if stack else (False, False)) != state:
                    flush()
                state = stack[-1][1:] if stack else (False, False)
            continue
        if name in _VOID or m["attrs"].rstrip().endswith("/") and name not in _INLINE | {"p", "div", "article"}:
            continue
        if name in _CLOSES:
            while stack and stack[-1][0] in _CLOSES[name] | _INLINE:
                # an inline element that a paragraph leaves open ends with it
                if stack[-1][0] in _INLINE and not any(n in _CLOSES[name] for n, _, _ in stack):
                    break
                stack.pop()
            state = stack[-1][1:] if stack else (False, False)
        declared = name in ("article", "main") or bool(re.search(r"(?i)articlebody|role\s*=\s*[\"']?main", m["attrs"]))
        nested = name == "article" and any(n == "article" for n, _, _ in stack)
        dropped = state[1] or nested or _is_boilerplate(name, m["attrs"], state[0])
        state = (state[0] or declared, dropped)
        stack.append((name, *state))
    flush()
    return out


def line_hashes(lines: list[str]) -> np.ndarray:
    return word_hashes([line.encode() for line in lines])


def shared_lines(mine: list[int], other: list[int]) -> list[bool]:
    """Which of ``mine`` a longest common subsequence with ``other`` aligns.

    The rows of the table of lengths are bits of whole numbers; the trace back
    reads, for each line, whether its row added to the length.
    """
    places: dict[int, int] = {}
    for j, value in enumerate(other):
        places[value] = places.get(value, 0) | (1 << j)
    full, row, rows = (1 << len(other)) - 1, (1 << len(other)) - 1, []
    for value in mine:
        found = row & places.get(value, 0)
        row = ((row + found) | (row - found)) & full
        rows.append(row)
    # a zero at bit j of row i: the length grows from j to j + 1 there
    marks, j = [False] * len(mine), len(other)
    for i in range(len(mine) - 1, -1, -1):
        while j > 0:
            zero = not rows[i] >> (j - 1) & 1
            if not zero:
                j -= 1
                continue
            above_zero = i > 0 and not rows[i - 1] >> (j - 1) & 1
            if above_zero:
                break  # the row above reaches the length as well
            marks[i] = True
            j -= 1
            break
    return marks


def main_text(found: list[tuple[str, bool, bool]], shared: list[bool]) -> str:
    """Blocks joined by empty lines: those of the article if the page declares one, else those left by both tests."""
    outside = iter(shared)
    left = [(t, a, (not a and next(outside)) or b) for t, a, b in found]
    declared = any(a and not b for _, a, b in left)
    return "\n\n".join(t for t, a, b in left if not b and (a or not declared))


def _outside(found: list[tuple[str, bool, bool]]) -> list[int]:
    """A number for each line outside the article: hash, then 15 bits of its length, then whether it is marked boilerplate."""
    lines = [(t, b) for t, a, b in found if not a]
    hashes = line_hashes([t for t, _ in lines]).view(np.int64).tolist()
    return [h >> 16 << 16 | min(len(t), 0x7FFF) << 1 | b for h, (t, b) in zip(hashes, lines)]


def _lines(values: list[int]) -> list[int]:
    return [v >> 1 for v in values]


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _path(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), r"(?:/|\.html?)$", "")


def _common(a: Column, b: Column) -> Column:
    """Steps of the paths that agree from the start."""
    one, two = F.split(a, "/"), F.split(b, "/")
    steps = F.filter(F.sequence(F.lit(1), F.least(F.size(one), F.size(two))), lambda n: F.slice(one, F.lit(1), n) == F.slice(two, F.lit(1), n))
    return F.size(steps)


def _copies(a: Column, b: Column) -> Column:
    """Whether the lines of two pages, less marked boilerplate, are the same but for a twentieth of their characters."""
    one, two = (F.array_distinct(F.filter(x, lambda v: v.bitwiseAND(1) == 0)) for x in (a, b))
    size = lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda n, v: n + F.shiftright(v.bitwiseAND(0xFFFF), 1))
    return (size(F.array_except(one, two)) + size(F.array_except(two, one))) * 20 <= size(one) + size(two)


def _with_others(df: DataFrame, order: list[str]) -> DataFrame:
    """Each row with structs ``prev`` and ``next`` (host, path, lines) of the nearest rows in ``order`` that are no copies of it.

    Copies that stand beside each other, in groups of any size, count as one
    row. As in ``with_neighbours``, what meets over all slices is one row for
    each of them.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(parts, *order).withColumn("_slice", F.spark_partition_id())
    cut = materialise(cut, "neighbours")
    beside = Window.partitionBy("_slice").orderBy(*order)
    value = F.struct("host", "path", "lines")
    over_slices = Window.orderBy("_slice")
    ends = cut.groupBy("_slice").agg(
        F.min_by(value, F.struct(*order)).alias("_first"), F.max_by(value, F.struct(*order)).alias("_last")
    )
    ends = ends.select(
        "_slice", F.lag("_last").over(over_slices).alias("_before"), F.lead("_first").over(over_slices).alias("_after")
    )
    rows = cut.select(
        "*", F.lag(value).over(beside).alias("prev"), F.lead(value).over(beside).alias("next"), F.row_number().over(beside).alias("_at")
    )
    rows = rows.join(F.broadcast(ends), "_slice").select(
        *df.columns, "_slice", "_at", F.coalesce("prev", "_before").alias("prev"), F.coalesce("next", "_after").alias("next")
    )

    def other(side: str) -> Column:
        """The row beside, where a group of copies ends; it may be null at the ends of the table."""
        same = (F.col(f"{side}.host") == F.col("host")) & _copies(F.col("lines"), F.col(f"{side}.lines"))
        return F.when(~F.coalesce(same, F.lit(False)), F.struct(F.col(side).alias("row")))

    rows = rows.withColumns({"prev": other("prev"), "next": other("next")})
    ends = rows.groupBy("_slice").agg(
        F.max_by("prev", F.when(F.col("prev").isNotNull(), F.col("_at"))).alias("_prev"),
        F.min_by("next", F.when(F.col("next").isNotNull(), F.col("_at"))).alias("_next"),
    )
    ends = ends.select(
        "_slice",
        F.last("_prev", True).over(over_slices.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.last("_next", True).over(Window.orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)).alias("_after"),
    )
    up, down = (Window.partitionBy("_slice").orderBy(o) for o in (F.col("_at"), F.desc("_at")))
    rows = rows.select(*df.columns, "_slice", F.last("prev", True).over(up).alias("prev"), F.last("next", True).over(down).alias("next"))
    # one row for each slice
    return rows.join(F.broadcast(ends), "_slice").select(
        *df.columns, F.coalesce("prev", "_before")["row"].alias("prev"), F.coalesce("next", "_after")["row"].alias("next")
    )


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    The pages of a host stand in the order of their paths; each is paired with
    the nearest before or after it that is no copy of it, by its lines, the one
    whose path agrees with its own for more steps (the one before it if both
    do). Copies beside each other, such as repeated rows, query-string variants
    and print copies, count as one page, so they do not delete each other; a
    page without any other on its host keeps its lines. The lines that stand outside the article are
    aligned with those of the partner by longest common subsequence, and
    shared ones are deleted. Elements that are boilerplate by name, role or
    class are deleted, too, and where a page declares its article, so is all
    else outside it: menus and adverts differ from page to page on many hosts,
    while articles are copied, so lines inside a declared article are not
    deleted for being shared.

    Only hashes of lines meet their neighbours; pages are moved once, to meet
    their partner's hashes. A null page counts as empty and gives an empty
    text; a null url or one without a host has no partner; a null id is an id
    like any other; repeated rows are returned repeated; other columns are not read.
    """
    url, key = F.col(url_col), F.xxhash64(F.col(url_col), F.col(html_col))
    page = F.coalesce(F.col(html_col), F.lit(""))
    small = df.select(F.col(id_col).alias("page_id"), _host(url).alias("host"), _path(url).alias("path"), key.alias("key"), page.alias("page"))
    small = small.where(F.coalesce(F.col("host"), F.lit("")) != "")
    hashed = per_text(
        small, {"lines": "array<bigint>"}, lambda: lambda text: (_outside(blocks(text)),)
    )
    placed = _with_others(hashed, ["host", "path", "key", "page_id"])
    before = F.when(F.col("prev.host") == F.col("host"), _common(F.col("path"), F.col("prev.path"))).otherwise(0)
    after = F.when(F.col("next.host") == F.col("host"), _common(F.col("path"), F.col("next.path"))).otherwise(0)
    partner = F.when((before > 0) & (before >= after), F.col("prev.lines")).when(after > 0, F.col("next.lines"))
    # rows of one id, url and page are alike; the least of their partners serves them all
    partners = placed.select("page_id", "key", F.coalesce(partner, F.array().cast("array<bigint>")).alias("partner"))
    partners = partners.groupBy(_known("page_id").alias("_id"), "key").agg(F.min("partner").alias("partner"))
    pages = df.select(F.col(id_col).alias("page_id"), url.alias("url"), _known(id_col).alias("_id"), key.alias("key"), page.alias("page"))
    joined = pages.join(partners, ["_id", "key"], "left").select("page_id", "url", F.struct("page", "partner").alias("value"))

    def work():
        def each(value):
            found = blocks(value["page"])
            text = main_text(found, shared_lines(_lines(_outside(found)), _lines(value["partner"] or [])))
            return text, len(text)

        return each

    return per_text(joined, {"text": "string", "n_chars": "bigint"}, work)


def _known(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("i"), F.col(column).cast("string")), F.lit("n"))
