"""Landed HTML pages: elements by container and class, links, attribute lists, stop sections, timetables.

Built-in expressions over whole pages; each page is one row, so nothing is shuffled except where
repeated rows have to be removed. ``elements`` cuts a page into tags and texts and counts the tags of an
element's own kind to find where it ends, which a regular expression cannot: a div within a div, a table
within a cell.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transit_spark.functions.text import plain_text, trimmed, unescape_html

# Tags, class names and the clock pattern of the pages. Values stand in either kind of
# quotes or in none, attributes in any order, and an element may have several classes.
_HREF = r"""href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
ANCHOR = rf"(?is)<a\s(?:[^>]*\s)?{_HREF}[^>]*>.*?</a>"


def _of_class(tag: str, name: str) -> str:
    return rf"""(?is)<{tag}\s(?:[^>]*\s)?class\s*=\s*(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?"|'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>]))[^>]*>(.*?)</{tag}>"""


ICON = _of_class("span", "icon")
TRIP = _of_class("div", "routetrip")
ITEM = r"(?is)<li[^>]*>(.*?)</li>"
ROW = r"(?is)<tr[^>]*>.*?</tr>"
STOP_ROW = _of_class("tr", "rowStop")
CELL = r"(?is)<td[^>]*>(.*?)</td>"
CLOCK = r"\d{2}:\d{2}(-\d{2}:\d{2})?"
TERMINALS = ("A", "B")
UNKNOWN_DIRECTION = "Unknown"
#: Comments, scripts and styles as a whole, tags (a bracket may stand in a quoted value; group 1 is the name, with its
#: slash), texts, stray brackets. Possessive, so long tags take neither steps back nor stack.
TOKEN = r"""(?is)<!--.*?-->|<(/?[a-z][a-z0-9]*+)(?:(?<=<script|<style)\b[^>]*+>.*?</(?:script|style)\s*+>|(?:"[^"]*+"|'[^']*+'|[^'">]++)*+>)|[^<]++|<"""
OPENING = r"""(?is)^<[a-z](?:"[^"]*+"|'[^']*+'|[^'">]++)*+>"""
#: Elements that never hold anything.
EMPTY = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
HEADING_OR_ROW = r"(?is)<h3\b[^>]*>.*?</h3\s*>|<tr\b[^>]*>.*?</tr\s*>"


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _text(c: Column) -> Column:
    """Markup removed, then unescaped, then blanks at both ends removed, the unescaped ones too."""
    plain = ~F.contains(c, F.lit("<")) & ~F.contains(c, F.lit("&"))
    return F.when(plain, trimmed(c)).otherwise(trimmed(unescape_html(plain_text(c))))


def _attribute(element: Column, name: str) -> Column:
    """The value of an attribute of an element's own tag, '' without it."""
    found = rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    quoted = lambda v: F.startswith(v, F.lit('"')) | F.startswith(v, F.lit("'"))
    value = F.regexp_extract(F.regexp_extract(element, OPENING, 0), found, 1)
    return _once(value, lambda v: F.when(quoted(v), F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))


def _once(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used in there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts(step: str) -> tuple[str | None, list[tuple[str, str]]]:
    """The tag of a selector's step, if it names one, and its ``#id`` and ``.class`` conditions."""
    parts = re.findall(r"([#.]?)([A-Za-z0-9_-]+)", step)
    if "".join(kind + name for kind, name in parts) != step or not parts:
        raise ValueError(f"unknown selector step: {step!r}")
    return (parts[0][1].lower() if not parts[0][0] else None), [(kind, name) for kind, name in parts if kind]


def _meets(token: Column, kind: str, name: str) -> Column:
    """Whether a tag has an id or class; hardly any tag holds the name at all, so that is looked at first."""
    has = _attribute(token, "id") == name if kind == "#" else F.array_contains(F.split(_attribute(token, "class"), r"\s+"), name)
    return F.contains(token, F.lit(name)) & has


def _page(html: Column) -> Column:
    """The tokens of a page and, beside them, the names of tags in lower case: ``tr``, ``/tr``, '' for what is no tag."""
    names = F.transform(_all(html, TOKEN, 1), lambda name: F.lower(name))
    return F.struct(_all(html, TOKEN, 0).alias("tokens"), names.alias("names"))


def _end_of(names: Column, marks: Column, k: Column, last: Column) -> Column:
    """Index of the token that closes the element opened at the k-th of ``marks``, the tags of its own kind: what is
    left open inside does not matter. An element that is never closed reaches to ``last``."""
    closes = lambda i: F.startswith(F.get(names, i), F.lit("/"))

    def step(depth: Column, i: Column) -> Column:
        """The depth behind a tag; once it is 0, the place where that was, as a negative number."""
        return F.when(depth < 0, depth).when(~closes(i), depth + 1).when(depth == 1, -i - 1).otherwise(depth - 1)

    nearest = F.get(marks, k + 1)
    walk = F.aggregate(F.slice(marks, k + 2, F.size(marks)), F.lit(1), step, lambda depth: F.when(depth < 0, -depth - 1))
    return F.coalesce(F.when(closes(nearest), nearest), walk, last)


def _spans(page: Column, step: str, first: Column, last: Column, outer: Column | None = None) -> Column:
    """Where the elements of a step start and end among the tokens from ``first`` to ``last``, in document order."""
    tokens, names = page["tokens"], page["names"]
    tag, conditions = _parts(step)

    def hit(i: Column) -> Column:
        checks = [_meets(F.get(tokens, i), kind, name) for kind, name in conditions]
        inside = [] if outer is None else [F.exists(outer, lambda s: (s["start"] < i) & (i <= s["end"]))]
        name = F.get(names, i)
        return reduce(lambda a, b: a & b, checks + inside, name == tag if tag else (name != "") & ~F.startswith(name, F.lit("/")))

    def marks_from(start: Column, name: Column) -> Column:
        return F.filter(F.sequence(start, last), lambda i: F.get(names, i).isin(name, F.concat(F.lit("/"), name)))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"))

    if tag is None:
        def alone(i: Column) -> Column:
            name = F.get(names, i)
            return span(i, F.when(name.isin(*EMPTY), i).otherwise(_once(marks_from(i, name), lambda marks: _end_of(names, marks, F.lit(0), last))))

        return F.transform(F.filter(F.sequence(first, last), hit), alone)
    if tag in EMPTY:
        return F.transform(F.filter(F.sequence(first, last), hit), lambda i: span(i, i))
    # Tags of one kind are looked for once for all elements of the step.
    found = lambda marks: F.transform(marks, lambda i, k: F.when(hit(i), span(i, _end_of(names, marks, k, last))))
    return F.filter(_once(marks_from(first, F.lit(tag)), found), lambda s: s.isNotNull())


def _markup(page: Column, span: Column) -> Column:
    return F.array_join(F.slice(page["tokens"], span["start"] + 1, span["end"] - span["start"] + 1), "")


def elements(html: Column, selector: str) -> Column:
    """The markup of each element that ``selector`` names, in document order, from its tag to its end.

    ``selector`` is a list of steps divided by blanks, each an element inside one of the step before:
    ``#divResult a.cms-button``. NULL for a page that is NULL.
    """
    steps = selector.split()
    if not steps:
        raise ValueError("an empty selector")

    def spans_of(page: Column, remaining: list[str], outer: Column | None) -> Column:
        """The texts of the last step's elements, each step looked for inside the spans of the one before."""
        spans = _spans(page, remaining[0], F.lit(0), F.size(page["names"]) - 1, outer)
        if len(remaining) > 1:
            return _once(spans, lambda found: spans_of(page, remaining[1:], found))
        return F.transform(spans, lambda s: _markup(page, s))

    def of_page(page: Column) -> Column:
        return F.when(F.size(page["names"]) > 0, spans_of(page, steps, None)).otherwise(F.array().cast("array<string>"))

    return F.when(html.isNotNull(), _once(_page(html), of_page))


def _facts(html: Column) -> Column:
    """The text of the first cell and the markup of the second, for each table row of two cells or more."""

    def of_row(page: Column, row: Column) -> Column:
        cells = F.transform(F.slice(_spans(page, "td", row["start"], row["end"]), 1, 2), lambda s: _markup(page, s))
        return _once(cells, lambda c: F.when(F.size(c) == 2, F.struct(_text(F.get(c, F.lit(0))).alias("name"), F.get(c, F.lit(1)).alias("value"))))

    def of_page(page: Column) -> Column:
        return F.transform(_spans(page, "tr", F.lit(0), F.size(page["names"]) - 1), lambda row: of_row(page, row))

    return F.when(html != "", F.filter(_once(_page(html), of_page), lambda fact: fact.isNotNull()))


def select_elements(pages: DataFrame, selector: str, key: str = "page_id", html: str = "html", name: str = "element") -> DataFrame:
    """(page, position, element) of the elements that ``selector`` names."""
    return pages.select(key, F.posexplode(elements(F.col(html), selector)).alias("position", name))


def extract_links(pages: DataFrame, site: str = "", key: str = "page_id", selector: str | None = None) -> DataFrame:
    """(page, position, number, name, url) per link; a path is put behind ``site``. ``selector`` takes
    only the links it names, and those among them that lead somewhere; positions count these."""
    if selector is None:
        found = _all(F.col("html"), ANCHOR, 0)
    else:
        found = F.filter(elements(F.col("html"), selector), lambda a: _attribute(a, "href") != "")
    links = pages.select(key, F.posexplode(found).alias("position", "a"))
    href = unescape_html(_attribute(F.col("a"), "href"))
    titled = F.regexp_extract("a", TRIP, 1)
    return links.select(
        key,
        "position",
        _text(F.regexp_extract("a", ICON, 1)).alias("number"),
        _text(F.when(titled != "", titled).otherwise(F.col("a"))).alias("name"),
        F.when(href.startswith("/"), F.concat(F.lit(site), href)).otherwise(href).alias("url"),
    )


def extract_attributes(pages: DataFrame, labels: dict[str, str], key: str = "page_id", within: str | None = None) -> DataFrame:
    """One row per page, one column per label: the text behind "Label:" of the last list item that
    names the label, else the text of the cell beside the last table cell that names it, '' when
    neither does. ``within`` (a selector) looks only into such elements; a cell that holds lists is no value."""
    body = F.col("html") if within is None else F.array_join(elements(F.col("html"), within), "\n")
    parts = pages.select(key, body.alias("_body"))
    items = parts.select(key, "_body", F.transform(_all(F.col("_body"), ITEM, 1), _text).alias("items"))

    def named(label: str) -> Column:
        return F.filter("items", lambda i: F.contains(i, F.lit(label)))

    # Tables are only read where some label stands in no list item.
    some_missing = reduce(lambda a, b: a | b, [F.size(named(label)) == 0 for label in labels.values()], F.lit(False))
    found = items.select(key, "items", F.when(some_missing, _facts(F.col("_body"))).alias("facts"))

    def value(label: str) -> Column:
        text = F.replace(F.try_element_at(named(label), F.lit(-1)), F.lit(f"{label}:"), F.lit(""))
        beside = F.filter("facts", lambda fact: F.contains(fact["name"], F.lit(label)) & ~fact["value"].rlike("(?i)<li\\b"))
        return F.coalesce(F.trim(text), _text(F.try_element_at(beside, F.lit(-1))["value"]), F.lit(""))

    return found.select(key, *[value(label).alias(name) for name, label in labels.items()])


def extract_stops(pages: DataFrame, skip_terminals: bool = False, direction_word: str | None = None, key: str = "page_id") -> DataFrame:
    """(page, direction, stop_order, stop_name) of the stop rows below each direction heading."""
    sections = pages.select(key, F.explode(F.filter(F.split("html", "(?i)<h3"), lambda _, i: i > 0)).alias("section"))
    heads = sections.select(
        key,
        _text(F.regexp_extract("section", r"(?is)^[^>]*>(.*?)</h3>", 1)).alias("direction"),
        F.posexplode(_all(F.col("section"), STOP_ROW, 0)).alias("place", "row"),
    )
    if direction_word is not None:
        heads = heads.where(F.contains("direction", F.lit(direction_word)))
    cells = heads.withColumn("cells", F.transform(_all(F.col("row"), CELL, 1), _text))
    order = F.nullif(F.get("cells", F.lit(0)), F.lit(""))
    rows = cells.select(
        key,
        "direction",
        F.coalesce(order, (F.col("place") + 1).cast("string")).alias("stop_order"),
        F.get("cells", F.lit(1)).alias("stop_name"),
    ).where(F.col("stop_name") != "")
    if skip_terminals:
        rows = rows.where(~F.col("stop_order").isin(*TERMINALS))
    return rows.distinct()


def extract_timetable(pages: DataFrame, key: str = "page_id", direction_word: str = "") -> DataFrame:
    """(page, row, direction, stop_order, stop_name, departure_time): first clock text from the third cell
    on, for table rows of at least four cells. ``direction`` is the last heading above the row, if it
    holds ``direction_word``; rows below another heading, or none, have an unknown one."""
    marks = pages.select(key, _all(F.col("html"), HEADING_OR_ROW, 0).alias("marks"))
    heading = "(?i)^<h3"

    def told(mark: Column, i: Column) -> Column:
        above = F.filter(F.slice(F.col("marks"), F.lit(1), i), lambda m: m.rlike(heading))
        rows = F.size(F.filter(F.slice(F.col("marks"), F.lit(1), i), lambda m: ~m.rlike(heading)))
        return F.struct(rows.alias("row"), F.try_element_at(above, F.lit(-1)).alias("heading"), mark.alias("tr"))

    rows = marks.select(key, F.explode(F.filter(F.transform("marks", told), lambda r: ~r["tr"].rlike(heading))).alias("r"))
    cells = rows.select(key, "r.row", "r.heading", F.transform(_all(F.col("r.tr"), CELL, 1), _text).alias("cells")).where(F.size("cells") >= 4)
    times = F.transform(F.slice(F.col("cells"), F.lit(3), F.size("cells")), lambda c: F.regexp_extract(c, CLOCK, 0))
    first = F.get(F.filter(times, lambda t: t != ""), F.lit(0))
    title = _text(F.col("heading"))
    return cells.select(
        key,
        "row",
        F.when(F.contains(title, F.lit(direction_word)), title).otherwise(UNKNOWN_DIRECTION).alias("direction"),
        F.get("cells", F.lit(0)).alias("stop_order"),
        F.get("cells", F.lit(1)).alias("stop_name"),
        first.alias("departure_time"),
    ).where((F.col("stop_name") != "") & F.col("departure_time").isNotNull())
