"""Tree reader for the pages the native expressions cannot decide.

A small standard-library parse per page, run inside Arrow batches by the pandas
UDFs at the end.  The module is pickled by value, so executors need no install.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr",
}
# A new element of the key closes open elements of the values.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
CLOSES.update({
    tag: {"p"} for tag in (
        "p", "div", "ul", "ol", "table", "article", "section", "main", "header", "footer",
        "nav", "aside", "form", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote",
    )
})
# Implied closing never reaches beyond these.
SCOPES = {"ul", "ol", "dl", "table", "select", "div", "article", "section", "body"}


class Element:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        """Elements below this one in document order, without recursion."""
        stack = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, Element):
                yield item
                stack.extend(reversed(item.children))

    def texts(self, dropped):
        stack = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            elif item.tag not in dropped:
                stack.extend(reversed(item.children))


class TreeReader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.here = Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        closes, node = CLOSES.get(tag, ()), self.here
        while closes and node.parent is not None and node.tag not in SCOPES:
            if node.tag in closes:
                self.here = node.parent
            node = node.parent
        element = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.here)
        self.here.children.append(element)
        if tag not in VOID:
            self.here = element

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        node = self.here
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.here = node.parent

    def handle_data(self, data):
        self.here.children.append(data)


def read_tree(html):
    reader = TreeReader()
    reader.feed(html)
    reader.close()
    return reader.root


def matches(element, selector):
    kind, value = selector
    if kind == "tag":
        return element.tag == value
    if kind == "id":
        return element.attrs.get("id") == value
    if kind == "class":
        return value in element.attrs.get("class", "").split()
    return value in element.attrs.get("class", "")


def first(root, selector, skipped=frozenset()):
    """First match in document order, outside the skipped elements."""
    stack = [root]
    while stack:
        item = stack.pop()
        if item is not root and matches(item, selector):
            return item
        stack.extend(
            c for c in reversed(item.children)
            if isinstance(c, Element) and c.tag not in skipped
        )
    return None


def squeeze(text):
    return " ".join(text.split())


def page_title(root, selectors, hidden):
    for selector in selectors:
        box = first(root, selector)
        heading = box and first(box, ("tag", "h1"))
        if heading:
            return squeeze("".join(heading.texts(hidden)))
    heading = first(root, ("tag", "h1")) or first(root, ("tag", "title"))
    return squeeze("".join(heading.texts(hidden))) if heading else ""


def page_text(root, selectors, min_length, dropped):
    for selector in selectors:
        box = first(root, selector, dropped)
        if box and sum(len(t.strip()) for t in box.texts(dropped)) > min_length:
            text = squeeze(" ".join(box.texts(dropped)))
            if text:
                return text
            break
    body = first(root, ("tag", "body"), dropped)
    if body:
        return squeeze(" ".join(body.texts(dropped)))
    headless = squeeze(" ".join(root.texts(dropped | {"head", "title"})))
    return headless or squeeze(" ".join(root.texts(dropped)))


def tree_fields(containers, title_selectors, noise, hidden):
    """Pandas UDF (html, content_type) -> (title, text); null html stays null.

    ``containers`` maps a content type to (selectors, minimum length).
    """
    dropped = frozenset(noise) | frozenset(hidden)
    hidden = frozenset(hidden)
    schema = T.StructType([
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
    ])

    def read(html: pd.Series, kind: pd.Series) -> pd.DataFrame:
        rows = []
        for page, content_type in zip(html, kind):
            if page is None:
                rows.append((None, None))
                continue
            root = read_tree(page)
            selectors, min_length = containers.get(content_type, ([], 0))
            rows.append((
                page_title(root, title_selectors, hidden),
                page_text(root, selectors, min_length, dropped),
            ))
        return pd.DataFrame(rows, columns=["title", "text"])

    return F.pandas_udf(read, schema)


def article_parts(hidden):
    """Pandas UDF html -> headings, category, plain and line-separated text."""
    hidden = frozenset(hidden)
    schema = T.StructType([
        T.StructField("headings", T.ArrayType(T.StringType())),
        T.StructField("category", T.StringType()),
        T.StructField("plain", T.StringType()),
        T.StructField("lines", T.StringType()),
    ])

    def read(html: pd.Series) -> pd.DataFrame:
        rows = []
        for page in html:
            if page is None:
                rows.append((None, None, None, None))
                continue
            root = read_tree(page)
            heads, category = [], None
            for element in root.walk():
                if element.tag in ("h1", "h2"):
                    heads.append("".join(element.texts(hidden)))
                elif category is None and element.tag == "a" and "?category=" in element.attrs.get("href", ""):
                    category = squeeze("".join(element.texts(hidden)))
            rows.append((heads, category, "".join(root.texts(hidden)), "\n".join(root.texts(hidden))))
        return pd.DataFrame(rows, columns=["headings", "category", "plain", "lines"])

    return F.pandas_udf(read, schema)


def dated_anchors(hidden, date_pattern):
    """Pandas UDF html -> anchors: every link with the first date in the text around it.

    The text of an anchor's direct parent is searched once per parent and stays here,
    so a page with many links costs one short row per link.
    """
    hidden, find = frozenset(hidden), re.compile(date_pattern).search
    schema = T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("date", T.StringType())]))

    def date_of(box):
        parts = (t.strip() for t in box.texts(hidden))
        found = find(" ".join(t for t in parts if t))
        return found[0] if found else ""

    def read(html: pd.Series) -> pd.Series:
        rows = []
        for page in html:
            dates, anchors = {}, []
            for element in read_tree(page or "").walk():
                if element.tag == "a" and "href" in element.attrs:
                    box = element.parent
                    if id(box) not in dates:
                        dates[id(box)] = date_of(box)
                    anchors.append({"href": element.attrs["href"], "date": dates[id(box)]})
            rows.append(anchors)
        return pd.Series(rows)

    return F.pandas_udf(read, schema)


def ship_by_value():
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


ship_by_value()
