"""HTML documents: a small tree builder over the standard parser, and what extraction takes from the tree.

The tree repairs what pages leave out (end tags of paragraphs, list items, table cells and options; void and raw-text
elements).  Parsing is the one step that no built-in expression can do; it runs in Arrow batches, whole documents at a time,
and hands raw fields back to column expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))
#: Elements, classes and identifiers that hold no content.
NON_CONTENT = frozenset("script style noscript template svg canvas iframe object embed form button input select textarea".split())
CHROME = frozenset("nav header footer aside".split())
CHROME_CLASSES = frozenset("sidebar navbar navigation social share comments cookie popup advert ads ad".split())
BLOCKS = frozenset("h1 h2 h3 h4 h5 h6 p li blockquote pre td th".split())
ARTICLE_CLASSES = frozenset("post-body entry-content post-content".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_BLOCK_STARTS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_SPACE = re.compile("[\\t\\n\\x0b\\f\\r  -   　﻿]+")


class Node:
    __slots__ = ("children", "name", "attrs", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        """Elements below this one, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def text(self, skip=None) -> str:
        out: list[str] = []
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif skip is None or not skip(n):
                stack += reversed(n.children)
        return "".join(out)

    @property
    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#document", {}, None)
        self.at = self.root

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCK_STARTS:
            self._close_open({"p"}, {"button", "table", "td", "th", "caption"})
        if tag in _CLOSES:
            self._close_open(_CLOSES[tag], {"ul", "ol", "table", "dl", "select"} if tag != "p" else {"button", "table", "td", "th"})
        named: dict[str, str] = {}
        for k, v in attrs:
            named.setdefault(k, v or "")
        node = Node(tag, named, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        n = self.at
        while n is not self.root and n.name != tag:
            n = n.parent or self.root
        if n is not self.root:
            self.at = n.parent or self.root

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)

    def _close_open(self, names: set[str], until: set[str]) -> None:
        n = self.at
        while n is not self.root and n.name not in until:
            if n.name in names:
                self.at = n.parent or self.root
                return
            n = n.parent or self.root


def parse(html: str | None) -> Node:
    b = _Builder()
    try:
        b.feed(html or "")
        b.close()
    except Exception:  # noqa: BLE001 - a page the parser gives up on keeps what was read
        pass
    return b.root


def squeeze(text: str) -> str:
    """Blanks collapsed, lines trimmed."""
    text = re.sub(r"[ \t]+", " ", text.replace(" ", " "))
    return re.sub(rf"{_SPACE.pattern[:-1]}*\n{_SPACE.pattern[:-1]}*", "\n", text).strip(" \t\n\r\f\v﻿　")


def no_tags(text: str) -> str:
    return squeeze(re.sub(r"<[^>]*>", " ", text))


def is_chrome(n: Node) -> bool:
    return n.name in CHROME or bool(n.classes & CHROME_CLASSES) or n.attrs.get("id") == "comments"


def _skip(n: Node) -> bool:
    return n.name in NON_CONTENT or is_chrome(n)


def _first(root: Node, name: str) -> Node | None:
    return next((n for n in root.walk() if n.name == name), None)


def _meta(root: Node, key: str, value: str) -> str:
    return next((n.attrs.get("content", "") for n in root.walk() if n.name == "meta" and n.attrs.get(key, "").lower() == value and n.attrs.get("content")), "")


def _visible(root: Node) -> list[Node]:
    """Elements below the body that no skipped element holds; found once for a document."""
    if root.attrs.get("visible") is None:
        root.attrs["visible"] = _find_visible(root)  # type: ignore[assignment]
    return root.attrs["visible"]  # type: ignore[return-value]


def _find_visible(root: Node) -> list[Node]:
    body = _first(root, "body") or root
    out, stack = [], [c for c in reversed(body.children) if isinstance(c, Node)]
    while stack:
        n = stack.pop()
        if _skip(n):
            continue
        out.append(n)
        stack += [c for c in reversed(n.children) if isinstance(c, Node)]
    return out


def light_text(root: Node) -> str:
    """Block texts of at least two characters, nested ones as often as they are nested; else the whole text."""
    blocks = [t for n in _visible(root) if n.name in BLOCKS and len(t := no_tags(n.text(_skip))) >= 2]
    body = _first(root, "body") or root
    return no_tags("\n".join(blocks) if blocks else body.text(_skip))


def useful_text(root: Node, most: int = 50_000) -> str:
    """Different block texts; the whole text where they are under 80 characters together."""
    seen: dict[str, None] = {}
    for n in _visible(root):
        hit = n.name in BLOCKS or n.name == "article" or (n.name == "div" and n.classes & {"post", "post-body"}) or n.classes & {"entry-content", "post-content", "widget-content"}
        if hit and len(t := squeeze(n.text(_skip))) >= 2:
            seen.setdefault(t)
    joined = squeeze("\n".join(seen))
    body = _first(root, "body") or root
    return (joined if len(joined) >= 80 else squeeze(body.text(_skip)))[:most]


def article_text(root: Node) -> str:
    """The longest of the article-like parts with at least 80 characters; '' if there is none."""
    best = ""
    for n in root.walk():
        if n.name == "article" or n.classes & ARTICLE_CLASSES or (n.name == "div" and "post" in n.classes):
            parts = [t for x in n.walk() if x.name in BLOCKS - {"td", "th"} and (t := squeeze(x.text()))]
            t = squeeze("\n".join(parts) or n.text())
            if len(t) >= 80 and len(t) > len(best):
                best = t
    return best


def anchors(root: Node, visible_only: bool = False) -> list[dict[str, str]]:
    """Links in order: href, text, hreflang, title, label."""
    nodes = _visible(root) if visible_only else root.walk()
    return [{"href": n.attrs["href"], "text": _SPACE.sub(" ", n.text()).strip(), "hreflang": n.attrs.get("hreflang", ""), "title": n.attrs.get("title", ""), "label": n.attrs.get("aria-label", "")} for n in nodes if n.name == "a" and "href" in n.attrs]


def links(root: Node) -> list[dict[str, str]]:
    """Link elements: rel, href, type, hreflang, title."""
    return [{k: n.attrs.get(k, "") for k in ("rel", "href", "type", "hreflang", "title")} for n in root.walk() if n.name == "link" and n.attrs.get("href")]


_ANCHOR = T.StructType([T.StructField(x, T.StringType()) for x in ("href", "text", "hreflang", "title", "label")])
_LINK = T.StructType([T.StructField(x, T.StringType()) for x in ("rel", "href", "type", "hreflang", "title")])
FIELDS = T.StructType(
    [T.StructField(x, T.StringType()) for x in ("title", "og_title", "description", "og_description", "meta_keywords", "icon", "light_text", "useful_text", "article_text")]
    + [T.StructField("anchors", T.ArrayType(_ANCHOR)), T.StructField("content_anchors", T.ArrayType(_ANCHOR)), T.StructField("links", T.ArrayType(_LINK)), T.StructField("text_length", T.IntegerType())]
)


def _title(root: Node) -> str:
    title = _first(root, "title")
    return title.text() if title else ""


def _icon(root: Node) -> str:
    return next((n.attrs.get("href", "") for n in root.walk() if n.name == "link" and "icon" in n.attrs.get("rel", "").lower().split() and n.attrs.get("href")), "")


_READ = {
    "title": _title, "og_title": lambda r: _meta(r, "property", "og:title"), "description": lambda r: _meta(r, "name", "description"), "og_description": lambda r: _meta(r, "property", "og:description"),
    "meta_keywords": lambda r: _meta(r, "name", "keywords"), "icon": _icon, "light_text": light_text, "useful_text": useful_text, "article_text": article_text, "anchors": anchors,
    "content_anchors": lambda r: anchors(r, True), "links": links, "text_length": lambda r: len(_SPACE.sub(" ", (_first(r, "body") or r).text()).strip()),
}


def raw_fields(html: str | None, only: tuple[str, ...] = tuple(_READ)) -> dict[str, object]:
    """The wanted raw fields of a document."""
    root = parse(html)
    return {name: _READ[name](root) for name in only}


def fields(pages: DataFrame, html: str = "html", only: tuple[str, ...] = tuple(_READ)) -> DataFrame:
    """``pages`` without the document, with its raw fields as columns; only those named are read."""
    keep = [c for c in pages.columns if c != html]
    names = [f.name for f in FIELDS.fields if f.name in only]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [raw_fields(h if isinstance(h, str) else None, tuple(names)) for h in pdf[html]]
            out = pdf[keep].reset_index(drop=True)
            for n in names:
                out[n] = pd.Series([r[n] for r in rows], dtype="int32" if n == "text_length" else object)
            yield out

    schema = T.StructType([pages.schema[c] for c in keep] + [FIELDS[n] for n in names])
    return pages.mapInPandas(run, schema)
