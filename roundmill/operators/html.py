"""Pages read with the standard parser inside Arrow batches: links, article details, counts of selectors.

No built-in expression reads HTML that isn't well formed, so these are pandas UDFs; all filtering of what they
return is done with built-in expressions.
"""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED = frozenset("script style noscript nav footer header aside form iframe".split())
INLINE = frozenset("a b i em strong span u font small mark sup sub code".split())
CLOSING = frozenset("p li ul ol div h1 h2 h3 h4 h5 h6 blockquote table section article aside nav header footer figure form".split())
BODY = frozenset("p li h2 h3 blockquote".split())


class _Node:
    __slots__ = ("tag", "attrs", "parent", "parts")

    def __init__(self, tag: str, attrs: dict, parent: _Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.parts: list = []

    def up(self):  # noqa: ANN201
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def text(self) -> str:
        return "".join(x if isinstance(x, str) else "" if x.tag in ("script", "style") else x.text() for x in self.parts)


class _Tree(HTMLParser):
    """A tolerant tree: a closing tag closes the nearest open element of its name."""

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = _Node("", {}, None)
        self.nodes: list[_Node] = []
        self.depth = 0
        self.feed(page)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSING:  # an open paragraph or item ends here, with the inline elements left open in it
            ended = "li" if tag == "li" else "p"
            for i, above in enumerate([self.here, *self.here.up()]):
                if above.tag == ended:
                    self.here = above.parent
                    self.depth -= i + 1
                    break
                if above.tag not in INLINE:
                    break
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.here)
        self.here.parts.append(node)
        self.nodes.append(node)
        if tag not in VOID and self.depth < 400:
            self.here = node
            self.depth += 1

    def handle_endtag(self, tag: str) -> None:
        chain = [self.here, *self.here.up()]
        for i, node in enumerate(chain):
            if node.tag == tag and node.parent is not None:
                self.here = node.parent
                self.depth -= i + 1
                return

    def handle_data(self, data: str) -> None:
        self.here.parts.append(data)


def _parse_simple(part: str) -> tuple[str, list[str], list[tuple[str, str]]]:
    tag = re.match(r"[a-zA-Z][\w-]*|\*?", part).group(0).lower()
    return tag, re.findall(r"\.([\w-]+)", re.sub(r"\[.*?\]", "", part)), re.findall(r"\[([\w:-]+)=[\"']?([^\"'\]]*)[\"']?\]", part)


def _fits(node: _Node, simple: tuple) -> bool:
    tag, classes, attrs = simple
    return (tag in ("", "*") or node.tag == tag) and set(classes) <= set(node.attrs.get("class", "").split()) and all(node.attrs.get(k) == v for k, v in attrs)


def select(tree: _Tree, selector: str) -> list[_Node]:
    """Elements of a comma list of descendant chains of ``tag.class[attr="value"]``, each once, in page order."""
    chains = [[_parse_simple(p) for p in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", c)] for c in selector.split(",")]
    out = []
    for node in tree.nodes:
        for chain in chains:
            if chain and _fits(node, chain[-1]):
                rest = chain[:-1]
                for above in node.up():
                    if rest and _fits(above, rest[-1]):
                        rest = rest[:-1]
                if not rest:
                    out.append(node)
                    break
    return out


def _squeeze(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def _published(tree: _Tree) -> str | None:
    for node in tree.nodes:
        if node.tag == "meta" and (node.attrs.get("property") or node.attrs.get("name")) in ("article:published_time", "published_time", "date"):
            return node.attrs.get("content") or None
    for node in tree.nodes:
        if node.tag == "script" and node.attrs.get("type") == "application/ld+json":
            raw = "".join(x for x in node.parts if isinstance(x, str))
            try:
                data = json.loads(raw)
                for block in data if isinstance(data, list) else [data]:
                    if isinstance(block, dict) and block.get("datePublished"):
                        return str(block["datePublished"])
            except ValueError:
                if m := re.search(r'"datePublished"\s*:\s*"([^"]+)"', raw):
                    return m.group(1)
    return None


def page_detail(page: str, author_selectors: tuple[str, ...] = ('meta[name="author"]', "a.author", "span.author", ".author-name", ".byline", '[rel="author"]')) -> tuple:
    """(title, published, author, text). Title: og:title, else <title>; text: the paragraphs, list items, subheads and
    quotations outside scripts, menus and footers, a blank line between them; else the description, else the title."""
    tree = _Tree(page)
    meta = {n.attrs.get("property") or n.attrs.get("name"): n.attrs.get("content", "") for n in reversed(tree.nodes) if n.tag == "meta"}
    title = _squeeze(meta.get("og:title", "") or next((n.text() for n in tree.nodes if n.tag == "title"), "")) or None
    author = None
    for selector in author_selectors:
        for node in select(tree, selector):
            author = author or _squeeze(node.attrs.get("content", "") or node.text()) or None
    blocks = []
    for node in tree.nodes:
        if node.tag in BODY and not any(a.tag in DROPPED or a.tag in BODY for a in node.up()) and (text := _squeeze(node.text())):
            blocks.append(text)
    body = "\n\n".join(blocks) or _squeeze(meta.get("og:description", "") or meta.get("description", "")) or title
    return title, _published(tree), author, body


DETAIL = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "published", "author", "text")])


@F.pandas_udf(DETAIL)
def detail(page: pd.Series) -> pd.DataFrame:
    """struct<title, published, author, text> of a page; nulls for null and empty pages."""
    return pd.DataFrame([page_detail(p) if p else (None,) * 4 for p in page], columns=["title", "published", "author", "text"])


LINK = T.ArrayType(T.StructType([T.StructField("href", T.StringType()), T.StructField("text", T.StringType())]))


@F.pandas_udf(LINK)
def links(page: pd.Series) -> pd.Series:
    """Links in page order as struct<href, text>; null and empty pages have none."""
    return page.map(lambda p: [{"href": n.attrs["href"], "text": _squeeze(n.text())} for n in _Tree(p).nodes if n.tag == "a" and n.attrs.get("href")] if p else [])


def selector_hits(selectors: list[str]):  # noqa: ANN201
    """A pandas UDF: map of each selector to its number of elements; an empty map for null and empty pages."""

    @F.pandas_udf(T.MapType(T.StringType(), T.IntegerType()))
    def hits(page: pd.Series) -> pd.Series:
        def count(p: str) -> dict:
            tree = _Tree(p)
            return {s: len(select(tree, s)) for s in selectors}

        return page.map(lambda p: count(p) if p else {})

    return hits


def absolute(href: Column, base: Column) -> Column:
    """Address without query and fragment; those that start with a slash get the base's host."""
    plain = F.regexp_replace(href, r"[?#].*$", "")
    return F.when(plain.startswith("/"), F.concat(F.regexp_extract(base, r"^([a-z]+://[^/]+)", 1), plain)).otherwise(plain)
