"""Main body of web pages by a maximum-scoring subsequence.

A page is a row of tokens: words and tags. Each has a weight learnt from labelled pages (a logistic model
over the blocks of text between tags, so the weights add up): words of reports score positive, tags and
words of menus, notices, teasers and comments negative. One linear scan finds the contiguous run of blocks
with the greatest sum, the content region; inside it blocks whose own sum is negative (promotions,
captions, notices) are dropped. Labels come from pages whose scraped text is known: a block is body if it
is a line of that text and no line that the source repeats.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundmill.llm.site_lines import repeated_lines
from roundmill.runtime import collect_bounded, spread

#: The classifier is fitted on about this many labelled pages, drawn by a hash of fetch_id; never more than twice as many.
LABELLED_PAGES = 1500
INLINE = frozenset("a b strong em i span img".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_TAG = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\s[^<>]*)?)/?>|<![a-zA-Z][^>]*>", re.S | re.I)
_SPACE = re.compile(r"\s+")
_CLASS = re.compile(r"class\s*=\s*[\"']?([a-zA-Z]+)")
_LINK = re.compile(r"href\s*=\s*[\"']?(/[a-z]+)?")
_WORD = re.compile(r"[^\W\d_]+|\d+")
CLIP_UP, CLIP_DOWN = 6.0, -1.5  # bounds of a block's weight in the scan: a promotion or two inside the report must not outweigh it


def blocks_of(page: str) -> list[tuple[str, list[str]]]:
    """(text, marks) of each block: the text between neighbouring tags other than the inline ones, entities decoded,
    white space made one space; marks describe the tags around it."""
    out: list[tuple[str, list[str]]] = []
    parts: list[str] = []
    inline: list[str] = []
    stack: list[str] = []
    heading, heading_depth = "", 0
    boundary, before_length, at = "start", 0, 0

    def close(following: str) -> None:
        nonlocal parts, inline, heading, heading_depth
        raw = "".join(parts)
        text = _SPACE.sub(" ", entities.unescape(raw)).strip() if raw and not raw.isspace() else ""
        if text:
            marks = ["<" + boundary, ">" + following, *inline, *("^" + t for t in set(stack))]
            if heading:
                marks.append("h:" + heading)
            if out:
                marks.append("p:" + " ".join(w.lower() for w in _WORD.findall(out[-1][0])[:2]) if len(out[-1][0]) < 40 else "p-long")
            out.append((text, marks))
            if boundary[:2] in ("h3", "h4", "h5", "h6"):
                heading, heading_depth = " ".join(w.lower() for w in _WORD.findall(text)[:3]), len(stack)
        parts, inline = [], []

    for m in _TAG.finditer(page):
        chunk = page[at : m.start()]
        parts.append(chunk)
        at = m.end()
        name = m.group(3)
        if not name:
            continue  # comments, scripts, declarations: neither text nor a boundary
        name = name.lower()
        if name in INLINE:
            if not m.group(2):
                where = "s" if not "".join(parts).strip() else "m"
                mark = f"i{where}:{name}"
                if name == "a" and (link := _LINK.search(m.group(4) or "")):
                    mark += link.group(1) or "http"
                inline.append(mark)
            elif not page[at : at + 40].split("<")[0].strip():
                inline.append("ie:" + name)
            continue
        style = _CLASS.search(m.group(4) or "")
        mark = name + ("." + style.group(1) if style else "")
        close(("/" if m.group(2) else "") + mark)
        if m.group(2):
            for i in range(len(stack) - 1, max(-1, len(stack) - 6), -1):  # a tag left open is closed with its parent
                if stack[i].split(".")[0] == name:
                    del stack[i:]
                    break
            if len(stack) < heading_depth - (boundary[:1] == "h"):
                heading = ""
            boundary = "/" + name
        else:
            if name in ("p", "li", "td", "tr") and stack and stack[-1].split(".")[0] == name:
                stack.pop()
            if name not in VOID:
                stack.append(mark)
            boundary = mark
    parts.append(page[at:])
    close("end")
    return out


def tokens_of(text: str, marks: list[str]) -> set[str]:
    """The words and tags whose weights make up the block's score."""
    words = _WORD.findall(text)
    low = ["#" if w.isdecimal() else w.lower() for w in words]
    size = len(low)
    return {*low, *marks, "first:" + " ".join(low[:2]), "last:" + text[-1:] if text[-1:] in ".!?:”\")" else "last:", f"size:{min(size, 3) if size < 4 else 4 + min(3, size // 8)}", f"caps:{min(3, sum(w[:1].isupper() for w in words) * 4 // max(1, size))}", "colon" if ":" in text else "", "bar" if re.search(r"[|/•·—–]", text) else ""}


def _plain(text: str) -> str:
    return " ".join(_WORD.findall(text.casefold()))


def fit_weights(examples: list[tuple[set[str], bool]], *, rounds: int = 30, rate: float = 0.5, decay: float = 1e-5) -> dict[str, float]:
    """Weights of a logistic model by adaptive gradient steps; tokens seen once are left out."""
    count: dict[str, int] = {}
    for tokens, _ in examples:
        for t in tokens:
            count[t] = count.get(t, 0) + 1
    index = {t: i for i, t in enumerate(t for t, n in count.items() if n > 1)}
    if not index:
        return {"": 0.0}
    rows = [np.array([index[t] for t in tokens if t in index], np.int64) for tokens, _ in examples]
    y = np.array([label for _, label in examples], float)
    w, seen = np.zeros(len(index)), np.full(len(index), 1e-6)
    order = np.arange(len(rows))
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        rng.shuffle(order)
        for part in np.array_split(order, max(1, len(order) // 512)):
            flat = np.concatenate([rows[i] for i in part])
            sizes = np.array([len(rows[i]) for i in part])
            owner = np.repeat(np.arange(len(part)), sizes)
            z = np.bincount(owner, w[flat], len(part))
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]
            grad = np.bincount(flat, g[owner], len(index)) / len(part) + decay * w
            seen += grad * grad
            w -= rate * grad / np.sqrt(seen)
    return {t: float(w[i]) for t, i in index.items()}


def label_pages(pages: DataFrame) -> list[tuple[set[str], bool]]:
    """Blocks of the sampled pages with their labels."""
    own = pages.where("html is not null and text is not null")
    some = own.where(F.pmod(F.xxhash64("fetch_id"), F.lit(max(1, own.select("fetch_id").count() // LABELLED_PAGES))) == 0)
    repeated: dict[int, set[int]] = {}
    for r in collect_bounded(repeated_lines(some).select("fetch_id", "line_no"), 2 * LABELLED_PAGES * 200, "repeated lines of the labelled pages"):
        repeated.setdefault(r["fetch_id"], set()).add(r["line_no"])
    examples = []
    for r in collect_bounded(some.select("fetch_id", "text", "html"), 2 * LABELLED_PAGES + 1000, "labelled pages"):
        gone = repeated.get(r["fetch_id"], set())
        body = {_plain(x) for i, x in enumerate(r["text"].split("\n"), 1) if i not in gone}
        body.discard("")
        examples += [(tokens_of(text, marks), _plain(text) in body) for text, marks in blocks_of(r["html"])]
    return examples


def best_region(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the greatest sum, the first of equals; (0, 0) if no score is positive."""
    best, begin, end, run, start = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, begin, end = run, start, i + 1
    return begin, end


def body_of(page: str, weights: dict[str, float]) -> list[str]:
    """The body's blocks in page order."""
    blocks = blocks_of(page)
    get = weights.get
    own = [sum(get(t, 0.0) for t in tokens_of(text, marks)) for text, marks in blocks]
    begin, end = best_region([max(CLIP_DOWN, min(CLIP_UP, s)) for s in own])
    return [text for (text, _), s in zip(blocks[begin:end], own[begin:end]) if s > 0]


def page_bodies(articles: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(fetch_id, block_no, block) of the body's blocks of each page with html, in page order.

    Rows with null, empty or blank html or without an id have none, as has a page on which nothing scores positive. Without
    ``weights`` they are fitted on a bounded sample of the pages themselves; a table without labelled pages
    gives no row. Repeated rows give repeated blocks; extra columns are ignored. Pages never meet in a shuffle.
    """
    pages = articles.select("fetch_id", "source", "text", "html", "published_at").where("fetch_id is not null")
    if weights is None:
        weights = fit_weights(label_pages(pages))
    box = articles.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, i, b) for k, page in zip(batch["fetch_id"], batch["html"]) if page for i, b in enumerate(body_of(page, box.value), 1)]
            yield pd.DataFrame(rows, columns=["fetch_id", "block_no", "block"])

    return spread(pages.where("html is not null").select("fetch_id", "html")).mapInPandas(run, "fetch_id long, block_no int, block string")


def body_hashes(articles: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(fetch_id, block_hash) of the distinct body blocks of each page: the first 16 hex digits of sha-256 of the block."""
    hashed = page_bodies(articles, weights).select("fetch_id", "block_no", F.substring(F.sha2(F.encode("block", "UTF-8"), 256), 1, 16).alias("block_hash"))
    return hashed.groupBy("fetch_id", "block_hash").agg(F.min("block_no").alias("block_no")).select("fetch_id", "block_hash")


def block_hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()[:16]
