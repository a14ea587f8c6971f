"""Evaluation passages inside training documents.

A positional index holds every three neighbouring words of the evaluation items. Each text is read once and
meets it; the offset-adjusted positions (document position less item position) of one document and item name
places, where the word sequences are then compared: the passage must run over enough words, nearly all of them
equal and among them a name or two numbers that mark the item, so a passage in another text built alike is no leak.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundmill.runtime import collect_bounded

WORDS = 15  # running words that make a leak
CHANGED = 8  # about one word in so many may be changed
RARE_ITEMS = 2  # a term in at most so many items marks an item
DRIFT = 6  # words by which inserted or lost words may shift the rest
MAX_ITEM_ROWS = 200_000  # held-out items kept in memory at once; more are worked off in blocks
KEPT = 2_000  # texts whose result a worker keeps

_INLINE = re.compile(r"</?(?:b|i|em|strong|span|a|u|s|mark|sup|sub|font|code)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[/!a-zA-Z][^<>]*>")
_HYPHEN = re.compile(r"(?<=\w)[-‐‑]\s*(?=\w)")
_UNSEEN = dict.fromkeys([0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x00AD])
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    """Words without case, accents, markup and punctuation; hyphenated ones in one piece."""
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if "&" in text:
        text = entities.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.translate(_UNSEEN))
        text = "".join(c for c in text if not unicodedata.combining(c))
    return _WORD.findall(_HYPHEN.sub("", text).casefold())


def index_terms(items: dict[int, list[str]]) -> set[str]:
    """The terms that mark an item: names and numbers that at most RARE_ITEMS items (or one in a hundred) hold."""
    frequency = Counter(w for words in items.values() for w in set(words))
    return {w for w, n in frequency.items() if n <= max(RARE_ITEMS, len(items) // 100) and len(w) > 2}


def _codes(ids: np.ndarray) -> np.ndarray:
    """One number for each three neighbouring words; equal numbers of different words only propose a place too much."""
    a = ids.astype(np.uint64)
    return (a[:-2] * np.uint64(0x9E3779B97F4A7C15) + a[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + a[2:]


class Index:
    """The items' words as numbers, and where each three neighbouring words of theirs stand, sorted by code."""

    def __init__(self, items: dict[int, list[str]]):
        texts: dict[tuple[str, ...], list[int]] = defaultdict(list)  # copies of an item count once and are reported each
        for i, words in items.items():
            texts[tuple(words)].append(i)
        self.keys, self.words = list(texts.values()), [list(words) for words in texts]
        self.marks = index_terms(dict(enumerate(self.words)))
        self.number = {w: k for k, w in enumerate(dict.fromkeys(w for words in self.words for w in words))}
        self.ids = [np.array([self.number[w] for w in words], dtype=np.int32) for words in self.words]
        self.weight = np.array([(1 if w.isdecimal() else 2) * (w in self.marks) for w in self.number], dtype=np.int8)
        empty = [np.empty(0, dtype=np.uint64)]
        codes = np.concatenate([_codes(x) for x in self.ids if len(x) > 2] + empty)
        owner = np.concatenate([np.full(len(x) - 2, k, dtype=np.int32) for k, x in enumerate(self.ids) if len(x) > 2] + [np.empty(0, dtype=np.int32)])
        at = np.concatenate([np.arange(len(x) - 2, dtype=np.int32) for x in self.ids if len(x) > 2] + [np.empty(0, dtype=np.int32)])
        order = np.argsort(codes, kind="stable")
        self.codes, self.owner, self.at = codes[order], owner[order], at[order]

    def places(self, doc: list[str]) -> tuple[np.ndarray, dict[int, list[int]]]:
        """Which numbered words the document holds, and for each item that shares three neighbouring words with it the
        offsets (document position less item position). With at most three of fifteen words changed, or two of thirteen,
        three neighbouring ones stay, so each leaked window proposes its place, however frequent its words are."""
        ids = np.fromiter((self.number.get(w, -1) for w in doc), dtype=np.int64, count=len(doc))
        held = np.zeros(len(self.number), dtype=bool)
        if len(ids) < 3 or not len(self.codes):
            return held, {}
        spots = np.flatnonzero((ids[:-2] >= 0) & (ids[1:-1] >= 0) & (ids[2:] >= 0))
        codes = _codes(ids)[spots]
        low, high = np.searchsorted(self.codes, codes, "left"), np.searchsorted(self.codes, codes, "right")
        out: dict[int, set[int]] = defaultdict(set)
        for p, x, y in zip(spots.tolist(), low.tolist(), high.tolist()):
            for k, q in zip(self.owner[x:y].tolist(), self.at[x:y].tolist()):
                out[k].add(p - q)
        if out:
            held[ids[ids >= 0]] = True
        return held, {k: sorted(v) for k, v in out.items()}

    def found(self, text: str, least: int) -> list[tuple[int, int]]:
        """(item_id, words) of the items that leaked into the text."""
        doc, out = words_of(text), []
        held, places = self.places(doc)
        for k, offsets in places.items():
            n = max(running_words(self.words[k], doc, offset) for offset in offsets)
            if n < least:
                n = 0
                if self.weight[self.ids[k][held[self.ids[k]]]].sum() > 1:  # else no mark of the item stands anywhere in the text
                    n = max(longest_passage(self.words[k], doc, offset, self.marks) for offset in offsets)
            if n >= least - 2:
                out += [(i, n) for i in self.keys[k]]
        return out


def running_words(item: list[str], doc: list[str], shift: int) -> int:
    """The most neighbouring item words that stand in the document at the given offset, all equal."""
    best = run = 0
    for i in range(max(0, -shift), min(len(item), len(doc) - shift)):
        run = run + 1 if item[i] == doc[i + shift] else 0
        if run > best:
            best = run
    return best


def aligned(item: list[str], doc: list[str], shift: int, drift: int = DRIFT) -> list[bool]:
    """Which item words stand in the document near the given offset, in order."""
    out, run = [], 0
    here, last, n, end = shift, -1, len(doc), len(item) - 1
    for i, w in enumerate(item):
        hit = -1
        at = i + here
        if last < at < n and doc[at] == w:
            hit = at
        elif i < end:  # words were lost or put in: two neighbours must agree at another offset
            then = item[i + 1]
            for step in range(1, drift + 1):
                for j in (at + step, at - step):
                    if last < j < n - 1 and doc[j] == w and doc[j + 1] == then and abs(j - i - shift) <= 2 * drift:
                        hit = j
                        break
                if hit >= 0:
                    break
        if hit >= 0:
            here, last, run = hit - i, hit, max(run, 0) + 1
        elif run > 0:
            run -= 3
            if run <= 0:  # the passage may have ended: back to the offset asked for
                here = shift
        out.append(hit >= 0)
    return out


def windows(hits: list[bool]) -> list[tuple[int, int]]:
    """(first, end) of the longest window from each equal word on to an equal word, nearly all of whose words are equal."""
    change = round(CHANGED / 1.6)  # one word in so many, rounded loosely
    sums = list(accumulate((1 if h else 1 - change for h in hits), initial=0))
    tops, top = [], []  # the ends from which on no later end has as high a sum
    for end in range(len(hits), 0, -1):
        if hits[end - 1] and (not tops or sums[end] > tops[-1]):
            tops.append(sums[end])
            top.append(end)
    out = []
    for first, hit in enumerate(hits):
        if hit:
            end = top[bisect_left(tops, sums[first])]  # the word itself is a window of one
            out.append((first, end))
    return out


def longest_passage(item: list[str], doc: list[str], shift: int, marks: set[str], drift: int = DRIFT) -> int:
    """Item words of the longest passage near the given offset, of which at most one word in CHANGED, loosely, is changed.
    The passage must hold a name that marks the item, or two numbers that do; 0 if there is none."""
    best = 0
    plain = [0 <= i + shift < len(doc) and doc[i + shift] == w for i, w in enumerate(item)]
    for hits in (plain, aligned(item, doc, shift, drift)):
        mark = list(accumulate((((1 if w.isdecimal() else 2) if h and w in marks else 0) for h, w in zip(hits, item)), initial=0))
        best = max([best, *(end - first for first, end in windows(hits) if mark[end] - mark[first] > 1)])
    return best


def leaked_items(documents: DataFrame, items: DataFrame, *, words: int = WORDS) -> DataFrame:
    """(doc_id, item_id, n_words) of each document that holds ``words`` or more running words of an item, about one in
    eight of them changed at most (a passage whose outer words were changed counts from WORDS - 2).

    Null and blank texts hold and leak nothing; rows without an id are left out; items of fewer words than asked can't leak. Repeated documents
    and items are reported each under its id; an empty table on either side gives no row.
    """
    rows = items.where("text is not null and item_id is not null").select("item_id", "text")
    blocks = max(1, -(-rows.count() // MAX_ITEM_ROWS))
    out = None
    for block in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        found = _leaks_of_block(documents, part, words)
        out = found if out is None else out.unionByName(found)
    return out


def _leaks_of_block(documents: DataFrame, part: DataFrame, least: int) -> DataFrame:
    spark = documents.sparkSession
    items = {r["item_id"]: words_of(r["text"]) for r in collect_bounded(part, 4 * MAX_ITEM_ROWS, "held-out items of a block")}
    items = {i: w for i, w in items.items() if len(w) >= least - 2}
    box = spark.sparkContext.broadcast(Index(items))
    texts = documents.select("doc_id", "text").where("text is not null and doc_id is not null")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = lru_cache(KEPT)(lambda text: box.value.found(text, least))  # a text that stands in many rows is compared once
        for batch in batches:
            rows = [(doc_id, i, n) for doc_id, text in zip(batch["doc_id"], batch["text"]) for i, n in found(text)]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "n_words"])

    return texts.mapInPandas(verify, "doc_id long, item_id long, n_words int")
