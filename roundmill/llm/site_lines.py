"""Lines that one source prints on page after page.

A line's wording is what stays the same: words found on a fifth of a source's pages or more. Any word of a
wording that stands on a quarter of the pages must itself be that frequent, so masking all rarer words
(names, places, topics), numbers and dates loses no such wording. Masked lines are counted over distinct
document clusters and publication dates, not pages, so a republished report doesn't make boilerplate of
its own text. Wordings split by a frequent name are joined again by masking up to two more words.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundmill.runtime import collect_bounded, cut

SHARE, LEAST = 0.25, 3  # of the articles of a source
WORD_SHARE = 0.20  # words this frequent in a source stay in its wordings
SEED_SHARE = 0.004  # masked lines this frequent may be joined with others
BLOCK_ROWS = 400_000  # most rows of statistics held at once; more sources are worked off in blocks

# Month names and their short forms.
MONTHS = frozenset("january february march april may june july august september october november december jan feb mar apr jun jul aug sep sept oct nov dec".split())
_TOKEN = re.compile(r"[^\W\d_]+|\d+")
_DATE = re.compile(r"(?:# % #|% # #|# # #|# %|% #)(?= |$)")
_NUMBERS = re.compile(r"#(?: #)+")
_MASKS = re.compile(r"\*(?: \*)+")


def plain_line(line: str) -> str:
    """Lower-case words; numbers as ``#``, dates as ``@``; no signs."""
    words = " ".join("#" if w.isdecimal() else "%" if w in MONTHS else w for w in _TOKEN.findall(line.casefold()))
    return _NUMBERS.sub("#", _DATE.sub("@", words)).replace("%", "may") if "#" in words else words.replace("%", "may")


def masked(plain: str, keep: frozenset[str]) -> str:
    return _MASKS.sub("*", " ".join(w if w in keep or w in "#@" else "*" for w in plain.split()))


def fingerprint(lines: list[str], keep: frozenset[str]) -> int:
    """Key of a document's cluster: the least hash of those plain lines that hold three or more words rare in the source.
    These carry the report, so lightly revised copies mostly share the key, and notices don't make one cluster of
    different reports. A document without such a line has the hash of all its lines."""
    own = [line for line in lines if sum(w not in keep and w not in "#@" for w in line.split()) >= 3]
    digest = lambda line: int.from_bytes(hashlib.blake2b(line.encode(), digest_size=8).digest(), "little", signed=True)
    return min(map(digest, own)) if own else digest("\n".join(lines))


def _words_of_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pages per (source, word), summed over the batch before anything is shuffled; word null: pages of the source."""
    for batch in batches:
        counts: Counter = Counter()
        for source, text in zip(batch["source"], batch["text"]):
            counts.update((source, w) for w in {w for x in text.split("\n") for w in plain_line(x).split()})
            counts[source, None] += 1
        yield pd.DataFrame([(s, w, n) for (s, w), n in counts.items()], columns=["source", "word", "n"])


def _generalised(counts: dict[str, int], need: float) -> dict[str, set[str]]:
    """Wordings that reach ``need``, each with the wordings counted for it: those that do by themselves and those that do
    once up to two words are masked (two neighbours in wordings of more than 60 words)."""
    found: dict[str, set[str]] = {t: {t} for t, n in counts.items() if n >= need}
    groups: dict[str, set[str]] = defaultdict(set)
    by_one: dict[str, int] = Counter()
    for t in counts:
        words = t.split()
        open_words = [i for i, w in enumerate(words) if w not in "*#@"]
        pairs = list(combinations(open_words, 2)) if len(words) <= 60 else list(zip(open_words, open_words[1:]))
        for gone in [(), *((i,) for i in open_words), *pairs]:
            general = _MASKS.sub("*", " ".join("*" if i in gone else w for i, w in enumerate(words)))
            groups[general].add(t)
            by_one[general] += len(gone) == 1
    for general, members in groups.items():
        fixed = [w for w in general.split() if w not in "*#"]
        # the mask must stand for words that vary: rare ones are masked anyway, or three frequent ones fill it
        varies = general in counts or by_one[general] >= LEAST
        if (len(fixed) >= 2 or "@" in fixed) and varies and sum(counts[m] for m in members) >= need:
            found.setdefault(general, set()).update(members)
    return found


def _pattern(wording: str) -> str:
    return " ".join(r"\S+(?: \S+){0,7}" if w == "*" else re.escape(w) for w in wording.split())


def repeated_lines(articles: DataFrame, *, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(fetch_id, source, line_no, line) of every non-empty line whose wording stands on at least ``share`` of the
    articles of its source and on at least ``least`` of them.

    Lines are split at a line feed and numbered from 1, empty ones counted. Rows with a null source, text
    or id have none; blank lines and lines without a letter or digit are none either. Copies and most
    light revisions of a page are one cluster. A source with fewer than ``least`` clusters has no repeated line. An empty table gives no row.
    """
    pages = articles.select("fetch_id", "source", "text", F.to_date("published_at").alias("day")).where("source is not null and text is not null and fetch_id is not null")
    words = pages.select("source", "text").mapInPandas(_words_of_batch, "source string, word string, n long").groupBy("source", "word").agg(F.sum("n").alias("n"))
    total = words.where("word is null").select("source", F.col("n").alias("pages"))
    kept = cut(words.where("word is not null").join(total, "source").where(F.col("n") >= WORD_SHARE * F.col("pages")).select("source", "word", "pages"))
    blocks = max(1, -(-kept.count() // BLOCK_ROWS))
    out = None
    for block in range(blocks):
        mine = lambda df: df if blocks == 1 else df.where(F.pmod(F.xxhash64("source"), F.lit(blocks)) == block)  # noqa: B023, E731
        part = _repeated_of_block(mine(pages), mine(kept), share, least)
        out = part if out is None else out.unionByName(part)
    return out


def _repeated_of_block(pages: DataFrame, kept: DataFrame, share: float, least: int) -> DataFrame:
    context = pages.sparkSession.sparkContext
    keep: dict[str, set[str]] = defaultdict(set)
    for r in collect_bounded(kept, 4 * BLOCK_ROWS, "frequent words of a block of sources"):
        keep[r["source"]].add(r["word"])
    box = context.broadcast({s: frozenset(w) for s, w in keep.items()})

    def wordings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for source, text, day in zip(batch["source"], batch["text"], batch["day"]):
                own, lines = box.value.get(source, frozenset()), [plain_line(x) for x in text.split("\n")]
                key = fingerprint(lines, own)
                rows += [(source, w, key, day) for w in {masked(x, own) for x in lines} if w and w != "*"]
                rows.append((source, "", key, day))
            yield pd.DataFrame(rows, columns=["source", "wording", "cluster", "day"])

    seen = pages.select("source", "text", "day").mapInPandas(wordings, "source string, wording string, cluster long, day date")
    # distinct clusters first (partial, then by key), so that no wording's rows meet in one task
    counted = seen.groupBy("source", "wording", "cluster").agg(F.min("day").alias("day"), F.max("day").alias("last")).groupBy("source", "wording").agg(F.count("*").alias("n"), F.min("day").alias("first"), F.max("last").alias("last"))
    counted = cut(counted.where("n >= 2 or wording = ''"))
    clusters = counted.where("wording = ''").select("source", F.col("n").alias("all"))
    # a document has few lines, so few wordings can stand on SEED_SHARE of a source's documents
    often = counted.where("wording <> ''").join(clusters, "source").where(F.col("n") >= F.greatest(F.lit(2.0), SEED_SHARE * F.col("all")))
    by_source: dict[str, dict[str, int]] = defaultdict(dict)
    need: dict[str, float] = {}
    single: set = set()
    for r in collect_bounded(often, 4 * BLOCK_ROWS, "frequent wordings of a block of sources"):
        by_source[r["source"]][r["wording"]] = r["n"]
        need[r["source"]] = max(least, share * r["all"])
        if r["first"] is not None and r["first"] == r["last"]:
            single.add((r["source"], r["wording"]))  # one day's lines only
    found = {s: {w: m for w, m in _generalised(c, need[s]).items() if (s, w) not in single} for s, c in by_source.items()}
    # a line is matched by its masked wording, as it was counted, or by a pattern, which fits wordings too rare to be counted
    exact = context.broadcast({s: frozenset(x for w, m in ws.items() for x in {w, *m} if (s, x) not in single) for s, ws in found.items() if ws})
    patterns = context.broadcast({s: "|".join(f"(?:{_pattern(w)})" for w in sorted(ws)) for s, ws in found.items() if ws})

    def matches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled: dict[str, re.Pattern | None] = {}
        for batch in batches:
            rows = []
            for fetch_id, source, text in zip(batch["fetch_id"], batch["source"], batch["text"]):
                if source not in compiled:
                    compiled[source] = re.compile(patterns.value[source]) if source in patterns.value else None
                pattern = compiled[source]
                if pattern is None:
                    continue
                own, known = box.value.get(source, frozenset()), exact.value[source]
                rows += [(fetch_id, source, i, x) for i, x in enumerate(text.split("\n"), 1) if (p := plain_line(x)) and (masked(p, own) in known or pattern.fullmatch(p))]
            yield pd.DataFrame(rows, columns=["fetch_id", "source", "line_no", "line"])

    return pages.select("fetch_id", "source", "text").mapInPandas(matches, "fetch_id long, source string, line_no int, line string")


def cleaned_articles(articles: DataFrame, lines: DataFrame) -> DataFrame:
    """Each article with its repeated lines taken out: (fetch_id, source, text). Null texts stay null; a text of
    repeated lines only becomes empty."""
    gone = lines.groupBy("fetch_id").agg(F.collect_set("line_no").alias("gone"))  # at most the lines of one page
    rest = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), (i + 1).cast("int").alias("i"))), lambda s: F.col("gone").isNull() | ~F.array_contains("gone", s["i"]))
    text = F.when(F.col("text").isNotNull(), F.array_join(F.transform(rest, lambda s: s["x"]), "\n"))
    return articles.select("fetch_id", "source", "text").join(gone, "fetch_id", "left").select("fetch_id", "source", text.alias("text"))
