"""Token-set similarity of names and joins on it.

The score is that of token-set comparison on a 0..100 scale: of the sorted common words and the sorted rests of
both sides, the greatest normalised indel similarity of any two of (common + rest a), (common + rest b), common;
100 where one set of words holds the other; 0 where a side has no word. A pair that scores at least t by the common
words against one side lacks few letters of that side, so it shares one of its rarest words. Any other pair has an
indel distance of at most (1 - t/100) of both lengths together: it either shares a word, or one of that many + 1
segments of the one stands unchanged, at most that far shifted, in the other. There, lengths and counts of letters
bound the distance from below, so names with a frequent word in common make no candidates by it. No pair is lost.
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundmill.runtime import cut


def longest_common(a: str, b: str) -> int:
    """Length of the longest common subsequence, all cells of a row at once in the bits of one integer."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        match = row & places.get(c, 0)
        row = (row + match | row - match) & full
    return len(a) - row.bit_count()


def indel_similarity(a: str, b: str) -> float:
    return 200.0 * longest_common(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set_ratio(a: str, b: str) -> float:
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both = " ".join(sorted(left & right))
    only_a, only_b = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    if both and (not only_a or not only_b):
        return 100.0
    full_a, full_b = f"{both} {only_a}".strip(), f"{both} {only_b}".strip()
    best = indel_similarity(full_a, full_b)
    if both:
        best = max(best, indel_similarity(both, full_a), indel_similarity(both, full_b))
    return best


@F.pandas_udf(T.DoubleType())
def token_set_score(a: pd.Series, b: pd.Series) -> pd.Series:
    """Token-set score of two columns; a null side scores 0."""
    return pd.Series([token_set_ratio(x, y) if x and y else 0.0 for x, y in zip(a, b)], dtype="float64")


def _sorted_form(text: str) -> str:
    return " ".join(sorted(set(text.split())))


def _budget(length: int, threshold: float) -> int:
    """Most edits between a string of this length and any that scores the threshold with it; the longest such partner
    allows the most."""
    return math.floor((100 - threshold) * (length + length * (200 - threshold) / threshold) / 100 + 1e-9)


def _segments(length: int, threshold: float) -> list[tuple[int, int]]:
    parts = min(length, _budget(length, threshold) + 1)
    cuts = [i * length // parts for i in range(parts + 1)]
    return list(zip(cuts, cuts[1:]))


def _shifts(length: int, other: int, threshold: float) -> range:
    """Places by which a piece of a string of this length may stand further on in one of the other length that scores the
    threshold with it. Edits come in the parity of both lengths together, and those that don't shift back make up the
    difference."""
    edits, more = math.floor((100 - threshold) * (length + other) / 100 + 1e-9), other - length
    edits -= (edits - more) % 2
    return range((more - edits) // 2, (more + edits) // 2 + 1) if edits >= abs(more) else range(0)


def _letters(text: str) -> tuple[int, int]:
    """128 bits: the first four occurrences of each of 32 classes of letters. Bits that only one of two strings has are
    never more than the edits between them."""
    seen = [0] * 32
    bits = 0
    for c in text:
        at = ord(c) % 32
        if seen[at] < 4:
            bits |= 1 << 4 * at + seen[at]
            seen[at] += 1
    low, high = bits & (1 << 64) - 1, bits >> 64
    return low - (low >> 63 << 64), high - (high >> 63 << 64)


_FORM = T.StructType([T.StructField("words", T.ArrayType(T.StringType())), T.StructField("size", T.IntegerType()), T.StructField("low", T.LongType()), T.StructField("high", T.LongType())])


@F.pandas_udf(_FORM)
def _form(text: pd.Series) -> pd.DataFrame:
    out = []
    for t in text:
        s = _sorted_form(t or "")
        out.append((s.split(), len(s), *_letters(s)))
    return pd.DataFrame(out, columns=["words", "size", "low", "high"])


def _telling(threshold: float):  # noqa: ANN202
    """Of a name's words, rarest first, as many as can't all be missing from a name that scores by its common words alone."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def telling(words: pd.Series) -> pd.Series:
        def first(ws: list[str]) -> list[str]:
            out, room = [], _missing(sum(len(w) + 1 for w in ws) - 1, threshold)
            for w in ws:
                out.append(w)
                room -= len(w) + 1
                if room < 0:
                    break
            return out

        return words.map(first)

    return telling


def _missing(size: int, threshold: float) -> int:
    """Most letters of a string of this size that a part of it may lack and still score the threshold with it."""
    return math.floor(size * (200 - 2 * threshold) / (200 - threshold) + 1e-9)


def _key_functions(threshold: float):  # noqa: ANN202
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def index(text: pd.Series) -> pd.Series:
        def keys(t: str | None) -> list[str]:
            s = _sorted_form(t or "")
            return [f"{len(s)}:{i}:{s[x:y]}" for i, (x, y) in enumerate(_segments(len(s), threshold))] if s else []

        return text.map(keys)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def probe(text: pd.Series) -> pd.Series:
        def keys(t: str | None) -> list[str]:
            s = _sorted_form(t or "")
            out = set()
            low, high = math.ceil(len(s) * threshold / (200 - threshold) - 1e-9), math.floor(len(s) * (200 - threshold) / threshold + 1e-9)
            for length in range(max(1, low), high + 1):
                shifts = _shifts(length, len(s), threshold)
                for i, (x, y) in enumerate(_segments(length, threshold)):
                    for at in range(max(0, x + shifts.start), min(len(s) - (y - x), x + shifts.stop - 1) + 1):
                        out.add(f"{length}:{i}:{s[at : at + y - x]}")
            return list(out)

        return text.map(keys)

    return index, probe


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float, *, on: tuple[str, ...] = ()) -> DataFrame:
    """(a, b, score) of every pair of distinct normal forms ``left.name`` and ``right.name`` that scores ``threshold`` or
    more, among rows that agree on the further columns ``on``.

    Empty and null names match nothing; equal names score 100. Each distinct name is compared once. Pairs that score by
    their common words alone share one of the telling words of one side; the others are alike as wholes, so their sizes
    and letters are, which is compared where keys meet and before a pair is written.
    """
    index, probe = _key_functions(threshold)
    # dealt out before they are stored, as the keys made of them are many
    parts = max(left.sparkSession.sparkContext.defaultParallelism, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    side = lambda df, c: cut(df.select(F.col("name").alias(c), *on).where("name <> ''").distinct().repartition(parts).withColumn("f", _form(c)).select(c, *on, F.struct("f.size", "f.low", "f.high").alias(f"{c}f"), F.col("f.words").alias("words")))
    a, b = side(left, "a"), side(right, "b")
    words = lambda df, c: df.select(c, *on, f"{c}f", F.explode("words").alias("key"))
    often = words(a, "a").select("key").unionByName(words(b, "b").select("key")).groupBy("key").agg(F.count("*").alias("n"))

    def telling(df: DataFrame, c: str) -> DataFrame:
        rare = words(df, c).join(often, "key").groupBy(c, *on, f"{c}f").agg(F.array_sort(F.collect_list(F.struct("n", "key"))).alias("ws"))
        return rare.select(c, *on, f"{c}f", F.explode(_telling(threshold)(F.transform("ws", lambda w: w["key"]))).alias("key"))

    lacks = lambda x, y: F.bit_count(F.col(f"{x}.low").bitwiseAND(F.bitwise_not(F.col(f"{y}.low")))) + F.bit_count(F.col(f"{x}.high").bitwiseAND(F.bitwise_not(F.col(f"{y}.high"))))
    held = lambda x, y: lacks(x, y) <= F.floor(F.col(f"{x}.size") * ((200 - 2 * threshold) / (200 - threshold)) + 1e-9)
    alike = lacks("af", "bf") + lacks("bf", "af") <= F.floor((F.col("af.size") + F.col("bf.size")) * ((100 - threshold) / 100) + 1e-9)
    # sizes of alike names are in one or two neighbouring bands
    band = lambda c: F.floor(F.log(F.col(f"{c}f.size")) / max(1.001 * math.log((200 - threshold) / threshold), 0.05))
    near = lambda df: df.withColumn("band", F.explode(F.array(*[band("a") + s for s in (-1, 0, 1)])))
    met = [
        telling(a, "a").join(words(b, "b"), ["key", *on]).where(held("af", "bf")),
        words(a, "a").join(telling(b, "b"), ["key", *on]).where(held("bf", "af")),
        near(words(a, "a")).join(words(b, "b").withColumn("band", band("b")), ["key", "band", *on]).where(alike),
        a.select("a", *on, "af", F.explode(probe("a")).alias("key")).withColumn("key", F.xxhash64("key")).join(b.select("b", *on, "bf", F.explode(index("b")).alias("key")).withColumn("key", F.xxhash64("key")), ["key", *on]).where(alike),
    ]
    candidates = reduce(DataFrame.unionByName, [m.select("a", "b", *on) for m in met]).distinct()
    return candidates.withColumn("score", token_set_score("a", "b")).where(F.col("score") >= threshold)


def best_match(pairs: DataFrame, order: Column) -> DataFrame:
    """The best b of each a: greatest score, then the least ``order``."""
    return pairs.groupBy("a").agg(F.min_by(F.struct("b", "score"), F.struct(-F.col("score"), order)).alias("m")).select("a", "m.b", "m.score")
