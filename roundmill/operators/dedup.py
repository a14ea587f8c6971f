"""Near-duplicate deals: names alike, days and sums close."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundmill.functions.text import normalize_company
from roundmill.operators.similarity import similar_pairs
from roundmill.runtime import cut

NAME_SCORE, DAYS, SHARE = 88, 3, 0.15


def days_close(a: Column, b: Column, days: int = DAYS) -> Column:
    """Within the days, or one of them unknown."""
    return a.isNull() | b.isNull() | (F.abs(F.datediff(a, b)) <= days)


def sums_close(a: Column, b: Column, share: float = SHARE) -> Column:
    """Apart by at most the share of the larger, or one of them unknown; two zeros are close."""
    return a.isNull() | b.isNull() | (F.abs(a - b) <= share * F.greatest(a, b))


def band_pairs(new: DataFrame, old: DataFrame, days: int = DAYS, share: float = SHARE) -> DataFrame:
    """(new_id, old_id) of deals of one normal name with close days and sums; rows need id, name, announced_on, amount_usd.

    Dated deals meet in day buckets; undated ones meet all deals of their name, which costs a square where a company has many.
    """
    keyed = lambda df: df.select("id", "announced_on", "amount_usd", F.col("name").alias("key"))
    return _banded(keyed(new), keyed(old), days, share).select("new_id", "old_id").distinct()


def _banded(new: DataFrame, old: DataFrame, days: int, share: float) -> DataFrame:
    """Pairs that share a key, with close days and sums; columns besides those of a deal are kept."""
    side = lambda df, p: df.withColumnsRenamed({"id": f"{p}_id", "announced_on": f"{p}_day", "amount_usd": f"{p}_usd"})
    a, b = side(new, "new"), side(old, "old")
    bucket = lambda c: F.floor(F.unix_date(c) / (days + 1))
    dated_a = a.where("new_day is not null").withColumn("bucket", F.explode(F.array(*[bucket(F.col("new_day")) + s for s in (-1, 0, 1)])))
    dated_b = b.where("old_day is not null").withColumn("bucket", bucket(F.col("old_day")))
    close = days_close(F.col("new_day"), F.col("old_day"), days) & sums_close(F.col("new_usd"), F.col("old_usd"), share) & (F.col("new_id") != F.col("old_id"))
    dated = dated_a.join(dated_b, ["key", "bucket"]).where(close).drop("bucket")
    loose = a.where("new_day is null").join(b, "key").where(close)
    loose_too = a.where("new_day is not null").join(b.where("old_day is null"), "key").where(close)
    return dated.unionByName(loose).unionByName(loose_too)


def existing_rounds(new: DataFrame, old: DataFrame, *, threshold: float = NAME_SCORE, days: int = DAYS, share: float = SHARE) -> DataFrame:
    """(new_id, old_id, score): for each new deal the known deal it repeats, by greatest name score, ties to the least
    ``ordinal`` of the known ones. Inputs hold id, company_name, announced_on, amount_usd; ``old`` also ordinal.

    Names that are empty in normal form match nothing. Missing days and sums match any. Each distinct name is compared
    once; deals meet only under names that are alike.
    """
    tidy = lambda df, *more: df.select("id", normalize_company(F.col("company_name")).alias("name"), "announced_on", "amount_usd", *more).where("name <> ''")
    a, b = tidy(new), tidy(old, "ordinal")
    pairs = cut(similar_pairs(a, b, threshold)).select(F.col("a").alias("name"), F.col("b").alias("key"), "score")
    ranked = _banded(a.join(pairs, "name").drop("name"), b.withColumnRenamed("name", "key"), days, share)
    return ranked.groupBy("new_id").agg(F.min_by(F.struct("old_id", "score"), F.struct(-F.col("score"), "ordinal")).alias("m")).select("new_id", "m.old_id", "m.score")


def rounds_side(rounds: DataFrame, id_col: str = "record_id") -> DataFrame:
    """id, company_name, announced_on, amount_usd, ordinal of a table of deals."""
    return rounds.select(F.col(id_col).alias("id"), "company_name", "announced_on", "amount_usd", F.col(id_col).alias("ordinal"))
