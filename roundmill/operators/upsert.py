"""Tables kept up to date by pure functions of the old table and the new rows. Writing the result beside the old
snapshot and swapping makes each step atomic and repeatable."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PENDING = ("pending", "failed")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], *, keep: tuple[str, ...] = (), order: str | None = None) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same keys; columns in ``keep`` stay as they were. Of new rows with
    equal keys the one greatest by ``order`` (else by all its columns) counts. Rows with a null key are left out of ``new``."""
    columns = old.columns
    rank = Window.partitionBy(*keys).orderBy(*([F.desc_nulls_last(order)] if order else []), *[F.desc_nulls_last(c) for c in columns if c not in keys])
    usable = new.select(*columns)
    for k in keys:
        usable = usable.where(F.col(k).isNotNull())
    last = usable.withColumn("_n", F.row_number().over(rank)).where("_n = 1").drop("_n")
    o = old.select(*[F.col(c).alias(f"o_{c}") if c not in keys else F.col(c) for c in columns], F.lit(True).alias("_old"))
    n = last.select(*[F.col(c).alias(f"n_{c}") if c not in keys else F.col(c) for c in columns], F.lit(True).alias("_new"))
    both = o.join(n, keys, "full")
    value = lambda c: F.when(F.col("_new") & ~(F.lit(c in keep) & F.coalesce("_old", F.lit(False))), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}"))
    return both.select(*[F.col(c) if c in keys else value(c).alias(c) for c in columns])


def upsert_articles(old: DataFrame, new: DataFrame) -> DataFrame:
    """By address; the state of enrichment of known pages stays."""
    return upsert(old, new, ["url"], keep=("enrichment_status", "enrichment_json"), order="fetched_at")


def upsert_runs(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, ["run_id", "source"], order="finished_at")


def mark_enrichment(articles: DataFrame, results: DataFrame) -> DataFrame:
    """Articles with the status and, where given, the JSON of their results (article_id, status, enrichment_json)."""
    r = results.groupBy("article_id").agg(F.max(F.struct("status", "enrichment_json")).alias("r"))
    done = articles.join(r, "article_id", "left")
    return done.withColumns({"enrichment_status": F.coalesce("r.status", "enrichment_status"), "enrichment_json": F.coalesce("r.enrichment_json", "enrichment_json")}).select(*articles.columns)


def merge_rounds(old: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    """Deals by round_id, in order of ``seq``: the last writer sets most fields, nulls included; name and time of
    creation are the first writer's, the confidence is the greatest."""
    both = old.unionByName(new).where("round_id is not null")
    last = [c for c in old.columns if c not in ("round_id", "company_name", "created_at", "confidence", seq)]
    return both.groupBy("round_id").agg(
        F.min_by("company_name", seq).alias("company_name"), *[F.max_by(c, seq).alias(c) for c in last],
        F.max("confidence").alias("confidence"), F.min_by("created_at", seq).alias("created_at"),
    )


def insert_links(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Links whose keys aren't held yet are added, one per key (least by the other columns); held ones stay as they are."""
    rest = [c for c in old.columns if c not in keys]
    fresh = new.select(*old.columns).join(old.select(*keys).distinct(), keys, "left_anti")
    one = fresh.groupBy(*keys).agg(*[F.min(c).alias(c) for c in rest]) if rest else fresh.distinct()
    return old.unionByName(one.select(*old.columns))


def pending_articles(articles: DataFrame, source: str | None = None, limit: int = 100) -> DataFrame:
    """The queue of pages still to be enriched, latest first; ties by fetch."""
    queue = articles.where(F.col("enrichment_status").isin(*PENDING))
    if source:
        queue = queue.where(F.col("source") == source)
    return queue.orderBy(F.desc("fetched_at"), F.asc("fetch_id")).limit(limit)


def unknown_only(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't known yet."""
    return new.join(known.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def orphans(links: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Links without a parent."""
    return links.join(parents.select(F.col(parent_key).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
