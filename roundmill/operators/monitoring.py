"""Health of sources and drift of their pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CRITICAL_STREAK, STALE_RUNS = 3, 2


def source_health(runs: DataFrame, now: Column, window_days: int = 7) -> DataFrame:
    """Per source with runs in the window: runs, errors, runs that saw nothing, mean seen (one decimal), length of the
    run of failures up to now, last success, last drift flag and status.

    A run succeeds if it has no error and saw an article; a run with unknown start is outside the window. Ties in
    start are ordered by run_id.
    """
    inside = runs.where(F.col("started_at") >= now - F.make_interval(days=F.lit(window_days)))
    ok = F.col("error").isNull() & (F.coalesce("articles_seen", F.lit(0)) > 0)
    newest = Window.partitionBy("source").orderBy(F.desc("started_at"), F.desc("run_id"))
    marked = inside.select("source", "run_id", "started_at", "error", F.coalesce("articles_seen", F.lit(0)).alias("seen"), F.coalesce("schema_drift_flag", F.lit(False)).alias("drift"), ok.alias("ok"))
    marked = marked.withColumn("good_since", F.sum(F.col("ok").cast("int")).over(newest))
    at = F.struct("started_at", "run_id")
    health = marked.groupBy("source").agg(
        F.count("*").alias("runs"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.count_if(F.col("seen") == 0).alias("zero_runs"),
        F.round(F.avg("seen"), 1).alias("mean_seen"), F.count_if(F.col("good_since") == 0).alias("streak"),
        F.max(F.when(F.col("ok"), F.col("started_at"))).alias("last_success"), F.max_by("drift", at).alias("drift"),
    )
    status = F.when(F.col("streak") >= CRITICAL_STREAK, "CRITICAL").when(F.col("drift"), "DRIFT").when(F.col("zero_runs") >= STALE_RUNS, "STALE").when(F.col("errors") > 0, "WARN").otherwise("OK")
    return health.withColumn("status", status)


def drifted(baselines: DataFrame, current: DataFrame) -> DataFrame:
    """(source, selector_key, baseline_hits, hits) of selectors that had hits and now have none; one that isn't counted
    has none. More hits than before are no drift."""
    now = current.groupBy("source", "selector_key").agg(F.min("hits").alias("hits"))
    joined = baselines.select("source", "selector_key", "baseline_hits").join(now, ["source", "selector_key"], "left")
    return joined.select("source", "selector_key", "baseline_hits", F.coalesce("hits", F.lit(0)).alias("hits")).where("baseline_hits >= 1 and hits = 0")


def next_baselines(baselines: DataFrame, current: DataFrame, updated_at: Column) -> DataFrame:
    """The baselines after a probe: sources all of whose selectors have hits, and only those, take the new counts."""
    counts = current.groupBy("source", "selector_key").agg(F.min("hits").alias("hits"))
    healthy = counts.groupBy("source").agg(F.every(F.col("hits") >= 1).alias("fine")).where("fine").select("source")
    new = counts.join(healthy, "source", "left_semi").select("source", "selector_key", F.col("hits").cast("int").alias("baseline_hits"), updated_at.alias("updated_at"))
    return baselines.join(new, ["source", "selector_key"], "left_anti").select("source", "selector_key", "baseline_hits", "updated_at").unionByName(new)


def check_and_update(baselines: DataFrame, current: DataFrame, updated_at: Column) -> tuple[DataFrame, DataFrame]:
    """(drift, baselines): drift is judged first; sources with drift keep their baselines."""
    drift = drifted(baselines, current)
    clean = current.join(drift.select("source").distinct(), "source", "left_anti")
    return drift, next_baselines(baselines, clean, updated_at)


def run_totals(runs: DataFrame) -> DataFrame:
    """Counters of each source over all its runs."""
    names = ("articles_seen", "articles_new", "articles_failed", "enriched_ok", "enriched_failed")
    return runs.groupBy("source").agg(F.count("*").alias("runs"), *[F.sum(F.coalesce(n, F.lit(0))).cast("bigint").alias(n) for n in names])
