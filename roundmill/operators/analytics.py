"""Export view and aggregates of deals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundmill.functions.deals import day_text, format_amount, format_stage, whole_dollars
from roundmill.functions.sectors import sector_label
from roundmill.schema import STAGE_LABELS

#: Columns of the public export, in order.
PUBLIC_COLUMNS = ("company_name", "sector", "stage", "amount", "amount_usd", "announced_on", "lead_investor", "investors", "sources", "confidence", "summary")
BUCKETS = ((0, 1e6, "<1M"), (1e6, 5e6, "1-5M"), (5e6, 20e6, "5-20M"), (20e6, 50e6, "20-50M"), (50e6, 100e6, "50-100M"), (100e6, None, "100M+"))
SEP = " | "


def joined_rounds(rounds: DataFrame, investors: DataFrame, sources: DataFrame, min_confidence: float | None = 0.0) -> DataFrame:
    """Deals with their investors, lead and sources, all ordered by name: links are made distinct and grouped before the
    join. The lead is the first in order of those marked. A null confidence fails any minimum; None asks for none."""
    kept = rounds if min_confidence is None else rounds.where(F.col("confidence") >= min_confidence)
    people = investors.where("name is not null").groupBy("round_id").agg(F.array_sort(F.collect_set("name")).alias("investor_list"), F.min(F.when(F.col("lead") == 1, F.col("name"))).alias("lead_investor"))
    links = sources.where("article_url is not null").groupBy("round_id").agg(F.array_sort(F.collect_set("article_url")).alias("source_list"))
    out = kept.join(people, "round_id", "left").join(links, "round_id", "left")
    empty = F.array().cast("array<string>")
    sector, city = F.get_json_object("company_json", "$.sector"), F.get_json_object("company_json", "$.city")
    return out.withColumns({"investor_list": F.coalesce("investor_list", empty), "source_list": F.coalesce("source_list", empty), "sector": sector, "city": city})


def public_rows(joined: DataFrame, *more: str) -> DataFrame:
    """Display strings and raw values of each deal, lists still as arrays."""
    stage = F.nullif(F.lower(F.trim("stage")), F.lit(""))
    sector = F.nullif(F.lower(F.trim("sector")), F.lit(""))
    usd = whole_dollars(F.col("amount_usd"))
    text = lambda c: F.coalesce(c, F.lit(""))
    return joined.select(
        *more, text("company_name").alias("company_name"), sector_label(sector).alias("sector"), sector.alias("sector_raw"), format_stage(stage).alias("stage"), stage.alias("stage_raw"),
        format_amount(F.col("amount_usd"), F.col("amount"), F.col("currency")).alias("amount"), F.round(usd, 2).alias("amount_usd"), usd.alias("amount_usd_raw"), text("currency").alias("currency"),
        day_text(F.col("announced_on")).alias("announced_on"), text("lead_investor").alias("lead_investor"), F.col("investor_list").alias("investors"), F.col("source_list").alias("sources"),
        F.coalesce(F.round("confidence", 3), F.lit(0.0)).alias("confidence"), text("summary").alias("summary"), text("city").alias("city"),
    )


def export_order(*ties: str) -> list[Column]:
    """Most certain first, then latest, unknown days last; ``ties`` make the order total."""
    return [F.desc_nulls_last("confidence"), F.desc_nulls_last("announced_on"), *[F.asc(t) for t in ties]]


def investor_agg(joined: DataFrame) -> DataFrame:
    """Per investor: deals, deals led, dollars in all of them (unknown sums count as nothing)."""
    each = joined.select(F.explode("investor_list").alias("name"), "lead_investor", F.coalesce("amount_usd", F.lit(0.0)).alias("usd"))
    return each.groupBy("name").agg(F.count("*").alias("deals"), F.count_if(F.col("name") == F.col("lead_investor")).alias("leads"), F.sum("usd").alias("total_usd"))


def co_investments(joined: DataFrame, least: int = 2) -> DataFrame:
    """Pairs of investors in one deal, each pair in name order, with how many deals they share.

    The pairs of a deal come from its own list, so the work is bounded by the deals' lists; counts are combined
    before they are shuffled.
    """
    names = F.col("investor_list")
    pairs = F.flatten(F.transform(names, lambda a: F.transform(F.filter(names, lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return joined.select(F.explode(pairs).alias("p")).groupBy(F.col("p.a").alias("name_a"), F.col("p.b").alias("name_b")).agg(F.count("*").alias("deals")).where(F.col("deals") >= least)


def investor_kpis(joined: DataFrame) -> DataFrame:
    """One row: investors, pairs with two deals or more, the most active, how many led."""
    people = investor_agg(joined)
    top = people.agg(F.count("*").alias("unique_investors"), F.min_by("name", F.struct(-F.col("deals"), F.col("name"))).alias("most_active"), F.count_if(F.col("leads") > 0).alias("with_leads"))
    return top.join(co_investments(joined).agg(F.count("*").alias("pairs")))


def company_rollup(rounds: DataFrame) -> DataFrame:
    """Per company: number of deals, dollars, first known sector in order of record. The timeline is a table of its own."""
    sector = F.nullif(F.trim(F.get_json_object("company_json", "$.sector")), F.lit(""))
    return rounds.where("company_name is not null").groupBy("company_name").agg(
        F.count("*").alias("n_rounds"), F.sum(F.coalesce("amount_usd", F.lit(0.0))).alias("total_usd"),
        F.min_by(F.when(sector.isNotNull(), sector), F.when(sector.isNotNull(), F.col("record_id"))).alias("sector"),
    )


def company_timeline(rounds: DataFrame) -> DataFrame:
    """Each deal's place in its company's timeline, unknown days first: one row per deal, so a company with a great
    many deals is sorted and spilled, never held as one list."""
    from pyspark.sql import Window

    order = Window.partitionBy("company_name").orderBy(F.col("announced_on").asc_nulls_first(), "record_id")
    return rounds.where("company_name is not null").select("company_name", F.row_number().over(order).alias("place"), "record_id", day_text(F.col("announced_on")).alias("day"), "stage", "amount_usd", "confidence")


def kpis(rounds: DataFrame) -> DataFrame:
    """One row: dollars, deals, mean of the disclosed sums (not unknown, not zero), most frequent stage (ties by name)."""
    disclosed = F.col("amount_usd").isNotNull() & (F.col("amount_usd") != 0)
    sums = rounds.agg(F.sum(F.coalesce("amount_usd", F.lit(0.0))).alias("total_usd"), F.count("*").alias("n_rounds"), F.try_divide(F.sum(F.when(disclosed, F.col("amount_usd"))), F.count_if(disclosed)).alias("mean_disclosed"))
    stages = rounds.where("stage is not null").groupBy("stage").count().agg(F.min_by("stage", F.struct(-F.col("count"), F.col("stage"))).alias("top_stage"))
    return sums.join(stages)


def dashboard_meta(joined: DataFrame) -> DataFrame:
    """One row: totals, greatest sum, stages and sectors present, distinct companies and investors."""
    usd = F.nullif(F.round(whole_dollars(F.col("amount_usd")), 2), F.lit(0.0))
    stage, sector = F.nullif(F.lower(F.trim("stage")), F.lit("")), F.nullif(F.lower(F.trim("sector")), F.lit(""))
    base = joined.agg(
        F.count("*").alias("total_rounds"), F.coalesce(F.sum(usd), F.lit(0.0)).alias("total_usd"), F.coalesce(F.max(usd), F.lit(0.0)).alias("max_amount_usd"),
        F.array_join(F.array_sort(F.collect_set(stage)), ",").alias("stages_present"), F.countDistinct(sector).alias("sectors_present"), F.countDistinct(F.coalesce("company_name", F.lit(""))).alias("unique_companies"),
    )
    people = joined.select(F.explode("investor_list").alias("n")).agg(F.countDistinct("n").alias("unique_investors"))
    return base.join(people)


def monthly_timeline(rounds: DataFrame) -> DataFrame:
    return rounds.where("announced_on is not null").groupBy(F.date_format("announced_on", "yyyy-MM").alias("month")).agg(F.sum(F.coalesce("amount_usd", F.lit(0.0))).alias("total_usd"), F.count("*").alias("n_rounds"))


def stage_distribution(rounds: DataFrame) -> DataFrame:
    """Deals per stage that occurs, with its place in the order of a company's life; unknown stages are left out."""
    place = F.create_map(*[F.lit(x) for i, s in enumerate(STAGE_LABELS) for x in (s, i)])
    return rounds.groupBy("stage").agg(F.count("*").alias("n_rounds")).withColumn("place", F.try_element_at(place, F.col("stage"))).where("place is not null")


def top_sectors(joined: DataFrame, n: int = 10) -> DataFrame:
    known = joined.select(F.nullif(F.trim("sector"), F.lit("")).alias("sector"), F.coalesce("amount_usd", F.lit(0.0)).alias("usd")).where("sector is not null")
    return known.groupBy("sector").agg(F.sum("usd").alias("total_usd")).orderBy(F.desc("total_usd"), "sector").limit(n)


def sector_mix(joined: DataFrame, n: int = 8) -> DataFrame:
    """(month, sector, n_rounds) with every combination of the months and the ``n`` most frequent sectors and "Other";
    unknown sectors are "Unknown". The list of sectors is n + 1 rows by its definition."""
    base = joined.where("announced_on is not null").select(F.date_format("announced_on", "yyyy-MM").alias("month"), F.coalesce(F.nullif(F.trim("sector"), F.lit("")), F.lit("Unknown")).alias("sector"))
    top = F.broadcast(base.groupBy("sector").count().orderBy(F.desc("count"), "sector").limit(n).select("sector", F.lit(True).alias("top")))
    mixed = base.join(top, "sector", "left").withColumn("sector", F.when(F.col("top"), F.col("sector")).otherwise("Other"))
    counts = mixed.groupBy("month", "sector").agg(F.count("*").alias("n"))
    grid = mixed.select("month").distinct().join(F.broadcast(mixed.select("sector").distinct().limit(n + 1)))
    return grid.join(counts, ["month", "sector"], "left").select("month", "sector", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rounds"))


def amount_histogram(rounds: DataFrame) -> DataFrame:
    """Deals by size of sum, empty sizes kept; unknown sums and zero are in none."""
    spark = rounds.sparkSession
    sizes = F.broadcast(spark.createDataFrame([(i, label) for i, (_, _, label) in enumerate(BUCKETS)], "place int, bucket string"))
    at = F.lit(None).cast("int")
    for i, (low, high, _) in enumerate(BUCKETS):
        inside = (F.col("amount_usd") >= low) & (F.lit(True) if high is None else F.col("amount_usd") < high)
        at = F.coalesce(at, F.when(inside & (F.col("amount_usd") != 0), F.lit(i)))
    counts = rounds.select(at.alias("place")).where("place is not null").groupBy("place").agg(F.count("*").alias("n"))
    return sizes.join(counts, "place", "left").select("place", "bucket", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rounds"))


def filtered(rows: DataFrame, *, since: str | None = None, until: str | None = None, stages: tuple[str, ...] = (), sectors: tuple[str, ...] = (), min_confidence: float = 0.0, min_usd: float = 0.0, search: str = "") -> DataFrame:
    """Interactive filter over ``public_rows``: unknown days pass the range, an empty set is no filter, an unknown sum counts
    as 0, the search looks for a substring of company, sector, summary, lead and investors in lower case."""
    keep = F.lit(True)
    day = F.col("announced_on")
    if since:
        keep = keep & ((day == "") | (day >= since))
    if until:
        keep = keep & ((day == "") | (day <= until))
    if stages:
        keep = keep & F.col("stage_raw").isin(*stages)
    if sectors:
        keep = keep & F.col("sector").isin(*sectors)
    keep = keep & (F.col("confidence") >= min_confidence) & (F.coalesce("amount_usd", F.lit(0.0)) >= min_usd)
    if search:
        hay = F.lower(F.concat_ws(" ", "company_name", "sector", "summary", "lead_investor", F.array_join("investors", " ")))
        keep = keep & hay.contains(search.lower())
    return rows.where(keep)


def page(rows: DataFrame, number: int, size: int = 25, *, order: list[Column]) -> DataFrame:
    """One page (from 1) of the ordered rows."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def page_count(rows: DataFrame, size: int = 25) -> DataFrame:
    return rows.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / size)).cast("bigint").alias("pages"))


def round_steps(rounds: DataFrame) -> DataFrame:
    """Extension: each dated deal's number among those of its company, days since the one before, running dollars."""
    from pyspark.sql import Window

    w = Window.partitionBy("company_name").orderBy("announced_on", "record_id")
    dated = rounds.where("company_name is not null and announced_on is not null")
    return dated.select("record_id", F.row_number().over(w).alias("step"), F.datediff("announced_on", F.lag("announced_on").over(w)).cast("bigint").alias("days_since"), F.sum(F.coalesce("amount_usd", F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_usd"))
