"""Canonical names of companies and investors, and the alias tables that remember them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundmill.functions.deals import first_of_each_name, round_id
from roundmill.functions.sectors import SECTOR_ALIASES, NEAR, exact_sector, plain_sector
from roundmill.functions.text import normalize_company, normalize_investor
from roundmill.functions.urls import canonical_url
from roundmill.operators.similarity import best_match, similar_pairs, token_set_score
from roundmill.runtime import broadcast_if_small, cut

COMPANY_SCORE = 92
MAX_ALIASES = 1_000_000


def resolve_companies(names: DataFrame, known: DataFrame, aliases: DataFrame, *, threshold: float = COMPANY_SCORE) -> DataFrame:
    """(name, canonical, how): the alias of the normal form, else the known name most like it (ties to the least ordinal),
    else the name itself. ``known`` holds name and ordinal. A name empty in normal form stays as it is."""
    own = names.select("name").where("name is not null").distinct().withColumn("norm", normalize_company(F.col("name")))
    alias = own.join(broadcast_if_small(aliases.select(F.col("alias_norm").alias("norm"), F.col("canonical").alias("by_alias")), MAX_ALIASES), "norm", "left")
    open_ = alias.where("by_alias is null and norm <> ''").select(F.col("norm").alias("name")).distinct()
    listed = known.select(F.col("name").alias("listed"), normalize_company(F.col("name")).alias("name"), "ordinal").where("name <> ''")
    first = listed.groupBy("name").agg(F.min_by("listed", "ordinal").alias("listed"), F.min("ordinal").alias("ordinal"))
    pairs = similar_pairs(open_, first, threshold).join(first.select(F.col("name").alias("b"), "listed", "ordinal"), "b")
    match = best_match(pairs.select("a", F.col("listed").alias("b"), "score", "ordinal"), F.col("ordinal")).select(F.col("a").alias("norm"), F.col("b").alias("by_score"))
    how = F.when(F.col("by_alias").isNotNull(), "alias").when(F.col("by_score").isNotNull(), "similar").otherwise("new")
    return alias.join(match, "norm", "left").select("name", F.coalesce("by_alias", "by_score", "name").alias("canonical"), how.alias("how"))


def resolve_investors(names: DataFrame, known: DataFrame, aliases: DataFrame) -> DataFrame:
    """(name, canonical, how): the alias of the normal form, else the first known name of that form, else the name."""
    own = names.select("name").where("name is not null").distinct().withColumn("norm", normalize_investor(F.col("name")))
    alias = aliases.select(F.col("alias_norm").alias("norm"), F.col("canonical").alias("by_alias"))
    first = known.select(normalize_investor(F.col("name")).alias("norm"), "name", "ordinal").where("norm <> ''").groupBy("norm").agg(F.min_by("name", "ordinal").alias("by_form"))
    joined = own.join(broadcast_if_small(alias, MAX_ALIASES), "norm", "left").join(first, "norm", "left")
    how = F.when(F.col("by_alias").isNotNull(), "alias").when(F.col("by_form").isNotNull(), "same form").otherwise("new")
    return joined.select("name", F.coalesce("by_alias", "by_form", "name").alias("canonical"), how.alias("how"))


def record_aliases(aliases: DataFrame, new: DataFrame) -> DataFrame:
    """The alias table with the new rows whose alias it doesn't hold; of new rows with one alias the earliest, then the
    least canonical counts. Adding twice changes nothing."""
    fresh = new.where("alias_norm is not null").groupBy("alias_norm").agg(F.min(F.struct("created_at", "canonical")).alias("m")).select("alias_norm", "m.canonical", "m.created_at")
    return aliases.unionByName(fresh.join(aliases.select("alias_norm"), "alias_norm", "left_anti"))


def normalize_sectors(values: DataFrame) -> DataFrame:
    """(raw, sector) of each distinct raw value: exact and decorated names, near misses (ties to the first phrase), else
    ``other``; null for null and blank. Slugs of the vocabulary stay themselves."""
    spark = values.sparkSession
    phrases = F.broadcast(spark.createDataFrame([(i, a, s) for i, (a, s) in enumerate(SECTOR_ALIASES.items())], "ordinal int, phrase string, slug string"))
    own = values.select("raw").distinct().select("raw", plain_sector(F.col("raw")).alias("plain"), exact_sector(F.col("raw")).alias("exact"))
    # the phrases are a fixed list, so each open value meets them as one block
    near = own.where("exact is null and plain is not null").select("plain").distinct().join(phrases).withColumn("score", token_set_score("plain", "phrase")).where(F.col("score") >= NEAR)
    best = near.groupBy("plain").agg(F.min_by("slug", F.struct(-F.col("score"), "ordinal")).alias("near"))
    out = F.when(F.col("plain").isNull(), None).otherwise(F.coalesce("exact", "near", F.lit("other")))
    return own.join(best, "plain", "left").select("raw", out.alias("sector"))


def canonical_rounds(rounds: DataFrame, companies: DataFrame, investors: DataFrame) -> DataFrame:
    """Deals under canonical names: company renamed, id made anew, investors renamed and made distinct (the first
    mention counts). ``rounds`` holds company_name, announced_on, amount_usd and investors array<struct<name, lead>>."""
    named = rounds.join(companies.select(F.col("name").alias("company_name"), "canonical"), "company_name", "left").withColumn("company_name", F.coalesce("canonical", "company_name")).drop("canonical")
    keyed = cut(named.withColumn("_row", F.monotonically_increasing_id()))  # stored, so that both branches see the same numbers
    each = keyed.select("_row", F.posexplode("investors").alias("pos", "i")).select("_row", "pos", F.col("i.name").alias("name"), F.col("i.lead").alias("lead"))
    renamed = each.join(investors.select("name", "canonical"), "name", "left").select("_row", "pos", F.coalesce("canonical", "name").alias("name"), "lead")
    lists = renamed.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name", "lead"))), lambda x: F.struct(x["name"].alias("name"), x["lead"].alias("lead"))).alias("investors"))
    empty = F.array().cast("array<struct<name:string,lead:boolean>>")
    done = keyed.drop("investors").join(lists, "_row", "left").drop("_row").withColumn("investors", first_of_each_name(F.coalesce("investors", empty)))
    return done.withColumn("round_id", round_id(F.col("company_name"), F.col("announced_on"), F.col("amount_usd")))


def backfill_sectors(rounds: DataFrame, sources: DataFrame, articles: DataFrame) -> DataFrame:
    """(round_id, old_sector, new_sector, outcome) of each deal: the sector of its first linked article that names one.
    Outcomes: updated, already_ok, skipped (no article names a sector)."""
    old = rounds.select("round_id", F.lower(F.trim(F.get_json_object("company_json", "$.sector"))).alias("old_sector")).groupBy("round_id").agg(F.min("old_sector").alias("old_sector"))
    page = lambda c: F.coalesce(canonical_url(F.col(c)), F.col(c)).alias("url")  # noqa: E731 - links are written in many ways
    named = articles.select(page("url"), F.get_json_object("enrichment_json", "$.sector").alias("raw")).where("raw is not null and trim(raw) <> ''")
    linked = sources.select("round_id", page("article_url")).distinct().join(named, "url").groupBy("round_id").agg(F.min_by("raw", F.struct("url", "raw")).alias("raw"))
    slug = linked.join(normalize_sectors(linked), "raw", "left").select("round_id", F.col("sector").alias("new_sector"))
    outcome = F.when(F.col("new_sector").isNull(), "skipped").when(F.col("old_sector") == F.col("new_sector"), "already_ok").otherwise("updated")
    return old.join(slug, "round_id", "left").select("round_id", "old_sector", "new_sector", outcome.alias("outcome"))


def backfill_names(links: DataFrame, investors: DataFrame) -> DataFrame:
    """The link table of investors under canonical names; rows that become equal are one, a lead among them counts."""
    renamed = links.join(investors.select("name", "canonical"), "name", "left")
    return renamed.select("round_id", F.coalesce("canonical", "name").alias("name"), "lead").groupBy("round_id", "name").agg(F.max("lead").alias("lead"))
