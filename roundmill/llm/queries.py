"""Queries of the training-data operators, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundmill.llm import canonical_values, history, leaks, name_links, page_body, reading, site_lines, survivor, tokens
from roundmill.runtime import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entry meant by each typed sector and city that isn't already one."""
    sectors, cities = table(spark, sf_dir, "ref_sectors"), table(spark, sf_dir, "ref_cities")
    mapped = canonical_values.canonical_values(table(spark, sf_dir, "sample_rounds", "sample_no", "sector", "city"), sectors, cities)
    return canonical_values.typed_cases(mapped, sectors, cities)


def p1_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of the values with no entry, and how often each stands."""
    mapped = canonical_values.canonical_values(table(spark, sf_dir, "sample_rounds", "sample_no", "sector", "city"), table(spark, sf_dir, "ref_sectors"), table(spark, sf_dir, "ref_cities"))
    return mapped.where("ref_key = 'unmatched'").groupBy("field_name", "value").agg(F.count("*").alias("n_rows"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("round_groups", "funding_rounds", "round_sources", "articles", "fx_rates")
    return survivor.judged_members(*(table(spark, sf_dir, n) for n in names))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The member of each group that gives the surviving value of each field."""
    return survivor.surviving_values(_judged(spark, sf_dir)).select("group_id", "field_name", "record_id")


def p2_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One surviving record per group, each field from its best member."""
    each = survivor.surviving_values(_judged(spark, sf_dir))
    pick = lambda f: F.max(F.when(F.col("field_name") == f, F.col("value"))).alias(f)
    return each.groupBy("group_id").agg(pick("confidence").cast("double").alias("confidence"), pick("summary"), pick("article_url"))


def p2_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link judged true of each group."""
    return survivor.true_values(_judged(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that a source prints on page after page."""
    return site_lines.repeated_lines(table(spark, sf_dir, "articles", "fetch_id", "source", "text", "published_at")).select("fetch_id", "line_no")


def p3_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every article without them."""
    articles = table(spark, sf_dir, "articles", "fetch_id", "source", "text", "published_at")
    return site_lines.cleaned_articles(articles, site_lines.repeated_lines(articles))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes of the blocks of each page's body."""
    return page_body.body_hashes(table(spark, sf_dir, "articles", "fetch_id", "source", "text", "html", "published_at"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of an entity's spellings."""
    return name_links.spelling_pairs(p6_entities(spark, sf_dir))


def p6_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per spelling with its entity."""
    return name_links.name_entities(name_links.typed_names(table(spark, sf_dir, "funding_rounds", "company_name"), table(spark, sf_dir, "round_investors", "name")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and deals of later batches that repeat one of an earlier batch."""
    articles = table(spark, sf_dir, "articles", "fetch_id", "batch_no", "url", "title", "text")
    return history.repeated_records(articles, table(spark, sf_dir, "funding_rounds"), table(spark, sf_dir, "fx_rates"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode_texts(table(spark, sf_dir, "documents", "doc_id", "text"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of held-out items."""
    return leaks.leaked_items(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "eval_items", "item_id", "text")).select("doc_id", "item_id")


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item: the documents it leaked into and its longest passage."""
    found = leaks.leaked_items(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "eval_items", "item_id", "text"))
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_documents"), F.max("n_words").alias("longest"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading level of each English document."""
    return reading.reading_levels(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "reading_labels")).select("doc_id", "reader_level")


def p10_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and words of each level."""
    levels = reading.reading_levels(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "reading_labels"))
    return levels.groupBy("reader_level").agg(F.count("*").alias("n_documents"), F.sum("n_words").alias("n_words"), F.round(F.avg("unfamiliar"), 4).alias("mean_unfamiliar"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (p1_found, p1_misses, p2_found, p2_survivors, p2_links, p3_found, p3_cleaned, p5_found, p6_found, p6_entities, p7_found, p8_ids, p9_found, p9_items, p10_found, p10_profile)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """None of these is expressible in SQL; tests compare them with brute force, round trips and held-out labels."""
    return {}
