"""From list pages and sitemaps to candidate articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundmill.operators.html import absolute, links

# Words in addresses of funding news.
FUNDING_WORDS = ("funding", "raises", "raise", "raised", "bags", "secures", "series-a", "series-b", "series-c", "series-d", "seed", "pre-seed", "investment", "investor", "mn", "million", "crore", "round", "backs", "led-by", "acquires", "acquisition", "ipo", "venture", "capital")


def about_funding(url: Column, words: tuple[str, ...] = FUNDING_WORDS) -> Column:
    return F.lower(url).rlike("|".join(w.replace("-", r"\-") for w in words))


def dated_slug(url: Column) -> Column:
    """Addresses of the form /YYYY/MM/slug of ten signs or more."""
    return url.rlike(r"/\d{4}/\d{2}/[\w-]{10,}")


def path_depth(url: Column) -> Column:
    return F.size(F.filter(F.split(F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://[^/]+", ""), r"[?#].*$", ""), "/"), lambda p: p != ""))


def outside_sections(url: Column, sections: tuple[str, ...]) -> Column:
    """First part of the path isn't one of the sections."""
    return ~F.regexp_extract(url, r"^[a-z]+://[^/]+/([^/?#]*)", 1).isin(*sections)


def candidate_links(pages: DataFrame, keep: Column, limit: int | None = None) -> DataFrame:
    """(page_id, href, place) of the links of each list page that pass ``keep`` (a predicate on ``href``), made absolute, each
    once in order of first sight, up to ``limit`` a page. ``pages`` holds page_id, url, html."""
    each = pages.select("page_id", "url", F.posexplode(links("html")).alias("pos", "l")).select("page_id", "pos", absolute(F.col("l.href"), F.col("url")).alias("href"))
    first = each.where(keep & F.col("href").rlike(r"^https?://")).groupBy("page_id", "href").agg(F.min("pos").alias("pos"))
    from pyspark.sql import Window

    placed = first.withColumn("place", F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))).drop("pos")
    return placed if limit is None else placed.where(F.col("place") <= limit)


def crawl(pages: DataFrame, keep: Column, limit: int) -> DataFrame:
    """Addresses over all list pages, each once in order of page and first sight, up to ``limit``."""
    return candidate_links(pages, keep).groupBy("href").agg(F.min(F.struct("page_id", "place")).alias("at")).orderBy("at").limit(limit).select("href")


def link_census(pages: DataFrame) -> DataFrame:
    """Links by first part of their path."""
    each = pages.select(F.explode(links("html")).alias("l")).select(F.regexp_extract("l.href", r"^(?:[a-z]+://[^/]+)?/([^/?#]*)", 1).alias("section"))
    return each.where("section <> ''").groupBy("section").agg(F.count("*").alias("n_links"))


def sitemap_entries(documents: DataFrame, keep: Column, limit: int) -> DataFrame:
    """(loc, lastmod) of sitemaps' entries that pass ``keep`` (a predicate on ``loc``), latest first. ``documents`` holds xml."""
    entry = F.explode(F.regexp_extract_all("xml", F.lit(r"(?s)<url>(.*?)</url>"), 1)).alias("e")
    inner = documents.select(entry).select(F.trim(F.regexp_extract("e", r"<loc>\s*(.*?)\s*</loc>", 1)).alias("loc"), F.regexp_extract("e", r"<lastmod>\s*(.*?)\s*</lastmod>", 1).alias("lastmod"))
    return inner.where(keep).orderBy(F.desc("lastmod"), "loc").limit(limit)


def page_addresses(spark, base: str, pages: int, style: str = "path") -> DataFrame:  # noqa: ANN001
    """(number, url) of a paged list: "path" gives base, base/page-2 ...; "query" gives base?page=1 ... pages - 1 (& if
    the base has a query); "same" gives the base alone."""
    numbers = spark.range(1, (pages if style == "query" else pages + 1) if style != "same" else 2).select(F.col("id").cast("int").alias("number"))
    root = F.lit(base.rstrip("/") if style == "path" else base)
    sign = "&" if "?" in base else "?"
    url = F.when(F.col("number") == 1, F.lit(base)).otherwise(F.concat(root, F.lit("/page-"), F.col("number"))) if style == "path" else F.concat(F.lit(base + sign + "page="), F.col("number")) if style == "query" else F.lit(base)
    return numbers.select("number", url.alias("url"))
