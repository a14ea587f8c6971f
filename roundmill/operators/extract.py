"""Deals from headlines and texts: by patterns, by an outside model, by both."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundmill.functions.deals import extract_amount, extract_announced_on, extract_company, extract_investors, extract_stage
from roundmill.functions.payload import coerce_json, sanitize_payload
from roundmill.schema import ENRICHMENT

LOW_CONFIDENCE = 0.35
MODEL_CHARS = 8000


def pattern_extract(title: Column, text: Column, published_at: Column) -> Column:
    """A typed struct read by patterns. Sums and stages are looked for in the text before the title; the confidence grows
    by 0.2 for each of company, sum, stage and investors found, up to 0.85. Null inputs count as empty."""
    title, text = F.coalesce(title, F.lit("")), F.coalesce(text, F.lit(""))
    both = F.concat(text, F.lit("\n"), title)
    amount, stage, company, people = extract_amount(both), extract_stage(both), extract_company(title), extract_investors(text)
    point = lambda c: F.when(c, 0.2).otherwise(0.0)
    score = F.least(F.lit(0.85), F.round(0.2 + point(company.isNotNull()) + point(amount["amount"].isNotNull()) + point(stage != "undisclosed") + point(F.size(people) > 0), 2))
    return F.struct(
        company.alias("company_name"), F.lit(None).cast("string").alias("sector"), stage.alias("stage"), amount["amount"].alias("amount"), amount["currency"].alias("currency"),
        amount["amount_usd"].alias("amount_usd"), extract_announced_on(published_at, text).alias("announced_on"), people.alias("investors"),
        F.lit(None).cast("string").alias("location"), F.lit(None).cast("string").alias("summary"), score.alias("confidence"), F.lit("regex_fallback").alias("extraction_method"),
    )


def model_answers(articles: DataFrame, answer: Callable[[str, str], str | None], models: tuple[str, ...] = ("default",)) -> DataFrame:
    """(article_id, model, raw) of an outside model: ``answer(model, text)`` gets the first 8000 characters, as its interface
    allows no more. A model that raises is given up for the rest of the partition and the next one is asked; where all
    fail, raw is null. Runs in Arrow batches where the articles lie."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = 0
        for batch in batches:
            rows = []
            for article_id, text in zip(batch["article_id"], batch["text"]):
                raw = None
                while raw is None and at < len(models):
                    try:
                        raw = answer(models[at], (text or "")[:MODEL_CHARS])
                        break
                    except Exception:  # noqa: BLE001 - any failure of an outside model moves on to the next
                        at += 1
                rows.append((article_id, models[at] if at < len(models) else None, raw))
            yield pd.DataFrame(rows, columns=["article_id", "model", "raw"])

    return articles.select("article_id", "text").mapInPandas(run, "article_id string, model string, raw string")


def parsed_answer(raw: Column) -> Column:
    """The typed struct of a raw answer, marked as the model's; null where it holds no JSON object."""
    s = sanitize_payload(coerce_json(raw))
    fields = [s[f.split(" ")[0]].alias(f.split(" ")[0]) for f in ENRICHMENT.replace("struct<name:string,lead:boolean>", "struct").split(", ") if not f.startswith("extraction_method")]
    return F.when(s.isNotNull(), F.struct(*fields, F.lit("llm").alias("extraction_method")))


def merged(model: Column, pattern: Column) -> Column:
    """The model's struct with its gaps filled from the pattern's: eight fields where null or empty, investors where none;
    confidence 0.6 and 0.3 of both, at most 0.75. The sector is the model's alone."""
    text = lambda f: F.coalesce(F.nullif(model[f], F.lit("")), pattern[f]).alias(f)
    other = lambda f: F.coalesce(model[f], pattern[f]).alias(f)
    people = F.when(F.size(F.coalesce(model["investors"], F.array().cast("array<struct<name:string,lead:boolean>>"))) > 0, model["investors"]).otherwise(pattern["investors"])
    return F.struct(
        text("company_name"), model["sector"].alias("sector"), text("stage"), other("amount"), text("currency"), other("amount_usd"), other("announced_on"), people.alias("investors"),
        text("location"), text("summary"), F.least(F.lit(0.75), 0.6 * model["confidence"] + 0.3 * pattern["confidence"]).alias("confidence"), F.lit("llm+regex").alias("extraction_method"),
    )


def enrich(articles: DataFrame, answers: DataFrame | None = None, *, low: float = LOW_CONFIDENCE) -> DataFrame:
    """(article_id, status, result): the model's answer where sure enough (ok), merged with the patterns where it is not
    (fallback), the patterns where there is none (fallback). ``answers`` holds article_id and raw."""
    base = articles.select("article_id", pattern_extract(F.col("title"), F.col("text"), F.col("published_at")).alias("rx"))
    if answers is None:
        return base.select("article_id", F.lit("fallback").alias("status"), F.col("rx").alias("result"))
    one = answers.groupBy("article_id").agg(F.max("raw").alias("raw"))
    both = base.join(one, "article_id", "left").withColumn("llm", parsed_answer(F.col("raw")))
    sure = F.col("llm").isNotNull() & (F.col("llm.confidence") >= low)
    result = F.when(sure, F.col("llm")).when(F.col("llm").isNotNull(), merged(F.col("llm"), F.col("rx"))).otherwise(F.col("rx"))
    return both.select("article_id", F.when(sure, "ok").otherwise("fallback").alias("status"), result.alias("result"))
