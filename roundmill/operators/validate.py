"""Rules of extracted deals: what breaks one is set aside with its reasons, all else becomes a deal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundmill.functions.deals import merged_investors, round_id, with_dollars
from roundmill.functions.text import clean_company
from roundmill.schema import CURRENCIES, MAX_USD, STAGE_LABELS


def violations(today: Column, *, max_usd: float = MAX_USD) -> Column:
    """Names of the rules a row breaks: negative amount, too many dollars, a day to come, unknown stage or currency,
    confidence outside 0..1. Unknown values break none."""
    rules = [
        ("negative_amount", F.col("amount") < 0), ("too_many_dollars", F.col("amount_usd") > max_usd), ("future_day", F.col("announced_on") > today),
        ("unknown_stage", ~F.col("stage").isin(*STAGE_LABELS)), ("unknown_currency", ~F.col("currency").isin(*CURRENCIES)),
        ("confidence_range", (F.col("confidence") < 0) | (F.col("confidence") > 1)),
    ]
    return F.filter(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules]), lambda r: r.isNotNull())


def split_valid(rows: DataFrame, today: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows carry ``reasons``."""
    checked = rows.withColumn("reasons", violations(today))
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0)


def build_rounds(results: DataFrame, published_on: str = "published_on") -> DataFrame:
    """Deals from extraction results: rows without a company are dropped, the day falls back to the publication, the stage
    to undisclosed, dollars to the fixed rate; investors are made distinct (a later lead counts), the id is made."""
    named = results.withColumn("company_name", clean_company(F.col("company_name"))).where("company_name is not null")
    full = named.withColumns(
        {
            "announced_on": F.coalesce("announced_on", F.col(published_on).cast("date")),
            "stage": F.coalesce("stage", F.lit("undisclosed")),
            "amount_usd": with_dollars(F.col("amount"), F.col("currency"), F.col("amount_usd")),
            "investors": merged_investors("investors"),
        }
    )
    return full.withColumn("round_id", round_id(F.col("company_name"), F.col("announced_on"), F.col("amount_usd")))
