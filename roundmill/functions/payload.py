"""JSON answers of an extraction model: fences, stray prose, loose types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roundmill.functions.sectors import exact_sector, plain_sector

_TEXTS = ("company_name", "stage", "currency", "announced_on", "location", "summary", "sector")
_NUMBERS = ("amount", "amount_usd", "confidence")


def strip_fence(raw: Column) -> Column:
    """The text between code fences, or the text itself, trimmed."""
    text = F.trim(raw)
    inner = F.regexp_replace(F.regexp_replace(text, r"^```(?:json)?\s*", ""), r"\s*```$", "")
    return F.trim(F.when(text.startswith("```"), inner).otherwise(text))


def coerce_json(raw: Column) -> Column:
    """Text of the JSON object: the whole, or the outermost braces within prose; null where neither parses."""
    text = strip_fence(raw)
    braces = F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))
    valid = lambda t: F.when(F.try_parse_json(t).isNotNull(), t)
    return F.coalesce(valid(text), valid(braces))


def sanitize_payload(json_text: Column) -> Column:
    """A typed struct of the answer: "" and "null" as null, numbers out of strings like "1,500,000", investors given as
    strings or objects, stage in lower and currency in upper case, sector as a slug where named exactly (else as
    typed, in lower case), confidence within 0..1 and 0 where it is no number. Bad JSON gives a null struct."""
    blank = lambda c: F.nullif(F.nullif(c, F.lit("")), F.lit("null"))
    text = {k: blank(F.get_json_object(json_text, f"$.{k}")) for k in _TEXTS}
    shown = {k: blank(F.get_json_object(json_text, f"$.{k}")) for k in _NUMBERS}
    number = {k: F.coalesce(v.try_cast("double"), F.nullif(F.regexp_replace(v, r"[^\d.\-]", ""), F.lit("")).try_cast("double")) for k, v in shown.items()}
    clamped = F.when(number["confidence"].isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), number["confidence"])))
    investors = F.from_json(F.get_json_object(json_text, "$.investors"), "array<string>")
    one = lambda x: F.when(x.startswith("{"), F.struct(F.get_json_object(x, "$.name").alias("name"), F.coalesce(F.get_json_object(x, "$.lead").try_cast("boolean"), F.lit(False)).alias("lead"))).otherwise(F.struct(x.alias("name"), F.lit(False).alias("lead")))
    people = F.filter(F.transform(F.coalesce(investors, F.array().cast("array<string>")), one), lambda x: F.coalesce(x["name"], F.lit("")) != "")
    fields = [
        text["company_name"].alias("company_name"), F.coalesce(exact_sector(text["sector"]), plain_sector(text["sector"])).alias("sector"),
        F.lower(F.trim(text["stage"])).alias("stage"), number["amount"].alias("amount"), F.upper(F.trim(text["currency"])).alias("currency"),
        number["amount_usd"].alias("amount_usd"), text["announced_on"].try_cast("date").alias("announced_on"), people.alias("investors"),
        text["location"].alias("location"), text["summary"].alias("summary"),
        clamped.alias("confidence"),
    ]
    return F.when(F.try_parse_json(json_text).isNotNull(), F.struct(*fields))
