"""Facts of a deal read from a headline and a text, and deals in display form. All built-in expressions.

Rounding: printf-style formatting rounds halves up; values that lie exactly between two displayed figures may
differ from a formatter that rounds halves to even.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roundmill.schema import STAGE_LABELS, USD_PER_UNIT

# Patterns of sums, in order of precedence.
USD_SIGN = r"(?i)\$\s*(\d+(?:\.\d+)?)\s*(mn|m|million|bn|b|billion)\b"
USD_WORD = r"(?i)\bUSD\s*(\d+(?:\.\d+)?)\s*(mn|m|million|bn|b|billion)?"
INR_SUM = r"(?i)(?:₹|Rs\.?|INR)\s*(\d+(?:[.,]\d+)?)\s*(cr|crore|crores|lakh|lakhs|lac|lacs|mn|million|bn|billion)\b"
UNITS = {"mn": 1e6, "m": 1e6, "million": 1e6, "bn": 1e9, "b": 1e9, "billion": 1e9, "cr": 1e7, "crore": 1e7, "crores": 1e7, "lakh": 1e5, "lakhs": 1e5, "lac": 1e5, "lacs": 1e5}
# Patterns of stages; the first pattern that occurs decides.
STAGE_PATTERNS = (
    ("pre_series_a", r"(?i)\bpre[-\s]?series\s*a\b"), ("series_a", r"(?i)\bseries\s*a\b"), ("series_b", r"(?i)\bseries\s*b\b"), ("series_c", r"(?i)\bseries\s*c\b"),
    ("series_d", r"(?i)\bseries\s*d\b"), ("series_e_plus", r"(?i)\bseries\s*(e|f|g|h)\b"), ("pre_seed", r"(?i)\bpre[-\s]?seed\b"),
    ("seed", r"(?i)\bseed\s*(round|funding|investment)?\b"), ("bridge", r"(?i)\bbridge\s*(round|funding)?\b"), ("debt", r"(?i)\bdebt\s*(funding|round|financing)\b"),
    ("grant", r"(?i)\bgrant\b"), ("ipo", r"\bIPO\b"), ("acquisition", r"(?i)\bacqui(?:res|sition|red)\b"),
)
# Verbs of headlines, and the forms in which investors are named.
RAISE_VERBS = r"(?:raises|raised|bags|secures|secured|mops[-\s]up|closes|closed|nets)"
TITLE_COMPANY = rf"(?iU)^\s*([A-Z][\w&.\-]*(?:\s+[A-Z][\w&.\-]*){{0,4}})\s+{RAISE_VERBS}\b"
LED_BY = r"(?U)led\s+by\s+([A-Z][\w&.\-]*(?:\s+[A-Z][\w&.\-]*){0,4}(?:\s+Ventures|\s+Capital|\s+Partners|\s+Fund|\s+Investments)?)"
JOINED = r"(?U)(?:participation\s+from|with\s+participation\s+from|alongside|joined\s+by)\s+([A-Z][\w&.\-]*(?:\s+[A-Z][\w&.\-]*){0,4})"
TEXT_DATE = r"\b(\d{1,2})\s+(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+(\d{4})\b"


def _map(items: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in items.items() for x in kv])


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


# --- reading ---------------------------------------------------------------------------------------------------------


def extract_amount(text: Column) -> Column:
    """struct<amount, currency, amount_usd> of the first sum: dollars by sign, dollars by word (millions where no unit
    stands), rupees. All null where there is none."""
    unit = lambda u: F.coalesce(F.try_element_at(_map(UNITS), F.lower(u)), F.lit(1.0))
    sign = _found(text, USD_SIGN).cast("double") * unit(_found(text, USD_SIGN, 2))
    word = _found(text, USD_WORD).cast("double") * unit(F.coalesce(_found(text, USD_WORD, 2), F.lit("million")))
    inr = F.regexp_replace(_found(text, INR_SUM), ",", "").cast("double") * unit(_found(text, INR_SUM, 2))
    usd = F.coalesce(sign, word)
    return F.struct(
        F.coalesce(usd, inr).alias("amount"),
        F.when(usd.isNotNull(), "USD").when(inr.isNotNull(), "INR").alias("currency"),
        F.coalesce(usd, F.round(inr * USD_PER_UNIT["INR"], 2)).alias("amount_usd"),
    )


def extract_stage(text: Column) -> Column:
    out = F.lit("undisclosed")
    for stage, pattern in reversed(STAGE_PATTERNS):
        out = F.when(text.rlike(pattern), stage).otherwise(out)
    return out


def extract_company(title: Column) -> Column:
    """Up to five words before a verb of raising money; else the leading capitalised words or numbers among the first five."""
    words = F.slice(F.filter(F.split(F.trim(title), r"\s+"), lambda w: w != ""), 1, 5)
    head = F.aggregate(
        words, F.struct(F.array().cast("array<string>").alias("w"), F.lit(True).alias("go")),
        lambda a, w: F.struct(F.when(a["go"] & w.rlike(r"^[\p{Lu}\p{Nd}]"), F.concat(a["w"], F.array(w))).otherwise(a["w"]).alias("w"), (a["go"] & w.rlike(r"^[\p{Lu}\p{Nd}]")).alias("go")),
    )["w"]
    return F.coalesce(F.nullif(F.trim(F.regexp_extract(title, TITLE_COMPANY, 1)), F.lit("")), F.nullif(F.array_join(head, " "), F.lit("")))


def extract_investors(text: Column) -> Column:
    """array<struct<name, lead>>: the first "led by", then all that joined; names differing in case only count once."""
    tidy = lambda n: F.regexp_replace(F.trim(n), r"[.,;]+$", "")
    lead = F.when(_found(text, LED_BY).isNotNull(), F.array(F.struct(tidy(_found(text, LED_BY)).alias("name"), F.lit(True).alias("lead")))).otherwise(F.array().cast("array<struct<name:string,lead:boolean>>"))
    rest = F.transform(F.regexp_extract_all(text, F.lit(JOINED), 1), lambda n: F.struct(tidy(n).alias("name"), F.lit(False).alias("lead")))
    return first_of_each_name(F.concat(lead, F.coalesce(rest, F.array().cast("array<struct<name:string,lead:boolean>>"))))


def first_of_each_name(investors: Column) -> Column:
    """The array with later entries of a name, whatever its case, left out."""
    return F.filter(investors, lambda x, i: F.array_position(F.transform(investors, lambda y: F.lower(y["name"])), F.lower(x["name"])) == i + 1)


def merged_investors(investors: Column) -> Column:
    """One entry per name, whatever its case, in order of first mention; a later lead replaces an earlier mention."""
    same = lambda x: F.filter(investors, lambda y: F.lower(y["name"]) == F.lower(x["name"]))
    lead = lambda x: F.try_element_at(F.filter(same(x), lambda y: y["lead"]), F.lit(1))
    return F.transform(first_of_each_name(investors), lambda x: F.when(x["lead"], x).otherwise(F.coalesce(lead(x), x)))


def extract_announced_on(hint: Column, text: Column) -> Column:
    """The day of publication if known, else the first day written as "14 April 2026"; impossible days give null."""
    spelled = F.concat_ws(" ", _found(text, TEXT_DATE), _found(text, TEXT_DATE, 2), _found(text, TEXT_DATE, 3))
    return F.coalesce(hint.cast("date"), F.try_to_timestamp(F.nullif(spelled, F.lit("")), F.lit("d MMM yyyy")).cast("date"))


# --- ids, money, days ------------------------------------------------------------------------------------------------


def article_id(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 16)


def round_id(name: Column, announced_on: Column, amount_usd: Column) -> Column:
    """First 16 hex digits of sha-256 of name, day and dollars; what is missing stands empty."""
    day = F.coalesce(F.date_format(announced_on, "yyyy-MM-dd"), F.lit(""))
    sum_ = F.coalesce(F.format_string("%.2f", amount_usd), F.lit(""))
    sum_ = F.when(amount_usd.isNull(), F.lit("")).otherwise(sum_)
    return F.substring(F.sha2(F.concat_ws("|", F.lower(F.trim(F.coalesce(name, F.lit("")))), day, sum_), 256), 1, 16)


def with_dollars(amount: Column, currency: Column, amount_usd: Column) -> Column:
    """amount_usd as given, else the amount at the fixed rate of its currency, to cents."""
    return F.coalesce(amount_usd, F.round(amount * F.try_element_at(_map(USD_PER_UNIT), currency), 2))


def whole_dollars(usd: Column) -> Column:
    """Null unless positive; values under a thousand are read as millions."""
    return F.when(usd <= 0, None).when(usd < 1000, usd * 1e6).otherwise(usd)


def calendar_day(iso: Column) -> Column:
    """The day of an ISO time in its own offset: its first ten characters."""
    return F.try_to_timestamp(F.substring(iso, 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def day_text(value: Column) -> Column:
    """A day or time as text cut before its time; null as an empty string."""
    return F.coalesce(F.regexp_extract(value.cast("string"), r"^([^T ]*)", 1), F.lit(""))


# --- display ---------------------------------------------------------------------------------------------------------


def format_stage(raw: Column) -> Column:
    known = F.try_element_at(_map(STAGE_LABELS), raw)
    return F.when(F.coalesce(raw, F.lit("")) == "", "").otherwise(F.coalesce(known, F.initcap(F.regexp_replace(raw, "_", " "))))


def format_usd(usd: Column) -> Column:
    """$1.2B, $15M, $500K, $900; null as an empty string. ".0" is dropped for millions only."""
    millions = F.regexp_replace(F.format_string("$%.1fM", usd / 1e6), r"\.0M", "M")
    return F.when(usd.isNull(), "").when(usd >= 1e9, F.format_string("$%.1fB", usd / 1e9)).when(usd >= 1e6, millions).when(usd >= 1e3, F.format_string("$%.0fK", usd / 1e3)).otherwise(F.format_string("$%.0f", usd))


def short_usd(usd: Column) -> Column:
    """As ``format_usd``, but nothing and zero give $0, and thousands and below carry no decimals."""
    return F.when(F.coalesce(usd, F.lit(0.0)) == 0, "$0").otherwise(format_usd(usd))


def format_inr(amount: Column) -> Column:
    """Crores from ten million on (one decimal below ten crores), lakhs from a hundred thousand on, else grouped digits."""
    crores = amount / 1e7
    return (
        F.when((amount >= 1e7) & (crores >= 10), F.format_string("₹%.0f Cr", crores)).when(amount >= 1e7, F.format_string("₹%.1f Cr", crores))
        .when(amount >= 1e5, F.format_string("₹%.0f L", amount / 1e5)).otherwise(F.concat(F.lit("₹"), F.format_number(amount, 0)))
    )


def format_amount(amount_usd: Column, amount: Column, currency: Column) -> Column:
    """Rupees and other currencies with the dollars in brackets, dollars alone; nothing known gives an empty string."""
    usd = format_usd(whole_dollars(amount_usd))
    tail = F.when(usd == "", "").otherwise(F.concat(F.lit(" ("), usd, F.lit(")")))
    some = F.coalesce(amount, F.lit(0.0)) != 0
    other = F.when(amount >= 1000, F.concat(F.format_number(amount, 0), F.lit(" "), currency)).otherwise(F.concat(F.format_string("%.1fM ", amount), currency))
    return F.when((currency == "INR") & some, F.concat(format_inr(amount), tail)).when(currency.isNotNull() & (currency != "") & (currency != "USD") & some, F.concat(other, tail)).otherwise(usd)


def confidence_band(confidence: Column) -> Column:
    return F.when(confidence >= 0.85, "high").when(confidence >= 0.6, "medium").otherwise("low")


def column_letter(number: Column) -> Column:
    """Spreadsheet letters of a column number from 1 (A, Z, AA ...), up to four letters."""
    digits = F.aggregate(
        F.sequence(F.lit(1), F.lit(4)), F.struct(number.cast("int").alias("n"), F.lit("").alias("s")),
        lambda a, _: F.when(a["n"] > 0, F.struct(((a["n"] - 1) / 26).cast("int").alias("n"), F.concat(F.char(F.lit(65) + F.pmod(a["n"] - 1, F.lit(26))), a["s"]).alias("s"))).otherwise(a),
    )
    return digits["s"]


def sheet_cell(value: Column, kind: str = "string") -> Column:
    """Cell text: null empty, booleans TRUE or FALSE, all else as it is."""
    text = F.when(value.cast("boolean"), "TRUE").otherwise("FALSE") if kind == "boolean" else value.cast("string")
    return F.when(value.isNull(), "").otherwise(text)
