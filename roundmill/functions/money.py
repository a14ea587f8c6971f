"""Sums of money in text: amount, unit and currency, read with built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spoken forms of currencies. The longer forms stand first.
CURRENCY_FORMS = [
    ("SGD", r"S\$|SGD|Singapore dollars?"),
    ("USD", r"US\$|USD|U\.S\. dollars?|US dollars?|dollars?|\$"),
    ("INR", r"Rs\.?|INR|₹|rupees?"),
    ("EUR", r"EUR|€|euros?"),
    ("GBP", r"GBP|£|pounds sterling|pounds?"),
    ("AED", r"AED|Dhs?\.?|dirhams?"),
    ("JPY", r"JPY|¥|yen"),
]
# Scale words and their factors.
SCALE_FORMS = [
    (1e7, r"crores?|cr\.?"),
    (1e5, r"lakhs?|lacs?|l"),
    (1e9, r"billions?|bn\.?|b"),
    (1e6, r"millions?|mn\.?|mln\.?|mm|mio\.?|m"),
    (1e3, r"thousands?|k"),
]
# Numbers written as words.
NUMBER_WORDS = {
    "half a": 0.5, "a": 1, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7,
    "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "fifteen": 15, "twenty": 20,
    "thirty": 30, "forty": 40, "fifty": 50, "hundred": 100, "a hundred": 100,
}
#: What extractors leave where they cut a text.
CUT_MARK = r"\s*(\.\.\.|…|\(contd\.?\)?|\[\+\d+ chars\])\s*$"
#: Sentences that tell of another sum than the one raised.
OTHER_SUM = (
    r"(?i)\b(previous(ly)? (round|raise)|earlier (round|valued|raised)|prior round|last round|valued|valuation|revenues?|turnover|market is"
    r"|market size|sales of|targets?|profit|loss of|net worth|in all so far|total funding)\b"
)

_ANY_CURRENCY = "|".join(p for _, p in CURRENCY_FORMS)
_ANY_SCALE = "|".join(p for _, p in SCALE_FORMS)
_WORDS = "|".join(sorted(NUMBER_WORDS, key=len, reverse=True))
#: Group 1 currency before, 2 digits, 3 number word, 4 scale, 5 currency after.
MONEY = (
    rf"(?i)(?<![\p{{L}}\p{{N}}])(?:({_ANY_CURRENCY})\s*)?(?:(\d[\d,]*(?:\.\d+)?)|\b({_WORDS})(?=\s+(?:million|billion|crore|lakh|thousand)))"
    rf"(?:\s*({_ANY_SCALE})(?![\p{{L}}\p{{N}}]))?(?:\s+({_ANY_CURRENCY})(?![\p{{L}}\p{{N}}]))?"
)
#: A mention must have a currency on either side; anything else is a count or a year.
MONEY_WITH_CURRENCY = (
    rf"(?i)(?<![\p{{L}}\p{{N}}])(?:(?:{_ANY_CURRENCY})\s*\d[\d,]*(?:\.\d+)?(?:\s*(?:{_ANY_SCALE})(?![\p{{L}}\p{{N}}]))?"
    rf"|(?:\d[\d,]*(?:\.\d+)?|\b(?:{_WORDS})(?=\s+(?:million|billion|crore|lakh|thousand)))(?:\s*(?:{_ANY_SCALE})(?![\p{{L}}\p{{N}}]))?\s+(?:{_ANY_CURRENCY})(?![\p{{L}}\p{{N}}]))"
)


def sentences(text: Column) -> Column:
    """Split at a full stop, question or exclamation mark that a capital letter follows after white space."""
    return F.split(text, r"(?<=[.!?])\s+(?=\p{Lu})")


def currency_of(form: Column) -> Column:
    """ISO code of a spoken form; null if it names none."""
    out = F.lit(None).cast("string")
    for code, pattern in reversed(CURRENCY_FORMS):
        out = F.when(form.rlike(rf"(?i)^\s*(?:{pattern})\s*$"), code).otherwise(out)
    return out


def scale_of(form: Column) -> Column:
    """Factor of a scale word; 1 where there is none."""
    out = F.lit(1.0)
    for factor, pattern in reversed(SCALE_FORMS):
        out = F.when(form.rlike(rf"(?i)^\s*(?:{pattern})\s*$"), factor).otherwise(out)
    return out


def _mentions(text: Column, other_sum: str) -> Column:
    """The mentions of a sum with a currency, in order, without sentences about other sums and without one at the cut."""
    whole = F.regexp_replace(text, CUT_MARK, "")
    kept = F.array_join(F.filter(sentences(whole), lambda s: ~s.rlike(other_sum)), " ")
    return F.regexp_replace(kept, rf"{MONEY_WITH_CURRENCY}\s*$", "")


def stated_sum(text: Column, other_sum: str = OTHER_SUM) -> Column:
    """The sum that the text says was raised: struct<value double, currency string>, or null.

    Sentences about other sums (earlier rounds, sales, valuations) are left out; of the rest the
    first mention with a currency counts. A null or empty text gives null, as does a text with no
    such mention. A mention that stands where the text was cut off may lack digits or its scale, so
    it gives null too.
    """
    return parse_money(F.regexp_extract(_mentions(text, other_sum), MONEY_WITH_CURRENCY, 0))


def readings_of(text: Column, other_sum: str = OTHER_SUM) -> Column:
    """Every way to read the sum raised: array<struct<value, currency, prior>>, the likeliest first; empty if there is none.

    Mentions as in ``stated_sum``; each later one is a tenth as likely as the one before. A lone comma before one or two
    digits is a decimal comma, before three digits a separator of thousands, and with little prior the other of the two.
    """
    mentions = F.regexp_extract_all(_mentions(text, other_sum), F.lit(MONEY_WITH_CURRENCY), F.lit(0))
    words = F.create_map(*[F.lit(x) for kv in NUMBER_WORDS.items() for x in (kv[0], float(kv[1]))])
    # each step names its parts, so that no pattern is matched twice
    cut_up = F.transform(mentions, lambda m: F.struct(*[F.regexp_extract(m, MONEY, i).alias(f"g{i}") for i in range(1, 6)]))
    named = F.transform(cut_up, lambda g: F.struct(
        g["g2"].alias("digits"), F.try_element_at(words, F.lower(g["g3"])).alias("word"), scale_of(g["g4"]).alias("scale"),
        currency_of(F.when(g["g1"] != "", g["g1"]).otherwise(g["g5"])).alias("currency"), F.regexp_extract(g["g2"], r"^\d{1,3},(\d{3})$|^\d+,\d{1,2}$", 0).alias("lone")))
    plain = lambda m: F.regexp_replace(m["digits"], ",", "").try_cast("double")
    point = lambda m: F.regexp_replace(m["digits"], ",", ".").try_cast("double")
    one = lambda m, number, prior: F.struct((number * m["scale"]).alias("value"), m["currency"].alias("currency"), prior.alias("prior"))

    def read(m: Column, at: Column) -> Column:
        place = F.pow(F.lit(0.1), at.cast("double"))
        thousands = F.substring(m["lone"], -4, 1) == ","
        both = F.when(thousands, F.array(one(m, plain(m), 0.97 * place), one(m, point(m), 0.03 * place))).otherwise(F.array(one(m, point(m), 0.97 * place), one(m, plain(m), 0.03 * place)))
        return F.when(m["lone"] != "", both).otherwise(F.array(one(m, F.coalesce(plain(m), m["word"]), place)))

    found = F.filter(F.flatten(F.transform(named, read)), lambda m: m["value"].isNotNull() & m["currency"].isNotNull())
    return F.coalesce(found, F.array().cast("array<struct<value:double,currency:string,prior:double>>"))


def parse_money(mention: Column) -> Column:
    """struct<value, currency> of one mention such as ``Rs. 9.5 cr`` or ``three million dollars``; null if it is none.

    A lone comma before one or two digits is a decimal comma, other commas separate thousands.
    """
    part = lambda i: F.regexp_extract(mention, MONEY, i)
    words = F.create_map(*[F.lit(x) for kv in NUMBER_WORDS.items() for x in (kv[0], float(kv[1]))])
    decimal = part(2).rlike(r"^\d+,\d{1,2}$")
    number = F.coalesce(F.regexp_replace(part(2), ",", F.when(decimal, ".").otherwise("")).try_cast("double"), F.try_element_at(words, F.lower(part(3))))
    currency = F.coalesce(currency_of(part(1)), currency_of(part(5)))
    value = number * scale_of(part(4))
    return F.when(value.isNotNull() & currency.isNotNull(), F.struct(value.alias("value"), currency.alias("currency")))
