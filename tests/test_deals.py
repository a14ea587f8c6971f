"""Pins of reading and showing deals."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roundmill.functions import deals
from roundmill.functions.text import clean_company, normalize_company, normalize_investor
from roundmill.functions.urls import canonical_url, page_number
from roundmill.operators.extract import enrich, merged, model_answers, parsed_answer, pattern_extract
from roundmill.operators.validate import build_rounds, split_valid
from roundmill.schema import ENRICHMENT, TABLES, empty_tables


def one(rows, expression, *values):
    names = [f"c{i}" for i in range(len(values))]
    return rows(", ".join(f"{n} string" for n in names), values).select(expression(*[F.col(n) for n in names]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "amount", "currency", "usd"),
    [
        ("raised $8 Mn from", 8e6, "USD", 8e6), ("$2.5 million now", 2.5e6, "USD", 2.5e6), ("worth $1.2 Bn, took $100 Mn", 1.2e9, "USD", 1.2e9),
        ("Rs 150 Cr round", 1.5e9, "INR", 18072289.16), ("Rs 25 lakh", 2.5e6, "INR", 30120.48), ("₹22 Cr", 2.2e8, "INR", 2650602.41),
        ("USD 8", 8e6, "USD", 8e6), ("USD 3 bn", 3e9, "USD", 3e9), ("no sum", None, None, None), ("", None, None, None), (None, None, None, None),
    ],
)
def test_amounts(rows, text, amount, currency, usd):
    x = one(rows, deals.extract_amount, text)
    assert (x["amount"], x["currency"]) == (amount, currency)
    assert x["amount_usd"] == pytest.approx(usd)


@pytest.mark.parametrize(("text", "stage"), [("a pre-seed deal", "pre_seed"), ("pre-Series A", "pre_series_a"), ("Series B led", "series_b"), ("series F", "series_e_plus"), ("IPO plans", "ipo"), ("ipo plans", "undisclosed"), ("X acquires Y", "acquisition"), ("nothing", "undisclosed"), ("", "undisclosed")])
def test_stages(rows, text, stage):
    assert one(rows, deals.extract_stage, text) == stage


@pytest.mark.parametrize(("title", "name"), [("TraqCheck Raises $8 Mn", "TraqCheck"), ("The Hosteller Raises Rs 150 Cr", "The Hosteller"), ("Palmonas Bags $40 Mn", "Palmonas"), ("Jio Financial Services Q4 net", "Jio Financial Services Q4"), ("nothing here", None), ("", None)])
def test_companies(rows, title, name):
    assert one(rows, deals.extract_company, title) == name


def test_investors(rows):
    text = "The round was led by Alpha Ventures, with participation from Beta Capital, alongside Gamma Partners and joined by beta capital."
    got = one(rows, deals.extract_investors, text)
    assert [(x["name"], x["lead"]) for x in got] == [("Alpha Ventures", True), ("Beta Capital", False), ("Gamma Partners", False)]
    assert one(rows, deals.extract_investors, "") == []


def test_merged_investors_upgrade_lead(rows):
    df = rows("i array<struct<name:string,lead:boolean>>", ([("Accel", False), ("Blume", False), ("ACCEL", True)],))
    assert [(x["name"], x["lead"]) for x in df.select(deals.merged_investors("i").alias("x")).first()["x"]] == [("ACCEL", True), ("Blume", False)]


def test_days(rows):
    assert one(rows, lambda a, b: deals.extract_announced_on(a, b), None, "on 14 April 2026, said") == dt.date(2026, 4, 14)
    assert one(rows, lambda a, b: deals.extract_announced_on(a, b), "2026-01-02", "on 14 Apr 2026") == dt.date(2026, 1, 2)
    assert one(rows, lambda a, b: deals.extract_announced_on(a, b), None, "31 Feb 2026") is None
    assert one(rows, deals.calendar_day, "2026-04-17T00:30:00+05:30") == dt.date(2026, 4, 17)
    assert one(rows, deals.calendar_day, "soon") is None


def test_display(rows):
    df = rows("u double, a double, c string", (15e6, 15e6, "USD"), (18072289.0, 1.5e9, "INR"), (5.4e6, 5e6, "EUR"), (None, None, None), (8.0, None, None), (6e8, 9.9e7, "INR"), (1.25e9, None, None))
    shown = [r["x"] for r in df.select(deals.format_amount(F.col("u"), F.col("a"), F.col("c")).alias("x")).collect()]
    assert shown == ["$15M", "₹150 Cr ($18.1M)", "5,000,000 EUR ($5.4M)", "", "$8M", "₹9.9 Cr ($600M)", "$1.3B"]
    assert [r["x"] for r in rows("n int", (1,), (26,), (27,), (703,)).select(deals.column_letter(F.col("n")).alias("x")).collect()] == ["A", "Z", "AA", "AAA"]
    assert one(rows, deals.format_stage, "series_e_plus") == "Series E+"
    assert one(rows, deals.format_stage, None) == ""


def test_ids(rows):
    df = rows("n string, d date, u double", (" Hocco ", dt.date(2026, 4, 14), 12e6), ("hocco", dt.date(2026, 4, 14), 12e6), ("hocco", dt.date(2026, 4, 14), 2e6), (None, None, None))
    ids = [r["x"] for r in df.select(deals.round_id(F.col("n"), F.col("d"), F.col("u")).alias("x")).collect()]
    assert len(ids[0]) == 16 and ids[0] == ids[1] != ids[2] and ids[3]


@pytest.mark.parametrize(("raw", "norm"), [("Bluestone Jewellery Pvt Ltd", "bluestone jewellery"), ("Tech Labs India", ""), ("Café  Zoë, Inc.", "café zoë"), ("A-B Technologies", "a b")])
def test_company_names(rows, raw, norm):
    assert one(rows, normalize_company, raw) == norm


def test_other_names(rows):
    assert one(rows, normalize_investor, "A & B-C Ventures LLP.") == "a & b-c ventures"
    assert one(rows, clean_company, "  Foo   Bar., ") == "Foo Bar"
    assert one(rows, clean_company, " . ") is None


@pytest.mark.parametrize(
    ("url", "plain"),
    [
        ("https://WWW.site.EXAMPLE//a/b/?utm_source=x&id=7#top", "site.example/a/b?id=7"), ("http://m.site.example:443/a%2Db-12345/amp", "site.example/a-b-12345"), ("https:/ /amp.site.example/x?ref=home/amp", "site.example/x"),
        ("https://www.site.example/story?src=nl&id=12747", "site.example/story?id=12747"), ("https://www.site.example/x-12345&preview=true", "site.example/x-12345"), ("see print edition", None), ("", None), (None, None), ("www", None),
    ],
)
def test_addresses(rows, url, plain):
    assert one(rows, canonical_url, url) == plain


def test_page_number(rows):
    assert one(rows, lambda u: page_number(canonical_url(u)), "https://a.example/x-revised-12365.html?x=1") == "a.example#12365"
    assert one(rows, lambda u: page_number(canonical_url(u)), "https://a.example/x-12") is None


def test_pattern_extract_and_merge(rows, spark):
    df = rows("article_id string, title string, text string, published_at string", ("1", "TraqCheck Raises $8 Mn", "The Series A was led by Alpha Ventures.", "2026-04-14"), ("2", "weather", "rain", None), ("3", None, None, None))
    out = {r["article_id"]: r["x"] for r in df.select("article_id", pattern_extract(F.col("title"), F.col("text"), F.col("published_at")).alias("x")).collect()}
    assert out["1"]["confidence"] == 0.85 and out["1"]["stage"] == "series_a" and out["1"]["company_name"] == "TraqCheck"
    assert out["2"]["confidence"] == 0.2 and out["3"]["company_name"] is None
    answers = rows("article_id string, raw string", ("1", '```json\n{"company_name": "", "stage": "SEED", "confidence": "0.2", "investors": ["Zed"]}\n```'), ("2", "no json"))
    done = {r["article_id"]: r for r in enrich(df, answers).collect()}
    assert (done["1"]["status"], done["1"]["result"]["company_name"], done["1"]["result"]["stage"]) == ("fallback", "TraqCheck", "seed")
    assert done["1"]["result"]["confidence"] == pytest.approx(0.6 * 0.2 + 0.3 * 0.85) and done["1"]["result"]["investors"][0]["name"] == "Zed"
    assert done["2"]["result"]["extraction_method"] == "regex_fallback"
    assert merged is not None and ENRICHMENT.startswith("company_name")


def test_payload(rows):
    good = 'Sure: {"company_name": "Foo", "amount": "1,500,000", "investors": [{"name": "A", "lead": true}, "B", {"lead": true}], "stage": " Seed ", "currency": "inr", "sector": "fintech platform", "confidence": 1.7, "announced_on": "2026-01-01"} done'
    x = one(rows, parsed_answer, good)
    assert (x["amount"], x["stage"], x["currency"], x["sector"], x["confidence"]) == (1.5e6, "seed", "INR", "fintech", 1.0)
    assert [(i["name"], i["lead"]) for i in x["investors"]] == [("A", True), ("B", False)]
    assert one(rows, parsed_answer, '{"confidence": "high", "amount": "n/a"}')["confidence"] == 0.0
    for bad in ('{"a": ', "", None, "text"):
        assert one(rows, parsed_answer, bad) is None


def test_model_chain(rows):
    def answer(model, text):
        if model == "a":
            raise RuntimeError("quota")
        return f"{model}:{text}"

    got = model_answers(rows("article_id string, text string", ("1", "x"), ("2", None)).coalesce(1), answer, ("a", "b")).collect()
    assert sorted((r["article_id"], r["raw"]) for r in got) == [("1", "b:x"), ("2", "b:")]
    assert model_answers(rows("article_id string, text string", ("1", "x")), answer, ("a",)).first()["raw"] is None


def test_validation(rows):
    schema = "company_name string, stage string, amount double, currency string, amount_usd double, announced_on date, confidence double"
    df = rows(schema, ("A", "seed", 1.0, "USD", 1.0, dt.date(2026, 1, 1), 0.5), ("B", "x", -1.0, "XYZ", 6e10, dt.date(2027, 1, 1), 2.0), (None, None, None, None, None, None, None))
    good, bad = split_valid(df, F.lit("2026-04-24").cast("date"))
    assert good.count() == 2
    assert bad.first()["reasons"] == ["negative_amount", "too_many_dollars", "future_day", "unknown_stage", "unknown_currency", "confidence_range"]
    full = rows(schema + ", investors array<struct<name:string,lead:boolean>>, published_on date", (" Foo. ", None, 83e6, "INR", None, None, 0.5, [("A", False), ("a", True)], dt.date(2026, 4, 1)), (" . ", None, 1.0, "USD", None, None, 0.5, None, None))
    got = build_rounds(full).collect()
    assert len(got) == 1 and got[0]["company_name"] == "Foo" and got[0]["amount_usd"] == 1e6 and got[0]["stage"] == "undisclosed" and str(got[0]["announced_on"]) == "2026-04-01" and len(got[0]["investors"]) == 1 and len(got[0]["round_id"]) == 16


def test_empty_tables(spark):
    tables = empty_tables(spark)
    assert set(tables) == set(TABLES) and tables["investor_aliases"].count() == 27 and tables["articles"].count() == 0
