"""Aggregates, monitoring and upserts on small fixtures."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from roundmill.operators import analytics, monitoring, upsert

T0 = dt.datetime(2026, 4, 24)


@pytest.fixture
def joined(rows):
    rounds = rows(
        "record_id long, round_id string, company_name string, company_json string, stage string, amount double, currency string, amount_usd double, announced_on date, summary string, confidence double",
        (1, "a", "Hocco", '{"sector": "foodtech", "city": "X"}', "series_c", 12e6, "USD", 12e6, dt.date(2026, 4, 14), "s", 0.95), (2, "b", "TraqCheck", "{", "seed", 5e5, "USD", 5e5, dt.date(2026, 3, 1), None, 0.40),
        (3, "c", "Hocco", None, "seed", None, None, None, None, None, None), (4, "d", None, None, None, 8.0, "USD", 8.0, dt.date(2026, 4, 1), "", 0.95),
    )
    people = rows("round_id string, name string, lead int", ("a", "Zed", 1), ("a", "Ann", 0), ("a", "Ann", 0), ("b", "Ann", 1), ("b", "Zed", None), ("x", "Nobody", 1), (None, "Q", 1), ("a", None, 1))
    links = rows("round_id string, article_url string", ("a", "u2"), ("a", "u1"), ("a", "u1"))
    return analytics.joined_rounds(rounds, people, links, None), rounds


def test_export_rows(joined):
    got = {r["record_id"]: r for r in analytics.public_rows(joined[0], "record_id").collect()}
    a = got[1]
    assert (a["sector"], a["stage"], a["amount"], a["lead_investor"], a["investors"], a["sources"]) == ("FoodTech", "Series C", "$12M", "Zed", ["Ann", "Zed"], ["u1", "u2"])
    assert (got[3]["company_name"], got[3]["amount"], got[3]["announced_on"], got[3]["confidence"], got[3]["investors"]) == ("Hocco", "", "", 0.0, [])
    assert (got[4]["company_name"], got[4]["amount"], got[4]["amount_usd"]) == ("", "$8M", 8e6)
    order = [r["record_id"] for r in joined[0].orderBy(*analytics.export_order("record_id")).collect()]
    assert order == [1, 4, 2, 3]


def test_investors(joined):
    got = {r["name"]: (r["deals"], r["leads"], r["total_usd"]) for r in analytics.investor_agg(joined[0]).collect()}
    assert got == {"Ann": (2, 1, 12.5e6), "Zed": (2, 1, 12.5e6)}
    assert [tuple(r) for r in analytics.co_investments(joined[0]).collect()] == [("Ann", "Zed", 2)]
    assert analytics.investor_kpis(joined[0]).first().asDict() == {"unique_investors": 2, "most_active": "Ann", "with_leads": 2, "pairs": 1}


def test_totals(joined):
    k = analytics.kpis(joined[1]).first()
    assert (k["total_usd"], k["n_rounds"], k["top_stage"]) == (12.5e6 + 8, 4, "seed") and k["mean_disclosed"] == pytest.approx((12.5e6 + 8) / 3)
    assert {r["bucket"]: r["n_rounds"] for r in analytics.amount_histogram(joined[1]).collect()} == {"<1M": 2, "1-5M": 0, "5-20M": 1, "20-50M": 0, "50-100M": 0, "100M+": 0}
    roll = {r["company_name"]: r for r in analytics.company_rollup(joined[1]).collect()}
    assert roll["Hocco"]["sector"] == "foodtech" and roll["Hocco"]["n_rounds"] == 2
    assert [(r["place"], r["day"], r["stage"]) for r in analytics.company_timeline(joined[1]).where("company_name = 'Hocco'").orderBy("place").collect()] == [(1, "", "seed"), (2, "2026-04-14", "series_c")]
    assert {(r["month"], r["sector"], r["n_rounds"]) for r in analytics.sector_mix(joined[0], 1).collect()} == {("2026-04", "Unknown", 1), ("2026-04", "Other", 1), ("2026-03", "Unknown", 1), ("2026-03", "Other", 0)}
    assert analytics.kpis(joined[1].limit(0)).first()["n_rounds"] == 0


def test_filter_and_pages(joined):
    public = analytics.public_rows(joined[0], "record_id")
    ids = lambda **k: {r["record_id"] for r in analytics.filtered(public, **k).collect()}
    assert ids() == {1, 2, 3, 4} and ids(since="2026-04-01") == {1, 3, 4} and ids(stages=("seed",)) == {2, 3} and ids(search="zed") == {1, 2} and ids(min_usd=1.0) == {1, 2, 4} and ids(min_confidence=0.5) == {1, 4}
    assert analytics.page_count(public).first()["pages"] == 1 and analytics.page_count(public.limit(0)).first()["pages"] == 1 and analytics.page_count(public, 3).first()["pages"] == 2
    assert [r["record_id"] for r in analytics.page(public, 2, 3, order=[F.asc("record_id")]).collect()] == [4]


def run(i, source, days, seen=5, error=None, drift=False):
    return (f"r{i}", source, T0 - dt.timedelta(days=days), None, seen, 1, 0, 1, 0, drift, error)


RUNS = "run_id string, source string, started_at timestamp_ntz, finished_at timestamp_ntz, articles_seen int, articles_new int, articles_failed int, enriched_ok int, enriched_failed int, schema_drift_flag boolean, error string"


@pytest.mark.parametrize(
    ("runs", "status", "streak"),
    [
        ([run(1, "s", 1), run(2, "s", 2)], "OK", 0), ([run(1, "s", 1, error="x"), run(2, "s", 2, error="x"), run(3, "s", 3, 0), run(4, "s", 4)], "CRITICAL", 3), ([run(1, "s", 1), run(2, "s", 2, 0), run(3, "s", 3, None)], "STALE", 0),
        ([run(1, "s", 1, drift=True), run(2, "s", 2)], "DRIFT", 0), ([run(1, "s", 1), run(2, "s", 2, error="x"), run(3, "s", 9, error="x")], "WARN", 0), ([run(1, "s", 1, 0)], "OK", 1),
    ],
)
def test_health(rows, runs, status, streak):
    got = monitoring.source_health(rows(RUNS, *runs), F.lit(str(T0)).cast("timestamp_ntz")).first()
    assert (got["status"], got["streak"]) == (status, streak)


def test_health_window_and_totals(rows):
    assert monitoring.source_health(rows(RUNS, run(1, "s", 8)), F.lit(str(T0)).cast("timestamp_ntz")).count() == 0
    assert monitoring.run_totals(rows(RUNS, run(1, "s", 1), run(2, "s", 2, None))).first()["articles_seen"] == 5


def test_drift(rows):
    base = rows("source string, selector_key string, baseline_hits int, updated_at string", ("a", "h1", 1, "0"), ("a", "p", 3, "0"), ("b", "h1", 1, "0"), ("c", "h1", 0, "0"))
    now = rows("source string, selector_key string, hits int", ("a", "h1", 0), ("a", "p", 9), ("b", "h1", 2), ("b", "p", 1), ("d", "h1", 0))
    drift, new = monitoring.check_and_update(base, now, F.lit("1"))
    assert {(r["source"], r["selector_key"]) for r in drift.collect()} == {("a", "h1")}
    assert {tuple(r) for r in new.collect()} == {("a", "h1", 1, "0"), ("a", "p", 3, "0"), ("c", "h1", 0, "0"), ("b", "h1", 2, "1"), ("b", "p", 1, "1")}
    assert {r["source"] for r in monitoring.drifted(base, now.limit(0)).collect()} == {"a", "b"}


def test_upsert_idempotent(rows):
    schema = "url string, title string, enrichment_status string, enrichment_json string, fetched_at long"
    old, new = rows(schema, ("a", "A", "ok", "{}", 1), ("b", "B", "ok", None, 1)), rows(schema, ("b", "B2", "pending", None, 2), ("b", "B3", "pending", None, 3), ("c", None, "pending", None, 1), (None, "x", None, None, 1))
    once = upsert.upsert_articles(old, new)
    expected = {("a", "A", "ok"), ("b", "B3", "ok"), ("c", None, "pending")}
    shape = lambda df: {(r["url"], r["title"], r["enrichment_status"]) for r in df.collect()}
    assert shape(once) == shape(upsert.upsert_articles(once, new)) == expected
    assert shape(upsert.upsert_articles(old.limit(0), new)) == {("b", "B3", "pending"), ("c", None, "pending")}


def test_merge_rounds_any_order(rows):
    schema = "round_id string, seq long, company_name string, stage string, confidence double, created_at string"
    data = [("a", 1, "Foo", "seed", 0.9, "1"), ("a", 2, "Foo Ltd", None, 0.5, "2"), ("a", 3, "FOO", "ipo", None, "3"), (None, 4, "x", None, None, None)]
    for order in itertools.permutations(data):
        got = upsert.merge_rounds(rows(schema, *order[:2]), rows(schema, *order[2:])).collect()
        assert [(r["company_name"], r["stage"], r["confidence"], r["created_at"]) for r in got] == [("Foo", "ipo", 0.9, "1")]
        break
    shuffled = random.Random(1).sample(data, 4)
    assert upsert.merge_rounds(rows(schema, *shuffled), rows(schema)).first()["stage"] == "ipo"
    assert upsert.merge_rounds(rows(schema, *data[:2]), rows(schema)).first()["stage"] is None


def test_links_and_queues(rows):
    schema = "round_id string, name string, lead int"
    got = upsert.insert_links(rows(schema, ("a", "X", 0)), rows(schema, ("a", "X", 1), ("a", "Y", 1), ("a", "Y", 0)), ["round_id", "name"])
    assert {tuple(r) for r in got.collect()} == {("a", "X", 0), ("a", "Y", 0)}
    pages = rows("fetch_id long, source string, enrichment_status string, fetched_at long", (1, "s", "pending", 5), (2, "s", "failed", 5), (3, "t", "pending", 9), (4, "s", "ok", 10), (5, "s", None, 10))
    assert [r["fetch_id"] for r in upsert.pending_articles(pages).collect()] == [3, 1, 2]
    assert [r["fetch_id"] for r in upsert.pending_articles(pages, "s", 1).collect()] == [1]
    assert {r["u"] for r in upsert.orphans(rows("u string", ("a",), ("b",), (None,)), rows("url string", ("a",), (None,)), "u", "url").collect()} == {"b", None}
    marked = upsert.mark_enrichment(rows("article_id string, enrichment_status string, enrichment_json string", ("1", "pending", None), ("2", "ok", "{}")), rows("article_id string, status string, enrichment_json string", ("1", "ok", "{1}")))
    assert {tuple(r) for r in marked.collect()} == {("1", "ok", "{1}"), ("2", "ok", "{}")}
