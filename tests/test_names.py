"""Similarity, resolution, duplicates: pins and brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roundmill.operators import dedup, similarity
from roundmill.operators.dedup import existing_rounds
from roundmill.operators.resolve import backfill_names, backfill_sectors, canonical_rounds, normalize_sectors, record_aliases, resolve_companies, resolve_investors
from roundmill.operators.similarity import longest_common, similar_pairs, token_set_ratio


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcd ", max_size=20), st.text("abcd ", max_size=20))
def test_longest_common(a, b):
    assert longest_common(a, b) == plain_lcs(a, b)


@pytest.mark.parametrize(("a", "b", "score"), [("hocco", "hocco ice cream", 100), ("the hosteller", "hosteller", 100), ("zomato", "hocco", 36.4), ("fin-tech", "fintech", 93.3), ("", "a", 0), ("a", "a", 100)])
def test_scores(a, b, score):
    assert token_set_ratio(a, b) == pytest.approx(score, abs=0.05)


def test_similar_pairs_lose_nothing(rows):
    rng = random.Random(3)
    parts = ["alpha", "beta", "gama", "gamma", "delta", "fintech", "fin-tech", "zed", "the", "kilo", "kiloo"]
    names = sorted({" ".join(rng.sample(parts, rng.randint(1, 3))) for _ in range(60)} | {"".join(rng.choice("abc") for _ in range(9)) for _ in range(20)})
    for threshold in (85, 88, 92):
        got = {(r["a"], r["b"]) for r in similar_pairs(rows("name string", *[(n,) for n in [*names, "", None]]), rows("name string", *[(n,) for n in names]), threshold).collect()}
        assert got == {(a, b) for a in names for b in names if token_set_ratio(a, b) >= threshold}


def test_similar_pairs_of_frequent_words(rows):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abdeiorsz") for _ in range(n))
    left = [f"{word(rng.randint(3, 7))} {rng.choice(['finserve', 'learning', 'finserve learning', 'farms'])}" for _ in range(60)] + ["farms", "é farms learning", "12 finserve"]

    def typo(name):
        at = rng.randrange(len(name) + 1)
        return rng.choice([name[:at] + rng.choice("aez ") + name[at:], name[:at] + name[at + 1 :], name[:at] + name[at : at + 2][::-1] + name[at + 2 :], name + " group", " ".join(name.split()[::-1])])

    right = [" ".join(typo(n).split()) for n in left for _ in range(3)]
    for threshold in (85, 88, 92):
        got = {(r["a"], r["b"]) for r in similar_pairs(rows("name string", *[(n,) for n in left]), rows("name string", *[(n,) for n in right]), threshold).collect()}
        assert got == {(a, b) for a in left for b in right if token_set_ratio(a, b) >= threshold}


def test_frequent_word_makes_no_square(rows, monkeypatch):
    rng = random.Random(9)
    names = [("".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(8)) + " finserve",) for _ in range(150)]
    monkeypatch.setattr(similarity, "token_set_score", lambda a, b: F.lit(100.0))
    met = similar_pairs(rows("name string", *names), rows("name string", *names), 92).count()
    assert len(names) <= met < 0.1 * len(names) ** 2


@pytest.mark.parametrize(
    ("new", "old", "same"),
    [
        (("Bluestone Jewellery Pvt Ltd", dt.date(2026, 4, 15), 28e6), ("Bluestone", dt.date(2026, 4, 14), 29e6), True), (("Hocco", dt.date(2026, 4, 14), 2e6), ("Hocco", dt.date(2026, 4, 14), 12e6), False),
        (("Hosteller", dt.date(2026, 4, 14), 18.2e6), ("The Hosteller", dt.date(2026, 4, 14), 18e6), True), (("Foo", None, None), ("Foo", dt.date(2020, 1, 1), 5.0), True), (("Foo", dt.date(2026, 1, 5), None), ("Foo", dt.date(2026, 1, 1), None), False),
        (("Foo", dt.date(2026, 1, 4), 0.0), ("Foo", dt.date(2026, 1, 1), 0.0), True), (("Tech Labs", None, None), ("Labs Tech", None, None), False),
    ],
)
def test_existing_rounds(rows, new, old, same):
    schema = "id long, company_name string, announced_on date, amount_usd double"
    got = existing_rounds(rows(schema, (1, *new)), rows(schema + ", ordinal long", (9, *old, 1))).collect()
    assert bool(got) == same


def test_deals_meet_under_names_alike_only(rows, monkeypatch):
    rng = random.Random(10)
    name = lambda: "".join(rng.choice("abcdefghijklmnoprstuvz") for _ in range(8)) + " finserve"
    for module in (dedup, similarity):
        monkeypatch.setattr(module, "token_set_score", lambda a, b: F.lit(100.0), raising=False)
    schema = "id long, company_name string, announced_on date, amount_usd double"
    new, old = [(i, name(), None, None) for i in range(60)], [(100 + i, name(), None, None, i) for i in range(60)]
    assert existing_rounds(rows(schema, *new), rows(schema + ", ordinal long", *old)).count() < 40


def test_existing_rounds_brute_force(rows):
    rng = random.Random(5)
    day = lambda: None if rng.random() < 0.2 else dt.date(2026, 1, 1) + dt.timedelta(rng.randint(0, 9))
    usd = lambda: None if rng.random() < 0.2 else float(rng.randint(8, 14))
    name = lambda: rng.choice(["alpha beta", "alpha", "alpah beta", "gamma", "gama", "beta gamma", None, ""])
    old = [(i, name(), day(), usd(), i) for i in range(40)]
    new = [(100 + i, name(), day(), usd()) for i in range(40)]
    schema = "id long, company_name string, announced_on date, amount_usd double"
    got = {r["new_id"]: r["old_id"] for r in existing_rounds(rows(schema, *new), rows(schema + ", ordinal long", *old)).collect()}
    expected = {}
    for i, n, d, u in new:
        best = (87.99, None)
        for j, m, e, v, _ in old:
            score = token_set_ratio(n or "", m or "")
            close = (d is None or e is None or abs((d - e).days) <= 3) and (u is None or v is None or abs(u - v) <= 0.15 * max(u, v))
            if close and score > best[0] and score >= 88:
                best = (score, j)
        if best[1] is not None:
            expected[i] = best[1]
    assert got == expected


def test_resolution(rows):
    known = rows("name string, ordinal long", ("Hocco Ice Cream", 1), ("Zomato", 2), ("Zomato Ltd", 3), (None, 4))
    none = rows("alias_norm string, canonical string, created_at string", ("zz", "Zed", None))
    got = {r["name"]: (r["canonical"], r["how"]) for r in resolve_companies(rows("name string", ("Hocco",), ("zomato pvt ltd",), ("ZZ",), ("Newco",), ("India",), (None,)), known, none).collect()}
    assert got == {"Hocco": ("Hocco Ice Cream", "similar"), "zomato pvt ltd": ("Zomato", "similar"), "ZZ": ("Zed", "alias"), "Newco": ("Newco", "new"), "India": ("India", "new")}
    people = {r["name"]: r["canonical"] for r in resolve_investors(rows("name string", ("ACCEL LLP",), ("Zz Capital",), ("Other",)), rows("name string, ordinal long", ("Accel", 1), ("accel", 2)), rows("alias_norm string, canonical string", ("zz capital", "Zed Capital"))).collect()}
    assert people == {"ACCEL LLP": "Accel", "Zz Capital": "Zed Capital", "Other": "Other"}
    again = record_aliases(record_aliases(none, rows("alias_norm string, canonical string, created_at string", ("a", "A", "2"), ("a", "B", "1"), ("zz", "X", "0"))), rows("alias_norm string, canonical string, created_at string", ("a", "C", "0")))
    assert {(r["alias_norm"], r["canonical"]) for r in again.collect()} == {("zz", "Zed"), ("a", "B")}


def test_sectors(rows):
    raw = [("fintech",), ("FinTech platform",), ("fin-tech",), ("quantum widgetry",), ("",), (None,), ("ai_ml",), ("ai healthcare",)]
    assert {r["raw"]: r["sector"] for r in normalize_sectors(rows("raw string", *raw)).collect()} == {"fintech": "fintech", "FinTech platform": "fintech", "fin-tech": "fintech", "quantum widgetry": "other", "": None, None: None, "ai_ml": "ai_ml", "ai healthcare": "healthtech"}


def test_canonical_rounds_and_backfills(rows):
    r = rows("company_name string, announced_on date, amount_usd double, investors array<struct<name:string,lead:boolean>>", ("Foo Ltd", dt.date(2026, 1, 1), 1.0, [("accel", False), ("Accel India", True), ("Zed", True)]), ("Bar", None, None, None))
    got = {x["company_name"]: x for x in canonical_rounds(r, rows("name string, canonical string", ("Foo Ltd", "Foo")), rows("name string, canonical string", ("accel", "Accel"), ("Accel India", "Accel"))).collect()}
    assert [(i["name"], i["lead"]) for i in got["Foo"]["investors"]] == [("Accel", False), ("Zed", True)] and got["Bar"]["investors"] == []
    rounds = rows("round_id string, company_json string", ("1", '{"sector": "fintech"}'), ("2", '{"sector": null}'), ("3", "bad"))
    links = rows("round_id string, article_url string", ("1", "u1"), ("2", "u2"), ("2", "u1"), ("3", "u9"), (None, "u1"))
    pages = rows("url string, enrichment_json string", ("u1", '{"sector": "payments"}'), ("u2", '{"sector": ""}'), ("u9", "{"))
    assert {x["round_id"]: x["outcome"] for x in backfill_sectors(rounds, links, pages).collect()} == {"1": "already_ok", "2": "updated", "3": "skipped"}
    assert {(x["name"], x["lead"]) for x in backfill_names(rows("round_id string, name string, lead int", ("1", "accel", 0), ("1", "Accel India", 1)), rows("name string, canonical string", ("accel", "Accel"), ("Accel India", "Accel"))).collect()} == {("Accel", 1)}
