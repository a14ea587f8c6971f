"""Typed values: lookup against brute force, pins, misses."""

from __future__ import annotations

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roundmill.llm import canonical_values as cv
from roundmill.llm import queries

SECTORS = [("fintech", "FinTech", ["digital lending", "payments"]), ("d2c", "D2C Brands", ["skincare"]), ("web3", "Web3", None)]
CITIES = [("Bengaluru", "Karnataka", ["Bangalore"]), ("Nagpur", "Maharashtra", []), ("New Delhi", "Delhi", ["Delhi"]), ("Thiruvananthapuram", "Kerala", None), ("Patna", "Bihar", []), ("Chennai", "Tamil Nadu", ["Madras"])]


def osa(a, b):
    d = [[max(i, j) if 0 in (i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=8), st.text("abc", min_size=1, max_size=8), st.integers(1, 2))
def test_distance_and_keys(a, b, limit):
    near = osa(a, b) <= limit
    assert (cv.weighted_distance(a, b, limit) < float("inf")) == near
    if osa(a, b) <= min(cv.allowed_edits(len(a)), cv.allowed_edits(len(b))):
        assert cv.delete_keys(a) & cv.delete_keys(b)


@pytest.fixture
def tables(rows):
    return rows("ref_key string, label string, terms array<string>", *SECTORS), rows("ref_key string, state string, also_known_as array<string>", *CITIES)


PINS = {
    "B'lore": "Bengaluru", "BLR": "Bengaluru", "blr, Karnataka": "Bengaluru", "Bengalruu": "Bengaluru", "MG Road, Nagpur": "Nagpur", "Nagaur": "unmatched", "Nágpur ": "Nagpur", "  new  DELHI": "New Delhi", "Thiruvananhtapurm": "Thiruvananthapuram",
    "Maharashtra": "unmatched", "": "unmatched", "-": "unmatched", "Greater Bengaluru (HQ)": "Bengaluru", "Patan": "Patna", "maa": "Chennai", "Remote": "unmatched", "x" * 3000: "unmatched",
}


def test_cities(rows, tables):
    data = [(i, None, v, "clash") for i, v in enumerate(PINS)] + [(900, None, "BLR", "x"), (900, None, "BLR", "x"), (901, None, None, None)]
    got = cv.canonical_values(rows("sample_no long, sector string, city string, ref_key string", *data), *tables).collect()
    assert {r["value"]: r["ref_key"] for r in got} == PINS
    assert sum(r["sample_no"] == 900 for r in got) == 2 and not any(r["sample_no"] == 901 for r in got)


def test_sectors_and_cases(rows, tables):
    data = [(1, "FinTech", "Nagpur"), (2, "fin - tech", "nagpur"), (3, "online digital-lending firm", None), (4, "DC2 Brands", None), (5, "kite making", None), (6, "We3b", None), (7, "tbd", None)]
    sample = rows("sample_no long, sector string, city string", *data)
    mapped = cv.canonical_values(sample, *tables)
    cases = {(r["sample_no"], r["field_name"]): r["ref_key"] for r in cv.typed_cases(mapped, *tables).collect()}
    assert cases == {(2, "sector"): "fintech", (2, "city"): "Nagpur", (3, "sector"): "fintech", (4, "sector"): "d2c", (5, "sector"): "unmatched", (6, "sector"): "web3", (7, "sector"): "unmatched"}
    assert cv.canonical_values(sample.limit(0), *tables).count() == 0
    assert {r["ref_key"] for r in cv.canonical_values(sample, tables[0].limit(0), tables[1].limit(0)).collect()} == {"unmatched"}


@settings(max_examples=60, deadline=None)
@given(st.text("abcdef", min_size=36, max_size=46), st.lists(st.tuples(st.integers(0, 45), st.sampled_from(["", "x", "xy"])), max_size=2))
def test_long_phrases_share_a_key(phrase, edits):
    """Phrases around the length at which segments take the place of deletes meet their misspellings too."""
    run = phrase
    for at, put in edits:
        run = run[:at] + put[:1] + run[at + 1 :]
    if osa(phrase, run) <= 2:
        assert cv.phrase_keys(phrase) & cv.run_keys(run)


@pytest.mark.parametrize("times", [20, 400])
def test_frequent_misspelling_keeps_its_entry(rows, tables, times):
    """A misspelling is mapped alike on few rows and on many."""
    data = [(i, None, "Bengalura") for i in range(times)] + [(1000 + i, None, "Bengalru") for i in range(5)]
    got = {r["value"]: r["ref_key"] for r in cv.canonical_values(rows("sample_no long, sector string, city string", *data), *tables).collect()}
    assert got == {"Bengalura": "Bengaluru", "Bengalru": "Bengaluru"}


def test_long_labels(rows, tables):
    """Labels of many words are found in lower case and with a typo, whatever their number of words."""
    long = "Tools and Spare Parts for Small Village Dairies"
    sectors = rows("ref_key string, label string, terms array<string>", *SECTORS, ("dairy", long, None))
    data = [(1, long.lower(), None), (2, "tools and spare parts for smal village dairies", None), (3, "We sell tools and spare parts for small vilage dairies", None)]
    assert {r["ref_key"] for r in cv.canonical_values(rows("sample_no long, sector string, city string", *data), sectors, tables[1]).collect()} == {"dairy"}


def test_frequent_typo_keeps_its_entry(spark, rows, tables, tmp_path):
    """The queries map a typo alike on few rows and on many."""
    data = [(i, None, "Bangalor") for i in range(60)] + [(100 + i, None, "Bengalru") for i in range(5)] + [(200, None, "Nagaur")]
    named = zip(("sample_rounds", "ref_sectors", "ref_cities"), (rows("sample_no long, sector string, city string", *data), *tables))
    for name, df in named:
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    got = {r["sample_no"]: r["ref_key"] for r in queries.p1_found(spark, str(tmp_path)).collect()}
    assert got == {i: "Bengaluru" for i in [*range(60), *range(100, 105)]} | {200: "unmatched"}
