"""Repeated lines of a source."""

from __future__ import annotations

import datetime as dt
import random

from roundmill.llm import site_lines

SCHEMA = "fetch_id long, source string, text string, published_at timestamp_ntz, line_no string"
NAMES = ["Ann Bee", "Carl Dorr", "Eva Fenn", "Gil Hart", "Ida Jost"]
WORDS = "market copper tractor bridge winter harvest engine village bakery lantern saddle orchid pepper velvet marble".split()


def pages(n, source="s", seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        body = " ".join(rng.choice(WORDS) for _ in range(25))
        lines = [f"By {rng.choice(NAMES)} | {rng.randint(2, 60)} min read", "", f"{i} {body}.", rng.choice(["SUBSCRIBE TO OUR  LETTER", "» Subscribe to our letter."]), f"Rare note {rng.choice(WORDS)}" if i % 10 == 0 else body[::-1]]
        out.append((i, source, "\n".join(lines), dt.datetime(2026, 1, 1) + dt.timedelta(days=i), "clash"))
    return out


def found(rows, data):
    return {(r["fetch_id"], r["line_no"]) for r in site_lines.repeated_lines(rows(SCHEMA, *data)).collect()}


def test_lines(rows):
    data = pages(60)
    assert found(rows, data) == {(i, k) for i in range(60) for k in (1, 4)}


def test_nulls_small_sources_and_republication(rows):
    data = pages(40)
    # one report fetched again and again is one cluster, so its own lines aren't boilerplate
    again = [(1000 + i, "s", data[0][2].split("\n", 3)[2] + "\nIts very own second line here", dt.datetime(2026, 3, 1), "") for i in range(30)]
    odd = [(2000, "s", None, None, None), (2001, None, "Subscribe to our letter", None, None), (2002, "s", "", None, None), (2003, "s", " \n\t\n --- ", None, None), (None, "s", data[1][2], None, None), (2004, "t", "Subscribe to our letter", None, None), (2005, "u", "x " * 60_000, None, None)]
    got = found(rows, [*data, *again, *odd])
    assert got == {(i, k) for i in range(40) for k in (1, 4)}
    assert found(rows, []) == set()


def test_cleaned(rows):
    df = rows(SCHEMA, *pages(30), (99, "s", None, None, None))
    clean = {r["fetch_id"]: r["text"] for r in site_lines.cleaned_articles(df, site_lines.repeated_lines(df)).collect()}
    assert len(clean) == 31 and clean[99] is None and "letter" not in clean[3].lower() and "min read" not in clean[3] and clean[3].count("\n") == 2


def test_plain_line():
    assert site_lines.plain_line("By Ann, 14 Apr 2026") == site_lines.plain_line("by ANN  April 3, 2025") == site_lines.plain_line("By Ann — 2026-04-14") == "by ann @"
    assert site_lines.plain_line("We may 3") == "we @"


def test_long_notices_over_short_reports(rows):
    """20 different short reports over three long notices, one of which names another firm on each page."""
    notices = ["all texts on this site are the property of the publisher and must not be copied without a written permission of the same " * 2, "we may earn a fee when you follow a link on this page and buy something there which costs you nothing at all " * 2]
    data = []
    for i in range(20):
        name = " ".join(f"firm{chr(97 + i)}{chr(97 + k)}" for k in range(11))
        third = f"for more about {name} and other firms that our readers have asked about in the last weeks see the list of firms that we keep up for them"
        data.append((i, "s", "\n".join([f"{chr(97 + i)}one {chr(97 + i)}two {chr(97 + i)}three {chr(97 + i)}four", *notices, third]), None, "x"))
    got = site_lines.repeated_lines(rows("fetch_id long, source string, text string, published_at timestamp, line string", *data)).collect()
    assert {(r["fetch_id"], r["line_no"]) for r in got} == {(i, k) for i in range(20) for k in (2, 3, 4)}
