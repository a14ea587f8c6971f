"""Surviving values of duplicate groups."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from roundmill.llm import survivor

ROUND = "record_id long, round_id string, company_name string, summary string, confidence double, extraction_method string, amount double, amount_usd double, currency string, announced_on date, group_id string"
GOOD = "{} bagged $5 million to open new depots. Alpha Ventures led the seed round."


@pytest.fixture
def tables(rows):
    data = []
    for g in range(12):
        c = f"Zorvalu{'abcdefghijkl'[g]}"
        texts = [GOOD.format(c), f"{c} bagged $5 million to open new depots. Alpha Ven (contd", "Read more »", GOOD.format("Other Firm"), None]
        for k, text in enumerate(texts):
            data.append((g * 10 + k, f"r{g}-{k}", c, text, [0.5, 0.9, 1.2, None, -1.0][k], ["llm", "manual", "regex_fallback", None, "llm"][k], 5e6, 5e6, "USD", dt.date(2026, 1, 1), "clash"))
    rounds = rows(ROUND, *data)
    groups = rows("group_id long, record_id long", *[(r[0] // 10, r[0]) for r in data], (0, 0), (77, 999), (None, 1), (78, None))
    links = rows("round_id string, article_url string", *[(f"r{g}-{k}", f"https://www.site.example//x/{g}-{10000 + k}?utm_source=a" if k == 2 else f"https://site.example/none-{g}-{k}") for g in range(12) for k in (1, 2, 3)], ("r0-2", "https://m.site.example/x/0-10002/amp"), (None, "u"), ("r0-2", None))
    pages = rows("url string, title string", *[(f"https://site.example/x/{g}-10002", "t") for g in range(12)], (None, "t"))
    return groups, rounds, links, pages, rows("currency string, usd_per_unit double", ("USD", 1.0))


def test_survivors(tables):
    judged = survivor.judged_members(*tables)
    got = {(r["group_id"], r["field_name"]): r for r in survivor.surviving_values(judged).collect()}
    assert len(got) == 36
    for g in range(12):
        assert got[g, "confidence"]["record_id"] == g * 10 + 1
        assert got[g, "summary"]["record_id"] == g * 10
        assert got[g, "article_url"]["record_id"] == g * 10 + 2
    links = survivor.true_values(judged).collect()
    assert sum(r["group_id"] == 0 for r in links) == 2  # both ways of writing the link are kept
    assert {r["field_name"] for r in links} == {"article_url"} and len(links) == 13


def test_empty(tables):
    groups, rounds, links, pages, rates = tables
    assert survivor.surviving_values(survivor.judged_members(groups.limit(0), rounds, links, pages, rates)).count() == 0
    assert survivor.surviving_values(survivor.judged_members(groups, rounds.limit(0), links, pages, rates)).count() == 0
    fields = {r["field_name"] for r in survivor.surviving_values(survivor.judged_members(groups, rounds, links.limit(0), pages.limit(0), rates)).collect()}
    assert fields == {"confidence", "summary"}


def test_quality_is_recovered():
    rng = np.random.default_rng(1)
    sens, spec = np.array([0.95, 0.8, 0.6, 0.9]), np.array([0.9, 0.95, 0.7, 0.6])
    truth = rng.random(20000) < 0.4
    seen = np.where(truth[:, None], rng.random((20000, 4)) < sens, rng.random((20000, 4)) > spec)
    patterns, counts = np.unique(seen, axis=0, return_counts=True)
    model = survivor.infer_quality([(tuple(p), int(c)) for p, c in zip(patterns, counts)], 400)
    assert np.allclose(model["sens"], sens, atol=0.06) and np.allclose(model["spec"], spec, atol=0.06) and abs(model["prior"] - 0.4) < 0.05
    assert survivor.infer_quality([])["prior"] == 0.5


def test_posterior_decides(tables):
    """With one posterior for all claims, most survivors are others: the model makes the choice."""
    from pyspark.sql import functions as F

    judged = survivor.judged_members(*tables)
    pick = lambda df: {(r["group_id"], r["field_name"]): r["record_id"] for r in survivor.surviving_values(df).collect()}
    own, flat = pick(judged), pick(judged.withColumn("posterior", F.lit(1.0)))
    assert sum(own[k] != flat.get(k) for k in own) >= len(own) // 2
