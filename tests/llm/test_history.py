"""New batches against history: replay equals batch after batch; pins; brute force."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundmill.llm import history

ART = "fetch_id long, batch_no int, url string, title string, text string, key string"
RND = "record_id long, batch_no int, round_id string, company_name string, amount double, currency string, amount_usd double, announced_on date, summary string"
RATES = ("currency string, usd_per_unit double", ("USD", 1.0), ("INR", 0.012))


def text(seed, n=120):
    rng = random.Random(seed)
    return "\n".join(" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 99)) for _ in range(20)) for _ in range(n // 20))


def articles(rows):
    base, changed = text(1), text(1).replace(" ", " new ", 1)
    return rows(
        ART,
        (1, 0, "https://www.a.example/x-10001", "T", base, "k"), (2, 0, "https://www.a.example/x-10001", "T", base, "k"), (3, 0, "https://b.example/other", "O", text(2), None), (4, 1, "http://a.example/x-10001/?utm_source=q", "T2", text(3), None),
        (5, 1, "https://c.example/copy", "C", changed, None), (6, 2, "https://c.example/copy", "C", text(4), None), (7, 2, "https://d.example/new", None, None, None), (8, 3, None, "N", "", None), (9, 3, "https://b.example/other-2-20002", "Q", text(5), None),
        (10, 4, "https://b.example/rev-20002", "q", text(6), None), (11, None, "https://b.example/other", "O", None, None), (12, 5, "bad", "x", text(7, 20), None), (13, 6, "bad", "y", text(7, 20), None),
    )


def pairs(df):
    return {(r["first_id"], r["second_id"]) for r in df.collect()}


def test_pages(rows):
    assert pairs(history.repeats(history.page_records(articles(rows)), "article")) == {(1, 4), (1, 5), (1, 6), (9, 10), (12, 13)}
    assert history.repeats(history.page_records(articles(rows).limit(0)), "article").count() == 0


@pytest.mark.parametrize("kind", ["article", "round"])
def test_replay_equals_batch_after_batch(rows, spark, kind):
    records = (history.page_records(articles(rows)) if kind == "article" else history.round_records(rounds(rows), rows(*RATES))).cache()
    step = history.History(spark, kind)
    found = None
    for batch in range(7):
        now = records.where(f"batch_no = {batch}")
        part = step.probe(now)
        found = part if found is None else found.unionByName(part)
        found = spark.createDataFrame(found.collect(), "first_id long, second_id long")
        step.append(now)
    assert pairs(history.first_of_all(found)) == pairs(history.repeats(records, kind))


def rounds(rows):
    d = lambda k: dt.date(2026, 1, k)
    return rows(
        RND,
        (1, 0, "a", "Zorvalu Labs", 5e6, "USD", 5e6, d(5), None), (2, 0, "b", "Zorvalu Labs", 9e6, "USD", 9e6, d(5), None), (3, 1, "c", "ZORVLAU LABS Ltd", 5.2e6, "USD", 5.2e6, d(7), None), (4, 1, "d", "Zorvalu Labs", 5e6, "USD", 5e6, d(12), None),
        (5, 2, "e", "Zorvalu Labs", None, None, None, d(4), None), (6, 2, "f", "Zorvalu Labs", 9.4e6, "USD", 9.4e6, None, None), (7, 3, "a", None, None, None, None, None, None), (8, 3, "g", "Zorvalu Foods", 5e6, "USD", 5e6, d(5), None),
        (9, 4, None, None, None, None, None, None, "x"), (10, 4, "h", "Zorvalu", 5.0, "USD", 5e6, d(5), "Zorvalu bagged $5 million to grow. B led."), (11, 5, None, "Zorvalu Labs", None, None, None, None, None), (11, 5, None, "Zorvalu Labs", None, None, None, None, None),
    )


def test_deals(rows):
    got = pairs(history.repeats(history.round_records(rounds(rows), rows(*RATES)), "round"))
    assert got == {(1, 3), (1, 5), (2, 6), (1, 7), (1, 10)}


def test_deals_brute_force(rows):
    rng = random.Random(6)
    data = []
    for i in range(80):
        usd = None if rng.random() < 0.2 else float(rng.choice([1e6, 1.05e6, 1.2e6, 3e6]))
        day = None if rng.random() < 0.2 else dt.date(2026, 1, 1) + dt.timedelta(rng.randint(0, 12))
        data.append((i, min(4, i // 16), f"r{i}", rng.choice(["Zorvalu Labs", "Kemidrai Foods", "Kemidrai Labs"]), usd, "USD", usd, day, None))
    got = pairs(history.repeats(history.round_records(rows(RND, *data), rows(*RATES)), "round"))
    first = {}
    for i, b, _, n, u, _, _, d, _ in data:  # batches rise with the ids
        for j, c, _, m, v, _, _, e, _ in data:
            close_day, close_sum = d and e and abs((d - e).days) <= 3, u and v and abs(u - v) <= 0.1 * max(u, v)
            if c < b and n == m and ((close_day and (not u or not v or close_sum)) or ((not d or not e) and close_sum)):
                first[i] = min(first.get(i, (9, 9)), first.get(j, (c, j)))
    assert got == {(v[1], k) for k, v in first.items()}


def test_other_names_are_ruled_out_by_their_keys(rows, spark, monkeypatch):
    """Names that share keys by chance don't reach the comparison of marks; a name with one edit does."""
    rng = random.Random(12)
    name = lambda: "".join(rng.choice(["za", "ko", "mi", "re", "du", "pla", "sho", "gri"]) for _ in range(4)).title() + " Foods"
    data = [(i, i // 100, f"r{i}", name(), 5e6, "USD", 5e6, dt.date(2026, 1, 1), None) for i in range(200)]
    data += [(300, 0, "a", "Vukobilesta Foods", 5e6, "USD", 5e6, dt.date(2026, 1, 1), None), (301, 1, "b", "Vukobilestta Foods", 5e6, "USD", 5e6, dt.date(2026, 1, 1), None)]
    records = history.round_records(rows(RND, *data), rows(*RATES)).cache()
    index = history.History(spark, "round")
    index.add(records.where("batch_no = 0"))
    monkeypatch.setattr(history, "_name_edits", lambda a, b: F.lit(0))
    got = pairs(index.probe(records.where("batch_no = 1")))
    index.drop()
    assert (300, 301) in got and len(got) < 60


@pytest.mark.parametrize("seed", range(3))
def test_one_edit_changes_two_letter_bits_at_most(seed):
    rng = random.Random(seed)
    for _ in range(2000):
        a = "".join(rng.choice("abcé z9\u0938") for _ in range(rng.randint(1, 9)))
        at, c = rng.randrange(len(a)), rng.choice("abzé1")
        for b in (a[:at] + c + a[at:], a[:at] + a[at + 1 :], a[:at] + c + a[at + 1 :], a[:at] + a[at : at + 2][::-1] + a[at + 2 :]):
            assert ((history._letters(a) ^ history._letters(b)) & (1 << 64) - 1).bit_count() <= 2


def test_signatures_estimate():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 62, 400, dtype=np.uint64)
    b = np.concatenate([a[:360], rng.integers(0, 1 << 62, 40, dtype=np.uint64)])
    alike = (history.signature(a, 128) == history.signature(b, 128)).mean()
    assert abs(alike - 360 / 440) < 0.12


def test_chain_over_nine_batches(rows):
    """A page revised once a batch, each time further from the first: every repeat leads back to it."""
    words = text(1, 200).split()
    data = []
    for b in range(9):
        data.append((b + 1, b, f"https://site{b}.example/page", "T", " ".join(words), None))
        at = 20 * b
        words[at : at + 20] = [f"new{b}w{k}" for k in range(20)]
    assert pairs(history.repeats(history.page_records(rows(ART, *data)), "article")) == {(1, i) for i in range(2, 10)}


def test_many_revisions_cost_no_square(rows, spark):
    """Of 300 light revisions of one page a key has one entry, and a batch's revisions hit it once each."""
    words = text(1, 300).split()
    data = [(i, i // 150, f"https://a.example/{i}", f"T{i}", " ".join([*words[:-1], f"last{i}"]), None) for i in range(300)]
    records = history.page_records(rows(ART, *data)).cache()
    index = history.History(spark, "article")
    index.add(records.where("batch_no = 0"))
    stored = spark.read.schema(history.KEY).parquet(f"{index.path}/keys").where("not exact").groupBy("key").count()
    assert stored.agg({"count": "max"}).first()[0] <= 3
    assert pairs(index.probe(records.where("batch_no = 1"))) == {(0, i) for i in range(150, 300)}


def test_only_asked_buckets_are_read(rows, spark):
    """A batch of one page reads no more buckets than it has keys, and the folder goes with the index."""
    records = history.page_records(articles(rows)).cache()
    index = history.History(spark, "article")
    index.append(records.where("batch_no = 0"))
    one = records.where("id = 5")
    asked = index._asked(index._keys(one, True), "bucket", "buckets")
    assert len(asked) <= index._keys(one, True).count() and max(asked) < index.buckets
    index.drop()
    import os

    assert not os.path.exists(index.path.removeprefix("file:"))


def test_a_batch_takes_few_jobs(rows, spark):
    """What the driver holds grows with the jobs of a batch, however few rows it has: no count is made beside what is stored
    or collected anyway, and buckets aren't pruned by a query of their own."""
    jobs = lambda: spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    for kind, records, most in (("article", history.page_records(articles(rows)), 30), ("round", history.round_records(rounds(rows), rows(*RATES)), 22)):
        records, index = records.cache(), history.History(spark, kind)
        index.add(records.where("batch_no = 0"))
        began = jobs()
        index.add(records.where("batch_no = 1"))
        index.drop()
        assert jobs() - began <= most
