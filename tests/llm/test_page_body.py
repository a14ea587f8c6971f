"""Body of pages: blocks, scan, held-out accuracy."""

from __future__ import annotations

import datetime as dt
import hashlib
import itertools
import random

from hypothesis import given
from hypothesis import strategies as st

from roundmill.llm import page_body

WORDS = "market copper tractor bridge winter harvest engine village bakery lantern saddle orchid pepper velvet marble".split()


def make(i, rng):
    body = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(8, 30))).capitalize() + "." for _ in range(rng.randint(2, 6))]
    notice = "Join our weekly letter"
    html = f"<html><head><title>t {i}</title><script>var x='<p>no</p>';</script></head><body><nav><ul><li><a href='/h'>Home</a></li><li><a href='/p'>People</a></li></ul></nav><main><h1>Head {i}</h1>"
    html += "".join(f"<p>{b}</p>" + ("<p>" + notice + "</p>" if k == 0 else "") for k, b in enumerate(body))
    html += f"</main><aside><h3>Trending</h3><div><a href='/s/{i}'>Other {i}</a><p>{' '.join(rng.choice(WORDS) for _ in range(9))}.</p></div></aside><footer><p>Terms &amp; privacy</p></footer></body></html>"
    return html, body, "\n".join(["By Ann", body[0], notice, *body[1:]])


def test_blocks():
    page = "<p>One&nbsp;<b>two</b>\n three<br>four<!-- c --> five</p><style>p{}</style><div>&lt;x&gt;</div><p>open"
    assert [t for t, _ in page_body.blocks_of(page)] == ["One two three", "four five", "<x>", "open"]
    assert page_body.blocks_of("") == [] and page_body.blocks_of("<div></div>") == []


@given(st.lists(st.integers(-5, 5), max_size=12))
def test_region_is_the_best(scores):
    begin, end = page_body.best_region([float(s) for s in scores])
    best = max([0, *(sum(scores[i:j]) for i, j in itertools.combinations(range(len(scores) + 1), 2))])
    assert sum(scores[begin:end]) == best


def test_accuracy_and_edges(rows):
    rng = random.Random(4)
    data = [make(i, rng) for i in range(120)]
    schema = "fetch_id long, source string, text string, html string, published_at timestamp_ntz, block string"
    day = lambda i: dt.datetime(2026, 1, 1) + dt.timedelta(days=i)
    df = rows(schema, *[(i, "s", t, h, day(i), "clash") for i, (h, _, t) in enumerate(data)])
    weights = page_body.fit_weights(page_body.label_pages(df.select("fetch_id", "source", "text", "html", "published_at")))
    held = [make(1000 + i, rng) for i in range(40)]
    test = rows(schema, *[(i, "s", None, h, None, "") for i, (h, _, _) in enumerate(held)], (900, "s", "x", None, None, None), (901, None, None, "", None, None), (902, "s", None, "plain " * 50_000, None, None), (903, "s", None, "<p><div><broken", None, None), (None, "s", None, held[0][0], None, None))
    got = {}
    for r in page_body.page_bodies(test, weights).collect():
        got.setdefault(r["fetch_id"], []).append(r["block"])
    right = sum(set(got.get(i, [])) == set(b) for i, (_, b, _) in enumerate(held))
    assert right >= 38 and 900 not in got and 901 not in got
    hashes = page_body.body_hashes(test, weights).where("fetch_id = 0").collect()
    assert {r["block_hash"] for r in hashes} == {hashlib.sha256(b.encode()).hexdigest()[:16] for b in got[0]}
    assert page_body.page_bodies(df.limit(0)).count() == 0
