"""Leaks: planted passages, scraps, other texts built alike, disguises."""

from __future__ import annotations

import random

import pytest

from roundmill.llm import leaks


def item(i, rng):
    name = lambda: "".join(rng.choice("bdkmrtvz") + rng.choice("aeiou") for _ in range(4)).capitalize()
    x, y, p = name(), name(), name()
    return f"In Pune, Neha {p} merged {rng.randint(1000, 9999)} loom workshops into {x} Foods; {y} Angels paid {rng.randint(100, 999)} euros and took a convertible note in return. The carpet unit left {x} Foods in May 2021 for {rng.randint(1000, 9999)} pounds, of which {y} Angels kept 34 percent in escrow until 8 March 2020."


RNG = random.Random(9)
ITEMS = {i: item(i, RNG) for i in range(40)}
FILL = "The repair network showed its data team because demand is growing and the kitchen ran soft toys at once this year."


def change(words, rng):
    return [rng.choice(["former", "new", "small"]) if k % 8 == 4 else w for k, w in enumerate(words)]


def test_leaks(rows):
    rng = random.Random(3)
    docs, expected = {}, set()
    for i in range(30):
        words = ITEMS[i].split()
        at = rng.randint(0, len(words) - 24)
        passage = words[at : at + 24]
        text = " ".join(passage)
        if i % 5 == 1:
            text = " ".join(change(passage, rng))
        elif i % 5 == 2:
            text = text.upper().replace(" ", "\n").replace("A", "Á")
        elif i % 5 == 3:
            text = " ".join(f"<b>{w}</b>" if k % 3 == 0 else w[:2] + "-\n" + w[2:] if len(w) > 6 and w.isalpha() else w + "­" for k, w in enumerate(passage))
        docs[i] = f"{FILL} {text} {FILL}"
        expected.add((i, i))
    for i in range(30, 40):
        docs[i] = f"{FILL} {' '.join(ITEMS[i].split()[5:13])} {FILL}"  # a scrap
    for i in range(40, 60):
        docs[i] = f"{FILL} {item(i, rng)} {FILL}"  # built alike, another text
    docs[60], docs[61], docs[62], docs[63] = None, "", "   ", FILL * 2000
    docs[64] = docs[0] + " " + docs[1]
    expected |= {(64, 0), (64, 1)}
    # by chance a text built alike may hold 15 running words, all equal: that is a leak by its definition
    expected |= {(d, i) for d in range(40, 60) for i, t in ITEMS.items() if any(f" {' '.join(w[k : k + 15])} " in f" {' '.join(leaks.words_of(docs[d]))} " for w in [leaks.words_of(t)] for k in range(len(w) - 14))}
    df = rows("doc_id long, text string, item_id string", *[(k, v, "clash") for k, v in docs.items()], (None, docs[0], ""))
    its = rows("item_id long, text string, task string", *[(k, v, "qa") for k, v in ITEMS.items()], (900, None, ""), (901, "", ""), (902, "too short to leak", ""))
    got = {(r["doc_id"], r["item_id"]) for r in leaks.leaked_items(df, its).collect()}
    assert got == expected
    assert leaks.leaked_items(df.limit(0), its).count() == 0 and leaks.leaked_items(df, its.limit(0)).count() == 0


def test_item_that_leaked_everywhere(rows):
    docs = [(i, f"{FILL} {ITEMS[3]}") for i in range(200)] + [(900, ITEMS[5])]
    got = {(r["doc_id"], r["item_id"]) for r in leaks.leaked_items(rows("doc_id long, text string", *docs), rows("item_id long, text string", *ITEMS.items())).collect()}
    assert got == {(i, 3) for i in range(200)} | {(900, 5)}


def test_part_that_leaked_everywhere(rows):
    """Fewer than half of the item's marks leaked, and they are the frequent ones."""
    part = " ".join(ITEMS[3].split()[-18:])
    docs = [(i, f"{FILL} {part} {FILL}") for i in range(200)] + [(900, ITEMS[5])]
    got = {(r["doc_id"], r["item_id"]) for r in leaks.leaked_items(rows("doc_id long, text string", *docs), rows("item_id long, text string", *ITEMS.items())).collect()}
    assert got == {(i, 3) for i in range(200)} | {(900, 5)}


def test_copies_of_items():
    """An item under four ids keeps its marks and is reported under each."""
    index = leaks.Index({i: leaks.words_of(ITEMS[max(i, 3)]) for i in range(40)})
    assert {i for i, _ in index.found(f"{FILL} {ITEMS[3]}", 15)} == {0, 1, 2, 3}


@pytest.mark.parametrize(("n", "changed"), [(15, (k,)) for k in range(15)] + [(15, (a, b)) for a in range(1, 14) for b in range(a + 1, 14)] + [(20, (3, 7)), (20, (1, 18)), (16, (2, 13))])
def test_changes_anywhere(n, changed):
    """One or two changed words lose no passage, wherever they stand."""
    words = leaks.words_of(ITEMS[3])
    marks = leaks.index_terms({i: leaks.words_of(t) for i, t in ITEMS.items()})
    passage = ["other" if k in changed else w for k, w in enumerate(words[:n])]
    assert leaks.longest_passage(words, ["yes", *passage, "so"], 1, marks) >= n - 2


@pytest.mark.parametrize(("raw", "words"), [("Pref-\nerence <b>Sh</b>ares&nbsp;<br>é", ["preference", "shares", "e"]), ("earn-out *x* a_b", ["earnout", "x", "a", "b"]), ("", [])])
def test_words(raw, words):
    assert leaks.words_of(raw) == words


def test_words_that_several_items_share(rows):
    """28 running words that three items share hold no mark of any of them, and leak from each."""
    shared = " ".join(f"common{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(28))
    items = [(i, f"{ITEMS[i]} {shared}") for i in range(3)] + [(i, ITEMS[i]) for i in range(3, 40)]
    got = {(r["doc_id"], r["item_id"]) for r in leaks.leaked_items(rows("doc_id long, text string", (1, f"{FILL} {shared} {FILL}"), (2, f"{FILL} {' '.join(shared.split()[:14])}")), rows("item_id long, text string", *items)).collect()}
    assert got == {(1, 0), (1, 1), (1, 2)}
