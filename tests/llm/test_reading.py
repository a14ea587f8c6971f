"""Reading level: held-out accuracy on made levels, language, edges."""

from __future__ import annotations

import random

from roundmill.llm import reading

EASY = "the firm sold cheap food and the team got a new van in the town".split()
MIDDLE = "the company will improve its booking system while the market is growing and the staff has tested online classes".split()
HARD = "considerable institutional heterogeneity of the multilateral remuneration framework necessitates comprehensive recalibration and is substantiated".split()


def text(level, rng):
    pool, size = {1: (EASY, 5), 2: (EASY + MIDDLE, 10), 3: (MIDDLE + HARD, 17), 4: (HARD, 26)}[level]
    return " ".join(" ".join(["The", *(rng.choice(pool) for _ in range(size)), "of", "the"]) + "." for _ in range(90 // size + 3))


def test_levels(rows):
    rng = random.Random(1)
    docs = [(i, text(1 + i % 4, rng), "de") for i in range(240)]
    labels = [(i, 1 + i % 4) for i in range(0, 120)] + [(5, None), (6, 9), (None, 2), (9999, 1)]
    odd = [(900, None, None), (901, "", "en"), (902, "The cat.", "en"), (903, "Die Bank plant ein neues Lager mit der Firma und das Unternehmen. " * 9, "en"), (904, "the food of the town is in the van " * 9000, None), (905, "नमस्ते दुनिया " * 60, "en"), (None, text(1, rng), "en")]
    df = rows("doc_id long, text string, lang string", *docs, *odd)
    got = {r["doc_id"]: r["reader_level"] for r in reading.reading_levels(df, rows("doc_id long, reader_level int", *labels)).collect()}
    held = range(120, 240)
    assert sum(got[i] == 1 + i % 4 for i in held) >= 0.93 * 120
    assert set(got) == {*range(240), 904}
    assert {r["reader_level"] for r in reading.reading_levels(df, rows("doc_id long, reader_level int")).collect()} == {2}
    assert reading.reading_levels(df.limit(0), rows("doc_id long, reader_level int", *labels)).count() == 0


def test_sentences():
    assert reading.sentence_count("A b c. D e f! G\nH i\n- j (4%)\n") == 5 and reading.sentence_count("") == 1 and reading.sentence_count("Rs.5 only?") == 1
    assert reading.sentence_count("x " * 100_000) == 1


def test_english():
    assert reading.is_english(("the firm of the town is in a van and it has been " * 5).split()) and not reading.is_english(["the"] * 39) and not reading.is_english(("la empresa del este y las con el " * 9).split())
