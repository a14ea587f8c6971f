"""Sums in text and the unit mixture."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roundmill.functions.money import stated_sum
from roundmill.operators.units import convert_units, wrong_dollars

RATES = [("USD", 1.0), ("INR", 0.012), ("EUR", 1.09), ("SGD", 0.74), ("JPY", 0.007)]
SCHEMA = "record_id long, amount double, currency string, amount_usd double, summary string"


@pytest.mark.parametrize(
    ("text", "value", "currency"),
    [
        ("Foo bagged Rs. 9.5 cr. to grow.", 9.5e7, "INR"), ("Fresh capital of US$2,300K will help.", 2.3e6, "USD"), ("got three million dollars now.", 3e6, "USD"), ("got half a million euros.", 5e5, "EUR"),
        ("secured S$15M from X.", 15e6, "SGD"), ("raised 1,450 lakh rupees today.", 1.45e8, "INR"), ("put ¥1.8 bn into it.", 1.8e9, "JPY"), ("€ 9.1 mln came.", 9.1e6, "EUR"), ("€ 4,3 Mio came.", 4.3e6, "EUR"), ("5.6 million Singapore dollars in.", 5.6e6, "SGD"),
        ("A deal of undisclosed size. Revenue last year stood at $150M.", None, None), ("Its previous round brought Rs 393 crore.", None, None), ("no sum in 2025", None, None), ("", None, None), (None, None, None), ("Foo bagged Rs. 2...", None, None),
    ],
)
def test_stated_sum(rows, text, value, currency):
    got = rows("t string", (text,)).select(stated_sum(F.col("t")).alias("x")).first()["x"]
    assert (got and (round(got["value"], 2), got["currency"])) == (value and (value, currency))


def test_conversion(rows):
    data = [(i, float(2_000_000 * (1 + i % 7)), "USD", None, None) for i in range(60)]
    data += [(100, 3.8, "USD", 3.8e6, "A round of US$3.8 MM was closed by X."), (101, 22.0, "INR", 0.26, "X secured Rs 22 lakh from Y."), (102, 5e6, "EUR", 5.45e6, "X mopped up €5 million in its deal.")]
    data += [(103, None, None, None, None), (104, float("nan"), "USD", 7e6, ""), (105, -5.0, "??", 0.0, "x" * 5000), (106, 4.0, "USD mn", None, None)]
    got = {r["record_id"]: r for r in convert_units(rows(SCHEMA, *data), rows("currency string, usd_per_unit double", *RATES)).collect()}
    assert len(got) == len(data)
    assert (got[100]["usd_whole"], got[100]["unit_scale"], got[100]["basis"]) == (3_800_000, 1e6, "stated")
    assert (got[101]["usd_whole"], got[101]["unit_currency"], got[101]["unit_scale"]) == (26_400, "INR", 1e5)
    assert got[103]["basis"] == "none" and got[103]["usd_whole"] is None and got[103]["uncertain"]
    assert (got[104]["basis"], got[104]["usd_whole"]) == ("recorded", 7_000_000)
    assert got[105]["basis"] == "none"
    assert got[106]["usd"] == pytest.approx(4e6)
    wrong = {r["record_id"]: r["usd_whole"] for r in wrong_dollars(convert_units(rows(SCHEMA, *data), rows("currency string, usd_per_unit double", *RATES))).collect()}
    assert wrong == {101: 26_400}


def test_empty_and_no_rates(rows):
    assert convert_units(rows(SCHEMA), rows("currency string, usd_per_unit double", *RATES)).count() == 0
    got = convert_units(rows(SCHEMA + ", stage string", (1, 5e6, "USD", None, None, "seed"), (1, 5e6, "USD", None, None, "seed")), rows("currency string, usd_per_unit double")).collect()
    assert [r["usd_whole"] for r in got] == [5_000_000] * 2


def _deals(n=600):
    """Deals with known sums, recorded in units, millions and crores, some under no label; the text isn't given."""
    import random

    rng = random.Random(5)
    truth, data = {}, []
    for i in range(n):
        usd = round(10 ** rng.uniform(5.3, 8), -4)
        currency, scale = rng.choice([("USD", 1.0), ("USD", 1.0), ("INR", 1.0), ("INR", 1.0), ("USD", 1e6), ("INR", 1e7)])
        rate = dict(RATES)[currency]
        amount = usd / rate / scale
        label = None if rng.random() < 0.1 else currency
        truth[i] = usd
        data.append((i, amount, label, amount * rate, f"X secured {currency} {usd / rate:.0f} from Y." if i % 2 else None))
    return truth, data


def test_units_without_text(rows):
    """Sums of records without text, the unit told by label, ratio and size; the share of uncertain ones is bounded too."""
    truth, data = _deals()
    got = [r for r in convert_units(rows(SCHEMA, *data), rows("currency string, usd_per_unit double", *RATES)).collect() if r["basis"] == "amount"]
    right = {r["record_id"] for r in got if abs(r["usd"] / truth[r["record_id"]] - 1) < 0.01}
    sure = [r["record_id"] for r in got if not r["uncertain"]]
    assert len(got) == 300 and len(sure) > 200 and sum(k in right for k in sure) >= 0.9 * len(sure)


def test_reading_by_amount(rows):
    """A number that reads in two ways is read as the amount bears out."""
    _, data = _deals()
    data += [(900, 1.5, "EUR", 1.5e6 * 1.09, "X mopped up € 1,500 million in its deal."), (901, 1_500e6, "EUR", None, "X mopped up € 1,500 million in its deal."), (902, 4.3e6, "EUR", None, "X mopped up € 4,3 Mio in its deal.")]
    got = {r["record_id"]: r for r in convert_units(rows(SCHEMA, *data), rows("currency string, usd_per_unit double", *RATES)).collect()}
    assert [round(got[k]["stated_usd"]) for k in (900, 901, 902)] == [1_635_000, 1_635_000_000, 4_687_000]
