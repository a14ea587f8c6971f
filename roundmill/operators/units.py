"""Quantities recorded in different units: every sum in whole US dollars.

A record tells of its sum in up to three ways: ``amount`` with a label that may be missing or wrong and a scale (units,
thousands, lakhs, millions, crores) that often is; ``amount_usd``, whose ratio to ``amount`` shows which rate was
used; and the text, whose mentions may be read in more than one way. All log amounts are taken as one log-normal size
distribution seen through (currency, scale) components whose offsets are the known conversion factors. EM fits its
centre and width, the shares of currencies and scales and how far labels and ratios can be trusted, with the
records whose text agrees with a unit as certain ones. Each row gets the unit of highest posterior; where the text can be
read in several ways, the posterior of the readings, given the amount, decides.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundmill.functions.money import SCALE_FORMS, currency_of, readings_of
from roundmill.runtime import collect_bounded, cut

#: Scales in which an amount may have been recorded: true amount = recorded amount x scale.
SCALES = (1.0, 1e3, 1e5, 1e6, 1e7, 1e9, 1e-3, 1e-6)
BIN = 0.25  # width of the histogram's bins in natural logarithms
LOW, HIGH = -12.0, 45.0  # its range; amounts outside are clipped for the fit only
MAX_RATES = 400  # more currencies than there are in the world
AGREE = 0.02  # natural logarithm within which an amount agrees with a stated sum
RATIO = 0.005  # the same for the ratio of amount_usd and amount to a rate
SLIP = 1e-3  # share of amounts that agree with no unit of the sum stated
_LABEL_SCALE = "|".join(p for _, p in SCALE_FORMS if p)


def label_currency(label: Column, known: list[str]) -> Column:
    """ISO code of a currency label as typed ("Rs.", "US$", "USD mn"); null if it names none that has a rate."""
    bare = F.trim(F.regexp_replace(label, rf"(?i)(?<=\W)({_LABEL_SCALE})\.?\s*$", ""))
    code = F.coalesce(currency_of(bare), F.upper(bare))
    return F.when(code.isin(known), code)


def label_scale(label: Column) -> Column:
    """The scale that a label such as "USD mn" or "INR cr" names; null if it names none."""
    out = F.lit(None).cast("double")
    for factor, pattern in reversed(SCALE_FORMS):
        out = F.when(label.rlike(rf"(?i)\W({pattern})\.?\s*$"), factor).otherwise(out)
    return out


def _rates(rates_df: DataFrame) -> dict[str, float]:
    rows = collect_bounded(rates_df.select("currency", "usd_per_unit").where("usd_per_unit > 0 and currency is not null"), MAX_RATES, "rates")
    return {r["currency"]: float(r["usd_per_unit"]) for r in rows} or {"USD": 1.0}


def _units(rates: dict[str, float]) -> list[tuple[str, float, float]]:
    """(currency, scale, offset of the logarithm) of each component."""
    return [(c, s, math.log(rates[c] * s)) for c in sorted(rates) for s in SCALES]


def _table(units: list[tuple], fields: str) -> Column:
    """A table of the components as one constant."""
    names = [f.split(" ")[0] for f in fields.split(", ")]
    schema = ", ".join(f.replace(" ", ": ") for f in fields.split(", "))
    return F.from_json(F.lit(json.dumps([dict(zip(names, u)) for u in units])), f"array<struct<{schema}>>")


def _observed(rounds: DataFrame, rates: dict[str, float]) -> DataFrame:
    """What each record tells: label, hint (scale named by the label or shown by the ratio), ratio (currency whose rate was
    used), y (log amount, the hint applied), readings of the text in dollars with their priors."""
    rate = F.create_map(*[F.lit(x) for kv in sorted(rates.items()) for x in kv])
    clean = lambda c: F.when((F.col(c) > 0) & ~F.isnan(c) & (F.col(c) < 1e300), F.col(c))
    base = rounds.select("record_id", clean("amount").alias("amount"), F.nanvl("amount_usd", F.lit(None).cast("double")).alias("amount_usd"), label_currency(F.col("currency"), sorted(rates)).alias("label"), label_scale(F.col("currency")).alias("named"), clean("amount_usd").alias("paid"), readings_of(F.col("summary")).alias("said"))
    plain_first = _table(sorted(_units(rates), key=lambda u: abs(math.log(u[1]))), "c string, s double, o double")  # a plain rate is the likelier reading
    base = base.withColumn("used", F.try_element_at(F.filter(plain_first, lambda u: F.abs(F.ln(F.col("paid") / F.col("amount")) - u["o"]) < RATIO), F.lit(1)))
    shown = F.when(F.col("used")["s"] != 1.0, F.col("used")["s"])
    base = base.withColumns({"ratio": F.col("used")["c"], "hint": F.coalesce("named", shown, F.lit(1.0))})
    dollars = F.filter(F.transform("said", lambda m: F.struct((m["value"] * F.try_element_at(rate, m["currency"])).alias("usd"), m["prior"].alias("prior"))), lambda m: m["usd"] > 0)
    return base.withColumns({"hinted": F.col("hint") != 1.0, "y": F.ln(F.col("amount") * F.col("hint")), "readings": dollars})


def _currency_prior(model: dict, currency: str, label: str | None, ratio: str | None) -> float:
    kind = _evidence(label, ratio)
    a, b = model["trust"][kind]
    return a * (currency == label) + b * (currency == ratio) + (1 - a - b) * model["share"][currency]


def _evidence(label: str | None, ratio: str | None) -> str:
    return ("none" if ratio is None else "ratio") if label is None else "label" if ratio is None else "same" if label == ratio else "other"


def fit_units(observed: DataFrame, rates: dict[str, float], rounds: int = 30) -> dict:
    """EM over counts by label, ratio and bin, and for rows whose text agrees with a unit by that unit; made over all
    rows, the counts don't grow with them. Without usable amounts a standard prior (centre 4 million dollars) is returned."""
    units = _units(rates)
    offset = np.array([o for _, _, o in units])
    currencies = sorted(rates)
    said = F.ln(F.try_element_at("readings", F.lit(1))["usd"])
    plain_first = _table([(k, u[2]) for k, u in sorted(enumerate(units), key=lambda ku: abs(math.log(ku[1][1])))], "k int, o double")
    near = F.try_element_at(F.filter(plain_first, lambda u: F.abs(F.col("y") + u["o"] - said) < AGREE), F.lit(1))["k"]
    single = F.size("readings") == 1  # texts with one reading only are certain ones
    x = F.when(single, said).otherwise(F.col("y"))
    cells = observed.where(F.col("y").isNotNull()).withColumns({"unit": F.when(single, F.coalesce(near, F.lit(-1))), "x": F.greatest(F.lit(LOW), F.least(F.lit(HIGH), x))})
    cells = cells.withColumn("bin", F.when(F.col("unit").isNull(), F.round(F.col("x") / BIN).cast("int")))
    seen = cells.groupBy("label", "ratio", "hinted", "unit", "bin").agg(F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx"))
    evidence = 2 * (len(rates) + 1) ** 2
    rows = collect_bounded(seen, int(evidence * (len(units) + 2 + (HIGH - LOW) / BIN)), "counts of amounts")
    shares = {s: 0.9 if s == 1.0 else 0.1 / (len(SCALES) - 1) for s in SCALES}
    model = {"mu": math.log(4e6), "sigma": 1.8, "share": {c: 1 / len(currencies) for c in currencies}, "scales": {(h, c): dict(shares) for h in (False, True) for c in currencies}}
    model["trust"] = {"none": (0.0, 0.0), "label": (0.9, 0.0), "ratio": (0.0, 0.9), "same": (0.45, 0.45), "other": (0.3, 0.6)}
    if not rows:
        return model
    n = np.array([r["n"] for r in rows], float)
    mean, square = np.array([r["sx"] for r in rows]) / n, np.array([r["sxx"] for r in rows]) / n
    fixed = np.array([-2 if r["unit"] is None else r["unit"] for r in rows])
    free, known, stray = fixed == -2, fixed >= 0, fixed == -1
    where = {c: np.array([k for k, u in enumerate(units) if u[0] == c]) for c in currencies}
    cells_of = {(kind): np.array([_evidence(r["label"], r["ratio"]) == kind for r in rows]) for kind in model["trust"]}
    by_label = np.array([[u[0] == r["label"] for u in units] for r in rows])
    by_ratio = np.array([[u[0] == r["ratio"] for u in units] for r in rows])
    hinted = np.array([bool(r["hinted"]) for r in rows])
    z = mean[:, None] + offset[None, :]
    for _ in range(rounds):
        share = np.array([model["share"][u[0]] for u in units])
        a, b = np.zeros(len(rows)), np.zeros(len(rows))
        for kind, at in cells_of.items():
            a[at], b[at] = model["trust"][kind]
        scale = np.array([[model["scales"][h, u[0]][u[1]] for u in units] for h in (False, True)])[hinted.astype(int)]
        parts = np.stack([a[:, None] * by_label, b[:, None] * by_ratio, (1 - a - b)[:, None] * np.broadcast_to(share, z.shape)]) * scale
        like = np.exp(-0.5 * ((z - model["mu"]) / model["sigma"]) ** 2) + 1e-300
        like[known] = 0.0
        like[known, fixed[known]] = 1.0
        like[stray] = 0.0
        post = parts.sum(0) * like
        total = post.sum(1, keepdims=True)
        post = np.divide(post, total, out=np.zeros_like(post), where=total > 0)
        w = post * n[:, None]
        size = np.where(free[:, None], z, mean[:, None])
        spread = np.where(free[:, None], 0.0, (square - mean * mean)[:, None]) + (BIN * BIN / 12) * free[:, None]
        model["mu"] = float((w * size).sum() / max(w.sum(), 1e-9))
        model["sigma"] = float(min(3.0, max(0.5, math.sqrt((w * ((size - model["mu"]) ** 2 + spread)).sum() / max(w.sum(), 1e-9)))))
        mass = {c: w[:, where[c]].sum() for c in currencies}
        model["share"] = {c: (mass[c] + 1) / (sum(mass.values()) + len(currencies)) for c in currencies}
        for h in (False, True):
            own = w[hinted == h].sum(0)
            pooled = np.array([sum(own[k] for k, u in enumerate(units) if u[1] == s) for s in SCALES])
            pooled = (pooled + np.array([9.0] + [1.0] * (len(SCALES) - 1)) / 2) / (pooled.sum() + (8 + len(SCALES)) / 2)
            for c in currencies:
                mine = own[where[c]]
                model["scales"][h, c] = dict(zip(SCALES, map(float, (mine + 10 * pooled) / (mine.sum() + 10))))
        joint = parts * like[None]
        joint = np.divide(joint, total[None], out=np.zeros_like(joint), where=total[None] > 0) * n[None, :, None]
        for kind, at in cells_of.items():
            if kind != "none":
                la, lb, rest = (float(joint[i][at].sum()) for i in range(3))
                start = {"label": (9, 0), "ratio": (0, 9), "same": (4.5, 4.5), "other": (3, 6)}[kind]
                model["trust"][kind] = ((la + start[0]) / (la + lb + rest + 10), (lb + start[1]) / (la + lb + rest + 10))
    return model


def fit_all(rounds: DataFrame, rates_df: DataFrame) -> dict:
    """The model of all records, for conversions of some of them."""
    rates = _rates(rates_df)
    return fit_units(_observed(rounds, rates), rates)


def convert_units(rounds: DataFrame, rates_df: DataFrame, *, sure: float = 0.8, model: dict | None = None) -> DataFrame:
    """One row per record with the sum in whole dollars, the unit its ``amount`` stands in and how sure that is.

    Columns: record_id, amount_usd, stated_usd (the sum of the summary in dollars, else null), unit_currency, unit_scale,
    posterior, usd (double), usd_whole (bigint), basis (stated, amount, recorded, none), uncertain.

    A null, NaN, zero or negative amount without a stated sum gives basis ``recorded`` (amount_usd as it
    stands) or ``none`` with null sums. Repeated records give repeated rows. An empty table gives no row.
    Currencies without a rate are treated as a missing label. Other columns are ignored. ``model`` is fitted on the
    rows themselves where none is given.
    """
    rates = _rates(rates_df)
    seen = cut(_observed(rounds, rates))  # read and parsed once; the fit and the assignment both read it
    model = model or fit_units(seen, rates)
    units = _units(rates)
    table = _table([(c, s, o, float(model["share"][c]), math.log(model["scales"][False, c][s]), math.log(model["scales"][True, c][s])) for c, s, o in units], "c string, s double, o double, q double, p0 double, p1 double")
    kind = F.when(F.col("label").isNull(), F.when(F.col("ratio").isNull(), "none").otherwise("ratio")).otherwise(F.when(F.col("ratio").isNull(), "label").when(F.col("label") == F.col("ratio"), "same").otherwise("other"))
    trust = F.from_json(F.lit(json.dumps({k: {"a": a, "b": b} for k, (a, b) in model["trust"].items()})), "map<string, struct<a: double, b: double>>")
    is_ = lambda u, name: F.coalesce((u["c"] == F.col(name)).cast("double"), F.lit(0.0))
    rest = 1 - F.col("t")["a"] - F.col("t")["b"]
    prior = F.transform("unit", lambda u: F.ln(F.col("t")["a"] * is_(u, "label") + F.col("t")["b"] * is_(u, "ratio") + rest * u["q"]) + F.when(F.col("hinted"), u["p1"]).otherwise(u["p0"]))
    size = lambda x: -0.5 * F.pow((x - model["mu"]) / model["sigma"], 2)
    agrees = lambda x, sum_: F.greatest(F.lit(-300.0), -0.5 * F.pow((x - F.ln(sum_)) / AGREE, 2))
    scored = seen.withColumns({"t": F.try_element_at(trust, kind), "unit": table}).withColumn("prior", prior)
    # the readings of the text, given the amount: one that a likely unit makes agree outweighs the others
    borne_out = lambda m: F.when(F.col("y").isNull(), 0.0).otherwise(F.ln(SLIP + F.aggregate(F.zip_with("prior", "unit", lambda p, u: F.exp(p + agrees(F.col("y") + u["o"], m["usd"]))), F.lit(0.0), lambda a, v: a + v)))
    ranked = F.transform("readings", lambda m: F.struct((F.ln(m["prior"]) + borne_out(m) + size(F.ln(m["usd"]))).alias("score"), m["usd"].alias("usd")))
    stated = F.when(F.size("readings") > 1, F.array_max(ranked)["usd"]).otherwise(F.try_element_at("readings", F.lit(1))["usd"])
    scored = scored.withColumn("stated_usd", stated)
    score = F.zip_with("prior", "unit", lambda p, u: p + F.when(F.col("stated_usd").isNotNull(), agrees(F.col("y") + u["o"], F.col("stated_usd"))).otherwise(size(F.col("y") + u["o"])))
    scored = scored.withColumn("score", F.when(F.col("y").isNotNull(), score)).withColumn("best", F.array_max("score"))
    scored = scored.withColumn("posterior", 1 / F.aggregate("score", F.lit(0.0), lambda a, s: a + F.exp(s - F.col("best"))))
    scored = scored.withColumn("u", F.try_element_at("unit", F.when(F.col("best").isNotNull(), F.array_position("score", F.col("best")).cast("int"))))
    recorded = F.when(F.col("amount_usd") > 0, F.col("amount_usd"))
    usd = F.coalesce("stated_usd", F.exp(F.col("y") + F.col("u")["o"]), recorded)
    basis = F.when(F.col("stated_usd").isNotNull(), "stated").when(F.col("y").isNotNull(), "amount").when(recorded.isNotNull(), "recorded").otherwise("none")
    return scored.select(
        "record_id", "amount_usd", "stated_usd", F.col("u")["c"].alias("unit_currency"), (F.col("u")["s"] * F.col("hint")).alias("unit_scale"), F.round("posterior", 6).alias("posterior"), usd.alias("usd"),
        F.round(usd, 0).cast("bigint").alias("usd_whole"), basis.alias("basis"), (F.coalesce("posterior", F.lit(0.0)) < sure).alias("uncertain"),
    )


def wrong_dollars(converted: DataFrame, *, tolerance: float = 0.01) -> DataFrame:
    """record_id, usd_whole of the records whose summary states the sum while amount_usd is missing or off by more than the tolerance."""
    off = F.col("amount_usd").isNull() | (F.abs(F.col("amount_usd") - F.col("stated_usd")) > tolerance * F.col("stated_usd"))
    return converted.where((F.col("basis") == "stated") & off).select("record_id", "usd_whole")
