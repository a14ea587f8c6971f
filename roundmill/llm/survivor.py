"""Best representative of each group of duplicate records, field by field.

Every member claims a value for each field, and sources of unknown quality vote on every claim: the ways of extraction
and the site a record came from, the other members of the group, the pages held, and readings of the text. A two-sided
model gives each source a sensitivity (how often it supports true claims) and a specificity (how often it withholds
support from false ones), inferred by expectation-maximisation from all claims together, with prior counts as strong as
a share of the claims. The posterior alone decides: claims above one half are judged true, a field that may hold several
values keeps them all, and the survivor takes the likeliest. The statistics are the counts of patterns of support, so
they don't grow with the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundmill.functions.money import CUT_MARK
from roundmill.functions.urls import canonical_url
from roundmill.llm.name_parts import parts_of, sound_of, words_plain
from roundmill.operators.units import convert_units, fit_all
from roundmill.runtime import collect_bounded, cut

FIELDS = ("confidence", "summary", "article_url")
#: Sources per field; each votes for or against every claim. The last three are the ways of extraction, of which a claim
#: has one at most; ``own_site`` says that the record's link leads to a site of which pages are held.
METHODS = ("llm", "manual", "regex_fallback")
SOURCES = {
    "confidence": ("unbeaten", "own_site", *METHODS),
    "summary": ("sentences", "uncut", "closed", "names_company", "states_sum", "no_other_sum", "own_words", "plain", "own_site", *METHODS),
    "article_url": ("well_formed", "site_known", "page_held", "page_names", *METHODS),
}
#: Prior sensitivity, specificity and weight (as a share of all claims) of sources whose vote has a meaning of its own;
#: the others have a weak prior that leans towards being right more often than not.
PRIORS = {
    "unbeaten": (0.95, 0.95, 0.5), "page_held": (0.98, 0.98, 0.5), "page_names": (0.9, 0.95, 0.5),  # a roundup's title doesn't name each company
    "closed": (0.999, 0.9, 1.0), "uncut": (0.999, 0.8, 0.5), "names_company": (0.98, 0.6, 0.5), "states_sum": (0.98, 0.8, 0.5),
}
TRUE_AT = 0.5
MULTIPLE = ("article_url",)  # fields that keep every value judged true


@F.pandas_udf(T.BooleanType())
def _names(text, name):  # noqa: ANN001, ANN202
    """Whether the text names the company: its core, in plain letters, stands in the text."""
    import pandas as pd

    out = []
    for t, n in zip(text, name):
        core = sound_of(parts_of(n)[0]) if n else ""
        out.append(bool(t) and len(core) > 2 and core in sound_of("".join(words_plain(t))))
    return pd.Series(out, dtype="bool")


def infer_quality(patterns: list[tuple[tuple[bool, ...], int]], rounds: int = 60, priors: list[tuple[float, float, float] | None] | None = None) -> dict:
    """Sensitivity and specificity of each source, and the share of true claims, from counts of support patterns."""
    if not patterns:
        return {"prior": 0.5, "sens": np.array([]), "spec": np.array([])}
    x = np.array([p for p, _ in patterns], float)
    n = np.array([c for _, c in patterns], float)
    own = np.array([p or (0.67, 0.67, 0.0) for p in priors or [None] * x.shape[1]])
    weight = 3 + own[:, 2] * n.sum()  # prior counts
    clear = own[:, 2] > 0
    truth = np.clip((x[:, clear] if clear.any() else x).mean(1), 0.05, 0.95)  # start: claims with much support are likelier
    for _ in range(rounds):
        t, f = n * truth, n * (1 - truth)
        prior = float(np.clip((t.sum() + 1) / (n.sum() + 2), 0.01, 0.99))
        sens = (t @ x + own[:, 0] * weight) / (t.sum() + weight)
        spec = (f @ (1 - x) + own[:, 1] * weight) / (f.sum() + weight)
        odds = np.log(prior / (1 - prior)) + x @ np.log(sens / (1 - spec)) + (1 - x) @ np.log((1 - sens) / spec)
        truth = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
    return {"prior": prior, "sens": sens, "spec": spec}


def _posterior(model: dict, supports: list[Column]) -> Column:
    odds = F.lit(float(np.log(model["prior"] / (1 - model["prior"]))))
    for s, sens, spec in zip(supports, model["sens"], model["spec"]):
        odds = odds + F.when(s, float(np.log(sens / (1 - spec)))).otherwise(float(np.log((1 - sens) / spec)))
    return 1 / (1 + F.exp(-odds))


def claims(groups: DataFrame, rounds: DataFrame, sources: DataFrame, articles: DataFrame, rates: DataFrame) -> DataFrame:
    """(group_id, field_name, record_id, value, supports): one row per claim, that is per member and field with a value, per
    link for article_url; supports holds one boolean per source of the field. A confidence outside 0..1 or NaN is no
    value, nor is a blank text."""
    member = groups.select("group_id", "record_id").where("group_id is not null and record_id is not null").distinct()
    columns = ["record_id", "round_id", "company_name", "summary", "confidence", "extraction_method", "stage", "amount", "amount_usd", "currency"]
    stage = F.col("stage") if "stage" in rounds.columns else F.lit(None).cast("string")
    own = rounds.withColumn("stage", stage).select(*columns).join(member, "record_id").dropDuplicates(["group_id", "record_id"])
    own = cut(own)  # the members' rows only; several branches read them
    usd = convert_units(own, rates, model=fit_all(rounds, rates)).select("record_id", "stated_usd", "usd").dropDuplicates(["record_id"])
    # texts that stand under several companies, by hash: only those of members are counted
    texts = own.where("summary is not null").select(F.xxhash64("summary").alias("words")).distinct()
    shared = rounds.where("summary is not null").select(F.xxhash64("summary").alias("words"), "company_name").join(texts, "words", "left_semi").groupBy("words").agg(F.min("company_name").alias("x"), F.max("company_name").alias("y")).where("x <> y").select("words", F.lit(True).alias("shared"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    valid = F.when((F.col("confidence") >= 0) & (F.col("confidence") <= 1), F.col("confidence"))
    per_group = own.join(usd, "record_id", "left").groupBy("group_id").agg(F.max(valid).alias("top"), F.percentile_approx("usd", 0.5, 1000).alias("middle"))
    base = own.join(usd, "record_id", "left").withColumn("words", F.xxhash64("summary")).join(shared, "words", "left").join(per_group, "group_id")

    page = canonical_url(F.col("url"))
    title = F.col("title") if "title" in articles.columns else F.lit(None).cast("string")
    held = cut(articles.select(page.alias("page"), title.alias("title")).where("page is not null").groupBy("page").agg(F.max("title").alias("title")))
    sites = held.select(F.regexp_extract("page", "^[^/?]+", 0).alias("site")).distinct()
    link = sources.select("round_id", F.col("article_url").alias("link"), canonical_url(F.col("article_url")).alias("page")).where("round_id is not null").distinct()
    link = link.join(own.select("round_id").distinct(), "round_id", "left_semi")
    link = link.join(held.withColumn("held", F.lit(True)), "page", "left").withColumn("site", F.regexp_extract("page", "^[^/?]+", 0)).join(sites.withColumn("known", F.lit(True)), "site", "left")
    linked = cut(own.select("group_id", "record_id", "round_id", "company_name", "extraction_method").join(link, "round_id"))
    some = linked.where("known").select("group_id", "record_id").distinct().withColumn("own_site", F.lit(True))
    base = cut(base.join(some, ["group_id", "record_id"], "left"))

    true = lambda *s: F.array(*[yes(x) for x in (*s, *[F.col("extraction_method") == m for m in METHODS])])
    row = lambda field, value: ("group_id", F.lit(field).alias("field_name"), "record_id", value.alias("value"))
    confidence = base.select(*row("confidence", valid.cast("string")), true(valid == F.col("top"), F.col("own_site")).alias("supports"))
    text = F.trim(F.coalesce("summary", F.lit("")))
    sentences = text.rlike(r"^[\p{Lu}\p{Ll}\p{N}“\"]") & (F.size(F.split(text, r"\s+")) >= 6)
    other = F.abs(F.col("stated_usd") - F.col("middle")) > 0.15 * F.greatest("stated_usd", "middle")
    read = (sentences, ~text.rlike(CUT_MARK), text.rlike(r"(?<!\.)[.!?][\"”’)]?$"), _names("summary", "company_name"), F.col("stated_usd").isNotNull(), ~yes(other), F.col("shared").isNull(), ~text.rlike(r"[<>\[\]{}|#]"), F.col("own_site"))
    summary = base.where(text != "").select(*row("summary", F.col("summary")), true(*read).alias("supports"))
    url = linked.select(*row("article_url", F.col("link")), true(F.col("page").isNotNull(), F.col("known"), F.col("held"), _names("title", "company_name")).alias("supports"))
    return confidence.unionByName(summary).unionByName(url).where("value is not null")


def judged_claims(all_claims: DataFrame) -> DataFrame:
    """The claims with the posterior of being true, the model fitted per field over all of them."""
    patterns = collect_bounded(all_claims.groupBy("field_name", "supports").count(), sum(2 ** len(s) for s in SOURCES.values()), "patterns of support")
    out = None
    for field in FIELDS:
        model = infer_quality([(tuple(r["supports"]), r["count"]) for r in patterns if r["field_name"] == field], priors=[PRIORS.get(s) for s in SOURCES[field]])
        supports = [F.col("supports")[i] for i in range(len(model["sens"]))]
        part = all_claims.where(F.col("field_name") == field).select("group_id", "field_name", "record_id", "value", _posterior(model, supports).alias("posterior"))
        out = part if out is None else out.unionByName(part)
    return out


def judged_members(groups: DataFrame, rounds: DataFrame, sources: DataFrame, articles: DataFrame, rates: DataFrame) -> DataFrame:
    """All claims of all groups, judged; read by the two results below."""
    return judged_claims(cut(claims(groups, rounds, sources, articles, rates)))


def surviving_values(judged: DataFrame) -> DataFrame:
    """(group_id, field_name, record_id, value, posterior): the member that gives the surviving value of each field.

    Of the claims judged true the greatest posterior wins, ties go to the smaller record_id. A field for which no
    claim is judged true has no row; members without a record, repeated memberships and records without round_id,
    company or summary are allowed; empty tables give no row. A group of any size is reduced by partial aggregates.
    """
    fit = judged.where((F.col("posterior") >= TRUE_AT) & F.col("value").isNotNull())
    best = fit.groupBy("group_id", "field_name").agg(F.min_by(F.struct("record_id", "value", "posterior"), F.struct(-F.col("posterior"), F.col("record_id"))).alias("b"))
    return best.select("group_id", "field_name", "b.record_id", "b.value", F.round("b.posterior", 6).alias("posterior"))


def true_values(judged: DataFrame) -> DataFrame:
    """(group_id, field_name, value): every value judged true of the fields that may hold several, one row each."""
    kept = judged.where((F.col("posterior") >= TRUE_AT) & F.col("value").isNotNull() & F.col("field_name").isin(*MULTIPLE))
    return kept.select("group_id", "field_name", "value").distinct()
