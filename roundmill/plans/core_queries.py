"""Queries of the core operators over the domain tables, each with the SQL that states the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roundmill.functions import deals, money, payload
from roundmill.functions.text import clean_company, normalize_company, normalize_investor
from roundmill.functions.urls import canonical_url
from roundmill.operators import analytics, dedup, extract, html, monitoring, pages, resolve, upsert, validate
from roundmill.operators.units import convert_units, wrong_dollars
from roundmill.runtime import spread, table
from roundmill.schema import INVESTOR_ALIASES
from roundmill.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}

#: The moment at which the sample's health is judged, and the day that counts as today.
NOW, TODAY = "2026-04-24 00:00:00", "2026-04-24"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _joined(spark: SparkSession, sf_dir: str, min_confidence: float | None = None) -> DataFrame:
    return analytics.joined_rounds(table(spark, sf_dir, "funding_rounds"), table(spark, sf_dir, "round_investors"), table(spark, sf_dir, "round_sources"), min_confidence)


# --- quantities in different units -----------------------------------------------------------------------------------


def _stated_sums_sql() -> str:
    """The stated sums in SQL: the regular expressions there know no look-around, so a mention is matched with its neighbours."""
    currency, scale = "|".join(p for _, p in money.CURRENCY_FORMS), "|".join(p for _, p in money.SCALE_FORMS)
    words = "|".join(sorted(money.NUMBER_WORDS, key=len, reverse=True))
    edge, number = r"(?:[^\p{L}\p{N}]|$)", r"\d[\d,]*(?:\.\d+)?"
    mention = rf"(?i)(?:^|[^\p{{L}}\p{{N}}])(?:({currency})\s*({number})(?:\s*({scale}){edge})?|({number}|(?:{words}))(?:\s*({scale}))?\s+({currency}){edge})"
    case = lambda x, forms, last: "CASE " + " ".join(f"WHEN regexp_full_match({x}, '(?i)(?:{p})') THEN {v!r}" for v, p in forms) + f"{last} END"
    spoken = "CASE lower(n) " + " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in money.NUMBER_WORDS.items()) + r" ELSE TRY_CAST(replace(n, ',', CASE WHEN regexp_full_match(n, '\d+,\d{1,2}') THEN '.' ELSE '' END) AS DOUBLE) END"
    return rf"""WITH s AS (SELECT record_id, amount_usd, ' ' || array_to_string(list_filter(string_split(regexp_replace(regexp_replace(summary, '{money.CUT_MARK}', ''), '([.!?])\s+(\p{{Lu}})', '\1' || chr(1) || '\2', 'g'), chr(1)),
lambda x: NOT regexp_matches(x, '{money.OTHER_SUM}')), ' ') AS t FROM funding_rounds WHERE summary IS NOT NULL),
m AS (SELECT record_id, amount_usd, t, regexp_extract(t, '{mention}', ['c1', 'n1', 's1', 'n2', 's2', 'c2']) AS g, regexp_extract(t, '{mention}', 0) AS whole FROM s),
v AS (SELECT record_id, amount_usd, coalesce(nullif(g.n1, ''), g.n2) AS n, coalesce(nullif(g.s1, ''), g.s2) AS sc, coalesce(nullif(g.c1, ''), g.c2) AS cu FROM m WHERE whole <> '' AND NOT ends_with(trim(t), trim(whole))),
w AS (SELECT record_id, amount_usd, ({spoken}) * ({case("sc", money.SCALE_FORMS, " ELSE 1")}) * usd_per_unit AS usd FROM v JOIN fx_rates f ON f.currency = {case("cu", money.CURRENCY_FORMS, "")})
SELECT record_id, round(usd)::BIGINT AS usd_whole FROM w WHERE usd IS NOT NULL AND (amount_usd IS NULL OR abs(amount_usd - usd) > 0.01 * usd)"""


@query(_stated_sums_sql())
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose stated sum and amount_usd disagree."""
    return wrong_dollars(convert_units(table(spark, sf_dir, "funding_rounds"), table(spark, sf_dir, "fx_rates")))


@query()
def p4_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record's sum in whole dollars, with the unit assigned and its certainty."""
    done = convert_units(table(spark, sf_dir, "funding_rounds"), table(spark, sf_dir, "fx_rates"))
    return done.select("record_id", "unit_currency", "unit_scale", "posterior", "usd_whole", "basis", "uncertain")


# --- export view and aggregates --------------------------------------------------------------------------------------

_LINKS = """
people AS (SELECT round_id, list(DISTINCT name) AS names, min(CASE WHEN lead = 1 THEN name END) AS lead_investor FROM round_investors WHERE name IS NOT NULL GROUP BY round_id),
links AS (SELECT round_id, list(DISTINCT article_url) AS urls FROM round_sources WHERE article_url IS NOT NULL GROUP BY round_id),
joined AS (SELECT f.*, p.names, p.lead_investor, l.urls,
  CASE WHEN json_valid(f.company_json) THEN json_extract_string(f.company_json, '$.sector') END AS sector
  FROM funding_rounds f LEFT JOIN people p USING (round_id) LEFT JOIN links l USING (round_id))
"""
_PEOPLE = "each AS (SELECT unnest(names) AS name, lead_investor, coalesce(amount_usd, 0) AS usd FROM joined WHERE names IS NOT NULL)"
_AGG = "agg AS (SELECT name, count(*)::BIGINT AS deals, (count(*) FILTER (WHERE name = lead_investor))::BIGINT AS leads, sum(usd) AS total FROM each GROUP BY name)"
_PAIRS = """pairs AS (SELECT a.name AS name_a, b.name AS name_b, count(*)::BIGINT AS deals
FROM (SELECT record_id, unnest(names) AS name FROM joined WHERE names IS NOT NULL) a JOIN (SELECT record_id, unnest(names) AS name FROM joined WHERE names IS NOT NULL) b
ON a.record_id = b.record_id AND a.name < b.name GROUP BY ALL HAVING count(*) >= 2)"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


@query(f"WITH {_LINKS}, {_PEOPLE}, {_AGG} SELECT name, deals, leads, round(total, 2) AS total_usd FROM agg")
def investor_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.investor_agg(_joined(spark, sf_dir)), "total_usd")


@query(f"WITH {_LINKS}, {_PEOPLE}, {_AGG} SELECT name, deals, leads FROM agg ORDER BY deals DESC, total DESC, name LIMIT 25")
def top_investors_25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k report of investors by deals, then money."""
    return analytics.investor_agg(_joined(spark, sf_dir)).orderBy(F.desc("deals"), F.desc("total_usd"), "name").limit(25).select("name", "deals", "leads")


@query(f"WITH {_LINKS}, {_PAIRS} SELECT * FROM pairs")
def co_investment_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.co_investments(_joined(spark, sf_dir))


@query(
    f"WITH {_LINKS}, {_PEOPLE}, {_AGG}, {_PAIRS} SELECT (SELECT count(*) FROM agg)::BIGINT AS unique_investors, (SELECT name FROM agg ORDER BY deals DESC, name LIMIT 1) AS most_active, (SELECT count(*) FROM agg WHERE leads > 0)::BIGINT AS with_leads, (SELECT count(*) FROM pairs)::BIGINT AS pairs"
)
def investor_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.investor_kpis(_joined(spark, sf_dir))


_STAGE = "CASE " + " ".join(f"WHEN st = '{k}' THEN '{v}'" for k, v in deals.STAGE_LABELS.items()) + " ELSE '' END"
_USD = "CASE WHEN amount_usd <= 0 THEN NULL WHEN amount_usd < 1000 THEN amount_usd * 1e6 ELSE amount_usd END"


@query(
    f"""WITH {_LINKS}, base AS (SELECT *, nullif(lower(trim(stage)), '') AS st FROM joined WHERE confidence >= 0.35)
SELECT record_id, coalesce(company_name, '') AS company_name, {_STAGE} AS stage, round({_USD}, 2) AS amount_usd,
coalesce(strftime(announced_on, '%Y-%m-%d'), '') AS announced_on, coalesce(lead_investor, '') AS lead_investor,
coalesce(array_to_string(list_sort(names), ' | '), '') AS investors, coalesce(array_to_string(list_sort(urls), ' | '), '') AS sources,
coalesce(round(confidence, 3), 0) AS confidence, coalesce(summary, '') AS summary FROM base"""
)
def export_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The public export of deals that are certain enough."""
    rows = analytics.public_rows(_joined(spark, sf_dir, 0.35), "record_id")
    return rows.select("record_id", "company_name", "stage", "amount_usd", "announced_on", "lead_investor", F.array_join("investors", " | ").alias("investors"), F.array_join("sources", " | ").alias("sources"), "confidence", "summary")


_FMT_USD = """CASE WHEN u IS NULL THEN '' WHEN u >= 1e9 THEN '$' || printf('%.1f', round(u / 1e9, 1)) || 'B'
WHEN u >= 1e6 THEN replace('$' || printf('%.1f', round(u / 1e6, 1)) || 'M', '.0M', 'M') WHEN u >= 1e3 THEN '$' || printf('%.0f', round(u / 1e3)) || 'K' ELSE '$' || printf('%.0f', round(u)) END"""


@query(f"SELECT record_id, {_FMT_USD} AS shown_usd FROM (SELECT record_id, {_USD} AS u FROM funding_rounds)")
def format_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "funding_rounds").select("record_id", deals.format_usd(deals.whole_dollars(F.col("amount_usd"))).alias("shown_usd"))


@query()
def format_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums in display form, native currency first, stages and certainty bands."""
    f = table(spark, sf_dir, "funding_rounds")
    return f.select("record_id", deals.format_amount(F.col("amount_usd"), F.col("amount"), F.col("currency")).alias("amount"), deals.short_usd(F.col("amount_usd")).alias("short"), deals.format_stage(F.col("stage")).alias("stage"), deals.confidence_band(F.col("confidence")).alias("band"))


@query(
    """WITH base AS (SELECT *, nullif(trim(CASE WHEN json_valid(company_json) THEN json_extract_string(company_json, '$.sector') END), '') AS sector FROM funding_rounds WHERE company_name IS NOT NULL)
SELECT company_name, count(*)::BIGINT AS n_rounds, round(sum(coalesce(amount_usd, 0)), 2) AS total_usd, arg_min(sector, record_id) FILTER (WHERE sector IS NOT NULL) AS sector FROM base GROUP BY company_name"""
)
def company_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.company_rollup(table(spark, sf_dir, "funding_rounds")), "total_usd")


@query(
    """SELECT company_name, (row_number() OVER (PARTITION BY company_name ORDER BY announced_on ASC NULLS FIRST, record_id))::INTEGER AS place, record_id, coalesce(strftime(announced_on, '%Y-%m-%d'), '') AS day, stage, amount_usd, confidence
FROM funding_rounds WHERE company_name IS NOT NULL"""
)
def company_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.company_timeline(table(spark, sf_dir, "funding_rounds"))


@query(
    """SELECT round(sum(coalesce(amount_usd, 0)), 2) AS total_usd, count(*)::BIGINT AS n_rounds, round(avg(amount_usd) FILTER (WHERE amount_usd <> 0), 2) AS mean_disclosed,
(SELECT stage FROM funding_rounds WHERE stage IS NOT NULL GROUP BY stage ORDER BY count(*) DESC, stage LIMIT 1) AS top_stage FROM funding_rounds"""
)
def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.kpis(table(spark, sf_dir, "funding_rounds")), "total_usd", "mean_disclosed")


@query(
    f"""WITH {_LINKS}, base AS (SELECT *, nullif(round({_USD}, 2), 0) AS usd FROM joined)
SELECT count(*)::BIGINT AS total_rounds, round(coalesce(sum(usd), 0), 2) AS total_usd, coalesce(max(usd), 0) AS max_amount_usd,
array_to_string(list_sort(list(DISTINCT nullif(lower(trim(stage)), '')) FILTER (WHERE nullif(trim(stage), '') IS NOT NULL)), ',') AS stages_present,
count(DISTINCT nullif(lower(trim(sector)), ''))::BIGINT AS sectors_present, count(DISTINCT coalesce(company_name, ''))::BIGINT AS unique_companies,
(SELECT count(DISTINCT n) FROM (SELECT unnest(names) AS n FROM joined))::BIGINT AS unique_investors FROM base"""
)
def dashboard_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.dashboard_meta(_joined(spark, sf_dir)), "total_usd")


@query("SELECT strftime(announced_on, '%Y-%m') AS month, round(sum(coalesce(amount_usd, 0)), 2) AS total_usd, count(*)::BIGINT AS n_rounds FROM funding_rounds WHERE announced_on IS NOT NULL GROUP BY ALL")
def monthly_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.monthly_timeline(table(spark, sf_dir, "funding_rounds")), "total_usd")


_PLACE = "CASE " + " ".join(f"WHEN stage = '{k}' THEN {i}" for i, k in enumerate(deals.STAGE_LABELS)) + " END"


@query(f"SELECT stage, count(*)::BIGINT AS n_rounds, ({_PLACE})::INTEGER AS place FROM funding_rounds WHERE ({_PLACE}) IS NOT NULL GROUP BY stage")
def stage_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.stage_distribution(table(spark, sf_dir, "funding_rounds"))


@query(f"WITH {_LINKS} SELECT nullif(trim(sector), '') AS sector, round(sum(coalesce(amount_usd, 0)), 2) AS total_usd FROM joined WHERE nullif(trim(sector), '') IS NOT NULL GROUP BY 1 ORDER BY sum(coalesce(amount_usd, 0)) DESC, 1 LIMIT 10")
def top_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k report of sectors by money."""
    return _rounded(analytics.top_sectors(_joined(spark, sf_dir)), "total_usd")


@query(
    f"""WITH {_LINKS}, base AS (SELECT strftime(announced_on, '%Y-%m') AS month, coalesce(nullif(trim(sector), ''), 'Unknown') AS sector FROM joined WHERE announced_on IS NOT NULL),
top AS (SELECT sector FROM base GROUP BY sector ORDER BY count(*) DESC, sector LIMIT 8), mixed AS (SELECT month, CASE WHEN sector IN (SELECT sector FROM top) THEN sector ELSE 'Other' END AS sector FROM base)
SELECT m.month, s.sector, (SELECT count(*) FROM mixed x WHERE x.month = m.month AND x.sector = s.sector)::BIGINT AS n_rounds FROM (SELECT DISTINCT month FROM mixed) m, (SELECT DISTINCT sector FROM mixed) s"""
)
def sector_mix_top8_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.sector_mix(_joined(spark, sf_dir))


_BUCKETS = " UNION ALL ".join(f"SELECT {i}::INTEGER AS place, '{label}' AS bucket, {low} AS low, {high if high is not None else 1e300} AS high" for i, (low, high, label) in enumerate(analytics.BUCKETS))


@query(f"SELECT b.place, b.bucket, count(f.record_id)::BIGINT AS n_rounds FROM ({_BUCKETS}) b LEFT JOIN funding_rounds f ON f.amount_usd >= b.low AND f.amount_usd < b.high AND f.amount_usd <> 0 GROUP BY ALL")
def amount_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.amount_histogram(table(spark, sf_dir, "funding_rounds"))


_FILTER = f"""WITH {_LINKS}, base AS (SELECT record_id, coalesce(strftime(announced_on, '%Y-%m-%d'), '') AS announced_on, nullif(lower(trim(stage)), '') AS stage_raw, coalesce(round(confidence, 3), 0) AS confidence,
round({_USD}, 2) AS amount_usd, coalesce(company_name, '') AS company_name FROM joined)
SELECT record_id, company_name, announced_on, confidence, amount_usd FROM base WHERE (announced_on = '' OR (announced_on >= '2025-01-01' AND announced_on <= '2025-12-31'))
AND stage_raw IN ('seed', 'series_a', 'series_b') AND confidence >= 0.5 AND coalesce(amount_usd, 0) >= 1e6"""


def _some_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = analytics.public_rows(_joined(spark, sf_dir), "record_id")
    return analytics.filtered(rows, since="2025-01-01", until="2025-12-31", stages=("seed", "series_a", "series_b"), min_confidence=0.5, min_usd=1e6).select("record_id", "company_name", "announced_on", "confidence", "amount_usd")


@query(_FILTER)
def filtered_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _some_rounds(spark, sf_dir)


@query(f"{_FILTER} ORDER BY confidence DESC, announced_on DESC, record_id LIMIT 25 OFFSET 25")
def round_page_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of the filtered deals: a page is the feature."""
    return analytics.page(_some_rounds(spark, sf_dir), 2, order=[F.desc("confidence"), F.desc("announced_on"), F.asc("record_id")])


@query(f"SELECT greatest(1, ceil(count(*) / 25.0))::BIGINT AS pages FROM ({_FILTER})")
def round_page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.page_count(_some_rounds(spark, sf_dir))


@query("SELECT (SELECT count(*) FROM funding_rounds)::BIGINT AS rounds, (SELECT count(DISTINCT name) FROM round_investors WHERE name IS NOT NULL)::BIGINT AS investors, (SELECT count(DISTINCT company_name) FROM funding_rounds)::BIGINT AS companies")
def tab_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = table(spark, sf_dir, "funding_rounds").agg(F.count("*").alias("rounds"), F.countDistinct("company_name").alias("companies"))
    people = table(spark, sf_dir, "round_investors").agg(F.countDistinct("name").alias("investors"))
    return rounds.join(people).select("rounds", "investors", "companies")


@query(
    """SELECT record_id, (row_number() OVER w)::INTEGER AS step, (announced_on - lag(announced_on) OVER w)::BIGINT AS days_since, round(sum(coalesce(amount_usd, 0)) OVER (PARTITION BY company_name ORDER BY announced_on, record_id ROWS UNBOUNDED PRECEDING), 2) AS running_usd
FROM funding_rounds WHERE company_name IS NOT NULL AND announced_on IS NOT NULL WINDOW w AS (PARTITION BY company_name ORDER BY announced_on, record_id)"""
)
def round_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analytics.round_steps(table(spark, sf_dir, "funding_rounds")), "running_usd")


# --- sinks -----------------------------------------------------------------------------------------------------------


@query()
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the CSV export as text."""
    return sinks.csv_rows(analytics.public_rows(_joined(spark, sf_dir)))


@query()
def sheet_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.sheet_widths(analytics.public_rows(_joined(spark, sf_dir)))


@query("SELECT record_id, CASE WHEN confidence < 0.35 THEN 'red' WHEN confidence >= 0.85 THEN 'green' ELSE 'none' END AS shade FROM funding_rounds")
def confidence_shades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "funding_rounds").select("record_id", sinks.shade(F.col("confidence")).alias("shade"))


# --- monitoring ------------------------------------------------------------------------------------------------------


@query(
    f"""WITH m AS (SELECT *, coalesce(articles_seen, 0) AS seen, (error IS NULL AND coalesce(articles_seen, 0) > 0) AS ok FROM run_log WHERE started_at >= TIMESTAMP '{NOW}' - INTERVAL 30 DAY),
g AS (SELECT *, sum(ok::INT) OVER (PARTITION BY source ORDER BY started_at DESC, run_id DESC) AS good FROM m),
h AS (SELECT source, count(*)::BIGINT AS runs, count(error)::BIGINT AS errors, (count(*) FILTER (WHERE seen = 0))::BIGINT AS zero_runs, round(avg(seen), 1) AS mean_seen, (count(*) FILTER (WHERE good = 0))::BIGINT AS streak,
max(started_at) FILTER (WHERE ok) AS last_success, arg_max(coalesce(schema_drift_flag, false), (started_at, run_id)) AS drift FROM g GROUP BY source)
SELECT *, CASE WHEN streak >= 3 THEN 'CRITICAL' WHEN drift THEN 'DRIFT' WHEN zero_runs >= 2 THEN 'STALE' WHEN errors > 0 THEN 'WARN' ELSE 'OK' END AS status FROM h"""
)
def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.source_health(table(spark, sf_dir, "run_log"), F.lit(NOW).cast("timestamp_ntz"), 30)


@query(
    "SELECT source, count(*)::BIGINT AS runs, sum(coalesce(articles_seen, 0))::BIGINT AS articles_seen, sum(coalesce(articles_new, 0))::BIGINT AS articles_new, sum(coalesce(articles_failed, 0))::BIGINT AS articles_failed, sum(coalesce(enriched_ok, 0))::BIGINT AS enriched_ok, sum(coalesce(enriched_failed, 0))::BIGINT AS enriched_failed FROM run_log GROUP BY source"
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.run_totals(table(spark, sf_dir, "run_log"))


SELECTORS = ["h1", "h2", "figcaption", "blockquote", 'meta[property="og:title"]', "main h1, article h1"]


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = spread(table(spark, sf_dir, "articles", "fetch_id", "source", "html", "batch_no").where("html is not null")).withColumn("m", html.selector_hits(SELECTORS)("html"))
    return counted.select("fetch_id", "source", "batch_no", F.explode("m").alias("selector_key", "hits"))


_COUNT = lambda tag: f"len(regexp_extract_all(html, '<{tag}[ >]'))::INTEGER"


@query(" UNION ALL ".join(f"SELECT fetch_id, '{t}' AS selector_key, {_COUNT(t)} AS hits FROM articles WHERE html IS NOT NULL" for t in SELECTORS[:4]))
def selector_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir).where(F.col("selector_key").isin(*SELECTORS[:4])).select("fetch_id", "selector_key", "hits")


@query()
def drift_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selectors that every page of a source had in its history and some later page lacks."""
    hits = _hits(spark, sf_dir)
    old = hits.where("batch_no = 0").groupBy("source", "selector_key").agg(F.min("hits").alias("baseline_hits"))
    return monitoring.drifted(old, hits.where("batch_no > 0").select("source", "selector_key", "hits"))


# --- upserts and audits ----------------------------------------------------------------------------------------------


@query("SELECT fetch_id, source, enrichment_status FROM articles WHERE enrichment_status IN ('pending', 'failed') ORDER BY fetched_at DESC, fetch_id LIMIT 100")
def pending_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next hundred pages to enrich: the size of the queue is the feature."""
    return upsert.pending_articles(table(spark, sf_dir, "articles", "fetch_id", "source", "enrichment_status", "fetched_at")).select("fetch_id", "source", "enrichment_status")


@query(
    """WITH n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched_at DESC, fetch_id DESC) AS r FROM articles WHERE batch_no > 0) WHERE r = 1),
o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched_at DESC, fetch_id DESC) AS r FROM articles WHERE batch_no = 0) WHERE r = 1)
SELECT coalesce(n.url, o.url) AS url, coalesce(n.fetch_id, o.fetch_id) AS fetch_id, CASE WHEN n.url IS NOT NULL THEN n.title ELSE o.title END AS title, CASE WHEN o.url IS NOT NULL THEN o.enrichment_status ELSE n.enrichment_status END AS enrichment_status FROM o FULL JOIN n ON o.url = n.url"""
)
def upsert_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History as the table, later batches as the new rows."""
    columns = ["url", "fetch_id", "title", "fetched_at", "enrichment_status"]
    every = table(spark, sf_dir, "articles", *columns, "batch_no")
    last = every.withColumn("r", F.row_number().over(Window.partitionBy("url", F.col("batch_no") == 0).orderBy(F.desc("fetched_at"), F.desc("fetch_id")))).where("r = 1")
    done = upsert.upsert(last.where("batch_no = 0").select(*columns), last.where("batch_no > 0").select(*columns), ["url"], keep=("enrichment_status",), order="fetched_at")
    return done.select("url", "fetch_id", "title", "enrichment_status")


@query(
    """SELECT round_id, arg_min_null(company_name, record_id) AS company_name, arg_max_null(stage, record_id) AS stage, arg_max_null(amount_usd, record_id) AS amount_usd, arg_max_null(summary, record_id) AS summary,
max(confidence) AS confidence, arg_min_null(created_at, record_id) AS created_at FROM funding_rounds WHERE round_id IS NOT NULL GROUP BY round_id"""
)
def merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later batches merged into the history by id, in order of record."""
    columns = ["round_id", "record_id", "company_name", "stage", "amount_usd", "summary", "confidence", "created_at"]
    every = table(spark, sf_dir, "funding_rounds", *columns, "batch_no")
    return upsert.merge_rounds(every.where("batch_no = 0").select(*columns), every.where("batch_no > 0").select(*columns), "record_id")


@query(
    """WITH s AS (SELECT i.*, i.round_id IN (SELECT round_id FROM funding_rounds WHERE batch_no = 0 AND round_id IS NOT NULL) AS old FROM round_investors i WHERE i.round_id IS NOT NULL AND i.name IS NOT NULL),
o AS (SELECT DISTINCT round_id, name FROM s WHERE old) SELECT round_id, name FROM o UNION SELECT round_id, name FROM s"""
)
def insert_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of later deals added to those of the history."""
    known = table(spark, sf_dir, "funding_rounds", "round_id", "batch_no").where("batch_no = 0 and round_id is not null").select("round_id").distinct()
    links = table(spark, sf_dir, "round_investors", "round_id", "name").where("round_id is not null and name is not null")
    return upsert.insert_links(links.join(known, "round_id", "left_semi").distinct(), links.join(known, "round_id", "left_anti"), ["round_id", "name"])


@query("SELECT DISTINCT s.round_id, s.article_url FROM round_sources s WHERE s.article_url IS NULL OR s.article_url NOT IN (SELECT url FROM articles WHERE url IS NOT NULL)")
def orphan_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to pages that aren't held under the very same address."""
    return upsert.orphans(table(spark, sf_dir, "round_sources"), table(spark, sf_dir, "articles", "url"), "article_url", "url").select("round_id", "article_url").distinct()


@query("SELECT fetch_id FROM articles a WHERE batch_no > 0 AND NOT EXISTS (SELECT 1 FROM articles o WHERE o.batch_no = 0 AND o.url = a.url)")
def new_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = table(spark, sf_dir, "articles", "fetch_id", "url", "batch_no")
    return upsert.unknown_only(every.where("batch_no > 0"), every.where("batch_no = 0"), "url").select("fetch_id")


# --- extraction, validation ------------------------------------------------------------------------------------------

_W = r"[\p{L}\p{N}_&.\-]*"
_TEXT = "coalesce(text, '') || chr(10) || coalesce(title, '')"
_UNIT = lambda u: f"CASE WHEN lower({u}) IN ('mn','m','million') THEN 1e6 WHEN lower({u}) IN ('bn','b','billion') THEN 1e9 WHEN lower({u}) IN ('cr','crore','crores') THEN 1e7 WHEN lower({u}) IN ('lakh','lakhs','lac','lacs') THEN 1e5 ELSE 1 END"
_X = lambda p, g: f"nullif(regexp_extract(b, '{p}', {g}), '')"
_SIGN, _WORD = r"(?i)\$\s*(\d+(?:\.\d+)?)\s*(mn|m|million|bn|b|billion)\b", r"(?i)\bUSD\s*(\d+(?:\.\d+)?)\s*(mn|m|million|bn|b|billion)?"
_INR = r"(?i)(?:₹|Rs\.?|INR)\s*(\d+(?:[.,]\d+)?)\s*(cr|crore|crores|lakh|lakhs|lac|lacs|mn|million|bn|billion)\b"
_STAGES = "CASE " + " ".join(f"WHEN regexp_matches(b, '{p}') THEN '{s}'" for s, p in deals.STAGE_PATTERNS) + " ELSE 'undisclosed' END"
_HEAD = r"^\s*([\p{Lu}\p{Nd}]\S*(?:\s+[\p{Lu}\p{Nd}]\S*){0,4})"


@query(
    rf"""WITH t AS (SELECT fetch_id, {_TEXT} AS b, coalesce(title, '') AS title FROM articles),
x AS (SELECT fetch_id, title, b, {_X(_SIGN, 1)}::DOUBLE * ({_UNIT(_X(_SIGN, 2))}) AS s, {_X(_WORD, 1)}::DOUBLE * ({_UNIT(f"coalesce({_X(_WORD, 2)}, 'million')")}) AS w, replace({_X(_INR, 1)}, ',', '')::DOUBLE * ({_UNIT(_X(_INR, 2))}) AS i FROM t)
SELECT fetch_id, coalesce(s, w, i) AS amount, CASE WHEN coalesce(s, w) IS NOT NULL THEN 'USD' WHEN i IS NOT NULL THEN 'INR' END AS currency, round(coalesce(s, w, round(i / 83.0, 2)), 2) AS amount_usd, {_STAGES} AS stage,
coalesce(nullif(trim(regexp_extract(title, '(?i)^\s*([A-Z]{_W}(?:\s+[A-Z]{_W}){{0,4}})\s+(?:raises|raised|bags|secures|secured|mops[-\s]up|closes|closed|nets)\b', 1)), ''), nullif(regexp_replace(regexp_extract(title, '{_HEAD}', 1), '\s+', ' ', 'g'), '')) AS company_name FROM x"""
)
def pattern_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum, stage and company of every page by patterns."""
    a = spread(table(spark, sf_dir, "articles", "fetch_id", "title", "text", "published_at")).withColumn("x", extract.pattern_extract(F.col("title"), F.col("text"), F.col("published_at")))
    return a.select("fetch_id", "x.amount", "x.currency", F.round("x.amount_usd", 2).alias("amount_usd"), "x.stage", "x.company_name")


@query()
def enrich_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded answers of a model, sanitised; merged with the patterns where unsure, the patterns alone where none."""
    a = table(spark, sf_dir, "articles", "fetch_id", "title", "text", "published_at", "enrichment_json").withColumn("article_id", F.col("fetch_id").cast("string"))
    done = extract.enrich(a, a.select("article_id", F.col("enrichment_json").alias("raw")))
    return done.select("article_id", "status", "result.company_name", "result.stage", "result.amount_usd", F.size("result.investors").alias("n_investors"), F.round("result.confidence", 4).alias("confidence"), "result.extraction_method")


@query(
    """WITH j AS (SELECT fetch_id, CASE WHEN json_valid(enrichment_json) THEN enrichment_json END AS j FROM articles)
SELECT fetch_id, nullif(nullif(json_extract_string(j, '$.company_name'), ''), 'null') AS company_name,
CASE WHEN j IS NOT NULL THEN coalesce(greatest(0, least(1, TRY_CAST(json_extract_string(j, '$.confidence') AS DOUBLE))), 0) END AS confidence,
CASE WHEN j IS NOT NULL THEN coalesce(json_array_length(j, '$.investors'), 0)::INTEGER END AS n_investors FROM j"""
)
def payload_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "articles", "fetch_id", "enrichment_json").withColumn("s", payload.sanitize_payload(payload.coerce_json(F.col("enrichment_json"))))
    return s.select("fetch_id", "s.company_name", "s.confidence", F.size("s.investors").alias("n_investors"))


_RULES = """array_to_string(list_filter([CASE WHEN amount < 0 THEN 'negative_amount' END, CASE WHEN amount_usd > 50e9 THEN 'too_many_dollars' END, CASE WHEN announced_on > DATE '2026-04-24' THEN 'future_day' END,
CASE WHEN stage NOT IN ({stages}) THEN 'unknown_stage' END, CASE WHEN currency NOT IN ('USD','INR','EUR','GBP','OTHER') THEN 'unknown_currency' END, CASE WHEN confidence < 0 OR confidence > 1 THEN 'confidence_range' END], lambda x: x IS NOT NULL), ',')""".format(
    stages=", ".join(f"'{s}'" for s in deals.STAGE_LABELS)
)


@query(f"SELECT record_id, {_RULES} AS reasons FROM funding_rounds")
def validate_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with the rules that it breaks."""
    f = table(spark, sf_dir, "funding_rounds")
    good, bad = validate.split_valid(f, F.lit(TODAY).cast("date"))
    return good.select("record_id", F.lit("").alias("reasons")).unionByName(bad.select("record_id", F.array_join("reasons", ",").alias("reasons")))


_FX = "CASE currency WHEN 'USD' THEN 1.0::DOUBLE WHEN 'INR' THEN 1/83.0::DOUBLE WHEN 'EUR' THEN 1/0.92::DOUBLE WHEN 'GBP' THEN 1/0.79::DOUBLE END"


@query(f"SELECT record_id, coalesce(amount_usd, round(amount * ({_FX}), 2)) AS amount_usd FROM funding_rounds")
def fx_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "funding_rounds").select("record_id", deals.with_dollars(F.col("amount"), F.col("currency"), F.col("amount_usd")).alias("amount_usd"))


@query(
    "SELECT record_id, substr(sha256(lower(trim(coalesce(company_name, ''))) || '|' || coalesce(strftime(announced_on, '%Y-%m-%d'), '') || '|' || coalesce(printf('%.2f', amount_usd), '')), 1, 16) AS made_id FROM funding_rounds"
)
def round_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "funding_rounds").select("record_id", deals.round_id(F.col("company_name"), F.col("announced_on"), F.col("amount_usd")).alias("made_id"))


@query("SELECT fetch_id, substr(sha256(url), 1, 16) AS article_id FROM articles")
def article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "articles", "fetch_id", "url").select("fetch_id", deals.article_id(F.col("url")).alias("article_id"))


@query()
def build_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deals built from what the patterns read on every page."""
    a = spread(table(spark, sf_dir, "articles", "fetch_id", "title", "text", "published_at")).withColumn("x", extract.pattern_extract(F.col("title"), F.col("text"), F.col("published_at")))
    built = validate.build_rounds(a.select("fetch_id", "x.*", F.to_date("published_at").alias("published_on")))
    return built.select("fetch_id", "round_id", "company_name", "stage", "amount_usd", "announced_on", F.size("investors").alias("n_investors"))


# --- names and duplicates --------------------------------------------------------------------------------------------

_CO = r"(?i)\b(private\s+limited|pvt\.?\s*ltd\.?|limited|ltd\.?|incorporated|inc\.?|corporation|corp\.?|technologies|tech|labs|solutions|india)\b"
_NORM = lambda c, p, keep: rf"trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '{p}', ' ', 'g'), '[^\p{{L}}\p{{N}}\p{{M}}_\s{keep}]', ' ', 'g'), '\s+', ' ', 'g'))"


@query(rf"SELECT DISTINCT company_name, {_NORM('company_name', _CO, '')} AS norm, nullif(trim(trim(regexp_replace(company_name, '\s+', ' ', 'g')), '.,;:'), '') AS clean FROM funding_rounds WHERE company_name IS NOT NULL")
def normalize_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "funding_rounds", "company_name").where("company_name is not null").distinct()
    return f.select("company_name", normalize_company(F.col("company_name")).alias("norm"), clean_company(F.col("company_name")).alias("clean"))


_IN = r"(?i)\b(llp|llc|pvt\.?\s*ltd\.?|private\s+limited|limited|ltd\.?|inc\.?|corp\.?|corporation)\b"


@query(rf"SELECT DISTINCT name, {_NORM('name', _IN, '&+-')} AS norm FROM round_investors WHERE name IS NOT NULL")
def normalize_investors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "round_investors", "name").where("name is not null").distinct().select("name", normalize_investor(F.col("name")).alias("norm"))


@query(
    rf"""WITH n AS (SELECT record_id AS id, {_NORM('company_name', _CO, '')} AS name, announced_on AS d, amount_usd AS u, batch_no FROM funding_rounds)
SELECT DISTINCT a.id AS new_id, b.id AS old_id FROM n a JOIN n b ON a.name = b.name AND a.name <> '' WHERE a.batch_no > 0 AND b.batch_no = 0
AND (a.d IS NULL OR b.d IS NULL OR abs(a.d - b.d) <= 3) AND (a.u IS NULL OR b.u IS NULL OR abs(a.u - b.u) <= 0.15 * greatest(a.u, b.u))"""
)
def band_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later deals and those of the history with one normal name, close days and sums."""
    f = table(spark, sf_dir, "funding_rounds", "record_id", "company_name", "announced_on", "amount_usd", "batch_no").select(F.col("record_id").alias("id"), normalize_company(F.col("company_name")).alias("name"), "announced_on", "amount_usd", "batch_no").where("name <> ''")
    return dedup.band_pairs(f.where("batch_no > 0"), f.where("batch_no = 0"))


@query()
def fuzzy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each later deal the deal of the history that it repeats, names alike by token sets."""
    f = table(spark, sf_dir, "funding_rounds", "record_id", "company_name", "announced_on", "amount_usd", "batch_no")
    found = dedup.existing_rounds(dedup.rounds_side(f.where("batch_no > 0")), dedup.rounds_side(f.where("batch_no = 0")))
    return found.select("new_id", "old_id", F.round("score", 4).alias("score"))


@query()
def resolve_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical name of each company of the later batches, from the names of the history."""
    f = table(spark, sf_dir, "funding_rounds", "record_id", "company_name", "batch_no").where("company_name is not null")
    known = f.where("batch_no = 0").groupBy(F.col("company_name").alias("name")).agg(F.min("record_id").alias("ordinal"))
    none = spark.createDataFrame([], "alias_norm string, canonical string")
    return resolve.resolve_companies(f.where("batch_no > 0").select(F.col("company_name").alias("name")), known, none)


_ALIASES = ", ".join(f"('{a}', '{c}')" for a, c in INVESTOR_ALIASES.items())


@query(
    rf"""WITH n AS (SELECT DISTINCT i.name, {_NORM('i.name', _IN, '&+-')} AS norm FROM round_investors i WHERE i.name IS NOT NULL), a(norm, canonical) AS (VALUES {_ALIASES}),
f AS (SELECT norm, min(name) AS first FROM n WHERE norm <> '' GROUP BY norm) SELECT n.name, coalesce(a.canonical, f.first, n.name) AS canonical FROM n LEFT JOIN a USING (norm) LEFT JOIN f USING (norm)"""
)
def resolve_investors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical name of each investor: known aliases, else the first name of the same form."""
    names = table(spark, sf_dir, "round_investors", "name").where("name is not null").distinct()
    aliases = spark.createDataFrame(list(INVESTOR_ALIASES.items()), "alias_norm string, canonical string")
    return resolve.resolve_investors(names, names.withColumn("ordinal", F.col("name")), aliases).select("name", "canonical")


@query()
def normalize_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slug of each sector as typed, near misses included."""
    raw = table(spark, sf_dir, "sample_rounds", "sector").select(F.col("sector").alias("raw")).distinct()
    return resolve.normalize_sectors(raw)


@query()
def backfill_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of carrying sectors from pages to deals."""
    done = resolve.backfill_sectors(table(spark, sf_dir, "funding_rounds", "round_id", "company_json"), table(spark, sf_dir, "round_sources"), table(spark, sf_dir, "articles", "url", "enrichment_json"))
    return done.groupBy("outcome").agg(F.count("*").alias("n_rounds"))


# --- pages -----------------------------------------------------------------------------------------------------------


@query()
def page_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, day, author and text read from every page."""
    a = spread(table(spark, sf_dir, "articles", "fetch_id", "html").where("html is not null")).withColumn("d", html.detail("html"))
    return a.select("fetch_id", "d.title", deals.calendar_day(F.col("d.published")).alias("day"), "d.author", F.length("d.text").alias("n_chars"))


@query()
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every page, absolute, each once in order."""
    a = spread(table(spark, sf_dir, "articles", "fetch_id", "url", "html").where("html is not null")).withColumnRenamed("fetch_id", "page_id")
    return pages.candidate_links(a, F.lit(True))


@query()
def link_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.link_census(spread(table(spark, sf_dir, "articles", "html").where("html is not null")))


@query(
    "SELECT fetch_id, regexp_matches(lower(url), 'funding|raises|raise|raised|bags|secures|series-a|series-b|series-c|series-d|seed|pre-seed|investment|investor|mn|million|crore|round|backs|led-by|acquires|acquisition|ipo|venture|capital') AS about_funding, len(list_filter(string_split(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]+', ''), '[?#].*$', ''), '/'), lambda p: p <> ''))::INTEGER AS depth FROM articles"
)
def url_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "articles", "fetch_id", "url")
    return a.select("fetch_id", pages.about_funding(F.col("url")).alias("about_funding"), pages.path_depth(F.col("url")).alias("depth"))


@query()
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "articles", "fetch_id", "url").select("fetch_id", canonical_url(F.col("url")).alias("canonical"))
