"""Table schemas and the fixed vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import types as T


def _of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


#: One schema per table; keys are kept unique by the upserts, references are checked by ``operators.upsert.orphans``.
TABLES: dict[str, str] = {
    "articles": "article_id string, source string, url string, title string, author string, published_at timestamp_ntz, fetched_at timestamp_ntz, text string, html string, enrichment_json string, enrichment_status string",
    "funding_rounds": "round_id string, company_name string, company_json string, stage string, amount double, currency string, amount_usd double, announced_on date, summary string, confidence double, extraction_method string, created_at timestamp_ntz, updated_at timestamp_ntz",
    "round_sources": "round_id string, article_url string",
    "round_investors": "round_id string, name string, lead int",
    "run_log": "run_id string, source string, started_at timestamp_ntz, finished_at timestamp_ntz, articles_seen int, articles_new int, articles_failed int, enriched_ok int, enriched_failed int, schema_drift_flag boolean, error string",
    "schema_baselines": "source string, selector_key string, baseline_hits int, updated_at timestamp_ntz",
    "company_aliases": "alias_norm string, canonical string, created_at timestamp_ntz",
    "investor_aliases": "alias_norm string, canonical string, created_at timestamp_ntz",
}

ENRICHMENT = "company_name string, sector string, stage string, amount double, currency string, amount_usd double, announced_on date, investors array<struct<name:string,lead:boolean>>, location string, summary string, confidence double, extraction_method string"

# Stages with their labels, in the order of a company's life.
STAGE_LABELS = {
    "pre_seed": "Pre-Seed", "seed": "Seed", "pre_series_a": "Pre-Series A", "series_a": "Series A", "series_b": "Series B",
    "series_c": "Series C", "series_d": "Series D", "series_e_plus": "Series E+", "bridge": "Bridge", "debt": "Debt",
    "grant": "Grant", "ipo": "IPO", "acquisition": "Acquisition", "undisclosed": "Undisclosed",
}
# Currencies of the model and dollars per unit; OTHER has no rate.
CURRENCIES = ("USD", "INR", "EUR", "GBP", "OTHER")
USD_PER_UNIT = {"USD": 1.0, "INR": 1 / 83.0, "EUR": 1 / 0.92, "GBP": 1 / 0.79}
MAX_USD = 50e9
# Selectors that each source's pages must hold.
ANCHOR_SELECTORS = {
    "inc42": ["h1.entry-title, h1", "div.entry-content, article .entry-content", 'meta[property="article:published_time"]'],
    "entrackr": ["h1", 'script[type="application/ld+json"]', "div.entry-content, article p"],
    "yourstory": ["h1", 'script[type="application/ld+json"]', "article, main"],
}
# Short names of investors and the names they are listed under.
INVESTOR_ALIASES = {
    "accel": "Accel", "accel partners": "Accel", "accel india": "Accel", "peak xv": "Peak XV Partners", "peak xv partners": "Peak XV Partners",
    "sequoia capital india": "Peak XV Partners", "sequoia india": "Peak XV Partners", "blume": "Blume Ventures", "blume ventures": "Blume Ventures",
    "matrix partners india": "Z47", "matrix partners": "Z47", "z47": "Z47", "elevation capital": "Elevation Capital", "saif partners": "Elevation Capital",
    "3one4 capital": "3one4 Capital", "3one4": "3one4 Capital", "lightspeed india partners": "Lightspeed India", "lightspeed india": "Lightspeed India",
    "lightspeed venture partners": "Lightspeed", "nexus venture partners": "Nexus Venture Partners", "nexus venture": "Nexus Venture Partners",
    "ivycap ventures": "IvyCap Ventures", "ivycap": "IvyCap Ventures", "kalaari capital": "Kalaari Capital", "kalaari": "Kalaari Capital",
    "tiger global": "Tiger Global", "tiger global management": "Tiger Global",
}


def struct_of(name: str) -> T.StructType:
    return _of(TABLES[name])


def empty_tables(spark) -> dict:  # noqa: ANN001
    """Every table, empty and typed; the alias table of investors holds the known short names."""
    tables = {name: spark.createDataFrame([], struct_of(name)) for name in TABLES}
    seeds = [(a, c, None) for a, c in INVESTOR_ALIASES.items()]
    tables["investor_aliases"] = spark.createDataFrame(seeds, struct_of("investor_aliases"))
    return tables
