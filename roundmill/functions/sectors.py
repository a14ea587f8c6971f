"""Sectors in a fixed vocabulary: exact names, decorated names, labels. Near misses: ``operators.similarity``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sector slugs with their labels.
SECTOR_LABELS = {
    "fintech": "FinTech", "saas": "SaaS", "healthtech": "HealthTech", "edtech": "EdTech", "agritech": "AgriTech",
    "d2c": "D2C", "ecommerce": "E-Commerce", "logistics": "Logistics", "mobility": "Mobility", "climatetech": "ClimateTech",
    "gaming": "Gaming", "ai_ml": "AI/ML", "cybersecurity": "Cybersecurity", "deeptech": "DeepTech", "media": "Media & Content",
    "foodtech": "FoodTech", "proptech": "PropTech", "hrtech": "HRTech", "legaltech": "LegalTech", "retail": "Retail",
    "traveltech": "TravelTech", "spacetech": "SpaceTech", "web3": "Web3", "manufacturing": "Manufacturing", "other": "Other",
}
# Phrases and the sector they mean; of two equally near phrases the first counts.
SECTOR_ALIASES = {
    "fintech": "fintech", "financial technology": "fintech", "financial services": "fintech", "finance": "fintech", "payments": "fintech",
    "payment": "fintech", "lending": "fintech", "credit": "fintech", "banking": "fintech", "neobank": "fintech",
    "insurtech": "fintech", "insurance": "fintech", "wealthtech": "fintech", "investtech": "fintech", "crypto": "fintech",
    "saas": "saas", "software": "saas", "enterprise software": "saas", "b2b saas": "saas", "productivity": "saas",
    "collaboration": "saas", "devtools": "saas", "developer tools": "saas", "no-code": "saas", "low-code": "saas",
    "healthtech": "healthtech", "health tech": "healthtech", "healthcare": "healthtech", "health": "healthtech", "medtech": "healthtech",
    "medical devices": "healthtech", "pharma": "healthtech", "biotech": "healthtech", "biotechnology": "healthtech", "wellness": "healthtech",
    "mental health": "healthtech", "diagnostics": "healthtech", "edtech": "edtech", "education": "edtech", "e-learning": "edtech",
    "learning": "edtech", "upskilling": "edtech", "test prep": "edtech", "agritech": "agritech", "agriculture": "agritech",
    "agri": "agritech", "farming": "agritech", "agtech": "agritech", "d2c": "d2c", "dtc": "d2c",
    "direct-to-consumer": "d2c", "direct to consumer": "d2c", "consumer brand": "d2c", "consumer goods": "d2c", "fmcg": "d2c",
    "beauty": "d2c", "personal care": "d2c", "apparel": "d2c", "ecommerce": "ecommerce", "e-commerce": "ecommerce",
    "marketplace": "ecommerce", "online retail": "ecommerce", "logistics": "logistics", "supply chain": "logistics", "shipping": "logistics",
    "freight": "logistics", "delivery": "logistics", "last-mile": "logistics", "warehousing": "logistics", "mobility": "mobility",
    "electric vehicle": "mobility", "electric vehicles": "mobility", "ev": "mobility", "automotive": "mobility", "ride-hailing": "mobility",
    "transportation": "mobility", "climatetech": "climatetech", "climate tech": "climatetech", "cleantech": "climatetech", "clean tech": "climatetech",
    "renewable energy": "climatetech", "solar": "climatetech", "sustainability": "climatetech", "green energy": "climatetech", "energy": "climatetech",
    "gaming": "gaming", "games": "gaming", "esports": "gaming", "fantasy sports": "gaming", "ai": "ai_ml",
    "ai/ml": "ai_ml", "artificial intelligence": "ai_ml", "machine learning": "ai_ml", "genai": "ai_ml", "generative ai": "ai_ml",
    "llm": "ai_ml", "cybersecurity": "cybersecurity", "cyber security": "cybersecurity", "security": "cybersecurity", "infosec": "cybersecurity",
    "deeptech": "deeptech", "deep tech": "deeptech", "hardware": "deeptech", "robotics": "deeptech", "iot": "deeptech",
    "semiconductor": "deeptech", "semiconductors": "deeptech", "media": "media", "content": "media", "ott": "media",
    "creator economy": "media", "entertainment": "media", "streaming": "media", "social media": "media", "foodtech": "foodtech",
    "food tech": "foodtech", "food": "foodtech", "food delivery": "foodtech", "cloud kitchen": "foodtech", "restaurant tech": "foodtech",
    "beverage": "foodtech", "proptech": "proptech", "real estate": "proptech", "property": "proptech", "housing": "proptech",
    "construction tech": "proptech", "hrtech": "hrtech", "hr tech": "hrtech", "hr": "hrtech", "human resources": "hrtech",
    "recruitment": "hrtech", "hiring": "hrtech", "staffing": "hrtech", "legaltech": "legaltech", "legal tech": "legaltech",
    "legal": "legaltech", "regtech": "legaltech", "compliance": "legaltech", "retail": "retail", "omnichannel retail": "retail",
    "traveltech": "traveltech", "travel tech": "traveltech", "travel": "traveltech", "tourism": "traveltech", "hospitality": "traveltech",
    "spacetech": "spacetech", "space tech": "spacetech", "space": "spacetech", "aerospace": "spacetech", "satellite": "spacetech",
    "defence": "spacetech", "defense": "spacetech", "web3": "web3", "web 3": "web3", "blockchain": "web3",
    "nft": "web3", "manufacturing": "manufacturing", "industrial": "manufacturing", "industry 4.0": "manufacturing",
}
# Words that decorate a sector's name.
DECORATIONS = ("platform", "startup", "company", "industry", "sector", "space")
NEAR = 85  # least token-set score of a near miss


def _map(items: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in items.items() for x in kv])


def plain_sector(raw: Column) -> Column:
    """Trimmed, in lower case; null where nothing is left."""
    return F.nullif(F.lower(F.trim(raw)), F.lit(""))


def exact_sector(raw: Column) -> Column:
    """Slug of a sector named exactly, with or without one decorating word, or by its slug; else null."""
    plain = plain_sector(raw)
    bare = F.trim(F.regexp_replace(plain, rf" ({'|'.join(DECORATIONS)})$", ""))
    known = F.when(plain.isin(*SECTOR_LABELS), plain)
    return F.coalesce(F.try_element_at(_map(SECTOR_ALIASES), plain), F.try_element_at(_map(SECTOR_ALIASES), bare), known)


def sector_label(slug: Column) -> Column:
    """Label of a slug; unknown ones in title case, null and empty as an empty string."""
    return F.when(F.coalesce(slug, F.lit("")) == "", "").otherwise(F.coalesce(F.try_element_at(_map(SECTOR_LABELS), slug), F.initcap(F.regexp_replace(slug, "_", " "))))


def sector_choices() -> str:
    """The slugs in order, as a prompt lists them."""
    return ", ".join(sorted(SECTOR_LABELS))
