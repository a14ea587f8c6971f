"""Names and texts in normal form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal forms and words dropped from company names anywhere, and from investor names.
COMPANY_SUFFIXES = r"private\s+limited|pvt\.?\s*ltd\.?|limited|ltd\.?|incorporated|inc\.?|corporation|corp\.?|technologies|tech|labs|solutions|india"
INVESTOR_SUFFIXES = r"llp|llc|pvt\.?\s*ltd\.?|private\s+limited|limited|ltd\.?|inc\.?|corp\.?|corporation"


def collapsed(text: Column) -> Column:
    """White space made single spaces and trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize_company(name: Column) -> Column:
    """Lower case without suffix words, punctuation and doubled spaces; a name of suffixes only becomes empty."""
    bare = F.regexp_replace(F.lower(name), rf"(?U)\b({COMPANY_SUFFIXES})\b", " ")
    return collapsed(F.regexp_replace(bare, r"(?U)[^\w\s]", " "))


def normalize_investor(name: Column) -> Column:
    """Lower case without legal forms; ``&``, ``+`` and ``-`` stay."""
    bare = F.regexp_replace(F.lower(name), rf"(?U)\b({INVESTOR_SUFFIXES})\b", " ")
    return collapsed(F.regexp_replace(bare, r"(?U)[^\w\s&+\-]", " "))


def clean_company(name: Column) -> Column:
    """Spaces collapsed, then ``.,;:`` taken off both ends; null where nothing is left."""
    return F.nullif(F.btrim(collapsed(name), F.lit(".,;:")), F.lit(""))
