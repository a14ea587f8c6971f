"""Addresses written in different ways, brought to one form with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that name a visit or a display, not a page.
TRACKING = "utm_[a-z]+|ref|src|source|clickref|output|preview|share|share_id|fbclid|gclid|igshid|mc_cid|mc_eid|cmp|campaign|amp"


def canonical_url(url: Column) -> Column:
    """Host and path in lower case without scheme, port, www., m. or amp., fragment, tracking parameters, doubled or
    trailing slashes, /amp and index.html; escaped signs are decoded, other parameters kept in order.

    Null stays null. What has no host with a dot gives null: it leads to no page.
    """
    u = F.regexp_replace(F.lower(url), r"\s+", "")
    u = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(u, "%2d", "-"), "%5f", "_"), "%2e", "."), "%2f", "/")
    u = F.regexp_replace(F.regexp_replace(u, "%7e", "~"), r"#.*$", "")
    u = F.regexp_replace(u, r"^[a-z]+:/*", "")
    u = F.regexp_replace(u, r"^(?:www\.|m\.|amp\.|mobile\.)+", "")
    host = F.regexp_extract(u, r"^([^/?&:]+)", 1)
    rest = F.regexp_replace(u, r"^[^/?&]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?&]*)", 1), r"/+", "/")
    path = F.regexp_replace(F.regexp_replace(path, r"(?:/amp|/index\.html?)+/*$", ""), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(rest, r"[?&](.*)$", 1), r"(?:/amp)?/*$", "")
    kept = F.array_join(F.array_sort(F.filter(F.split(query, r"[?&]"), lambda p: (p != "") & ~p.rlike(rf"^(?:{TRACKING})(?:=|$)"))), "&")
    full = F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(host.rlike(r"^[a-z0-9-]+(\.[a-z0-9-]+)+$"), full)


def page_number(canonical: Column) -> Column:
    """Host and the page's own number (five digits or more at the end of its path or in its id), which stays when a
    title in the path is revised; null if there is none."""
    number = F.regexp_extract(canonical, r"(\d{5,})(?:\.html?)?(?:$|\?)", 1)
    return F.when(number != "", F.concat_ws("#", F.regexp_extract(canonical, r"^([^/?]+)", 1), number))
