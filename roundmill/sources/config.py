"""Sources as a table, and the registry of their page readers."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Source:
    """How one site is read: static or rendered pages, scrolls where its list is endless, requests a second."""

    name: str
    base_url: str
    kind: str = "static"
    rate: float = 1.0
    enabled: bool = True
    scrolls: int = 0
    max_pages: int = 1


SCHEMA = "name string, base_url string, kind string, rate double, enabled boolean, scrolls int, max_pages int"


def parse_sources(text: str) -> list[Source]:
    """Sources from a small YAML: ``sources:`` holding one mapping of plain scalars per name. Unknown keys are ignored."""
    out: dict[str, dict] = {}
    here = None
    for line in text.splitlines():
        bare = re.sub(r"\s+#.*$", "", line).rstrip()
        if not bare or bare.lstrip().startswith("#"):
            continue
        depth, part = len(bare) - len(bare.lstrip()), bare.strip()
        key, _, value = part.partition(":")
        value = value.strip().strip("\"'")
        if depth == 2 and not value:
            here = out.setdefault(key.strip(), {})
        elif depth >= 4 and here is not None and value:
            here[key.strip()] = value
    truth = lambda v: v.lower() in ("true", "yes", "on", "1")
    kinds = {"rate": float, "enabled": truth, "scrolls": int, "max_pages": int}
    return [Source(name, **{k: kinds.get(k, str)(v) for k, v in d.items() if k in Source.__dataclass_fields__ and k != "name"}) for name, d in out.items()]


def load_sources(spark: SparkSession, path: str) -> DataFrame:
    rows = [(s.name, s.base_url, s.kind, s.rate, s.enabled, s.scrolls, s.max_pages) for s in parse_sources(Path(path).read_text())]
    return spark.createDataFrame(rows, SCHEMA)


def enabled_sources(sources: DataFrame) -> DataFrame:
    return sources.where("enabled")


Reader = Callable[[DataFrame], DataFrame]
_readers: dict[str, Reader] = {}


def register(name: str, reader: Reader) -> None:
    """A reader turns fetched pages of its source (url, html) into articles."""
    _readers[name] = reader


def reader_of(name: str) -> Reader:
    """KeyError where no reader is registered."""
    return _readers[name]


def fetch_order(urls: DataFrame, partitions: int) -> DataFrame:
    """Addresses placed by host, so that one task keeps to each host's rate."""
    return urls.withColumn("host", F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)).repartition(partitions, "host").sortWithinPartitions("host", "url")


def wait_of(rate: Column) -> Column:
    """Least seconds between two requests."""
    return F.when(rate > 0, 1 / rate).otherwise(F.lit(0.0))
