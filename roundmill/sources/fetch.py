"""A Spark data source of web pages: ``spark.read.format("roundmill_pages").option("urls", ...)``.

One partition per host keeps to the rate of that host; timeouts and broken connections are tried again, at most five
times with growing waits; a status of 400 or more ends in the row's status without a page.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, status int, html string, final_url string, error string"
ATTEMPTS, LONGEST_WAIT = 5, 30.0


class Host(InputPartition):
    def __init__(self, urls: list[str]) -> None:
        self.urls = urls


def fetch(url: str, timeout: float, attempts: int = ATTEMPTS, first_wait: float = 1.0) -> tuple:
    wait = first_wait
    for attempt in range(attempts):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as answer:  # noqa: S310
                return url, getattr(answer, "status", 200) or 200, answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace"), answer.geturl(), None
        except urllib.error.HTTPError as e:
            return url, e.code, None, url, str(e)
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            if attempt + 1 == attempts:
                return url, None, None, url, str(e)
            time.sleep(wait)
            wait = min(LONGEST_WAIT, 2 * wait)
    return url, None, None, url, "not tried"


class PageReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.rate, self.timeout = float(options.get("rate", 1.0)), float(options.get("timeout", 30))

    def partitions(self) -> list[InputPartition]:
        hosts = defaultdict(list)
        for u in self.urls:
            hosts[urlsplit(u).netloc].append(u)
        return [Host(urls) for urls in hosts.values()] or [Host([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        last = 0.0
        for url in partition.urls:
            if self.rate > 0 and (gap := last + 1 / self.rate - time.monotonic()) > 0 and last:
                time.sleep(gap)
            last = time.monotonic()
            yield fetch(url, self.timeout)


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "roundmill_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return PageReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PageSource)
