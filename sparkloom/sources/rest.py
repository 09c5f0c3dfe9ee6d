"""Paged and windowed HTTP sources as Python data sources; the fetching function is the caller's.

``fetch`` is called on the executors as fetch(path, parameters) -> decoded JSON, and may wait and retry
through ``with_retries``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class RateLimited(Exception):
    """Raised by a fetcher that must wait ``seconds``."""

    def __init__(self, seconds: float):
        super().__init__(f"rate limited for {seconds} s")
        self.seconds = seconds


def with_retries(fetch: Callable, attempts: int = 3, longest: float = 90, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """``fetch`` that waits out rate limits of up to ``longest`` seconds, ``attempts`` times in all."""

    def call(path: str, parameters: dict):
        for attempt in range(attempts):
            try:
                return fetch(path, parameters)
            except RateLimited as e:
                if e.seconds > longest or attempt == attempts - 1:
                    raise
                sleep(e.seconds)

    return call


class Page(InputPartition):
    def __init__(self, offset: int, length: int):
        super().__init__((offset, length))
        self.offset, self.length = offset, length


def paged_source(name: str, fetch: Callable, page: int = 100) -> type[DataSource]:
    """A data source whose partitions are offset ranges; rows are JSON text with their index.

    The first request tells the total; every page is then read by a task of its own, and one that is
    empty ends there.
    """

    class Reader(DataSourceReader):
        def partitions(self):
            total = int(fetch("/rows", {"offset": 0, "length": 0}).get("num_rows_total", 0))
            return [Page(k, page) for k in range(0, total, page)] or [Page(0, 0)]

        def read(self, partition):
            if partition.length:
                got = fetch("/rows", {"offset": partition.offset, "length": partition.length})
                for k, row in enumerate(got.get("rows", [])):
                    yield (partition.offset + k, json.dumps(row, ensure_ascii=False, sort_keys=True))

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "row_index bigint, value string"

        def reader(self, schema):
            return Reader()

    return Paged


class Window(InputPartition):
    def __init__(self, since: str, until: str):
        super().__init__((since, until))
        self.since, self.until = since, until


def iso(t: datetime) -> str:
    return t.astimezone(timezone.utc).replace(microsecond=0).isoformat().replace("+00:00", "Z")


def windows(count: Callable[[str, str], tuple[int, bool]], since: datetime, until: datetime, most: int = 1000) -> list[tuple[str, str]]:
    """Intervals of which each has at most ``most`` complete hits, by halving those that have more."""
    n, incomplete = count(iso(since), iso(until))
    if n <= most and not incomplete:
        return [(iso(since), iso(until))]
    middle = since + (until - since) / 2
    middle = middle.replace(microsecond=0)
    if middle <= since or middle >= until:
        raise ValueError(f"more than {most} hits within one second at {iso(since)}")
    return windows(count, since, middle, most) + windows(count, middle + timedelta(seconds=1), until, most)


def windowed_source(name: str, fetch: Callable, since: datetime, until: datetime, most: int = 1000, page: int = 100) -> type[DataSource]:
    """A data source over a search that returns at most ``most`` hits: planned windows, one task each; pull requests are left out."""

    class Reader(DataSourceReader):
        def partitions(self):
            def count(a: str, b: str) -> tuple[int, bool]:
                got = fetch("/search/issues", {"since": a, "until": b, "per_page": 1, "page": 1})
                return int(got["total_count"]), bool(got.get("incomplete_results"))

            return [Window(a, b) for a, b in windows(count, since, until, most)]

        def read(self, partition):
            for k in range(1, most // page + 1):
                items = fetch("/search/issues", {"since": partition.since, "until": partition.until, "per_page": page, "page": k}).get("items", [])
                for x in items:
                    if "pull_request" not in x:
                        yield (int(x["number"]), json.dumps(x, ensure_ascii=False, sort_keys=True))
                if len(items) < page:
                    return

    class Windowed(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "number bigint, value string"

        def reader(self, schema):
            return Reader()

    return Windowed
