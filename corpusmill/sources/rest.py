"""REST sources for the Python Data Source API: offset paging in parallel, and cursor paging as a stream.

Fetch functions are injected, so that retries, rates and fakes are the caller's; nothing here opens a connection itself.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader


class RateLimited(Exception):
    """The server asks to slow down."""


def retrying(fetch: Callable, attempts: int = 3, backoff: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """fetch with waits of backoff ** 0, backoff ** 1, ... times backoff between attempts; the last error goes on."""

    def run(*args, **kw):
        for k in range(attempts):
            try:
                return fetch(*args, **kw)
            except Exception:
                if k + 1 == attempts:
                    raise
                sleep(backoff * 2**k)

    return run


def throttled(fetch: Callable, seconds: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """fetch with a pause before each call."""

    def run(*args, **kw):
        sleep(seconds)
        return fetch(*args, **kw)

    return run


def status_checked(fetch: Callable) -> Callable:
    """fetch returns (status, body); 403 and 429 raise RateLimited, other statuses than 200 RuntimeError."""

    def run(*args, **kw):
        status, body = fetch(*args, **kw)
        if status in (403, 429):
            raise RateLimited(f"status {status}")
        if status != 200:
            raise RuntimeError(f"status {status}")
        return body

    return run


def read_range(fetch: Callable, titles: list, save: Callable[[list, str | None], None], delay: float = 1.0, cooldown: float = 60.0, batch: int = 15, checkpoint: int = 5, blocks: int = 2, sleep: Callable[[float], None] = time.sleep) -> bool:
    """One range of a listing by cursor, appended to titles: fetch(cursor) -> (titles, next cursor or None).

    Progress is saved every `checkpoint` requests, and before each pause. A pause is `delay` between requests, `cooldown`
    behind every `batch` of them and after a refusal (RateLimited). `blocks` refusals in a row give the range up.
    Returns whether the range was read to its end.
    """
    cursor, requests, refused = None, 0, 0
    while True:
        try:
            found, following = fetch(cursor)
        except RateLimited:
            refused += 1
            save(titles, cursor)
            if refused >= blocks:
                return False
            sleep(cooldown)
            continue
        refused, requests = 0, requests + 1
        titles.extend(found)
        if not following:
            return True
        cursor = following
        if requests % checkpoint == 0 or requests % batch == 0:
            save(titles, cursor)
        sleep(delay if requests % batch else cooldown)


def read_ranges(starts: list[str | None], fetch_from: Callable[[str | None], Callable], titles: list, save: Callable[[list, str | None], None], **pauses) -> list:
    """Ranges of a listing in turn, until one is read to its end; titles in the order of their first occurrence. The range
    without a start is left out if there are titles already. fetch_from(start) gives read_range's fetch."""
    for start in starts:
        if start is None and titles:
            continue
        if read_range(fetch_from(start), titles, save, **pauses):
            break
        pauses.get("sleep", time.sleep)(pauses.get("cooldown", 60.0))
    titles[:] = dict.fromkeys(titles)
    save(titles, None)
    return titles


class OffsetPages(InputPartition):
    def __init__(self, first: int, stride: int):
        self.first, self.stride = first, stride


class _OffsetReader(DataSourceReader):
    def __init__(self, fetch, columns, page, parallel):
        self.fetch, self.columns, self.page, self.parallel = fetch, columns, page, parallel

    def partitions(self):
        return [OffsetPages(k, self.parallel) for k in range(self.parallel)]

    def read(self, partition: OffsetPages) -> Iterator[tuple]:
        number = partition.first
        while rows := self.fetch(number * self.page, self.page):
            yield from (tuple(r.get(c) for c in self.columns) for r in rows)
            number += partition.stride


def offset_source(name: str, fetch: Callable[[int, int], list[dict]], schema: str, page: int = 100, parallel: int = 4) -> type[DataSource]:
    """A data source over fetch(skip, top) -> records, read until an empty page. Each partition takes every parallel-th page,
    and a lost task reads its own pages again."""
    columns = [part.split()[0] for part in schema.split(",")]

    class OffsetSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return _OffsetReader(fetch, columns, page, parallel)

    return OffsetSource


class _CursorReader(SimpleDataSourceStreamReader):
    def __init__(self, fetch, columns):
        self.fetch, self.columns = fetch, columns

    def initialOffset(self) -> dict:
        return {"cursor": "", "done": 0}

    def read(self, start: dict):
        if start.get("done"):
            return iter([]), start
        rows, cursor = self.fetch(start["cursor"] or None)
        out = [tuple(r.get(c) for c in self.columns) for r in rows]
        return iter(out), {"cursor": cursor or "", "done": 0 if cursor else 1}

    def readBetweenOffsets(self, start: dict, end: dict):
        return self.read(start)[0]

    def commit(self, end: dict) -> None:
        return None


def cursor_source(name: str, fetch: Callable[[str | None], tuple[list[dict], str | None]], schema: str) -> type[DataSource]:
    """A streaming data source over fetch(cursor) -> (records, next cursor or None). The cursor is the stream's offset, so a
    restarted query goes on where its checkpoint says."""
    columns = [part.split()[0] for part in schema.split(",")]

    class CursorSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
            return _CursorReader(fetch, columns)

    return CursorSource


def register(spark: SparkSession, *sources: type[DataSource]) -> None:
    for source in sources:
        spark.dataSource.register(source)
