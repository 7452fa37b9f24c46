"""Pages of addresses as a Python data source: one partition, a least time between requests, retries with growing pauses.

``spark.dataSource.register(Pages); spark.read.format("pages").option("urls", "a b").option("agent", "name mail").load()``. The opener is named by
``module:function`` and takes (url, headers, timeout) -> (status, headers, body), so that tests and other transports can take its place.
"""

from __future__ import annotations

import importlib
import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

#: Answers after which a request is tried again.
AGAIN = (403, 429, 500, 502, 503, 504)


def urlopen(url: str, headers: dict[str, str], timeout: float) -> tuple[int, dict[str, str], bytes]:
    """The standard library's opener."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:  # noqa: S310
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers or {}), e.read() or b""


def dry_run(url: str, headers: dict[str, str], timeout: float) -> tuple[int, dict[str, str], bytes]:  # noqa: ARG001
    """An opener without a network: what would be asked, as whom; not found for addresses that end with ``missing``."""
    return (404, {}, b"") if url.endswith("missing") else (200, {}, f"{url}|{headers.get('User-Agent', '')}".encode())


class Pace:
    """At least ``interval`` seconds between turns."""

    def __init__(self, interval: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.interval, self.clock, self.sleep, self.next = interval, clock, sleep, 0.0

    def turn(self) -> None:
        wait = self.next - self.clock()
        if wait > 0:
            self.sleep(wait)
        self.next = max(self.next, self.clock()) + self.interval


def pause(attempt: int, first: float, most: float, stated: str | None, jitter: Callable[[], float] = random.random) -> float:
    """Seconds before the next attempt: what the server states, else doubling with up to a quarter more, never above ``most``."""
    if stated and stated.strip().isdigit():
        return min(most, float(stated))
    return min(most, first * 2**attempt * (1 + jitter() / 4))


def fetch(url: str, opener: Callable, headers: dict[str, str], pace: Pace, attempts: int = 6, first: float = 5.0, most: float = 120.0, timeout: float = 30.0) -> tuple[int | None, bytes | None, str | None]:
    """(status, body, error) of a page; one of body and error is null."""
    error: str | None = None
    for attempt in range(attempts):
        pace.turn()
        stated, status = None, None
        try:
            status, got, body = opener(url, headers, timeout)
            if status < 400:
                return status, body, None
            error, stated = f"HTTP {status}", {k.lower(): v for k, v in got.items()}.get("retry-after")
            if status not in AGAIN:
                return status, None, error
        except OSError as e:
            error = f"{type(e).__name__}: {e}"
        if attempt + 1 < attempts:
            pace.sleep(pause(attempt, first, most, stated))
    return status, None, error


def _named(name: str | Callable) -> Callable:
    if callable(name):
        return name
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def fetch_rows(df: DataFrame, url: str, agent: str, opener: str | Callable = "quillstone.sources.http:urlopen", interval: float = 0.12, attempts: int = 6, first: float = 5.0, most: float = 120.0) -> DataFrame:
    """``df`` with the page of each row's address as (status, body, error), so that addresses made from a table (submissions, daily indexes, index pages,
    documents) are fetched where they stand. All rows go through one task, because the pace holds over all requests; a null address is an error without a request."""
    kept = [c for c in df.columns if c not in ("status", "body", "error")]
    headers = {"User-Agent": " ".join(agent.split())}
    if not headers["User-Agent"]:
        raise ValueError("agent must say who asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask, pace = _named(opener), Pace(interval)
        for batch in batches:
            got = [fetch(u, ask, headers, pace, attempts, first, most) if u else (None, None, "no address") for u in batch.column(url).to_pylist()]
            pages = [pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *pages], names=[*kept, "status", "body", "error"])

    rows = df.select(*kept)
    schema = StructType([*rows.schema.fields, StructField("status", IntegerType()), StructField("body", BinaryType()), StructField("error", StringType())])
    return rows.coalesce(1).mapInArrow(run, schema)


def quote_info(symbol: str, timeout: float = 25.0) -> dict:  # noqa: ARG001 - the library keeps its own
    """A symbol's quote record by the library that is commonly used for it; an error where it is not installed."""
    import yfinance

    return yfinance.Ticker(symbol).info


def quotes(df: DataFrame, symbol: str = "symbol", info: str | Callable = "quillstone.sources.http:quote_info", interval: float = 0.35, timeout: float = 25.0) -> DataFrame:
    """(symbol, value, error): the quote record of each distinct symbol as JSON, or why there is none. One task, for the pace."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask, pace = _named(info), Pace(interval)
        for batch in batches:
            values, errors = [], []
            for s in batch.column(0).to_pylist():
                pace.turn()
                try:
                    values.append(json.dumps(ask(s, timeout), default=str))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - whatever a client raises, the row says it
                    values.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.string()), pa.array(errors, pa.string())], names=["symbol", "value", "error"])

    return df.filter(f"`{symbol}` is not null").select(F.col(symbol).alias("symbol")).distinct().coalesce(1).mapInArrow(run, "symbol string, value string, error string")


def echo_info(symbol: str, timeout: float) -> dict:  # noqa: ARG001
    """A stand-in without a network; an error for symbols that end with X."""
    if symbol.endswith("X"):
        raise TimeoutError(symbol)
    return {"symbol": symbol, "longName": f"Name of {symbol}"}


def post(url: str, payload: bytes, timeout: float) -> bytes:
    request = urllib.request.Request(url, data=payload, headers={"Content-Type": "application/json"})  # noqa: S310
    with urllib.request.urlopen(request, timeout=timeout) as r:  # noqa: S310
        return r.read()


def chat(messages: list[dict[str, str]], url: str, model: str, temperature: float = 0.2, timeout: float = 120.0, send: Callable[[str, bytes, float], bytes] = post) -> str:
    """The reply of a chat model behind an address that takes ``{"model", "messages", "stream", "options"}`` and answers ``{"message": {"content"}}``; an empty
    reply or one of another form is an error."""
    asked = {"model": model, "messages": messages, "stream": False, "options": {"temperature": temperature}}
    said = json.loads(send(f"{url.rstrip('/')}/api/chat", json.dumps(asked).encode(), timeout))
    content = (said.get("message") or {}).get("content") if isinstance(said, dict) else None
    if not isinstance(content, str) or not content.strip():
        raise ValueError("the model gave no reply")
    return content.strip()


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # one, so that the pace holds over all requests

    def read(self, _partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        opener = _named(o.get("opener", "quillstone.sources.http:urlopen"))
        pace = Pace(float(o.get("interval", "0.12")))
        headers = {"User-Agent": " ".join(o.get("agent", "").split())}
        if not headers["User-Agent"]:
            raise ValueError("option agent must say who asks")
        for url in o.get("urls", "").split():
            yield (url, *fetch(url, opener, headers, pace, int(o.get("attempts", "6")), float(o.get("first_pause", "5")), float(o.get("most_pause", "120"))))


class Pages(DataSource):
    """(url, status, body, error) per address."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "url string, status int, body binary, error string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ARG002
        return _Reader(self.options)
