"""Reading pages over HTTP, in the executors; off unless a caller asks for it."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

HEADERS = {"User-Agent": "Mozilla/5.0 (compatible; postlens)", "Accept": "application/json, text/html"}


def _get(url: str, timeout: float) -> bytes:
    with urllib.request.urlopen(urllib.request.Request(url, headers=HEADERS), timeout=timeout) as answer:
        return answer.read()


def fetch_text(url: str, retries: int = 2, base_sleep: float = 30.0, timeout: float = 30.0, get: Callable[[str, float], bytes] = _get, sleep: Callable[[float], None] = time.sleep) -> str:
    """Text of an address; bytes that are no UTF-8 are replaced.

    Too many requests (429) wait ``base_sleep`` times the number of the attempt, other network errors
    at most 30 seconds times it; after ``retries`` repeated attempts the error is raised.
    """
    for attempt in range(1, retries + 2):
        try:
            return get(url, timeout).decode("utf-8", "replace")
        except (urllib.error.URLError, TimeoutError) as e:
            limited = getattr(e, "code", None) == 429
            if attempt > retries or (isinstance(e, urllib.error.HTTPError) and not limited):
                raise
            sleep(base_sleep * attempt if limited else min(base_sleep, 30.0 * attempt))
    raise AssertionError("unreachable")


def fetch_json(url: str, params: dict | None = None, **options) -> object:
    """The document at an address with parameters."""
    return json.loads(fetch_text(url + ("?" + urllib.parse.urlencode(params) if params else ""), **options))


def fetched(urls: DataFrame, column: str = "url", **options) -> DataFrame:
    """``url``, ``value``, ``error`` of each address, read one after the other in each partition; an error is a value, no failure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, errors = [], []
            for url in batch.column(0).to_pylist():
                try:
                    value, error = fetch_text(url, **options), None
                except Exception as e:
                    value, error = None, f"{type(e).__name__}: {e}"
                values.append(value)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.string()), pa.array(errors, pa.string())], ["url", "value", "error"])

    return urls.select(urls[column].alias("url")).mapInArrow(run, "url string, value string, error string")
