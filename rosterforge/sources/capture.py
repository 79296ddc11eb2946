"""Live capture of pages: each address is fetched once, by few tasks, with retries; what fails is reported, not raised."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from urllib.error import HTTPError, URLError
from urllib.parse import urlsplit
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.url import without_fragment

#: Attempts and the seconds waited between them, when a connection fails.
WAITS = (1, 2)
#: Tasks that fetch at once, at least and at most.
LEAST, MOST = 1, 20


def headers(url: str) -> dict[str, str]:
    """What a browser sends along, with the site itself as the page that was left."""
    parts = urlsplit(url)
    sent = {
        "User-Agent": "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/124.0 Safari/537.36",
        "Accept": "text/html,application/xhtml+xml;q=0.9,*/*;q=0.8",
        "Accept-Language": "zh-CN,zh;q=0.9,en;q=0.8",
    }
    return sent | ({"Referer": f"{parts.scheme}://{parts.netloc}/"} if parts.scheme and parts.netloc else {})


def fetched(url: str, seconds: float) -> str:
    """A page's text in the encoding it states, else UTF-8; bytes that can't be read are left out."""
    with urlopen(Request(url, headers=headers(url)), timeout=seconds) as answer:  # noqa: S310 - addresses are the user's
        return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "ignore")


def with_retries(fetch: Callable[[str, float], str], url: str, seconds: float, waits: tuple[float, ...] = WAITS) -> str:
    """``fetch`` again after a failed connection, but not after an answer that is an error."""
    for wait in waits:
        try:
            return fetch(url, seconds)
        except HTTPError:
            raise
        except URLError:
            time.sleep(wait)
    return fetch(url, seconds)


def captured(
    urls: DataFrame, column: str = "url", seconds: float = 15, concurrency: int = 5, fetch: Callable[[str, float], str] = fetched, waits: tuple[float, ...] = WAITS
) -> DataFrame:
    """``url, html, error`` of every distinct address without fragment; one of ``html`` and ``error`` is NULL.

    Blank addresses are left out. Store the result before it is used, so that a
    lost executor doesn't fetch again what is stored.
    """
    wanted = urls.select(without_fragment(F.trim(column)).alias("url")).where("url <> ''").distinct()

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for url in batch["url"]:
                try:
                    row = (url, with_retries(fetch, url, seconds, waits), None)
                except Exception as e:  # noqa: BLE001 - any failure is that page's own
                    row = (url, None, f"{type(e).__name__}: {e}")
                yield pd.DataFrame([row], columns=["url", "html", "error"])

    return wanted.repartition(max(LEAST, min(MOST, concurrency)), "url").mapInPandas(load, "url string, html string, error string")
