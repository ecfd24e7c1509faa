"""Live pages as a Spark data source behind one fetch function.

``fetch(kind, ident, cursor)`` returns a response as JSON text; it is named by the option ``fetch``
as ``module:function`` and runs on the executors, one id in each partition. Credentials are the
function's own matter and are never options. Kinds: ``category`` (all pages, by the number of items
so far), ``forum`` (all pages, by the last post's time), ``topic`` (one page).

A server that takes form posts needs no client of its own, only a module with
``fetch = post_client(url, fields)``.

    spark.dataSource.register(PageSource)
    raw = spark.read.format("pages").options(kind="category", ids="3413,3414", fetch="client:fetch").load()
    pages = as_category_pages(raw)
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import schemas
from .readers import ID_FIELD, REQUESTS

MAX_PAGES = 1_000_000


def post_client(url: str, fields: dict[str, str] | None = None, headers: dict[str, str] | None = None, timeout: float = 30.0, retries: int = 3, wait: float = 0.5) -> Callable[[str, int, int | None], str]:
    """A fetch function that posts forms to ``url``.

    ``fields`` (a session's, for example) go before those of the request, ``headers`` with each
    request. Failed connections and answers 429 and 5xx are tried again ``retries`` times, each
    time after twice the wait; other answers raise at once, and so does what is no JSON.
    """

    def fetch(kind: str, ident: int, cursor: int | None) -> str:
        request = "items" if kind == "category" and cursor is not None else kind
        form = {**(fields or {}), **REQUESTS[request], ID_FIELD[request]: str(ident)}
        if request == "items":
            form["start_num"] = str(cursor)
        elif request == "forum" and cursor is not None:
            form["fetch_before"] = str(cursor)
        call = urllib.request.Request(url, urllib.parse.urlencode(form).encode(), headers or {}, method="POST")
        for tried in range(retries + 1):
            try:
                with urllib.request.urlopen(call, timeout=timeout) as answer:
                    body = answer.read().decode()
                json.loads(body)
                return body
            except urllib.error.HTTPError as e:
                if tried == retries or e.code != 429 and e.code < 500:
                    raise
            except (urllib.error.URLError, TimeoutError, ConnectionError):
                if tried == retries:
                    raise
            time.sleep(wait * 2**tried)
        raise AssertionError

    return fetch


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "id bigint, page_no int, body string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)


class PageReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.kind, self.fetch = options.get("kind", "category"), options["fetch"]
        self.ids = [int(x) for x in options.get("ids", "").split(",") if x.strip()]
        if self.kind not in ("category", "forum", "topic"):
            raise ValueError(f"unknown kind of page: {self.kind}")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in self.ids]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        module, _, name = self.fetch.partition(":")
        fetch, ident, cursor, seen = getattr(importlib.import_module(module), name), partition.value, None, 0
        for page in range(MAX_PAGES):
            body = fetch(self.kind, ident, cursor)
            yield ident, page, body
            got = json.loads(body)
            response = got.get("response") or {}
            if self.kind == "category":
                items = (response.get("category") or {}).get("items") or response.get("new_items") or []
                seen += len(items)
                cursor = seen
                if response.get("no_more_items") or not items:
                    return
            elif self.kind == "forum":
                topics = response.get("topics") or []
                if got.get("no_more_topics") or not topics:
                    return
                cursor = topics[-1]["last_post_time"]
            else:
                return


def _parsed(raw: DataFrame, schema: str, id_name: str) -> DataFrame:
    fields = ", ".join(f for f in schema.split(", ") if not f.startswith(("category_id ", "topic_id ", "page_no ")))
    rows = raw.select("id", "page_no", F.from_json("body", fields).alias("x")).select("id", "page_no", "x.*")
    return rows.withColumnRenamed("id", id_name)


def as_category_pages(raw: DataFrame) -> DataFrame:
    return _parsed(raw, schemas.CATEGORY_PAGE, "category_id")


def as_topic_pages(raw: DataFrame) -> DataFrame:
    return _parsed(raw, schemas.TOPIC_PAGE, "topic_id")


def as_forum_pages(raw: DataFrame) -> DataFrame:
    return _parsed(raw, schemas.FORUM_PAGE, "category_id")
