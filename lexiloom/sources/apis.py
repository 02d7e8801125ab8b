"""Paged web APIs as Python data sources, batch and streaming, with an injectable transport.

A transport is a function from URL and parameters to parsed JSON, named as
``module:function`` so that workers can import it. Requests are retried with a
linearly growing pause. (SRC-12, SRC-16, SRC-17, SRC-18, SRC-19)
"""

from __future__ import annotations

import hashlib
import importlib
import json
import os
import tempfile
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

Transport = Callable[[str, dict], object]
RECORD = "channel string, value string"


def http_json(url: str, params: dict) -> object:
    """JSON of a GET request."""
    with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(params)}", timeout=30) as response:
        return json.loads(response.read())


def load_transport(name: str | None) -> Transport:
    if not name:
        return http_json
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def fetch(transport: Transport, url: str, params: dict, tries: int = 5, pause: float = 2.0) -> object:
    """A request, tried again after errors and after refusals for its rate. (SRC-19)"""
    for attempt in range(1, tries + 1):
        try:
            return transport(url, params)
        except (urllib.error.URLError, TimeoutError, ConnectionError):
            if attempt == tries:
                raise
            time.sleep(pause * attempt)
    raise AssertionError("unreachable")


def comment_pages(get: Callable[[dict], object], channel: str, most_pages: int, most_rows: int, size: int) -> Iterator[dict]:
    """Comments of a channel, newest first; each page ends before the oldest time seen. (SRC-12, SRT-04)"""
    before, rows = None, 0
    for _ in range(most_pages):
        page = get({"subreddit": channel, "size": size} | ({"before": before} if before else {})).get("data", [])
        if not page:
            return
        for record in page:
            yield record
            if (rows := rows + 1) >= most_rows:
                return
        oldest = min(int(r.get("created_utc") or 0) for r in page)
        if before is not None and oldest >= before:
            return
        before = oldest - 1


def archive_pages(get: Callable[[dict], object], channel: str, most_pages: int, most_rows: int, size: int) -> Iterator[dict]:
    """Posts of a board's archive by page number. (SRC-17)"""
    rows = 0
    for n in range(1, most_pages + 1):
        found = get({"board": channel, "page": n})
        posts = [p for part in found.values() if isinstance(part, dict) for p in part.get("posts", [])] if isinstance(found, dict) else []
        if not posts:
            return
        for post in posts:
            yield post
            if (rows := rows + 1) >= most_rows:
                return


def video_pages(get: Callable[[dict], object], channel: str, most_pages: int, most_rows: int, size: int) -> Iterator[dict]:
    """Comment threads of a video by page token. (SRC-18, FLT-10)"""
    token, rows = None, 0
    for _ in range(most_pages):
        page = get({"videoId": channel, "maxResults": size} | ({"pageToken": token} if token else {}))
        for thread in page.get("items", []):
            yield thread
            if (rows := rows + 1) >= most_rows:
                return
        if not (token := page.get("nextPageToken")):
            return


def video_search(get: Callable[[dict], object], channel: str, most_pages: int, most_rows: int, size: int) -> Iterator[dict]:
    """Comment threads of the videos that a search finds, each with its video's id and title; ``most_rows`` for each video. (SRC-18)"""
    token = None
    for _ in range(most_pages):
        page = get({"q": channel, "what": "search", "maxResults": size} | ({"pageToken": token} if token else {}))
        for found in page.get("items", []):
            video, title = found["id"]["videoId"], found.get("snippet", {}).get("title", "")
            for thread in video_pages(get, video, most_pages, most_rows, size):
                yield thread | {"videoId": video, "title": title}
        if not (token := page.get("nextPageToken")):
            return


def board_threads(get: Callable[[dict], object], channel: str, most_pages: int, most_rows: int, size: int) -> Iterator[dict]:
    """Posts of a live board: its catalogue, then up to ``size`` threads. (SRC-16, FLT-11)"""
    rows = 0
    threads = [t for page in get({"board": channel, "what": "catalog"})[:most_pages] for t in page.get("threads", [])][:size]
    for thread in threads:
        for post in get({"board": channel, "what": "thread", "no": thread["no"]}).get("posts", []):
            yield post
            if (rows := rows + 1) >= most_rows:
                return


PAGERS = {"comments": comment_pages, "archive": archive_pages, "videos": video_pages, "video-search": video_search, "board": board_threads}


class _Paged:
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        self.channels = [c for c in self.options.get("channels", "").split(",") if c]

    def records(self, channel: str) -> Iterator[tuple[str, str]]:
        o, transport = self.options, load_transport(self.options.get("transport"))
        get = lambda params: fetch(transport, o.get("url", ""), params, int(o.get("tries", 5)), float(o.get("pause", 2.0)))
        pager = PAGERS[o.get("kind", "comments")]
        for record in pager(get, channel, int(o.get("maxpages", 10)), int(o.get("maxrows", 10_000)), int(o.get("pagesize", 100))):
            yield channel, json.dumps(record, ensure_ascii=False)


class PagedReader(_Paged, DataSourceReader):
    """One partition per channel."""

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(c) for c in self.channels]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        return self.records(partition.value)


@dataclass
class Scan(InputPartition):
    """One channel, read for one scan."""

    channel: str
    number: int


class RescanReader(_Paged, DataSourceStreamReader):
    """Scans all channels anew, each in a task of its own; the offset counts scans. (STR-02)

    With ``repeat`` there are so many scans, without it one every ``every`` seconds.
    With ``keep``, a folder that all workers can open, a scan's records are written
    there before they are handed out, so a replayed batch has the same rows; without
    it a replay fetches anew.
    """

    def __init__(self, options: dict):
        super().__init__(options)
        self.scans = 0

    def initialOffset(self) -> dict:
        return {"scan": 0}

    def latestOffset(self) -> dict:
        if repeat := int(self.options.get("repeat", 0)):
            self.scans = min(self.scans + 1, repeat)
            return {"scan": self.scans}
        return {"scan": int(time.time() // float(self.options.get("every", 60)))}

    def partitions(self, start: dict, end: dict) -> list[Scan]:
        return [Scan(c, end["scan"]) for c in self.channels] if end["scan"] > start["scan"] else []

    def read(self, partition: Scan) -> Iterator[tuple[str, str]]:
        keep = self.options.get("keep")
        if not keep:
            yield from self.records(partition.channel)
            return
        name = hashlib.sha256(partition.channel.encode()).hexdigest()[:16]
        path = os.path.join(keep, f"{partition.number:012d}-{name}.jsonl")
        if not os.path.exists(path):
            os.makedirs(keep, exist_ok=True)
            with tempfile.NamedTemporaryFile("w", dir=keep, delete=False, encoding="utf-8") as out:
                for _, value in self.records(partition.channel):
                    out.write(value + "\n")
            os.replace(out.name, path)
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                yield partition.channel, line.rstrip("\n")

    def commit(self, end: dict) -> None:
        """Nothing is kept on the other side."""


class PagedApi(DataSource):
    """``spark.read.format("paged_api")`` with options kind, url, channels, transport, maxPages, maxRows, pageSize."""

    @classmethod
    def name(cls) -> str:
        return "paged_api"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))

    def streamReader(self, schema) -> RescanReader:
        return RescanReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedApi)
