"""Feeds polled by their schedules, as a stream that can be run again.

The offset of a feed is the last time that its six-field schedule was due. Each feed
that has become due is a partition, polled by a task. The answer goes to a log in a
shared folder before the task gives it out, so when a batch fails, on the way or at
its sink, the same batch gives the same rows without a second request.
"""

from __future__ import annotations

import json
import urllib.request
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from http.client import HTTPException
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from . import files, remote

SCHEMA = "provider string, timestamp string, format string, protocol string, metadata map<string,string>, payload string"


def last_due(cron: str, after: datetime, now: datetime) -> datetime | None:
    """The last time up to ``now`` and later than ``after`` at which a schedule
    runs. Looks back over spans that double, so it takes few steps whether the
    schedule runs each second or once a year."""
    span = timedelta(seconds=1)
    while True:
        start = max(after, now - span)
        found = None
        try:
            while (due := remote.next_run(cron, found or start)) <= now:
                found = due
        except ValueError:  # never again
            pass
        if found is not None or start == after:
            return found
        span *= 2


@dataclass
class Poll(InputPartition):
    """A feed and the time that it was due."""

    feed: dict
    due: str


def answer(feed: dict, timeout: float) -> str:
    """What a feed's address says; empty if that fails, or if it is no address."""
    try:
        request = urllib.request.Request(feed["endpoint"], headers=feed.get("headers") or {})
        with urllib.request.urlopen(request, timeout=timeout) as got:
            return got.read().decode() if got.status in (200, None) else ""  # files have no status
    except (OSError, ValueError, HTTPException):  # no text and no address are ValueErrors
        return ""


class PollReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.feeds = {f["provider"]: f for f in json.loads(options["feeds"])}
        for feed in self.feeds.values():
            remote.cron_fields(feed["cron"])
        self.log, self.timeout = options["log"].rstrip("/"), float(options.get("timeout", "30"))
        self.start = options.get("start") or datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0).isoformat()
        self.until, self.squeezed = options.get("until"), options.get("compress", "false").lower() == "true"

    def initialOffset(self) -> dict:
        return {p: self.start for p in self.feeds}

    def latestOffset(self) -> dict:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        now = min(now, datetime.fromisoformat(self.until)) if self.until else now
        last = {p: last_due(f["cron"], datetime.fromisoformat(self.start), now) for p, f in self.feeds.items()}
        return {p: due.isoformat() if due else self.start for p, due in last.items()}

    def partitions(self, start: dict, end: dict) -> Sequence[Poll]:
        return [Poll(f, end[p]) for p, f in self.feeds.items() if p in end and end[p] > start.get(p, self.start)]

    def place(self, provider: str, due: str) -> str:
        return f"{self.log}/{quote(provider, safe='')}/{quote(due, safe='')}"

    def read(self, partition: Poll) -> Iterator[tuple]:
        feed, place = partition.feed, self.place(partition.feed["provider"], partition.due)
        if not files.exists(place):
            body, near = answer(feed, self.timeout), f"{place}.{uuid.uuid4().hex}"
            with files.created(near) as out:
                out.write(body.encode())
            files.moved(near, place)
        with files.opened(place) as held:
            body = held.read().decode()
        if body:
            metadata = {"compressed": remote.COMPRESSED} if self.squeezed else {}
            yield feed["provider"], partition.due, feed.get("format", "json"), feed.get("protocol", "http"), metadata, remote.compress(body) if self.squeezed else body

    def commit(self, end: dict) -> None:
        """Answers of batches that are done are needed no more."""
        for provider, due in end.items():
            system, folder = files.located(f"{self.log}/{quote(provider, safe='')}")
            for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if info.base_name <= quote(due, safe=""):
                    system.delete_file(info.path)


class ScheduledPolls(DataSource):
    """``spark.readStream.format("scheduled_polls")``: one row for each answer.

    Options: ``feeds``, a JSON list of provider, endpoint, cron and, if wanted,
    format, protocol and headers; ``log``, a shared folder; ``start``, after which
    feeds are due (now; UTC), ``until``, after which none is; ``compress``,
    ``timeout``. Times that passed while nothing ran are one poll, as the answers
    of then are not to be had. A failed or empty answer gives no row.
    """

    @classmethod
    def name(cls) -> str:
        return "scheduled_polls"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> PollReader:
        return PollReader(self.options)


def polls(spark: SparkSession, feeds: Sequence[dict], log: str, **options: str) -> DataFrame:
    """A stream of answers of the feeds (see ``ScheduledPolls``). The trigger says
    how often schedules are looked at; each feed is polled by its own."""
    spark.dataSource.register(ScheduledPolls)
    return spark.readStream.format("scheduled_polls").options(feeds=json.dumps(list(feeds)), log=log, **options).load()
