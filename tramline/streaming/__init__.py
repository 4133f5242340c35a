"""Streaming pipelines: each micro-batch runs the batch transforms.

A message is a complete feed and its output replaces the last one, so a batch
keeps the latest message of each provider. The timetable is a snapshot folder
that a batch reads once, whole, at its start.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence
from urllib.parse import quote, unquote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.feed import KEYS, Feed
from ..operators.rows import last_of
from ..schemas import ENVELOPE
from ..sources import files, gtfs, netex, remote


RAWDATA = ENVELOPE.replace(", ", ",").replace(" ", ":")
MESSAGE = f"provider string, timestamp string, rawdata struct<{RAWDATA}>"


def messages(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """A stream of envelopes from JSON files: provider, timestamp, rawdata."""
    return spark.readStream.schema(MESSAGE).options(**options).json(folder)


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The same envelopes from the records of a topic."""
    records = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).options(**options).load()
    return opened(records.select(F.col("value").cast("string").alias("value")))


def opened(records: DataFrame) -> DataFrame:
    """Envelopes from rows whose ``value`` is their JSON; others are dropped."""
    parsed = records.select(F.from_json("value", MESSAGE).alias("m"))
    return parsed.where("m.provider is not null").select("m.*")


def unwrapped(batch: DataFrame) -> DataFrame:
    """(provider, timestamp, payload) with payloads inflated."""
    flat = batch.select("provider", "timestamp", "rawdata.*")
    return flat.select("provider", "timestamp", remote.payload(flat).alias("payload"))


def latest(batch: DataFrame) -> DataFrame:
    """The last message of each provider in a batch."""
    return last_of(batch, ["provider"], ["timestamp", "payload"])


class Snapshots:
    """Versions of the timetable as Parquet folders below one path.

    ``publish`` writes a version, with the last row of each key alone, and then
    its name into the pointer; ``feed`` reads the version that the pointer
    names, so a batch sees one version, and its lookups need no aggregate. A
    failed refresh leaves the pointer where it was. A batch that runs again sees
    the version that it saw before (``pinned``); ``prune`` removes old ones.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def publish(self, feed: Feed, version: str) -> None:
        for name, df in feed.tables.items():
            df = last_of(df, [KEYS[name]]) if name in KEYS and name not in feed.unique else df
            df.write.mode("overwrite").parquet(f"{self.path}/{version}/{name}")
        tables = ",".join(sorted(feed.tables))
        self.spark.range(1).select(F.lit(version).alias("version"), F.lit(tables).alias("tables"), F.lit(time.time_ns()).alias("at")).coalesce(1).write.mode("append").parquet(f"{self.path}/_pointer")

    def versions(self) -> list[tuple[str, list[str]]]:
        """(version, its tables), the oldest first; of a version published twice
        the later counts."""
        rows = self.spark.read.parquet(f"{self.path}/_pointer").orderBy("at").collect()  # a row for each publication
        return list({r["version"]: (r["version"], r["tables"].split(",")) for r in sorted(rows, key=lambda r: r["at"])}.values())

    def feed(self, version: str | None = None) -> Feed:
        """The newest version, or one by name."""
        name, tables = next((v for v in reversed(self.versions()) if version in (None, v[0])), (None, []))
        if name is None:
            raise ValueError(f"no version {version!r}")
        return Feed(unique=KEYS, **{t: self.spark.read.parquet(f"{self.path}/{name}/{t}") for t in tables})

    def pinned(self, query: str, batch: int) -> str:
        """The version that a batch of a query sees: the newest when it first ran,
        and the same whenever it runs again."""
        place = f"{self.path}/_batches/{quote(query, safe='')}/{batch}"
        if not files.exists(place):
            with files.created(f"{place}.new") as out:
                out.write(self.versions()[-1][0].encode())
            files.moved(f"{place}.new", place)
        with files.opened(place) as held:
            return held.read().decode()

    def prune(self, keep: int = 2) -> list[str]:
        """Removes the files of versions that are neither among the newest nor seen
        by the last batch of any query, which may run again; returns their names."""
        system, top = files.located(f"{self.path}/_batches")
        last: dict[str, tuple[int, str]] = {}
        for info in system.get_file_info(fs.FileSelector(top, recursive=True, allow_not_found=True)):
            if info.is_file and info.base_name.isdigit():
                query = info.path.rpartition("/")[0]
                last[query] = max(last.get(query, (-1, "")), (int(info.base_name), info.path))
        used = {system.open_input_file(path).read().decode() for _, path in last.values()}
        versions = self.versions()
        old = [v for v, _ in versions[: len(versions) - keep] if v not in used]
        rows = [(v, ",".join(tables), k) for k, (v, tables) in enumerate(versions) if v not in old]
        if old:
            self.spark.createDataFrame(rows, "version string, tables string, at long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_pointer")
        for v in old:
            files.removed(f"{self.path}/{v}")
        return old


def refresh(snapshots: Snapshots, load: Callable[[], Feed], version: str) -> bool:
    """A new version, if it loads; otherwise the old one stays."""
    try:
        snapshots.publish(load(), version)
    except Exception as e:  # noqa: BLE001  any failure of a load keeps the old version
        print(f"refresh failed, the snapshot stays: {e}")
        return False
    return True


def load_static(spark: SparkSession, gtfs_url: str, netex_pattern: str | None = None, types: Sequence[str] = ("ServiceJourney", "ServiceJourneyPattern", "Route", "Line")) -> tuple[Feed, DataFrame | None]:
    """The timetable from FTP: the bundle, and the entities of the latest dated
    archive of the pattern, pruned in the scan to the types that linkage needs.
    Shapes and translations are left out."""
    feed = gtfs.read_zip(spark, remote.download_ftp(spark, gtfs_url))
    if netex_pattern is None:
        return feed, None
    file = remote.download_ftp(spark, remote.resolve_latest_ftp(netex_pattern))
    return feed, netex.read_xml(spark, file, types=types)


def keep_fresh(snapshots: Snapshots, load: Callable[[], Feed], every: float = 86_400.0, stop: threading.Event | None = None, most: int | None = None) -> int:
    """Refreshes the snapshot now and then every so many seconds, until ``stop``
    is set or ``most`` loads are done; a failed load keeps the old version.
    Returns how many succeeded. Streams pick a version up at their next batch."""
    stop = stop or threading.Event()
    done = good = 0
    while not stop.is_set():
        good += refresh(snapshots, load, f"v{time.time_ns()}")
        done += 1
        if most is not None and done >= most or stop.wait(every):
            break
    return good


def run(stream: DataFrame, handle: Callable[[DataFrame, Feed], None], snapshots: Snapshots, checkpoint: str, provider: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """A query that hands each batch's latest messages and the snapshot to
    ``handle``; with ``provider`` only that one's (fan-out by routing key)."""
    chosen = stream.where(F.col("provider") == provider) if provider else stream

    def each(batch: DataFrame, number: int) -> None:
        rows = latest(unwrapped(batch))
        if not rows.isEmpty():
            handle(rows, snapshots.feed(snapshots.pinned(checkpoint, number)))

    return chosen.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def fan_out(stream: DataFrame, handlers: dict[str, Callable[[DataFrame, Feed], None]], snapshots: Snapshots, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """One query for all providers: the queue is read once, each batch's latest
    messages are staged by provider, and each handler gets its provider's part and
    the same version of the timetable. Messages of others are passed over; a
    handler that fails fails the batch, which runs again for all."""

    def each(batch: DataFrame, number: int) -> None:
        rows = latest(unwrapped(batch.where(F.col("provider").isin(*handlers))))
        staged = f"{checkpoint}/staged/{number}"
        rows.write.mode("overwrite").partitionBy("provider").parquet(staged)
        schema = rows.schema
        there = {unquote(i.base_name.partition("=")[2]) for i in _folders(staged)}
        version = snapshots.pinned(checkpoint, number) if there else None
        for provider, handle in handlers.items():
            if provider in there:
                handle(batch.sparkSession.read.schema(schema).parquet(staged).where(F.col("provider") == provider), snapshots.feed(version))
        files.removed(staged)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _folders(path: str) -> list[fs.FileInfo]:
    system, top = files.located(path)
    return [i for i in system.get_file_info(fs.FileSelector(top)) if not i.is_file]


def supervise(start: Callable[[], StreamingQuery], pause: float = 5.0, most: int | None = None) -> int:
    """Runs a query and starts it again when it fails, after a pause; returns
    how often it failed, once it ends well or ``most`` is reached."""
    failures = 0
    while True:
        try:
            start().awaitTermination()
            return failures
        except Exception as e:  # noqa: BLE001  whatever stopped the query, it starts again
            failures += 1
            print(f"query failed: {e}")
            if most is not None and failures >= most:
                return failures
            time.sleep(pause)
