"""A published timetable as bucketed catalog tables.

Publishing sorts every table once by the key that it is joined on, into buckets
of a bounded size, and derives what lookups would derive each time: when a trip
starts, and the how manieth time it is at a stop. Joins of stop times, trips and
starts by trip, and of services by service, then need no exchange, and live rows
alone are shuffled to them. Each key is held once; that is made so, or checked,
when a version is published. A version is complete when it is in the list of
versions, and tables are found again by any session from there.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .feed import KEYS, Feed
from .linkage import first_departures, occurrences
from .rows import last_of

#: What tables are bucketed by, and in what order their rows lie.
LAYOUT = {
    "stops": ("stop_id",), "routes": ("route_id",), "trips": ("trip_id",), "stop_times": ("trip_id", "stop_sequence"), "starts": ("trip_id",),
    "calendar": ("service_id",), "calendar_dates": ("service_id", "date"),
}
#: The key of each derived table.
DERIVED = {"starts": "trip_id"}
#: Rows of a bucket, about, of the largest table: a task reads a bucket whole.
BUCKET_ROWS = 1_000_000


def repeated(df: DataFrame, key: str) -> DataFrame:
    """The keys that ``df`` holds more than once."""
    return df.groupBy(key).count().where("count > 1").select(key)


class Store:
    """Versions of a timetable below a path, as tables whose names begin with
    ``name``. ``buckets`` is the least number of a version's; large versions have
    one for each BUCKET_ROWS stop times or trips."""

    def __init__(self, spark: SparkSession, path: str, name: str, buckets: int = 64):
        if not re.fullmatch(r"[a-z][a-z0-9_]*", name):
            raise ValueError(f"{name!r} cannot begin a table's name")
        self.spark, self.path, self.name, self.buckets = spark, path.rstrip("/"), name, buckets

    def table(self, version: str, table: str) -> str:
        return f"{self.name}_{re.sub(r'[^a-z0-9]', '_', version.lower())}_{table}"

    def publish(self, feed: Feed, version: str) -> None:
        """Writes a version; of rows of one key the last in file order is kept. A
        feed that says its keys are unique is taken at its word only after a look."""
        tables = dict(feed.tables)
        for name, key in KEYS.items():
            if name in tables and name not in feed.unique:
                tables[name] = last_of(tables[name], [key])
            elif name in tables and (wrong := repeated(tables[name], key).first()) is not None:
                raise ValueError(f"{name}: {key} {wrong[0]} is there more than once")
        if "stop_times" in tables:
            tables["starts"] = first_departures(Feed(stop_times=tables["stop_times"]))
            tables["stop_times"] = occurrences(tables["stop_times"])
        most = max((feed.tables[t].count() for t in ("stop_times", "trips") if t in feed.tables), default=0)
        buckets = max(self.buckets, -(-most // BUCKET_ROWS))
        made = []
        for name, df in tables.items():
            key, *more = LAYOUT.get(name) or (df.columns[0],)
            place = f"{self.path}/{version}/{name}"
            df.repartition(buckets, key).write.mode("overwrite").option("path", place).bucketBy(buckets, key).sortBy(key, *more).saveAsTable(self.table(version, name))
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
            made.append((version, name, f"({columns}) using parquet clustered by ({key}) sorted by ({', '.join((key, *more))}) into {buckets} buckets location '{place}'"))
        rows = self.spark.createDataFrame(made, "version string, name string, ddl string").withColumn("at", F.unix_micros(F.current_timestamp()))
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/_versions")

    def versions(self) -> list[str]:
        """Complete versions, the oldest first."""
        rows = self.spark.read.parquet(f"{self.path}/_versions").groupBy("version").agg(F.max("at").alias("at")).orderBy("at", "version").collect()
        return [r["version"] for r in rows]

    def feed(self, version: str | None = None) -> Feed:
        """The tables of a version, the newest unless one is named."""
        version = version or self.versions()[-1]
        rows = self.spark.read.parquet(f"{self.path}/_versions").where(F.col("version") == version).select("name", "ddl").distinct().collect()
        if not rows:
            raise ValueError(f"no version {version!r}")
        found = {}
        for r in rows:
            name = self.table(version, r["name"])
            self.spark.sql(f"create table if not exists `{name}` {r['ddl']}")  # a catalog may be of one session
            found[r["name"]] = self.spark.table(name)
        return Feed(unique=[*KEYS, *DERIVED], **found)

    def drop(self, version: str) -> None:
        """Takes a version's tables out of the catalog; its files stay."""
        for name in LAYOUT:
            self.spark.sql(f"drop table if exists `{self.table(version, name)}`")
