"""Published timetables: what joins of them need, and what publishing refuses."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from tramline.operators import linkage as link
from tramline.operators.feed import Feed
from tramline.operators.store import Store

SF = "/root/testdata/sf0.001"


def small(spark, unique=()):
    make = spark.createDataFrame
    return Feed(
        unique=unique,
        trips=make([("T1", "R", "S", 0, 0), ("T2", "R", "S", 1, 1), ("T1", "R2", "S", 0, 2)], "trip_id string, route_id string, service_id string, direction_id int, _ord long"),
        stop_times=make([("T1", "A", 1, 60, 70, 0), ("T1", "B", 2, 90, 90, 1), ("T1", "A", 3, 99, 99, 2), ("T2", "A", 5, 10, -1, 3)], "trip_id string, stop_id string, stop_sequence int, arrival_time int, departure_time int, _ord long"),
    )


def test_publish_and_find_again(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store", "t1", buckets=4)
    store.publish(small(spark), "One-1")
    with pytest.raises(ValueError, match="more than once"):
        store.publish(small(spark, unique=["trips"]), "two")
    assert store.versions() == ["One-1"]
    store.publish(Feed(trips=small(spark).trips.where("trip_id = 'T2'")), "three")
    assert store.versions() == ["One-1", "three"] and set(store.feed().tables) == {"trips"} and store.feed().trips.count() == 1
    f = store.feed("One-1")
    assert sorted((r["trip_id"], r["route_id"]) for r in f.trips.collect()) == [("T1", "R2"), ("T2", "R")]
    assert sorted(map(tuple, f.starts.collect())) == [("T1", 70), ("T2", 10)]
    assert sorted((r["trip_id"], r["stop_id"], r["nth"]) for r in f.stop_times.collect()) == [("T1", "A", 1), ("T1", "A", 2), ("T1", "B", 1), ("T2", "A", 1)]
    store.drop("One-1")  # as in a new session, whose catalog does not know the tables
    again = Store(spark, f"file://{tmp_path}/store", "t1", buckets=4).feed("One-1")
    assert again.trips.count() == 2 and again.stop_times.count() == 4
    with pytest.raises(ValueError, match="no version"):
        store.feed("none")
    with pytest.raises(ValueError, match="begin"):
        Store(spark, "x", "a-b")


@pytest.mark.skipif(not os.path.isdir(SF), reason="the standard tables are not here")
def test_joins_of_a_published_timetable_do_not_move_it(spark, tmp_path):
    from tramline.plans.adapters import feed
    from tramline.plans.queries import DATE, starts, trip_calls

    store = Store(spark, f"file://{tmp_path}/store", "t2", buckets=4)
    store.publish(feed(spark, SF), "v1")
    f = store.feed()

    def moved(df) -> list[str]:
        """Tables below an exchange, in the plan without adaptation."""
        found, exchanges = [], []
        text = df._jdf.queryExecution().executedPlan().toString()
        for line in text.splitlines():
            depth = re.search(r"[+:]- |$", line).start() if line[:1] in " :+" else 0
            exchanges = [d for d in exchanges if d < depth]
            if "Exchange" in line:
                exchanges.append(depth)
            if (m := re.search(r"Scan parquet spark_catalog\.default\.t2_v1_(\w+)", line)) and exchanges:
                found.append(m[1].partition("[")[0])
        return found

    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the tables here are small
    try:
        assert "stop_times" not in moved(link.nth_occurrence(trip_calls(feed(spark, SF)), f, "journey"))
        assert moved(f.stop_times.join(f.trips, "trip_id")) == []
        assert moved(f.trips.join(link.first_departures(f), "trip_id")) == []
        near = link.nearest_start(starts(spark, SF), f, link.running(f, [DATE]))
        assert "stop_times" not in moved(near)
        assert near.count() > 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert f.trips.where(F.col("trip_id").isNull()).count() == 0


def test_buckets_grow_with_the_timetable(spark, tmp_path, monkeypatch):
    from tramline.operators import store as module

    monkeypatch.setattr(module, "BUCKET_ROWS", 300)
    ids = spark.range(2_000)
    calls = ids.select((F.col("id") % 500).cast("string").alias("trip_id"), F.lit("A").alias("stop_id"), F.col("id").cast("int").alias("stop_sequence"), F.lit(1).alias("arrival_time"), F.lit(1).alias("departure_time"), F.col("id").alias("_ord"))
    store = Store(spark, f"file://{tmp_path}/store", "grown", buckets=2)
    store.publish(Feed(stop_times=calls), "v")
    ddl = {r["name"]: r["ddl"] for r in spark.read.parquet(f"file://{tmp_path}/store/_versions").collect()}
    assert all("into 7 buckets" in d for d in ddl.values()) and set(ddl) == {"stop_times", "starts"}
    assert store.feed("v").stop_times.count() == 2_000
    store.drop("v")
