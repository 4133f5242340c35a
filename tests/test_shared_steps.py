"""Steps of large scans that are to run once."""

from __future__ import annotations

import pyarrow as pa
from tramline.sources import gtfs


def test_cells_stand_in_the_order_of_the_table():
    names = [n for n, _ in gtfs.columns("stop_times")]
    batch = gtfs.batch_of("a.zip", "stop_times", ["stop_id", " trip_id ", "odd", "stop_id"], [["1", " t ", "x", "2"], ["3", "u", "y", ""]], 7)
    assert batch.schema.names == ["file", "table", "n", "cells"] and batch.column(2).to_pylist() == [7, 8]
    cells = [dict(zip(names, row, strict=True)) for row in batch.column(3).to_pylist()]
    assert cells[0] == dict.fromkeys(names) | {"stop_id": "2", "trip_id": "t"} and cells[1]["stop_id"] == ""  # the last of equal headers
    empty = gtfs.batch_of("a.zip", "stop_times", ["stop_id"], [], 0)
    assert empty.column(2) == pa.array([-1]) and empty.num_rows == 1


def test_a_json_field_is_computed_once(spark):
    from pyspark.sql import functions as F
    from tramline import functions as fn

    shown = spark.range(1).select(F.explode(fn.array_or_object(F.upper(F.concat(F.lit('{"a":'), "id", F.lit("}"))), "A string")))._jdf.queryExecution().optimizedPlan().toString()
    assert shown.count("upper(") == 1


def test_what_is_used_twice_is_computed_once(spark):
    from __spark_entry__ import queries

    for name in ("jn15_phase_a", "a15_audit"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [l_orderkey") == 1


def test_calls_move_three_times_and_their_delays_are_computed_once(spark):
    import re

    from __spark_entry__ import queries

    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5k")  # stops are sent to all, trips are not
    try:
        plan = queries()["t02_trip_updates"](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        assert sum("RLIKE(expected_arrival" in line for line in plan.optimizedPlan().toString().splitlines()) == 1
        moves, above = [], []
        for line in plan.executedPlan().toString().splitlines():
            depth = re.search(r"[+:]- |$", line).start() if line[:1] in " :+" else 0
            above = [d for d in above if d < depth] + [depth] * ("Exchange" in line)
            if "FileScan" in line and "lineitem" in line:
                moves.append(len(above))
        assert moves == [3, 3]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_trip_that_the_feed_does_not_know_has_no_update(spark):
    from tramline.operators.feed import Feed
    from tramline.plans import transforms

    make = spark.createDataFrame
    f = Feed(
        stops=make([("A", 0)], "stop_id string, _ord long"),
        trips=make([("T", "R", "S", 1, 0)], "trip_id string, route_id string, service_id string, direction_id int, _ord long"),
        stop_times=make([("T", "A", 1, 0), ("T", "A", 4, 1), ("U", "A", 1, 2)], "trip_id string, stop_id string, stop_sequence int, _ord long"),
    )
    at = "1998-03-02T08:0"
    calls = [(j, p, "a", f"{at}0:00Z", f"{at}1:00,5Z" if p > 1 else "odd", None, None) for j in ("j", "k", "u") for p in (1, 2)]
    made = transforms.trip_updates(
        make([(j, j, "L", at, "", "1998-03-02") for j in "jku"], "journey string, journey_ref string, line_ref string, origin_departure string, recorded_at string, date string"),
        make([(*c[:2], "A", *c[3:]) for c in calls], "journey string, position int, stop_ref string, aimed_arrival string, expected_arrival string, aimed_departure string, expected_departure string"),
        f,
        make([("j", "T"), ("k", "T"), ("u", "U")], "journey string, trip_id string"),
    )
    # two journeys of one trip, whose first calls are numbered though they have no time
    assert sorted((r["journey"], r["trip_id"], [tuple(u) for u in r["stop_time_updates"]]) for r in made.collect()) == [(j, "T", [(4, "A", 60, None)]) for j in "jk"]
