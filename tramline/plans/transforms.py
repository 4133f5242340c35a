"""Live feeds to GTFS-Realtime: vehicle positions, trip updates, alerts.

Each takes DataFrames of one message and gives one row for each entity, so a
whole day's messages or one micro-batch run through the same plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import linkage as link
from ..operators.feed import Feed
from ..operators.rows import first_of
from ..session import kept


def latest_per_vehicle(activities: DataFrame, by: str = "vehicle_ref", at: str = "recorded_at") -> DataFrame:
    """The latest activity of each vehicle; times compare as strings, the first
    wins ties. The empty reference is one vehicle."""
    newest = activities.groupBy(by).agg(F.max(at).alias(at))
    return first_of(activities.join(newest, [by, at], "left_semi"), [by], ["_ord"])


def vehicle_positions(activities: DataFrame, feed: Feed, codes: DataFrame | None = None, phase_a: DataFrame | None = None, tolerance: int = link.VISIT_TOLERANCE) -> DataFrame:
    """Vehicle positions of vehicles whose trip is found.

    ``activities``: _ord, vehicle_ref, recorded_at, line_ref, line_name,
    direction_ref, stop_ref, delay, date (as written), longitude, latitude,
    at_stop, in_congestion. ``phase_a``: (visit, trip_id) already matched
    through the timetable chain.
    """
    latest = latest_per_vehicle(activities)
    lines = link.resolve_route(latest, feed, "line_ref", "line_name", codes)
    visits = lines.select(
        "*",
        F.col("vehicle_ref").alias("visit"),
        fn.strip_stop_prefix(F.coalesce("stop_ref", F.lit(""))).alias("stop_id"),
        fn.live_direction(F.col("direction_ref")).alias("direction_id"),
        fn.gtfs_date(fn.plain_date(F.coalesce("date", F.lit("")))).alias("day"),
        fn.wall_clock_less(F.col("recorded_at"), fn.duration(F.col("delay"))).alias("clock"),
    )
    asked = visits.where((F.col("stop_id") != "") & F.col("clock").isNotNull()).select("visit", "stop_id", F.coalesce("code", F.lit("")).alias("code"), "direction_id", "clock", F.col("day").alias("date"))
    dates = link.running_on_any(feed, asked)
    second = link.nearest_visit(asked, feed, dates, tolerance)
    first = phase_a if phase_a is not None else second.limit(0)
    resolved = link.in_turn(visits, first, second, "visit").where("trip_id is not null").drop("route_id", "direction_id")
    known = feed.trip().select("trip_id", "route_id", "direction_id")
    stops = feed.stops.select(F.col("stop_id").alias("_known")).distinct()
    out = resolved.join(known, "trip_id", "left").join(stops, F.col("stop_id") == F.col("_known"), "left")
    return out.select(
        F.col("vehicle_ref").alias("entity_id"), "trip_id", "route_id", "direction_id", fn.plain_date(F.coalesce("date", F.lit(""))).alias("start_date"),
        F.lit("SCHEDULED").alias("schedule_relationship"), F.col("vehicle_ref").alias("vehicle_id"), F.col("line_name").alias("vehicle_label"),
        fn.real_number32(F.col("latitude")).alias("latitude"), fn.real_number32(F.col("longitude")).alias("longitude"),
        F.coalesce("_known", F.lit("")).alias("stop_id"), fn.stop_status(F.col("at_stop")).alias("current_status"), fn.congestion(F.col("in_congestion")).alias("congestion_level"),
        F.coalesce(fn.epoch(F.col("recorded_at")), F.lit(0)).alias("timestamp"), "phase",
    )


def trip_updates(journeys: DataFrame, calls: DataFrame, feed: Feed, resolved: DataFrame, header: Column | None = None) -> DataFrame:
    """Trip updates with the delays of their calls, ordered by stop sequence.

    ``journeys``: journey, journey_ref, line_ref, origin_departure, recorded_at,
    date. ``calls``: journey, position, stop_ref, and aimed and expected
    arrival and departure. ``resolved``: (journey, trip_id). A call takes its
    occurrence at the stop even if it then has no real-time data; journeys
    without a trip or without a call left give nothing.

    Delays are computed before the calls are numbered, so that they are computed
    once and two numbers move on instead of four timestamps; calls that are met
    are dealt by journey before they are gathered.
    """
    found = resolved.select("journey", "trip_id")
    placed = link.resolve_stop(calls.join(found, "journey"), feed, "stop_ref").where("stop_id <> ''")
    late = placed.select(
        "journey",
        "trip_id",
        "stop_id",
        "position",
        fn.delay(F.col("expected_arrival"), F.col("aimed_arrival")).alias("arrival_delay"),
        fn.delay(F.col("expected_departure"), F.col("aimed_departure")).alias("departure_delay"),
    )
    timed = link.nth_occurrence(late, feed, "journey").where("arrival_delay is not null or departure_delay is not null")
    call = F.struct("stop_sequence", "stop_id", "arrival_delay", "departure_delay")
    updates = timed.select("journey", call.alias("call")).repartition("journey").groupBy("journey").agg(F.sort_array(F.collect_list("call")).alias("stop_time_updates"))
    known = found.join(feed.trip().select("trip_id", "route_id", "direction_id"), "trip_id")
    out = journeys.join(known, "journey").join(updates, "journey")
    at = F.coalesce(fn.epoch(F.col("recorded_at")), header if header is not None else F.lit(0).cast("long"))
    return out.select(
        fn.entity_id(F.col("journey_ref"), F.col("line_ref"), F.col("origin_departure")).alias("entity_id"), "journey", "trip_id", "route_id", "direction_id",
        fn.plain_date(F.coalesce("date", F.lit(""))).alias("start_date"), at.alias("timestamp"), "stop_time_updates",
    )


def times_do_not_fall(updates: Column) -> Column:
    """Whether absolute times of a list of calls never go back; updates that
    hold delays alone have none, and pass."""
    times = F.flatten(F.transform(updates, lambda u: F.filter(F.array(u["arrival_time"], u["departure_time"]), lambda t: t.isNotNull())))
    start = F.struct(F.lit(None).cast("long").alias("last"), F.lit(True).alias("ok"))
    return F.aggregate(times, start, lambda a, t: F.struct(t.cast("long").alias("last"), (a["ok"] & F.coalesce(t >= a["last"], F.lit(True))).alias("ok")))["ok"]


def alerts(situations: DataFrame, stops: DataFrame, lines: DataFrame, feed: Feed, codes: DataFrame | None = None) -> DataFrame:
    """Alerts with periods, informed entities (stops, then routes) and texts.

    ``situations``: situation, cause, condition, severity (of the first
    consequence, null without one), periods and reasons as parsed arrays.
    ``stops``: situation, position, stop_ref. ``lines``: situation, position,
    line_ref, line_name. An alert without an informed entity stays.
    """
    ids = feed.stops.select(F.col("stop_id").alias("_stop")).distinct()
    bare = stops.withColumn("_stop", fn.strip_stop_prefix(F.col("stop_ref"))).join(ids, "_stop", "left_semi")
    informed = bare.select("situation", F.struct(F.lit(0).alias("kind"), F.col("position"), F.lit(0).cast("long").alias("n"), F.col("_stop").alias("id")).alias("e"))
    routes = link.all_routes(feed)
    one = link.public_code(lines, "line_ref", codes, "_c1")
    two = link.public_code(one, "line_name", codes, "_c2")
    has = routes.select("code").distinct()
    chosen = two.join(has.toDF("_has"), F.col("_c1") == F.col("_has"), "left").withColumn("code", F.when(F.col("_has").isNull(), F.col("_c2")).otherwise(F.col("_c1")))
    order = F.row_number().over(Window.partitionBy("situation", "position").orderBy("route_ord")).cast("long")
    by_line = chosen.join(routes, "code").select("situation", F.struct(F.lit(1).alias("kind"), F.col("position"), order.alias("n"), F.col("route_id").alias("id")).alias("e"))
    grouped = informed.union(by_line).groupBy("situation").agg(F.array_sort(F.collect_list("e")).alias("e"))
    entities = F.transform("e", lambda x: F.struct(F.when(x["kind"] == 0, x["id"]).alias("stop_id"), F.when(x["kind"] == 1, x["id"]).alias("route_id")))
    out = situations.join(grouped, "situation", "left")
    empty = F.array().cast("array<struct<stop_id:string,route_id:string>>")
    return out.select(
        F.col("situation").alias("entity_id"), fn.cause(F.col("cause")).alias("cause"),
        F.when(F.col("condition").isNotNull(), fn.effect(F.col("condition"))).alias("effect"), F.when(F.col("severity").isNotNull(), fn.severity(F.col("severity"))).alias("severity_level"),
        F.transform("periods", lambda p: F.struct(fn.epoch(p["StartTime"]).alias("start"), fn.epoch(p["EndTime"]).alias("end"))).alias("active_period"),
        F.coalesce(entities, empty).alias("informed_entity"),
        F.transform("reasons", lambda r: F.struct(r["text"].alias("text"), fn.language(r["lang"]).alias("language"))).alias("header_text"),
    )


def audit(updates: DataFrame, feed: Feed, dates: DataFrame) -> DataFrame:
    """Checks of trip updates: one row of counts. The updates are written once, as
    their calls and their heads are counted apart."""
    updates = kept(updates.select("journey", "trip_id", "direction_id", "start_date", "stop_time_updates"))
    by_seq = Window.partitionBy("journey").orderBy("i")
    flat = updates.select("journey", "trip_id", "direction_id", "start_date", F.posexplode("stop_time_updates").alias("i", "u"))
    flat = flat.withColumn("last", F.lag("u.stop_sequence").over(by_seq))
    at = feed.stop_times.select("trip_id", F.col("stop_id").alias("_s")).distinct()
    calls = flat.join(at, (flat["trip_id"] == at["trip_id"]) & (F.col("u.stop_id") == F.col("_s")), "left").agg(
        F.count("*").alias("calls"),
        F.count_if(F.col("_s").isNull()).alias("stop_not_on_trip"),
        F.count_if(F.abs(F.coalesce("u.arrival_delay", "u.departure_delay")) > 3600).alias("large_delays"),
        F.count_if(F.col("u.stop_sequence") == F.col("last")).alias("repeated_sequences"),
        F.count_if(F.col("u.stop_sequence") < F.col("last")).alias("unsorted"),
    )
    trips = feed.trip().select("trip_id", F.col("direction_id").alias("_d"), "service_id", F.lit(True).alias("_trip"))
    active = dates.select(F.col("date"), "service_id", F.lit(True).alias("_on"))
    heads = updates.join(trips, "trip_id", "left").withColumn("date", fn.gtfs_date(F.col("start_date"))).join(active, ["date", "service_id"], "left").agg(
        F.count("*").alias("updates"),
        F.count_if(F.col("_trip").isNull()).alias("unknown_trips"),
        F.count_if(F.col("_d") != F.col("direction_id")).alias("direction_mismatches"),
        F.count_if(F.col("_on").isNull()).alias("inactive_trips"),
    )
    return heads.crossJoin(F.broadcast(calls))  # one row each
