"""Record linkage: live references to lines, stops and trips.

Matches within a tolerance are equi-joins on the stop or line and a bucket of
time as wide as the tolerance, so a row meets only what is near it in time; what
does not run on the dates asked about is dropped before. Ties go to the first in
file order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..schemas import WEEKDAYS
from ..session import kept
from .feed import Feed
from .rows import first_of, last_of

#: Seconds within which a start or a visit may match.
START_TOLERANCE, VISIT_TOLERANCE = 120, 600
REWRITTEN = "it:22021:"


# --- timetable chain ---------------------------------------------------------


def keyed(entities: DataFrame, key: str = "id", order: str = "_ord") -> DataFrame:
    """Entities under their id and their id without one trailing colon; the
    last one of a key counts. Rows without an id cannot be found."""
    both = entities.where(F.col(key) != "").withColumn("_key", F.explode(F.array_distinct(F.array(F.col(key), fn.trim_colon(F.col(key))))))
    return last_of(both, ["_key"], [order])


def line_public_codes(lines: DataFrame) -> DataFrame:
    """(_key, public_code) of lines that have a public code."""
    return keyed(lines.where("public_code <> ''")).select("_key", "public_code")


def line_chain(journeys: DataFrame, patterns: DataFrame, routes: DataFrame, lines: DataFrame) -> DataFrame:
    """Journey id to line: (journey_id, line_id, public_code, direction).

    Inner at each hop. References meet ids as written or less one colon; the
    direction is the suffix of the route's direction reference. Lines without
    a public code resolve nothing.
    """
    p = keyed(patterns).select(F.col("_key").alias("journey_pattern_ref"), "route_ref")
    r = keyed(routes).select(F.col("_key").alias("route_ref"), F.col("line_ref").alias("_line"), "direction_ref")
    n = keyed(lines).where("public_code <> ''").select(F.col("_key").alias("_line"), F.col("id").alias("line_id"), "public_code")
    found = journeys.select(F.col("id").alias("journey_id"), "journey_pattern_ref").join(p, "journey_pattern_ref").join(r, "route_ref").join(n, "_line")
    return found.select("journey_id", "line_id", "public_code", fn.direction_suffix(F.col("direction_ref")).alias("direction"))


def journeys_by_base(journeys: DataFrame) -> DataFrame:
    """(base, journey_id): the last journey of each base key."""
    based = journeys.withColumn("base", fn.journey_base(F.col("id"))).where("base <> ''")
    return last_of(based, ["base"]).select("base", F.col("id").alias("journey_id"))


# --- lines and stops -----------------------------------------------------------


def public_code(df: DataFrame, ref: str, codes: DataFrame | None, out: str = "code") -> DataFrame:
    """``df`` with the public code of a line reference: looked up (as written,
    then less one colon) if it holds a colon, itself otherwise."""
    if codes is None:
        return df.withColumn(out, F.when(F.instr(ref, ":") > 0, F.lit("")).otherwise(F.coalesce(ref, F.lit(""))))
    exact = codes.select(F.col("_key").alias("_exact"), F.col("public_code").alias("_a"))
    less = codes.select(F.col("_key").alias("_less"), F.col("public_code").alias("_b"))
    joined = df.join(exact, F.col(ref) == F.col("_exact"), "left").join(less, fn.trim_colon(F.col(ref)) == F.col("_less"), "left")
    found = F.when(F.instr(ref, ":") > 0, F.coalesce("_a", "_b", F.lit(""))).otherwise(F.coalesce(ref, F.lit("")))
    return joined.withColumn(out, found).drop("_exact", "_less", "_a", "_b")


def first_route(feed: Feed) -> DataFrame:
    """(code, route_id): the first route of each short name."""
    named = feed.routes.where("route_short_name <> ''").select(F.col("route_short_name").alias("code"), "route_id", "_ord")
    return first_of(named, ["code"], ["_ord"]).select("code", "route_id")


def all_routes(feed: Feed) -> DataFrame:
    """(code, route_id, route_ord) of all routes with a short name."""
    return feed.routes.where("route_short_name <> ''").select(F.col("route_short_name").alias("code"), "route_id", F.col("_ord").alias("route_ord"))


def resolve_route(df: DataFrame, feed: Feed, ref: str, name: str, codes: DataFrame | None = None) -> DataFrame:
    """``df`` with ``code`` and ``route_id`` of the line reference, else of the
    published name if that is set and another one; ``via_name`` says which."""
    routes = first_route(feed)
    one = public_code(df, ref, codes, "_code1")
    two = public_code(one, name, codes, "_code2")
    joined = two.join(routes.toDF("_code1", "_route1"), "_code1", "left").join(routes.toDF("_code2", "_route2"), "_code2", "left")
    use = F.col("_route1").isNull() & (F.coalesce(name, F.lit("")) != "") & ~F.col(name).eqNullSafe(F.col(ref))
    out = joined.withColumn("via_name", use).withColumn("route_id", F.when(use, F.col("_route2")).otherwise(F.col("_route1")))
    return out.withColumn("code", F.when(use, F.col("_code2")).otherwise(F.col("_code1"))).drop("_code1", "_code2", "_route1", "_route2")


def resolve_stop(df: DataFrame, feed: Feed, ref: str, out: str = "stop_id") -> DataFrame:
    """``df`` with the stop of a live reference: as written, in lower case, or
    with the timetable prefix rewritten; empty if none exists."""
    ids = feed.stops.select("stop_id").distinct()
    rewritten = F.when(F.startswith(ref, F.lit(fn.STOP_POINT)), F.concat(F.lit(REWRITTEN), fn.strip_stop_prefix(F.col(ref))))
    joined = df
    for k, probe in enumerate((F.col(ref), F.lower(ref), rewritten)):
        joined = joined.join(ids.toDF(f"_s{k}"), probe == F.col(f"_s{k}"), "left")
    return joined.withColumn(out, F.coalesce("_s0", "_s1", "_s2", F.lit(""))).drop("_s0", "_s1", "_s2")


# --- nearest trips ----------------------------------------------------------------


def first_departures(feed: Feed) -> DataFrame:
    """(trip_id, first_sec): when each trip leaves its first stop, or reaches it
    where no departure is set; trips with neither are left out. A published feed
    holds the answer."""
    if "starts" in feed.tables:
        return feed.starts
    first = first_of(feed.stop_times, ["trip_id"], ["stop_sequence", "_ord"])
    at = F.when(F.col("departure_time") != fn.UNSET_TIME, F.col("departure_time")).otherwise(F.col("arrival_time"))
    return first.select("trip_id", at.alias("first_sec")).where(F.col("first_sec") != fn.UNSET_TIME)


def bucketed(df: DataFrame, at: str, width: int, around: int = 0) -> DataFrame:
    """``df`` with ``_bucket``, the bucket of ``width`` seconds that ``at`` falls
    in; with ``around``, a row for each bucket within so many seconds of it."""
    bucket = lambda c: F.floor(c / width).cast("int")
    if not around:
        return df.withColumn("_bucket", bucket(F.col(at)))
    return df.withColumn("_bucket", F.explode(F.sequence(bucket(F.col(at) - around), bucket(F.col(at) + around))))


def nearest_start(journeys: DataFrame, feed: Feed, dates: DataFrame, tolerance: int = START_TOLERANCE, key: str = "journey") -> DataFrame:
    """(key, trip_id, diff): the active trip of the journey's line that starts
    nearest to its clock time.

    ``journeys``: key, code, direction_id, clock (seconds), date. ``dates``:
    (date, service_id) of running services. If no candidate of the line has
    the direction all are taken; that is decided before the times are compared.
    Ties go to the first route, then the first trip, in file order.
    """
    trips = feed.trips.select("trip_id", "route_id", "service_id", F.col("direction_id").alias("trip_direction"), F.col("_ord").alias("trip_ord"))
    wanted = journeys.where("code <> ''").select(key, "code", "direction_id", "clock", "date")
    lines = wanted.select("code", "date").distinct().join(all_routes(feed), "code").join(trips, "route_id").join(dates, ["date", "service_id"])
    with_direction = lines.select("code", "date", F.col("trip_direction").alias("direction_id")).distinct().withColumn("_has", F.lit(True))
    width = max(tolerance, 1)
    starts = bucketed(lines.join(first_departures(feed), "trip_id"), "first_sec", width)
    asked = bucketed(wanted.join(with_direction, ["code", "date", "direction_id"], "left").where("clock is not null"), "clock", width, tolerance)
    near = F.abs(F.col("first_sec") - F.col("clock"))
    pairs = asked.join(starts, ["code", "date", "_bucket"]).where((near <= tolerance) & (F.col("_has").isNull() | (F.col("trip_direction") == F.col("direction_id"))))
    return first_of(pairs.select(key, "trip_id", near.cast("int").alias("diff"), "route_ord", "trip_ord"), [key], ["diff", "route_ord", "trip_ord"]).select(key, "trip_id", "diff")


def visit_candidates(visits: DataFrame, feed: Feed, dates: DataFrame | None, tolerance: int, key: str) -> DataFrame:
    """Active stop times at the visit's stop within the tolerance, with ``diff``."""
    trips = feed.trip().select("trip_id", "route_id", "service_id", F.col("direction_id").alias("trip_direction"))
    on = ["stop_id", "_bucket"]
    if dates is not None:
        trips, on = trips.join(dates, "service_id"), [*on, "date"]
    trips = trips.join(feed.route().select("route_id", "route_short_name"), "route_id", "left")
    at = F.when(F.col("arrival_time") != fn.UNSET_TIME, F.col("arrival_time")).otherwise(F.col("departure_time"))
    times = feed.stop_times.select("stop_id", "trip_id", at.alias("at_sec"), F.col("_ord").alias("time_ord")).where(F.col("at_sec") != fn.UNSET_TIME)
    width = max(tolerance, 1)
    running_times = bucketed(times.join(trips, "trip_id"), "at_sec", width)
    asked = bucketed(visits.where("clock is not null"), "clock", width, tolerance)
    near = F.abs(F.col("at_sec") - F.col("clock"))
    pairs = asked.join(running_times, on).where((near <= tolerance) & ((F.col("code") == "") | (F.col("code") == F.col("route_short_name"))))
    return pairs.withColumn("diff", near.cast("int"))


def folded(candidates: DataFrame, key: str) -> DataFrame:
    """(key, trip_id): what a scan of the candidates in file order ends with.

    A candidate replaces the one held if its score (1 / (1 + diff), half more
    in the right direction) exceeds 1 / (1 + held diff), or its diff is less.
    That depends on the order and is not the best score, so it is a fold, over
    the times at one stop within twice the tolerance.
    """
    item = F.struct(F.col("time_ord"), F.col("diff").cast("double").alias("diff"), (F.col("trip_direction") == F.col("direction_id")).alias("right"), "trip_id")
    grouped = candidates.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("c"))
    start = F.struct(F.lit(999999.0).alias("diff"), F.lit("").alias("trip_id"))

    def step(held: Column, x: Column) -> Column:
        score = 1.0 / (1.0 + x["diff"]) * F.when(x["right"], 1.5).otherwise(1.0)
        taken = (score > 1.0 / (1.0 + held["diff"])) | (x["diff"] < held["diff"])
        return F.struct(F.when(taken, x["diff"]).otherwise(held["diff"]).alias("diff"), F.when(taken, x["trip_id"]).otherwise(held["trip_id"]).alias("trip_id"))

    return grouped.select(key, F.aggregate("c", start, step)["trip_id"].alias("trip_id")).where("trip_id <> ''")


def nearest_visit(visits: DataFrame, feed: Feed, dates: DataFrame | None, tolerance: int = VISIT_TOLERANCE, key: str = "visit") -> DataFrame:
    """(key, trip_id) of ``visits``: key, stop_id, code, direction_id, clock, date."""
    return folded(visit_candidates(visits, feed, dates, tolerance, key), key)


def nearest_by_journey(refs: DataFrame, journeys: DataFrame, chain: DataFrame, departures: DataFrame, feed: Feed, dates: DataFrame, key: str = "journey") -> DataFrame:
    """Phase A: a live journey reference through the timetable chain.

    ``refs``: key, ref, date. ``departures``: (journey_id, clock) of journeys.
    The direction is the timetable's, not the live one. What the chain finds is
    written once, as ``nearest_start`` reads it three times.
    """
    based = refs.withColumn("base", fn.live_journey_base(F.col("ref"))).where("base <> ''").join(journeys_by_base(journeys), "base")
    found = based.join(chain, "journey_id").join(departures, "journey_id")
    wanted = found.select(key, F.col("public_code").alias("code"), fn.timetable_direction(F.col("direction")).alias("direction_id"), "clock", "date")
    return nearest_start(kept(wanted), feed, dates, key=key)


def in_turn(rows: DataFrame, first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """``rows`` with the trip of the first phase, else of the second; ``phase``
    is A, B or null."""
    a = first.select(key, F.col("trip_id").alias("_a"))
    b = second.select(key, F.col("trip_id").alias("_b"))
    joined = rows.join(a, key, "left").join(b, key, "left")
    return joined.withColumn("trip_id", F.coalesce("_a", "_b")).withColumn("phase", F.when(F.col("_a").isNotNull(), "A").when(F.col("_b").isNotNull(), "B")).drop("_a", "_b")


def running(feed: Feed, dates: list[int]) -> DataFrame:
    """(date, service_id) of the services that run on some dates."""
    parts = [feed.active_services(d).select(F.lit(d).alias("date"), "service_id") for d in dates]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def running_on_any(feed: Feed, dates: DataFrame) -> DataFrame:
    """The same for the dates of a DataFrame with a column ``date``."""
    days = dates.select("date").where(F.col("date") != fn.UNSET_DATE).distinct()
    exceptions = first_of(feed.calendar_dates.join(days, "date"), ["date", "service_id"], ["_ord"]).select("date", "service_id", "exception_type")
    week = F.filter(F.array(*[F.when(F.col(day), F.lit(k)) for k, day in enumerate(WEEKDAYS)]), lambda k: k.isNotNull())
    ranges = feed.calendar_for_service().select("service_id", "start_date", "end_date", F.explode(week).alias("weekday"))
    asked = days.withColumn("weekday", fn.weekday(F.col("date")).cast("int"))
    regular = ranges.join(asked, "weekday").where(F.col("date").between(F.col("start_date"), F.col("end_date"))).select("date", "service_id")
    by_rule = regular.join(exceptions, ["date", "service_id"], "left_anti")
    return by_rule.union(exceptions.where("exception_type = 1").select("date", "service_id"))


def occurrences(times: DataFrame) -> DataFrame:
    """Stop times with ``nth``, the how manieth time the trip is at the stop."""
    return times.withColumn("nth", F.row_number().over(Window.partitionBy("trip_id", "stop_id").orderBy("stop_sequence", "_ord")))


def nth_occurrence(calls: DataFrame, feed: Feed, key: str, position: str = "position") -> DataFrame:
    """Calls joined with the trip's stop times: the n-th call at a stop with
    the n-th time the trip is there. ``calls``: key, trip_id, stop_id, position.
    The stop times of a published feed are numbered already, and lie by trip."""
    asked = calls.withColumn("nth", F.row_number().over(Window.partitionBy(key, "stop_id").orderBy(position)))
    published = "nth" in feed.stop_times.columns
    there = (feed.stop_times if published else occurrences(feed.stop_times)).select("trip_id", "stop_id", "nth", "stop_sequence")
    if not published:
        return asked.join(there, ["trip_id", "stop_id", "nth"]).drop("nth")
    # the trip alone is to be the key of the join, as it is of the buckets: an equality that needs both sides is none
    calls_of = asked.withColumnsRenamed({"stop_id": "_stop", "nth": "_nth"})
    same = lambda a, b: F.greatest(a, b) == F.least(a, b)
    met = calls_of.join(there, "trip_id").where(same("nth", "_nth") & same("stop_id", "_stop"))
    return met.drop("_stop", "_nth", "nth")


def counts_of_phases() -> list[Column]:
    """Journeys resolved by phase, and the share unresolved in percent."""
    n = F.count("*")
    none = F.count_if(F.col("phase").isNull())
    return [
        n.alias("journeys"), F.count_if(F.col("phase") == "A").alias("phase_a"), F.count_if(F.col("phase") == "B").alias("phase_b"), none.alias("unresolved"),
        F.round(100.0 * none / n, 6).alias("unresolved_percent"),
    ]


def statistics(resolved: DataFrame) -> DataFrame:
    """``counts_of_phases`` as a row, by a pass of its own."""
    return resolved.agg(*counts_of_phases())


def observed(resolved: DataFrame) -> tuple[DataFrame, Observation]:
    """``resolved`` as it is, and its ``counts_of_phases``, which are there when
    the rows have been used: they cost no second linkage."""
    seen = Observation()
    return resolved.observe(seen, *counts_of_phases()), seen
