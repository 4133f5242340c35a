"""Queries on a timetable: lookups, traversals, calendars, searches, counts.

Every table carries ``_ord``, the order of its file, which decides ties.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..schemas import WEEKDAYS
from .rows import best, first_of, last_of

Score = Callable[[DataFrame], Column]


#: The key by which rows of a table are looked up.
KEYS = {"stops": "stop_id", "routes": "route_id", "trips": "trip_id", "calendar": "service_id"}


class Feed:
    """Timetable tables as DataFrames; absent ones are None.

    ``unique`` names tables that hold each key once, as published snapshots do:
    lookups of these need no aggregate to find the last row of a key.
    """

    def __init__(self, unique: Collection[str] = (), **tables: DataFrame | None):
        self.tables = {k: v for k, v in tables.items() if v is not None}
        self.unique = frozenset(unique)

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["tables"][name]
        except KeyError:
            raise AttributeError(f"the feed has no table {name!r}") from None

    # --- lookups ---------------------------------------------------------

    def _by_id(self, table: str, *ids: str) -> DataFrame:
        df, key = getattr(self, table), KEYS[table]
        found = df.where(F.col(key).isin(*ids)) if ids else df
        return found if table in self.unique else last_of(found, [key])

    def stop(self, *ids: str) -> DataFrame:
        """Stops by id, all without ids; the last row of an id counts."""
        return self._by_id("stops", *ids)

    def route(self, *ids: str) -> DataFrame:
        return self._by_id("routes", *ids)

    def trip(self, *ids: str) -> DataFrame:
        return self._by_id("trips", *ids)

    def calendar_for_service(self, *ids: str) -> DataFrame:
        return self._by_id("calendar", *ids)

    def exceptions_for_service(self, service_id: str) -> DataFrame:
        return self.calendar_dates.where(F.col("service_id") == service_id)

    def routes_by_short_name(self, name: str) -> DataFrame:
        """Case counts; an empty name finds nothing."""
        return self.routes.where((F.col("route_short_name") == name) & (F.col("route_short_name") != ""))

    def stops_by_name(self, name: str) -> DataFrame:
        """Case does not count."""
        return self.stops.where(F.lower("stop_name") == name.lower())

    # --- traversals ------------------------------------------------------------

    def stop_times_for_trip(self, trip_id: str) -> DataFrame:
        return self.stop_times.where(F.col("trip_id") == trip_id).orderBy("stop_sequence", "_ord")

    def stop_times_at_stop(self, stop_id: str) -> DataFrame:
        return self.stop_times.where(F.col("stop_id") == stop_id).orderBy("_ord")

    def trips_for_route(self, route_id: str) -> DataFrame:
        return self.trips.where(F.col("route_id") == route_id).orderBy("_ord")

    def trips_for_service(self, service_id: str) -> DataFrame:
        return self.trips.where(F.col("service_id") == service_id).orderBy("_ord")

    def child_stops(self, parent_id: str | None = None) -> DataFrame:
        """(parent_id, child_id, child_name), of one station or all."""
        children = self.stops.where("parent_station <> ''")
        if parent_id is not None:
            children = children.where(F.col("parent_station") == parent_id)
        parents = self.stop().select(F.col("stop_id").alias("parent_id"))
        return children.join(parents, F.col("parent_station") == F.col("parent_id")).select("parent_id", F.col("stop_id").alias("child_id"), F.col("stop_name").alias("child_name"))

    # --- calendars ----------------------------------------------------------

    def service_runs(self, date: int) -> DataFrame:
        """(service_id, runs) of every service of either calendar table.

        The first exception of the date decides alone (1 runs, anything else
        does not); else the last calendar row, its range and weekday.
        """
        exceptions = first_of(self.calendar_dates.where(F.col("date") == date), ["service_id"], ["_ord"]).select("service_id", F.col("exception_type").alias("exception"))
        flag = F.element_at(F.array(*WEEKDAYS), fn.weekday(F.lit(date)) + 1)
        regular = self.calendar_for_service().select("service_id", (F.lit(date).between(F.col("start_date"), F.col("end_date")) & flag).alias("regular"))
        every = self.calendar.select("service_id").union(self.calendar_dates.select("service_id")).distinct()
        joined = every.join(exceptions, "service_id", "left").join(regular, "service_id", "left")
        return joined.select("service_id", F.coalesce(F.col("exception") == 1, F.col("regular"), F.lit(False)).alias("runs"))

    def active_services(self, date: int) -> DataFrame:
        return self.service_runs(date).where("runs").select("service_id")

    def active_trips(self, date: int) -> DataFrame:
        return self.trips.join(self.active_services(date), "service_id", "left_semi")

    def trips_for_line(self, name: str, date: int) -> DataFrame:
        """Active trips of all routes of a short name, in order of route, then trip."""
        routes = self.routes_by_short_name(name).select("route_id", F.col("_ord").alias("_route_ord"))
        return self.active_trips(date).join(routes, "route_id").orderBy("_route_ord", "_ord")

    # --- predicates and scores: functions of a DataFrame that give a Column ----

    def find_trips(self, predicate: Score) -> DataFrame:
        return self.trips.where(predicate(self.trips))

    def find_stops(self, predicate: Score) -> DataFrame:
        return self.stops.where(predicate(self.stops))

    def find_routes(self, predicate: Score) -> DataFrame:
        return self.routes.where(predicate(self.routes))

    def find_stop_times(self, predicate: Score) -> DataFrame:
        return self.stop_times.where(predicate(self.stop_times))

    def trips_with_stops(self) -> DataFrame:
        """Trips with ``stops``, their ordered stop times; an empty array if none."""
        item = F.struct("stop_sequence", "_ord", "stop_id", "arrival_time", "departure_time")
        stops = self.stop_times.groupBy("trip_id").agg(F.array_sort(F.collect_list(item)).alias("stops"))
        out = self.trips.join(stops, "trip_id", "left")
        kind = stops.schema["stops"].dataType
        return out.withColumn("stops", F.coalesce("stops", F.array().cast(kind)))

    def find_trips_where(self, predicate: Score) -> DataFrame:
        """Trips by a predicate that needs the ordered array of their stop times."""
        df = self.trips_with_stops()
        return df.where(predicate(df))

    def find_trips_by_calls(self, call: Score, predicate: Score) -> DataFrame:
        """Trips by a predicate on ``calls``, how many stop times they have, and
        ``found``, whether any of these fulfils ``call``: two numbers for each
        trip, which aggregate before the shuffle, and no array."""
        met = self.stop_times.groupBy("trip_id").agg(F.count("*").alias("calls"), F.bool_or(F.coalesce(call(self.stop_times), F.lit(False))).alias("found"))
        df = self.trips.join(met, "trip_id", "left").withColumn("calls", F.coalesce("calls", F.lit(0))).withColumn("found", F.coalesce("found", F.lit(False)))
        return df.where(predicate(df)).drop("calls", "found")

    def match_trip(self, score: Score) -> DataFrame:
        df = self.trips_with_stops()
        return best(df, score(df))

    def match_stop(self, score: Score) -> DataFrame:
        return best(self.stops, score(self.stops))

    @staticmethod
    def match_in(candidates: DataFrame, score: Score, keys: list[str], order: str = "_ord") -> DataFrame:
        return best(candidates, score(candidates), keys, order)

    # --- counts ---------------------------------------------------------------

    def table_counts(self) -> DataFrame:
        """(table, rows) of all tables."""
        parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in sorted(self.tables.items())]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def count_active_services(self, date: int) -> DataFrame:
        """Rows of ``calendar`` whose service runs: services that only have
        exceptions do not count, repeated rows do."""
        return self.calendar.join(self.active_services(date), "service_id", "left_semi").agg(F.count("*").alias("active_services"))

    def trips_per_line(self, date: int) -> DataFrame:
        """(route_short_name, active_trips); the empty name is a line too."""
        routes = self.route().select("route_id", "route_short_name")
        return self.active_trips(date).join(routes, "route_id").groupBy("route_short_name").agg(F.count("*").alias("active_trips"))

    def trips_per_route(self, name: str) -> DataFrame:
        """(route_id, trips) of all routes of a short name, zero kept."""
        counts = self.trips.groupBy("route_id").agg(F.count("*").alias("trips"))
        return self.routes_by_short_name(name).join(counts, "route_id", "left").select("route_id", "route_long_name", F.coalesce("trips", F.lit(0)).alias("trips"))

    def visits(self) -> DataFrame:
        """(stop_id, visits): stop times at each stop that has any."""
        return self.stop_times.groupBy("stop_id").agg(F.count("*").alias("visits"))

    # --- shows of an inspection -----------------------------------------------

    def head_and_tail(self, head: int = 3, tail: int = 2) -> DataFrame:
        """The first and last stops of every trip, with their place."""
        by = Window.partitionBy("trip_id")
        ranked = self.stop_times.withColumn("place", F.row_number().over(by.orderBy("stop_sequence", "_ord"))).withColumn("stops", F.count("*").over(by))
        return ranked.where((F.col("place") <= head) | (F.col("place") > F.col("stops") - tail)).select("trip_id", "place", "stops", "stop_id", "stop_sequence")

    def inspect_stop(self, *ids: str, most_children: int = 10, most_times: int = 5) -> DataFrame:
        """Stops with the number of children and visits, and lists of both
        where they are short."""
        children = self.child_stops()
        kids = children.groupBy("parent_id").agg(F.count("*").alias("children"))
        # lists are made only where they are short
        named = children.join(kids.where(F.col("children") <= most_children), "parent_id").groupBy("parent_id").agg(F.array_sort(F.collect_list("child_id")).alias("child_ids"))
        kids = kids.join(named, "parent_id", "left")
        visits = self.stop_times.groupBy("stop_id").agg(F.count("*").alias("visits"))
        few = self.stop_times.join(visits.where(F.col("visits") <= most_times), "stop_id").groupBy("stop_id").agg(F.array_sort(F.collect_list("trip_id")).alias("trip_ids"))
        out = self.stop(*ids).join(kids.withColumnRenamed("parent_id", "stop_id"), "stop_id", "left").join(visits, "stop_id", "left").join(few, "stop_id", "left")
        return out.select(
            "stop_id", "stop_name", F.coalesce("children", F.lit(0)).alias("children"), F.coalesce("visits", F.lit(0)).alias("visits"),
            F.array_join("child_ids", ",").alias("child_ids"), F.array_join("trip_ids", ",").alias("trip_ids"),
        )

    def inspect_trip(self, *ids: str) -> DataFrame:
        """Trips with their route and the names of their first and last stops."""
        trips = self.trip(*ids)
        routes = self.route().select("route_id", "route_short_name")
        named = self.stop().select("stop_id", "stop_name")
        shown = Feed(stop_times=self.stop_times.join(trips.select("trip_id"), "trip_id", "left_semi")).head_and_tail()
        shown = shown.join(named, "stop_id", "left").groupBy("trip_id").agg(
            F.first("stops").alias("stops"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.coalesce("stop_name", F.col("stop_id")).alias("n")))), lambda x: x["n"]), ",").alias("shown")
        )
        return trips.join(routes, "route_id", "left").join(shown, "trip_id", "left").select("trip_id", "route_short_name", "service_id", F.coalesce("stops", F.lit(0)).alias("stops"), "shown")
