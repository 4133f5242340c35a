"""Queries on the standard tables and their SQL, one for each operator that the
adapter relations can show. Columns have the same names and types in both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import linkage as link
from ..operators.feed import KEYS, Feed
from ..sources import netex, remote
from . import transforms
from .adapters import SQL, active_sql, feed, vehicles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
#: The date that queries ask about: a Monday.
DATE, MONDAY = 19980302, 0
#: A line and a stop that exist at every size.
LINE, STOP = "BUILDING-3", "3"


def query(name: str, sql: str | None, *ctes: str) -> Callable[[Query], Query]:
    """Registers a query; the SQL may use the relations of ``SQL`` and ``ctes``."""

    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = ", ".join([SQL, *ctes]) + "\n" + sql
        return f

    return register


def on_feed(name: str, sql: str, *ctes: str) -> Callable[[Callable[[Feed], DataFrame]], Query]:
    """The same for a function of the feed alone."""

    def register(f: Callable[[Feed], DataFrame]) -> Query:
        return query(name, sql, *ctes)(lambda spark, sf_dir: f(feed(spark, sf_dir)))

    return register


ACTIVE = active_sql(DATE, MONDAY)
ROUTE = ("route_id", "route_short_name", "route_long_name", "route_type")
TRIP = ("trip_id", "route_id", "service_id", "direction_id")
TIME = ("trip_id", "stop_id", "stop_sequence", "arrival_time")
STOPS = ("stop_id", "stop_name", "location_type", "parent_station")


# --- inspection ---------------------------------------------------------------


@on_feed("q05_active_on_date", "select route_short_name, count(*) as active_trips from trips join active using (service_id) join routes using (route_id) group by 1", ACTIVE)
def q05(f: Feed) -> DataFrame:
    return f.trips_per_line(DATE)


@on_feed("a01_table_counts", """select 'calendar' as "table", count(*) as rows from calendar union all select 'calendar_dates', count(*) from calendar_dates
union all select 'routes', count(*) from routes union all select 'stop_times', count(*) from stop_times
union all select 'stops', count(*) from stops union all select 'trips', count(*) from trips""")
def a01(f: Feed) -> DataFrame:
    return f.table_counts()


@on_feed("a02_active_services", "select count(*) as active_services from calendar join active using (service_id)", ACTIVE)
def a02(f: Feed) -> DataFrame:
    return f.count_active_services(DATE)


@on_feed("a03_a05_active_trips_and_lines", "select count(*) as active_trips, count(distinct route_short_name) as lines from trips join active using (service_id) join routes using (route_id)", ACTIVE)
def a03(f: Feed) -> DataFrame:
    return f.trips_per_line(DATE).agg(F.coalesce(F.sum("active_trips"), F.lit(0)).alias("active_trips"), F.count("*").alias("lines"))


@on_feed("a06_trips_per_route", f"""select route_id, route_long_name, count(trip_id) as trips from routes left join trips using (route_id)
where route_short_name = '{LINE}' group by 1, 2""")
def a06(f: Feed) -> DataFrame:
    return f.trips_per_route(LINE)


@on_feed("a07_visits", "select stop_id, count(*) as visits from stop_times group by 1")
def a07(f: Feed) -> DataFrame:
    return f.visits()


@on_feed("q02_inspect_stop", """select stop_id, stop_name, coalesce(children, 0) as children, coalesce(visits, 0) as visits,
  case when coalesce(children, 0) <= 10 then child_ids end as child_ids, case when visits <= 5 then trip_ids end as trip_ids from stops
left join (select parent_station as p, count(*) as children, string_agg(stop_id, ',' order by stop_id) as child_ids from stops where parent_station <> '' group by 1) k on p = stop_id
left join (select stop_id, count(*) as visits, string_agg(trip_id, ',' order by trip_id) as trip_ids from stop_times group by 1) v using (stop_id)""")
def q02(f: Feed) -> DataFrame:
    return f.inspect_stop()


@on_feed("q03_inspect_route", f"select route_id, route_long_name, count(trip_id) as trips from routes left join trips using (route_id) where route_short_name = '{LINE}' group by 1, 2 having count(trip_id) > 0")
def q03(f: Feed) -> DataFrame:
    return f.trips_per_route(LINE).where("trips > 0")


@on_feed("q04_inspect_trip", """select trip_id, route_short_name, service_id, coalesce(s.stops, 0) as stops, shown from trips left join routes using (route_id) left join (
  select trip_id, any_value(n)::bigint as stops, string_agg(coalesce(stop_name, stop_id), ',' order by place) as shown from (
    select trip_id, stop_id, row_number() over (partition by trip_id order by stop_sequence, ord) as place, count(*) over (partition by trip_id) as n from stop_times) t
  left join stops using (stop_id) where place <= 3 or place > n - 2 group by 1) s using (trip_id)""")
def q04(f: Feed) -> DataFrame:
    return f.inspect_trip()


@on_feed("l01_head_and_tail", """select * from (select trip_id, (row_number() over (partition by trip_id order by stop_sequence, ord))::int as place,
  count(*) over (partition by trip_id) as stops, stop_id, stop_sequence from stop_times) where place <= 3 or place > stops - 2""")
def l01(f: Feed) -> DataFrame:
    return f.head_and_tail()


# --- lookups ----------------------------------------------------------------


def doubled(f: Feed, table: str, changed: str) -> Feed:
    """The feed with more rows for each key of a table: an older one for all, and
    for every second a newer one, in which a column is changed."""
    df, key = getattr(f, table), KEYS[table]
    kind, order = dict(df.dtypes)[changed], dict(df.dtypes)["_ord"]
    value = lambda k: F.lit(k).cast(kind) if kind != "string" else F.concat(F.col(changed), F.lit(f"/{k}"))
    # before and after all others, by the kind of order that the table has
    place = lambda k: F.struct(F.lit(k * 9).alias("k"), F.col("_ord.n")) if order.startswith("struct") else F.concat(F.lit(" " if k < 0 else "~"), "_ord") if order == "string" else (F.col("_ord") + k * (1 << 40))
    older = df.withColumn(changed, value(-1)).withColumn("_ord", place(-1))
    newer = df.where(F.substring(key, -1, 1).isin(*"02468")).withColumn(changed, value(7)).withColumn("_ord", place(1))
    rows = newer.unionByName(df).unionByName(older)
    return Feed(**{t: rows if t == table else x for t, x in f.tables.items()})


EVEN = "right({}, 1) in ('0', '2', '4', '6', '8')"


@on_feed("p01_stop_by_id", f"select stop_id, stop_name || case when {EVEN.format('stop_id')} then '/7' else '' end as stop_name, location_type, parent_station from stops where stop_id in ('3', '4', 'N7', 'N8')")
def p01(f: Feed) -> DataFrame:
    """Of several rows of an id the last counts, here and in the next two."""
    return doubled(f, "stops", "stop_name").stop("3", "4", "N7", "N8").select(*STOPS)


@on_feed("p02_route_by_id", f"select route_id, route_short_name, route_long_name || case when {EVEN.format('route_id')} then '/7' else '' end as route_long_name, route_type from routes")
def p02(f: Feed) -> DataFrame:
    return doubled(f, "routes", "route_long_name").route().select(*ROUTE)


@on_feed("p03_trip_by_id", f"select trip_id, route_id, service_id, case when {EVEN.format('trip_id')} then 7 else direction_id end as direction_id from trips")
def p03(f: Feed) -> DataFrame:
    return doubled(f, "trips", "direction_id").trip().select(*TRIP)


@on_feed("p04_routes_by_short_name", f"select route_id, route_short_name, route_long_name, route_type from routes where route_short_name = '{LINE}'")
def p04(f: Feed) -> DataFrame:
    return f.routes_by_short_name(LINE).select(*ROUTE)


@on_feed("p05_stops_by_name", "select stop_id, stop_name, location_type, parent_station from stops where lower(stop_name) in (select lower(stop_name) from stops where stop_id = '3')")
def p05(f: Feed) -> DataFrame:
    name = f.stop("3").select("stop_name").first()
    return f.stops_by_name(name[0].upper() if name else "").select(*STOPS)


@on_feed("p06_calendar_for_service", f"select service_id, start_date, case when {EVEN.format('service_id')} then 7 else end_date end as end_date, (0 + p) % 3 <> 0 as monday from calendar")
def p06(f: Feed) -> DataFrame:
    return doubled(f, "calendar", "end_date").calendar_for_service().select("service_id", "start_date", "end_date", "monday")


@on_feed("p07_exceptions_for_service", "select date, exception_type, ord from calendar_dates where service_id = '1-URGENT|1997'")
def p07(f: Feed) -> DataFrame:
    return f.exceptions_for_service("1-URGENT|1997").select("date", "exception_type", F.col("_ord").alias("ord"))


@on_feed("p08_bulk_read", "select trip_id, route_id, service_id, direction_id from trips")
def p08(f: Feed) -> DataFrame:
    return f.trips.select(*TRIP)


@on_feed("p09_find_trips", "select trip_id, route_id, service_id, direction_id from trips where direction_id = 1 and service_id like '%1997'")
def p09(f: Feed) -> DataFrame:
    return f.find_trips(lambda t: (t["direction_id"] == 1) & F.endswith(t["service_id"], F.lit("1997"))).select(*TRIP)


@on_feed("p10_find_stops", "select stop_id, stop_name, location_type, parent_station from stops where location_type = 1")
def p10(f: Feed) -> DataFrame:
    return f.find_stops(lambda s: s["location_type"] == 1).select(*STOPS)


@on_feed("p11_find_routes", "select route_id, route_short_name, route_long_name, route_type from routes where route_type = 3")
def p11(f: Feed) -> DataFrame:
    return f.find_routes(lambda r: r["route_type"] == 3).select(*ROUTE)


@on_feed("p12_find_stop_times", "select trip_id, stop_id, stop_sequence, arrival_time from stop_times where arrival_time >= 86400")
def p12(f: Feed) -> DataFrame:
    return f.find_stop_times(lambda t: t["arrival_time"] >= 86400).select(*TIME)


@on_feed("p13_find_trips_where", f"""select trip_id, route_id, service_id, direction_id from trips where trip_id in (select trip_id from stop_times where stop_id = '{STOP}')
or trip_id not in (select trip_id from stop_times)""")
def p13(f: Feed) -> DataFrame:
    return f.find_trips_by_calls(lambda c: c["stop_id"] == STOP, lambda t: (t["calls"] == 0) | t["found"]).select(*TRIP)


@on_feed("a09_match_trip", """select trip_id, route_id, service_id, direction_id from (select t.*, n, row_number() over (order by n desc, ord) as k from trips t
join (select trip_id, count(*) as n from stop_times group by 1) using (trip_id)) where k = 1""")
def a09(f: Feed) -> DataFrame:
    return f.match_trip(lambda t: F.size(t["stops"])).select(*TRIP)


@on_feed("a10_match_stop", "select stop_id, stop_name, location_type, parent_station from stops where location_type = 0 order by length(stop_name) desc, ord limit 1")
def a10(f: Feed) -> DataFrame:
    return f.match_stop(lambda s: F.when(s["location_type"] == 0, F.length(s["stop_name"])).otherwise(0)).select(*STOPS)


@on_feed("a11_match_in_candidates", """select route_id, trip_id from (select *, row_number() over (partition by route_id order by score desc, ord) as k from (
  select *, 1.0 / (1 + abs(ord % 100 - 40)) as score from trips where ord % 100 between 20 and 60)) where k = 1""")
def a11(f: Feed) -> DataFrame:
    near = F.col("_ord") % 100
    return f.match_in(f.trips, lambda t: fn.proximity(near - 40, 20), ["route_id"]).select("route_id", "trip_id")


# --- traversals and calendars ------------------------------------------------------


@on_feed("jn01_stop_times_for_trip", "select trip_id, stop_id, stop_sequence, arrival_time from stop_times where trip_id = '7'")
def jn01(f: Feed) -> DataFrame:
    return f.stop_times_for_trip("7").select(*TIME)


@on_feed("jn02_stop_times_at_stop", f"select trip_id, stop_id, stop_sequence, arrival_time from stop_times where stop_id = '{STOP}'")
def jn02(f: Feed) -> DataFrame:
    return f.stop_times_at_stop(STOP).select(*TIME)


@on_feed("jn03_trips_for_route", "select trip_id, route_id, service_id, direction_id from trips where route_id = '7'")
def jn03(f: Feed) -> DataFrame:
    return f.trips_for_route("7").select(*TRIP)


@on_feed("jn04_trips_for_service", "select trip_id, route_id, service_id, direction_id from trips where service_id = '1-URGENT|1997'")
def jn04(f: Feed) -> DataFrame:
    return f.trips_for_service("1-URGENT|1997").select(*TRIP)


@on_feed("jn05_child_stops", "select c.parent_station as parent_id, c.stop_id as child_id, c.stop_name as child_name from stops c join stops p on c.parent_station = p.stop_id")
def jn05(f: Feed) -> DataFrame:
    return f.child_stops()


@on_feed("jn06_trips_for_line", f"select trip_id, route_id, service_id, direction_id from trips join active using (service_id) join routes using (route_id) where route_short_name = '{LINE}'", ACTIVE)
def jn06(f: Feed) -> DataFrame:
    return f.trips_for_line(LINE, DATE).select(*TRIP)


@on_feed("jn07_service_runs", """select service_id, service_id in (select service_id from active) as runs
from (select service_id from calendar union select service_id from calendar_dates)""", ACTIVE)
def jn07(f: Feed) -> DataFrame:
    return f.service_runs(DATE)


@on_feed("jn08_active_trips", "select trip_id, route_id, service_id, direction_id from trips join active using (service_id)", ACTIVE)
def jn08(f: Feed) -> DataFrame:
    return f.active_trips(DATE).select(*TRIP)


# --- timetable entities ------------------------------------------------------------


def timetable(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Journeys, patterns, routes and lines of a timetable, with and without
    colons at the ends of ids."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    colon = lambda key: F.when(F.col(key) % 2 == 0, ":").otherwise("")
    name = F.concat_ws("-", "c_mktsegment", "c_nationkey")
    lines = c.groupBy(name.alias("name"), "c_nationkey").agg(F.min("c_custkey").alias("_ord"))
    return {
        "journeys": o.select(
            F.concat(F.lit("it:apb:ServiceJourney:"), "o_orderkey", F.lit(":"), F.col("o_custkey") % 7, colon("o_orderkey")).alias("id"),
            F.concat(F.lit("JP:"), "o_custkey", colon("o_orderkey")).alias("journey_pattern_ref"), F.col("o_orderkey").alias("_ord"),
        ),
        "patterns": c.select(F.concat(F.lit("JP:"), "c_custkey", F.lit(":")).alias("id"), F.concat(F.lit("RT:"), "c_custkey").alias("route_ref"), F.col("c_custkey").alias("_ord")),
        "routes": c.select(
            F.concat(F.lit("RT:"), "c_custkey", colon("c_custkey")).alias("id"), F.concat(F.lit("LN:"), name).alias("line_ref"),
            F.concat(F.lit("d:"), F.when(F.col("c_custkey") % 2 == 0, "H").otherwise("R"), F.lit(":")).alias("direction_ref"), F.col("c_custkey").alias("_ord"),
        ),
        "lines": lines.select(F.concat(F.lit("LN:"), "name").alias("id"), F.when(F.col("c_nationkey") % 5 == 0, "").otherwise(F.col("name")).alias("public_code"), "_ord"),
    }


NETEX = """nj as (select 'it:apb:ServiceJourney:' || o_orderkey || ':' || (o_custkey % 7) || case when o_orderkey % 2 = 0 then ':' else '' end as id,
    'JP:' || o_custkey || case when o_orderkey % 2 = 0 then ':' else '' end as jp, o_orderkey as ord from orders),
nr as (select c_custkey, 'RT:' || c_custkey as id, 'LN:' || c_mktsegment || '-' || c_nationkey as line_id,
    case when c_nationkey % 5 = 0 then '' else c_mktsegment || '-' || c_nationkey end as public_code, case when c_custkey % 2 = 0 then 'H' else 'R' end as direction from customer)"""


@query("jn09_line_chain", """select nj.id as journey_id, line_id, public_code, direction from nj
join nr on rtrim(substr(jp, 4), ':') = nr.c_custkey::varchar where public_code <> ''""", NETEX)
def jn09(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = timetable(spark, sf_dir)
    return link.line_chain(t["journeys"], t["patterns"], t["routes"], t["lines"])


@query("jn10_journey_by_base", "select split_part(id, ':', 4) as base, id as journey_id from nj", NETEX)
def jn10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.journeys_by_base(timetable(spark, sf_dir)["journeys"])


@query("p19_journey_by_id", "select rtrim(id, ':') as key, id as journey_id from nj", NETEX)
def p19(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = link.keyed(timetable(spark, sf_dir)["journeys"])
    return found.where(~F.endswith("_key", F.lit(":"))).select(F.col("_key").alias("key"), F.col("id").alias("journey_id"))


@query("p20_line_public_code", "select distinct line_id as key, public_code from nr where public_code <> ''", NETEX)
def p20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.line_public_codes(timetable(spark, sf_dir)["lines"]).select(F.col("_key").alias("key"), "public_code")


def entity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(type, seq, fields, file) rows from nations, suppliers and customers."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    fields = lambda **kw: F.map_from_arrays(F.array(*[F.lit(k) for k in kw]), F.array(*[v.cast("string") for v in kw.values()])).alias("fields")
    col = F.col
    place = read("nation").select(F.lit("StopPlace").alias("type"), col("n_nationkey").cast("long").alias("seq"), fields(id=col("n_nationkey"), name=col("n_name")), F.lit("a").alias("file"))
    quay = read("supplier").select(F.lit("Quay").alias("type"), col("s_suppkey").alias("seq"), fields(id=col("s_suppkey"), stop_place_id=col("s_nationkey"), name=col("s_name")), F.lit("b").alias("file"))
    line = read("customer").select(F.lit("Line").alias("type"), col("c_custkey").alias("seq"), fields(id=col("c_custkey") % 100, name=col("c_name"), public_code=col("c_mktsegment")), F.lit("c").alias("file"))
    return place.union(quay).union(line)


@query("p14_p18_entity_table", "select s_suppkey::varchar as id, s_nationkey::varchar as stop_place_id, s_name as name, '' as quay_type from supplier")
def p18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netex.table(entity_rows(spark, sf_dir), "Quay").select("id", "stop_place_id", "name", "quay_type")


@query("p15_entity_by_id", "select c_name as name from customer where c_custkey % 100 = 7 order by c_custkey desc limit 1")
def p15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netex.get(entity_rows(spark, sf_dir), "Line", "7").select(F.col("fields")["name"].alias("name"))


@query("p16_all_of_type", "select n_nationkey::bigint as seq, n_name as name from nation")
def p16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_rows(spark, sf_dir).where("type = 'StopPlace'").select("seq", F.col("fields")["name"].alias("name"))


@query("p17_types_present", "select 'Line' as type from customer union select 'Quay' from supplier union select 'StopPlace' from nation")
def p17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netex.types_present(entity_rows(spark, sf_dir))


@query("k03_rows_per_type", "select 'Line' as type, count(*) as rows from customer union all select 'Quay', count(*) from supplier union all select 'StopPlace', count(*) from nation")
def k03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return netex.counts(entity_rows(spark, sf_dir))


# --- linkage ----------------------------------------------------------------


def live_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as live journeys: a line reference that exists for even events,
    a published name for the rest."""
    events = vehicles(spark, sf_dir)
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("string").alias("vehicle_ref"), F.concat_ws("-", "c_mktsegment", "c_nationkey").alias("line"))
    out = events.join(c, "vehicle_ref")
    return out.withColumn("line_ref", F.when(F.col("_ord") % 2 == 0, F.col("line")).otherwise("unknown")).withColumn("line_name", F.when(F.col("_ord") % 3 == 0, "").otherwise(F.col("line")))


LIVE = """live as (
  select v.*, c_mktsegment || '-' || c_nationkey as line, case when v.ord % 2 = 0 then c_mktsegment || '-' || c_nationkey else 'unknown' end as line_ref,
    case when v.ord % 3 = 0 then '' else c_mktsegment || '-' || c_nationkey end as line_name,
    (extract(hour from ts) * 3600 + extract(minute from ts) * 60 + floor(extract(second from ts)))::int as wall,
    ((extract(hour from ts) * 3600 + extract(minute from ts) * 60 + floor(extract(second from ts)))::int - delay_sec + 864000) % 86400 as clock
  from vehicles v join customer on vehicle_ref = c_custkey::varchar)"""
FIRST_ROUTE = "first_route as (select route_short_name as code, arg_min(route_id, ord) as route_id from routes where route_short_name <> '' group by 1)"


@query("jn11_first_route", "select code, route_id from first_route", FIRST_ROUTE)
def jn11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.first_route(feed(spark, sf_dir))


@query("jn12_all_routes", "select route_short_name as code, route_id from routes")
def jn12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.all_routes(feed(spark, sf_dir)).select("code", "route_id")


@query("jn13_public_code", """select c_custkey, case when c_custkey % 3 = 0 then c_mktsegment || '-' || c_nationkey when c_nationkey % 5 = 0 then ''
  else c_mktsegment || '-' || c_nationkey end as code from customer""")
def jn13(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    name = F.concat_ws("-", "c_mktsegment", "c_nationkey")
    ref = F.when(F.col("c_custkey") % 3 == 0, name).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("LN:"), name)).otherwise(F.concat(F.lit("LN:"), name, F.lit(":")))
    return link.public_code(c.select("c_custkey", ref.alias("ref")), "ref", link.line_public_codes(timetable(spark, sf_dir)["lines"])).select("c_custkey", "code")


@query("jn14_resolve_route", """select l.ord, coalesce(a.route_id, case when line_name <> '' and line_name <> line_ref then b.route_id end) as route_id,
  a.route_id is null and line_name <> '' and line_name <> line_ref as via_name
from live l left join first_route a on a.code = line_ref left join first_route b on b.code = line_name""", LIVE, FIRST_ROUTE)
def jn14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.resolve_route(live_lines(spark, sf_dir), feed(spark, sf_dir), "line_ref", "line_name").select(F.col("_ord").alias("ord"), "route_id", "via_name")


def starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = live_lines(spark, sf_dir)
    return rows.select(F.col("_ord").alias("journey"), F.col("line").alias("code"), "direction_id", fn.wall_clock(F.col("recorded_at")).alias("clock"), F.lit(DATE).alias("date"))


STARTS = """first_stop as (select trip_id, arg_min(arrival_time, row(stop_sequence, ord)) as first_sec from stop_times group by 1),
on_line as (select route_short_name as code, r.ord as route_ord, t.ord as trip_ord, trip_id, direction_id from routes r join trips t using (route_id) join active using (service_id)),
asked as (select l.ord as journey, line as code, wall as clock, direction_id,
  exists (select 1 from on_line o where o.code = line and o.direction_id = l.direction_id) as has from live l),
started as (select journey, arg_min(trip_id, row(abs(first_sec - clock), route_ord, trip_ord)) as trip_id, min(abs(first_sec - clock))::int as diff
  from asked a join on_line o using (code) join first_stop using (trip_id)
  where abs(first_sec - clock) <= 120 and (not has or o.direction_id = a.direction_id) group by 1)"""


@query("jn15_jn17_nearest_start", "select journey, trip_id, diff from started", LIVE, ACTIVE, STARTS)
def jn17(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feed(spark, sf_dir)
    return link.nearest_start(starts(spark, sf_dir), f, link.running(f, [DATE]))


@query("jn15_phase_a", "select journey, trip_id, diff from started", ACTIVE, NETEX, STARTS[: STARTS.index("asked as")] + """asked as (
  select *, exists (select 1 from on_line o where o.code = j.code and o.direction_id = j.direction_id) as has from (
    select o_orderkey as journey, public_code as code, first_sec + o_orderkey % 200 as clock, case when direction = 'R' then 1 else 0 end as direction_id
    from orders join nr on o_custkey = c_custkey join first_stop on trip_id = o_orderkey::varchar where public_code <> '') j),
""" + STARTS[STARTS.index("started as") :])
def jn15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's journey, late by some seconds, through the timetable chain."""
    f, t = feed(spark, sf_dir), timetable(spark, sf_dir)
    chain = link.line_chain(t["journeys"], t["patterns"], t["routes"], t["lines"])
    refs = f.trips.select(F.col("_ord").alias("journey"), F.concat(F.lit("it:apb:ServiceJourney:"), "trip_id").alias("ref"), F.lit(DATE).alias("date"))
    known = t["journeys"].select(F.col("id").alias("journey_id"), F.col("_ord").cast("string").alias("trip_id"))
    departures = link.first_departures(f).join(known, "trip_id").select("journey_id", (F.col("first_sec") + F.col("trip_id").cast("long") % 200).cast("int").alias("clock"))
    return link.nearest_by_journey(refs, t["journeys"], chain, departures, f, link.running(f, [DATE]))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = live_lines(spark, sf_dir)
    clock = F.pmod(fn.wall_clock(F.col("recorded_at")) - F.col("delay_sec"), F.lit(86400))
    code = F.when(F.col("_ord") % 4 == 0, F.col("line")).otherwise("")
    return rows.select(F.col("_ord").alias("visit"), "stop_id", code.alias("code"), "direction_id", clock.alias("clock"), F.lit(DATE).alias("date"))


FOLD = """cand as (
  select l.ord as visit, s.ord as time_ord, abs(arrival_time - clock)::double as diff, t.direction_id = l.direction_id as dir, trip_id
  from live l join stop_times s using (stop_id) join trips t using (trip_id) join active using (service_id) left join routes using (route_id)
  where abs(arrival_time - clock) <= 600 and (l.ord % 4 <> 0 or route_short_name = line)),
fold as (select visit, list_reduce(list({'diff': diff, 'dir': dir, 'trip_id': trip_id} order by time_ord),
  lambda a, x: case when 1.0::double / (1 + x.diff) * (case when x.dir then 1.5::double else 1.0::double end) > 1.0::double / (1 + a.diff) or x.diff < a.diff then x else a end,
  {'diff': 999999.0::double, 'dir': false, 'trip_id': ''}).trip_id as trip_id from cand group by 1)"""


@query("jn16_nearest_visit", "select visit, trip_id from fold", LIVE, ACTIVE, FOLD)
def jn16(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feed(spark, sf_dir)
    return link.nearest_visit(visits(spark, sf_dir), f, link.running(f, [DATE]))


def both_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feed(spark, sf_dir)
    dates = link.running(f, [DATE])
    first = link.nearest_start(starts(spark, sf_dir), f, dates)
    second = link.nearest_visit(visits(spark, sf_dir), f, dates).withColumnRenamed("visit", "journey")
    rows = live_lines(spark, sf_dir).select(F.col("_ord").alias("journey"))
    return link.in_turn(rows, first, second, "journey")


@query("jn18_two_phases", """select l.ord as journey, coalesce(s.trip_id, f.trip_id) as trip_id, case when s.trip_id is not null then 'A' when f.trip_id is not null then 'B' end as phase
from live l left join started s on s.journey = l.ord left join fold f on f.visit = l.ord""", LIVE, ACTIVE, STARTS, FOLD)
def jn18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return both_phases(spark, sf_dir)


@query("a12_statistics", """select count(*) as journeys, count(s.trip_id) as phase_a, count(case when s.trip_id is null then f.trip_id end) as phase_b,
  count(*) filter (where s.trip_id is null and f.trip_id is null) as unresolved,
  round(100.0::double * count(*) filter (where s.trip_id is null and f.trip_id is null) / count(*), 6) as unresolved_percent
from live l left join started s on s.journey = l.ord left join fold f on f.visit = l.ord""", LIVE, ACTIVE, STARTS, FOLD)
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.statistics(both_phases(spark, sf_dir))


def trip_calls(f: Feed) -> DataFrame:
    """A call for each stop time, in reverse for odd trips."""
    n = F.row_number().over(Window.partitionBy("journey").orderBy("stop_sequence", "_ord"))
    numbered = f.stop_times.withColumn("journey", F.col("trip_id")).withColumn("n", n)
    odd = F.col("journey").cast("long") % 2 == 1
    return numbered.select("journey", "trip_id", "stop_id", F.when(odd, -F.col("n")).otherwise(F.col("n")).alias("position"), "arrival_time")


CALLS = """calls as (select trip_id, stop_id, arrival_time, case when trip_id::bigint % 2 = 1 then -n else n end as position from (
  select *, row_number() over (partition by trip_id order by stop_sequence, ord) as n from stop_times)),
nth as (select *, row_number() over (partition by trip_id, stop_id order by position) as k from calls),
there as (select trip_id, stop_id, stop_sequence, row_number() over (partition by trip_id, stop_id order by stop_sequence, ord) as k from stop_times)"""


@on_feed("jn19_nth_occurrence", "select trip_id, stop_id, position::int as position, stop_sequence from nth join there using (trip_id, stop_id, k)", CALLS)
def jn19(f: Feed) -> DataFrame:
    return link.nth_occurrence(trip_calls(f), f, "journey").select("trip_id", "stop_id", "position", "stop_sequence")


@query("jn20_resolve_stop", "select event_id, case when event_id % 3 = 0 and user_id % 100 not in (select s_suppkey from supplier) then '' when event_id % 3 = 1 then case when user_id % 25 in (select n_nationkey from nation) then 'N' || (user_id % 25) else '' end when event_id % 3 = 2 then '' else (user_id % 100)::varchar end as stop_id from events")
def jn20(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.col("event_id") % 3
    ref = F.when(k == 0, (F.col("user_id") % 100).cast("string")).when(k == 1, F.concat(F.lit("N"), F.col("user_id") % 25)).otherwise(F.concat(F.lit(fn.STOP_POINT), "user_id"))
    return link.resolve_stop(e.select("event_id", ref.alias("ref")), feed(spark, sf_dir), "ref").select("event_id", "stop_id")


@query("jn21_trip_attributes", "select ord as journey, route_id, direction_id from (select s.journey as ord, t.route_id, t.direction_id from started s join trips t using (trip_id))", LIVE, ACTIVE, STARTS)
def jn21(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feed(spark, sf_dir)
    found = link.nearest_start(starts(spark, sf_dir), f, link.running(f, [DATE]))
    return found.join(f.trip().select("trip_id", "route_id", "direction_id"), "trip_id").select("journey", "route_id", "direction_id")


# --- transforms -----------------------------------------------------------------


@query("a08_latest_per_vehicle", "select vehicle_ref, max(recorded_at) as recorded_at, arg_min(ord, row(-epoch(strptime(recorded_at, '%Y-%m-%dT%H:%M:%SZ')), ord)) as ord from vehicles group by 1")
def a08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.latest_per_vehicle(vehicles(spark, sf_dir)).select("vehicle_ref", "recorded_at", F.col("_ord").alias("ord"))


@query("t01_vehicle_positions", """select vehicle_ref as entity_id, trip_id, t.route_id, t.direction_id, '19980302' as start_date,
  case when s.stop_id is null then '' else s.stop_id end as stop_id, case when event_type = 'click' then 'STOPPED_AT' else 'IN_TRANSIT_TO' end as current_status,
  epoch(strptime(recorded_at, '%Y-%m-%dT%H:%M:%SZ'))::bigint as "timestamp"
from latest l join fold f on f.visit = l.ord join trips t using (trip_id) left join stops s on s.stop_id = l.stop_id""", LIVE, ACTIVE,
"latest as (select l.* from live l join (select vehicle_ref, arg_min(ord, row(-epoch(strptime(recorded_at, '%Y-%m-%dT%H:%M:%SZ')), ord)) as ord from live group by 1) using (vehicle_ref, ord))",
"first_route as (select route_short_name as code, arg_min(route_id, ord) as route_id from routes group by 1)",
"""coded as (select l.*, case when line_ref <> 'unknown' then line_ref else line_name end as code, l.direction_id as live_direction from latest l)""",
FOLD.replace("from live l", "from coded l").replace("(l.ord % 4 <> 0 or route_short_name = line)", "(l.code = '' or route_short_name = l.code)"))
def t01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events have a line reference without a code; some of these have no
    published name either, and meet the trips of every line."""
    rows = live_lines(spark, sf_dir).withColumn("line_ref", F.when(F.col("line_ref") == "unknown", "x:unknown").otherwise(F.col("line_ref")))
    activities = rows.select(
        "_ord", "vehicle_ref", "recorded_at", "line_ref", "line_name", (2 - F.col("direction_id")).cast("string").alias("direction_ref"), F.concat(F.lit(fn.STOP_POINT), "stop_id").alias("stop_ref"),
        F.concat(F.when(F.col("delay_sec") < 0, "-PT").otherwise("PT"), F.abs("delay_sec"), F.lit("S")).alias("delay"), F.lit("1998-03-02").alias("date"),
        F.lit("11.3").alias("longitude"), F.lit("46.5").alias("latitude"), F.when(F.col("event_type") == "click", "true").otherwise("false").alias("at_stop"), F.lit("false").alias("in_congestion"),
    )
    made = transforms.vehicle_positions(activities.withColumn("direction_ref", F.when(F.col("direction_ref") == "2", "2").otherwise("1")), feed(spark, sf_dir))
    return made.select("entity_id", "trip_id", "route_id", "direction_id", "start_date", "stop_id", "current_status", "timestamp")


def updates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Feed]:
    """Trip updates of all trips: calls at hour 8, late by their stop's number."""
    f = feed(spark, sf_dir)
    calls = trip_calls(f)
    stamp = lambda s: F.concat(F.lit("1998-03-02T08:"), F.lpad(F.floor(s / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"), F.lit("Z"))
    late = F.col("stop_id").cast("int") % 50
    has = F.col("stop_id").cast("int") % 4 != 0
    rows = calls.select(
        "journey", "position", F.col("stop_id").alias("stop_ref"), F.when(has, stamp(F.lit(600))).alias("aimed_arrival"), stamp(600 + late).alias("expected_arrival"),
        stamp(F.lit(660)).alias("aimed_departure"), F.when(late > 10, stamp(660 + late + 5)).alias("expected_departure"),
    )
    journeys = f.trips.select(F.col("trip_id").alias("journey"), F.lit("").alias("journey_ref"), F.col("route_id").alias("line_ref"), F.lit("1998-03-02T08:00:00Z").alias("origin_departure"), F.lit("").alias("recorded_at"), F.lit("1998-03-02").alias("date"))
    resolved = f.trips.select(F.col("trip_id").alias("journey"), "trip_id")
    return transforms.trip_updates(journeys, rows, f, resolved, F.lit(7).cast("long")), f


TIMED = """timed as (select trip_id, stop_sequence, stop_id, case when stop_id::int % 4 <> 0 then stop_id::int % 50 end as arrival_delay,
  case when stop_id::int % 50 > 10 then stop_id::int % 50 + 5 end as departure_delay from nth join there using (trip_id, stop_id, k)),
kept as (select * from timed where arrival_delay is not null or departure_delay is not null)"""


@query("t02_trip_updates", """select 'et-' || route_id || '-1998-03-02T08:00:00Z' as entity_id, trip_id, route_id, direction_id, '19980302' as start_date, 7::bigint as "timestamp",
  string_agg(stop_sequence || '/' || stop_id || '/' || coalesce(arrival_delay::varchar, '') || '/' || coalesce(departure_delay::varchar, ''), ',' order by stop_sequence, stop_id, arrival_delay, departure_delay) as stops
from kept join trips using (trip_id) group by all""", CALLS, TIMED)
def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, _ = updates(spark, sf_dir)
    text = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    shown = F.transform("stop_time_updates", lambda u: F.concat_ws("/", u["stop_sequence"].cast("string"), u["stop_id"], text(u["arrival_delay"]), text(u["departure_delay"])))
    return made.select("entity_id", "trip_id", "route_id", "direction_id", "start_date", "timestamp", F.array_join(shown, ",").alias("stops"))


@query("a15_audit", """select count(distinct trip_id) as updates, count(distinct case when k % 11 = 0 then trip_id end) as unknown_trips,
  count(distinct case when k % 5 = 0 and k % 11 <> 0 then trip_id end) as direction_mismatches,
  count(distinct case when k % 11 = 0 or service_id not in (select service_id from active) then trip_id end) as inactive_trips, count(*) as calls,
  count(*) filter (where k % 7 = 0 or k % 11 = 0) as stop_not_on_trip, count(*) filter (where k % 13 = 0 and arrival_delay is not null) as large_delays,
  count(*) filter (where stop_sequence = last) as repeated_sequences, count(*) filter (where k % 3 = 0 and stop_sequence > last) as unsorted
from (select *, trip_id::bigint as k, lag(stop_sequence) over (partition by trip_id order by stop_sequence) as last from kept) x join trips using (trip_id)""", CALLS, TIMED, ACTIVE)
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip updates of which some have each of the faults that are counted."""
    made, f = updates(spark, sf_dir)
    k = F.col("journey").cast("long")
    late = lambda u: F.when(k % 13 == 0, u["arrival_delay"] + 4000).otherwise(u["arrival_delay"])
    calls = F.transform("stop_time_updates", lambda u: F.struct(u["stop_sequence"].alias("stop_sequence"), F.when(k % 7 == 0, "nowhere").otherwise(u["stop_id"]).alias("stop_id"), late(u).alias("arrival_delay"), u["departure_delay"].alias("departure_delay")))
    odd = made.withColumn("stop_time_updates", F.when(k % 3 == 0, F.reverse(calls)).otherwise(calls))
    odd = odd.withColumn("trip_id", F.when(k % 11 == 0, F.concat(F.lit("X"), "trip_id")).otherwise(F.col("trip_id"))).withColumn("direction_id", F.when(k % 5 == 0, 1 - F.col("direction_id")).otherwise(F.col("direction_id")))
    return transforms.audit(odd, f, link.running(f, [DATE]))


@query("t03_alerts", """select 'SIT' || n_nationkey as entity_id, case n_nationkey % 4 when 0 then 'STRIKE' when 1 then 'CONSTRUCTION' when 2 then 'ACCIDENT' else 'UNKNOWN_CAUSE' end as cause,
  case n_nationkey % 3 when 0 then 'NO_SERVICE' when 1 then 'DETOUR' end as effect, case n_nationkey % 3 when 0 then 'SEVERE' when 1 then 'UNKNOWN_SEVERITY' end as severity_level,
  coalesce(concat_ws(',', s, r), '') as informed from nation
left join (select s_nationkey, string_agg('s' || s_suppkey, ',' order by s_suppkey) as s from supplier group by 1) on s_nationkey = n_nationkey
left join (select n, string_agg('r' || route_id, ',' order by ord) as r from (
  select n_nationkey as n, route_id, ord from nation join routes on route_short_name = 'BUILDING-' || n_nationkey) group by 1) on n = n_nationkey""")
def t03(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").withColumn("situation", F.concat(F.lit("SIT"), "n_nationkey"))
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    key = F.col("n_nationkey")
    periods = F.array(F.struct(F.lit("2026-01-01T00:00:00Z").alias("StartTime"), F.lit("").alias("EndTime")))
    reasons = F.array(F.struct(F.lit("DE").alias("lang"), F.lit("Grund").alias("text")))
    situations = n.select(
        "situation", F.element_at(F.array(*[F.lit(x) for x in ("strike", "constructionWork", "accident", "other")]), (key % 4 + 1).cast("int")).alias("cause"),
        F.when(key % 3 == 0, "stopCancelled").when(key % 3 == 1, "diverted").alias("condition"), F.when(key % 3 == 0, "severe").when(key % 3 == 1, "odd").alias("severity"),
        periods.alias("periods"), reasons.alias("reasons"),
    )
    stops = s.select(F.concat(F.lit("SIT"), "s_nationkey").alias("situation"), F.col("s_suppkey").cast("int").alias("position"), F.concat(F.lit(fn.STOP_POINT), "s_suppkey").alias("stop_ref"))
    gone = n.select("situation", F.lit(0).alias("position"), F.lit("nowhere").alias("stop_ref"))
    lines = n.select("situation", F.lit(0).alias("position"), F.lit("unknown").alias("line_ref"), F.concat(F.lit("BUILDING-"), key).alias("line_name"))
    made = transforms.alerts(situations, stops.union(gone), lines, feed(spark, sf_dir))
    shown = F.transform("informed_entity", lambda x: F.coalesce(F.concat(F.lit("s"), x["stop_id"]), F.concat(F.lit("r"), x["route_id"])))
    return made.select("entity_id", "cause", "effect", "severity_level", F.array_join(shown, ",").alias("informed"))


@query("u01_union_of_feeds", """select 'trip' as kind, count(*) as entities from trips union all select 'vehicle', count(distinct vehicle_ref) from vehicles""")
def u01(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = feed(spark, sf_dir)
    trips = f.trips.select(F.lit("trip").alias("kind"), F.col("trip_id").alias("id"))
    seen = transforms.latest_per_vehicle(vehicles(spark, sf_dir)).select(F.lit("vehicle").alias("kind"), F.col("vehicle_ref").alias("id"))
    return trips.unionByName(seen).groupBy("kind").agg(F.count("*").alias("entities"))


@on_feed("w01_w04_ordered_and_monotonic", """select trip_id, string_agg(stop_id, ',' order by stop_sequence, ord) as stop_ids, arg_min(stop_id, row(stop_sequence, ord)) as first_stop,
  bool_and(coalesce(arrival_time >= last, true)) as monotonic from (select *, lag(arrival_time) over (partition by trip_id order by stop_sequence, ord) as last from stop_times) group by 1""")
def w01(f: Feed) -> DataFrame:
    rows = f.trips_with_stops().where(F.size("stops") > 0)
    times = F.transform("stops", lambda s: F.struct(s["arrival_time"].alias("arrival_time"), F.lit(None).cast("int").alias("departure_time")))
    return rows.select("trip_id", F.array_join(F.transform("stops", lambda s: s["stop_id"]), ",").alias("stop_ids"), F.get("stops", F.lit(0))["stop_id"].alias("first_stop"), transforms.times_do_not_fall(times).alias("monotonic"))


@on_feed("m09_m10_directions", "select route_id, string_agg(trip_id, ',' order by ord) as trip_ids from (select *, count(*) filter (where direction_id = 1) over (partition by route_id) as n from trips) where n = 0 or direction_id = 1 group by 1")
def m10(f: Feed) -> DataFrame:
    grouped = f.trips.groupBy("route_id").agg(F.array_sort(F.collect_list(F.struct("_ord", "trip_id", "direction_id"))).alias("t"))
    own = F.filter("t", lambda x: x["direction_id"] == 1)
    kept = F.when(F.size(own) == 0, F.col("t")).otherwise(own)
    return grouped.select("route_id", F.array_join(F.transform(kept, lambda x: x["trip_id"]), ",").alias("trip_ids"))


@on_feed("m05_stop_sets", "select trip_id, count(distinct stop_id)::int as stops, bool_or(stop_id = '3') as calls_at_3 from stop_times group by 1")
def m05(f: Feed) -> DataFrame:
    sets = f.stop_times.groupBy("trip_id").agg(F.collect_set("stop_id").alias("s"))
    return sets.select("trip_id", F.size("s").alias("stops"), F.array_contains("s", "3").alias("calls_at_3"))


@query("j01_array_or_object", "select event_id, coalesce(json_extract_string(props, '$.k'), '') as k from events")
def j01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vehicles(spark, sf_dir).select(F.col("_ord").alias("event_id"), fn.array_or_object(F.col("payload"), "k string").alias("p"))
    return rows.select("event_id", F.coalesce(F.get("p", F.lit(0))["k"], F.lit("")).alias("k"))


@query("s32_latest_dated", "select 'feed_' || max(strftime(o_orderdate, '%Y%m%d')) || '.xml.zip' as name from orders")
def s32(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    good = F.concat(F.lit("feed_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".xml.zip"))
    names = o.select(good.alias("name"), F.col("o_orderkey").alias("_ord")).union(o.select(F.lit("feed_20269999.xml.zip"), F.col("o_orderkey")))
    return remote.latest_dated_rows(names, "feed_", ".xml.zip").select("name")


# --- scalar functions -------------------------------------------------------------


def scalar(name: str, made: Callable[[], Column], call: Callable[[Column], Column], sql: str) -> None:
    """A query of one function over orders: key, input and result. ``made``
    gives the input when the query runs, as columns need a session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        o = spark.read.parquet(f"{sf_dir}/orders.parquet")
        return o.select("o_orderkey", made().alias("given")).select("o_orderkey", "given", call(F.col("given")).alias("result"))

    QUERIES[name] = run
    ORACLE_SQL[name] = f"select o_orderkey, given, {sql} as result from (select *, {SCALAR_SQL[name]} as given from orders)"


KEY = lambda: F.col("o_orderkey")
PICK = lambda *xs: lambda: F.element_at(F.array(*[F.lit(x) for x in xs]), (KEY() % len(xs) + 1).cast("int"))
PICK_SQL = lambda *xs: f"([{', '.join(repr(x) for x in xs)}])[o_orderkey % {len(xs)} + 1]"
CAUSES = ("constructionWork", "maintenanceWork", "specialEvent", "accident", "strike", "weather", "technicalProblem", "Strike", "other")
EFFECTS = ("stopCancelled", "lineCancellation", "delayed", "diverted", "reducedService", "additionalService", "modifiedService", "", "other")
SEVERITIES = ("severe", "warning", "normal", "slight", "other")
STRICT = ("20260301", "20261399", " 00010101 ")
REALS = ("1.5", " -0.25 ", "", "x", "1,5", "1.024e3")
LANGS = ("DE", "it", "LAD", "En", "FR")
NUMBERS = (" 12 ", "-7", "1.5", "", "x9", "+3")
DIRECTIONS = ("1", "2", "5", "-3", "x", "")
STAMPS = ("2026-03-01T10:20:30Z", "2026-03-01T10:20:30.7Z", "2026-03-01T23:59:59+02:00", "2026-03-01T10:20:30", "2026-03-01", "2026-03", "")
STAMP_RESULTS = (1772360430, 1772360430, 1772402399, 1772360430, 1772323200, -1, -1)
WALLS = (37230, 37230, 86399, 37230, 0, -1, -1)
DURATIONS = ("PT1M30S", "-PT90S", "PT1H", "P3M", "P1DT2H", "PT1.5S", "", "PT2H3M4S")
DURATION_RESULTS = (90, -90, 3600, 180, 0, 0, 0, 7384)
JOURNEYS = ("it:apb:ServiceJourney:a:b:", "it:apb:ServiceJourney:ab", "x:it:apb:ServiceJourney:a:b", "it:apb:ServiceJourney::b", "it:apb:ServiceJourney:q:1_")
listed = lambda xs: f"([{', '.join('null' if x is None else repr(x) for x in xs)}])[o_orderkey % {len(xs)} + 1]"

HMS = "lpad((o_orderkey % 30)::varchar, 2, '0') || ':' || lpad((o_custkey % 70)::varchar, 2, '0') || case when o_orderkey % 5 = 0 then '' else ':07' end"
YMD = "case when o_orderkey % 6 = 0 then '2026-01' when o_orderkey % 6 = 1 then '20261399' else strftime(o_orderdate, '%Y%m%d') end"
SCALAR_SQL = {
    "f01_parse_time": HMS,
    "f02_format_time": f"case when o_orderkey % 5 = 0 then -1 else ((o_orderkey % 30) * 3600 + (o_custkey % 70) * 60 + 7)::int end",
    "f03_parse_date": YMD,
    "f04_strict_date": PICK_SQL(*STRICT),
    "f09_is_set": "(o_orderkey % 3 - 1)::int",
    "f18_real_number32": PICK_SQL(*REALS),
    "f05_format_date": "case when o_orderkey % 6 = 0 then 0 else strftime(o_orderdate, '%Y%m%d')::int end",
    "f06_weekday": "case when o_orderkey % 6 = 1 then 20261399 else strftime(o_orderdate, '%Y%m%d')::int end",
    "f07_whole_number": PICK_SQL(*NUMBERS),
    "f08_flag": "(o_orderkey % 3)::varchar",
    "f10_trim_colon": "o_orderpriority || repeat(':', (o_orderkey % 3)::int)",
    "f11_journey_base": PICK_SQL(*JOURNEYS),
    "f12_live_journey_base": PICK_SQL(*JOURNEYS),
    "f13_direction_suffix": "o_orderstatus || ':' || o_orderpriority || repeat(':', (o_orderkey % 2)::int)",
    "f14_timetable_direction": "o_orderstatus",
    "f15_epoch": PICK_SQL(*STAMPS),
    "f16_duration": PICK_SQL(*DURATIONS),
    "f17_plain_date": "strftime(o_orderdate, '%Y-%m-%d')",
    "f19_strip_stop_prefix": "case when o_orderkey % 2 = 0 then 'it:apb:ScheduledStopPoint:' else 'IT:' end || o_orderkey",
    "f20_live_direction": PICK_SQL(*DIRECTIONS),
    "f21_cause": PICK_SQL(*CAUSES),
    "f22_effect": PICK_SQL(*EFFECTS),
    "f23_severity": PICK_SQL(*SEVERITIES),
    "f24_language": PICK_SQL(*LANGS),
    "f25_wall_clock": PICK_SQL(*STAMPS),
    "f26_proximity": "(o_orderkey % 300)::int",
    "f29_stop_status": "case when o_orderkey % 2 = 0 then 'true' else 'True' end",
}
hms = lambda: F.concat(F.lpad((KEY() % 30).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.col("o_custkey") % 70).cast("string"), 2, "0"), F.when(KEY() % 5 == 0, "").otherwise(":07"))
ymd = lambda: F.date_format("o_orderdate", "yyyyMMdd")
seconds = lambda: ((KEY() % 30) * 3600 + (F.col("o_custkey") % 70) * 60 + 7).cast("int")
text_key = lambda: KEY().cast("string")

scalar("f01_parse_time", hms, fn.gtfs_time, "case when o_orderkey % 5 = 0 then -1 else ((o_orderkey % 30) * 3600 + (o_custkey % 70) * 60 + 7)::int end")
scalar("f02_format_time", lambda: F.when(KEY() % 5 == 0, -1).otherwise(seconds()), fn.format_time, "case when given = -1 then '' else lpad((given // 3600)::varchar, 2, '0') || ':' || lpad((given % 3600 // 60)::varchar, 2, '0') || ':' || lpad((given % 60)::varchar, 2, '0') end")
scalar("f03_parse_date", lambda: F.when(KEY() % 6 == 0, "2026-01").when(KEY() % 6 == 1, "20261399").otherwise(ymd()), fn.gtfs_date, "case when length(given) = 8 then given::int else 0 end")
scalar("f04_strict_date", PICK(*STRICT), fn.strict_date, listed((20260301, 20261399, 10101)))
scalar("f09_is_set", lambda: (KEY() % 3 - 1).cast("int"), lambda c: fn.is_set_time(c) & fn.is_set_date(c), "given = 1")
scalar("f18_real_number32", PICK(*REALS), fn.real_number32, listed((1.5, -0.25, 0.0, 0.0, 0.0, 1024.0)) + "::float")
scalar("f05_format_date", lambda: F.when(KEY() % 6 == 0, 0).otherwise(ymd().cast("int")), fn.format_date, "case when given = 0 then '' else given::varchar end")
scalar("f06_weekday", lambda: F.when(KEY() % 6 == 1, 20261399).otherwise(ymd().cast("int")), fn.weekday, "case when given = 20261399 then 4 else isodow(strptime(given::varchar, '%Y%m%d')) - 1 end::int")
scalar("f07_whole_number", PICK(*NUMBERS), fn.whole_number, listed((12, -7, 0, 0, 0, 3)))
scalar("f08_flag", lambda: (KEY() % 3).cast("string"), fn.flag, "given = '1'")
scalar("f10_trim_colon", lambda: F.concat("o_orderpriority", F.repeat(F.lit(":"), (KEY() % 3).cast("int"))), fn.trim_colon, "regexp_replace(given, ':$', '')")
scalar("f11_journey_base", PICK(*JOURNEYS), fn.journey_base, listed(("a", "ab", "", ":b", "q")))
scalar("f12_live_journey_base", PICK(*JOURNEYS), fn.live_journey_base, listed(("a:b", "ab", "a", ":b", "q")))
scalar("f13_direction_suffix", lambda: F.concat("o_orderstatus", F.lit(":"), "o_orderpriority", F.repeat(F.lit(":"), (KEY() % 2).cast("int"))), fn.direction_suffix, "o_orderpriority")
scalar("f14_timetable_direction", lambda: F.col("o_orderstatus"), fn.timetable_direction, "case when given = 'R' then 1 else 0 end")
scalar("f15_epoch", PICK(*STAMPS), lambda c: F.coalesce(fn.epoch(c), F.lit(-1)), listed(STAMP_RESULTS) + "::bigint")
scalar("f16_duration", PICK(*DURATIONS), fn.duration, listed(DURATION_RESULTS))
scalar("f17_plain_date", lambda: F.date_format("o_orderdate", "yyyy-MM-dd"), fn.plain_date, "replace(given, '-', '')")
scalar("f19_strip_stop_prefix", lambda: F.concat(F.when(KEY() % 2 == 0, fn.STOP_POINT).otherwise("IT:"), text_key()), fn.strip_stop_prefix, "regexp_replace(given, '^it:apb:ScheduledStopPoint:', '')")
scalar("f20_live_direction", PICK(*DIRECTIONS), fn.live_direction, listed((1, 0, 4, 0, 0, 0)))
scalar("f21_cause", PICK(*CAUSES), fn.cause, listed(("CONSTRUCTION", "MAINTENANCE", "OTHER_CAUSE", "ACCIDENT", "STRIKE", "WEATHER", "TECHNICAL_PROBLEM", "UNKNOWN_CAUSE", "UNKNOWN_CAUSE")))
scalar("f22_effect", PICK(*EFFECTS), fn.effect, listed(("NO_SERVICE", "NO_SERVICE", "SIGNIFICANT_DELAYS", "DETOUR", "REDUCED_SERVICE", "ADDITIONAL_SERVICE", "MODIFIED_SERVICE", "UNKNOWN_EFFECT", "UNKNOWN_EFFECT")))
scalar("f23_severity", PICK(*SEVERITIES), fn.severity, listed(("SEVERE", "WARNING", "INFO", "UNKNOWN_SEVERITY", "UNKNOWN_SEVERITY")))
scalar("f24_language", PICK(*LANGS), fn.language, listed(("de", "it", "lld", "en", "fr")))
scalar("f25_wall_clock", PICK(*STAMPS), lambda c: F.coalesce(fn.wall_clock(c), F.lit(-1)), listed(WALLS))
scalar("f26_proximity", lambda: (KEY() % 300).cast("int"), lambda c: fn.proximity(c, 120), "case when given <= 120 then 1.0::double / (1 + given) else 0.0::double end")
scalar("f29_stop_status", lambda: F.when(KEY() % 2 == 0, "true").otherwise("True"), fn.stop_status, "case when given = 'true' then 'STOPPED_AT' else 'IN_TRANSIT_TO' end")


@query("f27_f28_delay_and_entity_id", """select event_id, (delay_sec)::int as delay, case when event_id % 2 = 0 then 'et-L' || user_id || '-x' else 'ref' end as entity_id
from (select *, (event_id % 40)::int as delay_sec from events)""")
def f27(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    at = F.concat(F.lit("2026-03-01T10:20:"), F.lpad((F.col("event_id") % 40).cast("string"), 2, "0"), F.lit("Z"))
    ref = F.when(F.col("event_id") % 2 == 0, "").otherwise("ref")
    return e.select("event_id", fn.delay(at, F.lit("2026-03-01T12:20:00+02:00")).alias("delay"), fn.entity_id(ref, F.concat(F.lit("L"), "user_id"), F.lit("x")).alias("entity_id"))


@query("f30_f31_compressed_payload", "select event_id, case when event_id % 2 = 0 then '{\"a\": 1}' else coalesce(props, '') end as payload from events")
def f31(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    even = F.col("event_id") % 2 == 0
    packed = remote.compress('{"a": 1}')
    rows = e.select(
        "event_id", F.when(even, F.create_map(F.lit("compressed"), F.lit(remote.COMPRESSED))).otherwise(F.create_map(F.lit("x"), F.lit("y"))).alias("metadata"),
        F.when(even, packed).otherwise(F.coalesce("props", F.lit(""))).alias("payload"),
    )
    return rows.select("event_id", remote.payload(rows).alias("payload"))
