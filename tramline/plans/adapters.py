"""Transit relations made from the standard tables, in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.feed import Feed
from ..schemas import WEEKDAYS


def _date(c: str):
    return F.date_format(c, "yyyyMMdd").cast("int")


def feed(spark: SparkSession, sf_dir: str) -> Feed:
    """Timetable tables; ``_ord`` is the order of a file."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    text = lambda c: F.col(c).cast("string")
    service = F.concat_ws("|", "o_orderpriority", F.year("o_orderdate"))
    routes = read("customer").select(
        text("c_custkey").alias("route_id"),
        F.concat_ws("-", "c_mktsegment", "c_nationkey").alias("route_short_name"),
        F.col("c_name").alias("route_long_name"),
        (F.col("c_nationkey") % 12).cast("int").alias("route_type"),
        F.col("c_custkey").alias("_ord"),
    )
    trips = read("orders").select(
        text("o_orderkey").alias("trip_id"), text("o_custkey").alias("route_id"), service.alias("service_id"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("direction_id"), F.col("o_orderkey").alias("_ord"),
    )
    seconds = (F.col("l_quantity") * 1800 + F.col("l_linenumber") * 60).cast("int")
    stop_times = read("lineitem").select(
        text("l_orderkey").alias("trip_id"), text("l_suppkey").alias("stop_id"), F.col("l_linenumber").cast("int").alias("stop_sequence"),
        seconds.alias("arrival_time"), seconds.alias("departure_time"), F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("_ord"),
    )
    platforms = read("supplier").select(
        text("s_suppkey").alias("stop_id"), F.col("s_name").alias("stop_name"), F.lit(0).alias("location_type"),
        F.concat(F.lit("N"), "s_nationkey").alias("parent_station"), F.struct(F.lit(0).alias("k"), F.col("s_suppkey").alias("n")).alias("_ord"),
    )
    stations = read("nation").select(
        F.concat(F.lit("N"), "n_nationkey").alias("stop_id"), F.col("n_name").alias("stop_name"), F.lit(1).alias("location_type"),
        F.lit("").alias("parent_station"), F.struct(F.lit(1).alias("k"), F.col("n_nationkey").cast("long").alias("n")).alias("_ord"),
    )
    days = read("orders").select(service.alias("service_id"), _date("o_orderdate").alias("d"), F.substring("o_orderpriority", 1, 1).cast("int").alias("p"))
    spans = days.groupBy("service_id").agg(F.min("d").alias("start_date"), F.max("d").alias("end_date"), F.min("p").alias("p"))
    runs = [((F.lit(k) + F.col("p")) % 3 != 0).alias(day) for k, day in enumerate(WEEKDAYS)]
    calendar = spans.select("service_id", *runs, "start_date", "end_date", F.col("service_id").alias("_ord"))
    dates = read("orders").where("o_orderkey % 7 = 0").select(
        service.alias("service_id"), _date("o_orderdate").alias("date"), (1 + F.col("o_orderkey") % 2).cast("int").alias("exception_type"), F.col("o_orderkey").alias("_ord"),
    )
    keyed = ("stops", "routes", "trips", "calendar")  # by the keys of the standard tables
    return Feed(unique=keyed, stops=platforms.union(stations), routes=routes, trips=trips, stop_times=stop_times, calendar=calendar, calendar_dates=dates)


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle activities: one row for each event."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    raw = F.coalesce("props", F.lit("{}"))
    return e.select(
        F.col("user_id").cast("string").alias("vehicle_ref"), stamp.alias("recorded_at"), (F.col("user_id") % 100).cast("string").alias("stop_id"),
        F.col("value").cast("int").alias("delay_sec"), (F.col("event_id") % 2).cast("int").alias("direction_id"), F.col("event_type"),
        F.when(F.col("event_id") % 2 == 0, raw).otherwise(F.concat(F.lit("["), raw, F.lit("]"))).alias("payload"), F.col("event_id").alias("_ord"),
    )


#: The same relations for DuckDB.
SQL = """with routes as (
  select c_custkey::varchar as route_id, c_mktsegment || '-' || c_nationkey as route_short_name, c_name as route_long_name,
    (c_nationkey % 12)::int as route_type, c_custkey as ord from customer),
trips as (
  select o_orderkey::varchar as trip_id, o_custkey::varchar as route_id, o_orderpriority || '|' || year(o_orderdate) as service_id,
    (case when o_orderstatus = 'F' then 0 else 1 end)::int as direction_id, o_orderkey as ord from orders),
stop_times as (
  select l_orderkey::varchar as trip_id, l_suppkey::varchar as stop_id, l_linenumber::int as stop_sequence,
    trunc(l_quantity * 1800 + l_linenumber * 60)::int as arrival_time, row(l_orderkey, l_linenumber, l_partkey, l_suppkey) as ord from lineitem),
stops as (
  select s_suppkey::varchar as stop_id, s_name as stop_name, 0 as location_type, 'N' || s_nationkey as parent_station, row(0, s_suppkey) as ord from supplier
  union all select 'N' || n_nationkey, n_name, 1, '', row(1, n_nationkey::bigint) from nation),
spans as (
  select o_orderpriority || '|' || year(o_orderdate) as service_id, min(strftime(o_orderdate, '%Y%m%d')::int) as start_date,
    max(strftime(o_orderdate, '%Y%m%d')::int) as end_date, min(left(o_orderpriority, 1)::int) as p from orders group by 1),
calendar as (select service_id, start_date, end_date, p from spans),
calendar_dates as (
  select o_orderpriority || '|' || year(o_orderdate) as service_id, strftime(o_orderdate, '%Y%m%d')::int as date,
    (1 + o_orderkey % 2)::int as exception_type, o_orderkey as ord from orders where o_orderkey % 7 = 0),
vehicles as (
  select user_id::varchar as vehicle_ref, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as recorded_at, (user_id % 100)::varchar as stop_id,
    trunc(value)::int as delay_sec, (event_id % 2)::int as direction_id, event_type,
    case when event_id % 2 = 0 then coalesce(props, '{}') else '[' || coalesce(props, '{}') || ']' end as payload, event_id as ord, ts from events)"""


def active_sql(date: int, weekday: int) -> str:
    """CTE ``active``: the services that run on a date (0 is Monday)."""
    return f"""active as (
  select service_id from (select service_id from calendar union select service_id from calendar_dates) s
  left join (select service_id, arg_min(exception_type, ord) as exception from calendar_dates where date = {date} group by 1) e using (service_id)
  left join calendar c using (service_id)
  where coalesce(exception = 1, {date} between start_date and end_date and ({weekday} + p) % 3 <> 0, false))"""
