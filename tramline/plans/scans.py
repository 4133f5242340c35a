"""Queries that write the standard tables in the formats that the library reads,
scan them, and give rows that SQL takes from the tables themselves."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import sinks, streaming
from ..operators.feed import Feed
from ..operators.rows import last_of
from ..session import put_file, shared_dir
from ..sources import gtfs, gtfsrt, netex, siri
from .queries import ACTIVE, DATE, ORACLE_SQL, QUERIES, entity_rows, feed, query


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def plain(name: str, sql: str):
    """Registers a query whose SQL reads the standard tables alone."""

    def register(f):
        QUERIES[name], ORACLE_SQL[name] = f, sql
        return f

    return register


def listed(items: Column) -> Column:
    """JSON texts as an array, or as one object if there is one; null if none."""
    return F.when(F.size(items) == 1, items[0]).when(F.size(items) > 1, F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))


def in_order(key: str, *order: str, item: str = "json") -> Column:
    """The texts of a group in order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, item))), lambda x: x[item])


def enveloped(body: Column, other_root: Column) -> Column:
    """A message below one of the two roots that feeds use."""
    inner = F.concat(F.lit('{"ServiceDelivery":{"ResponseTimestamp":"2026-03-01T10:00:00Z",'), body, F.lit("}}"))
    return F.when(other_root, inner).otherwise(F.concat(F.lit('{"Siri":'), inner, F.lit("}")))


# --- live feeds ----------------------------------------------------------------


def vehicle_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three activities to a message, as an array; each fourth alone, as an object."""
    e = read(spark, sf_dir, "events")
    key = F.col("event_id")
    call = F.struct((F.col("user_id") % 100).cast("string").alias("StopPointRef"), F.when(F.col("event_type") == "click", "true").otherwise("false").alias("VehicleAtStop"))
    framed = F.struct(F.lit("1998-03-02").alias("DataFrameRef"), F.concat(F.lit("j:"), key).alias("DatedVehicleJourneyRef"))
    journey = F.struct(F.col("user_id").cast("string").alias("LineRef"), framed.alias("FramedVehicleJourneyRef"), F.concat(F.lit('say "'), "event_type", F.lit('"')).alias("PublishedLineName"), F.concat(F.lit("PT"), (key % 90).cast("string"), F.lit("S")).alias("Delay"), key.cast("string").alias("VehicleRef"), call.alias("MonitoredCall"))
    activity = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("RecordedAtTime"), journey.alias("MonitoredVehicleJourney")))
    message = F.when(key % 4 == 0, -1 - key).otherwise(F.floor(key / 4))
    rows = e.select(message.alias("message"), "event_id", activity.alias("json")).groupBy("message").agg(in_order("message", "event_id").alias("items"))
    body = F.concat(F.lit('"VehicleMonitoringDelivery":{"VehicleActivity":'), listed(F.col("items")), F.lit("}"))
    return rows.select("message", enveloped(body, F.col("message") % 2 == 0).alias("payload"))


ACTIVITIES = """select event_id::varchar as vehicle_ref, case when event_id % 4 = 0 then 0 else event_id % 4 - 1 end::int as position, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as recorded_at,
  user_id::varchar as line_ref, 'say "' || event_type || '"' as line_name, '' as direction_ref, (user_id % 100)::varchar as stop_ref, 'PT' || (event_id % 90) || 'S' as delay,
  '1998-03-02' as date, 'j:' || event_id as journey_ref, case when event_type = 'click' then 'true' else 'false' end as at_stop from events"""
ACTIVITY = ("vehicle_ref", "position", "recorded_at", "line_ref", "line_name", "direction_ref", "stop_ref", "delay", "date", "journey_ref", "at_stop")


@plain("s24_j02_vehicle_activities", ACTIVITIES)
def s24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return siri.flat_activities(vehicle_messages(spark, sf_dir)).withColumnRenamed("_ord", "position").select(*ACTIVITY)


@plain("k07_vehicle_json", ACTIVITIES)
def k07(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read, written as JSON again and read."""
    rows = siri.vehicle_activities(vehicle_messages(spark, sf_dir)).groupBy("message").agg(F.array_sort(F.collect_list(F.struct("position", "activity"))).alias("a"))
    again = rows.select(siri.to_json(F.transform("a", lambda x: x["activity"]), "VM", F.lit("2026-03-01T10:00:00Z")).alias("payload"))
    return siri.flat_activities(again).withColumnRenamed("_ord", "position").select(*ACTIVITY)


@plain("k06_dumped_messages", ACTIVITIES.replace(" from events", ", case when event_id % 4 = 0 then 'one' else 'many' end as provider from events"))
def k06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages dumped as text by provider, and read from there."""
    folder = shared_dir(spark)
    rows = vehicle_messages(spark, sf_dir).withColumn("provider", F.when(F.col("message") < 0, "one").otherwise("many"))
    sinks.dump_messages(rows, folder)
    again = spark.read.text(folder).withColumnRenamed("value", "payload")
    return siri.vehicle_activities(again).transform(siri.flattened, "provider").withColumnRenamed("_ord", "position").select(*ACTIVITY, "provider")


def estimated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message for each customer, a frame for each status of orders, a journey
    for each order, a call for each line: arrays, or objects where one."""
    quoted = lambda c: F.to_json(F.struct(c.cast("string").alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(c.cast("string").alias("x")))) - 6)
    line = read(spark, sf_dir, "lineitem")
    call = F.to_json(F.struct(F.concat(F.lit("s"), "l_suppkey").alias("StopPointRef"), F.col("l_linenumber").cast("string").alias("VisitNumber"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("AimedArrivalTime")))
    calls = line.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", call.alias("json"))
    calls = calls.groupBy("o_orderkey").agg(listed(in_order("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")).alias("calls"))
    o = read(spark, sf_dir, "orders").join(calls, "o_orderkey", "left")
    estimated = F.coalesce(F.concat(F.lit(',"EstimatedCalls":{"EstimatedCall":'), F.col("calls"), F.lit("}")), F.lit(""))
    journey = F.concat(F.lit('{"LineRef":'), quoted(F.col("o_orderpriority")), F.lit(',"FramedVehicleJourneyRef":{"DatedVehicleJourneyRef":'), quoted(F.col("o_orderkey")), F.lit("}"), estimated, F.lit("}"))
    journeys = o.select("o_custkey", "o_orderstatus", "o_orderkey", journey.alias("json")).groupBy("o_custkey", "o_orderstatus").agg(listed(in_order("o_custkey", "o_orderkey")).alias("j"))
    frame = F.concat(F.lit('{"RecordedAtTime":"2026-03-01T10:00:00Z","EstimatedVehicleJourney":'), F.col("j"), F.lit("}"))
    frames = journeys.withColumn("json", frame).groupBy("o_custkey").agg(listed(in_order("o_custkey", "o_orderstatus")).alias("f"))
    body = F.concat(F.lit('"EstimatedTimetableDelivery":{"EstimatedJourneyVersionFrame":'), F.col("f"), F.lit("}"))
    return frames.select(F.col("o_custkey").alias("message"), enveloped(body, F.col("o_custkey") % 2 == 0).alias("payload"))


@plain("s23_a14_estimated_journeys", """select o_orderkey::varchar as journey_ref, (dense_rank() over (partition by o_custkey order by o_orderstatus) - 1)::int as frame,
  (row_number() over (partition by o_custkey, o_orderstatus order by o_orderkey) - 1)::int as position, o_orderpriority as line_ref from orders""")
def s23(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = siri.journeys(estimated_messages(spark, sf_dir))
    return rows.select(F.col("journey.FramedVehicleJourneyRef.DatedVehicleJourneyRef").alias("journey_ref"), "frame", "position", F.col("journey.LineRef").alias("line_ref"))


CALLS_OF_JOURNEYS = """select l_orderkey::varchar as journey_ref, (row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_shipdate) - 1)::int as position,
  's' || l_suppkey as stop_ref, l_linenumber::varchar as visit, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') as aimed from lineitem join orders on o_orderkey = l_orderkey"""


def shown_calls(journeys: DataFrame, calls=siri.calls) -> DataFrame:
    rows = calls(journeys)
    return rows.select(F.col("journey.FramedVehicleJourneyRef.DatedVehicleJourneyRef").alias("journey_ref"), F.col("call_position").alias("position"), F.col("call.StopPointRef").alias("stop_ref"), F.col("call.VisitNumber").alias("visit"), F.col("call.AimedArrivalTime").alias("aimed"))


@plain("s23_estimated_calls", CALLS_OF_JOURNEYS)
def s23_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_calls(siri.journeys(estimated_messages(spark, sf_dir)))


def situation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Situations of which each part is an array, an object or absent."""
    n, k = read(spark, sf_dir, "nation"), F.col("n_nationkey")
    stop = F.concat(F.lit('{"StopPointRef":"s'), "s_suppkey", F.lit('"}'))
    stops = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", stop.alias("json")).groupBy("n_nationkey").agg(listed(in_order("n_nationkey", "s_suppkey")).alias("stops"))
    one, two, three = ('{"LineRef":"L%d"}' % x for x in (1, 2, 3))
    period = F.when(k % 3 == 0, '{"StartTime":"2026-01-01"}').when(k % 3 == 1, '[{"StartTime":"2026-01-01","EndTime":"2026-02-01"},{}]').otherwise('{"StartTime":""}')
    reason = F.concat(F.lit('{"@xml:lang":"DE","#text":"'), "n_name", F.lit('"}'))
    reasons = F.when(k % 2 == 0, reason).otherwise(F.concat(F.lit("["), reason, F.lit(',{"@xml:lang":"IT","#text":"b"}]')))
    network = F.when(k % 4 == 0, '{"AffectedLine":%s}' % one).when(k % 4 == 1, '{"AffectedLine":[%s,%s]}' % (one, two)).when(k % 4 == 2, '[{"AffectedLine":%s},{"AffectedLine":[%s,%s]}]' % (one, two, three))
    affected = F.concat_ws(",", F.concat(F.lit('"StopPoints":{"AffectedStopPoint":'), F.col("stops"), F.lit("}")), F.concat(F.lit('"Networks":{"AffectedNetwork":'), network, F.lit("}")))
    consequence = F.when(k % 3 == 0, '{"Condition":"delayed","Severity":"severe"}').when(k % 3 == 1, '[{"Condition":"diverted"},{"Severity":"normal"}]')
    situation = F.concat(F.lit('{"SituationNumber":"SIT'), k, F.lit('","ValidityPeriod":'), period, F.lit(',"ReasonName":'), reasons, F.lit(',"Affects":{'), affected, F.lit("}"), F.coalesce(F.concat(F.lit(',"Consequences":{"Consequence":'), consequence, F.lit("}")), F.lit("")), F.lit("}"))
    message = F.when(k % 6 == 0, -1 - k).otherwise(k % 6)
    rows = n.join(stops, "n_nationkey", "left").select(message.alias("message"), "n_nationkey", situation.alias("json")).groupBy("message").agg(listed(in_order("message", "n_nationkey")).alias("s"))
    body = F.concat(F.lit('"SituationExchangeDelivery":{"Situations":{"PtSituationElement":'), F.col("s"), F.lit("}}"))
    return rows.select("message", enveloped(body, F.col("message") % 2 == 0).alias("payload"))


def shown_situations(found: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(c, F.lit(""))
    shown = lambda c, f, by=",": F.array_join(F.transform(c, f), by)
    return found.select(
        F.col("situation.SituationNumber").alias("situation"), "position",
        shown("periods", lambda p: F.concat(text(p["StartTime"]), F.lit("/"), text(p["EndTime"]))).alias("periods"), shown("reasons", lambda x: F.concat(x["lang"], F.lit(":"), x["text"])).alias("reasons"),
        shown("networks", lambda net: shown(net, lambda x: x["LineRef"], "+"), ";").alias("lines"), shown("consequences", lambda c: F.concat(text(c["Condition"]), F.lit("/"), text(c["Severity"]))).alias("consequences"),
        shown("stops", lambda s: s["StopPointRef"]).alias("stops"),
    )


SITUATIONS = """select 'SIT' || n_nationkey as situation, (case when n_nationkey % 6 = 0 then 0 else n_nationkey // 6 end)::int as position,
  case n_nationkey % 3 when 0 then '2026-01-01/' when 1 then '2026-01-01/2026-02-01,/' else '' end as periods,
  case when n_nationkey % 2 = 0 then 'DE:' || n_name else 'DE:' || n_name || ',IT:b' end as reasons,
  case n_nationkey % 4 when 0 then 'L1' when 1 then 'L1+L2' when 2 then 'L1;L2+L3' else '' end as lines,
  case n_nationkey % 3 when 0 then 'delayed/severe' when 1 then 'diverted/,/normal' else '' end as consequences,
  coalesce((select string_agg('s' || s_suppkey, ',' order by s_suppkey) from supplier where s_nationkey = n_nationkey), '') as stops from nation"""


@plain("s25_j03_j07_situations", SITUATIONS)
def s25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_situations(siri.situations(situation_messages(spark, sf_dir)))


@plain("k10_s37_queued_envelopes", "select event_id::varchar as provider, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as timestamp, coalesce(props, '{}') as payload from events")
def k10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published to a folder, half of them compressed, and read as a queue is."""
    e = read(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("provider"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.lit("json").alias("format"), F.lit("siri").alias("protocol"), F.coalesce("props", F.lit("{}")).alias("payload"))
    folder, odd = shared_dir(spark), F.col("provider").cast("long") % 2 == 1
    sinks.publish(e.where(odd), folder, compress=True)
    sinks.publish(e.where(~odd), folder)
    return streaming.unwrapped(streaming.opened(spark.read.text(folder)))


# --- timetable files -----------------------------------------------------------


def cells(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables of a bundle as text, with what files may hold: a byte order
    mark, blanks around headers and cells, quotes, commas, line breaks, times
    past midnight, bad numbers, missing columns."""
    f, text = feed(spark, sf_dir), lambda c: F.col(c).cast("string")
    n = read(spark, sf_dir, "nation")
    flag = lambda c: F.when(F.col(c), "1").otherwise("0").alias(c)
    line = read(spark, sf_dir, "lineitem")
    seconds = (F.col("l_quantity") * 1800 + F.col("l_linenumber") * 60).cast("int")
    return {
        "agency": read(spark, sf_dir, "region").select(text("r_regionkey").alias("﻿agency_id"), F.concat(F.lit('"The" '), "r_name", F.lit(", lines")).alias(" agency_name "), F.lit("Europe/Rome").alias("agency_timezone")),
        "stops": read(spark, sf_dir, "supplier").select(text("s_suppkey").alias("stop_id"), F.concat("s_name", F.lit("\nplatform")).alias("stop_name"), (F.col("s_acctbal") / 64).cast("string").alias("stop_lat"), F.lit("x").alias("stop_lon"), F.lit("1.5").alias("location_type"), F.lit("z").alias("unknown column")),
        "routes": read(spark, sf_dir, "customer").select(text("c_custkey").alias("route_id"), F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("route_short_name"), (F.col("c_nationkey") % 12).cast("string").alias("route_type")),
        "trips": f.trips.select("route_id", "service_id", "trip_id", text("direction_id").alias("direction_id")),
        "stop_times": line.select(text("l_orderkey").alias("trip_id"), fn.format_time(seconds).alias("arrival_time"), F.when(F.col("l_linenumber") == 1, "").otherwise(fn.format_time(seconds)).alias("departure_time"), text("l_suppkey").alias("stop_id"), text("l_linenumber").alias("stop_sequence")),
        "calendar": f.calendar.select("service_id", *[flag(d) for d in ("monday", "tuesday", "sunday")], text("start_date").alias("start_date"), F.lit("2026-01-01").alias("end_date")),
        "calendar_dates": f.calendar_dates.select("service_id", text("date").alias("date"), text("exception_type").alias("exception_type")),
        "shapes": n.select(text("n_regionkey").alias("shape_id"), text("n_nationkey").alias("shape_pt_sequence"), F.concat("n_nationkey", F.lit(".25")).alias("shape_pt_lat")),
        "translations": n.select(F.lit("stops").alias("table_name"), F.lit("stop_name").alias("field_name"), F.lit("it").alias("language"), F.col("n_name").alias("translation"), text("n_nationkey").alias("record_id")),
    }


def bundle(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the bundle, written as CSV into a folder and scanned."""
    folder = shared_dir(spark)
    cells(spark, sf_dir)[table].write.csv(f"{folder}/{table}.txt", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return getattr(gtfs.read_folder(spark, folder, optional=("shapes", "translations")), table).drop("_ord")


#: For each table the operator's name and the expected rows; a column that the
#: file lacks has the zero value of its kind.
SCANS = {
    "agency": ("s06", "select r_regionkey::varchar as agency_id, '\"The\" ' || r_name || ', lines' as agency_name, '' as agency_url, 'Europe/Rome' as agency_timezone, '' as agency_lang, '' as agency_phone, '' as agency_fare_url, '' as agency_email from region"),
    "stops": ("s07", """select s_suppkey::varchar as stop_id, '' as stop_code, s_name || chr(10) || 'platform' as stop_name, '' as stop_desc, s_acctbal / 64 as stop_lat, 0.0::double as stop_lon, '' as zone_id,
      '' as stop_url, 0 as location_type, '' as parent_station, '' as stop_timezone, 0 as wheelchair_boarding, '' as level_id, '' as platform_code from supplier"""),
    "routes": ("s08", """select c_custkey::varchar as route_id, '' as agency_id, c_mktsegment as route_short_name, '' as route_long_name, '' as route_desc, (c_nationkey % 12)::int as route_type, '' as route_url,
      '' as route_color, '' as route_text_color, 0 as route_sort_order, 0 as continuous_pickup, 0 as continuous_drop_off, '' as network_id from customer"""),
    "trips": ("s09", "select route_id, service_id, trip_id, '' as trip_headsign, '' as trip_short_name, direction_id, '' as block_id, '' as shape_id, 0 as wheelchair_accessible, 0 as bikes_allowed from trips"),
    "stop_times": ("s10", """select trip_id, arrival_time, case when stop_sequence = 1 then -1 else arrival_time end as departure_time, stop_id, stop_sequence, '' as stop_headsign, 0 as pickup_type, 0 as drop_off_type,
      0 as continuous_pickup, 0 as continuous_drop_off, 0.0::double as shape_dist_traveled, 0 as timepoint from stop_times"""),
    "calendar": ("s11", """select service_id, p % 3 <> 0 as monday, (1 + p) % 3 <> 0 as tuesday, false as wednesday, false as thursday, false as friday, false as saturday, (6 + p) % 3 <> 0 as sunday, start_date, 0 as end_date from calendar"""),
    "calendar_dates": ("s12", "select service_id, date, exception_type from calendar_dates"),
    "shapes": ("s13", "select n_regionkey::varchar as shape_id, n_nationkey + 0.25::double as shape_pt_lat, 0.0::double as shape_pt_lon, n_nationkey::int as shape_pt_sequence, 0.0::double as shape_dist_traveled from nation"),
    "translations": ("s14", "select 'stops' as table_name, 'stop_name' as field_name, 'it' as language, n_name as translation, n_nationkey::varchar as record_id, '' as record_sub_id from nation"),
}
for _table, (_name, _sql) in SCANS.items():
    query(f"{_name}_scan_{_table}", _sql)(lambda spark, sf_dir, table=_table: bundle(spark, sf_dir, table))


@plain("s01_s05_zip_scan", "select n_nationkey::varchar as stop_id, n_name || ', \"x\"' || chr(10) || 'y' as stop_name, n_nationkey + 0.5::double as stop_lat, 'zip' as source from nation union all select r_regionkey::varchar, r_name, 0.0::double, 'zip' from region")
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two archives with headers of their own, one with a byte order mark."""
    folder = shared_dir(spark)
    nations, regions = read(spark, sf_dir, "nation").collect(), read(spark, sf_dir, "region").collect()  # 25 and 5 rows at every size
    first = "﻿stop_lat, stop_name ,stop_id\r\n" + "".join(f'{r["n_nationkey"]}.5,"{r["n_name"]}, ""x""\ny",{r["n_nationkey"]}\r\n' for r in nations)
    second = "stop_id,stop_name\n" + "".join(f"{r['r_regionkey']},{r['r_name']}\n" for r in regions)
    for name, text in (("a.zip", first), ("b.zip", second)):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("stops.txt", text)
            z.writestr("inner/routes.txt", "route_id\n1\n")
        put_file(spark, f"{folder}/{name}", data.getvalue())
    return gtfs.read_zip(spark, folder).stops.select("stop_id", "stop_name", "stop_lat", F.lit("zip").alias("source"))


# --- timetable entities ----------------------------------------------------------

#: Kind, profile, frame, collection, element and the fields that its table shows;
#: {n} is the nation's key. Fields not named are empty.
ELEMENTS = (
    ("Authority", "epip", "ResourceFrame", "organisations", '<Authority id="AU:{n}" version="{n}"><Name lang="de">Amt {n}</Name><ShortName>A{n}</ShortName><PublicCode>P{n}</PublicCode><OrganisationType>authority</OrganisationType></Authority>',
     "id=AU:{n};version={n};name=Amt {n};name_lang=de;short_name=A{n};public_code=P{n};organisation_type=authority"),
    ("Operator", "epip", "ResourceFrame", "organisations", '<Operator id="OP:{n}" version="1"><Name lang="it">Op {n}</Name><ShortName>O</ShortName><LegalName>L {n}</LegalName><OrganisationType>operator</OrganisationType></Operator>',
     "id=OP:{n};version=1;name=Op {n};name_lang=it;short_name=O;legal_name=L {n};organisation_type=operator"),
    ("VehicleType", "epip", "ResourceFrame", "vehicleTypes", '<VehicleType id="VT:{n}" version="1"><LowFloor>true</LowFloor><HasLiftOrRamp>false</HasLiftOrRamp><HasHoist>no</HasHoist><Length>{n}.5</Length></VehicleType>',
     "id=VT:{n};version=1;low_floor=true;has_lift_or_ramp=false;has_hoist=no;length={n}.5"),
    ("StopPlace", "epip", "SiteFrame", "stopPlaces", '<StopPlace id="SP:{n}" version="1"><keyList><KeyValue><Key>k</Key><Value>{n}</Value></KeyValue></keyList><Name lang="de">Halt {n}</Name><ShortName>H</ShortName><PrivateCode>pc</PrivateCode><Centroid><Location><Longitude>11.{n}</Longitude><Latitude>46.{n}</Latitude></Location></Centroid><TransportMode>bus</TransportMode><StopPlaceType>onstreetBus</StopPlaceType><TopographicPlaceRef ref="TP:{n}"/></StopPlace>',
     "id=SP:{n};version=1;name=Halt {n};name_lang=de;short_name=H;private_code=pc;longitude=11.{n};latitude=46.{n};transport_mode=bus;stop_place_type=onstreetBus;topographic_place_ref=TP:{n}"),
    ("Quay", "epip", "SiteFrame", "stopPlaces", '<StopPlace id="SP:{n}" version="1"><quays><Quay id="Q:{n}" version="2"><Name lang="de">Steig</Name><ShortName>S</ShortName><PrivateCode>a</PrivateCode><PublicCode>b</PublicCode><Centroid><Location><Longitude>1</Longitude><Latitude>2</Latitude></Location></Centroid><QuayType>busStop</QuayType></Quay></quays></StopPlace>',
     "id=Q:{n};version=2;stop_place_id=SP:{n};name=Steig;name_lang=de;short_name=S;private_code=a;public_code=b;longitude=1;latitude=2;quay_type=busStop"),
    ("ScheduledStopPoint", "epip", "ServiceFrame", "scheduledStopPoints", '<ScheduledStopPoint id="SSP:{n}" version="1"><Name lang="de">Punkt</Name><ShortName>P</ShortName><Location><Longitude>3</Longitude><Latitude>4</Latitude></Location></ScheduledStopPoint>',
     "id=SSP:{n};version=1;name=Punkt;name_lang=de;short_name=P;longitude=3;latitude=4"),
    ("Direction", "epip", "ServiceFrame", "directions", '<Direction id="D:{n}" version="1"><DirectionType>outbound</DirectionType></Direction>', "id=D:{n};version=1;direction_type=outbound"),
    ("Route", "epip", "ServiceFrame", "routes", '<Route id="R:{n}" version="1"><Name>Weg</Name><Distance>{n}00</Distance><LineRef ref="L:{n}"/><DirectionType>inbound</DirectionType><DirectionRef ref="D:{n}"/><InverseRouteRef ref="R:x"/></Route>',
     "id=R:{n};version=1;name=Weg;distance={n}00;line_ref=L:{n};direction_type=inbound;direction_ref=D:{n};inverse_route_ref=R:x"),
    ("PointOnRoute", "epip", "ServiceFrame", "routes", '<Route id="R:{n}" version="1"><pointsInSequence><PointOnRoute id="POR:{n}" order="3"><RoutePointRef ref="SSP:{n}"/></PointOnRoute></pointsInSequence></Route>',
     "id=POR:{n};route_id=R:{n};order=3;scheduled_stop_point_ref=SSP:{n}"),
    ("Line", "epip", "ServiceFrame", "lines", '<FlexibleLine id="L:{n}" version="1" responsibilitySetRef="RS"><Name lang="de">Linie</Name><ShortName>L</ShortName><Description>d</Description><TransportMode>bus</TransportMode><TransportSubmode><BusSubmode>localBus</BusSubmode></TransportSubmode><Url>u</Url><PublicCode>{n}</PublicCode><PrivateCode>p</PrivateCode><OperatorRef ref="OP:{n}"/><AuthorityRef ref="AU:{n}"/><Monitored>true</Monitored><TypeOfLineRef ref="T"/></FlexibleLine>',
     "id=L:{n};version=1;responsibility_set_ref=RS;name=Linie;name_lang=de;short_name=L;description=d;transport_mode=bus;transport_submode=localBus;url=u;public_code={n};private_code=p;operator_ref=OP:{n};authority_ref=AU:{n};monitored=true;type_of_line_ref=T"),
    ("DestinationDisplay", "epip", "ServiceFrame", "destinationDisplays", '<DestinationDisplay id="DD:{n}" version="1"><SideText>s</SideText><FrontText>f {n}</FrontText></DestinationDisplay>', "id=DD:{n};version=1;side_text=s;front_text=f {n}"),
    ("ServiceJourneyPattern", "epip", "ServiceFrame", "journeyPatterns", '<ServiceJourneyPattern id="JP:{n}" version="1"><Name>Muster</Name><RouteRef ref="R:{n}"/></ServiceJourneyPattern>', "id=JP:{n};version=1;name=Muster;route_ref=R:{n}"),
    ("StopPointInJourneyPattern", "epip", "ServiceFrame", "journeyPatterns", '<ServiceJourneyPattern id="JP:{n}" version="1"><pointsInSequence><StopPointInJourneyPattern id="SPJ:{n}" version="1" order="2"><ScheduledStopPointRef ref="SSP:{n}"/><ForAlighting>true</ForAlighting><ForBoarding>false</ForBoarding><DestinationDisplayRef ref="DD:{n}"/><RequestStop>true</RequestStop></StopPointInJourneyPattern></pointsInSequence></ServiceJourneyPattern>',
     "id=SPJ:{n};version=1;journey_pattern_id=JP:{n};order=2;scheduled_stop_point_ref=SSP:{n};for_alighting=true;for_boarding=false;destination_display_ref=DD:{n};request_stop=true"),
    ("ServiceLink", "epip", "ServiceFrame", "serviceLinks", '<ServiceLink id="SL:{n}" version="1"><Distance>{n}</Distance><FromPointRef ref="a"/><ToPointRef ref="b"/></ServiceLink>', "id=SL:{n};version=1;distance={n};from_point_ref=a;to_point_ref=b"),
    ("SiteConnection", "epip", "ServiceFrame", "connections", '<DefaultConnection id="C:{n}" version="1"><WalkTransferDuration><DefaultDuration>PT{n}M</DefaultDuration></WalkTransferDuration><BothWays>true</BothWays><From><StopPlaceRef ref="SP:1"/><QuayRef ref="Q:1"/></From><To><StopPlaceRef ref="SP:2"/><QuayRef ref="Q:2"/></To></DefaultConnection>',
     "id=C:{n};version=1;default_duration=PT{n}M;both_ways=true;from_stop_place_ref=SP:1;from_quay_ref=Q:1;to_stop_place_ref=SP:2;to_quay_ref=Q:2"),
    ("Notice", "epip", "ServiceFrame", "notices", '<Notice id="N:{n}" version="1"><Text lang="de">Hinweis &amp; {n}</Text></Notice>', "id=N:{n};version=1;text=Hinweis & {n};text_lang=de"),
    ("PassengerStopAssignment", "epip", "ServiceFrame", "stopAssignments", '<PassengerStopAssignment id="PSA:{n}" version="1" order="{n}"><ScheduledStopPointRef ref="SSP:{n}"/><StopPlaceRef ref="SP:{n}"/><QuayRef ref="Q:{n}"/></PassengerStopAssignment>',
     "id=PSA:{n};version=1;order={n};scheduled_stop_point_ref=SSP:{n};stop_place_ref=SP:{n};quay_ref=Q:{n}"),
    ("DayType", "epip", "ServiceCalendarFrame", "dayTypes", '<DayType id="DT:{n}" version="1"><Name lang="de">Tag</Name></DayType>', "id=DT:{n};version=1;name=Tag"),
    ("UicOperatingPeriod", "epip", "ServiceCalendarFrame", "operatingPeriods", '<UicOperatingPeriod id="UP:{n}" version="1"><FromDate>2026-01-01</FromDate><ToDate>2026-02-01</ToDate><ValidDayBits>0101</ValidDayBits></UicOperatingPeriod>',
     "id=UP:{n};version=1;from_date=2026-01-01;to_date=2026-02-01;valid_day_bits=0101"),
    ("DayTypeAssignment", "epip", "ServiceCalendarFrame", "dayTypeAssignments", '<DayTypeAssignment id="DTA:{n}" version="1" order="4"><OperatingPeriodRef ref="UP:{n}"/><DayTypeRef ref="DT:{n}"/></DayTypeAssignment>', "id=DTA:{n};version=1;order=4;operating_period_ref=UP:{n};day_type_ref=DT:{n}"),
    ("ServiceJourney", "epip", "TimetableFrame", "vehicleJourneys", '<ServiceJourney id="SJ:{n}" version="1"><Name>Fahrt</Name><Distance>9</Distance><TransportMode>bus</TransportMode><TransportSubmode><BusSubmode>regionalBus</BusSubmode></TransportSubmode><DepartureTime>08:{n}</DepartureTime><dayTypes><DayTypeRef ref="DT:1"/><DayTypeRef ref="DT:{n}"/></dayTypes><ServiceJourneyPatternRef ref="JP:{n}"/><VehicleTypeRef ref="VT:{n}"/><OperatorRef ref="OP:{n}"/><LineRef ref="L:{n}"/><trainNumbers><TrainNumberRef ref="TN:{n}"/></trainNumbers></ServiceJourney>',
     "id=SJ:{n};version=1;name=Fahrt;distance=9;transport_mode=bus;transport_submode=regionalBus;departure_time=08:{n};day_type_ref=DT:{n};journey_pattern_ref=JP:{n};vehicle_type_ref=VT:{n};operator_ref=OP:{n};line_ref=L:{n};train_number_ref=TN:{n}"),
    ("TimetabledPassingTime", "epip", "TimetableFrame", "vehicleJourneys", '<ServiceJourney id="SJ:{n}" version="1"><passingTimes><TimetabledPassingTime id="TPT:{n}" version="1"><StopPointInJourneyPatternRef ref="SPJ:{n}" order="7"/><ArrivalTime>08:00</ArrivalTime><DepartureTime>08:01</DepartureTime><ArrivalDayOffset>0</ArrivalDayOffset><DepartureDayOffset>1</DepartureDayOffset></TimetabledPassingTime></passingTimes></ServiceJourney>',
     "id=TPT:{n};version=1;service_journey_id=SJ:{n};stop_point_in_jp_ref=SPJ:{n};order=7;arrival_time=08:00;departure_time=08:01;arrival_day_offset=0;departure_day_offset=1"),
    ("TrainNumber", "epip", "TimetableFrame", "trainNumbers", '<TrainNumber id="TN:{n}" version="1"><ForAdvertisement>R{n}</ForAdvertisement></TrainNumber>', "id=TN:{n};version=1;for_advertisement=R{n}"),
    ("DayType", "it-l2", "ServiceCalendarFrame", "dayTypes", '<DayType id="DT:{n}" version="1"><Name>Tag</Name><ShortName>T</ShortName><Description>d</Description><PrivateCode>p</PrivateCode></DayType>', "id=DT:{n};version=1;name=Tag;short_name=T;description=d;private_code=p"),
    ("Operator", "it-l2", "ResourceFrame", "organisations", '<Operator id="OP:{n}" version="1"><Name lang="it">Op</Name><ShortName>O</ShortName><LegalName>L</LegalName><TradingName>T</TradingName><PublicCode>a</PublicCode><PrivateCode>b</PrivateCode><CompanyNumber>{n}</CompanyNumber><Description>d</Description><OrganisationType>operator</OrganisationType><PrimaryMode>bus</PrimaryMode></Operator>',
     "id=OP:{n};version=1;name=Op;name_lang=it;short_name=O;legal_name=L;trading_name=T;public_code=a;private_code=b;company_number={n};description=d;organisation_type=operator;primary_mode=bus"),
    ("VehicleType", "it-l2", "ResourceFrame", "vehicleTypes", '<VehicleType id="VT:{n}" version="1"><Name>V</Name><Description>d</Description><PrivateCode>p</PrivateCode><LowFloor>true</LowFloor><HasLiftOrRamp>true</HasLiftOrRamp><HasHoist>false</HasHoist><Length>{n}</Length><FuelType>diesel</FuelType><EuroClass>6</EuroClass></VehicleType>',
     "id=VT:{n};version=1;name=V;description=d;private_code=p;low_floor=true;has_lift_or_ramp=true;has_hoist=false;length={n};fuel_type=diesel;euro_class=6"),
    ("JourneyAccounting", "it-l2", "GeneralFrame", "members", '<JourneyAccounting id="JA:{n}" version="1"><Name>J</Name><Description>d</Description><AccountedObjectRef ref="SJ:{n}"/><OrganisationRef ref="OP:{n}"/><SupplyContractRef ref="SC"/><AccountingCode>c</AccountingCode><AccountingType>t</AccountingType><Partial>false</Partial><Distance>{n}</Distance><Duration>PT1M</Duration></JourneyAccounting>',
     "id=JA:{n};version=1;name=J;description=d;accounted_object_ref=SJ:{n};organisation_ref=OP:{n};supply_contract_ref=SC;accounting_code=c;accounting_type=t;partial=false;distance={n};duration=PT1M"),
    ("GroupOfOperators", "it-l2", "GeneralFrame", "members", '<GroupOfOperators id="GO:{n}" version="1"><Name>G</Name><ShortName>g</ShortName><Description>d</Description><PrivateCode>p{n}</PrivateCode></GroupOfOperators>', "id=GO:{n};version=1;name=G;short_name=g;description=d;private_code=p{n}"),
)


def documents(spark: SparkSession, sf_dir: str, frame: str, collection: str, element: str) -> str:
    """A folder with an XML file for each nation: the element in its collection,
    among a collection and a frame that no profile knows."""
    odd = "<unknownThings><Line id='no'/></unknownThings>"
    text = (
        "<?xml version='1.0' encoding='UTF-8'?><PublicationDelivery xmlns='http://www.netex.org.uk/netex'><dataObjects><CompositeFrame id='c'><frames>"
        f"<OddFrame><lines><Line id='no'/></lines></OddFrame><{frame} id='f'>{odd}<{collection}>{element}</{collection}></{frame}>"
        f"</frames></CompositeFrame><CompositeFrame id='d'><frames><{frame}><{collection}>{element}</{collection}></{frame}></frames></CompositeFrame></dataObjects></PublicationDelivery>"
    )
    path = shared_dir(spark)
    n = read(spark, sf_dir, "nation")
    n.select("n_nationkey", F.replace(F.lit(text), F.lit("{n}"), F.col("n_nationkey").cast("string"))).repartition(5, "n_nationkey").write.partitionBy("n_nationkey").text(path)
    return path


def element(kind: str, profile: str, frame: str, collection: str, xml: str, fields: str) -> None:
    shown = dict(x.split("=", 1) for x in fields.split(";"))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = netex.read_xml(spark, documents(spark, sf_dir, frame, collection, xml), profile, types=[kind])
        return netex.table(rows, kind, profile).drop("_ord")

    number = [k for k, (t, p, *_) in enumerate(ELEMENTS) if (t, p) == (kind, profile)][0] + 1
    values = ", ".join(f"replace('{shown.get(f, '')}', '{{n}}', n_nationkey::varchar) as \"{f}\"" for f in netex.profile(profile)[0][kind][1].split())
    plain(f"n{number:02}_{netex.snake(kind)}{'_l2' if profile != 'epip' else ''}", f"select {values} from nation")(run)


for _e in ELEMENTS:
    element(*_e)


@plain("s15_s19_mixed_document", """select 'Authority' as type, 'AU:' || n_nationkey as id, 0::bigint as seq from nation union all select 'Operator', 'OP:' || n_nationkey, 1 from nation
union all select 'Route', 'R:' || n_nationkey, 3 from nation union all select 'PointOnRoute', 'POR:' || n_nationkey, 2 from nation""")
def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with collections of one kind and of several; children come first."""
    by = {(k, p): (f, c, x) for k, p, f, c, x, _ in ELEMENTS}
    several = by["Authority", "epip"][2] + "<Unknown id='u'/>" + by["Operator", "epip"][2]
    route = by["PointOnRoute", "epip"][2]
    path = documents(spark, sf_dir, "ResourceFrame", "organisations", f"{several}</organisations></ResourceFrame><ServiceFrame><routes>{route}</routes></ServiceFrame><ResourceFrame><organisations>")
    return netex.read_xml(spark, path).select("type", F.col("fields")["id"].alias("id"), "seq")


@plain("s20_s22_k01_q06_tables_and_back", """select 'StopPlace' as type, n_nationkey::varchar as id, n_name as name from nation union all select 'Quay', s_suppkey::varchar, s_name from supplier
union all select 'Line', (c_custkey % 100)::varchar, c_name from customer""")
def q06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities written as CSV tables and read as entities again."""
    folder = shared_dir(spark)
    kinds = ("StopPlace", "Quay", "Line")
    sinks.write_tables(entity_rows(spark, sf_dir), folder, types=kinds)
    sinks.write_tables(entity_rows(spark, sf_dir).withColumn("type", F.lit("Notice")), folder, types=["Notice"])  # a file that is not opened
    rows = netex.read_csv_folder(spark, folder, exclude=["Notice"])
    return rows.select("type", F.col("fields")["id"].alias("id"), F.col("fields")["name"].alias("name"))


# --- GTFS-Realtime ---------------------------------------------------------------


def vehicle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, vehicle) for each customer."""
    c = read(spark, sf_dir, "customer")
    trip = F.struct(F.concat(F.lit("T"), "c_custkey").alias("trip_id"), F.col("c_nationkey").alias("direction_id"))
    body = F.struct(trip.alias("trip"), F.struct(F.lit(46.5).cast("float").alias("latitude"), F.lit(-1.0).cast("float").alias("longitude")).alias("position"), F.lit("STOPPED_AT").alias("current_status"), (F.col("c_custkey") % 100).cast("long").alias("timestamp"))
    return c.select(F.concat(F.lit("V"), "c_custkey").alias("id"), body.alias("vehicle"))


#: The bytes by the public wire format, field by field: 1 id, 4 vehicle; in it 1
#: trip (1 trip_id, 6 direction_id), 2 position (two floats), 4 status, 5 time.
WIRE = """with t as (select c_custkey, 'V' || c_custkey as id, 'T' || c_custkey as trip, c_nationkey as d, c_custkey % 100 as ts from customer),
a as (select *, '0a' || printf('%02x', length(trip)) || lower(hex(encode(trip))) || '30' || printf('%02x', d) as trip_bytes from t),
b as (select *, '0a' || printf('%02x', length(trip_bytes) // 2) || trip_bytes || '120a0d00003a4215000080bf' || '2001' || case when ts = 0 then '' else '28' || printf('%02x', ts) end as body from a)
select id, '0a' || printf('%02x', length(id)) || lower(hex(encode(id))) || '22' || printf('%02x', length(body) // 2) || body as bytes from b"""


@plain("k05_r02_r03_r08_r09_vehicle_bytes", WIRE)
def k05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gtfsrt.written(vehicle_rows(spark, sf_dir), "protobuf").select("id", F.lower(F.hex("protobuf")).alias("bytes"))


# --- streams, stores, plugins --------------------------------------------------


@query("x05_st03_snapshot_store", "select route_short_name, count(*) as active_trips from trips join active using (service_id) join routes using (route_id) group by 1", ACTIVE)
def x05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query on a published version of the timetable; an older
    version, and a refresh that fails, do not matter."""
    snapshots = streaming.Snapshots(spark, shared_dir(spark))
    whole = feed(spark, sf_dir)
    snapshots.publish(Feed(**{t: df.limit(0) for t, df in whole.tables.items()}), "old")
    streaming.refresh(snapshots, lambda: whole, "new")
    streaming.refresh(snapshots, lambda: Feed(stops=whole.stops.select("nothing")), "bad")
    return snapshots.feed().trips_per_line(DATE)


@plain("st01_st07_stream_batches", """select (user_id % 10)::varchar as provider, arg_max(coalesce(props, '{}'), row(ts, coalesce(props, '{}'))) as payload, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) as timestamp,
  any_value(s_name) as stop_name from events join supplier on s_suppkey = user_id % 10 where user_id % 10 <> 3 group by 1""")
def st01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queued messages through a stream: the latest of each provider, joined with
    the snapshot. One provider has a stream of its own, whose rows are not taken."""
    queue, out, top = shared_dir(spark), shared_dir(spark), shared_dir(spark)
    e = read(spark, sf_dir, "events")
    sinks.publish(e.select((F.col("user_id") % 10).cast("string").alias("provider"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.lit("json").alias("format"), F.lit("siri").alias("protocol"), F.coalesce("props", F.lit("{}")).alias("payload")), queue, compress=True)
    snapshots = streaming.Snapshots(spark, f"{top}/static")
    snapshots.publish(Feed(stops=feed(spark, sf_dir).stops), "v1")

    def handle(rows: DataFrame, static: Feed) -> None:
        named = rows.join(static.stop().select(F.col("stop_id").alias("provider"), "stop_name"), "provider")
        named.select("provider", "payload", "timestamp", "stop_name").write.mode("append").parquet(out)

    stream = streaming.messages(spark, queue)
    streaming.supervise(lambda: streaming.run(stream.where("provider <> '3'"), handle, snapshots, f"{top}/all"), most=1)
    alone: list[int] = []
    streaming.run(stream, lambda rows, _: alone.append(rows.count()), snapshots, f"{top}/one", provider="3").awaitTermination()
    return spark.read.schema("provider string, payload string, timestamp string, stop_name string").parquet(out)


@plain("x03_x04_own_profile", "select 'N:' || n_nationkey as id, 'v' || n_nationkey as variant, n_name as text from nation")
def x03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile that adds a frame, an entity and its table to another one."""
    netex.register_profile("own", {"Hint": ("hints", "id variant text")}, {"HintFrame": {"hints": "Hint"}})
    text = "<PublicationDelivery><dataObjects><CompositeFrame><frames><HintFrame><hints><Hint id='N:{n}'><Variant>v{n}</Variant><Text>{t}</Text><Other>x</Other></Hint></hints></HintFrame></frames></CompositeFrame></dataObjects></PublicationDelivery>"
    path, n = shared_dir(spark), read(spark, sf_dir, "nation")
    filled = F.replace(F.replace(F.lit(text), F.lit("{n}"), F.col("n_nationkey").cast("string")), F.lit("{t}"), F.col("n_name"))
    n.select("n_nationkey", filled).repartition(5, "n_nationkey").write.partitionBy("n_nationkey").text(path)
    return netex.table(netex.read_xml(spark, path, "own"), "Hint", "own").drop("_ord")


@plain("s26_s27_formats", """select o_orderkey, case o_orderkey % 6 when 0 then 'json' when 1 then 'xml' when 2 then 'xml' when 3 then 'xml' else 'json' end as format from orders""")
def s26(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the name's end, else by the first character of what is there."""
    pick = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", pick("a.JSON", "a.xml", "a", "", "a.txt", "xml").alias("path"), pick("<x/>", "{}", "  <x/>", "\ufeff<x/>", "{}", "").alias("head"))
    return rows.select("o_orderkey", siri.format_of(F.col("path"), F.col("head")).alias("format"))


@plain("a13_m03_last_of_a_key", "select c_nationkey, max(c_custkey) as c_custkey, arg_max(c_name, c_custkey) as c_name from customer group by 1")
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index by key in which later rows replace earlier ones."""
    return last_of(read(spark, sf_dir, "customer"), ["c_nationkey"], ["c_custkey"]).select("c_nationkey", "c_custkey", "c_name")


@plain("m02_m04_m06_maps_and_arrays", """select c_custkey, c_name as name, c_custkey % 3 = 0 as has_code, coalesce(case when c_custkey % 3 = 0 then c_mktsegment end, '') as code,
  case when c_custkey % 3 = 0 then 'id,name,code,end' else 'id,name,end' end as keys from customer""")
def m02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map from a row's cells, tests of its keys, and arrays put together."""
    c = read(spark, sf_dir, "customer")
    base = F.create_map(F.lit("id"), F.col("c_custkey").cast("string"), F.lit("name"), F.col("c_name"))
    fields = F.when(F.col("c_custkey") % 3 == 0, F.map_concat(base, F.create_map(F.lit("code"), F.col("c_mktsegment")))).otherwise(base)
    rows = c.select("c_custkey", F.lit("Line").alias("type"), F.lit("f").alias("file"), F.col("c_custkey").alias("seq"), fields.alias("fields"))
    code = F.coalesce(F.try_element_at("fields", F.lit("code")), F.lit(""))
    return rows.select("c_custkey", F.col("fields")["name"].alias("name"), F.map_contains_key("fields", "code").alias("has_code"), code.alias("code"), F.array_join(F.concat(F.map_keys("fields"), F.array(F.lit("end"))), ",").alias("keys"))
