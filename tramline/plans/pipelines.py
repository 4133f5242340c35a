"""Queries of streams, observed counts, table functions and messages written again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from .. import sinks, streaming
from ..operators import linkage as link
from ..operators.feed import Feed
from ..schemas import CALL
from ..session import shared_dir
from ..sources import netex, siri, strict
from .adapters import feed
from .queries import ACTIVE, FOLD, LIVE, STARTS, both_phases, query
from .scans import ACTIVITIES, ACTIVITY, CALLS_OF_JOURNEYS, SITUATIONS, estimated_messages, plain, read, shown_calls, shown_situations, situation_messages, vehicle_messages

STAMP = "2026-03-01T10:00:00Z"


@plain("k07_estimated_json", CALLS_OF_JOURNEYS)
def k07_estimated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimated journeys read, written as messages again and read."""
    rows = siri.journeys(estimated_messages(spark, sf_dir))
    place = ["message", "frame", "position"]
    calls = fn.array_or_object(F.col("journey.EstimatedCalls.EstimatedCall"), CALL)
    each = rows.select(*place, "journey", calls.alias("calls"))
    journey = F.struct(F.col("journey.LineRef").alias("LineRef"), F.col("journey.FramedVehicleJourneyRef").alias("FramedVehicleJourneyRef"), F.when(F.size("calls") > 0, F.struct(F.col("calls").alias("EstimatedCall"))).alias("EstimatedCalls"))
    each = each.select(*place, journey.alias("journey"))
    frames = each.groupBy("message", "frame").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "journey"))), lambda j: j["journey"]).alias("EstimatedVehicleJourney"))
    whole = frames.groupBy("message").agg(F.transform(F.array_sort(F.collect_list(F.struct("frame", "EstimatedVehicleJourney"))), lambda f: F.struct(f["EstimatedVehicleJourney"].alias("EstimatedVehicleJourney"))).alias("frames"))
    return shown_calls(siri.journeys(whole.select("message", siri.to_json(F.col("frames"), "ET", F.lit(STAMP)).alias("payload"))))


@plain("k07_situations_json", SITUATIONS)
def k07_situations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Situations read, written as messages again and read."""
    rows = siri.situations(situation_messages(spark, sf_dir))
    reasons = F.transform("reasons", lambda r: F.struct(r["lang"].alias("@xml:lang"), r["text"].alias("#text")))
    affects = F.struct(F.struct(F.col("stops").alias("AffectedStopPoint")).alias("StopPoints"), F.struct(F.transform("networks", lambda n: F.struct(n.alias("AffectedLine"))).alias("AffectedNetwork")).alias("Networks"))
    item = F.struct(F.col("situation.SituationNumber").alias("SituationNumber"), F.col("periods").alias("ValidityPeriod"), reasons.alias("ReasonName"), affects.alias("Affects"), F.struct(F.col("consequences").alias("Consequence")).alias("Consequences"))
    whole = rows.groupBy("message").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", item.alias("item")))), lambda s: s["item"]).alias("items"))
    return shown_situations(siri.situations(whole.select("message", siri.to_json(F.col("items"), "SE", F.lit(STAMP)).alias("payload"))))


@plain("n31_validity_and_keys", """select 'SP:' || c_custkey as id, c_name as name, c_mktsegment as key_segment, case when c_custkey % 2 = 0 then 'second' else '' end as key_other,
  '2026-01-01' as valid_from, case when c_custkey % 3 = 0 then '' else '2026-12-31' end as valid_to from customer""")
def n31(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key lists and validity of the stop places of a few files."""
    c = read(spark, sf_dir, "customer")
    pair = lambda key, value: F.concat(F.lit(f"<KeyValue><Key>{key}</Key><Value>"), value, F.lit("</Value></KeyValue>"))
    keys = F.concat(pair("segment", F.col("c_mktsegment")), F.when(F.col("c_custkey") % 2 == 0, pair("other", F.lit("second"))).otherwise("<KeyValue><Key>other</Key></KeyValue>"))
    valid = F.concat(F.lit("<ValidBetween><FromDate>2026-01-01</FromDate>"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise("<ToDate>2026-12-31</ToDate>"), F.lit("</ValidBetween>"))
    stop = F.concat(F.lit("<StopPlace id='SP:"), "c_custkey", F.lit("'><keyList>"), keys, F.lit("</keyList>"), valid, F.lit("<Name>"), "c_name", F.lit("</Name></StopPlace>"))
    head = "<PublicationDelivery><dataObjects><CompositeFrame><frames><SiteFrame><stopPlaces>"
    tail = "</stopPlaces></SiteFrame></frames></CompositeFrame></dataObjects></PublicationDelivery>"
    rows = c.select(F.floor(F.col("c_custkey") / 5_000).alias("file"), stop.alias("xml")).groupBy("file").agg(F.concat(F.lit(head), F.array_join(F.collect_list("xml"), ""), F.lit(tail)).alias("value"))
    folder = shared_dir(spark)
    rows.repartition("file").write.partitionBy("file").text(folder)
    get = lambda f: F.coalesce(F.try_element_at("fields", F.lit(f)), F.lit(""))
    found = netex.read_xml(spark, folder, types=["StopPlace"])
    return found.select(get("id").alias("id"), get("name").alias("name"), get("key:segment").alias("key_segment"), get("key:other").alias("key_other"), get("valid_between_from").alias("valid_from"), get("valid_between_to").alias("valid_to"))


@plain("x03_table_function", "select c_custkey, 'L:' || c_custkey as id, c_name as name, c_mktsegment as public_code from customer union all select c_custkey, 'M:' || c_custkey, '', '' from customer")
def x03_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile's table of each file, in SQL."""
    netex.register_table_function(spark)
    text = "<PublicationDelivery><dataObjects><CompositeFrame><frames><ServiceFrame><lines><Line id='L:{k}'><Name>{n}</Name><PublicCode>{s}</PublicCode></Line><Line id='M:{k}'/></lines></ServiceFrame></frames></CompositeFrame></dataObjects></PublicationDelivery>"
    filled = F.lit(text)
    for mark, column in (("{k}", "c_custkey"), ("{n}", "c_name"), ("{s}", "c_mktsegment")):
        filled = F.replace(filled, F.lit(mark), F.col(column).cast("string"))
    files = read(spark, sf_dir, "customer").select("c_custkey", F.encode(filled, "utf-8").alias("content"))
    return spark.sql("select c_custkey, t.id, t.name, t.public_code from {files}, lateral netex_table(content, 'Line', 'epip') t", files=files)


@query("a12_observed_statistics", """select count(*) as journeys, count(s.trip_id) as phase_a, count(case when s.trip_id is null then f.trip_id end) as phase_b,
  count(*) filter (where s.trip_id is null and f.trip_id is null) as unresolved,
  round(100.0::double * count(*) filter (where s.trip_id is null and f.trip_id is null) / count(*), 6) as unresolved_percent
from live l left join started s on s.journey = l.ord left join fold f on f.visit = l.ord""", LIVE, ACTIVE, STARTS, FOLD)
def a12_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts taken while the resolved rows were written, not by resolving again."""
    rows, seen = link.observed(both_phases(spark, sf_dir))
    rows.write.parquet(shared_dir(spark))
    return spark.createDataFrame([seen.get], "journeys long, phase_a long, phase_b long, unresolved long, unresolved_percent double")


def queue(spark: SparkSession, sf_dir: str) -> str:
    """The events as queued messages of ten providers."""
    folder, e = shared_dir(spark), read(spark, sf_dir, "events")
    sinks.publish(e.select((F.col("user_id") % 10).cast("string").alias("provider"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.lit("json").alias("format"), F.lit("siri").alias("protocol"), F.coalesce("props", F.lit("{}")).alias("payload")), folder, compress=True)
    return folder


LATEST = """select (user_id % 10)::varchar as provider, arg_max(coalesce(props, '{}'), row(ts, coalesce(props, '{}'))) as payload, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) as timestamp,
  'h' || (user_id % 10) as handler, any_value(s_name) as stop_name from events join supplier on s_suppkey = user_id % 10 where user_id % 10 < 6 group by 1, 4"""


def taken(name: str, out: str):
    """A handler that notes its name beside each message and its stop."""

    def handle(rows: DataFrame, static: Feed) -> None:
        named = rows.join(static.stop().select(F.col("stop_id").alias("provider"), "stop_name"), "provider")
        named.select("provider", "payload", "timestamp", F.lit(name).alias("handler"), "stop_name").write.mode("append").parquet(out)

    return handle


@plain("st03_st04_fan_out", LATEST)
def st04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six handlers on one query, which reads the queue once, and one version of
    the timetable for all, though a newer one is published meanwhile."""
    top, out = shared_dir(spark), shared_dir(spark)
    snapshots = streaming.Snapshots(spark, f"{top}/static")
    snapshots.publish(Feed(stops=feed(spark, sf_dir).stops), "v1")
    handlers = {str(k): taken(f"h{k}", out) for k in range(6)}
    first = handlers["0"]

    def publishing(rows: DataFrame, static: Feed) -> None:
        first(rows, static)
        snapshots.publish(Feed(stops=feed(spark, sf_dir).stops.withColumn("stop_name", F.lit("later"))), "v2")

    streaming.fan_out(streaming.messages(spark, queue(spark, sf_dir)), handlers | {"0": publishing}, snapshots, f"{top}/check").awaitTermination()
    return spark.read.schema("provider string, payload string, timestamp string, handler string, stop_name string").parquet(out)


@plain("st05_st06_fail_fast", LATEST.replace("'h' || (user_id % 10)", "'second try'"))
def st06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transformer that fails stops its batch before anything is written; the
    query starts again and the batch runs again, on the version that it saw."""
    top, out = shared_dir(spark), shared_dir(spark)
    snapshots = streaming.Snapshots(spark, f"{top}/static")
    snapshots.publish(Feed(stops=feed(spark, sf_dir).stops), "v1")
    tries: list[int] = []

    def handle(rows: DataFrame, static: Feed) -> None:
        tries.append(1)
        bad = F.raise_error("a message that cannot be transformed") if len(tries) == 1 else F.lit("second try")
        checked = rows.withColumn("payload", F.when((F.col("provider") != "5") | F.lit(len(tries) > 1), F.col("payload")).otherwise(bad))
        taken("second try", out)(checked, static)
        snapshots.publish(Feed(stops=feed(spark, sf_dir).stops.withColumn("stop_name", F.lit("later"))), f"v{len(tries) + 1}")

    stream = streaming.messages(spark, queue(spark, sf_dir)).where("provider < '6'")
    streaming.supervise(lambda: streaming.run(stream, handle, snapshots, f"{top}/check"), pause=0, most=2)
    return spark.read.schema("provider string, payload string, timestamp string, handler string, stop_name string").parquet(out)


def altered(messages: DataFrame) -> DataFrame:
    """Messages of which some have a number or boolean in a string field, keys in
    another case, a cut end, or a key that nobody knows."""
    case, p = F.pmod("message", F.lit(7)), F.col("payload")
    changed = (
        F.when(case == 1, F.regexp_replace(p, r'"StopPointRef":"([0-9]+)"', r'"StopPointRef":$1'))
        .when(case == 2, F.replace(F.replace(p, F.lit('"LineRef"'), F.lit('"lineREF"')), F.lit('"VehicleActivity"'), F.lit('"vehicleactivity"')))
        .when(case == 3, F.regexp_replace(p, r'"VehicleAtStop":"(\w+)"', r'"VehicleAtStop":$1'))
        .when(case == 4, F.substr(p, F.lit(1), F.length(p) - 1))
        .when(case == 5, F.concat(F.lit('{"Extra":[1,{}],'), F.substr(p, F.lit(2))))
    )
    return messages.withColumn("payload", F.coalesce(changed, p))


#: The message that an event is in, as the feeds of scans deal them, and its case.
ALTERED = "(case when event_id % 4 = 0 then -1 - event_id else event_id // 4 end)"
CASE = f"((({ALTERED} % 7) + 7) % 7)"


@plain("j08_strict_activities", f"{ACTIVITIES} where {CASE} not in (1, 3, 4)")
def j08_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = strict.vehicle_activities(altered(vehicle_messages(spark, sf_dir)))
    return siri.flattened(rows).withColumnRenamed("_ord", "position").select(*ACTIVITY)


@plain("j08_refused_messages", f"""select distinct {ALTERED}::bigint as message, case {CASE}
  when 1 then 'ServiceDelivery.VehicleMonitoringDelivery.VehicleActivity.MonitoredVehicleJourney.MonitoredCall.StopPointRef'
  when 3 then 'ServiceDelivery.VehicleMonitoringDelivery.VehicleActivity.MonitoredVehicleJourney.MonitoredCall.VehicleAtStop'
  else '$' end as refused from events where {CASE} in (1, 3, 4)""")
def j08_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages that are refused, each with the place of its first fault."""
    return strict.checked(altered(vehicle_messages(spark, sf_dir)), "VM").where("refused is not null").select("message", "refused")


@plain("j08_strict_calls", f"{CALLS_OF_JOURNEYS} where o_custkey % 5 <> 0")
def j08_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames, journeys and calls of one parse; each fifth customer's message has
    numbers for visits and is refused whole."""
    rows = estimated_messages(spark, sf_dir)
    numbers = F.regexp_replace("payload", r'"VisitNumber":"([0-9]+)"', r'"VisitNumber":$1')
    return shown_calls(strict.journeys(rows.withColumn("payload", F.when(F.col("message") % 5 == 0, numbers).otherwise(F.col("payload")))), strict.calls)


@plain("j08_strict_situations", SITUATIONS)
def j08_situations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown_situations(siri.details(strict.situations(situation_messages(spark, sf_dir))))
