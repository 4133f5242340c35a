"""Transit operators on small hand-made tables, and queries against SQL."""

from __future__ import annotations

import http.server
import json
import threading
import zipfile

import pytest
from pyspark.sql import functions as F

from tramline import functions as fn
from tramline import sinks, streaming
from tramline.operators import linkage as link
from tramline.operators.feed import Feed
from tramline.operators.rows import best, first_of, last_of
from tramline.plans import transforms
from tramline.sources import gtfs, gtfsrt, netex, remote, siri


def values(spark, call, given, kind="string"):
    df = spark.createDataFrame([(k, g) for k, g in enumerate(given)], f"k int, g {kind}")
    return [r["r"] for r in df.select("k", call(F.col("g")).alias("r")).orderBy("k").collect()]


@pytest.mark.parametrize(("call", "given", "expected"), [
    (fn.gtfs_time, ["25:30:00", " 8:05:09 ", "1:2", "a:1:2", None, "1: 2:3", "-1:00:00"], [91800, 29109, -1, -1, -1, -1, -3600]),
    (fn.gtfs_date, ["20261399", "2026", "2026010a", "-1234567", " 20260102 ", None], [20261399, 0, 0, -1234567, 20260102, 0]),
    (fn.whole_number, ["1.5", "", "+7", "99999999999", None, " 3 "], [0, 0, 7, 0, 0, 3]),
    (fn.real_number, ["1.5", "x", "", None], [1.5, 0.0, 0.0, 0.0]),
    (fn.flag, ["1", " 1 ", "true", None], [True, True, False, False]),
    (fn.trim_colon, ["a::", "a", ":", ""], ["a:", "a", "", ""]),
    (fn.journey_base, ["it:apb:ServiceJourney:a:b:", "it:apb:ServiceJourney:ab", "x", "it:apb:ServiceJourney::b"], ["a", "ab", "", ":b"]),
    (fn.live_journey_base, ["x:it:apb:ServiceJourney:a:1_", "it:apb:ServiceJourney:a:b:", "none"], ["a", "a:b", ""]),
    (fn.direction_suffix, ["a:b:H:", "H", "a:R"], ["H", "H", "R"]),
    (fn.epoch, ["2026-03-01T10:20:30.7Z", "2026-03-01T10:20:30+01:00", "2026-03-01", "2026-03", "x", None], [1772360430, 1772356830, 1772323200, None, None, None]),
    (fn.wall_clock, ["2026-03-01T10:20:30+09:00", "2026-03-01", "x"], [37230, 0, None]),
    (fn.duration, ["PT1M30S", "-PT90S", "P1DT2H", "P3M", "PT1.5S", "", "x", None], [90, -90, 0, 180, 0, 0, 0, 0]),
    (fn.live_direction, ["1", "2", "7", "0", "-4", "x", None], [1, 0, 6, 0, 0, 0, 0]),
    (fn.language, ["de", "LAD", "Fr"], ["de", "lld", "fr"]),
    (fn.cause, ["strike", "x"], ["STRIKE", "UNKNOWN_CAUSE"]),
])
def test_scalars(spark, call, given, expected):
    assert values(spark, call, given) == expected


def test_numbers_as_text(spark):
    assert values(spark, fn.format_time, [91800, -1, 61], "int") == ["25:30:00", "", "00:01:01"]
    assert values(spark, fn.format_date, [20260102, 0, 12], "int") == ["20260102", "", "00000012"]
    assert values(spark, fn.weekday, [20261399, 19980302], "int") == [4, 0]
    with pytest.raises(Exception, match="bad date"):
        values(spark, fn.strict_date, ["x"])


def test_array_or_object(spark):
    got = values(spark, lambda c: fn.array_or_object(c, "a string"), ['[{"a":"1"},{"a":"2"}]', '{"a":"3"}', None, "null", "5"])
    assert [None if g is None else [x["a"] for x in g] for g in got] == [["1", "2"], ["3"], [], [], None]


def test_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("b", 2, None)], "k string, _ord int, v string")
    assert {r["k"]: r["v"] for r in last_of(df, ["k"]).collect()} == {"a": "z", "b": None}
    assert {r["k"]: r["v"] for r in first_of(df, ["k"], ["_ord"]).collect()} == {"a": "x", "b": None}
    assert best(df, F.lit(0)).count() == 0
    assert best(df, F.lit(1)).first()["v"] == "x"


def small_feed(spark):
    make = spark.createDataFrame
    days = ", ".join(f"{d} boolean" for d in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"))
    week = [True, True, True, True, True, False, False]
    return Feed(
        routes=make([("R1", "1", "one", 3, 0), ("R2", "1", "uno", 3, 1), ("R3", "", "none", 3, 2)], "route_id string, route_short_name string, route_long_name string, route_type int, _ord int"),
        trips=make([("T1", "R1", "S", 0, 0), ("T2", "R2", "S", 1, 1), ("T3", "R1", "X", 0, 2), ("T4", "R3", "Y", 0, 3)], "trip_id string, route_id string, service_id string, direction_id int, _ord int"),
        stop_times=make(
            [("T1", "A", 1, 36000, 36000, 0), ("T1", "B", 2, 36300, 36300, 1), ("T1", "A", 3, 36600, -1, 2), ("T2", "A", 1, 36100, 36100, 3), ("T3", "A", 1, 36010, 36010, 4)],
            "trip_id string, stop_id string, stop_sequence int, arrival_time int, departure_time int, _ord int",
        ),
        stops=make([("A", "Alpha", 0, "P", 0), ("B", "beta", 0, "", 1), ("P", "Place", 1, "", 2), ("it:22021:c", "c", 0, "", 3)], "stop_id string, stop_name string, location_type int, parent_station string, _ord int"),
        calendar=make([("S", *week, 20260101, 20261231, 0), ("X", *week, 20260101, 20261231, 1)], f"service_id string, {days}, start_date int, end_date int, _ord int"),
        calendar_dates=make([("X", 20260302, 2, 0), ("X", 20260302, 1, 1), ("Y", 20260302, 1, 2), ("S", 20260303, 5, 3)], "service_id string, date int, exception_type int, _ord int"),
    )


def test_calendar(spark):
    f = small_feed(spark)
    runs = lambda d: {r["service_id"] for r in f.active_services(d).collect()}
    assert runs(20260302) == {"S", "Y"} and runs(20260303) == {"X"} and runs(20260307) == set() and runs(20270104) == set()
    assert {r["trip_id"] for r in f.active_trips(20260302).collect()} == {"T1", "T2", "T4"}
    assert f.count_active_services(20260302).first()[0] == 1
    days = spark.createDataFrame([(20260302,), (20260303,), (20260307,), (0,)], "date int")
    assert {tuple(r) for r in link.running_on_any(f, days).collect()} == {(20260302, "S"), (20260302, "Y"), (20260303, "X")}


def test_lookups(spark):
    f = small_feed(spark)
    assert f.stops_by_name("ALPHA").first()["stop_id"] == "A" and f.routes_by_short_name("").count() == 0
    assert [r["trip_id"] for r in f.trips_for_line("1", 20260302).collect()] == ["T1", "T2"]
    assert {r["trip_id"] for r in f.find_trips_where(lambda t: F.size(t["stops"]) == 0).collect()} == {"T4"}
    assert f.match_trip(lambda t: F.size(t["stops"])).first()["trip_id"] == "T1"
    shown = {r["stop_id"]: r for r in f.inspect_stop().collect()}
    assert shown["P"]["children"] == 1 and shown["A"]["visits"] == 4 and shown["A"]["trip_ids"] == "T1,T1,T2,T3"


def test_fold_is_not_the_best_score(spark):
    rows = [(1, 0, 10, 0, "a"), (1, 1, 14, 1, "b"), (1, 2, 13, 0, "c")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "visit int, time_ord int, diff int, trip_direction int, trip_id string, direction_id int")
    assert link.folded(df, "visit").first()["trip_id"] == "c"


def test_nearest_start_falls_back_before_the_times(spark):
    f = small_feed(spark)
    asked = spark.createDataFrame([("j1", "1", 0, 36050, 20260302), ("j2", "1", 1, 36010, 20260302), ("j3", "1", 5, 36060, 20260302), ("j4", "", 0, 36000, 20260302), ("j5", "1", 0, 40000, 20260302)], "journey string, code string, direction_id int, clock int, date int")
    got = {r["journey"]: r["trip_id"] for r in link.nearest_start(asked, f, link.running(f, [20260302])).collect()}
    assert got == {"j1": "T1", "j2": "T2", "j3": "T2"}


def test_stop_references_and_occurrences(spark):
    f = small_feed(spark)
    refs = spark.createDataFrame([("A",), ("it:22021:C",), (fn.STOP_POINT + "c",), ("zz",)], "ref string")
    assert {r["ref"]: r["stop_id"] for r in link.resolve_stop(refs, f, "ref").collect()} == {"A": "A", "it:22021:C": "it:22021:c", fn.STOP_POINT + "c": "it:22021:c", "zz": ""}
    calls = spark.createDataFrame([("j", "T1", "A", 1), ("j", "T1", "A", 2), ("j", "T1", "A", 3), ("j", "T1", "Q", 4)], "journey string, trip_id string, stop_id string, position int")
    assert {r["position"]: r["stop_sequence"] for r in link.nth_occurrence(calls, f, "journey").collect()} == {1: 1, 2: 3}


def test_timetable_chain(spark):
    make = spark.createDataFrame
    chain = link.line_chain(
        make([("it:apb:ServiceJourney:1:a:", "JP:1", 0), ("it:apb:ServiceJourney:2", "JP:2:", 1)], "id string, journey_pattern_ref string, _ord int"),
        make([("JP:1:", "RT:1", 0), ("JP:2", "RT:1", 1)], "id string, route_ref string, _ord int"),
        make([("RT:1:", "LN:1", "d:R:", 0)], "id string, line_ref string, direction_ref string, _ord int"),
        make([("LN:1:", "7", 0)], "id string, public_code string, _ord int"),
    )
    assert [tuple(r) for r in chain.collect()] == [("it:apb:ServiceJourney:1:a:", "LN:1:", "7", "R")]


VM = {"Siri": {"ServiceDelivery": {"VehicleMonitoringDelivery": {"VehicleActivity": {
    "RecordedAtTime": "2026-03-02T10:01:30Z", "MonitoredVehicleJourney": {
        "LineRef": "zzz", "DirectionRef": "2", "PublishedLineName": "1", "VehicleRef": "1001", "Delay": "PT1M30S", "FramedVehicleJourneyRef": {"DataFrameRef": "2026-03-02"},
        "VehicleLocation": {"Longitude": "11.3", "Latitude": "bad"}, "MonitoredCall": {"StopPointRef": "A", "VehicleAtStop": "true"}}}}}}}


def test_vehicle_positions_from_json(spark, tmp_path):
    f = small_feed(spark)
    later = json.loads(json.dumps(VM))
    later["Siri"]["ServiceDelivery"]["VehicleMonitoringDelivery"]["VehicleActivity"] = [VM["Siri"]["ServiceDelivery"]["VehicleMonitoringDelivery"]["VehicleActivity"]] * 2
    for message in (VM, later):
        rows = siri.flat_activities(spark.createDataFrame([(json.dumps(message),)], "payload string"))
        made = transforms.vehicle_positions(rows, f)
        (p,) = made.collect()
        assert (p["entity_id"], p["trip_id"], p["route_id"], p["stop_id"], p["current_status"], p["start_date"], p["latitude"], p["timestamp"]) == ("1001", "T1", "R1", "A", "STOPPED_AT", "20260302", 0.0, 1772445690)
    entities = gtfsrt.vehicle_entities(made)
    protobuf, text = gtfsrt.feed_bytes(entities, 99)
    back = gtfsrt.decode(protobuf)
    assert back["header"]["timestamp"] == 99 and back["entity"][0]["vehicle"]["trip"]["trip_id"] == "T1" and back["entity"][0]["vehicle"]["current_status"] == "STOPPED_AT"
    assert json.loads(text)["entity"][0]["vehicle"]["vehicle"] == {"id": "1001", "label": "1"}
    sinks.dump(entities, 99, f"{tmp_path}/v.pb")
    sinks.dump(entities, 99, f"{tmp_path}/v.json")
    read = gtfsrt.read(spark, f"{tmp_path}/v.*").collect()
    assert len(read) == 2 and {r["entity"]["vehicle"]["trip"]["route_id"] for r in read} == {"R1"}


def test_estimated_journeys_from_json(spark):
    f = small_feed(spark)
    call = lambda ref, late: {"StopPointRef": ref, "AimedArrivalTime": "2026-03-02T10:00:00Z", "ExpectedArrivalTime": f"2026-03-02T10:0{late}:00Z"}
    journey = {"LineRef": "1", "OriginAimedDepartureTime": "2026-03-02T10:00:00Z", "EstimatedCalls": {"EstimatedCall": [call("A", 1), {"StopPointRef": "B"}, call("A", 2)]}}
    feed_json = {"ServiceDelivery": {"EstimatedTimetableDelivery": {"EstimatedJourneyVersionFrame": {"EstimatedVehicleJourney": journey}}}}
    rows = siri.journeys(spark.createDataFrame([(json.dumps(feed_json),)], "payload string"))
    calls = siri.calls(rows)
    j = rows.select(F.lit("j").alias("journey"), F.lit("").alias("journey_ref"), F.col("journey.LineRef").alias("line_ref"), F.col("journey.OriginAimedDepartureTime").alias("origin_departure"), F.lit(None).cast("string").alias("recorded_at"), F.lit("2026-03-02").alias("date"))
    c = calls.select(F.lit("j").alias("journey"), F.col("call_position").alias("position"), F.col("call.StopPointRef").alias("stop_ref"), F.col("call.AimedArrivalTime").alias("aimed_arrival"), F.col("call.ExpectedArrivalTime").alias("expected_arrival"), F.col("call.AimedDepartureTime").alias("aimed_departure"), F.col("call.ExpectedDepartureTime").alias("expected_departure"))
    made = transforms.trip_updates(j, c, f, spark.createDataFrame([("j", "T1")], "journey string, trip_id string"), F.lit(5).cast("long"))
    (u,) = made.collect()
    assert u["entity_id"] == "et-1-2026-03-02T10:00:00Z" and u["timestamp"] == 5
    assert [(x["stop_sequence"], x["arrival_delay"], x["departure_delay"]) for x in u["stop_time_updates"]] == [(1, 60, None), (3, 120, None)]
    (counts,) = transforms.audit(made, f, link.running(f, [20260302])).collect()
    assert (counts["updates"], counts["calls"], counts["repeated_sequences"], counts["unknown_trips"], counts["inactive_trips"]) == (1, 2, 0, 0, 0)
    data = gtfsrt.decode(gtfsrt.feed_bytes(gtfsrt.trip_entities(made), 1)[0])
    assert data["entity"][0]["trip_update"]["stop_time_update"][1] == {"stop_sequence": 3, "arrival": {"delay": 120}, "stop_id": "A"}


def test_situations_from_json(spark):
    one = {"SituationNumber": "SIT1", "AlertCause": "strike", "ValidityPeriod": {"StartTime": "2026-03-01"}, "ReasonName": {"@xml:lang": "DE", "#text": "Streik"},
           "Affects": {"StopPoints": {"AffectedStopPoint": {"StopPointRef": "A"}}, "Networks": {"AffectedNetwork": {"AffectedLine": {"LineRef": "1"}}}},
           "Consequences": {"Consequence": [{"Condition": "delayed", "Severity": "severe"}]}}
    two = {"SituationNumber": "SIT2", "ValidityPeriod": {"StartTime": ""}}
    payload = json.dumps({"ServiceDelivery": {"SituationExchangeDelivery": {"Situations": {"PtSituationElement": [one, two]}}}})
    rows = siri.situations(spark.createDataFrame([(payload,)], "payload string"))
    s = rows.select(F.col("situation.SituationNumber").alias("situation"), F.col("situation.AlertCause").alias("cause"), F.get("consequences", F.lit(0))["Condition"].alias("condition"), F.get("consequences", F.lit(0))["Severity"].alias("severity"), "periods", "reasons")
    stops = rows.select(F.col("situation.SituationNumber").alias("situation"), F.posexplode("stops").alias("position", "s")).select("situation", "position", F.col("s.StopPointRef").alias("stop_ref"))
    lines = rows.select(F.col("situation.SituationNumber").alias("situation"), F.posexplode(F.flatten("networks")).alias("position", "l")).select("situation", "position", F.col("l.LineRef").alias("line_ref"), F.col("l.PublishedLineName").alias("line_name"))
    got = {r["entity_id"]: r for r in transforms.alerts(s, stops, lines, small_feed(spark)).collect()}
    assert [(e["stop_id"], e["route_id"]) for e in got["SIT1"]["informed_entity"]] == [("A", None), (None, "R1"), (None, "R2")]
    assert got["SIT1"]["effect"] == "SIGNIFICANT_DELAYS" and got["SIT1"]["severity_level"] == "SEVERE" and got["SIT1"]["header_text"][0]["language"] == "de"
    assert got["SIT2"]["informed_entity"] == [] and got["SIT2"]["effect"] is None and got["SIT2"]["active_period"] == [] and got["SIT2"]["cause"] == "UNKNOWN_CAUSE"


BUNDLE = {
    "routes.txt": '﻿route_id, route_short_name,route_long_name,route_type\nR1, 1 ,"a, ""b""",x\nR1,2,later,3\n',
    "stop_times.txt": "trip_id,arrival_time,stop_id,stop_sequence\nT,25:00:00,A,1\nT,bad,B,2\n",
    "shapes.txt": "shape_id\nS\n", "sub/trips.txt": "trip_id\nT\n", "calendar.txt": "service_id,monday,start_date\n",
}


def test_gtfs_zip_and_folder(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        for name, text in BUNDLE.items():
            z.writestr(name, text)
    for name, text in BUNDLE.items():
        if "/" not in name:
            (tmp_path / "f").mkdir(exist_ok=True)
            (tmp_path / "f" / name).write_text(text)
    for f in (gtfs.read_zip(spark, f"{tmp_path}/f.zip"), gtfs.read_folder(spark, f"{tmp_path}/f")):
        assert set(f.tables) == {"routes", "stop_times", "calendar"}
        rows = f.routes.orderBy("_ord").collect()
        assert [(r["route_short_name"], r["route_long_name"], r["route_type"], r["network_id"]) for r in rows] == [("1", 'a, "b"', 0, ""), ("2", "later", 3, "")]
        assert f.route("R1").first()["route_short_name"] == "2"
        assert [(r["arrival_time"], r["departure_time"]) for r in f.stop_times.orderBy("_ord").collect()] == [(90000, -1), (-1, -1)]
        assert f.calendar.count() == 0
    assert gtfs.wanted_tables(["shapes"], ["shapes", "trips"]) == ["agency", "stops", "routes", "stop_times", "calendar", "calendar_dates"]
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("routes.txt", "route_id,route_type\nR1\n")
    with pytest.raises(Exception, match="fields"):
        gtfs.read_zip(spark, f"{tmp_path}/bad.zip").routes.count()


XML = """<?xml version="1.0"?><PublicationDelivery xmlns="http://n"><Other><ServiceFrame/></Other><dataObjects><CompositeFrame id="c"><frames>
<SiteFrame><stopPlaces><StopPlace id="P" version="1"><Name lang="de">Platz</Name><Centroid><Location><Longitude>11</Longitude><Latitude>46</Latitude></Location></Centroid>
<keyList><KeyValue><Key>k</Key><Value>v</Value></KeyValue></keyList><quays><Quay id="Q"><Name>Steig</Name></Quay></quays></StopPlace></stopPlaces></SiteFrame>
<ServiceFrame><lines><FlexibleLine id="L:"><Name>x</Name><PublicCode>7</PublicCode><OperatorRef ref="O"/><TransportSubmode><BusSubmode>local</BusSubmode></TransportSubmode></FlexibleLine><Odd id="o"/></lines>
<connections><DefaultConnection id="D"><From><QuayRef ref="Q"/></From><WalkTransferDuration><DefaultDuration>PT1M</DefaultDuration></WalkTransferDuration></DefaultConnection></connections></ServiceFrame>
<UnknownFrame><lines><Line id="no"/></lines></UnknownFrame>
<ServiceCalendarFrame><ServiceCalendar><dayTypes><DayType id="DT"><Name>daily</Name><ShortName>d</ShortName></DayType></dayTypes></ServiceCalendar></ServiceCalendarFrame>
<TimetableFrame><vehicleJourneys><ServiceJourney id="SJ"><dayTypes><DayTypeRef ref="a"/><DayTypeRef ref="b"/></dayTypes><ServiceJourneyPatternRef ref="JP"/>
<passingTimes><TimetabledPassingTime id="t" order="9"><StopPointInJourneyPatternRef ref="sp"/><DepartureTime>10:00:00</DepartureTime></TimetabledPassingTime></passingTimes></ServiceJourney></vehicleJourneys></TimetableFrame>
</frames></CompositeFrame><CompositeFrame><frames><ServiceFrame><lines><Line id="second"/></lines></ServiceFrame></frames></CompositeFrame></dataObjects></PublicationDelivery>"""


def test_netex(spark, tmp_path):
    (tmp_path / "n.xml").write_text(XML)
    rows = netex.read_xml(spark, f"{tmp_path}/n.xml").cache()
    assert [r["type"] for r in rows.orderBy("seq").collect()] == ["Quay", "StopPlace", "Line", "SiteConnection", "DayType", "TimetabledPassingTime", "ServiceJourney"]
    one = lambda kind, profile="epip", r=rows: netex.table(r, kind, profile).drop("_ord").first().asDict()
    assert one("Quay")["stop_place_id"] == "P" and one("StopPlace")["longitude"] == "11" and one("StopPlace")["name_lang"] == "de"
    assert one("Line")["transport_submode"] == "local" and one("Line")["operator_ref"] == "O" and one("Line")["id"] == "L:"
    assert one("SiteConnection")["from_quay_ref"] == "Q" and one("SiteConnection")["default_duration"] == "PT1M"
    assert one("ServiceJourney")["day_type_ref"] == "b" and one("ServiceJourney")["journey_pattern_ref"] == "JP"
    assert one("TimetabledPassingTime")["order"] == "" and one("TimetabledPassingTime")["service_journey_id"] == "SJ"
    assert "short_name" not in one("DayType")
    assert rows.where("fields['key:k'] = 'v'").count() == 1
    assert one("DayType", "it-l2", netex.read_xml(spark, f"{tmp_path}/n.xml", "it-l2", ["DayType"]))["short_name"] == "d"
    with pytest.raises(ValueError, match="no profile"):
        netex.profile("nothing")
    counts = sinks.write_tables(rows, f"{tmp_path}/out", types=["Line", "Notice"])
    assert counts == {"lines": 1, "notices": 0}
    back = netex.read_csv_folder(spark, [f"{tmp_path}/out/lines.csv", f"{tmp_path}/out/notices.csv"], exclude=["Notice"])
    assert back.first()["fields"]["public_code"] == "7" and netex.type_of_file("x/connections.csv") == "Connection" and netex.type_of_file("other.csv") == "other"


def test_formats_and_configs():
    assert siri.detect_format("a.xml") == "xml" and siri.detect_format("a", b"\xef\xbb\xbf <x") == "xml" and siri.detect_format("a", b" {") == "json"
    with pytest.raises(NotImplementedError):
        siri.need_json("xml")
    assert remote.latest_dated(["a_20260101.x", "a_20260301.x", "a_20269901.x", "b_20270101.x"], "a_{}.x") == "a_20260301.x" and remote.latest_dated([], "plain") == "plain"
    with pytest.raises(FileNotFoundError):
        remote.latest_dated([], "a_{}")
    entry = "feeds:\n- {endpoint: u, provider: p, cron: '0/30 * * * * *', format: json, protocol: siri}\n"
    assert remote.seconds_between(remote.load_config(entry)[0]["cron"]) == 30
    for bad in ("feeds: []", "feeds:\n- {endpoint: u}"):
        with pytest.raises(ValueError):
            remote.load_config(bad)
    assert remote.decompress(remote.compress("ä" * 99)) == "ä" * 99


class Server(http.server.BaseHTTPRequestHandler):
    stored: dict = {}

    def do_PUT(self):
        self.stored[self.path] = self.rfile.read(int(self.headers["Content-Length"]))
        self.send_response(500 if self.path.endswith(".json") else 201)
        self.end_headers()

    def do_GET(self):
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps({"key": self.headers["X-Key"]}).encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def server():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_stream_to_http(spark, tmp_path, server):
    messages = [("vm", "2026-03-02T10:00:00", "json", "siri", {"compressed": remote.COMPRESSED}, remote.compress(json.dumps(VM))), ("vm", "2026-03-02T09:00:00", "json", "siri", {}, "{}"), ("other", "z", "json", "siri", {}, "{}")]
    rows = spark.createDataFrame(messages, "provider string, timestamp string, format string, protocol string, metadata map<string,string>, payload string")
    rows.select("provider", "timestamp", F.struct("format", "protocol", "metadata", "payload").alias("rawdata")).write.json(f"{tmp_path}/in")
    snapshots = streaming.Snapshots(spark, f"{tmp_path}/static")
    assert streaming.refresh(snapshots, lambda: small_feed(spark), "v1")
    assert not streaming.refresh(snapshots, lambda: 1 / 0, "v2")

    def handle(batch, feed):
        made = transforms.vehicle_positions(siri.flat_activities(batch), feed)
        sinks.put_feed(gtfsrt.vehicle_entities(made), 42, f"{server}/vm")

    query = lambda: streaming.run(streaming.messages(spark, f"{tmp_path}/in"), handle, snapshots, f"{tmp_path}/check", provider="vm")
    assert streaming.supervise(query, pause=0) == 0
    assert gtfsrt.decode(Server.stored["/vm.pb"])["entity"][0]["id"] == "1001" and "/vm.json" in Server.stored
    with pytest.raises(OSError):
        sinks.put(f"{server}/x.json", b"{}")
    saved = streaming.unwrapped(spark.read.schema("provider string, timestamp string, rawdata struct<format:string,protocol:string,metadata:map<string,string>,payload:string>").json(f"{tmp_path}/in"))
    sinks.save_raw(saved.withColumnRenamed("payload", "text"), server, {"vm": "raw/vm"})
    assert json.loads(Server.stored["/raw/vm"]) == VM


def test_supervisor_restarts():
    class Failing:
        def awaitTermination(self):
            raise RuntimeError("down")

    assert streaming.supervise(Failing, pause=0, most=3) == 3


def test_two_phases_through_the_timetable(spark):
    f = small_feed(spark)
    make = spark.createDataFrame
    journeys = make([("it:apb:ServiceJourney:k:v:", "JP", 0)], "id string, journey_pattern_ref string, _ord int")
    chain = make([("it:apb:ServiceJourney:k:v:", "L", "1", "R")], "journey_id string, line_id string, public_code string, direction string")
    clocks = make([("it:apb:ServiceJourney:k:v:", 36050)], "journey_id string, clock int")
    refs = make([("a", "x:it:apb:ServiceJourney:k:9_", 20260302), ("b", "none", 20260302)], "journey string, ref string, date int")
    found = link.nearest_by_journey(refs, journeys, chain, clocks, f, link.running(f, [20260302]))
    second = make([("a", "T1"), ("b", "T1")], "journey string, trip_id string")
    both = link.in_turn(refs, found, second, "journey")
    assert {r["journey"]: (r["trip_id"], r["phase"]) for r in both.collect()} == {"a": ("T2", "A"), "b": ("T1", "B")}
    assert tuple(link.statistics(both).first())[:4] == (2, 1, 1, 0)


def test_schedules():
    from datetime import datetime

    at = lambda *x: datetime(*x)
    for cron, after, then in (
        ("*/30 * * * * *", at(2026, 3, 1, 10, 0, 1), at(2026, 3, 1, 10, 0, 30)), ("0 15,45 8-9 * * MON-FRI", at(2026, 3, 1, 8, 0), at(2026, 3, 2, 8, 15)),
        ("0 0 0 29 feb ?", at(2026, 1, 1), at(2028, 2, 29)), ("0 0 12 13 * 5", at(2026, 3, 1), at(2026, 3, 6, 12)), ("10/20 5 1 * * 7", at(2026, 3, 2), at(2026, 3, 8, 1, 5, 10)),
    ):
        assert remote.next_run(cron, after) == then
    assert [remote.seconds_between(c) for c in ("*/30 * * * * *", "0 */5 * * * *", "0 0 * * * *", "0 0,30 * * * ?", "* * * * * *")] == [30, 300, 3600, 1800, 1]
    for bad in ("* * * * *", "61 * * * * *", "*/0 * * * * *", "x * * * * *", "5-1 * * * * *", "* * * * * * *", "*/7 * * * * *", "0 0 8,9 * * *"):
        with pytest.raises(ValueError):
            remote.seconds_between(bad)
    with pytest.raises(ValueError):
        remote.next_run("0 0 0 31 2 *", at(2026, 1, 1))


def ftp_server(files):
    """A server of some files for one test: login, NLST, RETR, passive mode."""
    import socket
    import threading

    listener = socket.create_server(("127.0.0.1", 0))

    def serve():
        while True:
            try:
                control, _ = listener.accept()
            except OSError:
                return
            lines, data = control.makefile("rb"), None
            say = lambda t: control.sendall(f"{t}\r\n".encode())
            say("220 ready")
            for line in lines:
                verb, _, rest = line.decode().strip().partition(" ")
                if verb in ("EPSV", "PASV"):
                    data = socket.create_server(("127.0.0.1", 0))
                    port = data.getsockname()[1]
                    say(f"229 ok (|||{port}|)" if verb == "EPSV" else f"227 ok (127,0,0,1,{port >> 8},{port & 255})")
                elif verb in ("NLST", "RETR"):
                    body = "\r\n".join(sorted(files)).encode() + b"\r\n" if verb == "NLST" else files[rest.rpartition("/")[2]]
                    say("150 comes")
                    peer, _ = data.accept()
                    peer.sendall(body)
                    peer.close()
                    data.close()
                    say("226 done")
                else:
                    say({"USER": "331 and?", "PASS": "230 in" if rest == "p w" or rest == "guest" else "530 no", "QUIT": "221 bye"}.get(verb, "200 ok"))
                    if verb == "QUIT":
                        break
            control.close()

    threading.Thread(target=serve, daemon=True).start()
    return listener


def test_static_load_from_ftp(spark, tmp_path):
    import io
    import zipfile

    from tramline.streaming import Snapshots, keep_fresh, load_static

    def packed(**members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, text in members.items():
                z.writestr(name.replace("__", "."), text)
        return out.getvalue()

    xml = "<PublicationDelivery><dataObjects><CompositeFrame><frames><ServiceFrame><lines><Line id='L:{0}'><PublicCode>{0}</PublicCode></Line></lines><routes><Route id='R:1'><pointsInSequence><PointOnRoute id='P'/></pointsInSequence></Route></routes></ServiceFrame></frames></CompositeFrame></dataObjects></PublicationDelivery>"
    files = {
        "gtfs.zip": packed(stops__txt="stop_id,stop_name\na,A\na,B\n", shapes__txt="shape_id\ns\n"),
        "net_20260101.xml.zip": packed(n__xml=xml.format("old")), "net_20260201.xml.zip": packed(readme__txt="-", n__xml=xml.format("new"), z__xml="<no/>"), "net_20269999.xml.zip": b"",
    }
    server = ftp_server(files)
    host = f"127.0.0.1:{server.getsockname()[1]}"
    feed, entities = load_static(spark, f"ftp://user:p%20w@{host}/pub/gtfs.zip", f"ftp://{host}/pub/net_{{}}.xml.zip")
    assert sorted(feed.tables) == ["stops"] and feed.stops.count() == 2
    assert sorted((r["type"], r["fields"].get("public_code")) for r in entities.collect()) == [("Line", "new"), ("Route", None)]
    snapshots = Snapshots(spark, f"{tmp_path}/static")
    loads = iter([lambda: feed, lambda: 1 / 0, lambda: feed])
    assert keep_fresh(snapshots, lambda: next(loads)(), every=0, most=3) == 2
    found = snapshots.feed()
    assert found.stop("a").select("stop_name").collect() == [("B",)] and "stops" in found.unique
    server.close()


def test_golden_bytes():
    # written out by hand from the public wire format: key, length or number, content
    feed = {
        "header": {"gtfs_realtime_version": "2.0", "incrementality": "FULL_DATASET", "timestamp": 300},
        "entity": [
            {"id": "a", "trip_update": {"trip": {"trip_id": "t", "schedule_relationship": "CANCELED"}, "stop_time_update": [{"stop_sequence": 5, "arrival": {"delay": -60}, "stop_id": "s"}], "timestamp": 1}},
            {"id": "b", "alert": {"active_period": [{"start": 1, "end": 2}], "informed_entity": [{"route_id": "r"}, {"stop_id": "s"}], "cause": "STRIKE", "effect": "DETOUR", "header_text": {"translation": [{"text": "é", "language": "de"}]}, "severity_level": "SEVERE"}},
        ],
    }
    golden = bytes.fromhex(
        "0a0a" "0a03322e30" "1000" "18ac02"
        "1222" "0a0161" "1a1d" "0a05" "0a0174" "2003" "1212" "0805" "120b" "08c4ffffffffffffffff01" "220173" "2001"
        "1227" "0a0162" "2a22" "0a04" "08011002" "2a03" "120172" "2a03" "2a0173" "3004" "3804" "520a" "0a08" "0a02c3a9" "12026465" "7004"
    )
    assert gtfsrt.encode(feed).hex() == golden.hex()
    back = gtfsrt.decode(golden)
    assert back["entity"][0]["trip_update"]["stop_time_update"] == [{"stop_sequence": 5, "arrival": {"delay": -60}, "stop_id": "s"}]
    assert back["entity"][1]["alert"]["header_text"]["translation"] == [{"text": "é", "language": "de"}] and back["header"]["timestamp"] == 300
