"""Strict reading of live feeds: what a typed decoder refuses."""

from __future__ import annotations

import json

import pytest

from tramline.sources import siri, strict

AT = "ServiceDelivery.VehicleMonitoringDelivery"
ITEM = f"{AT}.VehicleActivity"
JOURNEY = f"{ITEM}.MonitoredVehicleJourney"


def vm(items, **more):
    return json.dumps({"Siri": {"ServiceDelivery": {"VehicleMonitoringDelivery": {"VehicleActivity": items}, **more}}})


GOOD = {"RecordedAtTime": "t", "MonitoredVehicleJourney": {"LineRef": "a"}}
CASES = [
    (vm([GOOD, GOOD]), None, ["a", "a"]),
    (vm(GOOD), None, ["a"]),
    (json.dumps({"servicedelivery": {"VEHICLEMONITORINGDELIVERY": {"vehicleActivity": [{"monitoredvehiclejourney": {"lineref": "b"}}]}}}), None, ["b"]),
    (vm([{"MonitoredVehicleJourney": {"lineref": "x", "LineRef": "exact"}}]), None, ["exact"]),
    (vm([{"MonitoredVehicleJourney": {"LineRef": None, "Unknown": [1]}, "Extra": 5}]), None, [None]),
    (vm([{"MonitoredVehicleJourney": None}, None]), None, [None, None]),
    (vm(None), None, []),
    (vm([]), None, []),
    ("null", None, []),
    ("{}", None, []),
    (vm([GOOD], ProducerRef="p", ResponseTimestamp="r"), None, ["a"]),
    (vm([GOOD], ProducerRef=5), "ServiceDelivery.ProducerRef", []),
    (vm([GOOD, {"RecordedAtTime": 5}]), f"{ITEM}.RecordedAtTime", []),
    (vm({"MonitoredVehicleJourney": {"Delay": True}}), f"{JOURNEY}.Delay", []),
    (vm({"MonitoredVehicleJourney": {"Delay": {"x": 1}}}), f"{JOURNEY}.Delay", []),
    (vm({"MonitoredVehicleJourney": "text"}), JOURNEY, []),
    (vm({"MonitoredVehicleJourney": [GOOD]}), JOURNEY, []),
    (vm("text"), ITEM, []),
    (vm([["a"]]), ITEM, []),
    (vm(7), ITEM, []),
    (json.dumps({"Siri": {"ServiceDelivery": {"VehicleMonitoringDelivery": []}}}), AT, []),
    (json.dumps({"ServiceDelivery": 3}), "ServiceDelivery", []),
    ("[]", "$", []),
    ('"text"', "$", []),
    ("{", "$", []),
    ("", "$", []),
    (None, "$", []),
    ('{"a":1,"a":2}', "$", []),
]


def test_activities(spark):
    rows = spark.createDataFrame([(k, c[0]) for k, c in enumerate(CASES)], "k int, payload string")
    found = {r["k"]: r for r in strict.checked(rows, "VM").collect()}
    for k, (payload, refused, lines) in enumerate(CASES):
        row = found[k]
        assert row["refused"] == refused, payload
        assert [i["MonitoredVehicleJourney"]["LineRef"] for i in row["items"]] == lines, payload
    each = strict.vehicle_activities(rows).collect()
    assert sorted((r["k"], r["position"]) for r in each) == [(k, p) for k, c in enumerate(CASES) for p in range(len(c[2]))]
    assert strict.vehicle_activities(rows).columns == siri.vehicle_activities(rows).columns


def test_nothing(spark):
    none = spark.createDataFrame([], "payload string")
    for kind in strict.KINDS:
        assert strict.checked(none, kind).collect() == []


def test_nested_items(spark):
    call = {"StopPointRef": "s", "VisitNumber": "1"}
    journey = lambda calls: {"LineRef": "l", "EstimatedCalls": {"EstimatedCall": calls}}
    feed = lambda frames: json.dumps({"ServiceDelivery": {"EstimatedTimetableDelivery": {"EstimatedJourneyVersionFrame": frames}}})
    payloads = [
        feed({"EstimatedVehicleJourney": [journey([call, call]), journey(call), {"LineRef": "none"}]}),
        feed([{"EstimatedVehicleJourney": journey(call)}, {}]),
        feed({"EstimatedVehicleJourney": journey([call, {"VisitNumber": 1}])}),
    ]
    rows = spark.createDataFrame(list(enumerate(payloads)), "k int, payload string")
    checked = {r["k"]: r["refused"] for r in strict.checked(rows, "ET").collect()}
    assert checked == {0: None, 1: None, 2: "ServiceDelivery.EstimatedTimetableDelivery.EstimatedJourneyVersionFrame.EstimatedVehicleJourney.EstimatedCalls.EstimatedCall.VisitNumber"}
    found = strict.calls(strict.journeys(rows)).select("k", "frame", "position", "call_position", "call.StopPointRef").collect()
    assert sorted(map(tuple, found)) == [(0, 0, 0, 0, "s"), (0, 0, 0, 1, "s"), (0, 0, 1, 0, "s"), (1, 0, 0, 0, "s")]
    loose = siri.calls(siri.journeys(rows.where("k < 2"))).select("k", "frame", "position", "call_position", "call.StopPointRef").collect()
    assert sorted(map(tuple, loose)) == sorted(map(tuple, found))


@pytest.mark.parametrize(("changed", "refused"), [({}, None), ({"ValidityPeriod": 5, "ReasonName": "x"}, None), ({"Version": 1}, "Version"), ({"Affects": {"StopPoints": {"AffectedStopPoint": [{"StopPointRef": 9}]}}}, "Affects.StopPoints.AffectedStopPoint.StopPointRef")])
def test_situations(spark, changed, refused):
    element = {"SituationNumber": "n", "ValidityPeriod": {"StartTime": "a"}, "Affects": {"Networks": {"AffectedNetwork": [{"AffectedLine": {"LineRef": "l"}}]}}, **changed}
    payload = json.dumps({"ServiceDelivery": {"SituationExchangeDelivery": {"Situations": {"PtSituationElement": element}}}})
    rows = spark.createDataFrame([(payload,)], "payload string")
    (row,) = strict.checked(rows, "SE").collect()
    assert row["refused"] == (refused and f"ServiceDelivery.SituationExchangeDelivery.Situations.PtSituationElement.{refused}")
    shown = ["position", "situation.SituationNumber", "periods", "reasons", "stops", "networks", "consequences"]
    strictly = siri.details(strict.situations(rows)).select(shown).collect()
    assert strictly == ([] if refused else siri.situations(rows).select(shown).collect())


def test_a_message_is_parsed_once(spark):
    """The filter of accepted messages does not judge them again."""
    rows = spark.createDataFrame([("{}",)], "payload string")
    for df in (strict.calls(strict.journeys(rows)), strict.vehicle_activities(rows), strict.situations(rows), strict.checked(rows, "VM").where("refused is not null").select("refused")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1
