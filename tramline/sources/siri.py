"""Live feeds in SIRI Lite JSON: envelopes, array-or-object fields, rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..schemas import CALL, ET_JOURNEY, SITUATION, VM_ACTIVITY

ROOT = "$.Siri.ServiceDelivery"


def detect_format(path: str, head: bytes = b"") -> str:
    """json or xml: by extension, else by the first character; json if unclear."""
    for end in ("json", "xml"):
        if path.lower().endswith(f".{end}"):
            return end
    return "xml" if head.decode("utf-8-sig", "ignore").lstrip()[:1] == "<" else "json"


def format_of(path: Column, head: Column) -> Column:
    """The same as a column, for many files at once."""
    end = F.regexp_extract(F.lower(path), r"\.(json|xml)$", 1)
    first = F.regexp_extract(F.coalesce(head, F.lit("")), r"^\x{FEFF}?\s*(.)", 1)
    return F.when(end != "", end).when(first == "<", F.lit("xml")).otherwise(F.lit("json"))


def need_json(form: str) -> None:
    if form != "json":
        raise NotImplementedError(f"SIRI {form} is not supported")


def raw(payload: str, path: str) -> Column:
    """A field as JSON text, below either root that feeds use."""
    return F.coalesce(F.get_json_object(payload, f"{ROOT}.{path}"), F.get_json_object(payload, f"$.ServiceDelivery.{path}"))


def delivery_time(payload: str = "payload") -> Column:
    return raw(payload, "ResponseTimestamp")


#: What a delivery of each kind is called, and the path of its items.
DELIVERIES = {"VM": ("VehicleMonitoringDelivery", ("VehicleActivity",)), "ET": ("EstimatedTimetableDelivery", ("EstimatedJourneyVersionFrame",)), "SE": ("SituationExchangeDelivery", ("Situations", "PtSituationElement"))}


def to_json(items: Column, kind: str, timestamp: Column) -> Column:
    """A message as JSON again: an array of structs below its delivery. Nulls
    are left out, arrays stay arrays."""
    name, path = DELIVERIES[kind]
    inner = items
    for field in reversed(path):
        inner = F.struct(inner.alias(field))
    return F.to_json(F.struct(F.struct(F.struct(timestamp.alias("ResponseTimestamp"), inner.alias(name)).alias("ServiceDelivery")).alias("Siri")))


def vehicle_activities(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each vehicle activity, in order: the message's columns,
    ``position`` and ``activity``."""
    given = raw(payload, "VehicleMonitoringDelivery.VehicleActivity")
    return messages.select("*", F.posexplode(fn.array_or_object(given, VM_ACTIVITY)).alias("position", "activity"))


def flat_activities(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Activities with the columns that ``vehicle_positions`` takes."""
    return flattened(vehicle_activities(messages, payload))


def flattened(activities: DataFrame, *keep: str) -> DataFrame:
    """The same from ``vehicle_activities``, with some of the message's columns."""
    j, call = "activity.MonitoredVehicleJourney", "activity.MonitoredVehicleJourney.MonitoredCall"
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    return activities.select(
        *keep, F.col("position").alias("_ord"), empty(f"{j}.VehicleRef").alias("vehicle_ref"), empty("activity.RecordedAtTime").alias("recorded_at"),
        empty(f"{j}.LineRef").alias("line_ref"), empty(f"{j}.PublishedLineName").alias("line_name"), empty(f"{j}.DirectionRef").alias("direction_ref"),
        empty(f"{call}.StopPointRef").alias("stop_ref"), empty(f"{j}.Delay").alias("delay"), empty(f"{j}.FramedVehicleJourneyRef.DataFrameRef").alias("date"),
        empty(f"{j}.FramedVehicleJourneyRef.DatedVehicleJourneyRef").alias("journey_ref"), empty(f"{j}.VehicleLocation.Longitude").alias("longitude"),
        empty(f"{j}.VehicleLocation.Latitude").alias("latitude"), empty(f"{call}.VehicleAtStop").alias("at_stop"), empty(f"{j}.InCongestion").alias("in_congestion"),
    )


def journeys(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each estimated journey of all frames, in order:
    ``frame``, ``position`` and ``journey``; its calls stay raw JSON."""
    frames = fn.array_or_object(raw(payload, "EstimatedTimetableDelivery.EstimatedJourneyVersionFrame"), "RecordedAtTime string, EstimatedVehicleJourney string")
    each = messages.select("*", F.posexplode(frames).alias("frame", "_f"))
    return each.select("*", F.posexplode(fn.array_or_object(F.col("_f.EstimatedVehicleJourney"), ET_JOURNEY)).alias("position", "journey")).drop("_f")


def calls(rows: DataFrame) -> DataFrame:
    """One row for each call of ``journeys``: ``call_position`` and ``call``."""
    return rows.select("*", F.posexplode(fn.array_or_object(F.col("journey.EstimatedCalls.EstimatedCall"), CALL)).alias("call_position", "call"))


def situations(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each situation: ``position`` and ``situation``, with
    ``periods``, ``reasons``, ``networks``, ``stops`` and ``consequences`` parsed."""
    given = raw(payload, "SituationExchangeDelivery.Situations.PtSituationElement")
    return details(messages.select("*", F.posexplode(fn.array_or_object(given, SITUATION)).alias("position", "situation")))


def details(each: DataFrame) -> DataFrame:
    """Rows with a ``situation``, and what its fields hold that may be a list or one object."""
    lenient = lambda c, kind: F.coalesce(fn.array_or_object(F.col(c), kind), F.array().cast(f"array<struct<{kind}>>"))
    single = lambda c: F.startswith(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit("{"))
    period, reason = "situation.ValidityPeriod", "situation.ReasonName"
    periods = lenient(period, "StartTime string, EndTime string")
    reasons = lenient(reason, "`@xml:lang` string, `#text` string")
    return each.select(
        "*",
        F.filter(periods, lambda p: ~single(period) | (F.coalesce(p["StartTime"], F.lit("")) != "")).alias("periods"),
        F.transform(F.filter(reasons, lambda r: ~single(reason) | (F.coalesce(r["#text"], F.lit("")) != "")), lambda r: F.struct(r["@xml:lang"].alias("lang"), r["#text"].alias("text"))).alias("reasons"),
        lenient("situation.Affects.StopPoints.AffectedStopPoint", "StopPointRef string, PlaceName string").alias("stops"),
        F.transform(lenient("situation.Affects.Networks.AffectedNetwork", "AffectedLine string"), lambda n: fn.array_or_object(n["AffectedLine"], "LineRef string, PublishedLineName string")).alias("networks"),
        lenient("situation.Consequences.Consequence", "Condition string, Severity string").alias("consequences"),
    )
