"""GTFS-Realtime messages: JSON and protobuf, to and from rows.

Messages are nested dicts with the names of the public specification. Each
entity is one row, encoded or decoded on its own; a feed file is the header
followed by its entities.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator
from itertools import islice
from pathlib import PurePath

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import ArrayType, DataType, StructType

from ..session import shared_dir
from . import files, split_feeds
from .split_xml import dealt

#: Field numbers, names and kinds of the public specification.
#: Kinds: s string, u unsigned, i signed, b bool, f float, d double, else an enum
#: or a message; + marks a repeated field.
MESSAGES = {
    "FeedMessage": {1: ("header", "FeedHeader"), 2: ("entity", "FeedEntity+")},
    "FeedHeader": {1: ("gtfs_realtime_version", "s"), 2: ("incrementality", "Incrementality"), 3: ("timestamp", "u")},
    "FeedEntity": {1: ("id", "s"), 2: ("is_deleted", "b"), 3: ("trip_update", "TripUpdate"), 4: ("vehicle", "VehiclePosition"), 5: ("alert", "Alert")},
    "TripUpdate": {1: ("trip", "TripDescriptor"), 2: ("stop_time_update", "StopTimeUpdate+"), 3: ("vehicle", "VehicleDescriptor"), 4: ("timestamp", "u"), 5: ("delay", "i")},
    "StopTimeUpdate": {1: ("stop_sequence", "u"), 2: ("arrival", "StopTimeEvent"), 3: ("departure", "StopTimeEvent"), 4: ("stop_id", "s"), 5: ("schedule_relationship", "StopSchedule")},
    "StopTimeEvent": {1: ("delay", "i"), 2: ("time", "i"), 3: ("uncertainty", "i")},
    "VehiclePosition": {
        1: ("trip", "TripDescriptor"), 2: ("position", "Position"), 3: ("current_stop_sequence", "u"), 4: ("current_status", "StopStatus"), 5: ("timestamp", "u"),
        6: ("congestion_level", "Congestion"), 7: ("stop_id", "s"), 8: ("vehicle", "VehicleDescriptor"), 9: ("occupancy_status", "Occupancy"), 10: ("occupancy_percentage", "u"),
    },
    "Position": {1: ("latitude", "f"), 2: ("longitude", "f"), 3: ("bearing", "f"), 4: ("odometer", "d"), 5: ("speed", "f")},
    "TripDescriptor": {1: ("trip_id", "s"), 2: ("start_time", "s"), 3: ("start_date", "s"), 4: ("schedule_relationship", "TripSchedule"), 5: ("route_id", "s"), 6: ("direction_id", "u")},
    "VehicleDescriptor": {1: ("id", "s"), 2: ("label", "s"), 3: ("license_plate", "s")},
    "Alert": {
        1: ("active_period", "TimeRange+"), 5: ("informed_entity", "EntitySelector+"), 6: ("cause", "Cause"), 7: ("effect", "Effect"), 8: ("url", "TranslatedString"),
        10: ("header_text", "TranslatedString"), 11: ("description_text", "TranslatedString"), 14: ("severity_level", "Severity"),
    },
    "TimeRange": {1: ("start", "u"), 2: ("end", "u")},
    "EntitySelector": {1: ("agency_id", "s"), 2: ("route_id", "s"), 3: ("route_type", "i"), 4: ("trip", "TripDescriptor"), 5: ("stop_id", "s"), 6: ("direction_id", "u")},
    "TranslatedString": {1: ("translation", "Translation+")},
    "Translation": {1: ("text", "s"), 2: ("language", "s")},
}
#: Enums, the first number, and the name that an unknown one gets.
ENUMS = {
    "Incrementality": (dict(enumerate("FULL_DATASET DIFFERENTIAL".split())), "FULL_DATASET"),
    "StopSchedule": (dict(enumerate("SCHEDULED SKIPPED NO_DATA UNSCHEDULED".split())), "SCHEDULED"),
    "StopStatus": (dict(enumerate("INCOMING_AT STOPPED_AT IN_TRANSIT_TO".split())), "IN_TRANSIT_TO"),
    "Congestion": (dict(enumerate("UNKNOWN_CONGESTION_LEVEL RUNNING_SMOOTHLY STOP_AND_GO CONGESTION SEVERE_CONGESTION".split())), "UNKNOWN_CONGESTION_LEVEL"),
    "Occupancy": (dict(enumerate("EMPTY MANY_SEATS_AVAILABLE FEW_SEATS_AVAILABLE STANDING_ROOM_ONLY CRUSHED_STANDING_ROOM_ONLY FULL NOT_ACCEPTING_PASSENGERS NO_DATA_AVAILABLE NOT_BOARDABLE".split())), "NO_DATA_AVAILABLE"),
    "TripSchedule": ({0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED"}, "SCHEDULED"),
    "Cause": (dict(enumerate("UNKNOWN_CAUSE OTHER_CAUSE TECHNICAL_PROBLEM STRIKE DEMONSTRATION ACCIDENT HOLIDAY WEATHER MAINTENANCE CONSTRUCTION POLICE_ACTIVITY MEDICAL_EMERGENCY".split(), 1)), "UNKNOWN_CAUSE"),
    "Effect": (dict(enumerate("NO_SERVICE REDUCED_SERVICE SIGNIFICANT_DELAYS DETOUR ADDITIONAL_SERVICE MODIFIED_SERVICE OTHER_EFFECT UNKNOWN_EFFECT STOP_MOVED NO_EFFECT ACCESSIBILITY_ISSUE".split(), 1)), "UNKNOWN_EFFECT"),
    "Severity": (dict(enumerate("UNKNOWN_SEVERITY INFO WARNING SEVERE".split(), 1)), "UNKNOWN_SEVERITY"),
}
#: Bytes of a part of a feed, about.
BLOCK = 1 << 20
#: Fields whose zero is left out; other numbers keep it, as it may be meant.
DROP_ZERO = {"timestamp", "stop_sequence", "start", "end"}


def detect_format(path: str) -> str:
    return "protobuf" if PurePath(path.removesuffix(".zst")).suffix.lower() in (".pb", ".proto", ".bin") else "json"


def varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def encode(message: dict, kind: str = "FeedMessage") -> bytes:
    """A message as protobuf; nulls, empty strings and unset zeros are left out."""
    out = []
    for number, (name, field) in sorted(MESSAGES[kind].items()):
        value = message.get(name)
        for v in value or [] if field.endswith("+") else [value]:
            base = field.rstrip("+")
            if v is None or v == "" or v == 0 and name in DROP_ZERO and kind != "FeedHeader":
                continue
            if base in MESSAGES or base == "s":
                data = encode(v, base) if base in MESSAGES else v.encode()
                out.append(varint(number << 3 | 2) + varint(len(data)) + data)
            elif base in "fd":
                out.append(varint(number << 3 | (5 if base == "f" else 1)) + struct.pack("<f" if base == "f" else "<d", v))
            else:
                if base in ENUMS:
                    names, unknown = ENUMS[base]
                    v = {x: k for k, x in names.items()}.get(v, next(k for k, x in names.items() if x == unknown))
                out.append(varint(number << 3) + varint(int(v)))
    return b"".join(out)


def decode(data: bytes, kind: str = "FeedMessage") -> dict:
    """The inverse of ``encode``; unknown fields are passed over."""
    out: dict = {}
    at = 0

    def number() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at, n, shift = at + 1, n | (b & 127) << shift, shift + 7
            if b < 128:
                return n

    while at < len(data):
        key = number()
        wire, (name, field) = key & 7, MESSAGES[kind].get(key >> 3, (None, ""))
        base = field.rstrip("+")
        if wire == 2:
            size = number()
            part, at = data[at : at + size], at + size
            value: object = decode(part, base) if base in MESSAGES else part.decode() if name else None
        elif wire == 0:
            n = number()
            value = n - (1 << 64) if base == "i" and n >> 63 else bool(n) if base == "b" else ENUMS[base][0].get(n, ENUMS[base][1]) if base in ENUMS else n
        else:
            size = 4 if wire == 5 else 8
            value = struct.unpack("<f" if wire == 5 else "<d", data[at : at + size])[0]
            at += size
        if name and field.endswith("+"):
            out.setdefault(name, []).append(value)
        elif name:
            out[name] = value
    return out


def trimmed(value: object, name: str = "") -> object:
    """Without nulls, empty strings and lists, and zeros that mean unset."""
    if isinstance(value, dict):
        return {k: x for k, v in value.items() if (x := trimmed(v, k)) is not None}
    if isinstance(value, list):
        return [trimmed(v) for v in value] or None
    return None if value is None or value == "" or value == 0 and name in DROP_ZERO or value is False else value


def to_json(message: dict) -> str:
    header = message.get("header") or {}
    body = {"header": {k: v for k, v in header.items() if v not in (None, "")}, "entity": [trimmed(e) for e in message.get("entity") or []]}
    return json.dumps(body, indent=2, ensure_ascii=False)


def header(timestamp: int) -> dict:
    """The header of a full feed; the clock is the caller's."""
    return {"gtfs_realtime_version": "2.0", "incrementality": "FULL_DATASET", "timestamp": timestamp}


# --- rows ---------------------------------------------------------------------


def vehicle_entities(positions: DataFrame) -> DataFrame:
    """(id, vehicle) structs from rows of ``vehicle_positions``."""
    trip = F.struct("trip_id", "route_id", F.col("direction_id"), "start_date", "schedule_relationship")
    vehicle = F.struct(F.col("vehicle_id").alias("id"), F.col("vehicle_label").alias("label"))
    body = F.struct(trip.alias("trip"), F.struct("latitude", "longitude").alias("position"), "current_status", "timestamp", "congestion_level", "stop_id", vehicle.alias("vehicle"))
    return positions.select(F.col("entity_id").alias("id"), body.alias("vehicle"))


def trip_entities(updates: DataFrame) -> DataFrame:
    """(id, trip_update) structs from rows of ``trip_updates``."""
    event = lambda d: F.when(d.isNotNull(), F.struct(d.alias("delay")))
    stops = F.transform("stop_time_updates", lambda u: F.struct(u["stop_sequence"].alias("stop_sequence"), u["stop_id"].alias("stop_id"), event(u["arrival_delay"]).alias("arrival"), event(u["departure_delay"]).alias("departure")))
    trip = F.struct("trip_id", "route_id", "direction_id", "start_date", F.lit("SCHEDULED").alias("schedule_relationship"))
    return updates.select(F.col("entity_id").alias("id"), F.struct(trip.alias("trip"), stops.alias("stop_time_update"), "timestamp").alias("trip_update"))


def alert_entities(alerts: DataFrame) -> DataFrame:
    """(id, alert) structs from rows of ``alerts``."""
    text = F.when(F.size("header_text") > 0, F.struct(F.col("header_text").alias("translation")))
    body = F.struct("active_period", "informed_entity", "cause", "effect", "severity_level", text.alias("header_text"))
    return alerts.select(F.col("entity_id").alias("id"), body.alias("alert"))


def encoded(entities: DataFrame) -> DataFrame:
    """(id, protobuf, json): every entity in both forms, made where it is, a batch of
    them at once."""
    return written(entities, "protobuf", "json")


def written(entities: DataFrame, *forms: str) -> DataFrame:
    """``id`` and some of the forms ``protobuf`` and ``json`` of every entity; the
    JSON is as it would be read from the bytes, enums by name, floats of 32 bits."""
    from . import gtfsrt_columns as columns  # it needs this module

    make = {"protobuf": lambda rows: columns.encode(rows).cast(pa.binary()), "json": lambda rows: columns.to_json(rows).cast(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_struct_array()
            yield pa.RecordBatch.from_arrays([pc.struct_field(rows, "id").cast(pa.string()), *[make[f](rows) for f in forms]], ["id", *forms])

    return entities.mapInArrow(run, ", ".join(["id string", *[f"{f} {'binary' if f == 'protobuf' else 'string'}" for f in forms]]))


def arrow_type(kind: str, only: DataType | None = None) -> pa.DataType:
    """The column type of a message or another kind of field, with ``only`` some of its
    fields; enums are names."""
    base = kind.rstrip("+")
    plain = {"s": pa.string(), "u": pa.int64(), "i": pa.int64(), "b": pa.bool_(), "f": pa.float32(), "d": pa.float64()}
    one = pa.struct([(name, arrow_type(k, part(only, name))) for _, (name, k) in sorted(MESSAGES[base].items()) if wanted(only, name)]) if base in MESSAGES else plain.get(base, pa.string())
    return pa.list_(one) if kind.endswith("+") else one


def wanted(only: DataType | None, name: str) -> bool:
    return only is None or name in struct_of(only).names


def part(only: DataType | None, name: str) -> DataType | None:
    """What is wanted of a field, None for all of it."""
    found = None if only is None else struct_of(only)[name].dataType
    return found if isinstance(found, StructType | ArrayType) and isinstance(struct_of(found), StructType) else None


def struct_of(kind: DataType) -> DataType:
    return kind.elementType if isinstance(kind, ArrayType) else kind


def shaped(value: object, kind: str) -> object:
    """A value of a JSON feed as its kind of field has it; what does not fit is an
    error, unknown fields are passed over."""
    if value is None:
        return None
    if kind.endswith("+"):
        return [shaped(v, kind[:-1]) for v in value]
    if kind in MESSAGES:
        return {name: shaped(value[name], k) for name, k in MESSAGES[kind].values() if value.get(name) is not None}
    if kind in ENUMS and isinstance(value, int):
        return ENUMS[kind][0].get(value, ENUMS[kind][1])
    return {"u": int, "i": int, "f": float, "d": float, "b": bool}.get(kind, str)(value)


def cut_protobuf(parts: Iterable[bytes]) -> Iterator[bytes]:
    """The bytes of each entity of a feed, not decoded, as the feed is read."""
    return (data for _, data in split_feeds.protobuf_entities(parts))


def cut_json(parts: Iterable[bytes]) -> Iterator[str]:
    """The text of each entity of a feed, as the feed is read."""
    return (data.decode() for _, data in split_feeds.json_entities(parts))


def decoded(data: list[bytes], protobuf: bool, only: StructType | None = None) -> pa.StructArray:
    """Entities as rows: a column at a time; one by one where something is unusual,
    as numbers written as texts are."""
    from . import gtfsrt_columns as columns

    try:
        return columns.decode_all(data, only) if protobuf else columns.from_json(data, only)
    except (ValueError, TypeError, IndexError, pa.ArrowException):
        rows = [decode(d, "FeedEntity") if protobuf else shaped(json.loads(d), "FeedEntity") for d in data]
        if None in rows:
            raise ValueError("an entity that is null") from None
        return pa.array(rows, arrow_type("FeedEntity", only))


def read(spark: SparkSession, path: str, size: int = split_feeds.RANGE, fields: str | None = None) -> DataFrame:
    """(file, place, id, entity) of feed files in either format; ``entity`` is a
    struct of the public specification's fields, null where absent, or of those that are
    asked for (``fields``, as "alert struct<cause: string>"); others are passed over.

    A feed is one message, packed if its name ends in ``.zst``. One of more than ``size`` bytes is cut by many tasks if it
    can be told where its entities begin (``split_feeds``), and each decodes what it
    cuts. Any other is cut by one task as it reads; the entities are then dealt out.
    """
    from . import gtfsrt_columns as columns

    only = None if fields is None else StructType.fromDDL(f"id string, {fields}")
    listing = files.unpacked(files.listed(spark, path))
    ranges = split_feeds.ranges(listing, "lower(path) rlike '[^/][.](pb|proto|bin)([.]zst)?$'", size)
    count = listing.agg(F.sum(F.when(F.col("length") > size, F.ceil(F.col("length") / size)))).head()[0] or 0
    each, whole = None, listing.select("path")
    if count:
        seen = dealt(ranges, count).mapInArrow(split_feeds.scanned, "path string, length long, protobuf boolean, start long, end long, begin long, behind long, count long")
        known, folder = "path string, protobuf boolean, begin long, length long, count long, place long", shared_dir(spark)
        seen.groupBy("path").applyInArrow(split_feeds.chained, known).write.parquet(folder)
        each = spark.read.schema(known).parquet(folder)
        each = each.withColumn("behind", F.coalesce(F.lead("begin").over(Window.partitionBy("path").orderBy("begin")), "length"))  # a row for each range
        whole = whole.join(each.where("count >= 0").select("path").distinct(), "path", "left_anti")

    def batches_of(name: str, protobuf: bool, slices: Iterator[bytes], place: int) -> Iterator[pa.RecordBatch]:
        while part := list(islice(slices, 5_000)):
            n = len(part)
            yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(place, place + n), pa.int64()), pa.array(part, pa.binary()), pa.array([protobuf] * n)], ["file", "place", "data", "protobuf"])
            place += n

    def rows_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for protobuf in batch.column(3).unique().to_pylist():
            own = batch.filter(pc.equal(batch.column(3), protobuf))
            rows = decoded(own.column(2).to_pylist(), protobuf, only)
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pc.fill_null(pc.struct_field(rows, "id"), ""), rows], ["file", "place", "id", "entity"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                protobuf = detect_format(name) == "protobuf"
                with files.opened(name) as file:
                    slices = cut_protobuf(files.streamed(file)) if protobuf else (t.encode() for t in cut_json(files.streamed(file)))
                    yield from batches_of(name, protobuf, slices, 0)

    def at_once(file: pa.NativeFile, r: dict) -> pa.StructArray | None:
        """The entities of a range of a JSON feed, None if they have to be read one by one."""
        try:
            rows = columns.feed_rows(split_feeds.own_feed(file, r["begin"], r["behind"], r["length"]), only)
        except (ValueError, pa.ArrowException):
            return None
        return rows if len(rows) == r["count"] and not rows.null_count else None

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with files.opened(r["path"]) as file:
                    if not r["protobuf"] and (rows := at_once(file, r)) is not None:
                        for k in range(0, len(rows), 5_000):
                            own = rows[k : k + 5_000]
                            yield pa.RecordBatch.from_arrays([pa.array([r["path"]] * len(own)), pa.array(range(r["place"] + k, r["place"] + k + len(own)), pa.int64()), pc.fill_null(pc.struct_field(own, "id"), ""), own], ["file", "place", "id", "entity"])
                        continue
                    slices = (d for _, d in islice(split_feeds.entities(file, r["protobuf"], r["begin"], r["length"]), r["count"]))
                    for part in batches_of(r["path"], r["protobuf"], slices, r["place"]):
                        yield from rows_of(part)

    def dealt_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from rows_of(batch)

    schema = StructType().add("file", "string").add("place", "long").add("id", "string").add("entity", from_arrow_type(arrow_type("FeedEntity", only)))
    slices = whole.mapInArrow(cut, "file string, place long, data binary, protobuf boolean")
    out = slices.repartition("file", "place").mapInArrow(dealt_out, schema)
    return out if each is None else out.union(dealt(each.where("count > 0"), count).mapInArrow(ranged, schema))


def blocks(entities: DataFrame, targets: dict[str, str], between: dict[str, bytes]) -> DataFrame:
    """(target, part): entities as they stand in a feed, in the order of the rows,
    many to a part; ``targets`` and what is between entities are by form."""
    from . import gtfsrt_columns as columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_struct_array()
            for form, target in targets.items():
                data = columns.framed(columns.encode(rows)) if form == "pb" else columns.indented(rows)
                for part in columns.in_blocks(data, BLOCK):
                    yield pa.RecordBatch.from_arrays([pa.array([target]), pa.array([between[form].join(part)], pa.binary())], ["target", "part"])

    return entities.mapInArrow(run, "target string, part binary")


def frame(entity: bytes) -> bytes:
    """An encoded entity as a field of its feed."""
    return varint(2 << 3 | 2) + varint(len(entity)) + entity


def indented(entity: bytes) -> bytes:
    """An entity's JSON as it stands in its feed."""
    return b"    " + entity.replace(b"\n", b"\n    ")


def around(timestamp: int, empty: bool) -> dict[str, tuple[bytes, bytes, bytes]]:
    """What stands before, between and after the entities of a feed, by form."""
    before, after = to_json({"header": header(timestamp), "entity": []}).encode().rsplit(b"[]", 1)
    around = (b"[]", b"", b"") if empty else (b"[\n", b",\n", b"\n  ]")
    return {"pb": (encode({"header": header(timestamp)}), b"", b""), "json": (before + around[0], around[1], around[2] + after)}


def feed_bytes(entities: DataFrame, timestamp: int) -> tuple[bytes, str]:
    """A small feed as (protobuf, JSON) in the driver's memory; ``sinks`` writes
    feeds of any size."""
    rows = encoded(entities).collect()
    form = around(timestamp, not rows)
    text = form["json"][1].join(indented(r["json"].encode()) for r in rows)
    return form["pb"][0] + b"".join(frame(bytes(r["protobuf"])) for r in rows), (form["json"][0] + text + form["json"][2]).decode()
