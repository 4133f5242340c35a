"""Live feeds read strictly: a message is parsed once, into a VARIANT, then checked
and typed along its schema.

What a typed JSON decoder refuses is refused here: text that is no JSON, a number,
boolean, list or object where a string belongs, anything but an object where fields
belong, anything but a list or an object where items do. One such place refuses the
whole message. Keys match whatever their case (the exact one first, else the last by
name), unknown keys are ignored and ``null`` counts as absent. A key that an object
has twice refuses the message, as a VARIANT holds each key once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from ..schemas import CALL, ET_JOURNEY, SITUATION, VM_ACTIVITY

ET_TYPED = ET_JOURNEY.replace("EstimatedCall:string", f"EstimatedCall:array<struct<{CALL}>>")
#: What is checked in a situation: some fields are never refused, whatever they hold.
SITUATION_CHECKED = (
    SITUATION.replace("ValidityPeriod string", "ValidityPeriod variant").replace("ReasonName string", "ReasonName variant")
    .replace("AffectedStopPoint:string", "AffectedStopPoint:array<struct<StopPointRef:string,PlaceName:string>>")
    .replace("AffectedNetwork:string", "AffectedNetwork:variant").replace("Consequence:string", "Consequence:variant")
)
#: Of each kind: the delivery, the objects down to its items, their schema as
#: checked and as typed.
KINDS = {
    "VM": ("VehicleMonitoringDelivery", ("VehicleActivity",), VM_ACTIVITY, VM_ACTIVITY),
    "ET": ("EstimatedTimetableDelivery", ("EstimatedJourneyVersionFrame",), f"RecordedAtTime string, EstimatedVehicleJourney array<struct<{ET_TYPED}>>", f"RecordedAtTime string, EstimatedVehicleJourney array<struct<{ET_TYPED}>>"),
    "SE": ("SituationExchangeDelivery", ("Situations", "PtSituationElement"), SITUATION_CHECKED, SITUATION),
}


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def fields_of(v: Column) -> Column:
    """The fields of an object; null if it is none."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def items_of(v: Column) -> Column:
    """A list's items, or one object as a list of one; null if it is neither."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(fields_of(v).isNotNull(), F.array(v)))


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with one column more, computed once for each: an expression that a
    filter or several columns use would be written into each of them."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def among(fields: Column, odd: Column, name: str) -> Column:
    """One of an object's fields, its key in any case where a key is ``odd``; null if absent."""
    alike = lambda: F.filter(F.map_entries(fields), lambda e: F.lower(e["key"]) == name.lower())
    return F.coalesce(F.try_element_at(fields, F.lit(name)), F.when(odd, F.try_element_at(alike(), F.lit(-1))["value"]))


def odd_key(fields: Column, names: list[str]) -> Column:
    """Whether one of these names is there in another case."""
    return F.exists(F.map_keys(fields), lambda k: ~k.isin(names) & F.lower(k).isin([n.lower() for n in names]))


def with_fields(v: Column, names: list[str], body) -> Column:
    """``body(fields, get)``: the fields of an object, and what gives one of them by
    name; the object is taken apart once."""
    return let(fields_of(v), lambda m: let(odd_key(m, names), lambda odd: body(m, lambda name: among(m, odd, name))))


def field(v: Column, name: str) -> Column:
    """A field of an object, its key in any case (the exact one first); null if absent."""
    return with_fields(v, [name], lambda _, get: get(name))


def down(v: Column, path: tuple[str, ...]) -> Column:
    """What is below the fields of a path."""
    return let(v, lambda x: down(field(x, path[0]), path[1:])) if path else v


def absent(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def fault(v: Column, kind: DataType, path: str) -> Column:
    """The first place where ``v`` is not of ``kind``; null without one."""
    if isinstance(kind, StringType):
        return F.when(~F.schema_of_variant(v).isin("STRING", "VOID"), F.lit(path))
    if isinstance(kind, StructType):
        within = lambda f, c: let(c, lambda x: fault(x, f.dataType, f"{path}.{f.name}")) if isinstance(f.dataType, StructType | ArrayType) else fault(c, f.dataType, f"{path}.{f.name}")
        inner = lambda m, get: F.when(m.isNull(), F.when(~absent(v), F.lit(path))).otherwise(F.coalesce(*[within(f, get(f.name)) for f in kind.fields]))
        return with_fields(v, kind.names, inner)
    if isinstance(kind, ArrayType):
        each = lambda c: F.get(F.filter(F.transform(c, lambda x: fault(x, kind.elementType, path)), lambda x: x.isNotNull()), F.lit(0))
        return F.when(~absent(v), let(items_of(v), lambda c: F.when(c.isNull(), F.lit(path)).otherwise(each(c))))
    return F.lit(None).cast("string")


def typed(v: Column, kind: DataType) -> Column:
    """``v``, in which there is no fault, as ``kind``: absent strings and whole
    objects are null in each field, absent items an empty list; a string field that
    holds more is its JSON text."""
    if isinstance(kind, StructType):
        within = lambda f, c: typed(c, f.dataType) if isinstance(f.dataType, StringType) else let(c, lambda x: typed(x, f.dataType))
        return with_fields(v, kind.names, lambda _, get: F.struct(*[within(f, get(f.name)).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        items = F.coalesce(items_of(v), F.array().cast("array<variant>"))
        return F.transform(items, lambda x: typed(x, kind.elementType))
    return F.try_variant_get(v, "$", "string")


def judged(messages: DataFrame, kind: str, payload: str) -> tuple[DataFrame, Column]:
    """The messages with ``_root`` and ``refused``, each computed once, and their items."""
    name, path, checks, types = KINDS[kind]
    below = f"array<struct<{checks}>>"
    for part in reversed(path):
        below = f"struct<{part}:{below}>"
    below = below.replace("struct<", "struct<ResponseTimestamp:string,", 1)
    envelope = StructType.fromDDL(f"ResponseTimestamp string, ProducerRef string, {name} {below}")
    rows = once(messages, "_whole", F.try_parse_json(F.col(payload)))
    rows = once(rows, "_root", F.coalesce(down(F.col("_whole"), ("Siri", "ServiceDelivery")), field(F.col("_whole"), "ServiceDelivery")))
    no_object = F.col("_whole").isNull() | ~F.is_variant_null("_whole") & fields_of(F.col("_whole")).isNull()
    rows = once(rows, "refused", F.when(no_object, F.lit("$")).otherwise(fault(F.col("_root"), envelope, "ServiceDelivery"))).drop("_whole")
    given = F.when(F.col("refused").isNull(), down(F.col("_root"), (name, *path)))
    return rows, let(given, lambda c: typed(c, StructType.fromDDL(f"x array<struct<{types}>>")["x"].dataType))


def checked(messages: DataFrame, kind: str, payload: str = "payload") -> DataFrame:
    """The message's columns, ``refused`` (the place of the first fault, ``$`` for
    the message itself, null if it is accepted), ``timestamp`` and ``items`` (a list
    of structs, empty where refused).

    A message's own fields come below ``Siri.ServiceDelivery`` or
    ``ServiceDelivery``. Null and empty payloads are refused, ``null`` is a message
    without items.
    """
    rows, made = judged(messages, kind, payload)
    stamp = F.when(F.col("refused").isNull(), F.try_variant_get(field(F.col("_root"), "ResponseTimestamp"), "$", "string"))
    return rows.withColumn("timestamp", stamp).withColumn("items", made).drop("_root")


def accepted(messages: DataFrame, kind: str, payload: str) -> DataFrame:
    """The accepted messages and their ``items``."""
    rows, made = judged(messages, kind, payload)
    return once(rows.where("refused is null"), "items", made)


def vehicle_activities(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each activity of the accepted messages: as ``siri.vehicle_activities``."""
    rows = accepted(messages, "VM", payload)
    return rows.select(*messages.columns, F.posexplode("items").alias("position", "activity"))


def journeys(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each journey of the accepted messages: as ``siri.journeys``, but
    with its calls as a list of structs."""
    rows = accepted(messages, "ET", payload)
    frames = rows.select(*messages.columns, F.posexplode("items").alias("frame", "_f"))
    return frames.select("*", F.posexplode("_f.EstimatedVehicleJourney").alias("position", "journey")).drop("_f")


def calls(rows: DataFrame) -> DataFrame:
    """One row for each call of ``journeys``: ``call_position`` and ``call``."""
    return rows.select("*", F.posexplode("journey.EstimatedCalls.EstimatedCall").alias("call_position", "call"))


def situations(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each situation of the accepted messages, with the struct that
    ``siri.details`` takes."""
    rows = accepted(messages, "SE", payload)
    return rows.select(*messages.columns, F.posexplode("items").alias("position", "situation"))
