"""Scalar functions as Column expressions; nothing here runs Python on rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNSET_TIME, UNSET_DATE = -1, 0


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


# --- lenient scanning ---------------------------------------------------


def text(c: Column) -> Column:
    """Trimmed; a missing cell is the empty string."""
    return _text(c)


def whole_number(c: Column) -> Column:
    """A signed integer, else 0 (also for ``1.5`` and what does not fit)."""
    return F.coalesce(F.when(_text(c).rlike(r"^[+-]?[0-9]+$"), _text(c).try_cast("int")), F.lit(0))


def real_number(c: Column) -> Column:
    return F.coalesce(_text(c).try_cast("double"), F.lit(0.0))


def real_number32(c: Column) -> Column:
    return F.coalesce(_text(c).try_cast("float"), F.lit(0.0).cast("float"))


def flag(c: Column) -> Column:
    """True for ``1`` alone."""
    return _text(c) == "1"


def gtfs_time(c: Column) -> Column:
    """Seconds of ``h:m:s``, no range check; -1 for anything else."""
    parts = F.split(_text(c), ":")
    number = lambda k: F.get(parts, F.lit(k)).try_cast("int")
    seconds = number(0) * 3600 + number(1) * 60 + number(2)
    return F.coalesce(F.when(_text(c).rlike(r"^[+-]?[0-9]+:[+-]?[0-9]+:[+-]?[0-9]+$"), seconds), F.lit(UNSET_TIME)).cast("int")


def format_time(c: Column) -> Column:
    """``hh:mm:ss``, hours may pass 24; empty if unset."""
    shown = F.format_string("%02d:%02d:%02d", F.floor(c / 3600), F.floor(c % 3600 / 60), c % 60)
    return F.when(c == UNSET_TIME, F.lit("")).otherwise(shown)


def gtfs_date(c: Column) -> Column:
    """``YYYYMMDD`` as an integer without looking at a calendar; else 0."""
    return F.coalesce(F.when(_text(c).rlike(r"^([0-9]{8}|[+-][0-9]{7})$"), _text(c).try_cast("int")), F.lit(UNSET_DATE))


def strict_date(c: Column) -> Column:
    """``gtfs_date`` that fails the query where the date is unset."""
    value = gtfs_date(c)
    return F.when(value == UNSET_DATE, F.raise_error(F.concat(F.lit("bad date: "), F.coalesce(c, F.lit("null")))).cast("int")).otherwise(value)


def format_date(c: Column) -> Column:
    return F.when(c == UNSET_DATE, F.lit("")).otherwise(F.format_string("%08d", c))


def calendar_date(c: Column) -> Column:
    """The day of an integer date; months and days out of range carry over."""
    year, month, day = F.floor(c / 10000).cast("int"), F.floor(c / 100).cast("int") % 100, c % 100
    return F.date_add(F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1), day - 1)


def weekday(c: Column) -> Column:
    """0 for Monday to 6 for Sunday, of an integer date."""
    return F.weekday(calendar_date(c))


def is_set_time(c: Column) -> Column:
    return c != UNSET_TIME


def is_set_date(c: Column) -> Column:
    return c != UNSET_DATE


# --- identifiers ----------------------------------------------------------


def trim_colon(c: Column) -> Column:
    """Without one trailing colon."""
    return F.when(F.endswith(c, F.lit(":")), F.substr(c, F.lit(1), F.length(c) - 1)).otherwise(c)


def _cut_last(c: Column, mark: str) -> Column:
    """Up to the last ``mark``, if that is not the first character."""
    at = F.length(c) - F.length(F.substring_index(c, mark, -1))
    return F.when((F.instr(c, mark) > 0) & (at > 1), F.substr(c, F.lit(1), at - 1)).otherwise(c)


JOURNEY = "it:apb:ServiceJourney:"
STOP_POINT = "it:apb:ScheduledStopPoint:"


def journey_base(c: Column) -> Column:
    """Key of a timetable journey id; empty unless it starts with the prefix."""
    rest = trim_colon(F.substr(c, F.lit(len(JOURNEY) + 1)))
    return F.when(F.startswith(c, F.lit(JOURNEY)), _cut_last(rest, ":")).otherwise(F.lit(""))


def live_journey_base(c: Column) -> Column:
    """Key of a live journey reference; the prefix may stand anywhere in it."""
    at = F.instr(c, JOURNEY)
    rest = F.substr(c, at + len(JOURNEY))
    rest = F.when(F.endswith(rest, F.lit("_")), F.substr(rest, F.lit(1), F.length(rest) - 1)).otherwise(rest)
    return F.when(at > 0, _cut_last(rest, ":")).otherwise(F.lit(""))


def direction_suffix(c: Column) -> Column:
    return F.substring_index(trim_colon(c), ":", -1)


def strip_stop_prefix(c: Column) -> Column:
    return F.when(F.startswith(c, F.lit(STOP_POINT)), F.substr(c, F.lit(len(STOP_POINT) + 1))).otherwise(c)


# --- live timestamps and durations ------------------------------------

ZONED = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})$"
LOCAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?$"
DAY = r"^\d{4}-\d{2}-\d{2}$"


def timestamp(c: Column) -> Column:
    """RFC 3339, without zone (UTC) or a date alone; else null. The session's
    time zone has to be UTC."""
    plain = F.replace(c, F.lit(","), F.lit("."))  # what fits has no other comma
    return F.when(c.rlike(ZONED) | c.rlike(LOCAL) | c.rlike(DAY), F.try_to_timestamp(plain))


def epoch(c: Column) -> Column:
    """Whole seconds since 1970 of a live timestamp, floored; null if bad."""
    return F.floor(timestamp(c).cast("double")).cast("long")


def wall_clock(c: Column) -> Column:
    """Seconds since midnight in the offset that the string itself states."""
    at = F.when(c.rlike(ZONED) | c.rlike(LOCAL), F.substr(c, F.lit(12), F.lit(8))).when(c.rlike(DAY), F.lit("00:00:00"))
    return F.when(at.isNotNull(), gtfs_time(at))


def wall_clock_less(c: Column, delay: Column) -> Column:
    """``wall_clock`` of the moment ``delay`` seconds before; wraps at midnight."""
    return F.pmod(wall_clock(c) - delay, F.lit(86400)).cast("int")


def duration(c: Column) -> Column:
    """Seconds of an ISO duration in hours, minutes and seconds. Bad tokens,
    days and fractions count 0; months read as minutes, as ``M`` is all there is."""
    given = F.trim(F.coalesce(c, F.lit("")))
    negative = F.startswith(given, F.lit("-"))
    rest = F.regexp_replace(F.regexp_replace(given, r"^-", ""), r"^(PT|P|T)", "")
    unit = lambda u: F.coalesce(
        F.aggregate(
            F.transform(F.regexp_extract_all(rest, F.lit(rf"([^HMS]*){u}"), F.lit(1)), lambda x: F.coalesce(F.when(x.rlike(r"^[+-]?[0-9]+$"), x.try_cast("long")), F.lit(0).cast("long"))),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        ),
        F.lit(0).cast("long"),
    )
    total = unit("H") * 3600 + unit("M") * 60 + unit("S")
    return F.when(negative, -total).otherwise(total).cast("int")


def plain_date(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


# --- maps; the values are fixed --------------------------------------------


def mapped(c: Column, pairs: dict[str, str], otherwise: str | Column) -> Column:
    out = None
    for key, value in pairs.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out.otherwise(F.lit(otherwise) if isinstance(otherwise, str) else otherwise)


#: Fixed values.
CAUSES = {
    "constructionWork": "CONSTRUCTION", "maintenanceWork": "MAINTENANCE", "specialEvent": "OTHER_CAUSE", "accident": "ACCIDENT",
    "strike": "STRIKE", "weather": "WEATHER", "technicalProblem": "TECHNICAL_PROBLEM",
}
EFFECTS = {
    "stopCancelled": "NO_SERVICE", "lineCancellation": "NO_SERVICE", "delayed": "SIGNIFICANT_DELAYS", "diverted": "DETOUR",
    "reducedService": "REDUCED_SERVICE", "additionalService": "ADDITIONAL_SERVICE", "modifiedService": "MODIFIED_SERVICE",
}
SEVERITIES = {"severe": "SEVERE", "warning": "WARNING", "normal": "INFO"}
LANGUAGES = {"DE": "de", "IT": "it", "EN": "en", "LAD": "lld"}


def cause(c: Column) -> Column:
    return mapped(c, CAUSES, "UNKNOWN_CAUSE")


def effect(c: Column) -> Column:
    return mapped(c, EFFECTS, "UNKNOWN_EFFECT")


def severity(c: Column) -> Column:
    return mapped(c, SEVERITIES, "UNKNOWN_SEVERITY")


def language(c: Column) -> Column:
    return mapped(F.upper(c), LANGUAGES, F.lower(c))


def live_direction(c: Column) -> Column:
    """1 is 1, 2 is 0, another positive number is one less, all else 0."""
    n = whole_number(c)
    return F.when(n == 1, 1).when(n == 2, 0).when(n > 0, n - 1).otherwise(0)


def timetable_direction(c: Column) -> Column:
    """R is 1, H and all else 0."""
    return F.when(c == "R", 1).otherwise(0)


def stop_status(at_stop: Column) -> Column:
    return F.when(at_stop == "true", "STOPPED_AT").otherwise("IN_TRANSIT_TO")


def congestion(c: Column) -> Column:
    """Null unless the vehicle is in congestion."""
    return F.when(c == "true", "CONGESTION")


def proximity(difference: Column, tolerance: int) -> Column:
    """1 / (1 + distance), 0 beyond the tolerance."""
    far = F.abs(difference)
    return F.when(far <= tolerance, 1.0 / (1.0 + far)).otherwise(0.0)


def delay(expected: Column, aimed: Column) -> Column:
    """Whole seconds between two live timestamps; null unless both parse."""
    return (epoch(expected) - epoch(aimed)).cast("int")


def entity_id(ref: Column, line: Column, departure: Column) -> Column:
    made = F.concat(F.lit("et-"), F.coalesce(line, F.lit("")), F.lit("-"), F.coalesce(departure, F.lit("")))
    return F.when(F.coalesce(ref, F.lit("")) == "", made).otherwise(ref)


# --- JSON: array or object ----------------------------------------------------


def array_or_object(raw: Column, element: str) -> Column:
    """Raw JSON that is an array or one object, as an array of structs; absent
    or ``null``: empty; anything else: null."""
    empty = F.array().cast(parsed_type(element))

    def parsed(given: Column) -> Column:
        return F.when(given.isin("", "null"), empty).when(F.startswith(given, F.lit("{")) | F.startswith(given, F.lit("[")), F.from_json(given, parsed_type(element)))

    # bound to a name, as generators compute an expression again wherever it stands
    return F.get(F.transform(F.array(F.trim(F.coalesce(raw, F.lit("")))), parsed), F.lit(0))


def parsed_type(element: str) -> str:
    return f"array<struct<{element}>>"
