"""NeTEx: XML to entity rows, entity rows to tables, and tables back.

What an entity keeps of its child elements follows a naming rule: ``XRef``
becomes ``x_ref`` and holds the reference, any other element's text goes under
its name in lower case with underscores. The specifications below say which
fields each entity has, and where the rule is broken.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, chain, islice
from typing import IO
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..session import shared_dir
from . import files, split_xml

SCHEMA = "type string, seq long, fields map<string,string>, file string"
#: Most pieces whose numbers of rows are sent to all tasks, so that rows stay where they are.
BROADCAST_PIECES = 200_000
#: Attributes that any entity may have.
ATTRIBUTES = {
    "id": "id", "version": "version", "responsibilitySetRef": "responsibility_set_ref", "created": "created", "changed": "changed",
    "modification": "modification", "status": "status", "dataSourceRef": "data_source_ref", "order": "order",
}
#: File, entity type and columns of the European profile (L1).
TABLES = {
    "Authority": ("authorities", "id version name name_lang short_name public_code organisation_type"),
    "Operator": ("operators", "id version name name_lang short_name legal_name organisation_type"),
    "VehicleType": ("vehicle_types", "id version low_floor has_lift_or_ramp has_hoist length"),
    "StopPlace": ("stop_places", "id version name name_lang short_name private_code longitude latitude transport_mode stop_place_type topographic_place_ref"),
    "Quay": ("quays", "id version stop_place_id name name_lang short_name private_code public_code longitude latitude quay_type"),
    "ScheduledStopPoint": ("scheduled_stop_points", "id version name name_lang short_name longitude latitude"),
    "Direction": ("directions", "id version direction_type"),
    "Route": ("routes", "id version name distance line_ref direction_type direction_ref inverse_route_ref"),
    "PointOnRoute": ("route_points", "id route_id order scheduled_stop_point_ref"),
    "Line": ("lines", "id version responsibility_set_ref name name_lang short_name description transport_mode transport_submode url public_code private_code operator_ref authority_ref monitored type_of_line_ref"),
    "DestinationDisplay": ("destination_displays", "id version side_text front_text"),
    "ServiceJourneyPattern": ("journey_patterns", "id version name route_ref"),
    "StopPointInJourneyPattern": ("stop_points_in_jp", "id version journey_pattern_id order scheduled_stop_point_ref for_alighting for_boarding destination_display_ref request_stop"),
    "ServiceLink": ("service_links", "id version distance from_point_ref to_point_ref"),
    "SiteConnection": ("connections", "id version default_duration both_ways from_stop_place_ref from_quay_ref to_stop_place_ref to_quay_ref"),
    "Notice": ("notices", "id version text text_lang"),
    "PassengerStopAssignment": ("stop_assignments", "id version order scheduled_stop_point_ref stop_place_ref quay_ref"),
    "DayType": ("day_types", "id version name"),
    "UicOperatingPeriod": ("operating_periods", "id version from_date to_date valid_day_bits"),
    "DayTypeAssignment": ("day_type_assignments", "id version order operating_period_ref day_type_ref"),
    "ServiceJourney": ("service_journeys", "id version name distance transport_mode transport_submode departure_time day_type_ref journey_pattern_ref vehicle_type_ref operator_ref line_ref train_number_ref"),
    "TimetabledPassingTime": ("passing_times", "id version service_journey_id stop_point_in_jp_ref order arrival_time departure_time arrival_day_offset departure_day_offset"),
    "TrainNumber": ("train_numbers", "id version for_advertisement"),
}
#: What the Italian profile (L2) extends or adds.
L2_TABLES = {
    "DayType": ("day_types", "id version name short_name description private_code"),
    "Operator": ("operators", "id version name name_lang short_name legal_name trading_name public_code private_code company_number description organisation_type primary_mode"),
    "VehicleType": ("vehicle_types", "id version name description private_code low_floor has_lift_or_ramp has_hoist length fuel_type euro_class"),
    "JourneyAccounting": ("journey_accounting", "id version name description accounted_object_ref organisation_ref supply_contract_ref accounting_code accounting_type partial distance duration"),
    "GroupOfOperators": ("groups_of_operators", "id version name short_name description private_code"),
}
#: Kept in the fields, in no table.
EXTRA = {"Operator": "public_code", "StopPlace": "public_code", "DayType": "name_lang"}
#: Frame: collection: the element's entity, or None where each child names its own.
FRAMES = {
    "ResourceFrame": {"organisations": None, "vehicleTypes": "VehicleType"},
    "SiteFrame": {"stopPlaces": "StopPlace"},
    "ServiceFrame": {
        "directions": "Direction", "routes": "Route", "lines": None, "destinationDisplays": "DestinationDisplay", "scheduledStopPoints": "ScheduledStopPoint",
        "serviceLinks": "ServiceLink", "connections": None, "stopAssignments": None, "journeyPatterns": None, "notices": "Notice",
    },
    "ServiceCalendarFrame": {"dayTypes": "DayType", "operatingPeriods": None, "dayTypeAssignments": "DayTypeAssignment"},
    "TimetableFrame": {"vehicleJourneys": None, "trainNumbers": "TrainNumber"},
}
L2_FRAMES = {"GeneralFrame": {"members": None}}
#: Elements that give another entity's rows.
SAME_AS = {"FlexibleLine": "Line", "DefaultConnection": "SiteConnection"}
#: References that the rule would name otherwise.
RENAMED = {
    ("ServiceJourney", "ServiceJourneyPatternRef"): "journey_pattern_ref",
    ("TimetabledPassingTime", "StopPointInJourneyPatternRef"): "stop_point_in_jp_ref",
    ("PointOnRoute", "RoutePointRef"): "scheduled_stop_point_ref",
}
#: Child entities: parent, collection, child element, the child's field of the parent's id.
CHILDREN = {
    ("StopPlace", "quays"): ("Quay", "stop_place_id"),
    ("Route", "pointsInSequence"): ("PointOnRoute", "route_id"),
    ("ServiceJourneyPattern", "pointsInSequence"): ("StopPointInJourneyPattern", "journey_pattern_id"),
    ("ServiceJourney", "passingTimes"): ("TimetabledPassingTime", "service_journey_id"),
}

PROFILES = {"epip": (TABLES, FRAMES), "it-l2": (TABLES | L2_TABLES, FRAMES | L2_FRAMES)}


def register_profile(name: str, tables: dict, frames: dict, base: str = "epip") -> None:
    """Adds a profile that extends another by tables and frames."""
    PROFILES[name] = (PROFILES[base][0] | tables, PROFILES[base][1] | frames)


def profile(name: str) -> tuple[dict, dict]:
    if name not in PROFILES:
        raise ValueError(f"no profile {name!r}; there are {', '.join(sorted(PROFILES))}")
    return PROFILES[name]


def local(tag: str) -> str:
    return tag.rpartition("}")[2]


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def own_text(e: ElementTree.Element) -> str:
    """An element's character data without that of nested elements."""
    return "".join([e.text or "", *((c.tail or "") for c in e)]).strip() if len(e) else (e.text or "").strip()


def attribute(e: ElementTree.Element, name: str) -> str:
    for k, v in e.items():
        if k == name or local(k) == name:
            return v
    return ""


Row = tuple[str, dict[str, str]]


class Reader:
    """Rows of elements. What a child or an attribute means is worked out once for each
    kind of entity and name, as a file has few of these and many elements."""

    def __init__(self, tables: dict, types: Sequence[str] | None = None):
        self.tables, self.types = tables, types
        self.steps: dict[str, dict[str, tuple[str, str, str]]] = {}
        self.names: dict[str, str | None] = {}

    def step(self, kind: str, tag: str) -> tuple[str, str, str]:
        """(what to do, field or child entity, its language's field or key) for a child."""
        wanted = {*self.tables[kind][1].split(), *EXTRA.get(kind, "").split()} if kind in self.tables else set()
        field = RENAMED.get((kind, tag)) or snake(tag)
        if (kind, tag) in CHILDREN:
            return "children", *CHILDREN[kind, tag]
        if tag in ("Centroid", "Location", "ValidBetween", "keyList") or tag in ("From", "To", "WalkTransferDuration") and kind == "SiteConnection" or tag in ("dayTypes", "trainNumbers") and kind == "ServiceJourney":
            return "nested", tag, ""
        if field not in wanted:
            return "none", "", ""
        if tag == "TransportSubmode":
            return "first", field, ""
        if tag.endswith("Ref"):
            return "ref", field, "order" if field == "stop_point_in_jp_ref" else ""
        return "text", field, f"{field}_lang" if f"{field}_lang" in wanted else ""

    def add(self, out: list[Row], e: ElementTree.Element, kind: str, parent: dict[str, str] | None = None) -> None:
        """Adds the rows of one element: its children's first, then its own."""
        fields: dict[str, str] = {}
        names, steps = self.names, self.steps.setdefault(kind, {})
        for a, v in e.items():
            if a not in names:
                names[a] = ATTRIBUTES.get(local(a))
            if (name := names[a]) is not None and name not in fields:
                fields[name] = v
        if "" in fields.values():
            fields = {k: v for k, v in fields.items() if v}
        if parent:
            fields.update(parent)
        for c in e:
            if (found := steps.get(c.tag)) is None:
                found = steps[c.tag] = self.step(kind, local(c.tag))
            what, field, other = found
            if what == "ref":
                fields[field] = attribute(c, "ref")
                if other:
                    fields[other] = attribute(c, "order")
            elif what == "text":
                fields[field] = own_text(c)
                if other:
                    fields[other] = attribute(c, "lang")
            elif what == "children":
                owner = {other: fields.get("id", "")}
                for x in c:
                    if local(x.tag) == field:
                        self.add(out, x, field, owner)
            elif what == "first":
                fields[field] = own_text(c[0]) if len(c) else ""
            elif what == "nested":
                fields.update(nested(c, field))
        if self.types is None or kind in self.types:
            out.append((kind, fields))


def nested(c: ElementTree.Element, tag: str) -> dict[str, str]:
    """The fields that a child gives by what is in it."""
    if tag in ("Centroid", "Location"):
        return {snake(local(x.tag)): own_text(x) for x in c.iter() if local(x.tag) in ("Longitude", "Latitude")}
    if tag in ("From", "To"):
        return {f"{tag.lower()}_{snake(local(x.tag))}": attribute(x, "ref") for x in c if local(x.tag) in ("StopPlaceRef", "QuayRef")}
    if tag == "WalkTransferDuration":
        return {"default_duration": own_text(x) for x in c if local(x.tag) == "DefaultDuration"}
    if tag in ("dayTypes", "trainNumbers"):
        return {snake(local(x.tag)): attribute(x, "ref") for x in c}  # the last of several
    if tag == "ValidBetween":
        return {f"valid_between_{snake(local(x.tag))[:-5]}": own_text(x) for x in c if local(x.tag) in ("FromDate", "ToDate")}
    return {f"key:{own_text(k)}": own_text(v) for x in c if (k := child_of(x, "Key")) is not None and (v := child_of(x, "Value")) is not None}


def child_of(e: ElementTree.Element, tag: str) -> ElementTree.Element | None:
    return next((x for x in e if local(x.tag) == tag), None)


#: Where the frames of a file are.
FRAMES_AT = ("PublicationDelivery", "dataObjects", "CompositeFrame", "frames")


def entities(data: Iterable[bytes], name: str | tuple[dict, dict] = "epip", types: Sequence[str] | None = None, prefix: bytes = b"", whole: bool = True) -> Iterator[Row]:
    """Entity rows of one file, or of a piece behind its ``prefix``, frame by
    frame, in constant memory; a ``whole`` document has to end well.

    Only frames of the first CompositeFrame below PublicationDelivery /
    dataObjects count; unknown frames and collections are passed over. The parser
    builds elements by itself; after each chunk those that have ended are read and
    dropped, so that Python does nothing at each start and end tag.
    """
    tables, frames = profile(name) if isinstance(name, str) else name
    reader = Reader(tables, types)
    parser = ElementTree.XMLPullParser(("start",))  # its first event gives the root
    root: ElementTree.Element | None = None
    done = False

    def kind_of(here: tuple[str, ...]) -> str | None:
        """The entity of an element of a collection, None if it is in no table."""
        inside = here[5:] if here[5] != "ServiceCalendar" else here[6:]
        kind = frames.get(here[4], {}).get(inside[0], "") or SAME_AS.get(inside[1], inside[1])
        return kind if inside[0] in frames.get(here[4], {}) and kind in tables else None

    def ended(e: ElementTree.Element, here: tuple[str, ...], over: bool) -> Iterator[Row]:
        """The rows of what has ended in an element, which is dropped; the last child
        may go on unless the element is ``over``."""
        nonlocal done
        n, out, kinds = len(e), [], {}
        entity = len(here) == 7 or len(here) == 6 and here[5] != "ServiceCalendar"
        for k, c in enumerate(e):
            past = over or k + 1 < n
            if entity:
                if not past or done:
                    continue
                if c.tag not in kinds:
                    kinds[c.tag] = kind_of((*here, local(c.tag)))
                if (kind := kinds[c.tag]) is not None:
                    reader.add(out, c, kind)
                    yield from out
                    out.clear()
                continue
            there = (*here, local(c.tag))
            if not done and there[:4] == FRAMES_AT[: len(there)]:
                yield from ended(c, there, past)
                done = done or past and there == FRAMES_AT
            elif not past:
                while len(c):  # of no use, so only what is still open stays
                    del c[:-1]
                    c = c[-1]
        del e[: n if over else n - 1]

    def read(over: bool) -> Iterator[Row]:
        nonlocal root
        for _, e in parser.read_events():
            if root is None:
                root = e
        if root is not None:
            yield from ended(root, (local(root.tag),), over)

    for part in chain([prefix], data):
        parser.feed(part)
        yield from read(False)
    if whole:
        parser.close()
    else:
        parser.flush()  # a short last chunk may have been put off
    yield from read(True)


def between(names: list[bytes]) -> bool:
    """Whether a file may be cut where these elements are open: outside entities."""
    return len(names) <= 6 or len(names) == 7 and names[5] == b"ServiceCalendar"


def read_xml(spark: SparkSession, path: str, name: str = "epip", types: Sequence[str] | None = None, piece: int = split_xml.PIECE, columns: Sequence[str] | None = None) -> DataFrame:
    """Entities of XML files, or of the first XML in zips: (type, seq, fields,
    file). ``types`` prunes inside the scan, as ``columns`` does, which are some
    fields that stand in place of ``fields``, null where absent.

    Files up to ``piece`` bytes are a task's row each. Larger ones are cut between
    entities into pieces of about that size, each parsed by a task of its own, and
    the rows are written to the shared folder, since ``seq`` counts those of the
    pieces before. An archive's file is read on by one task, however large. What
    follows the first CompositeFrame's frames may not be looked at.
    """
    known = profile(name)  # sent along: registered profiles are the driver's
    given = ["fields"] if columns is None else [f"`{c}`" for c in columns]
    schema = SCHEMA if columns is None else ", ".join(["type string", "seq long", *(f"{c} string" for c in given), "file string"])

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with io.BytesIO(content) as held:
                    yield from batches_of(entities(xml_of(held), known, types), file, columns)

    def large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start, end, length, prefix, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with files.opened(file) as held:
                    data = xml_of(held) if (start, end) == (0, length) else files.chunks(held, start, end)
                    rows = entities(data, known, types, prefix, whole=end == length)
                    for part in batches_of(rows, file, columns):
                        yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.repeat(pa.scalar(number, pa.int64()), part.num_rows)], [*part.schema.names[:-1], "piece"])

    every = spark.read.format("binaryFile").load(path)
    found = every.where(F.col("length") <= piece).select("path", "content").mapInArrow(small, schema)
    over = files.listed(spark, path).where(F.col("length") > piece)
    if over.isEmpty():
        return found
    cuts = split_xml.pieces(over, between, ("PublicationDelivery", "dataObjects", "CompositeFrame", "frames"), piece)
    n = cuts.count()
    numbered = schema.removesuffix("file string") + "piece long"
    folder = shared_dir(spark)
    split_xml.dealt(cuts, n).mapInArrow(large, numbered).write.parquet(folder)
    rows = spark.read.schema(numbered).parquet(folder)
    order = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counted = cuts.select("piece", "path", "start").join(rows.groupBy("piece").count(), "piece")  # a row for each piece
    before = counted.select("piece", F.col("path").alias("file"), F.coalesce(F.sum("count").over(order), F.lit(0)).alias("before"))
    placed = rows.join(F.broadcast(before) if n <= BROADCAST_PIECES else before, "piece")
    return found.union(placed.select("type", (F.col("seq") + F.col("before")).alias("seq"), *given, "file"))


def xml_of(file: IO[bytes]) -> Iterator[bytes]:
    """The bytes of an XML file, or of the first one in an archive."""
    first = file.read(2)
    file.seek(0)
    if first != b"PK":
        yield from files.streamed(file)
        return
    with zipfile.ZipFile(file) as z:
        member = next((n for n in z.namelist() if n.lower().endswith(".xml")), None)
        if member is None:
            raise ValueError("no XML file in the archive")
        with z.open(member) as held:
            yield from files.streamed(held)


def batches_of(rows: Iterator[Row], file: str, columns: Sequence[str] | None = None, size: int = 5_000) -> Iterator[pa.RecordBatch]:
    """Rows numbered from 0, so many at a time."""
    seq = 0
    while part := list(islice(rows, size)):
        yield to_batch(part, seq, file, columns)
        seq += len(part)


def to_batch(rows: list[Row], seq: int, file: str, columns: Sequence[str] | None = None) -> pa.RecordBatch:
    if columns is not None:
        own = [pa.array([f.get(c) for _, f in rows], pa.string()) for c in columns]
        return pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array(range(seq, seq + len(rows)), pa.int64()), *own, pa.repeat(pa.scalar(file, pa.string()), len(rows))], ["type", "seq", *columns, "file"])
    ends = pa.array(accumulate((len(f) for _, f in rows), initial=0), pa.int32())
    names, values = (pa.array(list(chain.from_iterable(part)), pa.string()) for part in ((f.keys() for _, f in rows), (f.values() for _, f in rows)))
    fields = pa.MapArray.from_arrays(ends, names, values)
    return pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array(range(seq, seq + len(rows)), pa.int64()), fields, pa.repeat(pa.scalar(file, pa.string()), len(rows))], ["type", "seq", "fields", "file"])


# --- tables ---------------------------------------------------------------


def table(rows: DataFrame, kind: str, name: str = "epip") -> DataFrame:
    """The columns of an entity's table; an absent field is empty."""
    fields = profile(name)[0][kind][1].split()
    return rows.where(F.col("type") == kind).select(*[F.coalesce(F.try_element_at("fields", F.lit(f)), F.lit("")).alias(f) for f in fields], F.struct("file", "seq").alias("_ord"))


def type_of_file(file: str) -> str:
    """The entity type of a CSV file: most table files name their entity, five
    files have a name of their own here; others stand for themselves."""
    #: Fixed values.
    own = {"connections": "Connection", "stop_assignments": "StopAssignment", "operating_periods": "OperatingPeriod", "route_points": "RoutePoint", "journey_accountings": "JourneyAccounting"}
    base = re.sub(r"\.csv$", "", file.rpartition("/")[2])
    names = {f: kind for kind, (f, _) in (TABLES | {"GroupOfOperators": L2_TABLES["GroupOfOperators"]}).items()} | own
    return names.get(base, base)


#: A table's file, or a part of one that is a folder.
CSV_FILE = re.compile(r"([^/]+)\.csv(?:/part-[^/]*\.csv)?$")


def read_csv_folder(spark: SparkSession, path: str | Sequence[str], only: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Entities of the CSV files below a folder, or of given ones: (type, seq,
    fields, file). Files are listed once and told apart by their names, so one scan
    takes any number of them and does not open those of other types. A file, or a
    part of one, is read on by a task; ragged rows fail the load."""

    def wanted(file: str) -> str | None:
        found = CSV_FILE.search(file)
        kind = type_of_file(found[1]) if found else None
        return kind if kind and (kind in only if only is not None else kind not in exclude) else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                if (kind := wanted(file)) is None:
                    continue
                with files.opened(file) as held:
                    rows = csv.reader(io.TextIOWrapper(held, "utf-8-sig", newline=""))
                    names = [n.strip() for n in next(rows, [])]
                    yield from batches_of(((kind, dict(zip(names, map(str.strip, row), strict=True))) for row in rows if row), file)

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([path] if isinstance(path, str) else list(path)).select("path")
    n = listed.where(F.col("path").rlike(r"\.csv$")).count()
    return listed.where(F.col("path").rlike(r"\.csv$")).repartitionByRange(max(1, n), "path").mapInArrow(parse, SCHEMA)


def types_present(rows: DataFrame) -> DataFrame:
    return rows.select("type").distinct().orderBy("type")


def counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("type").agg(F.count("*").alias("rows"))


def get(rows: DataFrame, kind: str, key: str) -> DataFrame:
    """The last entity of a type with an id."""
    found = rows.where((F.col("type") == kind) & (F.try_element_at("fields", F.lit("id")) == key))
    return found.orderBy(F.desc("file"), F.desc("seq")).limit(1)


# --- in SQL -----------------------------------------------------------------


def register_table_function(spark: SparkSession, function: str = "netex_table") -> None:
    """Makes a table function of all profiles known now:
    ``select t.* from files, lateral netex_table(content, 'Line', 'epip') t``.

    Its columns follow the profile, so they are known when the query is analysed.
    A profile that is registered later needs the function registered again.
    """
    known = dict(PROFILES)

    class NetexTable:
        @staticmethod
        def analyze(content: AnalyzeArgument, kind: AnalyzeArgument, name: AnalyzeArgument) -> AnalyzeResult:
            if kind.value is None or name.value is None:
                raise ValueError("kind and profile have to be constants")
            if name.value not in known or kind.value not in known[name.value][0]:
                raise ValueError(f"no table of {kind.value!r} in a profile {name.value!r}")
            schema = StructType()
            for column in known[name.value][0][kind.value][1].split():
                schema = schema.add(column, "string")
            return AnalyzeResult(schema)

        def eval(self, content: bytes, kind: str, name: str) -> Iterator[tuple]:
            if content is None:
                return
            columns = known[name][0][kind][1].split()
            with io.BytesIO(bytes(content) if not isinstance(content, str) else content.encode()) as held:
                for _, fields in entities(xml_of(held), known[name], [kind]):
                    yield tuple(fields.get(c, "") for c in columns)

    spark.udtf.register(function, udtf(NetexTable))
