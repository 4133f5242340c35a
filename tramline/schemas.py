"""Tables, as plain specifications: GTFS columns with their kinds, and the
fields of live feeds."""

from __future__ import annotations

#: GTFS tables: column and kind (s string, i int, f double, b bool, t time, d date).
GTFS = {
    "agency": "agency_id:s agency_name:s agency_url:s agency_timezone:s agency_lang:s agency_phone:s agency_fare_url:s agency_email:s",
    "stops": "stop_id:s stop_code:s stop_name:s stop_desc:s stop_lat:f stop_lon:f zone_id:s stop_url:s location_type:i parent_station:s stop_timezone:s wheelchair_boarding:i level_id:s platform_code:s",
    "routes": "route_id:s agency_id:s route_short_name:s route_long_name:s route_desc:s route_type:i route_url:s route_color:s route_text_color:s route_sort_order:i continuous_pickup:i continuous_drop_off:i network_id:s",
    "trips": "route_id:s service_id:s trip_id:s trip_headsign:s trip_short_name:s direction_id:i block_id:s shape_id:s wheelchair_accessible:i bikes_allowed:i",
    "stop_times": "trip_id:s arrival_time:t departure_time:t stop_id:s stop_sequence:i stop_headsign:s pickup_type:i drop_off_type:i continuous_pickup:i continuous_drop_off:i shape_dist_traveled:f timepoint:i",
    "calendar": "service_id:s monday:b tuesday:b wednesday:b thursday:b friday:b saturday:b sunday:b start_date:d end_date:d",
    "calendar_dates": "service_id:s date:d exception_type:i",
    "shapes": "shape_id:s shape_pt_lat:f shape_pt_lon:f shape_pt_sequence:i shape_dist_traveled:f",
    "translations": "table_name:s field_name:s language:s translation:s record_id:s record_sub_id:s",
}
#: Loaded only on request.
OPT_IN = ("shapes", "translations")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

FRAMED = "FramedVehicleJourneyRef struct<DataFrameRef:string,DatedVehicleJourneyRef:string>"
#: One vehicle activity of a VehicleMonitoring feed.
VM_ACTIVITY = (
    "RecordedAtTime string, ValidUntilTime string, VehicleMonitoringRef string, MonitoredVehicleJourney struct<LineRef:string,DirectionRef:string,"
    "FramedVehicleJourneyRef:struct<DataFrameRef:string,DatedVehicleJourneyRef:string>,PublishedLineName:string,DirectionName:string,OperatorRef:string,"
    "ProductCategoryRef:string,Monitored:string,InCongestion:string,VehicleLocation:struct<Longitude:string,Latitude:string>,Delay:string,VehicleRef:string,"
    "MonitoredCall:struct<StopPointRef:string,StopPointName:string,VehicleAtStop:string>>"
)
CALL = "StopPointRef string, VisitNumber string, StopPointName string, DestinationDisplay string, " + ", ".join(
    f"{x} string" for k in ("Arrival", "Departure") for x in (f"Aimed{k}Time", f"Expected{k}Time", f"{k}Status", f"{k}PlatformName", f"{k}BoardingActivity")
)
#: One journey of an EstimatedTimetable feed; its calls stay raw JSON.
ET_JOURNEY = (
    "RecordedAtTime string, LineRef string, DirectionRef string, FramedVehicleJourneyRef struct<DataFrameRef:string,DatedVehicleJourneyRef:string>, "
    "PublishedLineName string, DirectionName string, OperatorRef string, ProductCategoryRef string, OriginRef string, DestinationRef string, "
    "OriginAimedDepartureTime string, DestinationAimedArrivalTime string, Monitored string, MonitoringError string, BlockRef string, "
    "IsCompleteStopSequence string, EstimatedCalls struct<EstimatedCall:string>"
)
#: One situation of a SituationExchange feed; fields that are an array or an object stay raw JSON.
SITUATION = (
    "CreationTime string, ParticipantRef string, SituationNumber string, Version string, Progress string, ValidityPeriod string, AlertCause string, "
    "ReasonName string, ScopeType string, Planned string, Language string, "
    "Affects struct<StopPoints:struct<AffectedStopPoint:string>,Networks:struct<AffectedNetwork:string>>, Consequences struct<Consequence:string>"
)
#: The envelope of a queued payload.
ENVELOPE = "format string, protocol string, metadata map<string,string>, payload string"


def columns(table: str) -> list[tuple[str, str]]:
    """(column, kind) of a GTFS table."""
    return [tuple(c.split(":")) for c in GTFS[table].split()]
