"""Table layouts and fixed values.

Schemas are declared once as DDL text and parsed by Spark. Every layout is
selected by name, so a missing column is an analysis error, not a gap.
"""

from pyspark.sql.types import StructType

# --- Fixed values: names, limits and word lists that define the data contract.

FLIGHT_KEY = [
    "FlightDate",
    "IATA_CODE_Reporting_Airline",
    "Flight_Number_Reporting_Airline",
    "Origin",
    "Dest",
    "CRSDepTime",
]

CARRIER = "IATA_CODE_Reporting_Airline"

CAUSES = ["CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]

POST_FLIGHT_COLUMNS = [
    "DepTime", "ArrTime", "TaxiOut", "TaxiIn", "WheelsOff", "WheelsOn",
    "ActualElapsedTime", "AirTime",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
]

INGEST_COLUMNS = [
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "FlightDate",
    "Reporting_Airline", "DOT_ID_Reporting_Airline", "IATA_CODE_Reporting_Airline",
    "Tail_Number", "Flight_Number_Reporting_Airline",
    "OriginAirportID", "Origin", "OriginCityName", "OriginState", "OriginStateName",
    "DestAirportID", "Dest", "DestCityName", "DestState", "DestStateName",
    "CRSDepTime", "CRSArrTime", "CRSElapsedTime", "DepTimeBlk", "ArrTimeBlk",
    "DepDelay", "DepDelayMinutes", "DepDel15",
    "ArrDelay", "ArrDelayMinutes", "ArrDel15",
    "Cancelled", "CancellationCode", "Diverted",
    "Distance", "DistanceGroup",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
]

REQUIRED_FILE_COLUMNS = [
    "FlightDate", "IATA_CODE_Reporting_Airline", "Origin", "Dest",
    "CRSDepTime", "CRSArrTime", "Cancelled",
]

INTEGER_COLUMNS = [
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek",
    "CRSDepTime", "CRSArrTime", "DistanceGroup",
    "Cancelled", "Diverted", "DepDel15", "ArrDel15",
]

DOUBLE_COLUMNS = [
    "CRSElapsedTime", "Distance",
    "DepDelay", "DepDelayMinutes", "ArrDelay", "ArrDelayMinutes",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
]

TEXT_COLUMNS = [
    "IATA_CODE_Reporting_Airline", "Origin", "Dest",
    "OriginState", "DestState", "CancellationCode",
]

PROFILE_NUMERIC = [
    "DepDelay", "DepDelayMinutes", "ArrDelay", "ArrDelayMinutes",
    "Cancelled", "Diverted", "Distance", "CRSElapsedTime",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
]

PROFILE_TEXT = [
    "IATA_CODE_Reporting_Airline", "Origin", "Dest",
    "OriginState", "DestState", "CancellationCode",
]

CRITICAL_COLUMNS = ["FlightDate", "Origin", "Dest", "IATA_CODE_Reporting_Airline"]

MIN_VALID_RATIO = 0.95
MAX_DUPLICATE_RATE = 0.01
CAP_PERCENTILE = 0.995
CAP_WITHOUT_DATA = 999.0

YEARS = (2021, 2025)
TRAIN_TEST_BOUNDARY = "2025-01-01"
OLD_DATA_BOUNDARY = "2023-01-01"
OLD_DATA_WEIGHT = 0.5

LABEL_NULL_MARKERS = ["\\N", "\\\\N", "", "NULL", "null", "nan"]

HISTORY_COLUMNS = [
    "route_avg_arr_delay_prev", "route_arr_delay_rate_prev", "route_cancel_rate_prev",
    "carrier_arr_delay_rate_prev", "carrier_cancel_rate_prev",
    "origin_arr_delay_rate_prev", "origin_cancel_rate_prev",
    "dest_arr_delay_rate_prev", "dest_cancel_rate_prev",
    "route_carrier_arr_delay_rate_prev",
]

CAUSE_HISTORY_COLUMNS = [
    "route_weather_delay_rate_prev", "origin_weather_delay_rate_prev",
    "origin_nas_delay_rate_prev", "carrier_late_aircraft_rate_prev",
]

MODEL_FEATURES = [
    "dep_hour_sin", "dep_hour_cos", "month_sin", "month_cos", "dow_sin", "dow_cos",
    "flight_day",
    "airline_index", "origin_index", "dest_index", "season_index",
    "Distance", "CRSElapsedTime", "distance_bucket",
    "has_route_history", "has_weather_history",
    "route_avg_arr_delay_prev", "route_arr_delay_rate_prev", "route_cancel_rate_prev",
    "route_carrier_arr_delay_rate_prev",
    "carrier_arr_delay_rate_prev", "carrier_cancel_rate_prev",
    "origin_arr_delay_rate_prev", "origin_cancel_rate_prev",
    "dest_arr_delay_rate_prev", "dest_cancel_rate_prev",
    "route_weather_delay_rate_prev", "origin_weather_delay_rate_prev",
    "origin_nas_delay_rate_prev", "carrier_late_aircraft_rate_prev",
    "route_x_carrier_risk", "origin_x_dest_risk", "carrier_rate_x_peak_hour",
    "weather_x_nas_risk",
]

NUMERIC_FEATURE_INPUTS = [
    "flight_month", "dep_hour", "is_weekend", "same_state_route", "day_of_week",
    "CRSElapsedTime", "Distance", "flight_day", "distance_bucket",
]

# --- Fixed values: table layouts and the labels' names.

MESSAGE_DDL = """
Year INT, Quarter INT, Month INT, DayofMonth INT, DayOfWeek INT, FlightDate STRING,
Reporting_Airline STRING, DOT_ID_Reporting_Airline INT, IATA_CODE_Reporting_Airline STRING,
Tail_Number STRING, Flight_Number_Reporting_Airline STRING,
OriginAirportID INT, Origin STRING, OriginCityName STRING, OriginState STRING,
OriginStateName STRING,
DestAirportID INT, Dest STRING, DestCityName STRING, DestState STRING, DestStateName STRING,
CRSDepTime INT, CRSArrTime INT, CRSElapsedTime DOUBLE, DepTimeBlk STRING, ArrTimeBlk STRING,
DepDelay DOUBLE, DepDelayMinutes DOUBLE, DepDel15 INT,
ArrDelay DOUBLE, ArrDelayMinutes DOUBLE, ArrDel15 INT,
Cancelled INT, CancellationCode STRING, Diverted INT, Distance DOUBLE, DistanceGroup INT,
CarrierDelay DOUBLE, WeatherDelay DOUBLE, NASDelay DOUBLE, SecurityDelay DOUBLE,
LateAircraftDelay DOUBLE,
ingest_ts STRING, source_file STRING, source_year INT, source_month INT
"""

CURATED_COLUMNS = [
    "FlightDate", "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek",
    "IATA_CODE_Reporting_Airline", "Reporting_Airline", "Tail_Number",
    "Flight_Number_Reporting_Airline",
    "OriginAirportID", "Origin", "OriginCityName", "OriginState", "OriginStateName",
    "DestAirportID", "Dest", "DestCityName", "DestState", "DestStateName",
    "CRSDepTime", "CRSArrTime", "CRSElapsedTime", "DepTimeBlk", "ArrTimeBlk",
    "DepDelay", "DepDelayMinutes", "DepDel15", "ArrDelay", "ArrDelayMinutes", "ArrDel15",
    "Cancelled", "CancellationCode", "Diverted",
    "is_cancelled", "has_arr_delay_label", "has_dep_delay_label",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
    "Distance", "DistanceGroup",
    "dep_delay_minutes_original", "arr_delay_minutes_original",
    "dep_delay_minutes_capped", "arr_delay_minutes_capped",
    "ingest_ts", "source_file", "source_year", "source_month",
]

POST_EVENT_COLUMNS = FLIGHT_KEY + CAUSES + [
    "DepDelayMinutes", "ArrDelayMinutes", "DepDel15", "ArrDel15", "Cancelled", "Diverted",
]

PRE_FLIGHT_COLUMNS = FLIGHT_KEY + [
    "flight_year", "flight_quarter", "flight_month", "flight_day",
    "day_of_week", "is_weekend", "season", "dep_hour", "arr_hour",
    "dep_time_bucket", "arr_time_bucket",
    "route", "same_state_route", "distance_bucket",
    "CRSElapsedTime", "Distance", "DistanceGroup",
    "OriginAirportID", "OriginState", "DestAirportID", "DestState",
]

LABEL_NAMES = {
    "DepDelayMinutes": "dep_delay_minutes_label",
    "ArrDelayMinutes": "arr_delay_minutes_label",
    "DepDel15": "dep_del15_label",
    "ArrDel15": "arr_del15_label",
    "Cancelled": "cancelled_label",
}


def struct(ddl: str) -> StructType:
    """Parse DDL text to a StructType (needs an active session)."""
    return StructType.fromDDL(" ".join(ddl.split()))
