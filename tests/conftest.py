import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from datasets import DATA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from skyledger.session import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__default__parallelism="8",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lk(spark):
    from skyledger.plans.lake import lake

    return lake(spark, DATA)


FLIGHT_DDL = (
    "FlightDate date, IATA_CODE_Reporting_Airline string, Flight_Number_Reporting_Airline string, "
    "Origin string, Dest string, CRSDepTime int, CRSArrTime int, Year int, Month int, DayOfWeek int, "
    "Distance double, DistanceGroup int, DepDelayMinutes double, ArrDelayMinutes double, DepDel15 int, "
    "ArrDel15 int, Cancelled int, Diverted int, CarrierDelay double, WeatherDelay double, NASDelay double, "
    "SecurityDelay double, LateAircraftDelay double, OriginState string, DestState string, "
    "source_file string, ingest_ts timestamp"
)


@pytest.fixture(scope="session")
def make_flights(spark):
    """Flights from dicts; what is not given has a plain default."""
    import datetime as dt

    names = [part.split()[0] for part in FLIGHT_DDL.split(", ")]

    def build(*rows):
        filled = []
        for given in rows:
            day = given.get("FlightDate", dt.date(2024, 1, 1))
            row = {
                "FlightDate": day, "IATA_CODE_Reporting_Airline": "AA", "Flight_Number_Reporting_Airline": "1",
                "Origin": "JFK", "Dest": "LAX", "CRSDepTime": 900, "CRSArrTime": 1200,
                "Year": day.year if day else 2024, "Month": day.month if day else 1,
                "DayOfWeek": day.isoweekday() if day else 1, "Distance": 100.0, "DistanceGroup": 1,
                "DepDelayMinutes": 0.0, "ArrDelayMinutes": 0.0, "DepDel15": 0, "ArrDel15": 0, "Cancelled": 0,
                "Diverted": 0, "CarrierDelay": 0.0, "WeatherDelay": 0.0, "NASDelay": 0.0, "SecurityDelay": 0.0,
                "LateAircraftDelay": 0.0, "OriginState": "NY", "DestState": "CA", "source_file": "f",
                "ingest_ts": dt.datetime(2024, 2, 1),
            }
            row.update(given)
            filled.append(tuple(row[n] for n in names))
        return spark.createDataFrame(filled, FLIGHT_DDL)

    return build
