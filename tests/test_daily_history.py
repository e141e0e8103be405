import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.operators import history
from skyledger.operators.daily_history import DailyHistory

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 4, 5, 6)]


@pytest.fixture(scope="module")
def flights(make_flights, spark):
    rows = []
    for i, day in enumerate(DAYS):
        for j in range(6):
            rows.append({
                "FlightDate": day, "Origin": "JFK" if j % 2 else "LAX", "Dest": "SFO" if j % 3 else "SEA",
                "IATA_CODE_Reporting_Airline": "AA" if (i + j) % 2 else "DL", "Flight_Number_Reporting_Airline": f"{i}-{j}",
                "ArrDelayMinutes": None if j == 5 else float(i * 7 + j), "ArrDel15": (i + j) % 2, "Cancelled": int(j == 4),
                "WeatherDelay": float(j == 2), "NASDelay": float(j == 3), "LateAircraftDelay": float(i == 1),
            })
    return make_flights(*rows)


def content(df):
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def of_day(flights, day):
    return flights.filter(F.col(history.DAY) == F.lit(day))


def files_read(df):
    return {f.split("table_part=")[1].split("/")[0] for f in df.inputFiles()}


def test_daily_steps_equal_one_pass_over_everything(spark, flights, tmp_path):
    """Started with a day, the others added one by one, one of them late and one twice."""
    ledger = DailyHistory(spark, str(tmp_path / "h"))
    ledger.start(of_day(flights, DAYS[0]))
    assert ledger.add(of_day(flights, DAYS[1])) == [DAYS[1]]
    assert ledger.add(of_day(flights, DAYS[3])) == [DAYS[3]]
    assert ledger.add(of_day(flights, DAYS[4])) == [DAYS[4]]
    assert ledger.add(of_day(flights, DAYS[2])) == DAYS[2:]
    assert ledger.add(of_day(flights, DAYS[4])) == [DAYS[4]]
    want = history.prior_lookup(flights).filter(F.col(history.DAY) > F.lit(DAYS[0]))
    assert content(ledger.lookups.read()) == content(want)


def test_a_step_reads_its_day_and_one_state(spark, flights, tmp_path, monkeypatch):
    ledger = DailyHistory(spark, str(tmp_path / "h"))
    ledger.add(flights.filter(F.col(history.DAY) < F.lit(DAYS[4])))
    read = []
    plain = type(ledger.cells).read
    monkeypatch.setattr(type(ledger.cells), "read", lambda self, some=None: read.append((self.by[0], some)) or plain(self, some))
    ledger.add(of_day(flights, DAYS[4]))
    assert read == [(history.DAY, ["2024-01-06"]), ("as_of", ["2024-01-05"])]


def test_from_nothing_and_with_few_states(spark, flights, tmp_path):
    ledger = DailyHistory(spark, str(tmp_path / "h"))
    assert ledger.add(flights.limit(0)) == []
    assert ledger.add(flights) == DAYS
    assert content(ledger.lookups.read()) == content(history.prior_lookup(flights))
    assert ledger.forget(2) == DAYS[:3] and ledger.days() == DAYS[3:]
    changed = of_day(flights, DAYS[4]).withColumn("Cancelled", F.lit(1))
    assert ledger.add(changed) == [DAYS[4]]
    ledger = DailyHistory(spark, str(tmp_path / "other"))
    ledger.start(flights.filter(F.col(history.DAY) < F.lit(DAYS[3])))
    with pytest.raises(ValueError, match="before the oldest kept state"):
        ledger.add(of_day(flights, DAYS[0]))
