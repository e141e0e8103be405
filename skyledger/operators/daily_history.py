"""Strict history a day at a time: a stored state of running sums, advanced by one day's cells."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import history
from skyledger.operators.joins import attach
from skyledger.sources.merged import MergedTable
from skyledger.sources.staging import stage, temporary

AS_OF = "as_of"


class DailyHistory:
    """History lookups that grow by days, below one folder.

    ``cells`` holds each day's sums per (origin, dest, carrier), ``states`` the running
    sums up to and including a day, ``lookups`` what flights of a day may know: the same
    rows as :func:`history.prior_lookup` has for it. A day's step reads that day's cells
    and the state before it, however long the past is. A state has one row per route and
    carrier ever flown.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.cells = MergedTable(spark, f"{root}/cells", [history.DAY])
        self.states = MergedTable(spark, f"{root}/states", [AS_OF])
        self.lookups = MergedTable(spark, f"{root}/lookups", [history.DAY])

    def days(self) -> list[dt.date]:
        """Days with a state, in order."""
        return [dt.date.fromisoformat(p) for p in self.states.partitions()]

    def start(self, flights: DataFrame) -> None:
        """Begin with a whole past in one pass: the state after its last day, and no lookups for it."""
        with temporary(self.spark):
            summed = stage(history.cells(flights, [history.DAY]), "daily-past")
            last = summed.agg(F.max(history.DAY)).first()[0]
            if last is not None:
                self.states.replace(_added(summed.drop(history.DAY)).withColumn(AS_OF, F.lit(last)))

    def add(self, flights: DataFrame) -> list[dt.date]:
        """Take in whole days of flights, in any order; returns the days that were worked out.

        A day that was there is replaced. From the earliest of the given days on, all days
        are worked out again from the last state before it, out of their stored cells; for
        a day that follows all others this is the day alone. A day that lies before the
        oldest kept state can not be taken in.
        """
        with temporary(self.spark):
            own = stage(history.cells(flights.filter(F.col(history.DAY).isNotNull()), [history.DAY]), "daily-cells")
            given = sorted(r[0] for r in own.select(history.DAY).distinct().collect())
            if not given:
                return []
            kept, stored = self.days(), [dt.date.fromisoformat(p) for p in self.cells.partitions()]
            before = [d for d in kept if d < given[0]]
            if kept and not before and not set(kept) <= {*stored, *given}:
                raise ValueError(f"{given[0]} lies before the oldest kept state, {kept[0]}")
            self.cells.replace(own)
            todo = sorted({*given, *(d for d in stored if d > given[0])})
            last = before[-1] if before else None
            for day in todo:
                self._step(day, last)
                last = day
            return todo

    def _step(self, day: dt.date, last: dt.date | None) -> None:
        today = self.cells.read([self.cells.partition_of(day)])
        known = self.states.read([self.states.partition_of(last)]).drop(AS_OF) if last else today.drop(history.DAY).limit(0)
        lookup = today.select(*history.CELL, history.DAY, F.col("flights").alias(history.ROWS))
        for keys, statistics in history.STATISTICS.items():
            summed = _added(known, list(keys))
            table = stage(summed.select(*keys, *history._quotients(statistics)), f"daily-{'-'.join(keys)}")
            lookup = attach(lookup, table, list(keys))
        self.lookups.replace(lookup)
        self.states.replace(_added(known.unionByName(today.drop(history.DAY))).withColumn(AS_OF, F.lit(day)))

    def forget(self, keep: int) -> list[dt.date]:
        """Drop the states of all but the last ``keep`` days; later days than the oldest of these can still come late."""
        gone = self.days()[:-keep]
        self.states.drop([self.states.partition_of(d) for d in gone])
        return gone


def _added(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or history.CELL
    return cells.groupBy(*keys).agg(*[F.sum(p).alias(p) for p in history.PARTS])
