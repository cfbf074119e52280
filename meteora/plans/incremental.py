"""Both facts kept up to date by changes of the observations, without aggregating all of them again.

A store (``sinks.store``) holds the daily partial aggregates, the daily and the yearly fact, each in folders
by year and ``slot`` (a hash of the station).  After observations were added, corrected or removed, the
partials of just the touched station-days are computed anew from the observations as they are now; the other
partials of the same folders are carried over.  Partials merge, so the yearly fact follows from the partials
of the touched folders, exactly as a full build would give it.  All three tables change in one commit.

What is read: the observations of the touched years, cut to the touched station-days before any shuffle of
them, and the touched folders.  What is written: the touched folders.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora.operators.aggregate import daily_parts, finish_parts, roll_up_parts, year_start
from meteora.operators.join import checked_broadcast
from meteora.options import TransformOptions
from meteora.plans.facts import enrich, fact_columns
from meteora.session import scratch_path
from meteora.sinks.store import Store, Transaction

PARTS, DAILY, YEARLY = "daily_parts", "fact_daily", "fact_yearly"
FOLDERS = ["year", "slot"]
#: Folders of a year.  More of them let a change touch less; each should still hold a file worth reading.
SLOTS = 16


def placed(df: DataFrame, slots: int) -> DataFrame:
    """``df`` (with id and date) with the folder of each row."""
    return df.withColumns({"year": F.year("date"), "slot": F.pmod(F.xxhash64("id"), F.lit(slots)).cast("int")})


def touched_days(*deltas: DataFrame) -> DataFrame:
    """The station-days of added, corrected (old and new rows) and removed observations.

    Observations without a station or a date reach no fact and touch nothing.
    """
    days = reduce(DataFrame.unionByName, (d.select("id", "date") for d in deltas))
    return days.where("id IS NOT NULL AND date IS NOT NULL").distinct()


def folders_of(days: DataFrame, slots: int) -> list[tuple[int, int]]:
    """Year and slot of every folder with a touched station-day: at most ``slots`` per year come back."""
    return sorted((r["year"], r["slot"]) for r in placed(days, slots).select(*FOLDERS).distinct().collect())


def keys_of(folders: Iterable[tuple[int, int]]) -> list[str]:
    return [f"year={y}/slot={s}" for y, s in folders]


def in_years(df: DataFrame, years: Iterable[int]) -> DataFrame:
    """Rows of the given years; on a table with a year column only their folders are read."""
    year = F.col("year") if "year" in df.columns else F.year("date")
    return df.where(year.isin(sorted(set(years))))


class IncrementalFacts:
    """The facts of one dialect, stored below ``path``."""

    def __init__(self, spark: SparkSession, path: str, opts: TransformOptions, slots: int = SLOTS):
        self.spark, self.opts, self.slots, self.store = spark, opts, slots, Store(spark, path)

    def build(self, obs: DataFrame, stations: DataFrame, countries: DataFrame) -> int:
        """All three tables from all observations; one scan of them."""
        change = self.store.begin()
        dated = obs.where("id IS NOT NULL AND date IS NOT NULL")
        return self._commit(change, daily_parts(dated, self.opts), stations, countries, None)

    def apply(self, obs: DataFrame, touched: DataFrame, stations: DataFrame, countries: DataFrame) -> int | None:
        """Take over a change.  ``obs`` are the observations after it, ``touched`` its station-days (``touched_days``).

        Returns the new version, or None when nothing was touched.
        """
        days = self._stored(touched.select("id", "date"), "touched")
        folders = folders_of(days, self.slots)
        if not folders:
            return None
        change = self.store.begin()
        side = checked_broadcast(days)
        now = in_years(obs, [y for y, _ in folders]).join(side, ["id", "date"], "left_semi")
        carried = change.read(PARTS, keys_of(folders)).drop(*FOLDERS).join(side, ["id", "date"], "left_anti")
        parts = carried.unionByName(daily_parts(now, self.opts))
        return self._commit(change, parts, stations, countries, keys_of(folders))

    def refresh_dimensions(self, stations: DataFrame, countries: DataFrame) -> int:
        """Both facts joined anew with changed stations or countries; no observation is read."""
        change = self.store.begin()
        return self._commit(change, change.read(PARTS).drop(*FOLDERS), stations, countries, None, write_parts=False)

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once to the shared scratch folder: several jobs use it, and a lost
        executor reads it again instead of repeating its work."""
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _commit(self, change: Transaction, parts: DataFrame, stations: DataFrame, countries: DataFrame,
                keys: list[str] | None, write_parts: bool = True) -> int:
        if write_parts:  # written once, by one shuffle; both facts read what was written
            change.write(PARTS, placed(parts, self.slots), FOLDERS, ["id", "date"], keys=keys, layout="folders")
            parts = change.written(PARTS).drop(*FOLDERS)
        columns = fact_columns(self.opts)
        daily = enrich(finish_parts(parts, self.opts), stations, countries, columns)
        yearly = enrich(finish_parts(roll_up_parts(parts, year_start(self.opts)), self.opts), stations, countries, columns)
        change.write(DAILY, placed(daily, self.slots), FOLDERS, ["country_code", "id"], keys=keys, layout="folders")
        change.write(YEARLY, placed(yearly, self.slots), FOLDERS, ["country_code", "id"], keys=keys, layout="folders")
        return change.commit()

    def daily(self) -> DataFrame:
        return self.store.read(DAILY).drop("slot")

    def yearly(self) -> DataFrame:
        return self.store.read(YEARLY).drop("slot")
