"""Serving tables that follow silver round by round."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators import marts
from meterlake.operators.trailing import moved, shown, summed, window_days
from meterlake.plans.serving import MONTH, TABLES, ServingStore
from meterlake.sources.zones import (
    among,
    read_mark,
    read_zone,
    slot_paths,
    write_mark,
    write_snapshot,
    write_switched,
)
from meterlake.streaming.marts import changed_days

DAILY = "org_daily_usage_by_service"
TRAILING = "org_service_cost_14d"
GENAI = "genai_tokens_by_org_date"
ANOMALIES = "cost_anomaly_by_org_date"
LIVE_TABLES = (DAILY, TRAILING, GENAI, ANOMALIES)

_KEYS, _SUMS, _LARGEST = ["org_id", "service"], ["cost_usd"], ["org_name"]
_STAGED, _ROUND, _OF_ROUND = "_staged", "_round", "_of_round"
_NONE = "none"


@dataclass(frozen=True)
class LiveMarts:
    """The usage tables of a store, kept up from the days of silver that changed.

    `state` is a folder for what a round needs beside the tables. The daily table is kept
    up always, since the others come from it; `tables` names those that are wanted.
    """

    store: ServingStore
    state: str
    tables: Sequence[str] = LIVE_TABLES
    genai_service: str = marts.GENAI_SERVICE
    days: int = marts.COST_WINDOW_DAYS

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def refresh(
        self, silver: DataFrame, since: dt.datetime | None = None
    ) -> list[dt.date | None]:
        """Bring the tables up to date with the days of `silver` that have files written
        at or after `since`, and return these days.

        Days are recomputed as a whole, so refreshing one again, or two rounds that
        overlap, count nothing twice. The daily rows of the changed days, as they are now
        and, for the trailing cost, as they were, are written below `state` before any
        table is touched, and a round that was cut off is finished by the next from these.
        The trailing cost is moved by their difference and by the days that enter and leave
        its window; no other day is read for it, unless a round before was made without it.
        """
        self._finish()
        days = changed_days(silver, since)
        if days:
            self._stage(silver.where(among("event_date", days)), days)
            self._finish()
        return days

    def _at(self, name: str) -> str:
        return f"{self.state.rstrip('/')}/{name}"

    def _daily(self) -> DataFrame | None:
        """The daily table, with the types of its organisations; None before any load."""
        if slot_paths(self.spark, self.store.base(DAILY))[0] is None:
            return None
        return self.store.table(DAILY)

    def _stage(self, changed: DataFrame, days: list[dt.date | None]) -> None:
        number = int(read_mark(self.spark, self.state, _ROUND) or 0) + 1
        rows = self.store.laid_out(DAILY, marts.daily_usage_of_stored(changed))
        # as the grouping leaves them: sizes of files matter in the tables alone
        rows.write.mode("overwrite").parquet(self._at("new"))
        if TRAILING in self.tables:
            daily = self._daily()
            before = rows.drop(*TABLES[DAILY].partitions).limit(0) if daily is None else daily
            before = before.where(among("event_date", days))
            before.write.mode("overwrite").parquet(self._at("old"))
            write_mark(self.spark, self._at("old"), _OF_ROUND, str(number))
        if ANOMALIES in self.tables:
            write_snapshot(marts.anomaly_by_day(changed), self._at("anomalies"))
        # the last thing: from here on the round can be finished without silver
        told = ",".join(_NONE if d is None else d.isoformat() for d in days)
        write_mark(self.spark, self.state, _STAGED, f"{number}:{told}")

    def _finish(self) -> None:
        """Carry a staged round on to the tables, if it is not there yet. Every step can
        be repeated; the mark of the round is set when all are done.
        """
        staged = read_mark(self.spark, self.state, _STAGED)
        if staged is None:
            return
        number, told = staged.split(":")
        if int(read_mark(self.spark, self.state, _ROUND) or 0) >= int(number):
            return
        days = [None if d == _NONE else dt.date.fromisoformat(d) for d in told.split(",")]
        months = {d and d.replace(day=1) for d in days}
        in_days = among("event_date", days) & among(MONTH, months)
        new = read_zone(self.spark, self._at("new"))
        self.store.load(DAILY, new, replaces=in_days, stored_at=self._at("new"))
        if GENAI in self.tables:
            tokens = marts.genai_from_daily(new, self.genai_service)
            self.store.load(GENAI, tokens, replaces=in_days)
        if ANOMALIES in self.tables:
            found = read_zone(self.spark, self._at("anomalies"))
            self.store.load(ANOMALIES, found, replaces=in_days)
        if TRAILING in self.tables:
            self._move_trailing(new, days, number)
            totals = read_zone(self.spark, self._totals())
            cost = shown("cost_usd").alias("total_cost_usd")
            self.store.load(TRAILING, totals.select(*_KEYS, cost, *_LARGEST))
        write_mark(self.spark, self.state, _ROUND, number)

    # -- trailing cost ------------------------------------------------------------------

    def _totals(self) -> str | None:
        return slot_paths(self.spark, self._at("trailing"))[0]

    def _move_trailing(
        self, new: DataFrame, days: list[dt.date | None], number: str
    ) -> None:
        """Totals of the window up to the newest day, from those of the last round; from
        nothing, if they are of an earlier one, or the rows as they were are not known.
        """
        base, current = self._at("trailing"), self._totals()
        # round and newest day that the totals stand for
        known = current and read_mark(self.spark, current, "_as_of")
        done, ended = known.split(":") if known else ("0", _NONE)
        if done == number:
            return
        daily = self._daily()
        newest = daily.agg(F.max("event_date")).first()[0]
        window = window_days(newest, self.days)
        held = window_days(None if ended == _NONE else dt.date.fromisoformat(ended), self.days)
        inside = daily.where(among("event_date", window))
        known_old = read_mark(self.spark, self._at("old"), _OF_ROUND) == number
        if not held or int(done) + 1 != int(number) or not known_old:
            totals = summed(inside, _KEYS, _SUMS, _LARGEST)
        else:
            old = read_zone(self.spark, self._at("old"))
            changed = {d for d in days if d is not None}
            columns = ["event_date", *_KEYS, *_SUMS, *_LARGEST]

            def of(rows: DataFrame, wanted: set[dt.date]) -> DataFrame:
                return rows.where(among("event_date", wanted)).select(columns)

            removed = of(old, changed & held).unionByName(of(daily, held - window - changed))
            added = of(new, changed & window).unionByName(of(daily, window - held - changed))
            before = read_zone(self.spark, current)
            totals = moved(before, removed, added, inside, _KEYS, _SUMS, _LARGEST)
        write_switched(totals, base, mark=("_as_of", f"{number}:{newest or _NONE}"))
