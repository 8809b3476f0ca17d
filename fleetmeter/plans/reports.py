"""Reports straight from run days and the company table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fleetmeter.functions.dates import as_date
from fleetmeter.operators import reports
from fleetmeter.operators.calendar import daily_calendar
from fleetmeter.operators.usage import usage_facts
from fleetmeter.sources.config import schedule_table, team_table


@dataclass(frozen=True)
class UsageReports:
    """All reports of one target date, built on the same facts and calendar.

    The reports are lazy. When several of them are written, give ``facts`` that
    were materialised once (see ``plans.daily``); they hold one row per company and
    day, however many runs there are.
    """

    facts: DataFrame
    calendar: DataFrame
    target: dt.date
    empty_is_zero: bool = False

    @classmethod
    def of(
        cls,
        run_days: DataFrame,
        companies: DataFrame,
        target: str | dt.date,
        open_end: bool = False,
        empty_is_zero: bool = False,
    ) -> UsageReports:
        facts = usage_facts(run_days, team_table(companies))
        calendar = daily_calendar(schedule_table(companies), target, open_end)
        return cls(facts, calendar, as_date(target), empty_is_zero)

    def hours(self, period: str = "date") -> DataFrame:
        return reports.gpu_hours(self.facts, self.calendar, period)

    def daily(self) -> DataFrame:
        return reports.report_daily(self.facts, self.calendar, self.empty_is_zero)

    def weekly(self, aligned_weeks: bool = False) -> DataFrame:
        return reports.report_weekly(
            self.facts, self.calendar, self.target, aligned_weeks, self.empty_is_zero
        )

    def monthly(self) -> DataFrame:
        return reports.report_monthly(
            self.facts, self.calendar, self.target, self.empty_is_zero
        )

    def overall(self) -> DataFrame:
        return reports.report_overall(self.facts, self.calendar, self.empty_is_zero)
