"""The health check of the published tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from fleetmeter.functions.dates import as_date
from fleetmeter.operators.quality import health_checks, health_message
from fleetmeter.sources.config import schedule_spans
from fleetmeter.sources.tables import record_alerts


def check_health(
    companies: DataFrame, registry: DataFrame, target: str | dt.date, latest: str = "latest"
) -> DataFrame:
    """The alert to send for ``target``, as one row."""
    return health_message(health_checks(schedule_spans(companies), registry, target, latest))


def record_health(
    companies: DataFrame,
    registry: DataFrame,
    target: str | dt.date,
    path: str,
    latest: str = "latest",
) -> None:
    alert = check_health(companies, registry, target, latest)
    record_alerts(alert, "record_health", as_date(target), path)
