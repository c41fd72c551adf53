"""Tunable thresholds and run parameters (one frozen value object)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """Thresholds used by the checks and the cohort views.

    ``as_of`` stands in for "now": operators whose output depends on the clock
    (freshness age, days a pending payment has been stale) take it from here so
    that a job is reproducible. It must be set before those operators run.
    """

    # Fixed values that must equal the reference's defaults.
    freshness_sla_hours: int = 24
    max_duplicate_rate: float = 0.05
    max_null_rate: float = 0.10
    max_failure_rate: float = 0.40
    failure_warn_fraction: float = 0.75
    min_arpu: float = 1.0
    max_months: int = 12

    as_of: dt.datetime | None = None
    # Last day of the data period; recoveries after it are void.
    period_end: dt.date | None = None

    def require_as_of(self) -> dt.datetime:
        if self.as_of is None:
            raise ValueError("Params.as_of must be set for clock-dependent operators")
        if isinstance(self.as_of, dt.datetime):
            return self.as_of
        return dt.datetime.combine(self.as_of, dt.time())

    @property
    def max_failure_pct(self) -> float:
        return self.max_failure_rate * 100

    @property
    def warn_failure_pct(self) -> float:
        return self.max_failure_pct * self.failure_warn_fraction


# Parameters the registered queries and the oracle strings agree on: the driver
# tables end on 2001-08-01, "now" is one week later.
FIXTURE_PARAMS = Params(as_of=dt.datetime(2001, 8, 8), period_end=dt.date(2001, 8, 1))
