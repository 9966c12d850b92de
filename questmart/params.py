"""Run parameters of the marts. They reach the plans as literals, never as replaced text."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    start_date: dt.date = dt.date(2024, 12, 31)
    end_date: dt.date = dt.date(2025, 3, 31)
    ab_start: dt.date = dt.date(2025, 3, 3)
    ab_end: dt.date = dt.date(2025, 4, 14)
    control_version: str = "1.0.0.a"
    test_version: str = "1.0.0.b"

    def __post_init__(self) -> None:
        if self.start_date > self.end_date or self.ab_start > self.ab_end:
            raise ValueError("start must not lie after end")
        if self.control_version == self.test_version:
            raise ValueError("control and test versions must differ")

    @property
    def churn_cutoff(self) -> dt.datetime:
        """Last second of end_date in UTC+3, written in UTC."""
        return dt.datetime.combine(self.end_date, dt.time(20, 59, 59))
