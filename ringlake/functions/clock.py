"""The wall clock as an argument, so that a run can be repeated exactly."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Clock:
    """``today`` and ``now`` of a run; an unset one reads Spark's query-start time."""

    today: date | None = None
    now: datetime | None = None

    def date(self) -> Column:
        return F.current_date() if self.today is None else F.lit(self.today)

    def timestamp(self) -> Column:
        if self.now is None:
            return F.current_timestamp()
        # Through text: a Python datetime literal would shift by the driver's own zone.
        return F.lit(self.now.isoformat(sep=" ")).cast("timestamp")
