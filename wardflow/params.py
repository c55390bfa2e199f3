"""Run parameters: the clock and the thresholds the models share."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Params:
    """`as_of` pins "now"; left out, the session clock is used."""

    as_of: datetime | None = None
    lookback_days: int = 30
    los_short_stay: int = 7
    los_long_stay: int = 60
    scd_valid_to: str = "9999-12-31"
    fiscal_start_month: int = 7
    # How many days behind the newest row seen others may still arrive, for incremental loads.
    late_days: int = 0

    def now(self) -> Column:
        if self.as_of is None:
            return F.expr("localtimestamp()")
        return F.lit(self.as_of.isoformat(sep=" ")).cast("timestamp_ntz")

    def today(self) -> Column:
        return F.to_date(self.now())
