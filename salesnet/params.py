"""Job parameters shared by the analytic jobs."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Period:
    """Half-open calendar window ``start <= order_date < end``."""

    start: dt.date
    end: dt.date

    @staticmethod
    def of(start: str, end: str) -> "Period":
        return Period(dt.date.fromisoformat(start), dt.date.fromisoformat(end))

    def months(self) -> list[dt.date]:
        """First days of the calendar months that the window touches."""
        last = self.end - dt.timedelta(days=1)
        first = self.start.year * 12 + self.start.month - 1
        return [dt.date(m // 12, m % 12 + 1, 1) for m in range(first, last.year * 12 + last.month)]

    def sql(self, column: str) -> str:
        """The same window as a SQL predicate (used by the DuckDB oracle)."""
        return f"{column} >= DATE '{self.start.isoformat()}' AND {column} < DATE '{self.end.isoformat()}'"


# Default analysis window on the driver data (orders run 1995-01 .. 2001-08):
# one full calendar year, and its second half for the H2 trend job.
DEFAULT_PERIOD = Period.of("1998-01-01", "1999-01-01")
DEFAULT_H2 = Period.of("1998-07-01", "1999-01-01")
