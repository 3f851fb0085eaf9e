"""Row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_period(df: DataFrame, col: str, start: dt.date, end: dt.date) -> DataFrame:
    """Half-open window ``start <= col < end`` on a DATE column.

    The predicate is written on the bare column with literal bounds, so the
    optimizer unwraps the source cast and pushes it into the Parquet scan
    (``PushedFilters`` on the raw timestamp) instead of filtering after the read.
    """
    c = F.col(col)
    return df.filter((c >= F.lit(start)) & (c < F.lit(end)))
