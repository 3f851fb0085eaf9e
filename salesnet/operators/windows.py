"""Ordered and grouped analytics over already aggregated rows.

Every window here runs on rows that were aggregated first (entity x month,
entity, channel, month), never on line-level rows.  Partitioned windows hold at
most one row per month of an entity.  Unpartitioned windows (grand totals,
global LAG, min-max bounds) are only applied to rows with one row per value of
a bounded domain: a month of the window, a channel, a distributor.  Their size
does not grow with the number of orders or lines, and they cost one pass, where
a scalar subquery would re-run the whole line-level plan that feeds them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesnet.functions.scalar import safe_pct


def _w(keys: Sequence[str], order: str):
    return Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)


def share_of_total(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "share_pct") -> DataFrame:
    """``value * 100 / SUM(value) over the group`` (grand total when ``by`` is empty).

    ``df`` must already be aggregated to one row per member of a bounded
    domain (channels, SKUs of a category); see the module note.
    """
    total = F.sum(value).over(Window.partitionBy(*by))
    return df.withColumn(out, safe_pct(F.col(value), total))


def group_mean(df: DataFrame, value: str, by: Sequence[str], out: str) -> DataFrame:
    """Attach the mean of ``value`` over the rows sharing ``by``.

    ``df`` has one row per entity of a dimension (e.g. distributors of a
    zone), so this is an AVG window partitioned by ``by`` -- one exchange,
    where an aggregate joined back would need a second one and a join.
    """
    return df.withColumn(out, F.avg(value).over(Window.partitionBy(*by)))


def lag_change(df: DataFrame, keys: Sequence[str], order: str, value: str,
               prev: str = "previous_value", pct: str | None = None) -> DataFrame:
    """Previous row's ``value`` per key (``LAG``) and optionally the % change."""
    out = df.withColumn(prev, F.lag(value).over(_w(keys, order)))
    if pct:
        out = out.withColumn(pct, safe_pct(F.col(value) - F.col(prev), F.col(prev)))
    return out


def decline_flags(df: DataFrame, keys: Sequence[str], order: str, value: str,
                  flag: str = "declined", prev_flag: str = "prev_declined") -> DataFrame:
    """1 when ``value`` is below the previous row's, else 0 (first row 0); plus the previous flag."""
    w = _w(keys, order)
    out = df.withColumn(flag, F.when(F.col(value) < F.lag(value).over(w), 1).otherwise(0))
    return out.withColumn(prev_flag, F.lag(flag).over(w))


def consecutive(flag: str = "declined", prev_flag: str = "prev_declined") -> Column:
    """Row condition: this and the previous row are both flagged."""
    return (F.col(flag) == 1) & (F.col(prev_flag) == 1)


def rolling_mean(df: DataFrame, keys: Sequence[str], order: str, value: str,
                 rows: int = 3, out: str = "rolling_mean") -> DataFrame:
    """Mean of this row and the ``rows - 1`` previous rows (ROWS frame, not calendar)."""
    w = _w(keys, order).rowsBetween(-(rows - 1), Window.currentRow)
    return df.withColumn(out, F.avg(value).over(w))


def top_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int,
                    out: str = "rank", method: str = "rank") -> DataFrame:
    """Rows ranked ``<= n`` within each group (RANK keeps ties, so may return more).

    The filter on the rank lets the optimizer insert a WindowGroupLimit before
    and after the shuffle, so only candidate rows move.
    """
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, fn().over(w)).filter(F.col(out) <= n)


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.rank().over(Window.partitionBy(*by).orderBy(*order)))


def latest_value(value: str, order: str, where: Column | None = None) -> Column:
    """Aggregate: ``value`` on the row with the greatest ``order`` (optionally among rows
    satisfying ``where``); NULL when no row qualifies.  The DISTINCT ON / argmax
    pattern as one grouped aggregate, no sort of the group."""
    key = F.col(order) if where is None else F.when(where, F.col(order))
    return F.max_by(F.col(value), key)
