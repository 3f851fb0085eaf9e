"""Building the sales fact and attaching dimensions.

Plan shape used by every job, chosen for large inputs:

1. Lines meet the orders of the window: ``order_lines`` (line grain, for
   product-level jobs) or ``order_totals`` (additive per-order totals, for
   retailer-level jobs; pre-aggregated per order before the join).  The window filter is pushed into the
   orders scan, and at scale the runtime bloom filter of the window's order
   keys trims the line scan before the one unavoidable shuffle of line rows.
2. Aggregate at the lowest grain the job needs (retailer, product, month...).
   Partial aggregation runs before the shuffle, so a hot retailer or product
   becomes one row per task instead of a skewed partition.
3. Attach dimensions to the aggregated rows (``with_geography``,
   ``with_products``).  Sums and counts roll up exactly, so re-aggregating after
   the dimension join gives the same answer as joining first.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesnet.functions.scalar import month_start
from salesnet.operators.filters import in_period
from salesnet.params import Period
from salesnet.sources.star import Star

RETAILER_COLS = ("retailer_name", "channel_type", "city")
DISTRIBUTOR_COLS = ("distributor_name", "tier")
ZONE_COLS = ("zone_name",)


def orders_in(star: Star, period: Period | None, month: bool = False) -> DataFrame:
    """Orders of the window (all orders when ``period`` is None)."""
    def build():
        orders = star.sales_orders.select("order_id", "retailer_id", "order_date")
        if period is not None:
            orders = in_period(orders, "order_date", period.start, period.end)
        if month:
            orders = orders.withColumn("sales_month", month_start(F.col("order_date")))
        return orders
    return star.memo(("orders_in", period, month), build)


def order_lines(star: Star, period: Period | None = None, month: bool = False,
                promotion_id: bool = False, promoted_only: bool = False) -> DataFrame:
    """Lines of the orders in ``period`` with order date, retailer and (optionally) month.

    ``promoted_only`` keeps promoted lines (a filter on line columns, pushed
    below the joins); ``promotion_id`` adds the id, after the order join when
    the source attaches it late.
    """
    late = promotion_id and star.promotion_ids is not None
    lines = star.items(promotion_id and not late)
    if promoted_only:
        lines = lines.filter(F.col("is_promoted"))
    out = lines.join(orders_in(star, period, month), "order_id")
    return star.promotion_ids(out) if late else out


ORDER_MEASURES = {
    "net_cents": lambda: F.sum("net_cents"),
    "lines": lambda: F.count(F.lit(1)),
    "promoted_lines": lambda: F.count_if(F.col("is_promoted")),
}
def order_totals(star: Star, period: Period | None = None, month: bool = False,
                 measures=("net_cents",)) -> DataFrame:
    """Additive line totals (``measures``) with the retailer, date and [month] of
    their order, for the orders of ``period``.  Callers only SUM the measures.

    Lines are reduced to one row per order *before* the order join.  Lines of an
    order are stored together, so the partial aggregate collapses them inside each
    scan task and the shuffle on the order key -- the biggest one of every
    retailer-grain job -- carries about one row per order instead of one per line;
    the final aggregate's partitioning is the one the join needs, so it adds no
    exchange.  Whether the orders are broadcast is left to the planner and AQE.
    """
    orders = orders_in(star, period, month)
    aggs = [ORDER_MEASURES[m]().alias(m) for m in measures]
    per_order = star.items().groupBy("order_id").agg(*aggs)
    return per_order.join(orders, "order_id")


def geography(star: Star, cols: Iterable[str]) -> DataFrame:
    """Retailer rows keyed by ``retailer_id`` with the retailer / distributor / zone columns ``cols``.

    Distributors and zones are small and are broadcast by the planner from
    their size statistics (sort-merge beyond the threshold), so building the
    chain costs one pass over the retailers.
    """
    cols = list(dict.fromkeys(cols))
    return star.memo(("geography", tuple(cols)), lambda: _geography(star, cols))


def _geography(star: Star, cols: list) -> DataFrame:
    r_cols = [c for c in cols if c in RETAILER_COLS]
    d_cols = [c for c in cols if c in DISTRIBUTOR_COLS]
    z_cols = [c for c in cols if c in ZONE_COLS]
    need_zone_id = bool(z_cols) or "zone_id" in cols
    need_dist = bool(d_cols) or need_zone_id or "distributor_id" in cols

    dims = star.retailers.select("retailer_id", *r_cols, *(["distributor_id"] if need_dist else []))
    if d_cols or need_zone_id:
        dims = dims.join(
            star.distributors.select("distributor_id", *d_cols, *(["zone_id"] if need_zone_id else [])),
            "distributor_id")
    if z_cols:
        dims = dims.join(star.zones.select("zone_id", *z_cols), "zone_id")
    return dims.select("retailer_id", *cols)


def with_geography(df: DataFrame, star: Star, cols: Iterable[str]) -> DataFrame:
    """Join ``geography(star, cols)`` onto rows keyed by ``retailer_id`` (one join)."""
    return df.join(geography(star, cols), "retailer_id")


def with_products(df: DataFrame, star: Star, cols: Iterable[str]) -> DataFrame:
    """Join product columns onto rows keyed by ``product_id``."""
    return df.join(star.products.select("product_id", *cols), "product_id")
