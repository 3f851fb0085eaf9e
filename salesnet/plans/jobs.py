"""The analytic jobs: one function per question, ``job(star, params) -> DataFrame``.

Each job is a thin composition of ``salesnet.operators``.  The common shape
(see ``operators.fact``): lines of the window joined to their orders,
aggregated at retailer / product grain (partial aggregation before every
shuffle), then dimensions joined to the aggregated rows and rolled up.  The
line-level sums run on exact BIGINT cents (``net_cents``...) and are turned
into DECIMAL right after that first aggregate.  Output
money and ratios are rounded half-up to 2 dp through DECIMAL(38,6) and given as
DOUBLE; sorts happen once, at the output.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesnet.functions.scalar import DEC, dec_round, from_cents, money, pct, ratio_round, safe_pct
from salesnet.operators import (
    blocked_corr, cohort_retention, consecutive, in_period, decline_flags, geography, group_mean, item_vectors, lag_change,
    latest_value, minmax_score, order_lines, order_totals, pairwise_corr, rank_by_value, rolling_mean,
    share_of_total, tier_label, top_n_per_group, weighted_sum, with_geography, with_products,
    without_activity,
)
from salesnet.operators.pairs import BLOCK_ITEMS
from salesnet.params import DEFAULT_H2, DEFAULT_PERIOD, Period
from salesnet.session import ensure_checkpoint_dir
from salesnet.sources.star import Star


# ---------------------------------------------------------------- shared rollups

def retailer_totals(star: Star, period: Period, month: bool = False, counts: bool = False) -> DataFrame:
    """Revenue (and with ``counts`` line and promoted-line counts) per retailer (and month),
    rolled up from per-order totals."""
    keys = ["retailer_id"] + (["sales_month"] if month else [])
    measures = ("net_cents", "lines", "promoted_lines") if counts else ("net_cents",)
    return (order_totals(star, period, month=month, measures=measures)
            .groupBy(*keys)
            .agg(*[F.sum(m).alias(m) for m in measures])
            .withColumn("revenue", from_cents(F.col("net_cents"))).drop("net_cents"))


def distributor_monthly(star: Star, period: Period, zone: bool = True, counts: bool = False) -> DataFrame:
    """Monthly revenue (and line / promoted-line counts) per distributor (the J13-J15, J18, J19 base)."""
    geo = ["distributor_id", "distributor_name"] + (["zone_name"] if zone else [])
    sums = [F.sum("revenue").alias("monthly_revenue")]
    if counts:
        sums += [F.sum("lines").alias("lines"), F.sum("promoted_lines").alias("promoted_lines")]
    return (with_geography(retailer_totals(star, period, month=True, counts=counts), star, geo)
            .groupBy(*geo, "sales_month").agg(*sums))


def distributor_totals(star: Star, period: Period) -> DataFrame:
    geo = ["zone_name", "distributor_id", "distributor_name"]
    return (with_geography(retailer_totals(star, period), star, geo)
            .groupBy(*geo).agg(F.sum("revenue").alias("revenue")))


def product_totals(star: Star, period: Period, month: bool = False) -> DataFrame:
    keys = ["product_id"] + (["sales_month"] if month else [])
    return (order_lines(star, period, month=month).groupBy(*keys)
            .agg(F.sum("net_cents").alias("net_cents"), F.sum("quantity_units").alias("units"))
            .withColumn("revenue", from_cents(F.col("net_cents"))).drop("net_cents"))


# ---------------------------------------------------------------- J01 .. J05

def revenue_by_zone(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Net revenue per zone, largest first."""
    return (with_geography(retailer_totals(star, period), star, ["zone_name"])
            .groupBy("zone_name").agg(money(F.sum("revenue")).alias("total_revenue"))
            .orderBy(F.desc("total_revenue")))


def top_skus_by_units(star: Star, period: Period = DEFAULT_PERIOD, n: int = 10) -> DataFrame:
    """Top ``n`` products by units (product id is the last sort key, so ties are stable)."""
    per_product = product_totals(star, period).select("product_id", F.col("units").alias("total_units_sold"))
    return (with_products(per_product, star, ["sku_name", "category", "brand"])
            .orderBy(F.desc("total_units_sold"), F.asc("product_id")).limit(n)
            .select("sku_name", "category", "brand", "total_units_sold"))


def inactive_entities(star: Star, days: int = 60, entity: str = "distributor", as_of: dt.date | None = None) -> DataFrame:
    """Entities with no order in ``(max_date - days, max_date]``; no period window.

    ``max_date`` is ``as_of``, or else the last order date, read first (one value), so
    that the window reaches the order scan as literals.  Entities without retailers or
    orders count as inactive.  ``entity`` is
    ``distributor`` (the original question) or ``retailer``.
    """
    last = as_of or star.sales_orders.agg(F.max("order_date")).first()[0] or dt.date(1970, 1, 1)
    one = dt.timedelta(days=1)
    # distinct retailer ids: a partial aggregate, so a retailer with many recent orders is one row per task
    recent = in_period(star.sales_orders, "order_date", last - (days - 1) * one, last + one).select("retailer_id").distinct()
    if entity == "retailer":
        people = geography(star, ["retailer_name", "channel_type", "distributor_name", "zone_name"])
        return (without_activity(people, recent, "retailer_id")
                .select("retailer_id", "retailer_name", "channel_type", "distributor_name", "zone_name")
                .orderBy("zone_name", "distributor_name", "retailer_name", "retailer_id"))
    active = (recent.join(star.retailers.select("retailer_id", "distributor_id"), "retailer_id")
              .select("distributor_id").distinct())
    dists = star.distributors.join(star.zones, "zone_id").select("distributor_id", "distributor_name", "zone_name", "tier")
    return without_activity(dists, active, "distributor_id").orderBy("zone_name", "tier", "distributor_name")


def channel_revenue_split(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Revenue per channel and its share of the grand total."""
    per_channel = (with_geography(retailer_totals(star, period), star, ["channel_type"])
                   .groupBy("channel_type").agg(F.sum("revenue").alias("revenue")))
    return (share_of_total(per_channel, "revenue", out="share")
            .select("channel_type", money(F.col("revenue")).alias("total_revenue"),
                    money(F.col("share")).alias("revenue_percentage"))
            .orderBy(F.desc("total_revenue")))


def weighted_margin_by_category(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """sum((trade - cost) x units) x 100 / sum(trade x units) per category (ratio of sums)."""
    units = product_totals(star, period).select("product_id", "units")
    per = with_products(units, star, ["category", "trade_price", "cost_price"])
    margin = F.sum((F.col("trade_price") - F.col("cost_price")) * F.col("units"))
    sales = F.sum(F.col("trade_price") * F.col("units"))
    return (per.groupBy("category").agg(pct(margin, sales).alias("weighted_gross_margin_percentage"))
            .orderBy(F.desc("weighted_gross_margin_percentage")))


# ---------------------------------------------------------------- J06 .. J12

def monthly_revenue_series(star: Star, period: Period) -> DataFrame:
    """Unrounded revenue per calendar month of the window (months without sales absent)."""
    return (order_totals(star, period, month=True)
            .groupBy("sales_month").agg(from_cents(F.sum("net_cents")).alias("revenue")))


def monthly_revenue(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Revenue per month."""
    return (monthly_revenue_series(star, period)
            .select("sales_month", money(F.col("revenue")).alias("monthly_revenue"))
            .orderBy("sales_month"))


def underperforming_distributors(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Distributors strictly below their zone's mean revenue.

    As in the question: revenue is rounded to 2 dp first, the zone mean is the
    unrounded mean of those rounded values.  The comparison is made without the
    quotient, revenue x distributors < zone total, so it is exact.
    """
    rev = distributor_totals(star, period).withColumn("rev_dec", dec_round(F.col("revenue")).cast("decimal(24,2)"))
    zone = Window.partitionBy("zone_name")
    with_mean = (group_mean(rev, "rev_dec", ["zone_name"], "zone_mean")
                 .withColumn("_zone_total", F.sum("rev_dec").over(zone)).withColumn("_zone_n", F.count(F.lit(1)).over(zone)))
    below = F.col("rev_dec") * F.col("_zone_n").cast("decimal(10,0)") < F.col("_zone_total")
    return (with_mean.filter(below)
            .select("zone_name", "distributor_name",
                    F.col("rev_dec").cast("double").alias("distributor_revenue"),
                    money(F.col("zone_mean")).alias("zone_avg_revenue"),
                    money(F.col("rev_dec") - F.col("zone_mean")).alias("revenue_gap"))
            .orderBy("zone_name", "revenue_gap"))


def units_per_retailer(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Units, buying retailers and units per buying retailer by zone x category.

    Lines are reduced to (retailer, product) before the product join (a hot
    product is then one row per retailer), then to (retailer, category); since a retailer belongs
    to one zone, the count of those rows per (zone, category) is the distinct
    number of retailers that bought the category.
    """
    per_product = (order_lines(star, period).groupBy("retailer_id", "product_id")
                   .agg(F.sum("quantity_units").alias("units")))
    per_retailer = (with_products(per_product, star, ["category"])
                    .groupBy("retailer_id", "category").agg(F.sum("units").alias("units")))
    out = (with_geography(per_retailer, star, ["zone_name"])
           .groupBy("zone_name", "category")
           .agg(F.sum("units").alias("total_units_sold"), F.count(F.lit(1)).alias("retailer_count")))
    return (out.withColumn("units_sold_per_retailer",
                           ratio_round(F.col("total_units_sold"), F.col("retailer_count")).cast("double"))
            .orderBy("zone_name", F.desc("units_sold_per_retailer")))


def promotion_totals(star: Star, period: Period) -> DataFrame:
    """Lines, gross, discount and net per promotion over the promoted lines of the window.

    Where the source derives the promotion id from the product (``promotion_ids``
    hook), the lines are first reduced to one row per (product, discount) so the
    product join that yields the id sees aggregated rows, not line rows.
    """
    sums = [F.count(F.lit(1)).alias("items_sold"), F.sum("gross_cents").alias("gross_cents"),
            F.sum("discount_cents").alias("discount_cents"), F.sum("net_cents").alias("net_cents")]
    if star.promotion_ids is not None:
        pre = (order_lines(star, period, promoted_only=True)
               .groupBy("product_id", "discount_pct", "is_promoted").agg(*sums))
        per = star.promotion_ids(pre).groupBy("promotion_id").agg(
            *[F.sum(c).alias(c) for c in ("items_sold", "gross_cents", "discount_cents", "net_cents")])
    else:
        per = order_lines(star, period, promotion_id=True, promoted_only=True).groupBy("promotion_id").agg(*sums)
    per = per.select("promotion_id", "items_sold",
                     from_cents(F.col("gross_cents")).alias("gross"),
                     from_cents(F.col("discount_cents")).alias("disc"),
                     from_cents(F.col("net_cents")).alias("net"))
    return per.join(star.promotions.select("promotion_id", "promotion_name", "category", "discount_percent"),
                    "promotion_id")


def promotion_performance(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Per promotion: lines, gross, discount, net and effective discount %."""
    return (promotion_totals(star, period)
            .select("promotion_name", "category",
                    F.col("discount_percent").cast("double").alias("discount_percent"),
                    "items_sold",
                    money(F.col("gross")).alias("gross_revenue"),
                    money(F.col("disc")).alias("total_discount_given"),
                    money(F.col("net")).alias("net_revenue"),
                    pct(F.col("disc"), F.col("gross")).alias("effective_discount_pct"))
            .orderBy(F.desc("net_revenue")))


def promotion_performance_export(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Export form of J09."""
    return (promotion_totals(star, period)
            .select("promotion_name", "category",
                    F.col("discount_percent").cast("double").alias("discount_percent"),
                    money(F.col("net")).alias("net_revenue"),
                    money(F.col("disc")).alias("total_discount"),
                    pct(F.col("disc"), F.col("gross")).alias("effective_discount_pct"))
            .orderBy(F.desc("net_revenue")))


def sku_share_of_category(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """SKU revenue and share of its category; SKUs with the same name are merged."""
    per_product = product_totals(star, period).select("product_id", "revenue")
    per_sku = (with_products(per_product, star, ["category", "sku_name"])
               .groupBy("category", "sku_name").agg(F.sum("revenue").alias("revenue")))
    # a category may hold any number of SKUs: its total is an aggregate joined back, not a window
    totals = per_sku.groupBy("category").agg(F.sum("revenue").alias("_total"))
    return (per_sku.join(totals, "category")
            .select("category", "sku_name", money(F.col("revenue")).alias("sku_revenue"),
                    pct(F.col("revenue"), F.col("_total")).alias("category_revenue_percentage"))
            .orderBy("category", F.desc("category_revenue_percentage")))


def never_promoted_retailers(star: Star) -> DataFrame:
    """Retailers with no promoted line ever (no window; retailers without orders included)."""
    # distinct first: the partial aggregate collapses an order's promoted lines in the scan task
    promoted_orders = star.items().filter(F.col("is_promoted")).select("order_id").distinct()
    buyers = star.sales_orders.select("order_id", "retailer_id").join(promoted_orders, "order_id", "left_semi")
    people = geography(star, ["retailer_name", "channel_type", "distributor_name", "zone_name"])
    return (without_activity(people, buyers.select("retailer_id").distinct(), "retailer_id")
            .select("retailer_id", "retailer_name", "channel_type", "distributor_name", "zone_name")
            .orderBy("zone_name", "distributor_name", "retailer_name"))


def top_distributors_per_zone(star: Star, period: Period = DEFAULT_PERIOD, n: int = 3) -> DataFrame:
    """Top ``n`` distributors per zone by RANK (ties may return more)."""
    ranked = top_n_per_group(distributor_totals(star, period), ["zone_name"], [F.desc("revenue")], n,
                             out="zone_rank")
    return (ranked.select("zone_name", "distributor_name", money(F.col("revenue")).alias("net_revenue"),
                          "zone_rank")
            .orderBy("zone_name", "zone_rank"))


# ---------------------------------------------------------------- J13 .. J17

def rolling_3_month_avg(star: Star, period: Period = DEFAULT_PERIOD, rows: int = 3) -> DataFrame:
    """Mean of this and the previous ``rows - 1`` monthly rows per distributor."""
    monthly = distributor_monthly(star, period, zone=False)
    return (rolling_mean(monthly, ["distributor_id"], "sales_month", "monthly_revenue", rows, out="rolling")
            .select("distributor_name", "sales_month", money(F.col("monthly_revenue")).alias("monthly_revenue"),
                    money(F.col("rolling")).alias("rolling_3_month_avg_revenue"))
            .orderBy("distributor_name", "sales_month"))


def _mom(star: Star, period: Period) -> DataFrame:
    return lag_change(monthly_revenue_series(star, period), [], "sales_month", "revenue",
                      prev="prev", pct="growth")


def mom_growth(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Monthly revenue, previous month's and growth % (first month kept with NULLs)."""
    return (_mom(star, period)
            .select("sales_month", money(F.col("revenue")).alias("monthly_revenue"),
                    money(F.col("prev")).alias("previous_month_revenue"),
                    money(F.col("growth")).alias("mom_growth_percentage"))
            .orderBy("sales_month"))


def mom_growth_export(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Export form of J14: first month dropped, previous month omitted."""
    return (_mom(star, period).filter(F.col("prev").isNotNull())
            .select("sales_month", money(F.col("revenue")).alias("monthly_revenue"),
                    money(F.col("growth")).alias("mom_growth_pct"))
            .orderBy("sales_month"))


def consecutive_declines(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """(distributor, month) rows where this and the previous monthly row both declined."""
    monthly = distributor_monthly(star, period, zone=False)
    flagged = decline_flags(monthly, ["distributor_id"], "sales_month", "monthly_revenue")
    return (flagged.filter(consecutive())
            .select("distributor_name", "sales_month", money(F.col("monthly_revenue")).alias("monthly_revenue"))
            .orderBy("distributor_name", "sales_month"))


def cohort_retention_matrix(star: Star) -> DataFrame:
    """First-order-month cohorts of retailers and their retention (all orders, no window)."""
    return (cohort_retention(star.sales_orders, "retailer_id", "order_date")
            .orderBy("cohort_month", "month_offset"))


def declining_skus(star: Star, period: Period = DEFAULT_H2, min_declines: int = 3,
                   sku_key: str = "sku_name") -> DataFrame:
    """SKUs with at least ``min_declines`` month-over-month declines inside the window.

    ``sku_key`` is ``product_id`` (one series per product) or ``sku_name``
    (one series per product line).  The window filter comes before LAG, so the
    first month of the window has no predecessor.
    """
    per = with_products(product_totals(star, period, month=True).select("product_id", "sales_month", "revenue"),
                        star, ["sku_name"])
    keys = ["product_id", "sku_name"] if sku_key == "product_id" else ["sku_name"]
    series = per.groupBy(*keys, "sales_month").agg(F.sum("revenue").alias("revenue"))
    lagged = lag_change(series, keys, "sales_month", "revenue", prev="prev")
    out = (lagged.groupBy(*keys)
           .agg(F.count_if(F.col("revenue") < F.col("prev")).alias("declining_month_count"),
                money(F.sum("revenue")).alias("last_6_month_revenue"))
           .filter(F.col("declining_month_count") >= min_declines))
    return (out.select("sku_name", "declining_month_count", "last_6_month_revenue")
            .orderBy(F.desc("declining_month_count"), F.desc("last_6_month_revenue"), "sku_name"))


# ---------------------------------------------------------------- J18 .. J20

def distributor_scorecard(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """Total revenue, latest month-over-month growth, promoted-line share, zone rank.

    One pass: the monthly distributor rows give both the growth series (LAG per
    distributor) and, rolled up, the totals; the latest growth is the value at
    the greatest month that has a predecessor (NULL for single-month distributors).
    """
    monthly = lag_change(distributor_monthly(star, period, counts=True), ["distributor_id"], "sales_month",
                         "monthly_revenue", prev="prev", pct="growth")
    card = monthly.groupBy("zone_name", "distributor_id", "distributor_name").agg(
        F.sum("monthly_revenue").alias("total"),
        F.sum("lines").alias("lines"),
        F.sum("promoted_lines").alias("promoted"),
        latest_value("growth", "sales_month", where=F.col("prev").isNotNull()).alias("latest_growth"))
    # one row per distributor, written once: the rank reads it three times
    ensure_checkpoint_dir(card.sparkSession)
    card = rank_by_value(card.checkpoint(), ["zone_name"], "total", out="zone_rank")
    return (card.select("zone_name", "distributor_name", money(F.col("total")).alias("total_revenue"),
                        money(F.col("latest_growth")).alias("latest_mom_growth_percentage"),
                        pct(F.col("promoted"), F.col("lines")).alias("promotion_participation_rate"),
                        "zone_rank")
            .orderBy("zone_name", "zone_rank", "distributor_name"))


# Fixed values of the risk score: signal weights, tier thresholds (on the
# unrounded composite), result size.
RISK_WEIGHTS = {"decline_score": "0.40", "gap_score": "0.35", "low_promo_score": "0.25"}
RISK_TIERS = [("Critical", "6.0"), ("Watch", "3.0")]
RISK_DEFAULT_TIER = "Stable"


def risk_signals(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """The three J19 signals per distributor (rounded as in the question).

    consecutive_decline_months: monthly rows that continue a decline (this and
    the previous row down); pct_below_zone_avg: % below the mean of the zone's
    unrounded totals, 0 when above; promo_participation_rate: promoted-line share.
    """
    flagged = decline_flags(distributor_monthly(star, period, counts=True), ["distributor_id"], "sales_month",
                            "monthly_revenue")
    totals = flagged.groupBy("distributor_id", "distributor_name", "zone_name").agg(
        F.sum("monthly_revenue").alias("total"),
        F.sum("lines").alias("lines"),
        F.sum("promoted_lines").alias("promoted"),
        F.count_if(consecutive()).alias("consecutive_decline_months"))
    totals = group_mean(totals, "total", ["zone_name"], "zone_mean")
    gap = F.greatest(DEC("0"), F.col("zone_mean") - F.col("total"))
    return totals.select(
        "distributor_id", "distributor_name", "zone_name", "total", "consecutive_decline_months",
        dec_round(safe_pct(gap, F.col("zone_mean"))).alias("pct_below_zone_avg"),
        ratio_round(F.col("promoted"), F.col("lines"), times=100).alias("promo_participation_rate"))


def score_risk(signals: DataFrame, weights: dict | None = None, tiers: list | None = None) -> DataFrame:
    """Min-max scale the signals to 0-10 (low promotion share inverted), weight them
    into ``composite`` (unrounded, used for the tier) and ``composite_risk_score``
    (rounded), and label the tier."""
    scored = minmax_score(signals, {
        "decline_score": ("consecutive_decline_months", False),
        "gap_score": ("pct_below_zone_avg", False),
        "low_promo_score": ("promo_participation_rate", True),
    })
    return (scored
            .withColumn("composite", weighted_sum(weights or RISK_WEIGHTS))
            .withColumn("composite_risk_score", money(F.col("composite")))
            .withColumn("risk_tier", tier_label(F.col("composite"), tiers or RISK_TIERS, RISK_DEFAULT_TIER)))


def revenue_at_risk(star: Star, period: Period = DEFAULT_PERIOD, n: int = 10,
                    weights: dict | None = None, tiers: list | None = None) -> DataFrame:
    """Top ``n`` distributors by a composite 0-10 risk score from three signals.

    If a signal is constant over all distributors its score, the composite and
    so the sort key are NULL; NULLs sort first (distributor name breaks ties).
    """
    scored = score_risk(risk_signals(star, period), weights, tiers)
    return (scored
            .orderBy(F.col("composite_risk_score").desc_nulls_first(), F.asc("distributor_name"))
            .limit(n)
            .select("distributor_name", "zone_name", money(F.col("total")).alias("total_revenue"),
                    "consecutive_decline_months",
                    *[F.col(c).cast("double").alias(c) for c in
                      ("pct_below_zone_avg", "promo_participation_rate", "decline_score", "gap_score",
                       "low_promo_score")],
                    "composite_risk_score", "risk_tier"))


# Fixed values of the substitution labels (applied to the unrounded r).
SUBSTITUTION_LABELS = [
    ("-0.7", "Strong substitute — high cannibalisation risk"),
    ("-0.5", "Potential substitute — monitor volume shift"),
]
NO_SUBSTITUTION = "No substitution signal"


def _substitutes(pairs: DataFrame, columns: list) -> DataFrame:
    """The substitution label of the unrounded r, and r to 3 places."""
    r = F.col("correlation")
    label = F.when(r < F.lit(float(SUBSTITUTION_LABELS[0][0])), F.lit(SUBSTITUTION_LABELS[0][1])) \
             .when(r < F.lit(float(SUBSTITUTION_LABELS[1][0])), F.lit(SUBSTITUTION_LABELS[1][1])) \
             .otherwise(F.lit(NO_SUBSTITUTION))
    return (pairs.select("category", *columns, F.round(r.cast("decimal(20,8)"), 3).cast("double").alias("correlation"),
                         label.alias("interpretation"))
            .orderBy("category", "correlation", *columns))


def sku_substitution(star: Star, period: Period = DEFAULT_PERIOD, threshold: float = -0.5, sku_key: str = "sku_name",
                     min_overlap: int = 0) -> DataFrame:
    """J20 by product line: SKU names of a category whose monthly units correlate below
    ``threshold``; with ``sku_key`` ``product_id``, ``product_substitution``.

    Pearson r over the months both SKUs sold; filter and label use the unrounded r, the
    output shows it rounded to 3 dp.  The SKUs of a category are bounded by its brands.
    ``min_overlap`` optionally requires that many shared months (off by default, as in the
    question: two shared months already give r = +-1).
    """
    if sku_key == "product_id":
        return product_substitution(star, period, threshold, min_overlap)
    per = with_products(product_totals(star, period, month=True).select("product_id", "sales_month", "units"),
                        star, ["category", "sku_name"])
    series = per.groupBy("category", "sku_name", "sales_month").agg(F.sum("units").alias("units"))
    pairs = pairwise_corr(series, "sku_name", "category", "sales_month", "units")
    pairs = pairs.withColumnRenamed("a_sku_name", "sku_a").withColumnRenamed("b_sku_name", "sku_b")
    if min_overlap:
        pairs = pairs.filter(F.col("n_shared") >= min_overlap)
    return _substitutes(pairs.filter(F.col("correlation") < F.lit(threshold)), ["sku_a", "sku_b"])


def product_substitution(star: Star, period: Period = DEFAULT_PERIOD, threshold: float = -0.5, min_overlap: int = 0,
                         block: int = BLOCK_ITEMS) -> DataFrame:
    """J20 at the question's own grain, one series per product: product pairs of a category
    whose monthly units correlate below ``threshold``.

    Each product is one row with its months as an array; a category's products
    are compared as pairs of blocks (``blocked_corr``), so no row per pair and month
    exists and a task holds two blocks of ``block`` products, whatever the category's size.
    """
    months = period.months()
    per = product_totals(star, period, month=True).select("product_id", "sales_month", "units")
    vectors = with_products(item_vectors(per, ["product_id"], "sales_month", "units", months), star, ["category", "sku_name"])
    sizes = star.products.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    pairs = blocked_corr(vectors, "product_id", "category", sizes, len(months), threshold, "sku_name", min_overlap, block)
    columns = {"a_product_id": "product_a", "b_product_id": "product_b", "a_sku_name": "sku_a", "b_sku_name": "sku_b"}
    return _substitutes(pairs.withColumnsRenamed(columns), list(columns.values()))
