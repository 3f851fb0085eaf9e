"""Named queries over a directory of TPC-H style tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesnet.plans import jobs, reports, tables
from salesnet.sources.tpch import TPCH_DOMAINS, cost_ratio, tpch_star

Query = Callable[[SparkSession, str], DataFrame]


_REPLACED: dict = {}


def star_for(spark: SparkSession, sf_dir: str):
    """The (lazy) star mapping of ``sf_dir``, built anew for each call so that it sees the
    files of the folder as they are now; a star set by ``use_star`` takes its place."""
    return _REPLACED.get((spark.sparkContext.applicationId, sf_dir)) or tpch_star(spark, sf_dir)


def use_star(spark: SparkSession, sf_dir: str, star) -> None:
    """Make the registered queries of ``sf_dir`` run on ``star`` (e.g. a loaded star schema)."""
    _REPLACED[(spark.sparkContext.applicationId, sf_dir)] = star


def _on_star(fn, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star_for(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def analytic_queries() -> dict[str, Query]:
    return {
        "revenue_by_zone": _on_star(jobs.revenue_by_zone),
        "top_skus_by_units": _on_star(jobs.top_skus_by_units),
        "inactive_distributors": _on_star(jobs.inactive_entities, entity="distributor"),
        "inactive_distributors_last_day": _on_star(jobs.inactive_entities, entity="distributor", days=1),
        "inactive_retailers": _on_star(jobs.inactive_entities, entity="retailer"),
        "channel_revenue_split": _on_star(jobs.channel_revenue_split),
        "weighted_margin_by_category": _on_star(jobs.weighted_margin_by_category),
        "monthly_revenue": _on_star(jobs.monthly_revenue),
        "underperforming_distributors": _on_star(jobs.underperforming_distributors),
        "units_per_retailer": _on_star(jobs.units_per_retailer),
        "promotion_performance": _on_star(jobs.promotion_performance),
        "promotion_performance_export": _on_star(jobs.promotion_performance_export),
        "sku_share_of_category": _on_star(jobs.sku_share_of_category),
        "never_promoted_retailers": _on_star(jobs.never_promoted_retailers),
        "top_distributors_per_zone": _on_star(jobs.top_distributors_per_zone),
        "rolling_3_month_avg": _on_star(jobs.rolling_3_month_avg),
        "mom_growth": _on_star(jobs.mom_growth),
        "mom_growth_export": _on_star(jobs.mom_growth_export),
        "consecutive_declines": _on_star(jobs.consecutive_declines),
        "cohort_retention": _on_star(jobs.cohort_retention_matrix),
        "declining_skus_h2": _on_star(jobs.declining_skus),
        "declining_products_h2": _on_star(jobs.declining_skus, sku_key="product_id"),
        "distributor_scorecard": _on_star(jobs.distributor_scorecard),
        "revenue_at_risk": _on_star(jobs.revenue_at_risk),
        "sku_substitution": _on_star(jobs.sku_substitution),
        "product_substitution": _on_star(jobs.product_substitution),
    }


def _repriced(star):
    """R5 with the mapping's category cost ratios."""
    return tables.repriced_products(star, cost_ratio(F.col("category")))


def table_queries() -> dict[str, Query]:
    return {
        "check_constraints": _on_star(tables.check_constraints, domains=TPCH_DOMAINS),
        "check_implied_rules": _on_star(tables.check_implied_rules),
        "row_counts": _on_star(tables.row_counts),
        "promotion_coverage": _on_star(tables.promotion_coverage),
        "orders_to_append": _on_star(tables.orders_to_append, loaded_until=dt.date(1998, 7, 1)),
        "order_sequence": _on_star(tables.order_sequence),
        "repriced_products": _on_star(_repriced),
        "promotion_attach_summary": _on_star(tables.promotion_attach_summary),
        "promotion_attach_intervals": _on_star(tables.promotion_attach_summary, by_day=False),
        "list_price_financials": _on_star(tables.list_price_financials),
        "distributor_targets": _on_star(tables.distributor_targets),
        "monthly_revenue_report": _on_star(reports.monthly_revenue_report),
        "mom_growth_report": _on_star(reports.mom_growth_report),
        "promotion_report": _on_star(reports.promotion_report),
    }


def all_queries() -> dict[str, Query]:
    return {**analytic_queries(), **table_queries()}
