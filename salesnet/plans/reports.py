"""Report series behind the published charts: labelled monthly revenue, growth
and promotion results (R12-R14), plus their CSV export (R11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesnet.functions.scalar import DEC, growth_class, lakh_label, money, month_label, signed_pct_label
from salesnet.params import DEFAULT_PERIOD, Period
from salesnet.plans import jobs
from salesnet.sources.sinks import export_csv
from salesnet.sources.star import Star


def monthly_revenue_report(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """J06 with a ``YYYY-MM`` label, the revenue in lakh and a flag on the peak month
    (one row per month, so the peak is a MAX over a bounded series)."""
    base = jobs.monthly_revenue(star, period)
    return (base.withColumn("month_label", month_label(F.col("sales_month")))
            .withColumn("revenue_label", lakh_label(F.col("monthly_revenue")))
            .withColumn("is_peak", F.col("monthly_revenue") == F.max("monthly_revenue").over(Window.partitionBy()))
            .orderBy("sales_month"))


def mom_growth_report(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """J14b with a month label, a signed growth label and a Growth/Decline class (0 is Growth)."""
    base = jobs.mom_growth_export(star, period)
    return (base.withColumn("month_label", month_label(F.col("sales_month")))
            .withColumn("growth_label", signed_pct_label(F.col("mom_growth_pct")))
            .withColumn("growth_class", growth_class(F.col("mom_growth_pct")))
            .orderBy("sales_month"))


def promotion_report(star: Star, period: Period = DEFAULT_PERIOD) -> DataFrame:
    """J09b with the net revenue in lakh."""
    base = jobs.promotion_performance_export(star, period)
    return (base.withColumn("net_revenue_lakh", money(F.col("net_revenue").cast("decimal(38,2)") / DEC("100000")))
            .orderBy(F.desc("net_revenue")))


def export_reports(star: Star, out_dir: str, period: Period = DEFAULT_PERIOD) -> None:
    """Write the three report series as headed CSV folders (one small file each)."""
    export_csv(monthly_revenue_report(star, period), f"{out_dir}/monthly_revenue", single_file=True)
    export_csv(promotion_report(star, period), f"{out_dir}/promotion_performance", single_file=True)
    export_csv(mom_growth_report(star, period), f"{out_dir}/mom_growth", single_file=True)
