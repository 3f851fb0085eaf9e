"""Absence searches and cohort retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesnet.functions.scalar import dec_round, month_diff, month_start, safe_pct


def without_activity(entities: DataFrame, active_keys: DataFrame, key: str) -> DataFrame:
    """Entities with no row in ``active_keys`` (NOT EXISTS as a left anti join).

    The anti join needs no distinct on ``active_keys``: a key seen many times
    only builds one hash entry / one sort run, and entities without any
    activity at all (no retailers, no orders) are kept.
    """
    return entities.join(active_keys.select(key), key, "left_anti")


def cohort_retention(events: DataFrame, entity: str, date: str) -> DataFrame:
    """First-activity-month cohorts and their retention at each later month.

    Output (long form, observed cells only, offset >= 1): cohort_month,
    month_offset, cohort_size, retained_count, retention_pct (rounded) and
    avg_retention_across_cohorts (mean of the rounded percentages, rounded).

    Plan: one partial-aggregated distinct of (entity, month), the cohort month
    as a MIN window per entity over those rows (at most one row per month per
    entity, so a hot entity cannot skew it), then two small aggregates keyed by
    cohort and offset.  Retained counts are plain counts because the
    (entity, month) rows are already distinct.
    """
    active = events.select(F.col(entity).alias("_e"), month_start(F.col(date)).alias("_m")).distinct()
    cohort = F.min("_m").over(Window.partitionBy("_e"))
    cells = (active.withColumn("cohort_month", cohort)
             .withColumn("month_offset", month_diff(F.col("_m"), F.col("cohort_month"))))
    sizes = (cells.filter(F.col("month_offset") == 0)
             .groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size")))
    retained = (cells.filter(F.col("month_offset") >= 1)
                .groupBy("cohort_month", "month_offset").agg(F.count(F.lit(1)).alias("retained_count")))
    pct = (retained.join(sizes, "cohort_month")
           .withColumn("retention_dec", dec_round(safe_pct(F.col("retained_count"), F.col("cohort_size")))))
    avg = pct.groupBy("month_offset").agg(dec_round(F.avg("retention_dec")).alias("avg_dec"))
    return (pct.join(avg, "month_offset")
            .select("cohort_month", "month_offset", "cohort_size", "retained_count",
                    F.col("retention_dec").cast("double").alias("retention_pct"),
                    F.col("avg_dec").cast("double").alias("avg_retention_across_cohorts")))
