"""Analytic jobs on hand-computed micro-fixtures (one edge case each)."""

from __future__ import annotations

from conftest import YEAR, D, d, rows

from salesnet.plans import jobs


def test_half_open_window(spark, sb):
    # M1: only the two dates inside [2025-01-01, 2026-01-01) count.
    for day, v in [("2024-12-31", 1), ("2025-01-01", 10), ("2025-12-31", 20), ("2026-01-01", 300)]:
        sb.sale(1, day, v)
    out = rows(jobs.monthly_revenue(sb.build(spark), YEAR), "sales_month", "monthly_revenue")
    assert out == [(d("2025-01-01"), 10.0), (d("2025-12-01"), 20.0)]


def test_revenue_by_zone_sorted(spark, sb):
    sb.zone(2, "South").distributor(2, "D2", 2).retailer(2, 2)
    sb.sale(1, "2025-02-01", 100).sale(2, "2025-02-01", 250.55).sale(2, "2025-03-01", 0.45)
    out = rows(jobs.revenue_by_zone(sb.build(spark), YEAR), "zone_name", "total_revenue")
    assert out == [("South", 251.0), ("North", 100.0)]


def test_top_skus_ties_break_on_product_id(spark, sb):
    sb.product(2, "SKU1").product(3, "SKU3")
    sb.sale(1, "2025-01-05", 1, product_id=3, qty=5).sale(1, "2025-01-05", 1, product_id=2, qty=5)
    sb.sale(1, "2025-01-05", 1, product_id=1, qty=2)
    out = rows(jobs.top_skus_by_units(sb.build(spark), YEAR, n=2), "sku_name", "total_units_sold")
    assert out == [("SKU1", 5), ("SKU3", 5)]  # product 2 (named SKU1) before product 3


def test_inactive_distributors_window_is_left_open(spark, sb):
    # M2: max date 2025-12-31, 60 days -> (2025-11-01, 2025-12-31]; d3 has no retailers.
    sb.distributor(2, "D2").distributor(3, "D3").retailer(2, 2)
    sb.sale(1, "2025-11-01", 5).sale(2, "2025-11-02", 5).sale(2, "2025-12-31", 5)
    out = rows(jobs.inactive_entities(sb.build(spark), 60), "distributor_id")
    assert sorted(out) == [(1,), (3,)]


def test_channel_split(spark, sb):
    # M3
    sb.retailer(2, channel="Wholesale")
    sb.sale(1, "2025-05-01", 75).sale(2, "2025-05-01", 25)
    out = rows(jobs.channel_revenue_split(sb.build(spark), YEAR), "channel_type", "total_revenue", "revenue_percentage")
    assert out == [("General Trade", 75.0, 75.0), ("Wholesale", 25.0, 25.0)]


def test_weighted_margin_is_ratio_of_sums(spark, sb):
    # M4: (10-8)*1 + (20-10)*3 = 32 over 10*1 + 20*3 = 70 -> 45.71
    sb.product(2, trade=20, cost=10)
    sb.sale(1, "2025-01-01", 1, product_id=1, qty=1).sale(1, "2025-01-01", 1, product_id=2, qty=3)
    out = rows(jobs.weighted_margin_by_category(sb.build(spark), YEAR), "weighted_gross_margin_percentage")
    assert out == [(45.71,)]


def test_underperformers_strictly_below_zone_mean(spark, sb):
    # M5: zone North 100, 200, 200 (mean 166.67); South 50, 50 (nobody below).
    sb.distributor(2, "D2").distributor(3, "D3").zone(2, "South").distributor(4, "D4", 2).distributor(5, "D5", 2)
    for rid in (2, 3, 4, 5):
        sb.retailer(rid, rid)
    for rid, v in [(1, 100), (2, 200), (3, 200), (4, 50), (5, 50)]:
        sb.sale(rid, "2025-04-01", v)
    out = rows(jobs.underperforming_distributors(sb.build(spark), YEAR),
               "distributor_name", "distributor_revenue", "zone_avg_revenue", "revenue_gap")
    assert out == [("D1", 100.0, 166.67, -66.67)]


def test_units_per_buying_retailer(spark, sb):
    # M6: 3 retailers in the zone, two buy the category.
    sb.retailer(2).retailer(3)
    sb.sale(1, "2025-01-01", 1, qty=10).sale(2, "2025-01-01", 1, qty=5)
    out = rows(jobs.units_per_retailer(sb.build(spark), YEAR),
               "category", "total_units_sold", "retailer_count", "units_sold_per_retailer")
    assert out == [("Beverages", 15, 2, 7.5)]


def test_promotion_performance(spark, sb):
    # M7: unpromoted line is dropped by the inner join.
    sb.promotion(1, "Beverages", 10, "2025-01-01", "2025-12-31")
    sb.sale(1, "2025-02-01", 90, promotion_id=1, gross=100, discount=10)
    sb.sale(1, "2025-02-01", 280, promotion_id=1, gross=300, discount=20)
    sb.sale(1, "2025-02-01", 500)
    out = rows(jobs.promotion_performance(sb.build(spark), YEAR),
               "items_sold", "gross_revenue", "total_discount_given", "net_revenue", "effective_discount_pct")
    assert out == [(2, 400.0, 30.0, 370.0, 7.5)]
    exp = jobs.promotion_performance_export(sb.build(spark), YEAR)
    assert exp.columns == ["promotion_name", "category", "discount_percent", "net_revenue", "total_discount",
                           "effective_discount_pct"]


def test_sku_share_merges_same_names(spark, sb):
    # M8
    sb.product(2, "SKU1").product(3, "OTHER")
    sb.sale(1, "2025-01-01", 30, product_id=1).sale(1, "2025-01-01", 20, product_id=2)
    sb.sale(1, "2025-01-01", 50, product_id=3)
    out = rows(jobs.sku_share_of_category(sb.build(spark), YEAR), "sku_name", "sku_revenue",
               "category_revenue_percentage")
    assert sorted(out) == [("OTHER", 50.0, 50.0), ("SKU1", 50.0, 50.0)]


def test_never_promoted_retailers(spark, sb):
    # M9: r1 only unpromoted lines, r2 one promoted line, r3 no orders.
    sb.retailer(2).retailer(3).promotion(1, "Beverages", 5, "2020-01-01", "2030-01-01")
    sb.sale(1, "2024-01-01", 5).sale(2, "2019-01-01", 5, promotion_id=1, discount=1)
    out = rows(jobs.never_promoted_retailers(sb.build(spark)), "retailer_id")
    assert sorted(out) == [(1,), (3,)]


def test_top3_keeps_rank_ties(spark, sb):
    # 50, 40, 30, 30, 20 -> ranks 1, 2, 3, 3.
    for i, v in enumerate([50, 40, 30, 30, 20], start=2):
        sb.distributor(i, f"D{i}").retailer(i, i).sale(i, "2025-06-01", v)
    out = rows(jobs.top_distributors_per_zone(sb.build(spark), YEAR), "net_revenue", "zone_rank")
    assert out == [(50.0, 1), (40.0, 2), (30.0, 3), (30.0, 3)]


def test_rolling_mean_uses_rows_not_months(spark, sb):
    # No March; April averages Jan, Feb, Apr.
    for m, v in [("01", 10), ("02", 20), ("04", 60), ("05", 30)]:
        sb.sale(1, f"2025-{m}-10", v)
    out = rows(jobs.rolling_3_month_avg(sb.build(spark), YEAR), "rolling_3_month_avg_revenue")
    assert out == [(10.0,), (15.0,), (30.0,), (36.67,)]


def test_mom_growth_guards_zero(spark, sb):
    # Jan 100, Feb 0, Mar 50.
    sb.sale(1, "2025-01-02", 100).sale(1, "2025-02-02", 0).sale(1, "2025-03-02", 50)
    star = sb.build(spark)
    out = rows(jobs.mom_growth(star, YEAR), "monthly_revenue", "previous_month_revenue", "mom_growth_percentage")
    assert out == [(100.0, None, None), (0.0, 100.0, -100.0), (50.0, 0.0, None)]
    exp = rows(jobs.mom_growth_export(star, YEAR), "sales_month", "mom_growth_pct")
    assert exp == [(d("2025-02-01"), -100.0), (d("2025-03-01"), None)]


def test_consecutive_declines(spark, sb):
    # 100, 90, 80, 85, 70, 60 -> months 3 and 6.
    for m, v in zip(range(1, 7), [100, 90, 80, 85, 70, 60]):
        sb.sale(1, f"2025-{m:02d}-03", v)
    out = rows(jobs.consecutive_declines(sb.build(spark), YEAR), "sales_month")
    assert out == [(d("2025-03-01"),), (d("2025-06-01"),)]


def test_cohort_retention(spark, sb):
    # r1 Jan+Mar, r2 Jan, r3 Feb+Mar.
    sb.retailer(2).retailer(3)
    sb.sale(1, "2025-01-05", 1).sale(1, "2025-03-05", 1).sale(2, "2025-01-09", 1)
    sb.sale(3, "2025-02-01", 1).sale(3, "2025-03-20", 1)
    out = rows(jobs.cohort_retention_matrix(sb.build(spark)), "cohort_month", "month_offset", "cohort_size",
               "retained_count", "retention_pct", "avg_retention_across_cohorts")
    assert out == [(d("2025-01-01"), 2, 2, 1, 50.0, 50.0), (d("2025-02-01"), 1, 1, 1, 100.0, 100.0)]


def test_cohort_offset_crosses_year(spark, sb):
    # M16
    sb.sale(1, "2024-11-30", 1).sale(1, "2025-02-01", 1)
    out = rows(jobs.cohort_retention_matrix(sb.build(spark)), "month_offset")
    assert out == [(3,)]


def test_declining_skus_h2(spark, sb):
    # June higher than July is outside the window; second SKU has two declines.
    h2 = YEAR.__class__.of("2025-07-01", "2026-01-01")
    sb.product(2, "SKU2")
    sb.sale(1, "2025-06-15", 999, product_id=1)
    for m, v in zip(range(7, 13), [60, 50, 55, 40, 45, 30]):
        sb.sale(1, f"2025-{m:02d}-15", v, product_id=1)
    for m, v in zip(range(7, 13), [10, 9, 8, 9, 10, 11]):
        sb.sale(1, f"2025-{m:02d}-15", v, product_id=2)
    out = rows(jobs.declining_skus(sb.build(spark), h2, sku_key="product_id"),
               "sku_name", "declining_month_count", "last_6_month_revenue")
    assert out == [("SKU1", 3, 280.0)]


def test_scorecard_single_month_keeps_null_growth(spark, sb):
    # M19
    sb.distributor(2, "D2").retailer(2, 2)
    sb.sale(1, "2025-01-10", 100).sale(1, "2025-02-10", 150, promotion_id=None)
    sb.sale(2, "2025-03-10", 80)
    out = rows(jobs.distributor_scorecard(sb.build(spark), YEAR), "distributor_name", "total_revenue",
               "latest_mom_growth_percentage", "promotion_participation_rate", "zone_rank")
    assert out == [("D1", 250.0, 50.0, 0.0, 1), ("D2", 80.0, None, 0.0, 2)]


def test_risk_scores_and_tiers(spark):
    # Signals (declines, gap, promo) A (0, 0, 30), B (2, 25, 20), C (4, 50, 10).
    sig = spark.createDataFrame(
        [("A", 0, D(0), D(30)), ("B", 2, D(25), D(20)), ("C", 4, D(50), D(10))],
        "distributor_name string, consecutive_decline_months long, pct_below_zone_avg decimal(38,2), "
        "promo_participation_rate decimal(38,2)")
    out = rows(jobs.score_risk(sig).orderBy("distributor_name"), "distributor_name", "composite_risk_score", "risk_tier")
    assert out == [("A", 0.0, "Stable"), ("B", 5.0, "Watch"), ("C", 10.0, "Critical")]


def test_risk_tier_uses_unrounded_composite(spark):
    # 9.99 x .40 + 4.00 x .35 + 2.40 x .25 = 5.996 -> shown 6.00, tier Watch.
    from pyspark.sql import functions as F
    from salesnet.operators import tier_label, weighted_sum
    df = spark.createDataFrame([(D(9.99), D(4.00), D(2.40))],
                               "decline_score decimal(38,2), gap_score decimal(38,2), low_promo_score decimal(38,2)")
    w = weighted_sum(jobs.RISK_WEIGHTS)
    r = df.select(F.round(w, 2).cast("double").alias("c"), tier_label(w, jobs.RISK_TIERS, "Stable").alias("t")).first()
    assert (r["c"], r["t"]) == (6.0, "Watch")


def test_risk_constant_signal_gives_null_scores(spark, sb):
    # Nobody declines twice in a row -> decline score NULL for all, composite NULL, Stable, no error.
    sb.distributor(2, "D2").retailer(2, 2)
    for m, v in [(1, 10), (2, 20), (3, 30)]:
        sb.sale(1, f"2025-{m:02d}-01", v).sale(2, f"2025-{m:02d}-01", v * 2)
    out = rows(jobs.revenue_at_risk(sb.build(spark), YEAR), "decline_score", "composite_risk_score", "risk_tier")
    assert out == [(None, None, "Stable"), (None, None, "Stable")]


def _units_star(sb, series):
    """One product per series; monthly units as given (None = no sale that month)."""
    for pid, units in enumerate(series, start=1):
        if pid > 1:
            sb.product(pid, f"S{pid}")
        for m, u in enumerate(units, start=1):
            if u is not None:
                sb.sale(1, f"2025-{m:02d}-05", 1, product_id=pid, qty=u)
    return sb


def test_substitution_perfect_negative(spark, sb):
    # M23
    star = _units_star(sb, [[1, 2, 3], [3, 2, 1]]).build(spark)
    out = rows(jobs.sku_substitution(star, YEAR, sku_key="product_id"), "sku_a", "sku_b", "correlation", "interpretation")
    assert out == [("SKU1", "S2", -1.0, jobs.SUBSTITUTION_LABELS[0][1])]


def test_substitution_degenerate_pairs_vanish(spark, sb):
    # A constant series and a pair sharing one month give no row and no error.
    star = _units_star(sb, [[5, 5, 5], [1, 2, 3], [None, None, 7]]).build(spark)
    assert jobs.sku_substitution(star, YEAR, sku_key="product_id").count() == 0


def test_substitution_filter_uses_unrounded_r(spark):
    # r = -0.5002 is kept (and shown as -0.5); the pairwise aggregate is checked directly.
    from salesnet.operators import pairwise_corr
    import math
    xs = [1.0, 2.0, 3.0, 4.0]
    target = -0.5002
    # y = target * zx + sqrt(1 - target^2) * w, with w orthogonal to x (both standardised)
    zx = [(x - 2.5) / math.sqrt(1.25) for x in xs]
    w = [1.0, -1.0, -1.0, 1.0]
    ys = [target * a + math.sqrt(1 - target ** 2) * b for a, b in zip(zx, w)]
    series = spark.createDataFrame(
        [("c", "a", m, x) for m, x in enumerate(xs)] + [("c", "b", m, y) for m, y in enumerate(ys)],
        "category string, sku string, month int, units double")
    r = pairwise_corr(series, "sku", "category", "month", "units").first()["correlation"]
    assert abs(r - target) < 1e-9 and r < -0.5 and round(r, 3) == -0.5


def test_substitution_min_overlap(spark, sb):
    star = _units_star(sb, [[1, 2, 3, None], [3, 2, 1, 5]]).build(spark)
    assert jobs.sku_substitution(star, YEAR, sku_key="product_id").count() == 1
    assert jobs.sku_substitution(star, YEAR, sku_key="product_id", min_overlap=4).count() == 0
