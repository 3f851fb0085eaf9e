"""Invariants of the job outputs on the driver data (SURVEY section 5 (c))."""

from __future__ import annotations

import os
from collections import defaultdict

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
Q = E.queries()


def rows(spark, name):
    return [r.asDict() for r in Q[name](spark, SF).collect()]


def test_shares_sum_to_100(spark):
    ch = rows(spark, "channel_revenue_split")
    assert abs(sum(r["revenue_percentage"] for r in ch) - 100) <= 0.005 * len(ch)
    per_cat = defaultdict(list)
    for r in rows(spark, "sku_share_of_category"):
        per_cat[r["category"]].append(r["category_revenue_percentage"])
    for cat, shares in per_cat.items():
        assert abs(sum(shares) - 100) <= 0.005 * len(shares), cat


def test_ranks_start_at_one(spark):
    for name in ("top_distributors_per_zone", "distributor_scorecard"):
        per_zone = defaultdict(list)
        for r in rows(spark, name):
            per_zone[r["zone_name"]].append(r["zone_rank"])
        assert all(min(v) == 1 for v in per_zone.values()), name
        if name == "top_distributors_per_zone":
            assert all(max(v) <= 3 for v in per_zone.values())


def test_retention_and_scores_in_range(spark):
    for r in rows(spark, "cohort_retention"):
        assert 0 < r["retention_pct"] <= 100 and 0 < r["avg_retention_across_cohorts"] <= 100
        assert r["retained_count"] <= r["cohort_size"] and r["month_offset"] >= 1
    risk = rows(spark, "revenue_at_risk")
    assert len(risk) == 10
    for r in risk:
        for c in ("decline_score", "gap_score", "low_promo_score", "composite_risk_score"):
            assert r[c] is None or 0 <= r[c] <= 10, (c, r[c])
        assert r["risk_tier"] in ("Critical", "Watch", "Stable")


def test_underperformer_gaps_negative_and_growth_consistent(spark):
    under = rows(spark, "underperforming_distributors")
    assert under and all(r["revenue_gap"] < 0 and r["distributor_revenue"] < r["zone_avg_revenue"] for r in under)
    mom = rows(spark, "mom_growth")
    assert mom[0]["previous_month_revenue"] is None and mom[0]["mom_growth_percentage"] is None
    assert all(a["monthly_revenue"] == b["previous_month_revenue"] for a, b in zip(mom, mom[1:]))


def test_totals_agree_across_jobs(spark):
    # the same window's revenue, summed three ways (zones, channels, months), agrees to the cent
    zones = sum(r["total_revenue"] for r in rows(spark, "revenue_by_zone"))
    channels = sum(r["total_revenue"] for r in rows(spark, "channel_revenue_split"))
    months = sum(r["monthly_revenue"] for r in rows(spark, "monthly_revenue"))
    assert abs(zones - channels) < 0.05 and abs(zones - months) < 0.1
