from salesnet.operators.filters import in_period
from salesnet.operators.fact import orders_in, order_lines, order_totals, geography, with_geography, with_products
from salesnet.operators.windows import (
    share_of_total, group_mean, lag_change, decline_flags, consecutive, rolling_mean,
    top_n_per_group, rank_within, latest_value,
)
from salesnet.operators.activity import without_activity, cohort_retention
from salesnet.operators.scoring import minmax_score, weighted_sum, tier_label
from salesnet.operators.ordering import cut_points, rank_by_value, with_bucket
from salesnet.operators.pairs import blocked_corr, item_vectors, pairwise_corr, pearson
from salesnet.operators.ranges import day_attach, interval_attach, resolve_overlaps, range_attach

__all__ = [
    "in_period", "orders_in", "order_lines", "order_totals", "geography", "with_geography", "with_products",
    "share_of_total", "group_mean", "lag_change", "decline_flags", "consecutive", "rolling_mean",
    "top_n_per_group", "rank_within", "latest_value", "without_activity", "cohort_retention",
    "minmax_score", "weighted_sum", "tier_label", "pairwise_corr", "pearson", "blocked_corr", "item_vectors",
    "cut_points", "rank_by_value", "with_bucket",
    "resolve_overlaps", "range_attach", "day_attach", "interval_attach",
]
