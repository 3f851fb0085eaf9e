"""Min-max scaling and weighted composite scores."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesnet.functions.scalar import DEC, dec_round, safe_div


def minmax_score(df: DataFrame, specs: Mapping[str, tuple[str, bool]], scale: int = 10) -> DataFrame:
    """Add one score column per ``specs[out] = (source column, invert)``.

    score = ROUND((x - min) * scale / NULLIF(max - min, 0), 2), or (max - x)
    when inverted; min and max are over all rows of ``df``.  A constant column
    has no spread and scores NULL.

    The bounds are one aggregate row (partial MIN/MAX in every task) read as a scalar
    subquery, so no task sees all entities; the shuffles below ``df`` are shared by
    both branches.
    """
    out = df
    bounds = df.agg(F.struct(*[f(src).alias(f"{k}_{name}") for name, (src, _) in specs.items()
                               for k, f in (("lo", F.min), ("hi", F.max))]).alias("b")).scalar()
    for name, (src, invert) in specs.items():
        lo, hi = bounds[f"lo_{name}"], bounds[f"hi_{name}"]
        num = (hi - F.col(src)) if invert else (F.col(src) - lo)
        out = out.withColumn(name, dec_round(safe_div(num * DEC(f"{scale}.0"), hi - lo)))
    return out


def weighted_sum(weights: Mapping[str, str]) -> Column:
    """Sum of ``column * weight`` with exact decimal weights (NULL if any part is NULL)."""
    expr = None
    for col, w in weights.items():
        term = F.col(col) * DEC(w)
        expr = term if expr is None else expr + term
    return expr


def tier_label(score: Column, thresholds: Sequence[tuple[str, str]], default: str) -> Column:
    """First label whose threshold ``score >= t`` holds, else ``default`` (NULL score -> default)."""
    expr = None
    for label, t in thresholds:
        cond = score >= DEC(t)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))
