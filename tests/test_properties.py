"""Operators against brute-force Python on random small inputs (hypothesis)."""

from __future__ import annotations

import datetime as dt
import math
from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesnet import schemas
from salesnet.operators import cohort_retention, pairwise_corr
from salesnet.plans import tables

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
BASE = dt.date(2025, 1, 1)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 40), st.integers(0, 20), st.integers(1, 15)),
                min_size=0, max_size=8),
       st.lists(st.tuples(st.integers(0, 3), st.integers(0, 70)), min_size=1, max_size=25))
def test_attach_promotion_matches_brute_force(spark, promos, lines):
    cats = ["a", "b", "c", "d"]
    prows = [(i + 1, f"p{i}", cats[c], Decimal(pct).quantize(Decimal("0.01")), BASE + dt.timedelta(days=s),
              BASE + dt.timedelta(days=s + ln)) for i, (c, s, pct, ln) in enumerate(promos)]
    lrows = [(i, cats[c], BASE + dt.timedelta(days=day)) for i, (c, day) in enumerate(lines)]
    pdf = spark.createDataFrame(prows, schemas.PROMOTIONS)
    ldf = spark.createDataFrame(lrows, "line_id int, category string, order_date date")
    got = {r["line_id"]: r["promotion_id"] for r in tables.attach_promotion(ldf, pdf).collect()}
    want = {}
    for lid, cat, day in lrows:
        valid = [p for p in prows if p[2] == cat and p[4] <= day <= p[5]]
        valid.sort(key=lambda p: (-p[3], p[0]))
        want[lid] = valid[0][0] if valid else None
    assert got == want


@SETTINGS
@given(st.dictionaries(st.sampled_from(["a", "b", "c", "d"]),
                       st.dictionaries(st.integers(0, 6), st.integers(0, 9), min_size=0, max_size=7),
                       min_size=2, max_size=4))
def test_pairwise_corr_matches_brute_force(spark, series):
    rows = [("g", item, t, float(v)) for item, pts in series.items() for t, v in pts.items()]
    if not rows:
        return
    df = spark.createDataFrame(rows, "grp string, item string, t int, v double")
    got = {(r["a_item"], r["b_item"]): r["correlation"] for r in pairwise_corr(df, "item", "grp", "t", "v").collect()}
    want = {}
    items = sorted(series)
    for i, a in enumerate(items):
        for b in items[i + 1:]:
            shared = sorted(set(series[a]) & set(series[b]))
            if not shared:
                continue
            xs = [series[a][t] for t in shared]
            ys = [series[b][t] for t in shared]
            n = len(xs)
            mx, my = sum(xs) / n, sum(ys) / n
            cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / n
            sx = math.sqrt(sum((x - mx) ** 2 for x in xs) / n)
            sy = math.sqrt(sum((y - my) ** 2 for y in ys) / n)
            want[(a, b)] = None if sx * sy == 0 else cov / (sx * sy)
    assert set(got) == set(want)
    for k, w in want.items():
        g = got[k]
        assert (g is None and w is None) or (g is not None and w is not None and abs(g - w) < 1e-9), (k, g, w)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(0, 500)), min_size=1, max_size=40))
def test_cohort_retention_matches_brute_force(spark, events):
    rows = [(e, BASE + dt.timedelta(days=day)) for e, day in events]
    df = spark.createDataFrame(rows, "entity int, day date")
    got = {(r["cohort_month"], r["month_offset"]): (r["cohort_size"], r["retained_count"], r["retention_pct"])
           for r in cohort_retention(df, "entity", "day").collect()}
    months = defaultdict(set)
    for e, day in rows:
        months[e].add((day.year, day.month))
    first = {e: min(ms) for e, ms in months.items()}
    size = defaultdict(int)
    for e, f in first.items():
        size[f] += 1
    kept = defaultdict(set)
    for e, ms in months.items():
        fy, fm = first[e]
        for y, m in ms:
            off = (y - fy) * 12 + m - fm
            if off >= 1:
                kept[(first[e], off)].add(e)
    want = {}
    for (f, off), es in kept.items():
        pct = (Decimal(len(es)) * 100 / Decimal(size[f])).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
        want[(dt.date(f[0], f[1], 1), off)] = (size[f], len(es), float(pct))
    assert got == want


@SETTINGS
@given(st.lists(st.integers(0, 10_000), min_size=0, max_size=60, unique=True), st.integers(1, 7), st.integers(0, 50))
def test_surrogate_keys_dense_in_order(spark, keys, parts, start):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = sorted((r["k"], r["sk"]) for r in tables.assign_surrogate_key(df, ["k"], "sk", start, parts).collect())
    assert got == [(k, start + i) for i, k in enumerate(sorted(keys))]
