"""Reusable operators on small frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from salesnet.operators import (
    latest_value, rolling_mean, share_of_total, top_n_per_group, resolve_overlaps, lag_change,
)


def test_top_n_methods(spark):
    df = spark.createDataFrame([("z", 50), ("z", 40), ("z", 40), ("z", 30)], "g string, v int")
    def ranks(method):
        return sorted(r["r"] for r in top_n_per_group(df, ["g"], [F.desc("v")], 2, out="r", method=method).collect())
    assert ranks("rank") == [1, 2, 2]
    assert ranks("dense_rank") == [1, 2, 2]
    assert ranks("row_number") == [1, 2]


def test_latest_value_with_condition(spark):
    df = spark.createDataFrame([("a", 1, None, 10.0), ("a", 2, 5.0, None), ("a", 3, None, 7.0), ("b", 1, None, 1.0)],
                               "k string, m int, prev double, g double")
    out = {r["k"]: r["x"] for r in df.groupBy("k").agg(
        latest_value("g", "m", where=F.col("prev").isNotNull()).alias("x")).collect()}
    # a: the latest month with a previous value is 2, whose growth is NULL; b has none
    assert out == {"a": None, "b": None}
    out2 = {r["k"]: r["x"] for r in df.groupBy("k").agg(latest_value("g", "m").alias("x")).collect()}
    assert out2 == {"a": 7.0, "b": 1.0}


def test_share_of_total_grouped(spark):
    df = spark.createDataFrame([("c1", Decimal("30.00")), ("c1", Decimal("10.00")), ("c2", Decimal("5.00"))],
                               "cat string, v decimal(12,2)")
    got = sorted((r["cat"], float(r["s"])) for r in share_of_total(df, "v", ["cat"], out="s").collect())
    assert got == [("c1", 25.0), ("c1", 75.0), ("c2", 100.0)]


def test_rolling_and_lag_per_key(spark):
    df = spark.createDataFrame([("a", 1, 3.0), ("a", 2, 6.0), ("a", 3, 9.0), ("a", 4, 0.0), ("b", 1, 1.0)],
                               "k string, t int, v double")
    r = {(x["k"], x["t"]): x["rm"] for x in rolling_mean(df, ["k"], "t", "v", rows=2, out="rm").collect()}
    assert r == {("a", 1): 3.0, ("a", 2): 4.5, ("a", 3): 7.5, ("a", 4): 4.5, ("b", 1): 1.0}
    g = {(x["k"], x["t"]): (x["p"], x["pct"]) for x in lag_change(df, ["k"], "t", "v", prev="p", pct="pct").collect()}
    assert g[("a", 2)][0] == 3.0 and float(g[("a", 2)][1]) == 100.0
    assert g[("a", 1)] == (None, None) and g[("b", 1)] == (None, None)


def test_resolve_overlaps_segments(spark):
    d = dt.date
    promos = spark.createDataFrame(
        [("x", 1, 5, d(2025, 1, 1), d(2025, 1, 10)), ("x", 2, 9, d(2025, 1, 5), d(2025, 1, 6))],
        "cat string, id int, pct int, s date, e date")
    segs = sorted((r["seg_start"], r["seg_end"], r["id"]) for r in resolve_overlaps(
        promos, "cat", "s", "e", [F.desc("pct"), F.asc("id")], ["id"]).collect())
    assert segs == [(d(2025, 1, 1), d(2025, 1, 4), 1), (d(2025, 1, 5), d(2025, 1, 6), 2), (d(2025, 1, 7), d(2025, 1, 10), 1)]


def test_ratios_are_rounded_once(spark):
    # just under a tie, a tie, a negative tie, one third, a zero and a NULL denominator
    from salesnet.functions import pct, ratio_round
    pairs = [(49999996, 10**10), (50000000, 10**10), (-50000000, 10**10), (1, 3), (7, 0), (7, None), (10**17 + 5, 10**3)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [(None if r[0] is None else str(r[0]), r[1]) for r in
           df.select(ratio_round(F.col("a"), F.col("b")), pct(F.col("a").cast("decimal(20,0)"), F.col("b"))).collect()]
    assert [g[0] for g in got] == ["0.00", "0.01", "-0.01", "0.33", None, None, "100000000000000.01"]
    assert [g[1] for g in got][:4] == [0.5, 0.5, -0.5, 33.33]
