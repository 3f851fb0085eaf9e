"""Ranks, keys and pairs of huge groups: brute force, hot groups and ties, and plan shape."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesnet.operators import blocked_corr, cut_points, item_vectors, pairwise_corr, rank_by_value, with_bucket
from salesnet.params import Period
from salesnet.plans import jobs, tables
from salesnet.plans.registry import all_queries, star_for
from test_plans import plan_of

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_buckets_are_ranges_of_the_order(spark, buckets):
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "b", "ü", ""]), rng.choice([None, *range(-40, 40)]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "s string, n long, i long")
    cuts = cut_points(df, ["s", "n"], buckets)
    out = with_bucket(df, ["s", "n"], cuts, "b").orderBy("s", "n").select("b").collect()
    got = [r.b for r in out]
    assert got == sorted(got) and max(got) <= len(cuts) <= buckets - 1
    assert buckets < 8 or len(set(got)) > 20


def test_bucket_lookup_is_a_binary_search_in_generated_code(spark):
    df = spark.range(50_000)
    cuts = cut_points(df, ["id"], 3000)
    assert len(cuts) > 2900
    plan = plan_of(with_bucket(df, ["id"], cuts, "b").groupBy("b").count())
    assert "ArrayFilter" not in plan and plan.count("Project [codegen id") <= 14
    sizes = with_bucket(df, ["id"], cuts, "b").groupBy("b").count().agg(F.max("count")).first()[0]
    assert sizes < 300


@pytest.mark.parametrize("buckets", [1, 5, 40])
def test_rank_with_ties_nulls_and_a_hot_group(spark, buckets):
    rng = random.Random(9)
    rows = [("hot" if i % 3 else rng.choice(["a", None, "b"]), 7 if i % 4 == 0 else rng.choice([None, rng.randrange(500)]), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long, i long")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))
    got = rank_by_value(df, ["g"], "v", out="r", buckets=buckets)
    assert sorted(map(tuple, got.select("i", "r").collect())) == sorted(map(tuple, want.select("i", "r").collect()))
    assert rank_by_value(df.limit(0), ["g"], "v").collect() == []


def test_scorecard_ranks_no_window_over_a_zone(spark):
    plan = plan_of(all_queries()["distributor_scorecard"](spark, SF))
    windows = [line for line in plan.split("\n") if line.startswith("Arguments") and "windowspecdefinition(zone_name" in line]
    assert windows and all("_bucket" in line for line in windows)
    assert "WindowGroupLimit" in plan_of(all_queries()["top_distributors_per_zone"](spark, SF))


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_blocked_pairs_equal_the_joined_ones(spark, block):
    rng = random.Random(2)
    rows = [(g, f"{g}{i}", m, rng.randrange(1, 9)) for g, n in (("big", 25), ("x", 3), ("y", 1)) for i in range(n)
            for m in range(8) if rng.random() < 0.7]
    series = spark.createDataFrame(rows, "grp string, item string, month int, units long")
    vectors = item_vectors(series, ["grp", "item"], "month", "units", list(range(8)))
    sizes = vectors.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    got = blocked_corr(vectors, "item", "grp", sizes, 8, -0.2, block=block)
    want = pairwise_corr(series, "item", "grp", "month", "units").filter("correlation < -0.2").drop("n_shared")
    assert got.columns == ["grp", "a_item", "b_item", "correlation"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 40


def test_blocked_pairs_need_exact_sums_of_large_values(spark):
    big = 2_000_000_000
    rows = [("g", i, m, big + (m if i else -m) + (m == 3)) for i in range(2) for m in range(4)]
    vectors = item_vectors(spark.createDataFrame(rows, "grp string, item int, month int, units long"), ["grp", "item"], "month",
                           "units", [0, 1, 2, 3])
    sizes = spark.createDataFrame([("g", 2)], "grp string, n long")
    x, y = ([r[3] for r in rows if r[1] == i] for i in range(2))
    num = 4 * sum(a * b for a, b in zip(x, y)) - sum(x) * sum(y)
    den = ((4 * sum(a * a for a in x) - sum(x) ** 2) * (4 * sum(a * a for a in y) - sum(y) ** 2)) ** 0.5
    assert blocked_corr(vectors, "item", "grp", sizes, 4, -0.1).first().correlation == num / den


@pytest.mark.parametrize("block,overlap", [(1, 0), (4, 0), (4, 5), (1000, 0)])
def test_blocked_pairs_of_very_large_values_meet_all_items_once(spark, block, overlap):
    rng = random.Random(7)
    scale = {i: rng.choice([9, 10 ** 5, 10 ** 9, 10 ** 15]) for i in range(24)}
    sold = {(g, i): {m: rng.randrange(scale[i]) for m in range(6) if rng.random() < 0.8} for g in "gh" for i in scale}
    rows = [(g, i, m, u) for (g, i), at in sold.items() for m, u in at.items()]
    vectors = item_vectors(spark.createDataFrame(rows, "grp string, item int, month int, units long"), ["grp", "item"], "month",
                           "units", list(range(6)))
    sizes = vectors.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    want = {}
    for g in "gh":
        for i in scale:
            for j in range(i + 1, len(scale)):
                at = sorted(sold[g, i].keys() & sold[g, j].keys())
                x, y = [sold[g, i][m] for m in at], [sold[g, j][m] for m in at]
                xx, yy, xy = (len(at) * sum(p * q for p, q in zip(v, w)) - sum(v) * sum(w) for v, w in ((x, x), (y, y), (x, y)))
                if xx and yy and len(at) >= overlap and xy / (xx * yy) ** 0.5 < -0.2:
                    want[g, i, j] = xy / (xx * yy) ** 0.5
    got = {tuple(r)[:3]: r.correlation for r in blocked_corr(vectors, "item", "grp", sizes, 6, -0.2, min_overlap=overlap, block=block)
           .collect()}
    found = blocked_corr(vectors, "item", "grp", sizes, 6, -0.2, min_overlap=overlap, block=block).count()
    assert len(want) > 50 and got.keys() == want.keys() and found == len(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


@pytest.mark.parametrize("end,overlap", [("1997-01-01", 0), ("1997-11-01", 0), ("1997-11-01", 3)])
def test_product_pairs_are_compared_in_compiled_code(spark, end, overlap):
    # HotSpot compiles no method of 8000 bytes or more: a pair then takes 40 times as long
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        pairs = jobs.product_substitution(star_for(spark, SF), Period.of("1996-01-01", end), min_overlap=overlap)
        debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
        stages = debug.codegenStringSeq(pairs._jdf.queryExecution().executedPlan())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = []
    for i in range(stages.size()):
        plan = stages.apply(i)._1().strip().split("\n")
        own = [line for line in plan if plan[0].split(" ")[0] + " " in line]
        if any("SortMergeJoin" in line and "_low" in line for line in own):
            sizes.append(stages.apply(i)._3().maxMethodCodeSize())
            assert any("Filter" in line and "correlation" in line for line in own)
    assert len(sizes) == 1 and 1000 < sizes[0] < 8000, sizes


def test_product_pairs_make_no_row_per_month(spark):
    star = star_for(spark, SF)
    plan = plan_of(jobs.product_substitution(star))
    joins = [line for line in plan.split("\n") if line.startswith(("Left keys", "Right keys")) and "_low" in line]
    assert joins and all("sales_month" not in line for line in joins)
    whole = sorted(map(tuple, jobs.product_substitution(star).collect()))
    assert len(whole) > 100 and whole == sorted(map(tuple, jobs.product_substitution(star, block=4).collect()))


def test_implied_rules_meet_products_after_aggregation(spark):
    plan = plan_of(tables.check_implied_rules(star_for(spark, SF)))
    tree = plan[:plan.index("\n\n(1)")].split("\n")
    depth = {name: [i for i, line in enumerate(tree) if name in line] for name in ("HashAggregate", "part", "lineitem")}
    scans = [line for line in tree if "Scan parquet" in line]
    assert len(scans) >= 3 and depth["HashAggregate"]
    first_aggregate = [line for line in plan.split("\n") if line.startswith("Keys [4]: [product_id")]
    assert first_aggregate


def test_append_with_missing_keys_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (None, "b", 2.0)], "k long, j string, v double")
    new = spark.createDataFrame([(1, "a", 5.0), (None, "b", 6.0), (None, None, 7.0), (None, None, 6.5), (2, None, 8.0)], target.schema)
    added = tables.insert_if_absent(target, new, ["k", "j"])
    assert sorted(map(tuple, added.collect()), key=str) == sorted([(None, None, 6.5), (2, None, 8.0)], key=str)
    assert tables.insert_if_absent(target.union(added), new, ["k", "j"]).count() == 0


def test_append_reads_a_bucketed_target_without_a_shuffle(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    rows.write.bucketBy(4, "k").sortBy("k").option("path", str(tmp_path / "t")).mode("overwrite").saveAsTable("append_target")
    try:
        target = spark.table("append_target")
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        new = spark.range(1990, 2010).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("v"))
        added = tables.insert_if_absent(target, new, ["k"])
        plan = plan_of(added)
        assert sorted(r.k for r in added.collect()) == list(range(2000, 2010))
        tree = plan[:plan.index("\n\n(1)")]
        assert tree.count("Exchange") == 1 and "append_target" in tree  # the new rows alone
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE append_target")
