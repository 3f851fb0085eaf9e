"""Cases that once went wrong at scale: payload columns beside surrogate keys, categories
outside the cost list, files added between calls, pruned windows, cluster sessions."""

from __future__ import annotations

import shutil

import pytest

from pyspark.sql import functions as F

from salesnet.plans import jobs, tables
from salesnet.plans.registry import all_queries
from salesnet.session import get_session
from salesnet.sources.tpch import tpch_star

SF = "/root/testdata/sf0.001"
LARGE = "/root/testdata/sf0.1"


def test_surrogate_keys_with_a_payload(spark):
    orders = tpch_star(spark, LARGE).sales_orders.repartition(7, "retailer_id")
    rows = tables.assign_surrogate_key(orders, ["order_date", "order_id"], "sk", partitions=9).toPandas()
    assert len(rows) >= 150_000 and sorted(rows["sk"]) == list(range(1, len(rows) + 1))
    ordered = rows.sort_values("sk")
    assert ordered[["order_date", "order_id"]].apply(tuple, axis=1).is_monotonic_increasing


@pytest.fixture()
def folder(tmp_path):
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        (tmp_path / f"{t}.parquet").mkdir()
        shutil.copy(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet" / "a.parquet")
    return tmp_path


def test_unlisted_category_keeps_its_promoted_lines(spark, folder):
    part = spark.read.parquet(f"{SF}/part.parquet")
    part = part.withColumn("p_type", F.when(F.col("p_partkey") % 4 == 0, "BULK").otherwise(F.col("p_type")))
    part.write.parquet(str(folder / "other" / "part.parquet"))
    for t in ("region", "nation", "customer", "orders", "lineitem"):
        (folder / "other" / f"{t}.parquet").symlink_to(folder / f"{t}.parquet")
    star = tpch_star(spark, str(folder / "other"))
    sold = sum(r["items_sold"] for r in jobs.promotion_performance(star, None).collect())
    assert sold == tables.promotion_coverage(star).first()["promoted_items"]
    with pytest.raises(Exception, match="no cost ratio for category BULK"):
        jobs.weighted_margin_by_category(star, None).collect()


def test_added_file_is_seen_by_the_next_call(spark, folder):
    def count():
        return {r[0]: r[1] for r in all_queries()["row_counts"](spark, str(folder)).collect()}["sales_orders"]
    first = count()
    shutil.copy(f"{SF}/orders.parquet", folder / "orders.parquet" / "b.parquet")
    assert count() == 2 * first


def test_inactive_window_reaches_the_scan(spark):
    plan = jobs.inactive_entities(tpch_star(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_inactive_entities_of_an_empty_table(spark):
    star = tpch_star(spark, SF)
    star._src["sales_orders"] = lambda: spark.createDataFrame([], "order_id long, retailer_id long, order_date date")
    assert jobs.inactive_entities(star).count() == 25


def test_session_needs_no_checkpoint_folder():
    import inspect
    assert "ensure_checkpoint_dir(spark)" not in inspect.getsource(get_session)
