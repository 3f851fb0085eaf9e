"""S4 by month: one month reloaded, the others' files untouched, both scans pruned."""

from __future__ import annotations

import glob
import os

import pytest

from salesnet.params import Period
from salesnet.plans import jobs
from salesnet.sources.months import load_star_months, reload_months, write_star_months
from salesnet.sources.tpch import tpch_star
from conftest import StarBuilder, YEAR, d


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/sales_order*/order_month=*/*.parquet")}


def year(sb):
    for month in (1, 2, 3):
        for day in (1, 15, 28):
            sb.sale(1, f"2025-{month:02d}-{day:02d}", 10 * month)
    return sb


def test_one_month_is_replaced_and_no_other_file(spark, sb, tmp_path):
    path = str(tmp_path / "star")
    write_star_months(year(sb).build(spark), path, files=2)
    before = files(path)
    orders = {r["order_id"] for r in load_star_months(spark, path).sales_orders.filter("month(order_date) = 2").collect()}
    new = StarBuilder()
    new.orders.append((500, 1, d("2025-02-03")))
    new.line(500, 7)
    batch = new.build(spark)
    for _ in range(2):  # a repeated call leaves the same rows
        assert [str(m) for m in reload_months(batch, path, files=2)] == ["2025-02-01"]
        star = load_star_months(spark, path)
        assert star.sales_orders.count() == star.sales_order_items.count() == 7
        assert star.sales_orders.filter("month(order_date) = 2").count() == 1 and len(orders) == 3
        after = files(path)
        assert {f: t for f, t in before.items() if "2025-02" not in f} == {f: t for f, t in after.items() if "2025-02" not in f}
        revenue = {str(r[0]): r[1] for r in jobs.monthly_revenue(star, YEAR).collect()}
        assert revenue == {"2025-01-01": 30.0, "2025-02-01": 7.0, "2025-03-01": 90.0}


def test_what_cannot_be_reloaded_is_refused_before_writing(spark, sb, tmp_path):
    path = str(tmp_path / "star")
    write_star_months(year(sb).build(spark), path)
    before = files(path)
    orphan = StarBuilder()
    orphan.sale(1, "2025-02-03", 7)
    orphan.line(99, 5)
    bare = StarBuilder()
    bare.sale(1, "2025-02-03", 7)
    bare.orders.append((777, 1, d("2025-03-02")))
    for bad in (orphan, bare):
        with pytest.raises(ValueError):
            reload_months(bad.build(spark), path)
    assert reload_months(StarBuilder().build(spark), path) == [] and files(path) == before


def test_a_line_without_order_is_kept(spark, sb, tmp_path):
    year(sb).line(99, 5)
    write_star_months(sb.build(spark), str(tmp_path / "star"))
    assert load_star_months(spark, str(tmp_path / "star")).sales_order_items.count() == 10


def test_a_window_prunes_orders_and_lines(spark, tmp_path):
    path, window = str(tmp_path / "star"), Period.of("1998-03-01", "1998-06-01")
    star = tpch_star(spark, "/root/testdata/sf0.001")
    write_star_months(star, path, files=1)
    stored = load_star_months(spark, path, window)
    for job in (jobs.revenue_by_zone, jobs.channel_revenue_split, jobs.monthly_revenue):
        assert sorted(job(stored, window).collect()) == sorted(job(star, window).collect())
    for df, count in ((stored.sales_orders, 3), (stored.sales_order_items, 3)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(order_month" in plan
        assert len({f.split("order_month=")[1][:10] for f in df.inputFiles()} & {"1998-03-01", "1998-04-01", "1998-05-01"}) == count
    assert load_star_months(spark, path).sales_order_items.count() == star.sales_order_items.count()
