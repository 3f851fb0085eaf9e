"""Table work: constraint checks, loading helpers, derivations, reports."""

from __future__ import annotations

import pytest
from conftest import YEAR, D, d, rows
from pyspark.sql import functions as F

from salesnet import schemas
from salesnet.plans import reports, tables
from salesnet.sources.star import load_star, write_star


def _violations(df):
    return {(r["table_name"], r["rule"]): r["violations"] for r in df.collect()}


def test_constraints_clean_fixture_has_no_violations(spark, sb):
    sb.promotion(1, None, 5, "2025-01-01", "2025-01-31")  # NULL category passes its domain rule
    sb.sale(1, "2025-01-05", 10)
    v = _violations(tables.check_constraints(sb.build(spark)))
    assert v and all(n == 0 for n in v.values())


def test_constraints_one_bad_row_per_rule(spark, sb):
    # M26 (a representative subset): each bad row trips exactly its rule.
    sb.zone(2, "North")                                        # duplicate zone name
    sb.distributor(2, "D2", zone_id=9, tier="Z")               # orphan zone, bad tier
    sb.product(2, trade=20, cost=25, mrp=15)                   # cost >= trade, trade > mrp
    sb.promotion(1, "Toys", 80, "2025-02-01", "2025-01-01")    # domain, range, dates
    sb.sale(1, "2025-01-05", 10, qty=0)                        # quantity > 0
    sb.line(99, 5)                                             # orphan order
    v = _violations(tables.check_constraints(sb.build(spark)))
    expected = {
        ("zones", "unique_zone_name"), ("distributors", "foreign_key_zone_id"), ("distributors", "domain_tier"),
        ("products", "cost_lt_trade"), ("products", "trade_le_mrp"), ("promotions", "domain_category"),
        ("promotions", "discount_percent_range"), ("promotions", "end_after_start"),
        ("sales_order_items", "quantity_positive"), ("sales_order_items", "foreign_key_order_id"),
    }
    assert {k for k, n in v.items() if n} == expected
    assert all(v[k] == 1 for k in expected)


def test_primary_key_duplicates_are_counted(spark, sb):
    sb.sale(1, "2025-01-05", 10)
    sb.items.append(sb.items[0])
    v = _violations(tables.check_constraints(sb.build(spark), only_violated=True))
    assert v == {("sales_order_items", "primary_key_unique_order_item_id"): 1}


def test_insert_if_absent_is_idempotent(spark):
    # M27
    target = spark.createDataFrame([("North",)], "zone_name string")
    new = spark.createDataFrame([("North",), ("South",), ("South",)], "zone_name string")
    first = tables.insert_if_absent(target, new, ["zone_name"])
    assert rows(first, "zone_name") == [("South",)]
    assert tables.insert_if_absent(target.unionByName(first), new, ["zone_name"]).count() == 0


def test_insert_if_absent_keeps_one_row_per_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(2, "z"), (2, "b"), (3, None)], "k int, v string")
    out = sorted(rows(tables.insert_if_absent(target, new, ["k"]), "k", "v"))
    assert out == [(2, "b"), (3, None)]


def test_surrogate_keys_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = tables.assign_surrogate_key(df, ["k"], id_col="sk", start=101, partitions=5)
    got = sorted(rows(out, "k", "sk"))
    assert got == [(k, 101 + k) for k in range(1000)]


def test_derive_prices(spark):
    # Beverages, mrp 90.00 -> trade 72.00, cost 56.16 (ratio .78).
    p = spark.createDataFrame([(1, "Beverages", D(90))], "product_id long, category string, mrp decimal(10,2)")
    out = tables.derive_prices(p, F.lit(D("0.78")))
    assert rows(out, "trade_price", "cost_price") == [(D(72), D("56.16"))]


def test_attach_promotion_inclusive_and_keeps_every_line(spark):
    # Inclusive ends, other category untouched, best discount wins.
    promos = spark.createDataFrame(
        [(1, "P8", "Bev", D(8), d("2025-03-01"), d("2025-03-31")),
         (2, "P10", "Bev", D(10), d("2025-03-15"), d("2025-04-10")),
         (3, "Food", "Food", D(5), d("2025-01-01"), d("2025-12-31"))], schemas.PROMOTIONS)
    lines = spark.createDataFrame(
        [(i, "Bev", d(x)) for i, x in enumerate(["2025-02-28", "2025-03-01", "2025-03-15", "2025-03-31",
                                                  "2025-04-01", "2025-04-11"])] + [(9, "Toys", d("2025-03-05"))],
        "line_id int, category string, order_date date")
    out = sorted(rows(tables.attach_promotion(lines, promos), "line_id", "promotion_id"))
    assert out == [(0, None), (1, 1), (2, 2), (3, 2), (4, 2), (5, None), (9, None)]


def test_line_financials(spark):
    # Qty 7, price 72.00, 12% -> 504.00, 60.48, 443.52; no percentage -> discount 0.
    df = spark.createDataFrame([(7, D(72), D(12)), (7, D(72), None)],
                               "quantity_units int, trade_price decimal(10,2), discount_percent decimal(5,2)")
    out = rows(tables.line_financials(df), "gross_sales_value", "discount_value", "net_sales_value")
    assert out == [(D(504), D("60.48"), D("443.52")), (D(504), D(0), D(504))]


def test_allocate_targets_half_even(spark):
    # Quota 4,500 over A x2, B x3, C x4 (weights 5, 2.5, 1; sum 21.5) -> 1,047 / 523 / 209.
    dists = spark.createDataFrame([(i, 1, t) for i, t in enumerate("AABBBCCCC")], "distributor_id int, zone_id int, tier string")
    quotas = spark.createDataFrame([(1, 4500)], "zone_id int, quota long")
    out = tables.allocate_targets(dists, quotas)
    got = {r["tier"]: r["target_items"] for r in out.collect()}
    assert got == {"A": 1047, "B": 523, "C": 209}
    assert out.agg(F.sum("target_items")).first()[0] == 4499


def test_row_counts_and_coverage(spark, sb):
    sb.promotion(1, "Beverages", 5, "2025-01-01", "2025-12-31")
    sb.sale(1, "2025-01-05", 10).sale(1, "2025-01-06", 9, promotion_id=1, discount=1)
    star = sb.build(spark)
    counts = dict(rows(tables.row_counts(star), "table_name", "row_count"))
    assert counts["sales_order_items"] == 2 and counts["zones"] == 1
    assert rows(tables.promotion_coverage(star), "promoted_items", "total_items", "coverage_pct") == [(1, 2, 50.0)]


def test_coverage_of_empty_table(spark, sb):
    # M33
    assert rows(tables.promotion_coverage(sb.build(spark)), "promoted_items", "total_items", "coverage_pct") == [(0, 0, 0.0)]


def test_growth_report_labels(spark, sb):
    # Growth 0.0 is Growth, "+0.0%".
    sb.sale(1, "2025-01-02", 100).sale(1, "2025-02-02", 100).sale(1, "2025-03-02", 50)
    out = rows(reports.mom_growth_report(sb.build(spark), YEAR), "month_label", "growth_label", "growth_class")
    assert out == [("2025-02", "+0.0%", "Growth"), ("2025-03", "-50.0%", "Decline")]


def test_monthly_report_peak_and_lakh(spark, sb):
    sb.sale(1, "2025-10-02", 2660000).sale(1, "2025-11-02", 250000)
    out = rows(reports.monthly_revenue_report(sb.build(spark), YEAR), "month_label", "revenue_label", "is_peak")
    assert out == [("2025-10", "26.6L", True), ("2025-11", "2.5L", False)]


def test_star_round_trip(spark, sb, tmp_path):
    # Write the star as Parquet and load it back with the declared schemas.
    sb.promotion(1, None, 5, "2025-01-01", "2025-12-31").sale(1, "2025-01-05", 10, promotion_id=1)
    star = sb.build(spark)
    write_star(star, str(tmp_path / "star"))
    back = load_star(spark, str(tmp_path / "star"))
    for name, schema in schemas.STAR.items():
        # file sources read every column as nullable; NOT NULL is what check_constraints verifies
        got = [(f.name, f.dataType) for f in back.tables()[name].schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields]
        assert back.tables()[name].count() == star.tables()[name].count()


def test_foreign_key_violations_count_rows(spark, sb):
    sb.sale(1, "2025-01-05", 10)
    sb.line(99, 5).line(99, 6).line(98, 1)   # three orphan lines, two missing orders
    v = _violations(tables.check_constraints(sb.build(spark), only_violated=True))
    assert v == {("sales_order_items", "foreign_key_order_id"): 3}


def test_line_references_are_counted_as_rows(spark, sb):
    sb.promotion(1, "Home Care", 10, "2025-01-01", "2025-02-01")
    sb.sale(1, "2025-01-05", 10).sale(1, "2025-01-06", 10, promotion_id=1)
    sb.sale(1, "2025-01-07", 10, promotion_id=7).line(1, 5, product_id=8, promotion_id=7).line(1, 5, product_id=9)
    v = _violations(tables.check_constraints(sb.build(spark), only_violated=True))
    assert v == {("sales_order_items", "foreign_key_product_id"): 2, ("sales_order_items", "foreign_key_promotion_id"): 2}


def test_line_rules_on_empty_lines(spark, sb):
    v = _violations(tables.check_constraints(sb.build(spark)))
    assert v[("sales_order_items", "foreign_key_order_id")] == v[("sales_order_items", "foreign_key_product_id")] == 0
    assert v[("sales_order_items", "quantity_positive")] == 0


@pytest.mark.parametrize("name, most", [("check_constraints", 3)])
def test_lines_are_scanned_few_times(spark, name, most):
    from salesnet.plans.registry import all_queries
    plan = all_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert sum("l_partkey" in relation for relation in plan.split("Relation [")[1:] if relation.startswith("l_")) <= most


def test_export_csv_with_header(spark, sb, tmp_path):
    # R11 / S3
    from salesnet.sources import export_csv
    sb.sale(1, "2025-01-05", 10).sale(1, "2025-02-05", 20)
    out = str(tmp_path / "monthly")
    export_csv(reports.monthly_revenue_report(sb.build(spark), YEAR), out, single_file=True)
    import glob
    files = glob.glob(f"{out}/part-*.csv")
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    assert lines[0] == "sales_month,monthly_revenue,month_label,revenue_label,is_peak"
    assert len(lines) == 3


def test_bucketed_star_joins_lines_to_orders_without_shuffle(spark, sb, tmp_path):
    from salesnet.operators import order_totals
    from salesnet.sources import load_star_tables, write_star_tables
    for i in range(20):
        sb.sale(1, f"2025-01-{i + 1:02d}", 10 + i)
    write_star_tables(sb.build(spark), "bk_", 4, path=str(tmp_path / "wh"))
    star = load_star_tables(spark, "bk_")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = order_totals(star, YEAR)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert df.agg(F.sum("net_cents")).first()[0] == sum(1000 + 100 * i for i in range(20))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_surrogate_keys_continue_above_existing(spark):
    existing = spark.createDataFrame([(i, f"z{i}") for i in (1, 2, 5)], "zone_id long, zone_name string")
    new = spark.createDataFrame([("b",), ("a",)], "zone_name string")
    out = tables.assign_surrogate_key(new, ["zone_name"], "zone_id", tables.next_id_after(existing, "zone_id"), 2)
    assert sorted(rows(out, "zone_name", "zone_id")) == [("a", 6), ("b", 7)]
    empty = existing.limit(0)
    out = tables.assign_surrogate_key(new, ["zone_name"], "zone_id", tables.next_id_after(empty, "zone_id"), 2)
    assert sorted(rows(out, "zone_name", "zone_id")) == [("a", 1), ("b", 2)]
