"""Interval join by cells against brute force, and declared column defaults."""

import datetime as dt
import random

import pytest

from salesnet import schemas
from salesnet.operators import interval_attach
from salesnet.sources import load_star, write_star

EPOCH = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)


def disjoint(rng, longest):
    at, out = -longest, []
    for i in range(40):
        at += rng.choice([0, 1, rng.randrange(longest)])
        end = at + rng.choice([0, 1, 2, 3, rng.randrange(1, longest)])
        out.append((at, end, i))
        at = max(at, end)
    return out


@pytest.mark.parametrize("kind, longest", [("long", 9), ("long", 10**12), ("date", 9000), ("timestamp", 10**10)])
def test_interval_attach_matches_brute_force(spark, kind, longest):
    rng = random.Random(f"{kind}{longest}")
    show = {"long": lambda x: x, "date": lambda x: dt.date(2020, 1, 1) + dt.timedelta(days=x // 20),
            "timestamp": lambda x: EPOCH + dt.timedelta(microseconds=x)}[kind]
    segs = [(k, show(s), show(e), v) for k in "ab" for s, e, v in disjoint(rng, longest)]
    edges = [x for _, s, e, _ in segs for x in (s, e)]
    facts = [(i, rng.choice("abc"), rng.choice(edges)) for i in range(300)] + [(300, None, edges[0]), (301, "a", None)]
    got = interval_attach(spark.createDataFrame(facts, f"id int, k string, at {kind}"),
                          spark.createDataFrame(segs + [("a", None, edges[0], 99)], f"k string, s {kind}, e {kind}, v int"), "k", "at", "s", "e", ["v"])
    assert got.columns == ["id", "k", "at", "v"]
    want = {i: next((v for sk, s, e, v in segs if at is not None and sk == k and s <= at < e), None) for i, k, at in facts}
    rows = got.collect()
    assert len(rows) == len(facts) and {r.id: r.v for r in rows} == want and any(v is not None for v in want.values())


def test_interval_attach_without_segments(spark):
    got = interval_attach(spark.createDataFrame([(1, "a")], "at long, k string"),
                          spark.createDataFrame([], "k string, s long, e long, v int"), "k", "at", "s", "e", ["v"])
    assert [(r["at"], r.k, r.v) for r in got.collect()] == [(1, "a", None)]


def test_columns_that_a_source_lacks_get_their_declared_default(spark):
    got = schemas.conform(spark.createDataFrame([(1, "R", 1, "C", "X")], "retailer_id int, retailer_name string, distributor_id int, city string, channel_type string"),
                          schemas.RETAILERS)
    assert got.collect()[0].active_status is True and [f.dataType for f in got.schema] == [f.dataType for f in schemas.RETAILERS]
    line = spark.createDataFrame([(1, 1, 1, None, 2, 3.0, 3.0)], "order_item_id int, order_id int, product_id int, promotion_id int, quantity_units int, gross_sales_value double, net_sales_value double")
    assert schemas.conform(line, schemas.SALES_ORDER_ITEMS).collect()[0].discount_value == 0


def test_files_without_a_column_load_with_its_default(spark, sb, tmp_path):
    star = sb.sale(1, "2024-01-05", 10).build(spark)
    write_star(star, str(tmp_path))
    for name, column in [("retailers", "active_status"), ("distributors", "active_status"), ("sales_order_items", "discount_value")]:
        star.tables()[name].drop(column).write.mode("overwrite").parquet(f"{tmp_path}/{name}")
    loaded = load_star(spark, str(tmp_path))
    assert loaded.retailers.collect()[0].active_status is True and loaded.distributors.collect()[0].active_status is True
    assert loaded.sales_order_items.collect()[0].discount_value == 0
    star.retailers.selectExpr("* except (active_status)", "cast(null as boolean) as active_status").write.mode("append").parquet(f"{tmp_path}/retailers")
    assert sorted(str(r.active_status) for r in load_star(spark, str(tmp_path)).retailers.collect()) == ["None", "True"]
