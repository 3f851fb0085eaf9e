"""Incremental idempotent load: replayed files and repeated keys append once."""

from __future__ import annotations

from conftest import d

from pyspark.sql import types as T

from salesnet import schemas
from salesnet.streaming import start_idempotent_load

ORDERS_WITH_MONTH = T.StructType(schemas.SALES_ORDERS.fields + [T.StructField("order_month", T.StringType(), False)])


def _orders(spark, rows):
    return spark.createDataFrame([(i, r, d(x), x[:7]) for i, r, x in rows], ORDERS_WITH_MONTH)


def test_stream_appends_each_key_once(spark, tmp_path):
    src, dst = str(tmp_path / "incoming"), str(tmp_path / "orders")
    ckpt = str(tmp_path / "ckpt")
    _orders(spark, [(1, 10, "2025-01-05"), (2, 11, "2025-01-06")]).write.mode("append").parquet(src)
    q = start_idempotent_load(spark, src, dst, ORDERS_WITH_MONTH, ["order_id"], "order_month", ckpt)
    q.awaitTermination()
    # second delivery repeats order 2 and adds order 3 in another month
    _orders(spark, [(2, 11, "2025-01-06"), (3, 12, "2025-02-01"), (3, 12, "2025-02-01")]).write.mode("append").parquet(src)
    q = start_idempotent_load(spark, src, dst, ORDERS_WITH_MONTH, ["order_id"], "order_month", ckpt)
    q.awaitTermination()
    got = spark.read.schema(ORDERS_WITH_MONTH).option("basePath", dst).parquet(dst)
    assert sorted(r["order_id"] for r in got.collect()) == [1, 2, 3]


def test_key_redelivered_in_another_partition(spark, tmp_path):
    src, dst, ckpt = (str(tmp_path / n) for n in ("incoming", "orders", "ckpt"))
    for day in ("2025-01-06", "2025-02-06"):
        _orders(spark, [(2, 11, day)]).write.mode("append").parquet(src)
        start_idempotent_load(spark, src, dst, ORDERS_WITH_MONTH, ["order_id"], "order_month", ckpt).awaitTermination()
    got = spark.read.schema(ORDERS_WITH_MONTH).option("basePath", dst).parquet(dst)
    assert [(r["order_id"], r["order_month"]) for r in got.collect()] == [(2, "2025-01")]


def test_default_checkpoint_resumes(spark, tmp_path):
    # Without an explicit location the checkpoint path depends only on (source, target):
    # a second start of the same load sees the first one's progress and appends nothing.
    src, dst = str(tmp_path / "in"), str(tmp_path / "out")
    _orders(spark, [(7, 1, "2025-03-01")]).write.mode("append").parquet(src)
    start_idempotent_load(spark, src, dst, ORDERS_WITH_MONTH, ["order_id"], "order_month").awaitTermination()
    start_idempotent_load(spark, src, dst, ORDERS_WITH_MONTH, ["order_id"], "order_month").awaitTermination()
    got = spark.read.schema(ORDERS_WITH_MONTH).option("basePath", dst).parquet(dst)
    assert [r["order_id"] for r in got.collect()] == [7]
