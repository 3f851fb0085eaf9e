"""Orders and lines stored by calendar month: a month is reloaded by itself (S4), and a window
of months prunes the scans of both tables.

The month of a line is its order's.  The layout is the one of ``write_star``, with one folder
``order_month=YYYY-MM-DD`` (first day) per month under the two fact tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesnet import schemas
from salesnet.functions.scalar import month_start
from salesnet.params import Period
from salesnet.sources.star import Star

MONTH = "order_month"
MONTHLY = ("sales_orders", "sales_order_items")


def _by_month(star: Star) -> dict[str, DataFrame]:
    """Orders and lines with their month (NULL for a line without order, or an order without date)."""
    orders = schemas.conform(star.sales_orders, schemas.STAR["sales_orders"]).withColumn(MONTH, month_start(F.col("order_date")))
    lines = schemas.conform(star.sales_order_items, schemas.STAR["sales_order_items"])
    month = orders.groupBy("order_id").agg(F.min(MONTH).alias(MONTH))  # a repeated order repeats no line
    return {"sales_orders": orders, "sales_order_items": lines.join(month, "order_id", "left")}


def _write(df: DataFrame, path: str, name: str, files: int, partitions: str) -> None:
    """One write, at most ``files`` files a month: a month with a third of all rows is ``files`` tasks."""
    columns = [f.name for f in schemas.STAR[name].fields]
    sort = [MONTH, "order_date" if name == "sales_orders" else "order_id"]
    (df.repartition(MONTH, F.pmod(F.xxhash64("order_id"), F.lit(files))).sortWithinPartitions(*sort).select(*columns, MONTH)
     .write.mode("overwrite").option("partitionOverwriteMode", partitions).partitionBy(MONTH).parquet(f"{path}/{name}"))


def write_star_months(star: Star, path: str, files: int = 8) -> None:
    """The whole star at ``path``, replacing what is there.  Rows without a month are kept, in a folder of their own."""
    monthly = _by_month(star)
    for name in schemas.CREATE_ORDER:
        if name in MONTHLY:
            _write(monthly[name], path, name, files, "static")
        else:
            schemas.conform(star.tables()[name], schemas.STAR[name]).write.mode("overwrite").parquet(f"{path}/{name}")


def reload_months(star: Star, path: str, files: int = 8) -> list[dt.date]:
    """Replaces, in both fact tables at ``path``, the months that the orders of ``star`` fall into
    with its rows, and returns them.  No file of another month is touched, and a repeated call
    leaves the same rows.  Dimensions are not written.

    Raises ``ValueError`` before anything is written if a line has no order in ``star``, an order
    has no date, or a month has orders but no line (its old lines would stay).  A star without
    orders and lines changes nothing.
    """
    monthly = _by_month(star)
    found = {name: {r[0] for r in monthly[name].select(MONTH).distinct().collect()} for name in MONTHLY}  # one row a month
    if None in found["sales_orders"] or None in found["sales_order_items"]:
        raise ValueError("orders without date or lines without order cannot be reloaded by month")
    if found["sales_orders"] != found["sales_order_items"]:
        raise ValueError(f"months without lines: {sorted(found['sales_orders'] - found['sales_order_items'])}")
    if found["sales_orders"]:
        for name in MONTHLY:
            _write(monthly[name], path, name, files, "dynamic")
    return sorted(found["sales_orders"])


def load_star_months(spark: SparkSession, path: str, period: Period | None = None) -> Star:
    """The star at ``path``.  With ``period`` only the months it touches are read, of orders and of
    lines (the line table itself has no date to prune by); without, every row."""
    def fact(name: str) -> DataFrame:
        schema = schemas.reading(schemas.STAR[name])
        df = spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.DateType())])).parquet(f"{path}/{name}")
        if period:
            df = df.filter((F.col(MONTH) >= F.lit(period.start.replace(day=1))) & (F.col(MONTH) < F.lit(period.end)))
        return schemas.conform(df, schemas.STAR[name])

    tables = {name: (lambda name=name: fact(name)) if name in MONTHLY else
              (lambda name=name: schemas.conform(spark.read.schema(schemas.reading(schemas.STAR[name])).parquet(f"{path}/{name}"),
                                                 schemas.STAR[name])) for name in schemas.STAR}
    return Star(**tables)
