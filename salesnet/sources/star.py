"""The star schema as a set of DataFrames, plus typed Parquet load and write."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesnet import schemas
from salesnet.functions.scalar import to_cents


TABLE_NAMES = ("zones", "distributors", "retailers", "products", "promotions",
               "sales_orders", "sales_order_items")


class Star:
    """The seven star tables, each a DataFrame built on first access.

    Tables are given as DataFrames or as zero-argument factories; a factory
    runs once, when a job first touches the table, so a job pays only for the
    plans of the tables it reads.  ``lean_items`` is an optional cheaper view
    of the line table without ``promotion_id`` but with ``is_promoted`` and the
    cents columns; sources whose promotion id needs a join (the TPC-H mapping)
    provide it so jobs that only ask "was this line promoted?" skip that join,
    together with ``promotion_ids`` to attach the id late.
    """

    def __init__(self, lean_items=None, promotion_ids=None, **tables):
        missing = set(TABLE_NAMES) - set(tables)
        if missing:
            raise ValueError(f"missing star tables: {sorted(missing)}")
        self._src = dict(tables, lean_items=lean_items)
        self._built: dict[str, DataFrame] = {}
        self._memo: dict = {}
        # Optional ``DataFrame -> DataFrame`` adding ``promotion_id`` to rows that
        # carry the lean line columns ``product_id``, ``discount_pct`` and
        # ``is_promoted`` (line rows, possibly filtered / joined, or rows already
        # aggregated by those columns), for sources where the id needs a join:
        # jobs attach it after their own filters, joins and partial aggregates.
        self.promotion_ids = promotion_ids

    def _get(self, name: str) -> Optional[DataFrame]:
        if name not in self._built:
            src = self._src[name]
            self._built[name] = src() if callable(src) else src
        return self._built[name]

    def __getattr__(self, name: str):
        if name.startswith("_") or name not in self._src:
            raise AttributeError(name)
        return self._get(name)

    def items(self, promotion_id: bool = False) -> DataFrame:
        """Line table with ``is_promoted`` and exact BIGINT ``*_cents`` money columns
        (``gross_cents``, ``discount_cents``, ``net_cents``) for the aggregation
        hot path; ``promotion_id`` too when asked for."""
        lean = self._get("lean_items")
        if promotion_id and lean is not None and self.promotion_ids is not None:
            return self.promotion_ids(lean)
        if promotion_id or lean is None:
            df = self.sales_order_items
            return df.select(
                "*", F.col("promotion_id").isNotNull().alias("is_promoted"),
                to_cents(F.col("gross_sales_value")).alias("gross_cents"),
                to_cents(F.col("discount_value")).alias("discount_cents"),
                to_cents(F.col("net_sales_value")).alias("net_cents"))
        return lean

    def memo(self, key, build):
        """Plan fragment ``build()`` shared by every job on this star with the same
        ``key`` (DataFrames are immutable plans, so sharing them is safe)."""
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def tables(self) -> dict[str, DataFrame]:
        return {name: self._get(name) for name in TABLE_NAMES}


def load_star(spark: SparkSession, path: str) -> Star:
    """Typed load of ``<path>/<table>`` Parquet folders with the declared schemas.

    The schema is given to the reader (no inference); a file whose column
    types differ fails at read time rather than producing silently cast data.
    A column that a file lacks reads as its declared default (``schemas.DEFAULTS``).
    """
    dfs = {name: schemas.conform(spark.read.schema(schemas.reading(schema)).parquet(f"{path}/{name}"), schema)
           for name, schema in schemas.STAR.items()}
    return Star(**dfs)


def write_star(star: Star, path: str, mode: str = "overwrite") -> None:
    """Write (or append) every table as Parquet in foreign-key order.

    Orders are clustered by date inside each output file so the Parquet
    row-group statistics let a date-window filter skip row groups; each table
    is one atomic Spark write.
    """
    for name in schemas.CREATE_ORDER:
        df = schemas.conform(star.tables()[name], schemas.STAR[name])
        if name == "sales_orders":
            df = df.sortWithinPartitions("order_date")
        df.write.mode(mode).parquet(f"{path}/{name}")


BUCKETED = ("sales_orders", "sales_order_items")


def write_star_tables(star: Star, prefix: str, buckets: int, path: str | None = None,
                      mode: str = "overwrite") -> None:
    """Save the star as catalog tables ``<prefix><table>``, orders and lines bucketed
    and sorted by ``order_id`` into ``buckets`` buckets.

    With both sides bucketed alike, the order-line join and the per-order
    aggregate of every job read co-located buckets: the largest shuffle of the
    jobs disappears for every later run.  ``path`` makes them external tables
    under ``<path>/<table>`` (shared storage on a cluster).
    """
    for name in schemas.CREATE_ORDER:
        df = schemas.conform(star.tables()[name], schemas.STAR[name])
        writer = df.write.mode(mode).format("parquet")
        if name in BUCKETED:
            writer = writer.bucketBy(buckets, "order_id").sortBy("order_id")
        if path:
            writer = writer.option("path", f"{path}/{name}")
        writer.saveAsTable(f"{prefix}{name}")


def load_star_tables(spark: SparkSession, prefix: str) -> Star:
    """The star from catalog tables written by ``write_star_tables`` (bucketing kept)."""
    return Star(**{name: schemas.conform(spark.table(f"{prefix}{name}"), schema)
                   for name, schema in schemas.STAR.items()})
