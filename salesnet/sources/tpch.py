"""Mapping of TPC-H style tables onto the star schema.

    zones             <- region      (r_regionkey, r_name)
    distributors      <- nation      (tier from the nation key, see TIER_RULE)
    retailers         <- customer    (distributor = c_nationkey, channel = c_mktsegment)
    products          <- part        (category = p_type, brand = p_brand,
                                      sku_name = "<p_type>/<p_brand>", a product line)
    promotions        <- part types x promotion discount tiers (category-scoped)
    sales_orders      <- orders      (order_date = o_orderdate as DATE)
    sales_order_items <- lineitem    (gross = l_extendedprice, discount = gross x l_discount
                                      rounded half up to the cent, net = gross - discount,
                                      promoted when l_discount >= 8%)

Every table is a projection of one scan, so Catalyst prunes columns and pushes
filters (a window on ``order_date`` reaches the ``o_orderdate`` Parquet scan).
The only join in the mapping is line -> part for the promotion id, and it is
only planned when a job asks for the promotion id (``Star.items(True)``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesnet import schemas
from salesnet.functions.scalar import DEC, from_cents
from salesnet.sources.star import Star

# ---- Fixed values of the mapping --------------------------------------------
# Cost-to-trade price ratio per product category (p_type); the
# code used in promotion ids is the category's place among the parts' categories by name.
CATEGORY_COST_RATIO = [
    ("ECONOMY", "0.78"),
    ("STANDARD", "0.76"),
    ("MEDIUM", "0.74"),
    ("SMALL", "0.72"),
    ("LARGE", "0.70"),
    ("PROMO", "0.66"),
]
# Trade price is 80% of MRP, so MRP = trade / 0.80.
TRADE_TO_MRP = "0.80"
# Distributor tier from n_nationkey % 5: 0 -> A, 1 or 2 -> B, 3 or 4 -> C.
TIER_RULE = {0: "A", 1: "B", 2: "B", 3: "C", 4: "C"}
# A line is on promotion when its discount is one of these percentages.
PROMOTION_TIERS = [8, 9, 10]
# Campaign of each tier: from and to, in hundredths of the order history; a category's
# campaigns start CAMPAIGN_SHIFT days later than those of the category before it.
# Campaigns overlap, and days at both ends have none.
CAMPAIGN_SPAN = {8: (0, 55), 9: (45, 80), 10: (15, 35)}
CAMPAIGN_SHIFT = 30
# Market segments of the customer table (the mapping's channel domain).
MARKET_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
# -----------------------------------------------------------------------------

# Declared input schemas: reading with a schema skips the footer-sampling
# schema-inference job per table (one Spark job each, and a full listing of
# footers on a large table).
SOURCE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}
TABLES = list(SOURCE_SCHEMAS)

# Value domains of the mapped star, for constraint validation.
TPCH_DOMAINS = {
    "tier": sorted(set(TIER_RULE.values())),
    "channel_type": MARKET_SEGMENTS,
    "category": [k for k, _ in CATEGORY_COST_RATIO],
}


def _case(col: Column, mapping) -> Column:
    expr = None
    for key, value in mapping:
        expr = F.when(col == key, value) if expr is None else expr.when(col == key, value)
    return expr


def cost_ratio(category: Column) -> Column:
    """Ratio of the category; a category without one is an error (NULL stays NULL)."""
    known = _case(category, [(k, DEC(v)) for k, v in CATEGORY_COST_RATIO])
    unknown = F.raise_error(F.concat(F.lit("no cost ratio for category "), category)).cast("decimal(3,2)")
    return known.when(category.isNotNull(), unknown)


def category_codes(part: DataFrame) -> DataFrame:
    """(category, category_code): the categories that the parts have, numbered by name."""
    cats = part.select(F.col("p_type").alias("category")).filter(F.col("p_type").isNotNull()).distinct()
    return cats.withColumn("category_code", F.row_number().over(Window.orderBy("category")))


def tier_of(nationkey: Column) -> Column:
    return _case(nationkey % 5, sorted(TIER_RULE.items()))


def promotion_id(code: Column, pct: Column) -> Column:
    """Category-scoped promotion id: category code x 100 + percent (e.g. 108)."""
    return (code * 100 + pct).cast("long")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def tpch_star(spark: SparkSession, sf_dir: str) -> Star:
    """Build the star tables as lazy projections over ``<sf_dir>/<table>.parquet``.

    Each table is a factory run on first access, so a job plans only what it reads.
    """
    src = {name: _read(spark, sf_dir, name) for name in TABLES}
    region, nation, customer = src["region"], src["nation"], src["customer"]
    part, orders, lineitem = src["part"], src["orders"], src["lineitem"]

    def zones():
        return region.select(F.col("r_regionkey").cast("long").alias("zone_id"),
                             F.col("r_name").alias("zone_name"))

    def distributors():
        return nation.select(
            F.col("n_nationkey").cast("long").alias("distributor_id"),
            F.col("n_name").alias("distributor_name"),
            F.col("n_regionkey").cast("long").alias("zone_id"),
            tier_of(F.col("n_nationkey")).alias("tier"),
            F.col("n_name").alias("city"),
            F.lit(True).alias("active_status"))

    def retailers():
        return customer.select(
            F.col("c_custkey").alias("retailer_id"),
            F.col("c_name").alias("retailer_name"),
            F.col("c_nationkey").cast("long").alias("distributor_id"),
            F.concat(F.lit("CITY_"), F.col("c_nationkey").cast("string")).alias("city"),
            F.col("c_mktsegment").alias("channel_type"),
            F.lit(True).alias("active_status"))

    def products():
        trade = F.col("p_retailprice").cast(schemas.MONEY_PRICE)
        return part.select(
            F.col("p_partkey").alias("product_id"),
            F.concat_ws("/", F.col("p_type"), F.col("p_brand")).alias("sku_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.round(trade / DEC(TRADE_TO_MRP), 2).cast(schemas.MONEY_PRICE).alias("mrp"),
            trade.alias("trade_price"),
            F.round(trade * cost_ratio(F.col("p_type")), 2).cast(schemas.MONEY_PRICE).alias("cost_price"))

    def sales_orders():
        return orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("retailer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"))

    def promotions():
        # One campaign per (category, tier): categories from a tiny distinct aggregate
        # of the part table, dates from one-row scalar subqueries over the order dates
        # (pruned when unused).
        first_day = star.sales_orders.agg(F.min("order_date")).scalar()
        last_day = star.sales_orders.agg(F.max("order_date")).scalar()
        tiers = F.explode(F.array(*[F.lit(p) for p in PROMOTION_TIERS]))
        days = F.datediff(last_day, first_day)

        def day(end: int) -> Column:
            share = _case(F.col("pct"), [(p, F.lit(span[end])) for p, span in CAMPAIGN_SPAN.items()])
            return F.date_add(first_day, (F.floor(days * share / 100) + CAMPAIGN_SHIFT * (F.col("category_code") - 1)).cast("int"))

        return category_codes(part).select("category", "category_code", tiers.alias("pct")).select(
            promotion_id(F.col("category_code"), F.col("pct")).alias("promotion_id"),
            F.concat(F.col("category"), F.lit(" "), F.col("pct").cast("string"),
                     F.lit("% offer")).alias("promotion_name"),
            F.col("category"),
            F.col("pct").cast(schemas.PERCENT).alias("discount_percent"),
            day(0).alias("start_date"),
            day(1).alias("end_date"))

    # Line money in exact integer cents (prices are on the cent grid): the
    # aggregation hot path sums BIGINTs instead of wide DECIMALs; the declared
    # DECIMAL(12,2) columns are derived from the cents and only computed when a
    # job selects them.  discount = gross x pct / 100 rounded half up.
    # half-up to the nearest integer as floor(x + 0.5): exact for these non-negative
    # cent-grid values and about 2x faster per row than round(), which goes
    # through a BigDecimal for every double
    gross_c = "CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)"
    pct_c = "CAST(floor(l_discount * 100 + 0.5) AS INT)"
    promoted = F.col("discount_pct").isin(PROMOTION_TIERS)

    def base():
        return lineitem.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity_units"),
            F.expr(gross_c).alias("gross_cents"),
            F.expr(f"({gross_c} * {pct_c} + 50) div 100").alias("discount_cents"),
            F.expr(pct_c).alias("discount_pct"),
        ).withColumn("net_cents", F.col("gross_cents") - F.col("discount_cents"))

    def decimals():
        return [from_cents(F.col(c)).cast(schemas.MONEY_LINE).alias(n) for c, n in
                (("gross_cents", "gross_sales_value"), ("discount_cents", "discount_value"),
                 ("net_cents", "net_sales_value"))]

    def lean_items():
        return base().select("order_item_id", "order_id", "product_id", "quantity_units",
                             "gross_cents", "discount_cents", "net_cents", "discount_pct",
                             promoted.alias("is_promoted"), *decimals())

    def coded_parts() -> DataFrame:
        codes = category_codes(part).withColumnRenamed("category", "p_type")
        return (part.select(F.col("p_partkey").alias("product_id"), "p_type").join(codes, "p_type")
                .select("product_id", "category_code"))

    def promotion_ids(lines: DataFrame) -> DataFrame:
        # The category comes from the part row; applied to lines that were
        # already filtered / joined by the job, so only those rows meet the part table.
        typed = lines.join(coded_parts(), "product_id", "left")
        return typed.withColumn(
            "promotion_id", F.when(F.col("is_promoted"), promotion_id(F.col("category_code"), F.col("discount_pct")))
        ).drop("category_code")

    def sales_order_items():
        typed = base().join(coded_parts(), "product_id", "left")
        return typed.select(
            "order_item_id", "order_id", "product_id",
            F.when(promoted, promotion_id(F.col("category_code"), F.col("discount_pct"))).alias("promotion_id"),
            "quantity_units", *decimals())

    star = Star(zones=zones, distributors=distributors, retailers=retailers, products=products,
                promotions=promotions, sales_orders=sales_orders, sales_order_items=sales_order_items,
                lean_items=lean_items, promotion_ids=promotion_ids)
    return star
