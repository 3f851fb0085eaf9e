"""Declared schemas of the seven star tables.

Ids are LONG so that large source keys fit; money is DECIMAL(10,2) on products
and DECIMAL(12,2) on lines; ``promotions.category`` and
``sales_order_items.promotion_id`` are the only nullable columns.
"""

from pyspark.sql import types as T


def _f(name, dtype, nullable=False):
    return T.StructField(name, dtype, nullable)


MONEY_PRICE = T.DecimalType(10, 2)
MONEY_LINE = T.DecimalType(12, 2)
PERCENT = T.DecimalType(5, 2)

ZONES = T.StructType([
    _f("zone_id", T.LongType()),
    _f("zone_name", T.StringType()),
])

DISTRIBUTORS = T.StructType([
    _f("distributor_id", T.LongType()),
    _f("distributor_name", T.StringType()),
    _f("zone_id", T.LongType()),
    _f("tier", T.StringType()),
    _f("city", T.StringType()),
    _f("active_status", T.BooleanType()),
])

RETAILERS = T.StructType([
    _f("retailer_id", T.LongType()),
    _f("retailer_name", T.StringType()),
    _f("distributor_id", T.LongType()),
    _f("city", T.StringType()),
    _f("channel_type", T.StringType()),
    _f("active_status", T.BooleanType()),
])

PRODUCTS = T.StructType([
    _f("product_id", T.LongType()),
    _f("sku_name", T.StringType()),
    _f("category", T.StringType()),
    _f("brand", T.StringType()),
    _f("mrp", MONEY_PRICE),
    _f("trade_price", MONEY_PRICE),
    _f("cost_price", MONEY_PRICE),
])

PROMOTIONS = T.StructType([
    _f("promotion_id", T.LongType()),
    _f("promotion_name", T.StringType()),
    _f("category", T.StringType(), True),
    _f("discount_percent", PERCENT),
    _f("start_date", T.DateType()),
    _f("end_date", T.DateType()),
])

SALES_ORDERS = T.StructType([
    _f("order_id", T.LongType()),
    _f("retailer_id", T.LongType()),
    _f("order_date", T.DateType()),
])

SALES_ORDER_ITEMS = T.StructType([
    _f("order_item_id", T.LongType()),
    _f("order_id", T.LongType()),
    _f("product_id", T.LongType()),
    _f("promotion_id", T.LongType(), True),
    _f("quantity_units", T.IntegerType()),
    _f("gross_sales_value", MONEY_LINE),
    _f("discount_value", MONEY_LINE),
    _f("net_sales_value", MONEY_LINE),
])

STAR = {
    "zones": ZONES,
    "distributors": DISTRIBUTORS,
    "retailers": RETAILERS,
    "products": PRODUCTS,
    "promotions": PROMOTIONS,
    "sales_orders": SALES_ORDERS,
    "sales_order_items": SALES_ORDER_ITEMS,
}

# Drop / create order that respects the foreign keys (dimensions first).
CREATE_ORDER = ["zones", "distributors", "retailers", "products", "promotions",
                "sales_orders", "sales_order_items"]


# Declared column defaults: what a column that the source lacks is filled with.
DEFAULTS = {"active_status": True, "discount_value": 0}


def reading(schema: T.StructType) -> T.StructType:
    """``schema`` for a file reader: columns that a file lacks read as their declared default,
    while a NULL that it holds stays a NULL."""
    return T.StructType([T.StructField(f.name, f.dataType, f.nullable, {
        "CURRENT_DEFAULT": str(DEFAULTS[f.name]).lower(), "EXISTS_DEFAULT": str(DEFAULTS[f.name]).lower()})
        if f.name in DEFAULTS else f for f in schema.fields])


def with_defaults(df, schema: T.StructType):
    """``df`` with the declared default in each column of ``schema`` that it lacks."""
    from pyspark.sql import functions as F
    missing = [f for f in schema.fields if f.name in DEFAULTS and f.name not in df.columns]
    return df.withColumns({f.name: F.lit(DEFAULTS[f.name]).cast(f.dataType) for f in missing}) if missing else df


def conform(df, schema: T.StructType):
    """Project ``df`` onto ``schema``: same column order, declared types, defaults for columns it lacks."""
    from pyspark.sql import functions as F
    df = with_defaults(df, schema)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
