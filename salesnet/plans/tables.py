"""Table work on the star schema: validation, loading helpers, derivations.

All jobs are set-based DataFrame plans: one aggregate pass per table for the
validation rules, anti joins for idempotent appends, a broadcast of a
partition-count table (bounded by the number of partitions) for dense
surrogate keys, a range join against disjoint campaign segments for promotion
attachment.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesnet import schemas
from salesnet.functions.scalar import DEC, money, safe_pct
from salesnet.operators import cut_points, day_attach, interval_attach, order_lines, order_totals, resolve_overlaps, with_bucket, with_products
from salesnet.params import DEFAULT_PERIOD, Period
from salesnet.sources.star import TABLE_NAMES, Star

# ---------------------------------------------------------------- R2 constraints

# The declared domains of the star schema.
DECLARED_DOMAINS = {
    "tier": ["A", "B", "C"],
    "channel_type": ["General Trade", "Modern Trade", "Wholesale"],
    "category": ["Home Care", "Personal Care", "Packaged Foods", "Beverages"],
}
# Declared VARCHAR limits.
LENGTH_LIMITS = {
    "zones": {"zone_name": 50},
    "distributors": {"distributor_name": 100, "tier": 10, "city": 80},
    "retailers": {"retailer_name": 120, "city": 80, "channel_type": 30},
    "products": {"sku_name": 120, "category": 50, "brand": 80},
    "promotions": {"promotion_name": 120, "category": 50},
}
PRIMARY_KEYS = {
    "zones": "zone_id", "distributors": "distributor_id", "retailers": "retailer_id",
    "products": "product_id", "promotions": "promotion_id", "sales_orders": "order_id",
    "sales_order_items": "order_item_id",
}
# (child table, column, parent table, parent key); a NULL reference passes.
FOREIGN_KEYS = [
    ("distributors", "zone_id", "zones", "zone_id"),
    ("retailers", "distributor_id", "distributors", "distributor_id"),
    ("sales_orders", "retailer_id", "retailers", "retailer_id"),
    ("sales_order_items", "order_id", "sales_orders", "order_id"),
    ("sales_order_items", "product_id", "products", "product_id"),
    ("sales_order_items", "promotion_id", "promotions", "promotion_id"),
]
UNIQUE = [("zones", "zone_name")]


def check_rules(domains: Mapping[str, Sequence[str]] = DECLARED_DOMAINS) -> dict[str, list[tuple[str, str]]]:
    """Row-level CHECK / NOT NULL / length rules per table as (rule name, SQL predicate).

    A row violates a rule when the predicate is FALSE; NULL passes, as in SQL.
    """
    def dom(col, key):
        vals = ", ".join("'" + v.replace("'", "''") + "'" for v in domains[key])
        return f"{col} IN ({vals})"

    rules: dict[str, list[tuple[str, str]]] = {t: [] for t in TABLE_NAMES}
    for table, schema in schemas.STAR.items():
        for f in schema.fields:
            if not f.nullable:
                rules[table].append((f"not_null_{f.name}", f"{f.name} IS NOT NULL"))
    for table, limits in LENGTH_LIMITS.items():
        for col, n in limits.items():
            rules[table].append((f"length_{col}", f"length({col}) <= {n}"))
    rules["distributors"].append(("domain_tier", dom("tier", "tier")))
    rules["retailers"].append(("domain_channel_type", dom("channel_type", "channel_type")))
    rules["products"] += [
        ("domain_category", dom("category", "category")),
        ("mrp_positive", "mrp > 0"), ("trade_price_positive", "trade_price > 0"),
        ("cost_price_positive", "cost_price > 0"),
        ("trade_le_mrp", "trade_price <= mrp"), ("cost_lt_trade", "cost_price < trade_price"),
    ]
    rules["promotions"] += [
        ("domain_category", dom("category", "category")),
        ("discount_percent_range", "discount_percent BETWEEN 0 AND 70"),
        ("end_after_start", "end_date >= start_date"),
    ]
    rules["sales_order_items"] += [
        ("quantity_positive", "quantity_units > 0"),
        ("gross_non_negative", "gross_sales_value >= 0"),
        ("discount_non_negative", "discount_value >= 0"),
        ("net_non_negative", "net_sales_value >= 0"),
    ]
    return rules


# Rules implied by the writer of the line table, not declared as constraints.
IMPLIED_LINE_RULES = [
    ("net_is_gross_minus_discount", "net_sales_value = gross_sales_value - discount_value"),
    ("no_discount_without_promotion", "promotion_id IS NOT NULL OR discount_value = 0"),
]


def check_implied_rules(star: Star) -> DataFrame:
    """R2, the rules the writer implies: (rule, table_name, violations) from one pass over
    the lines with their order date.

    The rules of a line alone are counted, in exact cents, while lines are reduced to
    (product, date, promotion), or what the promotion is derived from, and those without
    promotion to their product; only these weighted rows meet the products, and only
    (category, date, promotion) rows meet the promotions, so neither a hot product nor
    the lines without promotion make a skewed join.
    """
    hook = star.promotion_ids
    lines = order_lines(star, None, promotion_id=hook is None)
    promoted = F.col("is_promoted") if hook else F.col("promotion_id").isNotNull()
    keys = ["product_id", F.when(promoted, F.col("order_date")).alias("order_date")]
    keys += [F.when(promoted, F.col("discount_pct")).alias("discount_pct"), "is_promoted"] if hook else ["promotion_id"]
    groups = lines.groupBy(*keys).agg(
        F.count_if(F.col("net_cents") != F.col("gross_cents") - F.col("discount_cents")).alias("_unequal"),
        F.count_if(F.col("discount_cents") != 0).alias("_discounted"), F.count(F.lit(1)).alias("_lines"))
    groups = with_products(hook(groups) if hook else groups, star, ["category"])
    groups = groups.groupBy("category", "promotion_id", "order_date").agg(
        *[F.sum(c).alias(c) for c in ("_unequal", "_discounted", "_lines")])
    promo = star.promotions.select(F.col("promotion_id").alias("_promotion"), F.col("category").alias("_category"),
                                   "start_date", "end_date")
    seen = groups.join(promo, F.col("promotion_id") == F.col("_promotion"), "left")
    counted = [(IMPLIED_LINE_RULES[0][0], "_unequal", "false"),
               (IMPLIED_LINE_RULES[1][0], "_discounted", "promotion_id IS NOT NULL"),
               ("promotion_category_is_product_category", "_lines", "_promotion IS NULL OR _category = category"),
               ("order_date_inside_promotion", "_lines", "_promotion IS NULL OR order_date BETWEEN start_date AND end_date")]
    counts = seen.selectExpr(*[f"sum(IF(NOT ({holds}), {n}, 0)) AS c{i}" for i, (_, n, holds) in enumerate(counted)])
    return _stacked(counts, "sales_order_items", [name for name, *_ in counted])


def _stacked(counts: DataFrame, table: str, names: Sequence[str]) -> DataFrame:
    """One row of counts ``c0``, ``c1``, ... as rows (rule, table_name, violations)."""
    stack = ", ".join(f"'{name}', c{i}" for i, name in enumerate(names))
    return counts.selectExpr(f"stack({len(names)}, {stack}) AS (rule, violations)").selectExpr(
        "rule", f"'{table}' AS table_name", "CAST(coalesce(violations, 0) AS BIGINT) AS violations")


def _known(per_key: DataFrame, key: str, flag: str) -> DataFrame:
    return per_key.select(key, F.lit(True).alias(flag))


def _line_rules(lines: DataFrame, rules: list[tuple[str, str]], orders: DataFrame) -> DataFrame:
    """The row rules of the lines and their order references, from one scan: violations and
    references are counted per order (a partial aggregate where the lines are read), and the
    per-order rows meet the order keys."""
    per_order = lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_refs"), *[F.expr(f"count_if(NOT ({pred}))").alias(f"c{i}") for i, (_, pred) in enumerate(rules)])
    checked = per_order.join(_known(orders, "order_id", "_order"), "order_id", "left")
    n = len(rules)
    counts = checked.agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(n)],
                         F.sum(F.expr("CASE WHEN order_id IS NOT NULL AND _order IS NULL THEN _refs END")).alias(f"c{n}"))
    return _stacked(counts, "sales_order_items", [*(name for name, _ in rules), "foreign_key_order_id"])


def _line_references(star: Star, products: DataFrame, promotions: DataFrame) -> DataFrame:
    """The product and promotion references of the lines, from one scan.

    Lines are counted per product and what decides the promotion, so the joins see
    aggregated rows; lines without promotion are one row before the promotion join.
    """
    hook = star.promotion_ids
    keys = ["product_id", "discount_pct", "is_promoted"] if hook else ["product_id", "promotion_id"]
    refs = star.items(promotion_id=hook is None).groupBy(*keys).agg(F.count(F.lit(1)).alias("_refs"))
    refs = refs.join(_known(products, "product_id", "_product"), "product_id", "left").withColumn(
        "_lost", F.expr("CASE WHEN product_id IS NOT NULL AND _product IS NULL THEN _refs END"))
    per = ((hook(refs) if hook else refs).groupBy("promotion_id")
           .agg(F.sum("_refs").alias("_refs"), F.sum("_lost").alias("_lost")))
    counts = (per.join(_known(promotions, "promotion_id", "_promotion"), "promotion_id", "left")
              .agg(F.sum("_lost").alias("c0"),
                   F.sum(F.expr("CASE WHEN promotion_id IS NOT NULL AND _promotion IS NULL THEN _refs END")).alias("c1")))
    return _stacked(counts, "sales_order_items", ["foreign_key_product_id", "foreign_key_promotion_id"])


def check_constraints(star: Star, domains: Mapping[str, Sequence[str]] = DECLARED_DOMAINS,
                      implied: bool = False, only_violated: bool = False) -> DataFrame:
    """R2: one row per rule: (rule, table_name, violations).

    Row rules of a table are evaluated in one aggregate pass over it
    (``count_if(NOT pred)`` per rule); key uniqueness is a grouped count per key
    (partial aggregation before the shuffle, so a hot key is one row per task);
    foreign keys are left anti joins of the non-NULL references (counted per key
    before the shuffle); a violation count is a number of rows.  The lines are read
    three times: for their rules and order references, for their product and promotion
    references, and for their key.
    """
    rules = check_rules(domains)
    if implied:
        rules["sales_order_items"] = rules["sales_order_items"] + IMPLIED_LINE_RULES
    tables = star.tables()
    # Line rules and the line key only need the line columns: read them through
    # ``items()``, which avoids the part join a source may need for the promotion id
    # (the implied rules do use it).
    lines = tables["sales_order_items"] = star.items(promotion_id=implied)
    per_keys = {table: tables[table].groupBy(key).agg(F.count(F.lit(1)).alias("n")) for table, key in PRIMARY_KEYS.items()}
    parts = [_line_rules(lines, rules.pop("sales_order_items"), per_keys["sales_orders"]),
             _line_references(star, per_keys["products"], per_keys["promotions"])]
    for table, rs in rules.items():
        if rs:
            counts = tables[table].selectExpr(*[f"count_if(NOT ({pred})) AS c{i}" for i, (_, pred) in enumerate(rs)])
            parts.append(_stacked(counts, table, [name for name, _ in rs]))
    for table, key in PRIMARY_KEYS.items():
        parts.append(_stacked(per_keys[table].selectExpr("count_if(n > 1) AS c0"), table, [f"primary_key_unique_{key}"]))
    for table, col in UNIQUE:
        per_val = tables[table].filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
        parts.append(_stacked(per_val.selectExpr("count_if(n > 1) AS c0"), table, [f"unique_{col}"]))
    for child, col, parent, pkey in FOREIGN_KEYS:
        if child == "sales_order_items":
            continue
        refs = (tables[child].select(col).filter(F.col(col).isNotNull())
                .groupBy(col).agg(F.count(F.lit(1)).alias("_refs")))
        # the parent side is the primary-key aggregate above: already one row per key
        # and hash-partitioned on it, so the parent table is shuffled once for both checks
        orphans = refs.join(per_keys[parent].select(F.col(pkey).alias(col)), col, "left_anti")
        parts.append(_stacked(orphans.selectExpr("sum(_refs) AS c0"), child, [f"foreign_key_{col}"]))
    out = reduce(DataFrame.unionByName, parts)
    if only_violated:
        out = out.filter(F.col("violations") > 0)
    return out.orderBy("table_name", "rule")


# ---------------------------------------------------------------- R3 / R4 loading

def insert_if_absent(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not in ``target`` yet, one per key.

    Appending the result is idempotent: a second run returns nothing.  Among
    duplicate keys in ``new`` the smallest row by the remaining columns is
    kept, so the choice is deterministic; it is a MIN aggregate, partial before
    the shuffle, so a key repeated on a third of the rows costs one row per task.
    Keys with a NULL are equal when their other columns are: they meet the target's
    rows with a NULL key only (a filter pushed to its scan), while whole keys meet in a
    plain equi-join, which reads a target bucketed by the key without a shuffle.
    """
    keys = list(keys)
    others = [c for c in new.columns if c not in keys]
    if others:
        first = (new.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
                 .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]))
    else:
        first = new.select(*keys).distinct()
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    absent = first.filter(whole).join(target.select(*keys), keys, "left_anti")
    if not any(new.schema[k].nullable for k in keys):
        return absent
    held = target.filter(~whole).select(*[F.col(k).alias(f"_held_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys])
    return absent.unionByName(first.filter(~whole).join(held, same, "left_anti"))


def assign_surrogate_key(df: DataFrame, order_cols: Sequence[str], id_col: str = "id",
                         start: int | Column = 1, partitions: int | None = None) -> DataFrame:
    """Dense ids ``start, start+1, ...`` following the total order ``order_cols``.

    Cut points, read once from a bounded sample, split the order into buckets; a row finds
    its bucket by binary search in these literals, so every branch of the plan agrees on
    it and a row's cost does not depend on the number of buckets.  Rows are counted per
    bucket, the counts become offsets (one row per bucket, broadcast), and a row adds its
    position in its own bucket.  No step gathers the rows into one task.  ``order_cols``
    must be unique, so recomputation after an executor loss assigns the same ids.
    """
    n = int(partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = cut_points(df, order_cols, n)
    counts = (with_bucket(df.select(*order_cols), order_cols, cuts, "_bucket")
              .groupBy(F.col("_bucket").alias("_of")).agg(F.count(F.lit(1)).alias("_n")))
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_of", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    base = start if isinstance(start, Column) else F.lit(start)
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_cols)) - 1
    return (with_bucket(df, order_cols, cuts, "_bucket").withColumn("_pos", inside)
            .join(F.broadcast(offsets), F.col("_bucket") == F.col("_of"))
            .withColumn(id_col, (base + F.col("_off") + F.col("_pos")).cast("long"))
            .drop("_bucket", "_pos", "_of", "_off"))


def next_id_after(existing: DataFrame, id_col: str) -> Column:
    """``max(existing.id_col) + 1`` (1 for an empty table) as a one-row scalar subquery,
    to pass as ``start`` so new surrogate keys continue above the current maximum."""
    return existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long") + 1).scalar()


# ---------------------------------------------------------------- R5 .. R8 derivations

TRADE_SHARE_OF_MRP = "0.80"


def derive_prices(products: DataFrame, cost_ratio: Column, trade_share: str = TRADE_SHARE_OF_MRP) -> DataFrame:
    """trade = round(mrp x share, 2); cost = round(trade x ratio(category), 2)."""
    trade = F.round(F.col("mrp") * DEC(trade_share), 2).cast(schemas.MONEY_PRICE)
    return (products.withColumn("trade_price", trade)
            .withColumn("cost_price", F.round(F.col("trade_price") * cost_ratio, 2).cast(schemas.MONEY_PRICE)))


def best_promotion_segments(promotions: DataFrame) -> DataFrame:
    """Disjoint per-category date segments, each with its single best promotion
    (highest discount, then lowest id)."""
    return resolve_overlaps(promotions.filter(F.col("category").isNotNull()), "category", "start_date", "end_date",
                            [F.desc("discount_percent"), F.asc("promotion_id")],
                            keep=["promotion_id", "discount_percent"])


def attach_promotion(lines: DataFrame, promotions: DataFrame, by_day: bool = True) -> DataFrame:
    """Left join by day of lines (with ``category`` and ``order_date``) to the
    promotion valid for their category on their date; every line is kept, at
    most one promotion each (inclusive ends; NULL-category campaigns never match).
    ``by_day=False`` joins by interval cells, for campaigns of many years."""
    if not by_day:
        segments = best_promotion_segments(promotions).withColumn("seg_stop", F.date_add("seg_end", 1))
        return interval_attach(lines, segments, "category", "order_date", "seg_start", "seg_stop",
                               ["promotion_id", "discount_percent"])
    return day_attach(lines, best_promotion_segments(promotions), "category", "order_date",
                        ["promotion_id", "discount_percent"])


def line_financials(df: DataFrame, qty: str = "quantity_units", price: str = "trade_price",
                    pct: str = "discount_percent") -> DataFrame:
    """gross = round(qty x price, 2); discount = round(qty x price x pct / 100, 2)
    (0 without a percentage); net = gross - discount."""
    gross = F.round(F.col(qty) * F.col(price), 2)
    disc = F.coalesce(F.round(F.col(qty) * F.col(price) * F.col(pct) * DEC("0.01"), 2), DEC("0.00"))
    return (df.withColumn("gross_sales_value", gross.cast(schemas.MONEY_LINE))
            .withColumn("discount_value", disc.cast(schemas.MONEY_LINE))
            .withColumn("net_sales_value",
                        (F.col("gross_sales_value") - F.col("discount_value")).cast(schemas.MONEY_LINE)))


# Tier weights for target allocation.
TIER_WEIGHTS = {"A": "5.0", "B": "2.5", "C": "1.0"}


def allocate_targets(distributors: DataFrame, quotas: DataFrame, weights: Mapping[str, str] = TIER_WEIGHTS,
                     zone_key: str = "zone_id") -> DataFrame:
    """Split each zone's ``quota`` over its distributors in proportion to the tier weight,
    ``bround(quota x w / sum(w))`` (half-even, as the original)."""
    w = None
    for tier, val in weights.items():
        w = F.when(F.col("tier") == tier, DEC(val)) if w is None else w.when(F.col("tier") == tier, DEC(val))
    d = distributors.withColumn("_w", w)
    totals = d.groupBy(zone_key).agg(F.sum("_w").alias("_wsum"))
    return (d.join(totals, zone_key).join(quotas, zone_key)
            .withColumn("target_items",
                        F.bround((F.col("quota") * F.col("_w") / F.col("_wsum")).cast("decimal(38,6)"), 0).cast("long"))
            .drop("_w", "_wsum"))


# ---------------------------------------------------------------- R9 / R10 counts

def row_counts(star: Star) -> DataFrame:
    """(table_name, row_count) for the seven tables."""
    # the line table is counted through ``items()``: same rows, but without the
    # part join a source may need for the promotion id (a join Spark cannot prune)
    tables = dict(star.tables(), sales_order_items=star.items())
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def promotion_coverage(star: Star) -> DataFrame:
    """Promoted lines, all lines and the promoted percentage (0 for an empty table)."""
    agg = star.items().agg(F.count_if(F.col("is_promoted")).alias("promoted_items"),
                           F.count(F.lit(1)).alias("total_items"))
    return agg.withColumn("coverage_pct",
                          F.coalesce(money(safe_pct(F.col("promoted_items"), F.col("total_items"))), F.lit(0.0)))


# ---------------------------------------------------------------- registered forms

def orders_to_append(star: Star, loaded_until: dt.date, batch: Period = DEFAULT_PERIOD) -> DataFrame:
    """R3 on the order table: orders of an incoming ``batch`` window that are not in a
    target loaded up to ``loaded_until`` (the batches overlap; only new keys append)."""
    target = star.sales_orders.filter(F.col("order_date") < F.lit(loaded_until))
    new = star.sales_orders.filter((F.col("order_date") >= F.lit(batch.start)) & (F.col("order_date") < F.lit(batch.end)))
    return insert_if_absent(target, new, ["order_id"])


def order_sequence(star: Star) -> DataFrame:
    """R4 on all orders: dense sequence numbers by (order_date, order_id)."""
    return assign_surrogate_key(star.sales_orders, ["order_date", "order_id"], id_col="sequence_no").select(
        "order_id", "retailer_id", "order_date", "sequence_no")


def repriced_products(star: Star, cost_ratio: Column) -> DataFrame:
    """R5 on the product table: trade and cost re-derived from MRP."""
    priced = derive_prices(star.products.select("product_id", "category", "mrp"), cost_ratio)
    return priced.select("product_id", *[F.col(c).cast("double").alias(c) for c in ("mrp", "trade_price", "cost_price")])


def _weighted_totals(priced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals of per-line amounts over groups of identical lines (``n`` lines each)."""
    w = F.col("n")
    return (priced.groupBy(*keys)
            .agg(F.sum(w).alias("lines"),
                 money(F.sum(F.col("gross_sales_value") * w)).alias("gross_value"),
                 money(F.sum(F.col("discount_value") * w)).alias("discount_value"),
                 money(F.sum(F.col("net_sales_value") * w)).alias("net_value"))
            .orderBy(*keys))


def promotion_attach_summary(star: Star, period: Period | None = None, by_day: bool = True) -> DataFrame:
    """R6 on all lines (or those of a window): lines and list-price amounts per attached promotion
    (NULL promotion = no valid campaign).

    Lines with the same (product, date, quantity) get the same promotion and the
    same per-line rounded amounts, so they are counted into one row first (a
    partial aggregate: a hot product is one row per date and quantity per task)
    and the product join and range join see those rows, weighted by the count.
    """
    groups = (order_lines(star, period).groupBy("product_id", "order_date", "quantity_units")
              .agg(F.count(F.lit(1)).alias("n")))
    lines = with_products(groups, star, ["category", "trade_price"])
    attached = line_financials(attach_promotion(lines, star.promotions, by_day))
    # the id as text: a column with NULLs that reads the same in every client
    return _weighted_totals(attached.withColumn("promotion_id", F.col("promotion_id").cast("string")), ["category", "promotion_id"])


def list_price_financials(star: Star, period: Period | None = None) -> DataFrame:
    """R7 on all lines (or those of a window): gross / discount / net re-priced at the product's
    trade price with the line's own promotion percentage (0 when not promoted).

    Lines with the same (product, quantity, promotion) price identically, so they are
    counted into one row before the product and promotion joins (see R6).
    """
    if star.promotion_ids is not None:
        pre = (order_lines(star, period).groupBy("product_id", "quantity_units", "discount_pct", "is_promoted")
               .agg(F.count(F.lit(1)).alias("n")))
        groups = star.promotion_ids(pre).select("product_id", "quantity_units", "promotion_id", "n")
    else:
        groups = (order_lines(star, period, promotion_id=True).groupBy("product_id", "quantity_units", "promotion_id")
                  .agg(F.count(F.lit(1)).alias("n")))
    # most lines have no promotion: they get keys of their own that match nothing, so
    # that they are not one hot NULL key
    alone = -1 - F.pmod(F.xxhash64("product_id", "quantity_units"), F.lit(1024))
    percent = star.promotions.select(F.col("promotion_id").alias("_promotion"), "discount_percent")
    groups = (groups.withColumn("_key", F.coalesce("promotion_id", alone))
              .join(percent, F.col("_key") == F.col("_promotion"), "left").drop("_key", "_promotion"))
    priced = line_financials(with_products(groups, star, ["category", "trade_price"]))
    return _weighted_totals(priced, ["category"])


def distributor_targets(star: Star, period: Period | None = None) -> DataFrame:
    """R8 with data-derived quotas: each zone's line count, split over
    its distributors by tier weight."""
    geo = star.retailers.select("retailer_id", "distributor_id").join(
        star.distributors.select("distributor_id", "zone_id"), "distributor_id")
    per_retailer = order_totals(star, period, measures=("lines",)).groupBy("retailer_id").agg(F.sum("lines").alias("n"))
    quotas = per_retailer.join(geo, "retailer_id").groupBy("zone_id").agg(F.sum("n").alias("quota"))
    dists = star.distributors.select("distributor_id", "distributor_name", "zone_id", "tier")
    out = allocate_targets(dists, quotas)
    return (out.join(star.zones, "zone_id")
            .select("zone_name", "distributor_name", "tier", "quota", "target_items")
            .orderBy("zone_name", "tier", "distributor_name"))
