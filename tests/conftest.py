"""Shared fixtures: one local Spark session and a builder for tiny star schemas."""

from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesnet import schemas  # noqa: E402
from salesnet.params import Period  # noqa: E402
from salesnet.session import get_session  # noqa: E402
from salesnet.sources.star import Star  # noqa: E402

YEAR = Period.of("2025-01-01", "2026-01-01")


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4)
    yield s


def D(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


class StarBuilder:
    """Collects rows for the seven tables and builds a typed ``Star``.

    Defaults: zone 1 "North", distributor 1 (tier A) in it, retailer 1 of that
    distributor, product 1 (category "Beverages", trade 10, cost 8, mrp 12.5).
    Helpers add orders with one line each.
    """

    def __init__(self):
        self.zones = [(1, "North")]
        self.distributors = [(1, "D1", 1, "A", "Delhi", True)]
        self.retailers = [(1, "R1", 1, "Delhi", "General Trade", True)]
        self.products = [(1, "SKU1", "Beverages", "B1", D(12.5), D(10), D(8))]
        self.promotions = []
        self.orders = []
        self.items = []

    def zone(self, zid, name):
        self.zones.append((zid, name))
        return self

    def distributor(self, did, name, zone_id=1, tier="A"):
        self.distributors.append((did, name, zone_id, tier, "City", True))
        return self

    def retailer(self, rid, distributor_id=1, name=None, channel="General Trade"):
        self.retailers.append((rid, name or f"R{rid}", distributor_id, "City", channel, True))
        return self

    def product(self, pid, sku=None, category="Beverages", trade=10, cost=8, mrp=None, brand="B"):
        mrp = mrp if mrp is not None else trade * 1.25
        self.products.append((pid, sku or f"SKU{pid}", category, brand, D(mrp), D(trade), D(cost)))
        return self

    def promotion(self, pid, category, pct, start, end, name=None):
        self.promotions.append((pid, name or f"P{pid}", category, D(pct), d(start), d(end)))
        return self

    def sale(self, retailer_id, date, net, product_id=1, qty=1, promotion_id=None, gross=None, discount=0):
        oid = len(self.orders) + 1
        self.orders.append((oid, retailer_id, d(date)))
        self.line(oid, net, product_id, qty, promotion_id, gross, discount)
        return self

    def line(self, order_id, net, product_id=1, qty=1, promotion_id=None, gross=None, discount=0):
        iid = len(self.items) + 1
        gross = net + discount if gross is None else gross
        self.items.append((iid, order_id, product_id, promotion_id, qty, D(gross), D(discount), D(net)))
        return self

    def build(self, spark) -> Star:
        mk = lambda rows, schema: spark.createDataFrame(rows, schema)
        return Star(
            zones=mk(self.zones, schemas.ZONES),
            distributors=mk(self.distributors, schemas.DISTRIBUTORS),
            retailers=mk(self.retailers, schemas.RETAILERS),
            products=mk(self.products, schemas.PRODUCTS),
            promotions=mk(self.promotions, schemas.PROMOTIONS),
            sales_orders=mk(self.orders, schemas.SALES_ORDERS),
            sales_order_items=mk(self.items, schemas.SALES_ORDER_ITEMS),
        )


@pytest.fixture
def sb():
    return StarBuilder()


def rows(df, *cols):
    """Collect ``cols`` of ``df`` as a list of tuples in the frame's order."""
    return [tuple(r[c] for c in cols) for r in df.collect()]
