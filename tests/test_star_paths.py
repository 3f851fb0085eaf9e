"""The jobs give the same answers on a Parquet star as on the mapped source tables."""

from __future__ import annotations

import os

import pytest

from salesnet.plans.registry import analytic_queries, table_queries, use_star
from salesnet.sources import load_star, tpch_star, write_star

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_parquet_star_matches_mapping(spark, tmp_path):
    mapped = tpch_star(spark, SF)
    write_star(mapped, str(tmp_path / "star"))
    loaded = load_star(spark, str(tmp_path / "star"))
    key = str(tmp_path / "alias")
    use_star(spark, key, loaded)
    queries = {**analytic_queries(), **table_queries()}
    mismatched = []
    for name, fn in queries.items():
        a = _rows(fn(spark, SF))
        b = _rows(fn(spark, key))
        if a != b:
            mismatched.append(name)
    assert mismatched == []
