"""Command line entry points."""

from __future__ import annotations

import os

import pytest

from salesnet.__main__ import main

SF = "/root/testdata/sf0.001"


def test_list(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert "distributor_scorecard" in out and "check_constraints" in out


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_run_to_csv(spark, tmp_path):
    out = str(tmp_path / "zones")
    assert main(["run", "revenue_by_zone", "--data", SF, "--out", out, "--format", "csv"]) == 0
    assert spark.read.option("header", True).csv(out).count() == 5
