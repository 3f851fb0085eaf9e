"""Result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """Write a job result as headed CSV (no index column).

    ``single_file`` coalesces to one partition and is meant for small final
    reports only (a handful of rows per job); large results keep their
    partitioning and are written in parallel.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
