"""Distributed order: cut points of a key, log-time bucket lookup, dense positions.

A total order over all rows is split at cut points into buckets that any task can tell
for itself, so positions and ranks need one window per bucket and a small table of
bucket sizes instead of one window over everything.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_SAMPLE = 64  # sampled keys per bucket boundary


def cut_points(df: DataFrame, cols: Sequence[str], buckets: int) -> list[tuple[str, ...]]:
    """At most ``buckets - 1`` ascending keys (as strings) that split ``cols`` about evenly.

    Read from the ``KEY_SAMPLE * buckets`` keys with the smallest hashes: the sample is
    bounded, is the same in every run, and is ordered by Spark in the columns' own types.
    A key with a NULL is never a cut; such rows belong to a lower bucket, as in NULLS FIRST.
    """
    keys = df.select(*cols).na.drop()
    sample = (keys.orderBy(F.xxhash64(*cols)).limit(KEY_SAMPLE * buckets).orderBy(*cols)
              .select(*[F.col(c).cast("string") for c in cols]).collect())
    picked = [tuple(sample[len(sample) * i // buckets]) for i in range(1, buckets)] if sample else []
    return [c for i, c in enumerate(picked) if i == 0 or c != picked[i - 1]]


def _typed_array(values: Sequence[str], data_type: str) -> Column:
    """A literal array: one JSON string, folded to a constant by the optimizer."""
    return F.from_json(F.lit(json.dumps(list(values))), "array<string>").cast(f"array<{data_type}>")


def with_bucket(df: DataFrame, cols: Sequence[str], cuts: Sequence[tuple[str, ...]], out: str) -> DataFrame:
    """``df`` with ``out`` (int): how many cut points are at or below the row's key.

    A binary search, one projection per halving over constant arrays, so a row costs
    log2(len(cuts)) comparisons whatever the number of buckets, inside generated code.
    """
    df = df.withColumn(out, F.lit(0))
    if not cuts:
        return df
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    arrays = [_typed_array(v, types[c]) for c, v in zip(cols, zip(*cuts))]
    step = 1 << (len(cuts).bit_length() - 1)
    while step:
        at = F.col(out) + F.lit(step - 1)
        below = F.lit(True)
        for c, a in reversed(list(zip(cols, arrays))):
            cut = F.get(a, at)
            last = c == cols[-1]
            below = (cut <= F.col(c)) if last else (cut < F.col(c)) | ((cut == F.col(c)) & below)
        df = df.withColumn(out, F.when(below, F.col(out) + F.lit(step)).otherwise(F.col(out)))
        step //= 2
    return df


def rank_by_value(df: DataFrame, by: Sequence[str], value: str, out: str = "rank", buckets: int | None = None) -> DataFrame:
    """``RANK() OVER (PARTITION BY by ORDER BY value DESC)`` without a window over a whole group.

    Two passes: the different values of a group are counted (a partial aggregate, so a
    value that a third of the rows share is one row) and go to range buckets of
    (``by``, ``value``); a value's rank is the rows in the group's higher buckets, plus
    those above it in its own, plus one.  A window holds one bucket of a group, or one
    row per bucket.  NULL values rank last.  ``df`` is planned three times: checkpoint it.
    """
    n = int(buckets or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = [*by, value]
    values = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    placed = with_bucket(values, key, cut_points(df, key, n), "_bucket")
    before = (Window.unboundedPreceding, -1)
    higher = Window.partitionBy(*by).orderBy(F.desc("_bucket")).rowsBetween(*before)
    offsets = (placed.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_rows"))
               .select(*[F.col(c).alias(f"_of_{c}") for c in by], F.col("_bucket").alias("_of_bucket"),
                       F.coalesce(F.sum("_rows").over(higher), F.lit(0)).alias("_higher")))
    above = Window.partitionBy(*by, "_bucket").orderBy(F.desc(value)).rowsBetween(*before)
    here = F.col("_bucket") == F.col("_of_bucket")
    for c in by:
        here = here & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    ranks = (placed.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0))).join(offsets, here)
             .select(*[F.col(c).alias(f"_at_{c}") for c in key],
                     (F.col("_higher") + F.col("_above") + 1).cast("int").alias(out)))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
    return df.join(ranks, same).drop(*[f"_at_{c}" for c in key])
