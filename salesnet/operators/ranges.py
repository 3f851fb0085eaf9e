"""Range (interval) joins: attach at most one valid interval row per fact row."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve_overlaps(intervals: DataFrame, key: str, start: str, end: str,
                     priority: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """Split overlapping inclusive intervals of each ``key`` into disjoint segments.

    Each segment carries the single interval that wins on ``priority`` among
    those covering it.  Runs on the interval table only (campaigns, price lists:
    small), so a later range join of the big fact table finds at most one match
    per row and needs no per-row de-duplication shuffle.

    Output: key, seg_start, seg_end (inclusive DATEs), and the ``keep`` columns.
    """
    cuts = (intervals.select(key, F.col(start).alias("_b"))
            .union(intervals.select(key, F.date_add(F.col(end), 1).alias("_b")))
            .distinct())
    w = Window.partitionBy(key).orderBy("_b")
    segments = (cuts.withColumn("_next", F.lead("_b").over(w))
                .filter(F.col("_next").isNotNull())
                .select(key, F.col("_b").alias("seg_start"), F.date_sub(F.col("_next"), 1).alias("seg_end")))
    covering = segments.join(intervals, key).filter(
        (F.col(start) <= F.col("seg_start")) & (F.col(end) >= F.col("seg_end")))
    best = F.row_number().over(Window.partitionBy(key, "seg_start").orderBy(*priority))
    return (covering.withColumn("_rk", best).filter(F.col("_rk") == 1)
            .select(key, "seg_start", "seg_end", *keep))


def range_attach(facts: DataFrame, segments: DataFrame, key: str, at: str, keep: Sequence[str]) -> DataFrame:
    """Left join: each fact row gets the ``keep`` columns of the segment of its ``key``
    whose [seg_start, seg_end] holds ``at``; rows without one keep NULLs.

    Equi-join on ``key`` plus a BETWEEN residual; segments are disjoint per key,
    so the row count of ``facts`` is preserved.
    """
    seg = segments.select(F.col(key).alias("_k"), "seg_start", "seg_end", *keep)
    cond = (F.col(key) == F.col("_k")) & F.col(at).between(F.col("seg_start"), F.col("seg_end"))
    return facts.join(seg, cond, "left").drop("_k", "seg_start", "seg_end")


def day_attach(facts: DataFrame, segments: DataFrame, key: str, at: str, keep: Sequence[str]) -> DataFrame:
    """``range_attach`` for DATE segments as an equi-join: each segment is listed once per
    day (segments are disjoint, so a key has one row per day at most) and facts are
    hashed on (key, day) instead of on the few values of the key."""
    days = segments.select(F.col(key).alias("_k"), F.explode(F.sequence("seg_start", "seg_end")).alias("_day"), *keep)
    return facts.join(days, (F.col(key) == F.col("_k")) & (F.col(at) == F.col("_day")), "left").drop("_k", "_day")


def _position(df: DataFrame, name: str) -> Column:
    """A DATE as days, a TIMESTAMP as microseconds, an integer as it is (BIGINT)."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("long")
    return F.unix_micros(name) if isinstance(kind, T.TimestampType) else F.col(name).cast("long")


def interval_attach(facts: DataFrame, segments: DataFrame, key: str, at: str, start: str, end: str,
                    keep: Sequence[str]) -> DataFrame:
    """Left join: each fact row gets the ``keep`` columns of the segment of its ``key`` whose
    half-open [start, end) holds ``at``; rows without one keep NULLs.  Segments of a key are
    disjoint; ``start``, ``end`` and ``at`` are of one type (DATE, TIMESTAMP or integer).

    A segment of length 2^l to 2^(l+1) lies in two or three cells of width 2^l, whatever its
    length, so years or microseconds cost the same.  Distinct (key, at) look up their cell of
    each width in use, at most 63, as an equi-join with at most two segments a cell; the
    result comes back to the facts by (key, at).  A hot key spreads over its cells.
    Empty or NULL intervals hold nothing; a NULL ``at`` or ``key`` gets NULLs.
    """
    cells = (segments.select(F.col(key).alias("_k"), _position(segments, start).alias("_s"), _position(segments, end).alias("_e"), *keep)
             .filter(F.col("_e") > F.col("_s")).withColumn("_l", F.floor(F.log2(F.col("_e") - F.col("_s"))).cast("int")))
    widths = sorted(r[0] for r in cells.select("_l").distinct().collect())
    cells = cells.withColumn("_c", F.explode(F.expr("sequence(shiftright(_s, _l), shiftright(_e - 1, _l))")))
    points = facts.select(F.col(key).alias("_pk"), _position(facts, at).alias("_p")).dropna().distinct()
    probes = (points.withColumn("_pl", F.explode(F.array(*[F.lit(w) for w in widths]).cast("array<int>")))
              .withColumn("_pc", F.expr("shiftright(_p, _pl)")))
    hits = (probes.join(cells, (F.col("_pk") == F.col("_k")) & (F.col("_pl") == F.col("_l")) & (F.col("_pc") == F.col("_c")))
            .filter((F.col("_p") >= F.col("_s")) & (F.col("_p") < F.col("_e"))).select("_pk", "_p", *keep))
    return (facts.withColumn("_at", _position(facts, at))
            .join(hits, (F.col(key) == F.col("_pk")) & (F.col("_at") == F.col("_p")), "left").drop("_pk", "_p", "_at"))
