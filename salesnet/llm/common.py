"""Shared helpers: table access, reliable checkpoints, ranks inside hot groups,
and word streams over Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from contextlib import contextmanager
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesnet.session import ensure_checkpoint_dir

# Words are runs of anything but these bytes, for every operator of the package.
WORD_SEPARATORS = " \t\n\x0b\x0c\r"
# Rank buckets inside one group; see ``rank_in_group``.
RANK_BUCKETS = 256
# Arrow batches are cut into pieces of about this many text bytes before numpy work.
PIECE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """At most ``rows`` rows of whole texts in one Arrow batch: each batch is held several
    times, in the JVM and in Python, and both keep what they once needed.  For jobs that run
    many text operators in one session."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= rows:
        spark.conf.set(setting, str(rows))


@contextmanager
def batch_bytes(spark: SparkSession, limit: int) -> Iterator[None]:
    """Arrow batches of about ``limit`` bytes (one row at least) for the jobs run inside,
    however long their rows; the session's own limit holds again afterwards."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(limit))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, lineage cut (reliable, never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared checkpoint folder (nothing is created here)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def fresh(name: str, df: DataFrame) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus`` (NULL for a NULL id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """TRUE for the held-out fold; a row without id is never held out."""
    return F.coalesce(id_remainder(doc_id, modulus) == remainder, F.lit(False))


def word_count(text: str) -> Column:
    """Number of words of a text (0 for NULL), as JVM expressions."""
    marked = F.trim(F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\x0c\r", "     "))
    words = F.regexp_replace(marked, " +", " ")
    return F.when(words == "", F.lit(0)).otherwise(
        F.length(words) - F.length(F.translate(words, " ", "")) + 1).cast("long")


def rank_in_group(df: DataFrame, group: str, order: Sequence[str], out: str,
                  running: str | None = None, buckets: int = RANK_BUCKETS) -> DataFrame:
    """Position of each row in its group (0, 1, ...), without one task per group.

    Rows of a group go to ``buckets`` hash buckets; a row's position is the size of
    the lower buckets plus its place inside its own.  A group with a third of all
    rows is ``buckets`` window partitions, and the bucket sizes are a partial
    aggregate.  ``running`` names a long column to accumulate instead of 1 (prefix
    sums).  ``group`` must not be NULL.  ``df`` is planned twice, so it should be
    cheap or checkpointed.  Rows equal in ``order`` are interchangeable.
    """
    b = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    one = F.col(running) if running else F.lit(1).cast("long")
    sizes = b.groupBy(group, "_b").agg(F.sum(one).alias("_n"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(group).alias("_g"), F.col("_b").alias("_gb"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = b.withColumn("_at", F.sum(one).over(inside) - one)
    return (placed.join(starts, (F.col(group) == F.col("_g")) & (F.col("_b") == F.col("_gb")))
            .withColumn(out, (F.col("_start") + F.col("_at")).cast("long"))
            .drop("_b", "_g", "_gb", "_start", "_at"))


# ---------------------------------------------------------------- Arrow batches

def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of the batches with about ``limit`` bytes in ``column`` each (one row at
    least).  When the batches end, with the task, memory that is free goes back to the system."""
    try:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
            total = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                base = total[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
                yield batch.slice(start, stop - start)
                start = stop
    finally:
        release_memory()


def release_memory() -> None:
    """Give back what a task leaves free in a Python worker that lives on: Arrow's pool and
    the C heap (where the C library can)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The text column, NULL as the empty text."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(column)), "")


def words_of(text: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row of each word, code of each word, distinct words by code), in text order.
    ``lower`` folds A-Z only."""
    if lower:
        text = pc.ascii_lower(text)
    lists = pc.ascii_split_whitespace(text)
    flat = lists.flatten()
    rows = pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(flat), 0)
    flat, rows = flat.filter(full), rows.filter(full)
    coded = flat.dictionary_encode()
    return (rows.to_numpy(zero_copy_only=False).astype(np.int64),
            coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit words (shift, multiply, shift)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights=weights, minlength=n)


def out_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type) for n, c in
         ((f.name, columns[f.name]) for f in schema)], schema=schema)
