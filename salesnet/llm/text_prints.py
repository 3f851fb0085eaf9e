"""Document fingerprints: SimHash of weighted terms, and the permuted block tables that
find every fingerprint within a Hamming radius."""

from __future__ import annotations

import hashlib
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesnet.llm.common import checkpointed, out_batch, pieces, scramble, words_of
from salesnet.operators.ordering import cut_points, with_bucket

BITS = 128
TERM_WORDS = 2          # words of a term
RADIUS = 4              # bits that near fingerprints may differ in
BLOCK_ROWS = 1024       # fingerprints of a table entry that are compared at once
BUCKETS_PER_PARTITION = 4
_TERMS_AT_ONCE = 1 << 15
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


# ---------------------------------------------------------------- fingerprints

def _terms(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, high 64 bits, low 64 bits) of every term: ``width`` words in a row, lower-cased;
    a text with fewer words is one term."""
    rows, codes, distinct = words_of(texts, lower=True)
    base = np.array([xxhash.xxh64_intdigest(w) for w in distinct.cast(pa.binary()).to_pylist()], dtype=np.uint64)
    h = base[codes] if len(codes) else np.zeros(0, dtype=np.uint64)
    n = len(h)
    at = np.arange(n)
    ends = np.cumsum(np.bincount(rows, minlength=len(texts)))[rows] if n else at
    first = np.r_[True, rows[1:] != rows[:-1]] if n else np.zeros(0, dtype=bool)
    keep = (at + width <= ends) | first
    start = at[keep]
    out = []
    for side in range(2):
        x = np.full(len(start), width, dtype=np.uint64)
        for k in range(width):
            here = np.minimum(start + k, n - 1)
            inside = start + k < ends[start]
            x = np.where(inside, scramble(x * _ODD[side] + h[here]), x)
        out.append(x)
    return rows[start], out[0], out[1]


def simhash(texts: pa.Array, width: int = TERM_WORDS) -> np.ndarray:
    """(texts, 2) 64-bit halves of the fingerprints.

    Every different term of a text votes on each bit with the weight 1 + log2(occurrences),
    in eighths; a bit is 1 where the ones outweigh the zeros.  Sums are of integers, so
    equal texts have equal fingerprints.  A text without words has all bits 0.
    """
    rows, high, low = _terms(texts, width)
    key = rows.astype(np.uint64) << np.uint64(44) | high >> np.uint64(20)  # 44 bits tell a text's terms apart
    _, place, times = np.unique(key, return_index=True, return_counts=True)
    weight = np.floor(8 * (1 + np.log2(times))).astype(np.uint16)
    owner = rows[place]
    halves = np.stack([high[place], low[place]], axis=1).astype(">u8")
    votes = np.zeros((len(texts), BITS), dtype=np.int64)
    for a in range(0, len(owner), _TERMS_AT_ONCE):
        block = slice(a, a + _TERMS_AT_ONCE)
        bits = np.unpackbits(halves[block].view(np.uint8).reshape(-1, BITS // 8), axis=1)
        own = owner[block]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        votes[own[starts]] += np.add.reduceat(bits * weight[block, None], starts, axis=0, dtype=np.int64)
    total = np.bincount(owner, weights=weight, minlength=len(texts)).astype(np.int64)
    packed = np.packbits(votes * 2 > total[:, None], axis=1)
    return packed.view(">u8").reshape(len(texts), 2).astype(np.uint64)


def hex_of(prints: np.ndarray) -> list[str]:
    return [f"{a:016x}{b:016x}" for a, b in prints.tolist()]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits, 0 to 1."""
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


# ---------------------------------------------------------------- order: each document beside the next

ORDER = ["_none", "_back", "_text_hash", "_task"]


def _beside_next(docs: DataFrame) -> DataFrame:
    """Rows (bucket, borrowed, doc_id, text) in partitions sorted by descending doc_id, each
    bucket followed by a copy of the next bucket's first row.

    Buckets are ranges of the order cut by a bounded sample, so texts move once and no
    window spans the table.  The order is doc_id descending, rows without id last, then
    the text's hash, then the input partition, so neither a repeated id nor a missing one
    makes a hot bucket.  Only the first key of each bucket reaches the driver.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.col("doc_id").isNull().cast("int").alias("_none"),
        F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0)).cast("long").alias("_back"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_hash"), F.spark_partition_id().alias("_task"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) * BUCKETS_PER_PARTITION
    placed = with_bucket(keyed, ORDER, cut_points(keyed, ORDER, buckets), "_bucket")
    firsts = sorted((r[0], *r[1]) for r in placed.groupBy("_bucket").agg(F.min(F.struct(*ORDER))).collect())
    lent = spark.createDataFrame(
        [(firsts[i - 1][0], *f[1:]) for i, f in enumerate(firsts)],
        "_to int, _n int, _b long, _h long, _t int")
    same = ((F.col("_none") == F.col("_n")) & (F.col("_back") == F.col("_b"))
            & (F.col("_text_hash") == F.col("_h")) & (F.col("_task") == F.col("_t")))
    # one row per bucket, at most BUCKETS_PER_PARTITION for each shuffle partition
    borrowed = (keyed.join(F.broadcast(lent), same).dropDuplicates(["_to"])
                .select("doc_id", "text", *ORDER, F.col("_to").alias("_bucket"), F.lit(1).alias("_borrowed")))
    both = placed.select("doc_id", "text", *ORDER, "_bucket", F.lit(0).alias("_borrowed")).union(borrowed)
    return (both.repartition("_bucket").sortWithinPartitions("_bucket", "_borrowed", *ORDER)
            .select("_bucket", "_borrowed", "doc_id", "text"))


PRINTS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, high long, low long")


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edited_prints(docs: DataFrame, width: int = TERM_WORDS) -> DataFrame:
    """Per document its fingerprint, its edited text's, and their likeness; see ``document_fingerprints``."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
                        ("near_next", pa.float64()), ("high", pa.int64()), ("low", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # the last row seen, whose next is still to come
        for batch in pieces(batches, "text"):
            rows = held + list(zip(*(c.to_pylist() for c in batch.columns)))
            held = rows[-1:]
            own = [i for i in range(len(rows) - 1) if not rows[i][1]]
            if not own:
                continue
            after = [i + 1 for i in own]
            texts = [r[3] for r in rows]
            changed = [edited(texts[i], texts[i + 1]) for i in own]
            prints = simhash(pa.array(texts + changed, type=pa.string()), width)
            mine, theirs, nexts = prints[own], prints[len(texts):], prints[after]
            yield out_batch(
                schema, doc_id=[rows[i][2] for i in own], n_chars=[len(texts[i]) for i in own],
                edited_sha256=[hashlib.sha256(t.encode()).hexdigest() for t in changed],
                fingerprint=hex_of(mine), edited_fingerprint=hex_of(theirs), near_edited=likeness(mine, theirs),
                near_next=likeness(mine, nexts), high=mine[:, 0].view(np.int64), low=mine[:, 1].view(np.int64))

    return _beside_next(docs).mapInArrow(run, PRINTS)


# ---------------------------------------------------------------- permuted block tables

def block_masks(tables: int) -> list[tuple[int, int]]:
    """(high, low) masks of the blocks that the bits are cut into."""
    masks = []
    for cut in np.array_split(np.arange(BITS), tables):
        whole = sum(1 << (BITS - 1 - int(i)) for i in cut)
        masks.append((whole >> 64, whole & (1 << 64) - 1))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_fingerprints(prints: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(high, low, near): for every row of ``prints`` (different fingerprints high, low with
    their number of documents n), how many documents of *other* fingerprints are at most
    ``radius`` bits away.  Fingerprints without a neighbour are absent.

    The bits are cut into radius + 1 blocks; two near fingerprints agree on one whole
    block, so table t lists all fingerprints under their block t and near ones meet in some
    entry.  An entry is compared as pairs of salted parts of about ``block_rows``
    fingerprints, each pair of parts in a group of its own, so a large group of near copies
    is many bounded groups.  A pair counts in the first table it shares only; a group
    returns counts per fingerprint, never pairs.
    """
    masks = block_masks(radius + 1)
    entries = F.array(*[F.struct(F.lit(t).alias("table"),
                                 F.col("high").bitwiseAND(F.lit(_signed(h))).alias("kh"),
                                 F.col("low").bitwiseAND(F.lit(_signed(w))).alias("kl"))
                        for t, (h, w) in enumerate(masks)])
    listed = prints.select("high", "low", "n", F.explode(entries).alias("e")).select("high", "low", "n", "e.*")
    key = ["table", "kh", "kl"]
    sizes = (listed.groupBy(*key).agg(F.count(F.lit(1)).alias("_size")).filter(F.col("_size") > 1)
             .withColumn("_parts", F.ceil(F.col("_size") / F.lit(block_rows)).cast("int")).drop("_size"))
    salted = (listed.join(sizes, key)
              .withColumn("_mine", F.pmod(F.xxhash64("high", "low"), F.col("_parts")).cast("int"))
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
              .withColumn("_i", F.least("_mine", "_other")).withColumn("_j", F.greatest("_mine", "_other")))
    groups = (salted.groupBy(*key, "_i", "_j")
              .agg(F.collect_list(F.struct("high", "low", "n", (F.col("_mine") == F.col("_i")).alias("left"))).alias("members"))
              .select("table", (F.col("_i") == F.col("_j")).alias("inside"), "members"))
    found = groups.mapInArrow(_compare(radius, masks), "high long, low long, near long")
    return found.groupBy("high", "low").agg(F.sum("near").alias("near"))


def _compare(radius: int, masks: Sequence[tuple[int, int]]):
    schema = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("near", pa.int64())])
    blocks = [(np.uint64(h), np.uint64(w)) for h, w in masks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for table, inside, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                high, low, n, left = (members.values.field(k).to_numpy(zero_copy_only=False) for k in range(4))
                a, b = (np.arange(len(n)),) * 2 if inside else (np.flatnonzero(left), np.flatnonzero(~left))
                h, w = high.view(np.uint64), low.view(np.uint64)
                xh, xl = h[a][:, None] ^ h[b][None, :], w[a][:, None] ^ w[b][None, :]
                i, j = np.nonzero(np.bitwise_count(xh).astype(np.uint8) + np.bitwise_count(xl) <= radius)
                i, j = (i[i < j], j[i < j]) if inside else (i, j)
                dh, dl = xh[i, j], xl[i, j]
                fresh = np.ones(len(i), dtype=bool)
                for mh, ml in blocks[:table]:
                    fresh &= ((dh & mh) | (dl & ml)) != 0
                i, j = a[i[fresh]], b[j[fresh]]
                near = np.bincount(i, weights=n[j], minlength=len(n)) + np.bincount(j, weights=n[i], minlength=len(n))
                some = np.flatnonzero(near)
                out.append((high[some], low[some], near[some].astype(np.int64)))
            if out:
                yield out_batch(schema, **dict(zip(schema.names, map(np.concatenate, zip(*out)))))

    return run


def document_fingerprints(docs: DataFrame, width: int = TERM_WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (32 hex digits),
    near_edited, near_next (share of equal bits), n_near (other documents whose
    fingerprint is at most ``radius`` bits away, equal ones included).

    A document's edited text has its last half of code points replaced by the first as
    many of the next document's, by descending doc_id, the first after the last.  Rows
    without id come last; rows that share an id follow by their text's hash.  NULL text
    counts as empty: 0 characters, all bits 0.  A text shorter than ``width`` words is one
    term.  Repeated rows repeat, a single row is its own next, an empty table gives no
    rows, other columns are ignored.  Texts are taken whole, whatever their length.
    """
    prints = checkpointed(edited_prints(docs, width))
    classes = prints.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"))
    near = near_fingerprints(classes, radius).select(F.col("high").alias("_h"), F.col("low").alias("_l"), "near")
    known = (classes.join(near, (F.col("high") == F.col("_h")) & (F.col("low") == F.col("_l")), "left")
             .select(F.col("high").alias("_h"), F.col("low").alias("_l"),
                     (F.col("n") - 1 + F.coalesce("near", F.lit(0))).cast("long").alias("n_near")))
    return (prints.join(known, (F.col("high") == F.col("_h")) & (F.col("low") == F.col("_l")))
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                    "near_next", "n_near"))
