"""SimHash near-dedup: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from itertools import combinations
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesnet.llm.common import checkpointed, fresh, out_batch, pieces, text_of
from salesnet.llm.components import connected_components

BITS = 64
SHINGLE = 3
MAX_BITS = 2
SEED = 42
SPLIT_ABOVE = 128   # a block with more different fingerprints is split on its other bits
LEVELS = (4, 4, 4)  # blocks the still unused bits are cut into, level by level
_SHINGLES_AT_ONCE = 1 << 16


def _fingerprints(texts: list[str], width: int) -> list[str]:
    """16 hex digits per text: bit i is set when over half of the shingle hashes have it."""
    hashes, counts = [], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        words = text.encode().lower().split()  # bytes: lowers A-Z, splits at space and \t to \r
        n = len(words)
        if n > width:
            line = b" ".join(words)
            stop = np.cumsum([len(w) + 1 for w in words])
            first = [0, *stop[:n - width].tolist()]
            hashes += [digest(line[a:b], SEED) for a, b in zip(first, (stop[width - 1:] - 1).tolist())]
            counts.append(n - width + 1)
        elif n:
            hashes.append(digest(b" ".join(words), SEED))
            counts.append(1)
        else:
            counts.append(0)
    out = np.zeros(len(texts), dtype=np.uint64)
    every = np.array(hashes, dtype=np.uint64)
    counts = np.array(counts)
    votes = np.zeros((len(texts), BITS), dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    for at in range(0, len(every), _SHINGLES_AT_ONCE):
        bits = np.unpackbits(every[at:at + _SHINGLES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        own = owner[at:at + _SHINGLES_AT_ONCE]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        votes[own[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    packed = np.packbits(votes * 2 > counts[:, None], axis=1)
    out = packed.view(">u8").ravel()
    return [f"{x:016x}" for x in out.tolist()]


def fingerprints(docs: DataFrame, width: int = SHINGLE, *keep: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) of every document, and its long columns ``keep``.
    A text with fewer than ``width`` words is one shingle; one without words has fingerprint zero."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string()), *[(c, pa.int64()) for c in keep]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            yield out_batch(schema, doc_id=batch.column(0), fingerprint=_fingerprints(text_of(batch).to_pylist(), width),
                            **{c: batch.column(2 + i) for i, c in enumerate(keep)})

    return docs.select(F.col("doc_id").cast("long"), "text", *keep).mapInArrow(
        run, ", ".join(["doc_id long, fingerprint string", *[f"{c} long" for c in keep]]))


def _hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _masks(free: int, blocks: int, apart: int) -> list[int]:
    """Bit masks to add to the shared ones: the ``free`` bits are cut into ``blocks``
    blocks, and two words with at most ``apart`` different bits agree on all bits of
    some ``blocks - apart`` of them."""
    positions = [i for i in range(BITS) if free >> i & 1]
    cuts = np.array_split(positions, blocks)
    return [sum(1 << int(p) for c in chosen for p in c) for chosen in combinations(cuts, blocks - apart)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(prints: DataFrame, apart: int = MAX_BITS) -> DataFrame:
    """(a, b): enough links between different fingerprints (column ``f``, 64-bit long) at
    most ``apart`` bits apart to connect all that are linked.

    Pigeonhole blocks: 64 bits in ``apart + 2`` blocks; a close pair agrees on two of
    them, so every fingerprint is listed under each choice of two blocks and close
    pairs meet under a key.  A key with more than ``SPLIT_ABOVE`` fingerprints (a large
    group of near copies) is not compared as it is: its fingerprints differ only in the
    remaining bits, which are cut into blocks again, and again; after three levels a key
    leaves 8 bits open, 256 fingerprints at most.  This is exact at every level.

    Inside a key the fingerprints (a bounded array) are compared, and a task returns one
    link per fingerprint to the first of its group, not the pairs.
    """
    keys = prints.select("f", F.lit(0).cast("long").alias("mask"))
    open_masks = {0}
    out = None
    for level, blocks in enumerate((apart + 2, apart + 2, apart + 2)):
        listed, grown = None, {}
        for mask in open_masks:
            grown[mask] = [mask | m for m in _masks(~mask & (2 ** BITS - 1), blocks, apart)]
        choice = None
        for mask, nexts in grown.items():
            values = F.array(*[F.lit(_signed(m)) for m in nexts])
            cond = F.col("mask") == F.lit(_signed(mask))
            choice = F.when(cond, values) if choice is None else choice.when(cond, values)
        listed = (keys.select("f", F.explode(choice).alias("mask"))
                  .select("f", "mask", F.col("f").bitwiseAND(F.col("mask")).alias("key")).distinct())
        last = level == 2
        sizes = listed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        small = sizes if last else sizes.filter(F.col("n") <= SPLIT_ABOVE)
        groups = (listed.join(small.drop("n"), ["mask", "key"]).groupBy("mask", "key")
                  .agg(F.collect_list("f").alias("members")))
        links = groups.select("members").mapInArrow(_compare(apart), "a long, b long").distinct()
        out = links if out is None else out.union(links)
        if last:
            break
        large = checkpointed(sizes.filter(F.col("n") > SPLIT_ABOVE).drop("n"))
        open_masks = {r[0] & (2 ** BITS - 1) for r in large.select("mask").distinct().collect()}  # a few dozen masks at most
        if not open_masks:
            break
        keys = listed.join(large, ["mask", "key"]).select("f", "mask").distinct()
    return out


def _compare(apart: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch.column(0):
                m = np.sort(members.values.to_numpy())
                x = m.view(np.uint64)
                near = np.bitwise_count(x[:, None] ^ x[None, :]) <= apart
                label = np.arange(len(m))
                while True:
                    low = np.where(near, label[None, :], len(m)).min(axis=1)
                    if (low == label).all():
                        break
                    label = low
                to = label != np.arange(len(m))
                a.append(m[to])
                b.append(m[label[to]])
            if a:
                yield out_batch(schema, a=np.concatenate(a), b=np.concatenate(b))

    return run


def simhash_components(docs: DataFrame, width: int = SHINGLE, apart: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint, component_id (smallest doc_id reachable by links, itself included).

    Equal fingerprints are one class (a partial MIN aggregate, so thousands of copies are
    one row per task); links and components are found between classes and joined back.
    NULL text counts as empty; texts without words share fingerprint zero and are linked.
    A row without doc_id takes part and gets the component of its group (NULL if the
    group has no id).  Repeated rows repeat; an empty table gives no rows; other columns
    are ignored.
    """
    prints = checkpointed(fingerprints(docs, width).withColumn(
        "f", F.conv(F.col("fingerprint"), 16, -10).cast("long")))
    labelled = _component_classes(prints, apart)
    smallest = labelled.groupBy("c").agg(F.min("first_id").alias("component_id"))
    of_class = labelled.join(smallest, "c").select("f", "component_id")
    return prints.join(of_class, "f").select("doc_id", "fingerprint", "component_id")


def _component_classes(prints: DataFrame, apart: int, *of_class: Column) -> DataFrame:
    """(f, c, first_id, ...): each fingerprint, the smallest one its links reach, its
    smallest id, and further aggregates of its rows."""
    classes = prints.groupBy("f").agg(F.min("doc_id").alias("first_id"), *of_class)
    links = fingerprint_links(classes.select("f"), apart)
    parts = connected_components(links, "a", "b")
    return (classes.join(parts, F.col("f") == F.col("node"), "left")
            .withColumn("c", F.coalesce("component", "f")).drop("node", "component"))


def _id_text(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("none"))


def without_near_copies(docs: DataFrame, width: int = SHINGLE, apart: int = MAX_BITS) -> DataFrame:
    """Exactly one document of each group (all columns): of the rows with the group's
    smallest id (rows without id last), one with that id's smallest fingerprint.

    Rows are known by id and a hash of the text, so a repeated row stays once, and a row
    that shares a kept id stays only if its own text was chosen.  Equal rows are reduced in
    the scan tasks (a rank limit of 1), before texts are shuffled on that key.
    """
    key, own, first, at, rank = (fresh(f"_{c}", docs) for c in ("key", "own", "first", "at", "rank_of_equals"))
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    prints = checkpointed(fingerprints(docs.withColumn("text_hash", text_hash), width, "text_hash")
                          .withColumn("f", F.conv(F.col("fingerprint"), 16, -10).cast("long")))
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    chosen = (_component_classes(prints, apart, smallest.alias("row")).groupBy("c").agg(F.min("row").alias("r"))
              .select(_id_text("r.doc_id").alias(first), F.col("r.text_hash").alias(at)))
    others = [F.xxhash64(c) for c, t in docs.dtypes if "map<" not in t and c != "text"]
    rows = (docs.withColumn(key, _id_text("doc_id")).withColumn(own, text_hash)
            .withColumn(rank, F.row_number().over(Window.partitionBy(key, own).orderBy(*others))).filter(F.col(rank) <= 1))
    same = (F.col(key) == F.col(first)) & (F.col(own) == F.col(at))
    return rows.join(chosen, same, "left_semi").select(*docs.columns)
