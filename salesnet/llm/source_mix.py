"""Mixing sources to target weights with a low-discrepancy schedule."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesnet.llm.common import checkpointed, fresh, rank_in_group, word_count

GOLDEN = 0.6180339887498949  # fractional part of the golden ratio
BLOCK_WORDS = 128
MAX_EPOCHS = 3
WEIGHT_CYCLE = (1, 2, 3)
SLOT_CHUNK = 1 << 14
FEW_BLOCKS = 64  # a source with fewer blocks to take does without the schedule


def capped_targets(sizes: DataFrame, cycle: Sequence[int] = WEIGHT_CYCLE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target): the total shared by weight, targets stopped at
    ``epochs`` times the source's size and the excess reshared by weight.

    Water filling as one sorted pass: with sources ordered by size / weight, the ones
    below the water level are capped, and the level is (total - capped sizes) / (weight
    left) at the first source it does not cap.  One row per source; sources are ordered
    by code point, NULL last, for the weight cycle.
    """
    binary = F.col("source").cast("binary")
    n = len(cycle)
    place = F.row_number().over(Window.orderBy(binary.asc_nulls_last())) - 1
    w = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(x)) for x in cycle]), (place % n + 1).cast("int")))
    w = w.withColumn("_cap", F.col("source_size").cast("double") * epochs)
    order = Window.orderBy(F.col("_cap") / F.col("_w"), binary.asc_nulls_last())
    every = Window.partitionBy(F.lit(1))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total, weight = F.sum("source_size").over(every).cast("double"), F.sum("_w").over(every)
    w = (w.withColumn("_level", (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                      / (weight - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))))
    # the first source whose cap is above the level it would get fixes the level for all after it
    open_ = F.col("_level") * F.col("_w") <= F.col("_cap")
    w = w.withColumn("_final", F.min(F.when(open_, F.struct(F.col("_cap") / F.col("_w"), F.col("_level").alias("l")))).over(every)["l"])
    return w.select("source", "source_size", F.coalesce(
        F.least("_cap", F.col("_final") * F.col("_w")), F.col("_cap")).alias("target"))


def source_slots(shares: DataFrame, spark, blocks: int) -> DataFrame:
    """(source, rank) for ``blocks`` slots: slot i falls on the source whose part of
    the cumulative target shares holds frac(i * golden ratio).

    ``shares`` has (source, lo, hi), one row per source.  The slots are a Spark range;
    the attaching join is on the bucket of the unit interval, so it is an equi-join:
    every source lists the buckets its part touches.
    """
    grid = 4096
    cells = shares.select("source", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * grid).cast("int"), F.least(F.floor(F.col("hi") * grid), F.lit(grid - 1)).cast("int"))).alias("cell"))
    slots = spark.range(blocks).select("id", ((F.col("id") + 1) * F.lit(GOLDEN) % 1.0).alias("x"))
    slots = slots.withColumn("cell", F.least(F.floor(F.col("x") * grid), F.lit(grid - 1)).cast("int"))
    hit = (slots.join(cells, "cell").filter((F.col("x") >= F.col("lo")) & (F.col("x") < F.col("hi")))
           .select("source", "id", F.floor(F.col("id") / SLOT_CHUNK).cast("long").alias("chunk")))
    per_chunk = hit.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_chunk.select(F.col("source").alias("_s"), F.col("chunk").alias("_c"),
                              F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("source", "chunk").orderBy("id")
    return (hit.withColumn("_in", F.row_number().over(inside) - 1)
            .join(starts, (F.col("source") == F.col("_s")) & (F.col("chunk") == F.col("_c")))
            .select("source", F.col("id").alias("slot"), (F.col("_start") + F.col("_in")).alias("rank")))


def _group_name() -> Column:
    """The source as a join key: NULL is a name that no string can equal."""
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))


def mix(docs: DataFrame, cycle: Sequence[int] = WEIGHT_CYCLE, epochs: int = MAX_EPOCHS,
        block_words: int = BLOCK_WORDS) -> DataFrame:
    """How many words of every document the mix takes.

    Output: doc_id, size, source_size, target, taken.

    1. Sizes per source (partial aggregate) and their capped targets.
    2. A source's documents are shuffled by a hash, laid end to end (prefix sums over
       hash buckets, so a source with a third of the rows is many tasks) and cut into
       equal blocks of about ``block_words`` words (its size / its number of blocks).
       Its target is a whole number of blocks, its quota.
    3. Slots, each mapped to a source by a golden-ratio point through the cumulative
       quotas, are ranked per source; the k-th slot of a source takes its block k modulo
       its number of blocks.  There are an eighth more slots than blocks to take, and a
       source stops at its quota; a source whose quota is below ``FEW_BLOCKS`` is too thin for the
       points to meet it exactly and takes its quota in the same order without them.
       Uses per block and the pieces of documents in the block meet in an equi-join on
       (source, block).

    A block is used ``epochs`` times at most, so no document is taken more often.  Every
    target is met to half a block.  NULL text has size 0 and takes nothing; NULL
    sources are one source, ordered last; repeated rows count separately; an empty
    table gives no rows; other columns are ignored.  The result depends on ids and
    sizes only, so reruns agree.
    """
    plain = checkpointed(docs.select("doc_id", _group_name().alias("_src"), word_count("text").alias("size")))
    sizes = plain.groupBy("_src").agg(F.sum("size").alias("source_size"))
    targets = capped_targets(sizes.withColumn("source", F.when(F.col("_src") != "n", F.expr("substring(_src, 2)"))),
                             cycle, epochs).withColumn("_src", _group_name())
    # blocks: the first _longer ones hold _block + 1 words, the others _block
    targets = (targets.withColumn("_n", F.ceil(F.col("source_size") / block_words))
               .withColumn("_quota", F.round(F.col("target") * F.col("_n") / F.nullif("source_size", F.lit(0))))
               .withColumn("_block", F.expr("source_size div nullif(_n, 0)"))
               .withColumn("_longer", F.expr("source_size % nullif(_n, 0)")))
    every = Window.partitionBy(F.lit(1))
    upto = Window.orderBy("_src").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    many = F.when(F.col("_quota") >= FEW_BLOCKS, F.col("_quota")).otherwise(0.0)
    targets = checkpointed(targets.drop("source").withColumn("_share", many)
                           .withColumn("_hi", F.sum("_share").over(upto)).withColumn("_all", F.sum("_share").over(every)))
    total = targets.agg(F.sum("_share")).first()[0] or 0
    shares = targets.filter(F.col("_share") > 0).select(
        F.col("_src").alias("source"), F.greatest((F.col("_hi") - F.col("_share")) / F.col("_all"), F.lit(0.0)).alias("lo"),
        (F.col("_hi") / F.col("_all")).alias("hi"))
    slots = source_slots(shares, docs.sparkSession, int(total) + -(-int(total) // 8))
    quotas = targets.select(F.col("_src").alias("_qs"), F.col("_n").alias("n_blocks"), F.col("_quota").cast("long").alias("quota"))
    drawn = (slots.join(quotas, F.col("source") == F.col("_qs")).filter(F.col("rank") < F.col("quota"))
             .select("source", "rank", "n_blocks"))
    few = (quotas.filter((F.col("quota") > 0) & (F.col("quota") < FEW_BLOCKS))
           .select(F.col("_qs").alias("source"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("rank"), "n_blocks"))
    uses = (drawn.unionByName(few).groupBy(F.col("source").alias("_us"), (F.col("rank") % F.col("n_blocks")).alias("_ub"))
            .agg(F.count(F.lit(1)).alias("uses")))
    laid = rank_in_group(plain.filter(F.col("size") > 0), "_src", ["doc_id", "size"], "at", running="size")
    cut = targets.select(F.col("_src").alias("_cs"), "_block", "_longer")

    def block_of(word: str) -> Column:
        return F.expr(f"IF({word} < _longer * (_block + 1), ({word}) div (_block + 1), "
                      f"_longer + ({word} - _longer * (_block + 1)) div _block)")

    # sources are few beside documents: the planner broadcasts them by their size, or AQE splits a hot one
    parts = (laid.join(cut, F.col("_src") == F.col("_cs"))
             .select("_src", "doc_id", "size", "at", "_block", "_longer",
                     F.explode(F.sequence(block_of("at"), block_of("at + size - 1"))).alias("block")))
    start = F.expr("block * _block + least(block, _longer)")
    stop = F.expr("(block + 1) * _block + least(block + 1, _longer)")
    inside = F.least(F.col("at") + F.col("size"), stop) - F.greatest(F.col("at"), start)
    taken = (parts.withColumn("_inside", inside)
             .join(uses, (F.col("_src") == F.col("_us")) & (F.col("block") == F.col("_ub")), "left")
             .groupBy("_src", "at", "doc_id", "size")
             .agg(F.coalesce(F.sum(F.col("_inside") * F.col("uses")), F.lit(0)).cast("long").alias("taken")).drop("at"))
    empty = plain.filter(F.col("size") == 0).select("_src", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return (taken.unionByName(empty).join(targets.select("_src", "source_size", "target"), "_src")
            .select("doc_id", "size", "source_size", "target", "taken"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as the mix takes them: each one repeated round(taken / size) times
    (0 to 3), whole texts, all columns as they are.  Sources keep their targets up to
    the documents at the edge of the last epoch.  Rows repeated with one id and size
    take the mean of their group; rows without words are not taken by the mix."""
    key, size, copies, n = (fresh(f"_mix_{c}", docs) for c in ("id", "size", "copies", "n"))
    plan = (mix(docs).filter(F.col("size") > 0)
            .groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(key), F.col("size").alias(size))
            .agg(F.round(F.sum("taken") / F.sum("size")).cast("int").alias(copies))
            .filter(F.col(copies) > 0))
    rows = docs.withColumn(size, word_count("text")).withColumn(key, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return (rows.join(plan, [key, size])
            .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns))
