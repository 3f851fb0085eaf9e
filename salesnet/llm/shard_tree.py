"""Hierarchical weighted hash tree: region, rack and shard by weighted hash draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesnet.llm.common import rank_in_group

# A topology is {region: {rack: {shard number: weight}}}; the weight of a rack or a
# region is the sum below it.
Topology = dict[str, dict[str, dict[int, float]]]
DRAW_DIGITS = 12  # hexadecimal digits of an MD5 used as one uniform draw


def topology(regions: int = 2, racks: int = 2, shards: int = 4, weight: float = 1.0) -> Topology:
    """An even tree with shards numbered from 0."""
    number = iter(range(regions * racks * shards))
    return {f"region{r}": {f"rack{k}": {next(number): weight for _ in range(shards)} for k in range(racks)}
            for r in range(regions)}


def grow(tree: Topology, weight: float = 1.0) -> Topology:
    """One more shard, in a region of its own: no existing subtree changes its weight,
    so the new shard takes rows only into itself and nothing moves between old ones."""
    top = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return {**tree, f"region-of-{top}": {"rack0": {top: weight}}}


def _draw(key: Column, node: str, weight: float) -> Column:
    """Exponential draw of rate ``weight`` for (key, node): -ln(u) / weight."""
    digest = F.substring(F.md5(F.concat(key, F.lit(f"|{node}")).cast("binary")), 1, DRAW_DIGITS)
    u = (F.conv(digest, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16 ** DRAW_DIGITS))
    return -F.log(u) / F.lit(float(weight))


def _first(key: Column, path: str, children: list[tuple[str, float]]) -> Column:
    """Index of the child with the smallest draw."""
    if len(children) == 1:
        return F.lit(0)
    draws = [F.struct(_draw(key, f"{path}/{name}", w).alias("d"), F.lit(i).alias("i"))
             for i, (name, w) in enumerate(children)]
    return F.array_min(F.array(*draws))["i"]


def _total(node) -> float:
    return sum(map(_total, node.values())) if isinstance(node, dict) else float(node)


def place(df: DataFrame, key: Column, tree: Topology, out: str) -> DataFrame:
    """Add ``out``: the shard of ``key``, by one weighted draw per level.

    A level compares only the children of the node chosen above it, so a changed
    weight moves keys only between the node whose weight changed and its siblings,
    and inside the subtree it leads to.  The tree is configuration (a handful of
    nodes written into the expression), not data.
    """
    regions = list(tree.items())
    df = df.withColumn("_region", _first(key, "", [(n, _total(t)) for n, t in regions]))
    rack = shard = None
    for i, (rn, racks) in enumerate(regions):
        pick = _first(key, f"/{rn}", [(n, _total(t)) for n, t in racks.items()])
        rack = F.when(F.col("_region") == i, pick) if rack is None else rack.when(F.col("_region") == i, pick)
    df = df.withColumn("_rack", rack)
    for i, (rn, racks) in enumerate(regions):
        for j, (kn, shards) in enumerate(racks.items()):
            numbers = F.array(*[F.lit(int(s)) for s in shards])
            at = F.element_at(numbers, _first(key, f"/{rn}/{kn}", [(str(s), w) for s, w in shards.items()]) + 1)
            here = (F.col("_region") == i) & (F.col("_rack") == j)
            shard = F.when(here, at) if shard is None else shard.when(here, at)
    return df.withColumn(out, shard).drop("_region", "_rack")


def shard_documents(docs: DataFrame, tree: Topology | None = None, weight: float = 1.0) -> DataFrame:
    """Every document's shard under ``tree`` and under the tree with one more shard.

    Output: doc_id, size (UTF-8 bytes + 1), text_crc32, law, shard, slot, grown_shard.
    Law ``key``: the id and the tree decide.  Built-in expressions only; the text is
    read once per use and never shuffled.  Slots number the rows of a shard from 0
    without one task per shard (``rank_in_group``).

    NULL text: size 1, checksum of the empty text.  NULL id: the key is the empty
    string.  Repeated ids share a shard and get slots of their own.  An empty table
    gives no rows.  Other columns are ignored, so their names cannot clash.
    """
    tree = tree or topology()
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = place(base, key, tree, "shard")
    placed = place(placed, key, grow(tree, weight), "grown_shard")
    ranked = rank_in_group(placed, "shard", ["doc_id", "text_crc32", "size"], "slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
