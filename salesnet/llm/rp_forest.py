"""Embedding near-dedup with a forest of random-projection trees, and exact block pairs for
groups larger than a leaf."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesnet.llm.common import checkpointed, out_batch
from salesnet.llm.components import connected_components

THRESHOLD = 0.93
TREES = 8             # trees of a label that one cell holds, and of all groves together beyond
GROVES = 4            # groves of trees: the trees of one share their upper splits
SPILL = 0.06          # share of a node's rows on either side of the median that goes both ways
LEAF_ROWS = 1500      # rows of a leaf
CELL_ROWS = 8192      # estimated rows of a label below one node of the upper splits: the rows of one task
FIT_ROWS = 20_000     # bound of the sample the upper splits are fitted on
MIN_FIT_LEAF = 16     # sampled rows below which a node is not split
DENSE_SHARE = 0.25    # share of LEAF_ROWS: a row with more estimated neighbours is kept out of the trees
MIN_FIT_DENSE = 4     # sampled neighbours such a row has at least
PAIR_ROWS = 4096      # estimated rows of one block of a cell that is compared in pairs of blocks
BLOCK = 1024


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision (scaled by the largest entry first)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Splits:
    """Recursive random splits: directions, spill bounds and children by node number.  A node is
    split while ``size`` of its rows is above ``most``."""

    def __init__(self, x: np.ndarray, size, most: float, seed: int, fewest: int = 1):
        rng = np.random.default_rng(seed)
        self.direction, self.low, self.high, self.left, self.right, self.size = [], [], [], [], [], []
        self._split(x, np.arange(len(x)), size, most, fewest, rng)

    def _split(self, x, own, size, most, fewest, rng) -> int:
        node = len(self.left)
        self.direction.append(None)
        self.size.append(size(own))
        for column in (self.low, self.high):
            column.append(0.0)
        for column in (self.left, self.right):
            column.append(-1)
        if self.size[node] > most and len(own) > fewest:
            d = rng.standard_normal(x.shape[1])
            at = x[own] @ d
            low, high = np.quantile(at, [0.5 - SPILL, 0.5 + SPILL])
            down, up = own[at <= high], own[at >= low]
            if len(down) < len(own) and len(up) < len(own):
                self.direction[node], self.low[node], self.high[node] = d, low, high
                self.left[node] = self._split(x, down, size, most, fewest, rng)
                self.right[node] = self._split(x, up, size, most, fewest, rng)
        return node

    def leaves(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, its rows in order) of the leaves that hold a row."""
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            if not len(own):
                continue
            if self.left[node] < 0:
                yield node, own
                continue
            at = x[own] @ self.direction[node]
            todo.append((self.left[node], own[at <= self.high[node]]))
            todo.append((self.right[node], own[at >= self.low[node]]))


class Groves:
    """The upper splits of each grove.  A label estimated at ``CELL_ROWS`` rows at most is one
    cell; the others share the splits, down to nodes that hold as many of one label."""

    def __init__(self, sample: np.ndarray, label: np.ndarray, rows_each: float, groves: int):
        values, at = np.unique(label, return_inverse=True)
        many = np.bincount(at, minlength=len(values)) * rows_each > CELL_ROWS
        self.large = values[many]
        self.all_large = rows_each > CELL_ROWS / 16  # too thin a sample to call any label small
        own = np.ones(len(sample), dtype=bool) if self.all_large else many[at]
        x, of = sample[own], at[own]
        self.trees = [Splits(x, lambda rows: rows_each * np.bincount(of[rows], minlength=1).max(), CELL_ROWS, 1000 + g, MIN_FIT_LEAF)
                      for g in range(groves)]
        self.blocks = [[1 if most <= 2 * CELL_ROWS else int(np.ceil(most / PAIR_ROWS)) for most in tree.size] for tree in self.trees]

    def cells(self, x: np.ndarray, label: np.ndarray) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
        """(grove, cell, blocks, trees, rows).  A node that the sample could not split far enough
        is compared as pairs of blocks, without trees."""
        large = np.ones(len(x), dtype=bool) if self.all_large else np.isin(label, self.large)
        yield 0, -1, 1, TREES, np.flatnonzero(~large)
        large = np.flatnonzero(large)
        for g, tree in enumerate(self.trees):
            if g and tree.left[0] < 0:
                return  # nothing was split: one grove holds every pair
            each = TREES if tree.left[0] < 0 else -(-TREES // len(self.trees))
            for node, own in tree.leaves(x[large]):
                yield g, node, self.blocks[g][node], each, large[own]


class Dense:
    """Centres of the groups that a tree would cut, found on the sample by label.

    A sampled row with ``DENSE_SHARE`` of a leaf as neighbours gets a centre within the
    threshold angle.  A row that close to a centre is inside: all its neighbours are
    within twice the angle, so the cell of these rows holds every pair of a row inside,
    and no tree needs it."""

    def __init__(self, sample: np.ndarray, label: np.ndarray, rows_each: float, threshold: float):
        self.threshold = threshold
        self.reach = 2 * threshold * threshold - 1 - 1e-9 if threshold > 0 else -1.1
        need = max(MIN_FIT_DENSE, int(np.ceil(DENSE_SHARE * LEAF_ROWS / rows_each)))
        centres, labels, rows = [], [], []
        for value in np.unique(label):
            own = sample[label == value]
            if len(own) <= need:
                continue
            near = np.concatenate([(own[at:at + BLOCK] @ own.T >= threshold).sum(axis=1) - 1 for at in range(0, len(own), BLOCK)])
            todo = near >= need
            while todo.any():
                first = int(np.argmax(np.where(todo, near, -1)))
                centre = _unit(own[own @ own[first] >= threshold].mean(axis=0, keepdims=True))[0]
                if centre @ own[first] < threshold:
                    centre = own[first]
                at = own @ centre
                todo &= at < threshold
                todo[first] = False
                centres.append(centre)
                labels.append(value)
                rows.append((at >= self.reach).sum() * rows_each)
        self.centre = np.array(centres).reshape(-1, sample.shape[1])
        self.label = np.array(labels, dtype=np.int64)
        self.blocks = np.maximum(1, np.ceil(np.array(rows) / PAIR_ROWS)).astype(np.int32)

    def cells(self, x: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, centre) for every centre in reach of a row, and which rows are inside."""
        rows, found, inside = [], [], np.zeros(len(x), dtype=bool)
        for at in range(0, len(x) if len(self.centre) else 0, BLOCK):
            near = np.where(label[at:at + BLOCK, None] == self.label[None, :], x[at:at + BLOCK] @ self.centre.T, -2.0)
            inside[at:at + BLOCK] = (near >= self.threshold).any(axis=1)
            r, c = np.nonzero(near >= self.reach)
            rows.append(r + at)
            found.append(c)
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *rows]), np.concatenate([none, *found]), inside


def fit(sample: np.ndarray, label: np.ndarray, rows: int, threshold: float, groves: int) -> tuple[Dense, Groves]:
    """The dense centres, and the upper splits of the sampled rows that are not inside one."""
    each = max(1.0, rows / max(1, len(sample)))
    dense = Dense(sample, label, each, threshold)
    rest = ~dense.cells(sample, label)[2]
    return dense, Groves(sample[rest], label[rest], each, groves)


def _assign(fitted, number: pa.DataType):
    """Arrow batches of (class_id, label, copies, v) to one row per cell a class falls into: the
    dense centres in reach (grove -1), and outside them a cell of each grove or, by spill, several.
    ``earlier`` names the cells of a class before this one."""
    schema = pa.schema([("grove", pa.int32()), ("cell", pa.int32()), ("blocks", pa.int32()), ("trees", pa.int32()),
                        ("class_id", pa.int64()), ("label", pa.int64()), ("copies", pa.int64()), ("dim", pa.int32()),
                        ("v", pa.list_(number)), ("earlier", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, label, copies, v = (batch.column(i) for i in range(4))
            lengths = v.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths):
                own = np.flatnonzero(lengths == dim)
                x = _unit(_matrix(v.take(pa.array(own)), int(dim)))
                dense, groves = fitted.value[int(dim)]
                of = label.to_numpy(zero_copy_only=False)[own]
                rows, centre, inside = dense.cells(x, of)
                seen = [[] for _ in own]
                open_ = np.flatnonzero(~inside)
                cells = [(-1, c, int(dense.blocks[c]), 0, rows[centre == c]) for c in np.unique(centre)]
                cells += [(g, c, b, t, open_[r]) for g, c, b, t, r in groves.cells(x[open_], of[open_])]
                for g, c, b, t, rows in cells:
                    if not len(rows):
                        continue
                    earlier = [tuple(seen[r]) for r in rows.tolist()]
                    for r in rows.tolist():
                        seen[r].append((g + 1) << 40 | c + 1)
                    at, k = pa.array(own[rows]), len(rows)
                    yield out_batch(schema, grove=np.full(k, g, np.int32), cell=np.full(k, c, np.int32),
                                    blocks=np.full(k, b, np.int32), trees=np.full(k, t, np.int32), class_id=ids.take(at),
                                    label=label.take(at), copies=copies.take(at), dim=np.full(k, dim, np.int32),
                                    v=v.take(at), earlier=pa.array(earlier, type=pa.list_(pa.int64())))

    return run


def _matrix(v: pa.Array, dim: int) -> np.ndarray:
    """Lists of ``dim`` numbers each as rows of doubles."""
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _padded(lists: pa.Array) -> np.ndarray:
    """Lists as rows of a matrix, -1 where they are shorter."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.full((len(lengths), int(lengths.max(initial=0))), -1, dtype=np.int64)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Every pair (a, b) gets one root, the smallest, in ``root``."""
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root[:] = root[root]


def _cell_links(threshold: float, leaf_rows: int):
    """The links inside one cell of a label, or between two blocks of one, cosine in double
    precision: per class the copies it is linked to for the first time (no earlier cell holds
    both), and one link to its group.

    A cell with ``trees`` and more rows than a leaf is split on by trees of its own, and rows
    are compared inside leaves; a pair that shares several leaves is marked once.  The marks
    are held for ``BLOCK`` rows at a time."""
    schema = pa.schema([("class_id", pa.int64()), ("links", pa.int64()), ("to", pa.int64())])

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by("class_id").combine_chunks()
        column = {c: cell.column(c).combine_chunks() for c in cell.column_names}
        ids, copies, block, n = column["class_id"].to_numpy(), column["copies"].to_numpy(), column["block"].to_numpy(), cell.num_rows
        i, j, trees, dim = (column[c][0].as_py() for c in ("i", "j", "trees", "dim"))
        x, codes = _unit(_matrix(column["v"], dim)), _padded(column["earlier"])
        if trees and i == j == 0 and n > leaf_rows:
            seed = (column["grove"][0].as_py() + 1) * 100_003 + column["cell"][0].as_py() + 1
            leaves = [(own, own) for t in range(trees) for _, own in Splits(x, len, leaf_rows, seed * TREES + t).leaves(x)]
        else:
            leaves = [(np.flatnonzero(block == i), np.flatnonzero(block == j))]
        links, root = np.zeros(n, dtype=np.int64), np.arange(n)
        for start in range(0, n, BLOCK):
            stop = min(n, start + BLOCK)
            near = np.zeros((stop - start, n), dtype=bool)
            for a, b in leaves:
                a = a[np.searchsorted(a, start):np.searchsorted(a, stop)]
                if i == j:  # each pair from its smaller row
                    b = b[np.searchsorted(b, start):]
                if len(a) and len(b):
                    r, c = np.nonzero(x[a] @ x[b].T >= threshold)
                    near[a[r] - start, b[c]] = True
            r, c = np.nonzero(near)
            r += start
            if i == j:
                r, c = r[r < c], c[r < c]
            _unite(root, r, c)
            new = np.ones(len(r), dtype=bool)
            for k in range(codes.shape[1]):
                for m in range(codes.shape[1]):
                    new &= (codes[r, k] != codes[c, m]) | (codes[r, k] < 0)
            r, c = r[new], c[new]
            np.add.at(links, r, copies[c])
            np.add.at(links, c, copies[r])
        some = (links > 0) | (root != np.arange(n))
        return pa.table([ids[some], links[some], ids[root[some]]], schema=schema)

    return run


def embedding_components(vectors: DataFrame, threshold: float = THRESHOLD, groves: int = GROVES) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector.

    1. Equal vectors of a label are one class with a count of copies (partial
       aggregate): copies are never compared with one another.
    2. Centres of dense groups and the upper splits of ``GROVES`` groves of trees are
       fitted on at most ``FIT_ROWS`` classes (the smallest by hash) and are the only thing
       broadcast.  A class inside a dense group goes to the cells of the centres in reach
       and to no tree, so no split cuts such a group; its links are exact.  The others go
       to a cell of each grove, with about ``CELL_ROWS`` rows of a label, or to several:
       rows within ``SPILL`` of a median take both sides.  A label below that size is one
       cell, so that its vectors are shuffled once.
    3. A cell is one task's work: it is split on by random trees fitted on all its rows
       (``TREES`` in all groves together), and classes of one leaf are compared by cosine in double
       precision.  A dense cell, or a node the sample could not split, that is estimated
       above ``PAIR_ROWS`` rows is compared as pairs of hashed blocks, a task each.  A pair
       that meets in several cells counts in the first of them, so a task returns one row
       per class (its new links, one link to its group), not pairs.  The comparisons
       inside a dense group grow with the square of its distinct vectors.
    4. Components of the links, joined back to the vectors.

    A vector that is NULL, all zero, or holds a NULL or non-finite component, and one
    without label, links with nothing: n_links 0, its own component.  Vectors of
    different lengths are not compared.  Rows without vec_id keep component NULL and are
    kept.  Repeated rows count as copies.  An empty table gives no rows; other columns
    are ignored.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    usable = (F.size(v) > 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) & F.exists(v, lambda x: x != 0.0)
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType(), vectors.schema["embedding"].dataType.containsNull)
    kind, number = ("float", pa.float32()) if single else ("double", pa.float64())  # floats travel as floats
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast(f"array<{kind}>").alias("v"))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.filter("usable").drop("usable").withColumn("h", F.xxhash64("label", "v"))
    classes = checkpointed(good.groupBy("h", "label", "v").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("class_id", F.monotonically_increasing_id()))  # ids may repeat with other vectors, classes not
    total = {r[0]: r[1] for r in classes.groupBy(F.size("v")).agg(F.count(F.lit(1))).collect()}
    sample = classes.orderBy(F.xxhash64("h"), "first_id").limit(FIT_ROWS).select("v", "label").collect()
    fitted = {}
    for dim, n in total.items():
        own = [r for r in sample if len(r[0]) == dim]
        x = np.array([r[0] for r in own], dtype=np.float64).reshape(-1, dim)
        fitted[dim] = fit(_unit(x) if len(x) else x, np.array([r[1] for r in own], dtype=np.int64), n, threshold, groves)
    shared = spark.sparkContext.broadcast(fitted)
    placed = classes.select("class_id", "label", "copies", "v").mapInArrow(
        _assign(shared, number), "grove int, cell int, blocks int, trees int, class_id long, label long, copies long, "
                                 f"dim int, v array<{kind}>, earlier array<long>")
    placed = (placed.withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
              .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("i", F.least("block", "_with")).withColumn("j", F.greatest("block", "_with")).drop("blocks", "_with"))
    found = checkpointed(placed.groupBy("grove", "cell", "dim", "label", "i", "j").applyInArrow(
        _cell_links(threshold, LEAF_ROWS), "class_id long, links long, to long"))
    counts = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("class_id", "to"), "class_id", "to")
    labelled = (classes.select("class_id", "first_id", "copies")
                .join(counts, "class_id", "left").join(parts, F.col("class_id") == F.col("node"), "left")
                .withColumn("c", F.coalesce("component", "class_id")))
    smallest = labelled.groupBy(F.col("c").alias("_c")).agg(F.min("first_id").alias("component_id"))
    of_class = (labelled.join(smallest, F.col("c") == F.col("_c"))
                .select(F.col("class_id").alias("_class"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        "component_id"))
    named = classes.select(F.col("h").alias("_h"), F.col("label").alias("_label"), F.col("v").alias("_v"), "class_id")
    same = (F.col("h") == F.col("_h")) & (F.col("label") == F.col("_label")) & (F.col("v") == F.col("_v"))
    linked = (good.join(named, same).select("vec_id", "class_id")
              .join(of_class, F.col("class_id") == F.col("_class")).select("vec_id", "n_links", "component_id"))
    alone = rows.filter(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                 F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
