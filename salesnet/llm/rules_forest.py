"""Quality rules: rule statistics per document, judged by an isolation forest."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesnet.llm.common import WORD_SEPARATORS, fresh, out_batch, per_row, pieces, text_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
TREES = 100
TREE_ROWS = 256
FIT_ROWS = 20_000      # bound of the labelled sample the forest is fitted on
SCORE_STEPS = 100_000  # steps of the score that the threshold is chosen from

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper_words", "n_bare", "n_shouts")
FEATURES = ("symbols", "upper", "bare", "shouts", "repeats", "word_length")
DEPTH = 10


def _repeated_words(rows: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """Per text the words covered by 5-word windows found twice or more in it."""
    w = len(codes) - WINDOW + 1
    if w < 1:
        return np.zeros(n, dtype=np.int64)
    inside = np.flatnonzero(rows[:w] == rows[WINDOW - 1:])
    if not len(inside):
        return np.zeros(n, dtype=np.int64)
    with np.errstate(over="ignore"):
        key = rows[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(WINDOW):
            key = (key ^ (codes[inside + k].astype(np.uint64) + np.uint64(1))) * np.uint64(0xD6E8FEB86659FD93)
            key ^= key >> np.uint64(32)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    a, b = inside[order][:-1][same], inside[order][1:][same]
    equal = rows[a] == rows[b]
    for k in range(WINDOW):
        equal &= codes[a + k] == codes[b + k]
    if not equal.all():  # two different windows share a hash: sort the windows themselves
        table = np.stack([rows[inside], *[codes[inside + k] for k in range(WINDOW)]], axis=1)
        _, at, count = np.unique(table, axis=0, return_inverse=True, return_counts=True)
        twice = inside[count[at.ravel()] > 1]
    else:
        twice = np.unique(np.concatenate([a, b]))
    cover = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return per_row(rows[covered], n)


def _stats(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    text, n = text_of(batch), batch.num_rows
    rows, codes, words = words_of(text)

    def total(values: pa.Array) -> np.ndarray:
        v = values.to_numpy(zero_copy_only=False).astype(np.int64)
        return per_row(rows, n, v[codes]).astype(np.int64) if len(codes) else np.zeros(n, np.int64)

    letters = pc.match_substring_regex(words, r"\p{Lu}\P{Ll}*\p{Lu}")
    upper = pc.and_(letters, pc.invert(pc.match_substring_regex(words, r"\p{Ll}")))
    lists = pc.split_pattern(text, "\n")
    lines, owner = lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.greater(pc.binary_length(pc.ascii_trim(lines, characters=WORD_SEPARATORS)), 0).to_numpy(zero_copy_only=False)
    coded = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner, coded = owner[full], coded[full]
    n_lines = per_row(owner, n)
    pair = np.unique(owner * (coded.max() + 1 if len(coded) else 1) + coded)
    distinct_lines = per_row(pair // (coded.max() + 1), n) if len(coded) else np.zeros(n, np.int64)
    return {
        "n_words": per_row(rows, n), "word_chars": total(pc.utf8_length(words)),
        "n_symbols": total(pc.count_substring_regex(words, f"[{SYMBOLS}]")),
        "n_dup_lines": n_lines - distinct_lines, "n_repeat_words": _repeated_words(rows, codes, n),
        "n_upper_words": total(upper.cast(pa.int64())),
        # words without letter or digit, and words that end in an exclamation mark
        "n_bare": total(pc.match_substring_regex(words, r"^[^\pL\pN]+$").cast(pa.int64())),
        "n_shouts": total(pc.match_substring_regex(words, r"!$").cast(pa.int64()))}


def rule_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the integer columns ``keep`` and the rule statistics of every whole text."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", *keep, *STATS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            yield out_batch(schema, **{c: batch.column(i) for i, c in enumerate(("doc_id", *keep))},
                            **{k: v.astype(np.int64) for k, v in _stats(batch).items()})

    return docs.select(*[F.col(c).cast("long").alias(c) for c in ("doc_id", *keep)], "text").mapInArrow(
        run, ", ".join(f"{f.name} long" for f in schema))


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Rule statistics as rates of the text (square roots, which spread the small ones)."""
    words = np.maximum(s["n_words"], 1).astype(float)
    chars = np.maximum(s["word_chars"], 1).astype(float)
    return np.stack([np.sqrt(s["n_symbols"] / chars), np.sqrt(s["n_upper_words"] / words), np.sqrt(s["n_bare"] / words),
                     np.sqrt(s["n_shouts"] / words), np.sqrt(s["n_repeat_words"] / words),
                     np.log(np.clip(chars / words, 1, 20))], axis=1)


class IsolationForest:
    """Random splits of small samples of ordinary rows; a short average path marks an anomaly.

    A cut is drawn uniformly from the node's box, which starts as the range of all rows
    given as ``box``, not from the range of the sample in it: space that ordinary rows
    leave empty is cut off near the root, and rows that lie there get short paths.
    """

    def __init__(self, x: np.ndarray, box: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, depth: int = DEPTH,
                 seed: int = 7):
        rng = np.random.default_rng(seed)
        self.depth = depth
        rows = min(rows, len(x))
        self.norm = float(_mean_path(np.array([max(rows, 2)]))[0])
        low, high = (box.min(axis=0), box.max(axis=0)) if len(box) else (np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
        self.trees = [self._grow(x[rng.choice(len(x), rows, replace=False)] if rows else x, low, high, rng)
                      for _ in range(trees)]

    def _grow(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        nodes: list[list[float]] = []  # feature, cut, left, right, path length if a row ends here

        def node(own: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, 0, 0, depth + float(_mean_path(np.array([len(own)]))[0])])
            if depth < self.depth and len(own) > 1 and (high > low).any():
                f = int(rng.choice(np.flatnonzero(high > low)))
                c = rng.uniform(low[f], high[f])
                below, above = high.copy(), low.copy()
                below[f] = above[f] = c
                is_low = own[:, f] < c
                nodes[at][:4] = [f, c, node(own[is_low], low, below, depth + 1), node(own[~is_low], above, high, depth + 1)]
            return at

        node(x, low, high, 0)
        table = np.array(nodes)
        return table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64), table[:, 4]

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): higher for anomalies."""
        total, every = np.zeros(len(x)), np.arange(len(x))
        for feature, cut, left, right, path in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = feature[at]
                go = np.where(x[every, np.maximum(f, 0)] < cut[at], left[at], right[at])
                at = np.where(f >= 0, go, at)
            total += path[at]
        return 2.0 ** -(total / len(self.trees) / self.norm)


def _mean_path(n: np.ndarray) -> np.ndarray:
    """Expected path length of an unsuccessful search among n rows (0 for an empty leaf)."""
    n = n.astype(float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), np.maximum(n - 1, 0))


# ---------------------------------------------------------------- fit and verdict

def labelled_rows(docs: DataFrame, labels: DataFrame, rows: int, condition=None) -> DataFrame:
    """(doc_id, text, quality) of at most ``rows`` labelled documents, the smallest by a
    hash of the id.  The chosen ids are bounded by ``rows``, so they are broadcast; the
    documents are filtered where they are read.  Repeated labels of an id: the lowest."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    if condition is not None:
        known = known.filter(condition)
    chosen = (known.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
            .select("doc_id", "text", "quality"))


def best_cut(low: np.ndarray, high: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """Score above which a row is rejected, from the lowest and highest score and the good
    and bad rows of each step of the score: the cut with the highest share of bad rows
    caught less the share of good rows lost, in the middle of its gap.  Nothing is rejected
    without both kinds of rows, or if no cut catches a larger share of bad rows than of good."""
    if len(low) < 2 or not good.sum() or not bad.sum():
        return float("inf")
    order = np.argsort(-low, kind="stable")
    low, high, good, bad = low[order], high[order], good[order], bad[order]
    gain = (np.cumsum(bad) * good.sum() - np.cumsum(good) * bad.sum())[:-1]
    at = int(np.argmax(gain))
    return float((low[at] + high[at + 1]) / 2) if gain[at] > 0 else float("inf")


def _base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def score_steps(docs: DataFrame, labels: DataFrame, forest: IsolationForest) -> DataFrame:
    """step, low, high, good, bad: all labelled documents that pass the base rules, by score
    in ``1 / SCORE_STEPS`` steps.  Texts are scored where they are read; ids and scores meet the labels."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            s = _stats(batch)
            ok = ~_base_failed(s)
            yield out_batch(schema, doc_id=batch.column(0).filter(pa.array(ok)), score=shared.value.score(features(s))[ok])

    scores = (docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
              .mapInArrow(run, "doc_id long, score double"))
    known = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("quality")))
    is_bad = (F.col("quality") == 0).cast("long")
    return (scores.join(known, F.col("doc_id") == F.col("_id"))
            .groupBy(F.floor(F.col("score") * SCORE_STEPS).alias("step"))
            .agg(F.min("score").alias("low"), F.max("score").alias("high"),
                 F.sum(1 - is_bad).alias("good"), F.sum(is_bad).alias("bad")))


def fit_rules(docs: DataFrame, labels: DataFrame) -> tuple[IsolationForest, float]:
    """The forest on at most ``FIT_ROWS`` labelled documents of quality 1 that pass the base
    rules, and its threshold on all labelled ones that do."""
    sample = labelled_rows(docs, labels, FIT_ROWS)
    rows = (rule_statistics(sample, "quality").groupBy("doc_id")  # one row an id, whatever repeats
            .agg(F.min(F.struct("quality", *STATS)).alias("s")).select("doc_id", "s.*").toPandas().sort_values("doc_id"))
    s = {c: rows[c].to_numpy(dtype=np.int64) for c in STATS}
    x, bad, ok = features(s), rows["quality"].to_numpy(dtype=float) == 0, ~_base_failed(s)
    x, bad = x[ok], bad[ok]
    forest = IsolationForest(x[~bad], x)
    if not len(x):
        return forest, float("inf")
    steps = score_steps(docs, labels, forest).toPandas()
    return forest, best_cut(steps["low"].to_numpy(dtype=float), steps["high"].to_numpy(dtype=float),
                            steps["good"].to_numpy(dtype=np.int64), steps["bad"].to_numpy(dtype=np.int64))


def judge(docs: DataFrame, model: tuple[IsolationForest, float], names: list[str]) -> DataFrame:
    """All columns of ``docs`` and, under ``names``, the base statistics, base_failed and
    kept: one pass over whole texts, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [*docs.columns, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, cut = shared.value
        for batch in pieces(batches, "text"):
            s = _stats(batch)
            failed = _base_failed(s)
            cols = [pa.array(s[c].astype(np.int64)) for c in STATS[:5]]
            cols += [pa.array(failed), pa.array(~failed & (forest.score(features(s)) <= cut))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=columns)

    types = ["long"] * 5 + ["boolean"] * 2
    return docs.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
                                          + [f"`{n}` {t}" for n, t in zip(names, types)]))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    The statistics come from every whole text in one pass over Arrow batches.  A document
    that passes the base rules is kept unless its isolation score is above the threshold
    that separates the labelled documents best.  The forest is fitted on at most
    ``FIT_ROWS`` labelled documents (chosen by a hash of the id), the threshold on all
    labelled ones, to ``1 / SCORE_STEPS`` of the score; they are the only thing broadcast.

    NULL or empty text has no words and fails the base rules.  Without labels of both
    kinds only the base rules reject.  Rows without id are judged like others; repeated
    rows repeat (the forest takes one row of an id); a score equal to the threshold is
    kept; an empty table gives no rows; other columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = [*STATS[:5], "base_failed", "kept"]
    return judge(slim, fit_rules(docs, labels), names).select("doc_id", *names)


def passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the quality rules keep, all columns."""
    names = [fresh(f"_rules_{n}", docs) for n in (*STATS[:5], "base_failed", "kept")]
    return judge(docs, fit_rules(docs, labels), names).filter(F.col(names[-1])).select(*docs.columns)
