"""Quality classifier: gated-attention multiple-instance learning over passages."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesnet.llm.common import fresh, held_out, id_remainder, out_batch, pieces, text_of, word_count, words_of
from salesnet.llm.rules_forest import labelled_rows

PASSAGE_WORDS = 64
HIDDEN = 16
FIT_ROWS = 6_000       # bound of the labelled sample the network is fitted on
FIT_PASSAGES = 90_000  # bound of its passages: a document that would pass it is left out whole, in hash order
EPOCHS = 250
KEEP_SCORE = 0.7
FOLD, HELD = 4, 2

# Byte classes of a passage: one code per group below, 0 for everything else.
_GROUPS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",", "!", "?", "|", "#*$%&", "<>",
           "-_", "'\"()[]{}", "=:;/\\@"]
N_CLASSES = len(_GROUPS) + 2
BYTE_CLASS = np.zeros(256, dtype=np.int64)
for _i, _g in enumerate(_GROUPS):
    BYTE_CLASS[[ord(_c) for _c in _g]] = _i + 1
BYTE_CLASS[128:] = N_CLASSES - 1
N_FEATURES = N_CLASSES + 6


def _word_table(words: pa.Array) -> np.ndarray:
    """Per distinct word the counts of its byte classes."""
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32, count=n + 1 + words.offset)[words.offset:]
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]] if n else np.zeros(0, np.uint8)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    return np.bincount(owner * N_CLASSES + BYTE_CLASS[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES).astype(np.float32)


def encode_passages(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text of each passage, its features).  Passages are runs of ``PASSAGE_WORDS``
    words and cover the whole text; a text without words is one passage of zeros."""
    n = len(text)
    rows, codes, words = words_of(text)
    count = np.bincount(rows, minlength=n)
    first = np.r_[0, np.cumsum(count)[:-1]]
    per = np.maximum(1, -(-count // PASSAGE_WORDS))
    owner = np.repeat(np.arange(n), per)
    out = np.zeros((len(owner), N_FEATURES), dtype=np.float32)
    if len(codes):
        base = np.r_[0, np.cumsum(per)[:-1]]
        passage = base[rows] + (np.arange(len(rows)) - first[rows]) // PASSAGE_WORDS
        starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        at = passage[starts]
        table = _word_table(words)
        letters, alnum = table[:, 1] + table[:, -1], table[:, 1] + table[:, 2] + table[:, 3] + table[:, -1]
        flags = np.stack([alnum == 0, (table[:, 2] >= 2) & (table[:, 1] == 0)], axis=1).astype(np.float32)
        # words that repeat the word before, and word pairs seen before in the text
        same = np.r_[False, (codes[1:] == codes[:-1]) & (rows[1:] == rows[:-1])]
        pair = np.r_[-1, codes[:-1] * len(words) + codes[1:]]
        pair[first[count > 0]] = -1
        seen = np.ones(len(codes), dtype=bool)
        key = np.lexsort((pair, rows))
        seen[key[np.r_[True, (pair[key][1:] != pair[key][:-1]) | (rows[key][1:] != rows[key][:-1])]]] = False
        n_words = np.diff(np.r_[starts, len(codes)]).astype(np.float32)
        classes = np.add.reduceat(table[codes], starts, axis=0)
        n_bytes = np.maximum(classes.sum(axis=1), 1)
        rates = np.add.reduceat(np.column_stack([flags[codes], same, seen & (pair >= 0)]).astype(np.float32), starts, axis=0)
        out[at, :N_CLASSES] = np.sqrt(classes / n_bytes[:, None])
        out[at, N_CLASSES:N_CLASSES + 4] = rates / n_words[:, None]
        out[at, N_CLASSES + 4] = np.log(n_bytes / n_words)
        out[at, N_CLASSES + 5] = np.log1p(n_words) / 4
    return owner, out


class GatedAttention:
    """h = tanh(x W); weight ~ softmax over a document of u . (tanh(h V) * sigmoid(h G));
    score = sigmoid(c . sum(weight * h) + b).  Trained on document labels only."""

    def __init__(self, x: np.ndarray, owner: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-3) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
        d, k = N_FEATURES, HIDDEN
        self.p = {"W": rng.normal(0, 0.2, (d, k)), "V": rng.normal(0, 0.3, (k, k)), "G": rng.normal(0, 0.3, (k, k)),
                  "u": rng.normal(0, 0.3, k), "c": rng.normal(0, 0.3, k), "b": np.zeros(1), "a": np.zeros(k)}
        self.prior = float(label.mean()) if len(label) else 0.5
        self.trained = len(label) > 0 and 0 < label.sum() < len(label)
        m = {n: np.zeros_like(v) for n, v in self.p.items()}
        v2 = {n: np.zeros_like(v) for n, v in self.p.items()}
        if self.trained:
            x = self._scaled(x)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            for t in range(1, epochs + 1):
                for n, g in self._gradient(x, owner, starts, label).items():
                    m[n] = 0.9 * m[n] + 0.1 * g
                    v2[n] = 0.999 * v2[n] + 0.001 * g * g
                    self.p[n] -= 0.03 * (m[n] / (1 - 0.9 ** t)) / (np.sqrt(v2[n] / (1 - 0.999 ** t)) + 1e-8)

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _forward(self, x, owner, starts):
        p = self.p
        h = np.tanh(x @ p["W"] + p["a"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["G"])))
        e = (t * s) @ p["u"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[owner])
        w = e / np.add.reduceat(e, starts)[owner]
        z = np.add.reduceat(w[:, None] * h, starts, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -40, 40)))
        return h, t, s, w, z, y

    def _gradient(self, x, owner, starts, label):
        p = self.p
        h, t, s, w, z, y = self._forward(x, owner, starts)
        dy = (y - label) / len(label)
        dz = dy[:, None] * p["c"]
        dh = w[:, None] * dz[owner]
        dw = (dz[owner] * h).sum(axis=1)
        de = w * (dw - np.add.reduceat(w * dw, starts)[owner])
        dts = de[:, None] * p["u"]
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        dh += dt @ p["V"].T + ds @ p["G"].T
        dx = dh * (1 - h * h)
        decay = 1e-5
        return {"W": x.T @ dx + decay * p["W"], "a": dx.sum(axis=0), "V": h.T @ dt, "G": h.T @ ds,
                "u": (t * s).T @ de, "c": z.T @ dy + decay * p["c"], "b": np.array([dy.sum()])}

    def score(self, x: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """One score per document (``owner`` ascending, every document with a passage)."""
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, int)
        if not self.trained or not len(starts):
            return np.full(len(starts), self.prior)
        return self._forward(self._scaled(x), owner, starts)[-1]


def fit_documents(sample: DataFrame) -> list[tuple[int, int]]:
    """(id, hash of the text) of the sampled documents that fit into ``FIT_PASSAGES``, taken in the
    order of a hash of the id; one that would pass the bound is left out whole and the next ones
    are tried.  An id with several texts: the text of the smallest hash."""
    parts = F.greatest(F.lit(1), F.ceil(word_count("text") / PASSAGE_WORDS)).cast("long")
    rows = (sample.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min(F.struct(F.xxhash64("text").alias("h"), parts.alias("n"))).alias("s"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id", "s.h", "s.n").collect())
    room, chosen = FIT_PASSAGES, []
    for r in rows:
        if r["n"] <= room:
            room -= r["n"]
            chosen.append((r["doc_id"], r["h"]))
    return chosen


def fit_quality(docs: DataFrame, labels: DataFrame) -> GatedAttention:
    """The network, from the whole texts of at most ``FIT_ROWS`` labelled documents outside the held-out fold."""
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int64()), ("part", pa.int32()),
                        ("x", pa.list_(pa.float32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            owner, x = encode_passages(text_of(batch))
            at = pa.array(owner)
            part = np.arange(len(owner)) - np.searchsorted(owner, owner)
            yield out_batch(schema, doc_id=batch.column(0).take(at), quality=batch.column(1).take(at),
                            part=part.astype(np.int32), x=pa.array(list(x), type=pa.list_(pa.float32())))

    sample = labelled_rows(docs, labels, FIT_ROWS, id_remainder("doc_id", FOLD) != HELD)
    chosen = docs.sparkSession.createDataFrame(fit_documents(sample), "_fit_id long, _fit_text long")
    rows = (sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long"), "text")
            .join(F.broadcast(chosen), (F.col("doc_id") == F.col("_fit_id")) & (F.xxhash64("text") == F.col("_fit_text")))
            .select("doc_id", "quality", "text")
            .mapInArrow(run, "doc_id long, quality long, part int, x array<float>")
            .groupBy("doc_id", "part").agg(F.min("quality").alias("quality"), F.min("x").alias("x"))  # repeated rows once
            .toPandas().sort_values(["doc_id", "part"]).reset_index(drop=True))
    ids, owner = np.unique(rows["doc_id"].to_numpy(dtype=np.int64), return_inverse=True)
    order = np.argsort(owner, kind="stable")
    x = np.stack(rows["x"].to_numpy()).astype(float)[order] if len(rows) else np.zeros((0, N_FEATURES))
    label = np.zeros(len(ids))
    label[owner] = rows["quality"].to_numpy(dtype=float)
    return GatedAttention(x, owner[order], label)


def scored(docs: DataFrame, model: GatedAttention, name: str) -> DataFrame:
    """All columns of ``docs`` and the score as ``name``: every passage of every whole text encoded,
    no shuffle; the network (a few thousand numbers) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            owner, x = encode_passages(text_of(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(x, owner), type=pa.float64())],
                                             names=[*names, name])

    return docs.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{name}` double"]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``KEEP_SCORE``) of every document.

    Labels are used only of documents whose crc32(id) mod 4 is not 2, and only by
    ``fit_quality``; the score of a document is a function of its text.  NULL text
    counts as empty and has a score too.  Without labels of both kinds every score is
    the share of label 1 (0.5 without labels).  Rows without id are not held out;
    repeated rows repeat; an empty table gives no rows; other columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scored(slim, fit_quality(docs, labels), "score").select(
        "doc_id", held_out("doc_id", FOLD, HELD).alias("held_out"), "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be of quality 1, all columns."""
    name = fresh("_quality_score", docs)
    return scored(docs, fit_quality(docs, labels), name).filter(F.col(name) >= KEEP_SCORE).select(*docs.columns)
