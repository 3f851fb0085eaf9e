"""Language-model scoring with an Elias-Fano n-gram trie in memory-mapped shards.

Level 1 holds the training words (sorted 64-bit hashes, a monotone sequence) with exact
counts and monotone pointers to level 2; level 2 holds, per context word, the ids of the
words that follow it (made monotone by adding the end of the context before) with
quantised smoothed log probabilities.  Shards are files in the shared checkpoint folder,
written by Spark tasks and memory-mapped by the tasks that score.
"""

from __future__ import annotations

import json
import uuid
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesnet.llm.common import held_out, id_remainder, out_batch, pieces, shared_folder, text_of, words_of

FOLD, HELD = 7, 2
PRIOR = 2.0            # weight of the unigram in a smoothed bigram
STEP = 12.0 / 65535    # log10 probabilities are kept as multiples of this
SPLIT = 8              # parts a context's bigrams are dealt over (by word id), so a hot context is several tasks
FLUSH = 3_000_000      # different n-grams a task holds before it sends them on
SHARD_TEXT = 128 << 20 # training text per level-1 shard, so that shards follow the model's size
SCORE_BYTES = 8 << 20  # text whose different bigrams are looked up together
END = xxhash.xxh64_intdigest(b"\n")  # no word holds white space
_U64 = np.uint64

# ---------------------------------------------------------------- succinct sequences

_POP = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_SEL = np.zeros((256, 8), dtype=np.uint8)
for _b in range(256):
    for _k, _p in enumerate([p for p in range(8) if _b >> p & 1]):
        _SEL[_b, _k] = _p


def _select_in_words(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th set bit of each 64-bit word."""
    parts = words.astype("<u8").view(np.uint8).reshape(-1, 8)
    upto = np.cumsum(_POP[parts], axis=1, dtype=np.int64)
    byte = (upto <= k[:, None]).sum(axis=1)
    row = np.arange(len(words))
    before = upto[row, byte] - _POP[parts[row, byte]]
    return byte * 8 + _SEL[parts[row, byte], k - before]


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Fixed-width integers in 64-bit words (one spare word at the end)."""
    out = np.zeros(len(values) * bits // 64 + 2, dtype=_U64)
    if bits and len(values):
        at = np.arange(len(values), dtype=np.int64) * bits
        word, shift = at >> 6, (at & 63).astype(_U64)
        np.bitwise_or.at(out, word, values << shift)
        spill = shift.astype(np.int64) + bits > 64
        np.bitwise_or.at(out, word[spill] + 1, values[spill] >> (_U64(64) - shift[spill]))
    return out


def unpack(words: np.ndarray, bits: int, i: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(i), dtype=_U64)
    at = i.astype(np.int64) * bits
    word, shift = at >> 6, (at & 63).astype(_U64)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((_U64(64) - shift) & _U64(63)), _U64(0))
    return (low | high) & _U64((1 << bits) - 1)


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary, select by sampled counts."""

    def __init__(self, n: int, bits: int, low, high, ones):
        self.n, self.bits, self.low, self.high, self.ones = n, bits, low, high, ones

    @staticmethod
    def build(values: np.ndarray, universe: int) -> "EliasFano":
        n = len(values)
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(_U64)
        top = (values >> _U64(bits)).astype(np.int64)
        at = top + np.arange(n)
        size = ((int(top[-1]) if n else 0) + n) // 64 + 2
        high = np.zeros(size, dtype=_U64)
        np.bitwise_or.at(high, at >> 6, _U64(1) << (at & 63).astype(_U64))
        ones = np.r_[0, np.cumsum(np.bitwise_count(high), dtype=np.int64)]
        return EliasFano(n, bits, pack(values & _U64((1 << bits) - 1), bits), high, ones.astype(np.int64 if n >> 31 else np.uint32))

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.ones": self.ones,
                f"{name}.meta": np.array([self.n, self.bits], dtype=np.int64)}

    @staticmethod
    def view(a: dict[str, np.ndarray], name: str) -> "EliasFano":
        n, bits = a[f"{name}.meta"].tolist()
        return EliasFano(n, bits, a[f"{name}.low"], a[f"{name}.high"], a[f"{name}.ones"])

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at positions ``i``."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        at = word * 64 + _select_in_words(self.high[word], i - self.ones[word].astype(np.int64))
        return ((at - i).astype(_U64) << _U64(self.bits)) | unpack(self.low, self.bits, i)

    def _bucket(self, top: np.ndarray) -> np.ndarray:
        """Number of elements whose high part is below ``top``: the zeros before decide."""
        words = len(self.high)
        zeros = np.arange(words + 1, dtype=np.int64) * 64 - self.ones.astype(np.int64)
        k = top - 1
        inside = (k >= 0) & (k < zeros[-1])
        word = np.clip(np.searchsorted(zeros, np.where(inside, k, 0), side="right") - 1, 0, words - 1)
        at = word * 64 + _select_in_words(~self.high[word], np.where(inside, k - zeros[word], 0))
        return np.where(k < 0, 0, np.where(inside, np.minimum(at - k, self.n), self.n))

    def find(self, values: np.ndarray, first: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Position of the first element not below each value (successor), searched only in
        [first, stop); -1 where that element is not the value itself."""
        top = (values >> _U64(self.bits)).astype(np.int64)
        lo, hi = self._bucket(top), self._bucket(top + 1)
        if first is not None:
            lo, hi = np.clip(lo, first, stop), np.clip(hi, first, stop)
        end, want = hi.copy(), values & _U64((1 << self.bits) - 1)
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = unpack(self.low, self.bits, mid) < want[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
            live = live[lo[live] < hi[live]]
        ok = lo < end
        ok[ok] = unpack(self.low, self.bits, lo[ok]) == want[ok]
        return np.where(ok, lo, -1)


# ---------------------------------------------------------------- shard files

def _filesystem(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "file://", 1))


def write_shard(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: a JSON header and the arrays, written aside and renamed, so that a task
    that runs twice leaves one whole file."""
    filesystem, path = _filesystem(folder)
    filesystem.create_dir(path, recursive=True)
    at, head = 0, {}
    for k, a in arrays.items():
        head[k] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    aside = f"{path}/.{name}.{uuid.uuid4().hex}"
    with filesystem.open_output_stream(aside) as f:
        f.write(len(text).to_bytes(8, "little") + text)
        for a in arrays.values():
            f.write(np.ascontiguousarray(a).tobytes() + b"\0" * (-a.nbytes % 8))
    filesystem.move(aside, f"{path}/{name}")


def map_shard(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a shard: memory-mapped where the folder is mounted, else read."""
    filesystem, path = _filesystem(folder)
    if filesystem.type_name == "local":
        raw = np.memmap(f"{path}/{name}", dtype=np.uint8, mode="r")
    else:
        with filesystem.open_input_file(f"{path}/{name}") as f:
            raw = np.frombuffer(f.read(), dtype=np.uint8)
    n = int.from_bytes(raw[:8].tobytes(), "little")
    head = json.loads(raw[8:8 + n].tobytes())
    return {k: raw[8 + n + at:8 + n + at + size * np.dtype(t).itemsize].view(t) for k, (t, size, at) in head.items()}


class Trie:
    """Handle of a trained model: where its shards are and how many words each holds."""

    def __init__(self, folder: str, shards: int, words: dict[int, int], tokens: int):
        self.folder, self.shards, self.tokens = folder, shards, tokens
        self.sizes = np.array([words.get(s, 0) for s in range(shards)], dtype=np.int64)
        self.base = np.r_[0, np.cumsum(self.sizes)]
        self.words = int(self.base[-1])
        self.level2: dict[int, int] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_open"}

    def _shard(self, name: str) -> dict[str, np.ndarray]:
        cache = self.__dict__.setdefault("_open", {})
        if name not in cache:
            cache[name] = map_shard(self.folder, name)
        return cache[name]

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word id or -1, training count) of word hashes."""
        ids, counts = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        for s, own in by_shard(shard_of(hashes, self.shards)):
            if not self.sizes[s]:
                continue
            a = self._shard(f"words-{s}")
            at = EliasFano.view(a, "hash").find(hashes[own] - _U64(shard_start(int(s), self.shards)))
            own, at = own[at >= 0], at[at >= 0]
            ids[own], counts[own] = self.base[s] + at, a["count"][at]
        return ids, counts

    def counts_of(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), dtype=np.int64)
        for s, own in by_shard(np.searchsorted(self.base, ids, side="right") - 1):
            out[own] = self._shard(f"words-{s}")["count"][ids[own] - self.base[s]]
        return out

    @property
    def start(self) -> int:
        """Context id before the first token."""
        return self.words

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.tokens + 1.0 * (self.words + 1))

    def part_of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Level-2 shard of a bigram: the context's level-1 shard and a part of the words."""
        shard = np.minimum(np.searchsorted(self.base, context, side="right") - 1, self.shards - 1)
        return shard * SPLIT + word % SPLIT

    def bigrams(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 probability of seen bigrams, NaN for others."""
        out = np.full(len(context), np.nan)
        for p, own in by_shard(self.part_of(context, word)):
            if not self.level2.get(p):
                continue
            a = self._shard(f"bigrams-{p}")
            contexts, pointers, ids = (EliasFano.view(a, n) for n in ("context", "pointer", "id"))
            at = contexts.find(context[own].astype(_U64))
            own, at = own[at >= 0], at[at >= 0]
            if not len(own):
                continue
            first, stop = pointers.access(at).astype(np.int64), pointers.access(at + 1).astype(np.int64)
            before = np.where(first > 0, ids.access(np.maximum(first - 1, 0)) + _U64(1), _U64(0))
            hit = ids.find(before + word[own].astype(_U64), first, stop)
            own, hit = own[hit >= 0], hit[hit >= 0]
            out[own] = -STEP * a["probability"][hit]
        return out


def by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of its items) of each shard that occurs, by one sort."""
    order = np.argsort(shard, kind="stable")
    starts = np.flatnonzero(np.r_[True, shard[order[1:]] != shard[order[:-1]]]) if len(order) else order
    for a, b in zip(starts, [*starts[1:], len(order)]):
        yield int(shard[order[a]]), order[a:b]


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash, so ids follow the order of the hashes."""
    return ((hashes >> _U64(40)).astype(np.int64) * shards) >> 24


def shard_start(s: int, shards: int) -> int:
    return -(-(s << 24) // shards) << 40


# ---------------------------------------------------------------- training

def _tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash per distinct token, text of each token, code of each token, code of the token
    before it); the last code is the end, and -1 stands before the first token."""
    rows, codes, words = words_of(text, lower=True)
    n = len(text)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([*map(digest, words.to_pylist()), END], dtype=_U64)
    count = np.bincount(rows, minlength=n)
    ends = np.cumsum(count)
    owner = np.insert(rows, ends, np.arange(n))
    code = np.insert(codes, ends, len(words))
    before = np.r_[-1, code[:-1]]
    before[np.r_[True, owner[1:] != owner[:-1]]] = -1
    return hashes, owner, code, before


def _sum_equal(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _planes(a: np.ndarray) -> bytes:
    """Bytes of a sorted array as differences, by significance, so that the shuffle's
    compression meets the runs of zeros."""
    d = np.diff(a, prepend=a.dtype.type(0))
    return np.ascontiguousarray(d.view(np.uint8).reshape(len(a), -1).T).tobytes()


def _unplanes(b: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.cumsum(np.frombuffer(b, np.uint8).reshape(width, -1).T.copy().view(dtype).ravel(), dtype=dtype)


_BLOBS = "shard int, n long, keys binary, counts binary"
_BLOB_SCHEMA = pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _counted(count_piece, shard_of_key):
    """A map task: n-gram counts of the texts it reads, summed inside the task and sent on as
    one block per shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def blocks():
            keys, counts = _sum_equal(*map(np.concatenate, zip(*held)))
            shard = shard_of_key(keys)
            order = np.argsort(shard, kind="stable")
            keys, counts, shard = keys[order], counts[order], shard[order]
            starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            for a, b in zip(starts, np.r_[starts[1:], len(shard)]):
                if counts[a:b].max() >= 1 << 32:
                    raise OverflowError("an n-gram occurs 2**32 times or more in one task")
                n = counts[a:b].astype("<u4")
                yield out_batch(_BLOB_SCHEMA, shard=[int(shard[a])], n=[b - a], keys=[_planes(keys[a:b])],
                                counts=[np.ascontiguousarray(n.view(np.uint8).reshape(-1, 4).T).tobytes()])

        for batch in pieces(batches, "text"):
            held.append(count_piece(text_of(batch)))
            if sum(len(k) for k, _ in held) > FLUSH:
                held = [_sum_equal(*map(np.concatenate, zip(*held)))]
                if len(held[0][0]) > FLUSH // 2:
                    yield from blocks()
                    held = []
        if held:
            yield from blocks()

    return run


def _merged(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([_unplanes(b, _U64) for b in rows["keys"]])
    counts = np.concatenate([_unplanes_raw(b) for b in rows["counts"]])
    return _sum_equal(keys, counts)


def _unplanes_raw(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def train(docs: DataFrame) -> Trie:
    """The trie of all training texts.

    Two counting jobs: words, then bigrams of word ids.  Tasks count what they read, send
    one compact block per shard, and one task per shard merges, smooths, and writes the
    shard.  Only shard sizes come to the driver.  The number of shards follows the amount
    of training text (``SHARD_TEXT``), so that looking up a piece of text costs the same
    whatever the cluster's settings.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "ngram-trie")
    texts = docs.filter(F.coalesce(id_remainder("doc_id", FOLD) != HELD, F.lit(False))).select("text")
    shards = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_TEXT

    def words(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        hashes, _, code, _ = _tokens(text)
        return _sum_equal(hashes, np.bincount(code, minlength=len(hashes)).astype(np.int64))

    def write_words(rows: pd.DataFrame) -> pd.DataFrame:
        s = int(rows["shard"].iloc[0])
        keys, counts = _merged(rows)
        keys, counts = keys[counts > 0], counts[counts > 0]
        if len(keys):
            relative = keys - _U64(shard_start(s, shards))
            ef = EliasFano.build(relative, max(1, (1 << 64) // shards + (1 << 40)))
            write_shard(folder, f"words-{s}", {**ef.arrays("hash"), "count": counts.astype(np.uint32 if counts.max() < 1 << 32 else np.int64)})
        return pd.DataFrame({"shard": [s], "n": [len(keys)], "tokens": [int(counts.sum())]})

    level1 = (texts.mapInArrow(_counted(words, lambda k: shard_of(k, shards)), _BLOBS)
              .groupBy("shard").applyInPandas(write_words, "shard int, n long, tokens long").collect())
    trie = Trie(folder, shards, {r["shard"]: r["n"] for r in level1}, sum(r["tokens"] for r in level1))
    if not trie.words:
        return trie
    shared = spark.sparkContext.broadcast(trie)
    width = _U64(max(1, (trie.words + 1).bit_length()))

    def bigrams(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        hashes, _, code, before = _tokens(text)
        pair, n = np.unique((before + 1) * len(hashes) + code, return_counts=True)
        ids, _ = shared.value.ids(hashes)
        ids = np.r_[ids, shared.value.start]  # code -1 is the start
        return (ids[pair // len(hashes) - 1].astype(_U64) << width) | ids[pair % len(hashes)].astype(_U64), n.astype(np.int64)

    def part(keys: np.ndarray) -> np.ndarray:
        return shared.value.part_of((keys >> width).astype(np.int64), (keys & ((_U64(1) << width) - _U64(1))).astype(np.int64))

    def write_bigrams(rows: pd.DataFrame) -> pd.DataFrame:
        model, p = shared.value, int(rows["shard"].iloc[0])
        keys, counts = _merged(rows)
        context, word = (keys >> width).astype(np.int64), (keys & ((_U64(1) << width) - _U64(1))).astype(np.int64)
        firsts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        # a context is followed once by a token each time it occurs; the start as often as the end
        own = context[firsts]
        total = np.zeros(len(own), dtype=np.int64)
        inner = own < model.words
        total[inner] = model.counts_of(own[inner])
        end_id, end_count = model.ids(np.array([END], dtype=_U64))
        total[~inner] = end_count[0]
        size = np.diff(np.r_[firsts, len(keys)])
        prob = (counts + PRIOR * model.unigram(model.counts_of(word))) / (np.repeat(total, size) + PRIOR)
        # ids become monotone: each context starts after the end of the one before
        last = word[np.r_[firsts[1:], len(keys)] - 1] + 1
        start = np.r_[0, np.cumsum(last)[:-1]]
        ids = word + np.repeat(start, size)
        write_shard(model.folder, f"bigrams-{p}", {
            **EliasFano.build(own, model.words + 2).arrays("context"),
            **EliasFano.build(np.r_[firsts, len(keys)], len(keys) + 1).arrays("pointer"),
            **EliasFano.build(ids, int(ids[-1]) + 1).arrays("id"),
            "probability": np.clip(np.round(-np.log10(prob) / STEP), 0, 65535).astype(np.uint16)})
        return pd.DataFrame({"shard": [p], "n": [len(keys)]})

    level2 = (texts.mapInArrow(_counted(bigrams, part), _BLOBS)
              .groupBy("shard").applyInPandas(write_bigrams, "shard int, n long").collect())
    trie.level2 = {r["shard"]: r["n"] for r in level2}
    return trie


# ---------------------------------------------------------------- scoring

def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    ``base_score`` is the add-one unigram; ``score`` the bigram with a unigram prior,
    p(w | c) = (n(c, w) + PRIOR p(w)) / (n(c) + PRIOR), read from the trie for seen
    bigrams (quantised to ``STEP``) and computed from the counts for others.  Scoring is
    a map over the texts: the distinct tokens and bigrams of a piece of text are looked
    up once each in the memory-mapped shards; nothing is shuffled.

    NULL text is empty: one token, the end.  Rows without id are neither learned from nor
    held out.  Without training text N and V are 0 and both scores are 0.  Repeated rows
    repeat; an empty table gives no rows; other columns are ignored.
    """
    model = train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    tokens = model.tokens
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for batch in pieces(batches, "text", SCORE_BYTES):
            hashes, owner, code, before = _tokens(text_of(batch))
            n = batch.num_rows
            ids, counts = trie.ids(hashes)
            base = np.log10(trie.unigram(counts))
            pair, at = np.unique((before + 1) * len(hashes) + code, return_inverse=True)
            c, w = pair // len(hashes) - 1, pair % len(hashes)
            context = np.where(c < 0, trie.start, ids[c])
            end = counts[-1]
            total = np.where(c < 0, end, np.where(context >= 0, counts[c], 0))
            backed = np.log10(PRIOR * trie.unigram(counts[w]) / (total + PRIOR))
            seen = np.full(len(pair), np.nan)
            known = (context >= 0) & (ids[w] >= 0)
            seen[known] = trie.bigrams(context[known], ids[w][known])
            prob = np.where(np.isnan(seen), backed, seen)
            yield out_batch(schema, doc_id=batch.column(0), n_tokens=np.bincount(owner, minlength=n),
                            n_known=np.bincount(owner, weights=counts[code] > 0, minlength=n).astype(np.int64),
                            base_score=np.bincount(owner, weights=base[code], minlength=n),
                            score=np.bincount(owner, weights=prob[at.ravel()], minlength=n))

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return found.select("doc_id", held_out("doc_id", FOLD, HELD).alias("held_out"), "n_tokens", "n_known",
                        F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
