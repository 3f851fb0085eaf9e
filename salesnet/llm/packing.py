"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesnet.llm.common import checkpointed, out_batch, pieces, rank_in_group, text_of
from salesnet.llm.token_alignment import _byte_alphabet

CAPACITY = 4096
SEPARATOR_ID = 1
CACHE_BYTES = 48 << 20  # strings and ids that a task keeps, about; twice, for pieces and for words
_ENTRY_BYTES = 170      # of a cached string beside its characters and ids

_TOKENIZERS: dict = {}


# Text with a special token or with any other letter than these keeps to the tokenizer's own cut.
_OWN_CUT = r"<\||[^\t-\r -~\x{a1}-\x{12f}\x{131}-\x{24f}\x{2010}-\x{2027}]"
# In lower-cased text of these letters, the tokenizer's pieces beside runs of letters.
_BESIDE_LETTERS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\t-\r \p{L}\p{N}]+"
_SYMBOLS = {byte: symbol for symbol, byte in _byte_alphabet().items()}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class IdCache(dict):
    """Packed ids of a string, filled on first use up to about ``CACHE_BYTES``."""

    def __init__(self, ids_of):
        super().__init__()
        self.ids_of, self.room = ids_of, CACHE_BYTES

    def __missing__(self, key: str) -> bytes:
        ids = _packed(self.ids_of(key))
        if self.room > 0:
            self.room -= _ENTRY_BYTES + len(key) + len(ids)
            self[key] = ids
        return ids


class WordCache:
    """A tokenizer with its ids kept by piece of a word.  No token of this vocabulary
    reaches over white space, so text that is not cut here is encoded word by word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.forget()

    def forget(self) -> None:
        self.pieces, self.words = IdCache(self._piece), IdCache(self._word)

    def _word(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _piece(self, piece: str) -> list[int]:
        # a piece as the tokenizer cuts it: the model alone gives the ids of its byte-level
        # symbols (printable ASCII bytes are their own)
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(_SYMBOLS)
        return [t.id for t in self.model.tokenize(piece)]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text]))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Packed ids of each text (none NULL); a string is looked up once for all of them."""
        texts = texts.cast(pa.large_string())
        own = pc.match_substring_regex(texts, _OWN_CUT)
        cut = pc.replace_substring_regex(pc.utf8_lower(texts.filter(pc.invert(own))), _BESIDE_LETTERS, r" \0 ")
        at_own = own.to_numpy(zero_copy_only=False)
        ids = np.empty(len(texts), dtype=object)
        for rows, spaced, cache in ((~at_own, cut, self.pieces), (at_own, texts.filter(own), self.words)):
            ids[rows] = _joined(spaced, cache)
        return ids.tolist()


def _joined(texts: pa.Array, cache: IdCache) -> list[bytes]:
    """Per text, the ids of its strings between white space in a row."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    known = pa.array(map(cache.__getitem__, coded.dictionary.to_pylist()), pa.large_binary())
    joined = known.take(coded.indices)
    _, offsets, data = joined.buffers()
    ends = np.frombuffer(offsets, "<i8")[lists.offsets.to_numpy()].tolist()
    return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]


def word_cache(path: str) -> WordCache:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordCache(path)
    return _TOKENIZERS[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Per document its ids and the separator, cut into pieces of ``capacity`` ids (the
    last may be shorter): doc_id, piece, start, length, ids_crc32.  Arrow batches in,
    Arrow batches out; ids are held for about 4 MB of texts at a time (one text whole)."""
    end = np.array([SEPARATOR_ID], dtype="<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, step = word_cache(tokenizer_path), 4 * capacity
        cache.forget()  # a worker that lives on holds one task's strings, no more
        for batch in pieces(batches, "text"):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), cache.encode_all(text_of(batch))):
                ids += end
                for i, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    rows.append((doc_id, i, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows))
            yield out_batch(schema, **{f.name: c for f, c in zip(schema, cols)})
        cache.forget()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, ranks, first sequence,
    pieces per sequence, offset).

    Piece ``r`` of a length, with first <= r < first + ranks, goes to sequence
    ``first sequence + (r - first) // per`` at offset ``offset + ((r - first) % per) * length``.
    Open sequences with the same room are kept as ranges, so the work depends on the
    number of different lengths (``capacity`` at most), not on the number of pieces.
    """
    plan: list[tuple[int, int, int, int, int, int]] = []
    rooms: list[int] = []                        # rooms with open ranges, ascending
    ranges: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, how many)]
    next_sequence = 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in ranges:
                insort(rooms, room)
                ranges[room] = []
            ranges[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = ranges[room].pop()
                if not ranges[room]:
                    del ranges[room], rooms[at]
            else:
                room, first = capacity, next_sequence
                n = -(-left // (capacity // length))
                next_sequence += n
            per = room // length
            whole = min(n, left // per)
            offset = capacity - room
            if whole:
                plan.append((length, rank, whole * per, first, per, offset))
                put(room - per * length, first, whole)
                rank, left = rank + whole * per, left - whole * per
            if whole < n and left:
                some = min(per, left)
                plan.append((length, rank, some, first + whole, per, offset))
                put(room - some * length, first + whole, 1)
                rank, left, whole = rank + some, left - some, whole + 1
            put(room, first + whole, n - whole)
    return plan


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with the sequence and the offset they are packed at.

    Output: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The tokenised pieces (numbers only) are checkpointed once.  Their length histogram
    (``capacity`` rows at most) goes to the driver, where best-fit decreasing runs over
    the counts; the plan comes back as a bounded table and each piece finds its slot by
    joining on (length, rank within the length).  Ranks come from hash buckets
    (``rank_in_group``), so one length may hold any share of the rows.

    NULL or empty text is one piece holding the separator; repeated rows are packed
    separately; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    cut = checkpointed(token_pieces(docs, tokenizer_path, capacity))
    histogram = {r[0]: r[1] for r in cut.groupBy("length").agg(F.count(F.lit(1))).collect()}
    plan = spark.createDataFrame(best_fit_plan(histogram, capacity) or [],
                                 "_length long, _first long, _ranks long, _sequence long, _per long, _offset long")
    ranked = rank_in_group(cut, "length", ["doc_id", "piece", "ids_crc32"], "_rank")
    into = F.col("_rank") - F.col("_first")
    here = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (into < F.col("_ranks"))
    # the plan has a few rows per length, whatever the number of documents
    return (ranked.join(F.broadcast(plan), here)
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("_sequence") + F.floor(into / F.col("_per"))).cast("long").alias("sequence_id"),
                    (F.col("_offset") + into % F.col("_per") * F.col("length")).cast("long").alias("offset")))
