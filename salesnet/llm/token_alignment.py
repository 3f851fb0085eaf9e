"""Cross-tokenizer alignment: groups of overlapping tokens by pointer jumping, links
between the tokens of a group, and how often each pair of ids is linked in the corpus."""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesnet.llm.common import out_batch, pieces, shared_folder

CHUNK_BYTES = 16 << 20      # text of the documents that share one table of pairs
PIECE_BYTES = 2 << 20       # text aligned at once
EXPAND_LINKS = 4096         # groups with more links are first reduced to their different ids
SEP = "▁"                   # SentencePiece's mark of a space

# Fixed value: the pre-tokenizer pattern of byte-level BPE files that name ByteLevel with use_regex.
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ---------------------------------------------------------------- tokenizers

def _byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in byte-level vocabularies: visible Latin-1
    characters stand for themselves, the rest for the code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> tuple[Callable[[Sequence[str]], list[list[int]]], list[bytes]]:
    """(encode texts to ids without special tokens, bytes by id) of a byte-level BPE file.

    A plain file (merges in the order of ids, the usual pattern, no normalizer) is run by
    the rank-based encoder, which gives the same ids several times faster; any other by
    the tokenizers library.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet, vocab = _byte_alphabet(), dict(spec["model"]["vocab"])
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    table = [b""] * (1 + max([*vocab.values(), *special.values()]))
    for token, i in [*special.items(), *vocab.items()]:
        table[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    pre = spec.get("pre_tokenizer") or {}
    ranks = {table[i]: i for i in vocab.values()}
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
    plain = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex")
             and not pre.get("add_prefix_space") and merged == sorted(merged) and len(ranks) == len(vocab)
             and len(vocab) == len(merged) + 256)
    if plain:
        import tiktoken
        run = tiktoken.Encoding("byte level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return (lambda texts: [run.encode_ordinary(t) for t in texts]), table
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return (lambda texts: [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]), table


@lru_cache(maxsize=2)
def piece_bpe(path: str) -> tuple[Callable[[Sequence[str]], list[list[int]]], list[bytes]]:
    """(encode texts to ids, bytes by id) of a SentencePiece model; it adds a space in front."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if model.is_byte(i) else None
        table.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SEP, " ").encode())
    return (lambda texts: model.encode(list(texts), num_threads=1)), table


# ---------------------------------------------------------------- groups

def overlap_groups(ends_a: np.ndarray, starts_a: np.ndarray, ends_b: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number (0, 1, ... from left to right) of every A and every B token.

    Both token rows tile the same bytes.  Every token points to its farthest-right
    overlapping token of the other row; a B token whose end is also an A token's end
    points to itself.  Doubling the pointers until nothing changes takes each token to
    the terminal one of its component, in log2(longest chain) vector steps.
    """
    n = len(ends_a)
    to_b = np.searchsorted(starts_b, ends_a, side="left") - 1
    to_a = np.searchsorted(starts_a, ends_b, side="left") - 1
    terminal = ends_a[to_a] == ends_b
    points = np.concatenate([n + to_b, np.where(terminal, n + np.arange(len(ends_b)), to_a)])
    while True:
        jumped = points[points]
        if np.array_equal(jumped, points):
            break
        points = jumped
    number = np.cumsum(terminal) - 1
    return number[points[:n] - n], number[points[n:] - n]


def _links(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, doc_of: np.ndarray,
           width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, occurrences) of the links, pair = A id x ``width`` + B id, sorted."""
    groups = len(doc_of)
    many_a, many_b = np.bincount(in_a, minlength=groups), np.bincount(in_b, minlength=groups)
    first_b = np.cumsum(many_b) - many_b
    small = many_a * many_b <= EXPAND_LINKS
    mine = np.flatnonzero(small[in_a])
    copies = many_b[in_a[mine]]
    left = np.repeat(mine, copies)
    step = np.arange(len(left)) - np.repeat(np.cumsum(copies) - copies, copies)
    keys = [(doc_of[in_a[left]] << 40) | (a[left] * width + b[first_b[in_a[left]] + step])]
    keys[0], times = np.unique(keys[0], return_counts=True)
    times = [times]
    first_a = np.cumsum(many_a) - many_a
    for g in np.flatnonzero(~small):  # ids repeat in a large group: multiply their counts
        ids_a, n_a = np.unique(a[first_a[g]:first_a[g] + many_a[g]], return_counts=True)
        ids_b, n_b = np.unique(b[first_b[g]:first_b[g] + many_b[g]], return_counts=True)
        keys.append(((doc_of[g] << 40) | (ids_a[:, None] * width + ids_b[None, :])).ravel())
        times.append((n_a[:, None] * n_b[None, :]).ravel())
    key, times = np.concatenate(keys), np.concatenate(times)
    if len(keys) > 1:
        key, place = np.unique(key, return_inverse=True)
        total = np.zeros(len(key), dtype=np.int64)
        np.add.at(total, place, times)
        times = total
    return key >> 40, key & (1 << 40) - 1, times


@lru_cache(maxsize=4)
def _decimal(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal ids as bytes with what follows them: an id, the B half, the next group."""
    return tuple(np.array([b"%d%s" % (i, after) for i in range(size)], dtype=object) for after in (b",", b"|", b";"))


def align(texts: Sequence[str], path_a: str, path_b: str) -> dict[str, np.ndarray | list]:
    """Alignment of some texts: n_a, n_b, n_groups, n_links, sha256 per text, and the links
    (document, pair, occurrences), sorted by document and pair."""
    (encode_a, bytes_a), (encode_b, bytes_b) = byte_bpe(path_a), piece_bpe(path_b)
    full = [i for i, t in enumerate(texts) if t]
    spaced = [" " + texts[i] for i in full]
    kept_a, kept_b, docs = [], [], []
    for i, text, a, b in zip(full, spaced, encode_a(spaced), encode_b([texts[i] for i in full])):
        whole = text.encode()
        if b"".join([bytes_a[x] for x in a]) == whole and b"".join([bytes_b[x] for x in b]) == whole:
            kept_a.append(a), kept_b.append(b), docs.append(i)
    out = {k: np.zeros(len(texts), dtype=np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")}
    out["sha256"] = [""] * len(texts)
    out["document"] = out["pair"] = out["times"] = np.zeros(0, dtype=np.int64)
    if not docs:
        return out
    n_a, n_b = np.array(list(map(len, kept_a))), np.array(list(map(len, kept_b)))
    a, b = (np.concatenate([np.array(x, dtype=np.int64) for x in ids]) for ids in (kept_a, kept_b))
    long_a, long_b = (np.array(list(map(len, t)), dtype=np.int64) for t in (bytes_a, bytes_b))
    ends_a, ends_b = np.cumsum(long_a[a]), np.cumsum(long_b[b])
    in_a, in_b = overlap_groups(ends_a, ends_a - long_a[a], ends_b, ends_b - long_b[b])
    groups = int(in_a[-1]) + 1
    many_a, many_b = np.bincount(in_a, minlength=groups), np.bincount(in_b, minlength=groups)
    doc_of = np.repeat(np.array(docs), n_a)[np.cumsum(many_a) - 1]
    out["n_a"][docs], out["n_b"][docs] = n_a, n_b
    out["n_groups"] = np.bincount(doc_of, minlength=len(texts))
    np.add.at(out["n_links"], doc_of, many_a * many_b)
    # A ids of a group, then its B ids, each with the sign that follows it
    (mid_a, end_a, _), (mid_b, _, end_b) = _decimal(len(bytes_a)), _decimal(len(bytes_b))
    line = np.empty(len(a) + len(b), dtype=object)
    at_a = np.arange(len(a)) + (np.cumsum(many_b) - many_b)[in_a]
    at_b = np.arange(len(b)) + np.cumsum(many_a)[in_b]
    line[at_a], line[at_b] = mid_a[a], mid_b[b]
    last_a, last_b = np.cumsum(many_a) - 1, np.cumsum(many_b) - 1
    line[at_a[last_a]], line[at_b[last_b]] = end_a[a[last_a]], end_b[b[last_b]]
    stops = np.cumsum(n_a + n_b)
    for i, start, stop in zip(docs, (stops - n_a - n_b).tolist(), stops.tolist()):
        out["sha256"][i] = hashlib.sha256(b"".join(line[start:stop].tolist())[:-1]).hexdigest()
    out["document"], out["pair"], out["times"] = _links(a, b, in_a, in_b, doc_of, len(bytes_b))
    return out


# ---------------------------------------------------------------- chunks of documents

CHUNKS = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "sha256 array<string>, size array<int>, packed binary, pair array<long>, held array<int>")
_PER_DOC = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "sha256", "size")


def _pack(place: np.ndarray, times: np.ndarray) -> bytes:
    """Two int rows, the first as differences, compressed without loss."""
    steps = np.diff(place, prepend=0).astype("<i4")
    return zstandard.compress(np.concatenate([steps, times.astype("<i4")]).reshape(-1, 1).view(np.uint8).T.tobytes(), 1)


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8).reshape(4, -1)
    both = np.ascontiguousarray(raw.T).view("<i4").ravel().astype(np.int64)
    n = len(both) // 2
    return np.cumsum(both[:n]), both[n:]


def aligned_chunks(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk of about ``chunk_bytes`` of text: what is known of its documents,
    their links as places in the chunk's sorted pairs, and in how many of them each pair
    occurs.  A document is never divided."""
    schema = pa.schema([("chunk", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())),
                        ("n_b", pa.list_(pa.int64())), ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())),
                        ("sha256", pa.list_(pa.string())), ("size", pa.list_(pa.int32())), ("packed", pa.binary()),
                        ("pair", pa.list_(pa.int64())), ("held", pa.list_(pa.int32()))])

    def chunk_row(number: int, parts: list[dict]) -> pa.RecordBatch:
        pair = np.concatenate([p["pair"] for p in parts])
        times = np.concatenate([p["times"] for p in parts])
        distinct, place = np.unique(pair, return_inverse=True)
        row = {k: [x for p in parts for x in p[k]] for k in _PER_DOC}
        row |= {"chunk": number, "packed": _pack(place, times), "pair": distinct,
                "held": np.bincount(place, minlength=len(distinct)).astype(np.int32)}
        return pa.RecordBatch.from_arrays([pa.array([row[f.name]], type=f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in pieces(batches, "text", PIECE_BYTES):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            part = align(texts, path_a, path_b)
            part["doc_id"] = batch.column(0).to_pylist()
            part["size"] = np.bincount(part["document"], minlength=len(texts))
            parts.append(part)
            held += sum(map(len, texts))
            if held >= chunk_bytes:
                yield chunk_row(number, parts)
                number, parts, held = number + 1, [], 0
        if parts:
            yield chunk_row(number, parts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, CHUNKS)


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk rows with their pairs' corpus-wide counts: one row per document."""
    schema = pa.schema([(n, pa.string() if n == "groups_sha256" else pa.int64()) for n in
                        (c.split()[0] for c in ALIGNED.split(", "))])
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(k)[i] for k, n in enumerate(batch.schema.names)}
            per_doc = {n: row[n].values for n in _PER_DOC}
            count = np.zeros(0, dtype=np.int64)
            if row["known"].is_valid:
                known = row["known"].values
                order = np.argsort(known.field(0).to_numpy())
                count = known.field(1).to_numpy()[order]  # twice the count, plus 1 for an A id's highest
            place, times = _unpack(row["packed"].as_py())
            stops = np.cumsum(per_doc["size"].to_numpy())
            sums = [np.r_[0, np.cumsum(x)] for x in ((count[place] & 1) * times, (count[place] >> 1) * times)]
            n_best, count_sum = (s[stops] - s[stops - per_doc["size"].to_numpy()] for s in sums)
            yield out_batch(schema, n_best=n_best, count_sum=count_sum, groups_sha256=per_doc["sha256"],
                            **{n: per_doc[n] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")})


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per document.

    Each text is encoded once.  Chunks are written to a table in the shared folder; from
    it only (pair, documents) are read to count pairs over the corpus, and only the
    different pairs of a chunk are shuffled, to their counts and back, never a document's
    links.  A pair has at most one row per chunk, so no key is hot.  The highest count of
    each A id is a row per id of the vocabulary, the bound of what is broadcast.

    NULL and empty texts, and texts whose tokens do not spell them, have zeros and an
    empty hash.  Rows without doc_id take part; repeated rows repeat and count as
    documents of their own; an empty table gives no rows; other columns are ignored.
    The links of one document are held in one task.
    """
    spark = docs.sparkSession
    width = len(piece_bpe(path_b)[1])
    folder = shared_folder(spark, "alignment")
    aligned_chunks(docs, path_a, path_b, chunk_bytes).write.option("compression", "zstd").parquet(folder)
    chunks = spark.read.parquet(folder)
    held = (chunks.select("chunk", F.explode(F.arrays_zip("pair", "held")).alias("e"))
            .select("chunk", F.col("e.pair").alias("pair"), F.col("e.held").alias("held")))
    counts = held.groupBy("pair").agg(F.sum("held").alias("docs"))
    id_a = F.floor(F.col("pair") / F.lit(width)).cast("int")
    highest = counts.groupBy(id_a.alias("_a")).agg(F.max("docs").alias("_most"))  # at most the vocabulary of A
    marked = (counts.join(F.broadcast(highest), id_a == F.col("_a"))
              .select("pair", (F.col("docs") * 2 + (F.col("docs") == F.col("_most")).cast("int")).alias("count")))
    known = (held.select("chunk", "pair").join(marked, "pair")
             .groupBy("chunk").agg(F.collect_list(F.struct("pair", "count")).alias("known")))
    return (chunks.select("chunk", *_PER_DOC, "packed").join(known, "chunk", "left").drop("chunk")
            .mapInArrow(_totals, ALIGNED))
