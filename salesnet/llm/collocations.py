"""Phrase collocation mining by Toivonen's method: a sample proposes frequent phrases, a
full pass counts them and their negative border exactly, and further passes count what
the border's failures open up, until nothing new is frequent."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesnet.llm.common import batch_bytes, out_batch, pieces, scramble, shared_folder, text_of

MIN_COUNT = 10              # occurrences of a candidate
MAX_WORDS = 3               # words of the longest candidate
TOP = 2000                  # phrases reported per language
COVERED_PERCENT = 50        # a longer candidate this frequent drops the phrases inside it
SAMPLE_BYTES = 32 << 20     # expected text of the sample
FILTER_BITS = 26            # log2 of the bits that hold the proposed phrases
SPLIT_BYTES = 4 << 20       # text counted at once: its words and hashes take about 25 times that
UNKNOWN = "und"

BREAKS = ".,;:!?\n\x0b\x0c\r"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, dtype=np.uint8)          # 0 in a word, 1 between words, 2 between pieces
_KIND[[32, 9]] = 1
_KIND[[ord(c) for c in BREAKS]] = 2

COUNTS = "lang string, words int, phrase string, n long"
_SCHEMA = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])


# ---------------------------------------------------------------- words of a batch

def words_in_pieces(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(the words, A-Z lowered; the row of each; whether the next word follows it in the
    same piece), found on the bytes of the whole column at once."""
    text = text.cast(pa.large_string())
    ends = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset:text.offset + len(text) + 1]
    if not len(text) or ends[-1] == ends[0]:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, bool)
    body = _LOWER[np.frombuffer(text.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]]
    ends = ends - ends[0]
    kind = _KIND[body]
    inside = kind == 0
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < len(body))]  # where one text ends and the next begins
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    row = np.searchsorted(ends, start, side="right") - 1
    piece = np.searchsorted(np.flatnonzero(kind == 2), start)
    together = np.zeros(len(start), dtype=bool)
    together[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
    offsets = np.r_[0, np.cumsum(stop - start)].astype(np.int32)
    words = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(body[inside]))
    return words, row, together


def _spelling_hash(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word (none is empty): the sum over its bytes of a mix of place and byte."""
    if not len(words):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    body = np.frombuffer(words.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]
    start = ends[:-1] - ends[0]
    place = np.arange(1, len(body) + 1) - np.repeat(start, np.diff(ends))
    return np.add.reduceat(scramble((place.view(np.uint64) << np.uint64(8) | body) * _ODD), start)


def _longer(phrase: np.ndarray, word: np.ndarray, k: int) -> np.ndarray:
    """Hash of a phrase and the word after it, ``k`` words in all."""
    return _levelled(scramble(phrase * _ODD + word), k)


def _levelled(h: np.ndarray, k: int) -> np.ndarray:
    """A hash whose last four bits tell how many words the phrase has."""
    return (h & ~np.uint64(15)) | np.uint64(k)


# ---------------------------------------------------------------- sets of phrases, of a fixed size

class PhraseSet:
    """Hashes of phrases in a Bloom filter of 2**bits bits.

    It may hold phrases that were never added, which costs their counting and nothing else:
    whether a phrase is frequent is decided by its exact count alone.
    """

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), dtype=np.uint64) if words is None else words

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), dtype=bool)
        mask = np.uint64((1 << self.bits) - 1)
        for p in (h >> np.uint64(4) & mask, h >> np.uint64(64 - self.bits)):
            found &= (self.words[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found

    def with_hashes(self, hashes: DataFrame) -> "PhraseSet":
        """This set and the rows of ``hashes`` (h).  Bits are gathered by built-in
        aggregates; what reaches the driver has a row per 64 bits at most."""
        mask = F.lit((1 << self.bits) - 1).cast("long")
        places = F.array(F.shiftright("h", 4).bitwiseAND(mask), F.shiftrightunsigned("h", 64 - self.bits))
        rows = (hashes.select(F.explode(places).alias("p"))
                .groupBy(F.shiftright("p", 6).alias("at"))
                .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("word")).toArrow())
        words = self.words.copy()
        words[rows.column(0).to_numpy()] |= rows.column(1).to_numpy().view(np.uint64)
        return PhraseSet(self.bits, words)


# ---------------------------------------------------------------- counting

class Grams:
    """The words of some texts with a code per (language, word), and their phrases."""

    def __init__(self, lang: pa.Array, text: pa.Array):
        self.words, row, self.together = words_in_pieces(text)
        coded = self.words.dictionary_encode()
        langs = lang.dictionary_encode()
        self.langs = langs.dictionary
        self.lang_of = langs.indices.to_numpy(zero_copy_only=False)[row]
        spellings = max(len(coded.dictionary), 1)
        size = spellings * len(self.langs)
        key = self.lang_of * np.int64(spellings) + coded.indices.to_numpy(zero_copy_only=False)
        if size <= 4 * len(key):
            seen = np.bincount(key, minlength=size)
            distinct = np.flatnonzero(seen)
            self.times, place = seen[distinct], np.zeros(size, dtype=np.int32)
            place[distinct] = np.arange(len(distinct), dtype=np.int32)
            self.code = place[key]
        else:
            distinct, code, self.times = np.unique(key, return_inverse=True, return_counts=True)
            self.code = code.astype(np.int32)
        spelled = _spelling_hash(coded.dictionary)
        tongue = np.array([xxhash.xxh64_intdigest(x, 1) for x in self.langs.cast(pa.binary()).to_pylist()], dtype=np.uint64)
        self.hashes = _levelled(scramble(spelled[distinct % spellings] + _ODD * tongue[distinct // spellings]), 1)

    def longer(self, start: np.ndarray, k: int) -> np.ndarray:
        """Of the starts of k - 1 words, those that go on to a k-th in the same piece."""
        start = start[self.together[start + k - 2]]
        return start[start + k <= len(self.code)]

    def admitted(self, max_words: int, now: PhraseSet | None, before: PhraseSet | None) -> Iterator[np.ndarray]:
        """Hashes, one per occurrence, of the phrases of 2 to ``max_words`` words both of
        whose parts (without the last, without the first word) are in ``now`` and not both
        in ``before``."""
        n = len(self.code)
        every = np.full(len(self.hashes), 1, np.int8)  # 0: not proposed, 1: proposed now, 2: before
        if now is not None:
            every = now.has(self.hashes).astype(np.int8)
            if before is not None:
                every[before.has(self.hashes)] = 2
        each = self.hashes[self.code]
        state, h, at = np.append(every[self.code], np.int8(0)), each.copy(), np.arange(n)
        for k in range(2, max_words + 1):
            start = self.longer(at[(state[at] > 0) & (state[at + 1] > 0)], k)
            if not len(start):
                return
            h[start] = _longer(h[start], each[start + k - 1], k)
            yield h[start[(state[start] < 2) | (state[start + 1] < 2)]]
            if k == max_words:
                return
            earlier = start[(state[start] == 2) & (state[start + 1] == 2)]  # counted by an earlier pass
            state = np.zeros(n + 1, dtype=np.int8)
            if now is None:
                state[start] = 1
            else:
                state[start[now.has(h[start])]] = 1
                if before is not None:
                    # ``before`` may hold by chance what no pass has counted: that is new, as is what it opens up
                    state[earlier[before.has(h[earlier])]] = 2
            at = start

    def named(self, max_words: int, chosen: PhraseSet) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, a place, occurrences here) of each phrase that ``chosen`` may hold, told
        apart by its words, not its hash."""
        each = self.hashes[self.code]
        h, at = each.copy(), np.arange(len(self.code))
        for k in range(1, max_words + 1):
            if k > 1:
                at = self.longer(at, k)
                h[at] = _longer(h[at], each[at + k - 1], k)
            here = at[chosen.has(h[at])]
            if not len(here):
                continue
            g = self.code[here]
            _, first, g, times = np.unique(g, return_index=True, return_inverse=True, return_counts=True)
            for i in range(1, k):
                _, first, g, times = np.unique(g * len(self.hashes) + self.code[here + i], return_index=True,
                                               return_inverse=True, return_counts=True)
            yield k, here[first], times


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[Grams]:
    for batch in pieces(batches, "text", SPLIT_BYTES):
        grams = Grams(text_of(batch, "lang"), text_of(batch))
        if len(grams.words):
            yield grams


def hashed_counts(texts: DataFrame, max_words: int, now: PhraseSet | None = None, before: PhraseSet | None = None) -> DataFrame:
    """(h, n): occurrences by hash, so never less than a phrase's own, of the phrases that
    ``Grams.admitted`` gives and, in the first pass (``before`` None), of all words."""
    shared = texts.sparkSession.sparkContext.broadcast((now, before))
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = shared.value
        for grams in _grams(batches):
            if before is None:
                yield out_batch(schema, h=grams.hashes.view(np.int64), n=grams.times)
            for found in grams.admitted(max_words, now, before):
                h, n = np.unique(found, return_counts=True)
                yield out_batch(schema, h=h.view(np.int64), n=n)

    return texts.select("lang", "text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def named_counts(texts: DataFrame, max_words: int, chosen: PhraseSet) -> DataFrame:
    """(lang, words, phrase, n): exact occurrences of every phrase that ``chosen`` holds, and
    with 0 words the number of words of a language."""
    shared = texts.sparkSession.sparkContext.broadcast(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grams in _grams(batches):
            n = np.bincount(grams.lang_of, minlength=len(grams.langs))
            yield out_batch(_SCHEMA, lang=grams.langs, words=np.zeros(len(n), np.int32), phrase=[""] * len(n), n=n)
            for k, at, n in grams.named(max_words, shared.value):
                parts = [grams.words.take(pa.array(at + i)) for i in range(k)]
                yield out_batch(_SCHEMA, lang=grams.langs.take(pa.array(grams.lang_of[at])), words=np.full(len(at), k, np.int32),
                                phrase=pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0], n=n)

    return (texts.select("lang", "text").mapInArrow(run, COUNTS)
            .groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")))


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                     sample_bytes: int = SAMPLE_BYTES, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, words, phrase, n) of every phrase of 1 to ``max_words`` words that occurs
    ``min_count`` times or more in its language, and of every language's word total
    (words 0); exact, whatever the sample holds.

    The sample's frequent phrases, at a lowered threshold, are the first proposal.  A full
    pass counts the proposal and its negative border: the phrases all of whose parts are
    proposed.  Frequent phrases of the border that were not proposed are its failures; they
    join the proposal, and the next pass counts the phrases that this newly admits.
    Without failures the proposal is closed, after ``max_words`` passes at the latest.

    These passes count 64-bit hashes, summed per task before they are shuffled; a hash's
    count is a phrase's own or more, so no frequent phrase is missed.  A last pass counts
    the phrases with frequent hashes by their words, which makes the result exact.  Only
    frequent rows are written, to the shared folder.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = min(1.0, sample_bytes / size) if size else 1.0
    lowered = min_count if share == 1 else max(2, int(0.5 * share * min_count))
    sample = texts if share == 1 else texts.filter(F.rand(7) < share)
    with batch_bytes(spark, SPLIT_BYTES * 7 // 8):  # a batch is one piece, unless a long text ends it
        proposed = hashed_counts(sample, max_words - 1).filter(F.col("n") >= lowered)
        now, before = PhraseSet(filter_bits).with_hashes(proposed), None
        folder, found = shared_folder(spark, "phrases"), []
        while True:
            found.append(f"{folder}/pass{len(found)}")
            hashed_counts(texts, max_words, now, before).filter(F.col("n") >= min_count).write.parquet(found[-1])
            extensible = spark.read.parquet(found[-1]).filter(F.col("h").bitwiseAND(F.lit(15)) < max_words)
            grown = now.with_hashes(extensible)
            if np.array_equal(grown.words, now.words):
                break
            now, before = grown, now
        chosen = PhraseSet(filter_bits).with_hashes(spark.read.parquet(*found))
        (named_counts(texts, max_words, chosen).filter((F.col("n") >= min_count) | (F.col("words") == 0))
         .write.parquet(f"{folder}/frequent"))
    return spark.read.parquet(f"{folder}/frequent")


# ---------------------------------------------------------------- collocations

def _part(words: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def _score(a: str, l: str, r: str) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of up to 38 digits."""
    whole = [f"cast({c} as decimal(16,0))" for c in (a, a, l, r)]
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({whole[0]} * {whole[1]})) div ({whole[2]} * {whole[3]})")


def scored_phrases(frequent: DataFrame, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score): the candidates that no longer candidate covers, with
    their lowest-scoring cut (the earliest of equals)."""
    phrases = frequent.filter(F.col("words") >= 1).select("lang", "words", "phrase", "n")
    candidates = phrases.filter(F.col("words") >= 2).withColumn("_w", F.split("phrase", " "))
    cuts = (candidates.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .select("lang", "phrase", F.col("n").alias("a"), "_k",
                    _part(F.col("_w"), F.lit(1), F.col("_k")).alias("_left"),
                    _part(F.col("_w"), F.col("_k") + 1, F.col("words") - F.col("_k")).alias("_right")))
    # frequent parts: a word that begins many phrases is a skewed key of a plain equi-join, left to AQE
    left = phrases.select("lang", F.col("phrase").alias("_left"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("_right"), F.col("n").alias("r"))
    cut = (cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
           .withColumn("score", _score("a", "l", "r"))
           .groupBy("lang", "phrase").agg(F.min(F.struct("score", "_k", "l", "r", "a")).alias("c")))
    starts = F.sequence(F.lit(1), F.col("words"))
    inside = (candidates.filter(F.col("words") >= 3)
              .withColumn("_at", F.explode(starts)).withColumn("_n", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
              .filter(F.col("_at") + F.col("_n") - 1 <= F.col("words"))
              .groupBy("lang", _part(F.col("_w"), F.col("_at"), F.col("_n")).alias("phrase")).agg(F.max("n").alias("_longer")))
    covered = F.col("_longer") * 100 >= F.col("c.a") * covered_percent
    return (cut.join(inside, ["lang", "phrase"], "left").filter(F.coalesce(~covered, F.lit(True)))
            .select("lang", "phrase", "c.a", "c.l", "c.r", "c.score"))


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS,
                 sample_bytes: int = SAMPLE_BYTES, filter_bits: int = FILTER_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases by
    score, then occurrences (both descending), then the phrase's bytes.

    Rows without lang count as ``und``; NULL texts are empty; repeated rows count again;
    phrases never cross punctuation or lines, nor documents; ties are broken by the
    phrase; an empty table gives no rows; other columns are ignored.  Texts are counted
    whole.  Per language only ``top`` rows of a task reach the ranking window.
    """
    frequent = frequent_phrases(docs, min_count, max_words, sample_bytes, filter_bits)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = scored_phrases(frequent).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = frequent.filter(F.col("words") == 0).select("lang", F.col("n").alias("_n"))
    return (first.join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("_n").alias("n"), "score"))


COLLOCATIONS_SQL = f"""
WITH words AS (
  SELECT doc, piece, lang, list_filter(regexp_split_to_array(p, '[ \\t]+'), lambda x: x <> '') AS w
  FROM (SELECT doc, lang, unnest(ps) AS p, generate_subscripts(ps, 1) AS piece
        FROM (SELECT row_number() OVER () AS doc, coalesce(lang, '{UNKNOWN}') AS lang,
                     regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                     'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS ps
              FROM documents))
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3]) AS k))
), f AS (
  SELECT lang, k, phrase, count(*) AS c FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND c >= {MIN_COUNT}
), cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.c AS l, r.c AS r,
         CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.c AS HUGEINT) * r.c) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM candidates WHERE k = 3
), kept AS (
  SELECT * FROM lowest o WHERE NOT EXISTS (
    SELECT 1 FROM inside i WHERE i.lang = o.lang AND i.phrase = o.phrase AND 100 * i.a >= {COVERED_PERCENT} * o.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, score::BIGINT AS score FROM kept) JOIN totals USING (lang)
WHERE rank <= {TOP}
"""
