"""Fingerprints, token alignment and collocations against brute-force versions and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import re
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salesnet.llm import collocations, queries, text_prints, token_alignment

DIR = "/root/testdata/sf0.01"
COLS = "doc_id long, text string, lang string, source string, high int, n int, _bucket string, chunk string, phrase int, words int"
PATHS = tuple(map(queries.tokenizer_path, queries.ALIGNED))


def frame(spark, rows):
    """(doc_id, text, lang) with other columns whose names clash with those used inside."""
    return spark.createDataFrame([(*r, None, 1, 2, "x", "y", 3, 4) for r in rows], COLS)


ODD = [(1, None, "en"), (2, "", "en"), (3, " \t\n", None), (4, "One word", "en"), (None, "x y z", None),
       (5, "the same text of several words again", "en"), (5, "the same text of several words again", "en"),
       (6, "the same text of several words again", "fr"), (7, "ÉÈ ß 漢字   nb sp 😀 ", "de"), (8, "long words " * 9000, "en"),
       (9, "1 2 3 !!! ###", None), (None, None, None), (10, "it's <|endoftext|> don't </s> <0x41> 'LL 12a", "en"), (11, "▁a", "en")]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


# ---------------------------------------------------------------- op11

def slow_simhash(text: str, width: int) -> str:
    """The votes of a text's terms one by one, with the operator's own term hash."""
    rows, high, low = text_prints._terms(pa.array([text]), width)
    times = collections.Counter(zip(high.tolist(), low.tolist()))
    votes = [0] * 128
    for (a, b), n in times.items():
        weight = int(8 * (1 + np.log2(n)))
        for i in range(128):
            votes[i] += weight if (a << 64 | b) >> (127 - i) & 1 else -weight
    return f"{sum(1 << (127 - i) for i in range(128) if votes[i] > 0):032x}"


def bits_apart(a: str, b: str) -> int:
    return (int(a, 16) ^ int(b, 16)).bit_count()


def check_fingerprints(rows, got, width=text_prints.TERM_WORDS, radius=text_prints.RADIUS):
    """``rows`` (doc_id, text) with different ids against the result by doc_id."""
    ordered = sorted(rows, key=lambda r: -r[0])
    own = {t: slow_simhash(t, width) for _, t in ordered}
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        r, half = got[i], len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == own[text] and r.edited_fingerprint == slow_simhash(changed, width)
        assert r.near_edited == 1 - bits_apart(r.fingerprint, r.edited_fingerprint) / 128
        assert r.near_next == 1 - bits_apart(r.fingerprint, own[after]) / 128
        assert r.n_near == sum(bits_apart(r.fingerprint, own[t]) <= radius for _, t in rows) - 1


def test_fingerprints_against_brute_force(spark, documents):
    some = documents.filter("doc_id % 7 = 0").select("doc_id", "text")
    rows = [(r[0], r[1] or "") for r in some.collect() if len(r[1] or "") < 3000]
    got = {r.doc_id: r for r in text_prints.document_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    check_fingerprints(rows, got)


def test_fingerprints_take_awkward_rows(spark):
    out = text_prints.document_fingerprints(frame(spark, ODD)).collect()
    assert len(out) == len(ODD)
    by_id = {r.doc_id: r for r in out if r.doc_id not in (None, 5)}
    assert by_id[1].n_chars == by_id[2].n_chars == 0 and by_id[1].fingerprint == "0" * 32
    same = {r.fingerprint for r in out if r.n_chars == len(ODD[5][1])}
    assert len(same) == 1 and all(r.n_near == 2 for r in out if r.fingerprint in same)
    assert by_id[8].n_chars == len(ODD[9][1])
    # rows without id come last: the smallest id is followed by one of them
    assert by_id[1].edited_sha256 == hashlib.sha256(b"").hexdigest()
    # equal ids: the first of the two is followed by its copy, the second by document 4
    assert sorted(r.near_next == 1.0 for r in out if r.doc_id == 5) == [False, True]
    assert text_prints.document_fingerprints(frame(spark, [])).collect() == []
    one = text_prints.document_fingerprints(frame(spark, [(1, "abcd ef", None)])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcdabc").hexdigest()


@pytest.mark.parametrize("ids", ["same", "none"])
def test_fingerprint_order_with_a_hot_id(spark, ids):
    rows = [(None if ids == "none" else 3, f"{i} is the number of this text", "en") for i in range(300)] + [(i, f"other {i}", "en") for i in range(5)]
    docs = frame(spark, rows)
    placed = text_prints._beside_next(docs).select("_bucket", "_borrowed").groupBy("_bucket").sum("_borrowed").collect()
    assert len(placed) > 8 and all(r[1] == 1 for r in placed)
    out = text_prints.document_fingerprints(docs).collect()
    assert len(out) == len(rows) and len({r.edited_sha256 for r in out}) > 250


@pytest.mark.parametrize("block_rows", [1024, 40])
def test_tables_find_every_near_fingerprint(spark, block_rows):
    rng = np.random.default_rng(5)
    centres = [int.from_bytes(rng.bytes(16), "big") for _ in range(4)]
    prints = {c ^ sum(1 << int(i) for i in rng.choice(128, rng.integers(0, 5), replace=False)) for c in centres for _ in range(120)}
    prints |= {int.from_bytes(rng.bytes(16), "big") for _ in range(200)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(p >> 64), signed(p & (1 << 64) - 1), i % 3 + 1) for i, p in enumerate(sorted(prints))]
    table = spark.createDataFrame(rows, "high long, low long, n long")
    got = {(r.high, r.low): r.near for r in text_prints.near_fingerprints(table, 4, block_rows).collect()}
    full = {r[:2]: ((r[0] % (1 << 64)) << 64) | r[1] % (1 << 64) for r in rows}
    want = {k: sum(n for a, b, n in rows if (a, b) != k and (full[k] ^ full[(a, b)]).bit_count() <= 4) for k in full}
    assert got == {k: v for k, v in want.items() if v} and len(got) > 300


# ---------------------------------------------------------------- op12

def slow_alignment(rows):
    """Groups cut where both tokenizers end, links listed one by one."""
    (encode_a, bytes_a), (encode_b, bytes_b) = token_alignment.byte_bpe(PATHS[0]), token_alignment.piece_bpe(PATHS[1])
    docs = []
    for text in rows:
        whole = (" " + (text or "")).encode()
        a, b = encode_a([" " + text])[0] if text else [], encode_b([text])[0] if text else []
        if not text or b"".join(bytes_a[i] for i in a) != whole or b"".join(bytes_b[i] for i in b) != whole:
            docs.append(None)
            continue
        ends = [[(sum(len(t[x]) for x in ids[:0]), x) for x in ids] for ids, t in ((a, bytes_a), (b, bytes_b))]
        for row, t in zip(ends, (bytes_a, bytes_b)):
            at = 0
            for k, (_, x) in enumerate(row):
                at += len(t[x])
                row[k] = (at, x)
        cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        groups, start = [], 0
        for c in cuts:
            groups.append([[x for e, x in row if start < e <= c] for row in ends])
            start = c
        docs.append((len(a), len(b), groups))
    held = collections.Counter(p for d in docs if d for p in {(x, y) for ga, gb in d[2] for x in ga for y in gb})
    most = collections.defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for ga, gb in d[2] for x in ga for y in gb]
        line = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in d[2])
        out.append((d[0], d[1], len(d[2]), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(line.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("chunk_bytes", [1, 20_000, token_alignment.CHUNK_BYTES])
def test_alignment_against_brute_force(spark, documents, chunk_bytes):
    texts = [r[0] for r in documents.filter("doc_id % 9 = 0").select("text").collect() if len(r[0] or "") < 2000]
    texts += [r[1] for r in ODD if len(r[1] or "") < 1000] + ["ab1!" * 60, "  " * 30 + "x", "漢字カナ" * 20, "\x00 \r\n\ttab"]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    got = token_alignment.align_tokenizers(frame(spark, rows), *PATHS, chunk_bytes=chunk_bytes).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == dict(enumerate(slow_alignment(texts)))


def test_alignment_takes_awkward_rows(spark):
    out = token_alignment.align_tokenizers(frame(spark, ODD), *PATHS).collect()
    assert len(out) == len(ODD) and sum(r.doc_id is None for r in out) == 2
    by_id = {r.doc_id: r for r in out}
    assert by_id[1][1:] == by_id[2][1:] == by_id[11][1:] == (0, 0, 0, 0, 0, 0, "")
    assert by_id[10].n_a > 0 and by_id[8].n_a > 10_000  # special tokens in a text are plain text
    assert token_alignment.align_tokenizers(frame(spark, []), *PATHS).collect() == []


def test_rank_encoder_gives_the_tokenizers_own_ids(documents):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(PATHS[0])
    tokenizer.encode_special_tokens = True
    texts = [" " + r[0] for r in documents.select("text").collect() if r[0]] + [r[1] for r in ODD if r[1]]
    encode, table = token_alignment.byte_bpe(PATHS[0])
    assert encode(texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert all(b"".join(table[i] for i in ids) == t.encode() for t, ids in zip(texts, encode(texts)))


def test_pointer_jumping_over_a_long_chain_and_large_groups():
    """Tokens of 3 and of 5 bytes meet every 15 bytes; shifted ones only at the end."""
    n = 3000
    a, b = np.arange(3, 3 * n + 1, 3), np.r_[1, np.arange(4, 3 * n - 1, 3), 3 * n]
    in_a, in_b = token_alignment.overlap_groups(a, a - 3, b, np.r_[0, b[:-1]])
    assert set(in_a.tolist()) == set(in_b.tolist()) == {0}
    ids_a, ids_b = np.arange(n) % 70, np.arange(len(b)) % 90
    doc, pair, times = token_alignment._links(ids_a, ids_b, in_a, in_b, np.array([4]), 100)
    want = collections.Counter((x * 100 + y) for x in ids_a.tolist() for y in ids_b.tolist())
    assert dict(zip(pair.tolist(), times.tolist())) == want and set(doc.tolist()) == {4}


# ---------------------------------------------------------------- op13

def slow_collocations(rows, top, min_count, max_words):
    f, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    cand = {p: n for p, n in f.items() if len(p[1]) > 1 and n >= min_count}
    scored = collections.defaultdict(list)
    for (lang, words), a in cand.items():
        inside = any(o[0] == lang and len(o[1]) > len(words) and 100 * n >= 50 * a
                     and any(o[1][i:i + len(words)] == words for i in range(len(o[1]))) for o, n in cand.items())
        if inside:
            continue
        score, _, l, r = min((1000000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
                             for k in range(1, len(words)))
        scored[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return {(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s)
            for lang, rows in scored.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])}


@pytest.mark.parametrize("sample_bytes,max_words", [(1 << 30, 3), (2_000, 3), (2_000, 4), (1, 2)])
def test_collocations_against_brute_force(spark, sample_bytes, max_words):
    rng = np.random.default_rng(3)
    words = ["Alpha", "beta,", "É", "gamma", "d\x0be", "New York", "new york city.", "\x00", "x;y"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 40))), [None, "en", "de"][i % 3]) for i in range(120)] + ODD[:9] + ODD[10:]
    got = collocations.collocations(frame(spark, rows), 25, 6, max_words, sample_bytes, filter_bits=16)
    assert {tuple(r) for r in got.collect()} == slow_collocations([r[1:] for r in rows], 25, 6, max_words)


def test_collocations_with_a_full_filter_and_a_useless_sample(spark, documents):
    """A filter whose bits are nearly all set only counts more; an empty sample only needs more passes."""
    some = documents.filter("doc_id % 5 = 0")
    want = sorted(map(tuple, collocations.collocations(some).collect()))
    got = sorted(map(tuple, collocations.collocations(some, sample_bytes=1, filter_bits=8).collect()))
    assert got == want and len(want) > 100


def test_collocations_with_phrases_a_filter_holds_by_chance(spark):
    """Phrases of words that the sample misses; a filter of 2**14 bits holds some of them unproposed."""
    rng = np.random.default_rng(0)
    phrases = [" ".join(f"w{j}" for j in rng.integers(0, 4000, 3)) for _ in range(1500)]
    lines = rng.permutation(phrases * 12)
    rows = [(i, ". ".join(lines[i * 20:i * 20 + 20]), "en") for i in range(len(lines) // 20)]
    got = collocations.frequent_phrases(frame(spark, rows), sample_bytes=60_000, filter_bits=14).filter("words = 3").collect()
    assert {(r.phrase, r.n) for r in got} == {(p, 12) for p in phrases} and len(got) == 1500


def test_collocations_against_sql(spark, documents):
    want = duckdb.sql(collocations.COLLOCATIONS_SQL.replace("FROM documents", f"FROM '{DIR}/documents.parquet'")).fetchall()
    got = collocations.collocations(documents).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_collocations_of_no_rows_and_exact_large_numbers(spark):
    assert collocations.collocations(frame(spark, [])).collect() == []
    big = 3 * 10 ** 12
    frequent = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 1)],
                                     "lang string, words int, phrase string, n long")
    r = collocations.scored_phrases(frequent).first()
    assert r.score == 1000000 * (big - 1) ** 2 // (big * (big + 1))


def test_collocations_hold_arrays_of_a_piece_at_a_time():
    """The arrays of a task follow the piece of text at hand, not its batch."""
    rng = np.random.default_rng(1)
    spelled = np.array([f"word{i}" for i in range(60_000)])
    texts = [" ".join(rng.choice(spelled, 20_000)) for _ in range(120)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de"] * 60, "text": texts})
    words = 0
    tracemalloc.start()
    try:
        for grams in collocations._grams(iter([batch])):
            words += int(grams.times.sum())
            for found in grams.admitted(3, None, None):
                np.unique(found, return_counts=True)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert batch.nbytes > 3 * collocations.SPLIT_BYTES and words == 120 * 20_000
    assert peak < 120e6


def test_collocations_read_batches_of_bounded_bytes(spark, monkeypatch):
    """Long texts reach a task few at a time, and the session's own limit holds afterwards."""
    grams, setting = collocations._grams, "spark.sql.execution.arrow.maxBytesPerBatch"

    def measured(batches):
        def small():
            for batch in batches:
                assert batch.nbytes < 5 << 20, batch.nbytes
                yield batch
        return grams(small())

    monkeypatch.setattr(collocations, "_grams", measured)
    limit = spark.conf.get(setting)
    rows = spark.range(40).selectExpr("'en' lang", "repeat(concat('w', id, ' a b. '), 40000) text").coalesce(1)
    got = {(r.phrase, r.n) for r in collocations.frequent_phrases(rows).filter("words = 3").collect()}
    assert got == {(f"w{i} a b", 40000) for i in range(40)}
    assert spark.conf.get(setting) == limit


def test_word_hashes_tell_words_and_languages_apart():
    words = ["a", "b", "ab", "ba", "aab", "aba", "a" * 70, "a" * 71, "a" * 69 + "b", "b" + "a" * 69, "é", "漢字", "字漢", "\x00", "\x00\x00"]
    grams = collocations.Grams(pa.array(["en", "de", ""]), pa.array([" ".join(words)] * 3))
    assert len(grams.hashes) == len(set(grams.hashes.tolist())) == 3 * len(words)
    again = collocations.Grams(pa.array([None, "de", "xx"]).slice(1), pa.array(["", "x q " + " ".join(words), "q"]).slice(1))
    assert set(grams.hashes[grams.code[15:30]].tolist()) < set(again.hashes.tolist())


def test_words_keep_to_their_texts_and_slices():
    texts = pa.array(["zz", "a b", "", "c", "d.e\nf", " g ", None, "HÉ"])[1:]
    words, row, together = collocations.words_in_pieces(texts.fill_null(""))
    assert list(zip(words.to_pylist(), row.tolist(), together.tolist())) == [
        ("a", 0, True), ("b", 0, False), ("c", 2, False), ("d", 3, False), ("e", 3, False), ("f", 3, False), ("g", 4, False),
        ("hÉ", 6, False)]
