"""Repeated rows, missing ids and tiny sources in the operators that keep or count groups."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from salesnet.llm import ngram_trie, packing, queries, rp_forest, simhash, source_mix
import numpy as np
import pyarrow as pa

COLS = "doc_id long, text string, source string, _key string, f long, c int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2) for r in rows], COLS)


def test_one_row_of_each_group_stays(spark):
    rows = [(3, "a b c d", "x"), (3, "a b c d", "x"), (None, "a b c d", "x"), (None, "zzz yyy", None), (3, "some other text", "x"),
            (None, "zzz yyy", None), (9, "zzz yyy xxx", "q"), (9, None, "q"), (8, "", None)]
    kept = simhash.without_near_copies(frame(spark, rows))
    assert kept.columns == [c.split()[0] for c in COLS.split(", ")]
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [
        (0, "zzz yyy"), (3, "a b c d"), (3, "some other text"), (8, ""), (9, "zzz yyy xxx")]
    assert simhash.without_near_copies(frame(spark, [])).collect() == []


def test_a_hot_repeated_row_stays_once(spark):
    same = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three four").alias("text"))
    other = spark.range(20).select((F.col("id") + 100).alias("doc_id"), F.concat_ws(" ", F.lit("text"), F.col("id"), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    out = simhash.without_near_copies(same.union(other))
    assert sorted(r.doc_id for r in out.collect()) == [7, *range(100, 120)]


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 130, "c": 300}, {"a": 1, None: 128, "c": 129, "d": 100_000, "e": 7}])
def test_every_source_meets_its_target_to_a_block(spark, sizes):
    rows, i = [], 0
    for source, words in sizes.items():
        left = words
        while left:
            n = min(left, 37 + i % 90)
            rows.append((i, "w " * n, source))
            i, left = i + 1, left - n
    out = source_mix.mix(frame(spark, rows)).groupBy("source_size").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max(F.col("taken") / F.col("size")).alias("most"))
    got = {r.source_size: r for r in out.collect()}
    assert set(got) == set(sizes.values()) and all(r.most <= 3 for r in got.values())
    for r in got.values():
        assert abs(r.taken - r.target) <= min(r.source_size, 128) / 2 + 2, r
    assert sum(r.taken for r in got.values()) == pytest.approx(sum(sizes.values()), abs=64 * len(sizes)) or sizes.get("d") is None


def test_a_repeated_vector_id_is_two_classes(spark):
    rows = [(1, [1.0, 0.0], 4), (1, [0.0, 1.0], 4), (2, [0.0, 1.0], 4), (3, [1.0, 0.01], 4), (5, [1.0, 0.0], 5)]
    out = rp_forest.embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out.collect()) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (5, 0, 5)]


def test_shards_follow_the_text_and_not_the_settings(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 4 = 0")
    one = {r.doc_id: (r.n_known, r.score) for r in ngram_trie.lm_scores(docs).collect()}
    monkeypatch.setattr(ngram_trie, "SHARD_TEXT", 40_000)
    trie = ngram_trie.train(docs)
    assert trie.shards > 10 and len(trie.level2) > 60
    many = {r.doc_id: (r.n_known, r.score) for r in ngram_trie.lm_scores(docs).collect()}
    assert {k: v[0] for k, v in one.items()} == {k: v[0] for k, v in many.items()}
    assert all(v[1] == pytest.approx(many[k][1], rel=1e-9) for k, v in one.items())


def test_items_by_shard_is_one_pass():
    shard = np.array([5, 0, 5, 2, 0])
    assert {s: own.tolist() for s, own in ngram_trie.by_shard(shard)} == {0: [1, 4], 2: [3], 5: [0, 2]}
    assert list(ngram_trie.by_shard(np.zeros(0, dtype=np.int64))) == []


def test_token_cache_is_bounded_and_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 2000)
    cache = packing.WordCache(queries.tokenizer_path())
    texts = [f"word{i} and more{i}" for i in range(300)]
    ids = [cache.encode(t) for t in texts]
    assert len(cache.pieces) < 20
    cache.forget()
    assert not cache.pieces and not cache.words and ids == [cache.encode(t) for t in texts]


def test_texts_of_a_batch_encode_each_different_piece_once(monkeypatch):
    from tokenizers import Tokenizer
    coded, whole = [], []
    piece, word = packing.WordCache._piece, packing.WordCache._word
    monkeypatch.setattr(packing, "CACHE_BYTES", 0)  # nothing is kept from one batch to the next
    monkeypatch.setattr(packing.WordCache, "_piece", lambda self, p: coded.append(p) or piece(self, p))
    monkeypatch.setattr(packing.WordCache, "_word", lambda self, w: whole.append(w) or word(self, w))
    own, cache = Tokenizer.from_file(queries.tokenizer_path()), packing.WordCache(queries.tokenizer_path())
    packed = lambda text: np.array(own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    text = "Été, été; don't été!! 12 ’² don't"
    assert cache.encode(text) == packed(text)
    assert whole == [] and len(coded) == len(set(coded))  # letters beyond ASCII take the short way too
    assert set(filter(None, coded)) == {"été", ",", ";", "don", "'t", "!!", "1", "2", "’", "²"}
    texts = [text, "", " \t\n", "<|endoftext|> don't <|endoftext|>", "été", "漢字 漢字", text]
    coded.clear()
    assert cache.encode_all(pa.array(texts)) == [packed(t) for t in texts]
    assert len(coded) == len(set(coded)) and len(whole) == len(set(whole))
