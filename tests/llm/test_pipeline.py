"""The pipeline against its stages, and the guard of the entry file."""

from __future__ import annotations

import collections
import os
import subprocess
import sys

import corpus_pipeline
from salesnet.llm import mil_quality, rules_forest, simhash, source_mix

DIR = "/root/testdata/sf0.01"


def test_each_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    steps = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, DIR).cache()
        assert docs.columns == before.columns
        steps.append((before, docs))
    ids = [[collections.Counter(r[0] for r in x.select("doc_id").collect()) for x in pair] for pair in steps]
    kept = {r["doc_id"] for r in rules_forest.quality_rules(steps[0][0], labels).collect() if r["kept"]}
    assert set(ids[0][1]) == kept
    good = {r["doc_id"] for r in mil_quality.quality_scores(steps[1][0], labels).collect() if r["predicted"]}
    assert set(ids[1][1]) == good
    assert set(ids[2][1]) == {r["component_id"] for r in simhash.simhash_components(steps[2][0]).collect()}
    copies = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in source_mix.mix(steps[3][0]).collect()}
    assert ids[3][1] == collections.Counter({i: n for i, n in copies.items() if n})
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DIR).collect()
    assert collections.Counter(r["doc_id"] for r in packed if r["piece"] == 0) == ids[3][1]
    full = corpus_pipeline.run(spark, DIR).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, full)) == sorted(map(key, packed))


def test_clean_labelled_documents_stay(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    for _, stage in corpus_pipeline.STAGES[:2]:
        before = {r[0] for r in docs.select("doc_id").collect()}
        docs = stage(spark, docs, DIR).cache()
        gone = before - {r[0] for r in docs.select("doc_id").collect()}
        known = [labels[i] for i in gone if i in labels]
        assert not known or sum(known) <= 0.02 * sum(labels.values()) + 6
    left = [labels[r[0]] for r in docs.select("doc_id").collect() if r[0] in labels]
    assert sum(q == 0 for q in left) <= 0.02 * len(left)


def test_entry_imports_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name == 'corpus_pipeline' or name.startswith('salesnet.llm'):\n"
            "            raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and not [k for k in e.queries() if k.startswith('op') and k[2].isdigit()]\n"
            "assert 'pipeline' not in e.oracle_sql()\n")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_registered_names():
    import __spark_entry__ as e
    names = list(e.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
