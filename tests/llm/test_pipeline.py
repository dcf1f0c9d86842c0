"""Every stage of the pipeline on its own input against brute force, and the whole."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tests.conftest import SF
from tests.llm.test_corpus import brute_components, shingles
from walrill.llm import toxicity
from walrill.llm.common import materialise, table


def test_stages(spark):
    docs = table(spark, SF, "documents")
    inputs, outputs, now = {}, {}, docs
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = now.collect()
        now = materialise(stage(spark, now, SF))
        outputs[name] = now.collect()
        if name != "sharding":
            assert now.columns == docs.columns
    key = lambda r: (r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"])
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, table(spark, SF, "labels")).collect()}
    assert Counter(map(key, outputs["toxicity"])) == Counter(key(r) for r in inputs["toxicity"] if not scores[r["doc_id"]])
    rows = inputs["near_duplicates"]
    kept = {d for (d, n, c) in brute_components([(r["doc_id"], r["text"]) for r in rows], 80) if d == c}
    assert Counter(map(key, outputs["near_duplicates"])) == Counter(key(r) for r in rows if r["doc_id"] in kept)
    items = [shingles(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = lambda t: not any(i and 100 * len(i & shingles(t)) >= 80 * len(i) for i in items)
    assert Counter(map(key, outputs["decontamination"])) == Counter(key(r) for r in inputs["decontamination"] if clean(r["text"]))
    taken, there = Counter(map(key, outputs["mixing"])), Counter(map(key, inputs["mixing"]))
    assert set(taken) <= set(there) and max(taken.values()) <= 2
    sharded = outputs["sharding"]
    assert Counter(map(key, sharded)) == taken and {r["shard"] for r in sharded} <= set(range(40))
    assert sorted(Counter(map(key, corpus_pipeline.run(spark, SF).collect())).items()) == sorted(taken.items())


def test_stages_take_odd_tables(spark):
    odd = spark.createDataFrame([(None, None, "x", None, 1), (1, "", "x", "s", 1), (1, "", "x", "s", 1), (2, "a b c d e f g", None, "s", None), (2, "a b c d e f g", None, "s", None)], "doc_id long, text string, shard string, source string, size long")
    for docs, n in ((odd, 4), (odd.limit(0), 0)):
        now = docs
        for name, stage in corpus_pipeline.STAGES:
            now = materialise(stage(spark, now, SF))
            if name == "near_duplicates":
                assert now.count() == n
        assert now.columns[:5] == docs.columns


def test_near_duplicates_from_a_similarity_of_080(spark):
    docs = table(spark, SF, "documents")
    rows = docs.collect()
    # The base has 21 shingles, the others 5 and 6 more: similarities of 21/26 = 0.81 and 21/27 = 0.78.
    base = [f"b{i}" for i in range(25)]
    more = [(9_000, " ".join(base)), (9_001, " ".join([*base, *(f"c{i}" for i in range(5))])), (9_002, " ".join([*base, *(f"d{i}" for i in range(6))]))]
    added = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in more], docs.schema)
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    got = sorted(r["doc_id"] for r in stage(spark, docs.unionByName(added), SF).collect())
    all_rows = [(r["doc_id"], r["text"]) for r in rows] + more
    at = {p: sorted(d for d, _, c in brute_components(all_rows, p) if d == c) for p in (80, 85)}
    assert at[80] != at[85] and 9_001 not in at[80] and 9_002 in at[80]
    assert got == at[80]
