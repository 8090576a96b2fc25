import collections

import corpus_pipeline
from flowml.llm import exact_dedup, packing, quality
from flowml.session import materialise

DIR = "/root/testdata/sf0.01"


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    scores = {r.doc_id: r.predicted for r in quality.op3_quality(spark, DIR).collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, DIR), name)
        if name != "pack":
            assert docs.columns == columns
        kept[name] = [r.doc_id for r in docs.select("doc_id").collect()]
    assert sorted(kept["quality"]) == sorted(i for i, p in scores.items() if p)
    norm = {i: " ".join((rows[i].text or "").split()) for i in rows}
    first = {}
    for i in sorted(kept["quality"]):
        first.setdefault(norm[i], i)
    assert len(kept["exact_dedup"]) <= len(kept["quality"]) and set(first.values()) <= set(kept["exact_dedup"])
    assert set(kept["near_dedup"]) <= set(kept["exact_dedup"]) and len(set(kept["near_dedup"])) == len(kept["near_dedup"])
    times = collections.Counter(kept["mix"])
    assert set(times) <= set(kept["near_dedup"]) and max(times.values()) == 2
    # Every copy in the mix is packed whole.
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == set(times)
    assert sum(r.piece == 0 for r in pieces) == len(kept["mix"])
    used = collections.Counter()
    for r in pieces:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.SEQUENCE


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, DIR), name)
        assert docs.count() == 0
    assert exact_dedup.deduplicate(spark.read.parquet(f"{DIR}/documents.parquet").limit(0)).count() == 0
