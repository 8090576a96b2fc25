import hashlib
import re

import pytest

from flowml.llm import exact_dedup
from flowml.session import scratch_path


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return sorted((i, min((x for x in groups[norm(t)] if x is not None), default=None), len(groups[norm(t)]),
                   hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows if i is not None)


def test_matches_brute_force_on_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = exact_dedup.deduplicate(odd_docs).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got if r.doc_id is not None) == brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got if r.doc_id is not None)


def test_index_persists_across_batches(spark, make_docs):
    path = scratch_path(spark, "index-test")
    first = exact_dedup.DigestIndex(spark, path, 4)
    first.ingest(make_docs([(10, "a"), (11, "b")])).collect()
    again = exact_dedup.DigestIndex(spark, path, 4)
    got = {r.doc_id: (r.keep_id, r.kept) for r in again.ingest(make_docs([(1, "a"), (2, "c"), (3, " c")])).collect()}
    assert got == {1: (10, False), 2: (2, True), 3: (3, True)}
    # A retried batch changes nothing.
    got = {r.doc_id: (r.keep_id, r.kept) for r in again.ingest(make_docs([(1, "a"), (2, "c"), (3, " c")])).collect()}
    assert got == {1: (10, False), 2: (2, True), 3: (3, True)}
    assert again.read().count() == 4


def test_index_side_is_joined_without_a_shuffle(spark, make_docs):
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index-plan"), 4)
    index.ingest(make_docs([(i, str(i)) for i in range(50)]))
    other = spark.range(5).selectExpr("unhex(sha2(cast(id as string), 256)) digest")
    plan = other.join(index.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_one_text_holds_most_rows(make_docs):
    got = exact_dedup.deduplicate(make_docs([(i, "same") for i in range(400)] + [(1000 + i, str(i)) for i in range(50)]))
    rows = got.collect()
    assert sum(r.kept for r in rows) == 51 and {r.group_size for r in rows} == {1, 400}


def test_empty_table(make_docs):
    assert exact_dedup.deduplicate(make_docs([])).collect() == []


def test_reopened_index_finds_all_texts(spark, make_docs):
    """The bucket count belongs to the index, not to the session that opens it."""
    path, docs = scratch_path(spark, "index-reopen"), make_docs([(i, f"text {i}") for i in range(100)])
    exact_dedup.DigestIndex(spark, path, 8).ingest(docs)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("2", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            index = exact_dedup.DigestIndex(spark, path)
            assert index.buckets == 8
            got = index.ingest(make_docs([(1000 + i, f"text {i}") for i in range(100)])).collect()
            assert not any(r.kept for r in got) and index.read().count() == 100
            small = index.compact()
            assert small.read().count() == 100
            assert not any(r.kept for r in small.ingest(make_docs([(2000, "text  7")])).collect())
            small.close()
            index.close()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, path, 4)


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_batches_decide_as_one_table(odd_docs, make_docs, batches):
    for docs in (odd_docs, make_docs([(i, f"t{i % 7}") for i in range(40)])):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = exact_dedup.deduplicate_in_batches(docs, batches).collect()
        assert len(got) == len(rows)
        assert sorted((r.doc_id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got
                      if r.doc_id is not None) == brute(rows)
    assert exact_dedup.deduplicate_in_batches(make_docs([]), batches).count() == 0


def test_stage_keeps_one_row_of_each_text(spark, odd_docs, make_docs):
    for docs in (make_docs([(1, "x y"), (1, "x y"), (1, "x  y"), (2, "x y")]),
                 make_docs([(3, "x"), (5, "x"), (5, "own"), (None, "own"), (None, "alone"), (None, "alone")]), odd_docs):
        rows = docs.collect()
        first = {}
        for r in rows:
            text = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
            first.setdefault(text, []).append(r.doc_id)
        got = exact_dedup.stage(spark, docs, "").collect()
        want = sorted(((min((i for i in ids if i is not None), default=None), t) for t, ids in first.items()), key=repr)
        assert sorted(((r.doc_id, re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")) for r in got), key=repr) == want
        assert all(r in rows for r in got) and exact_dedup.stage(spark, docs, "").columns == docs.columns
