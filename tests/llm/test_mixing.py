import pytest
from pyspark.sql import functions as F

from flowml.llm import mixing


def goals(sizes):
    """Targets by repeated sharing of the excess: {source: (size, target)}."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / (sum(weight[s] for s in free) or 1)
        over = [s for s in free if weight[s] * level >= 2 * sizes[s]]
        if not over:
            return {s: fixed.get(s, weight[s] * level) for s in order}
        fixed |= {s: 2.0 * sizes[s] for s in over}


ROWS = [(i, "w " * (i * 37 % 211), "en", [None, "a", "b", "ä", "Z", "c"][i * i % 6]) for i in range(300)] + [
    (1000, None, "en", "a"), (1001, "", "en", "only-empty"), (5, "w " * 9, "en", "b"), (None, "w w", "en", None),
    (1002, "w " * 30_000, "en", "b")]


def test_targets_and_taken(make_docs):
    docs = make_docs(ROWS)
    got = mixing.mix_documents(docs).collect()
    assert len(got) == len(ROWS)
    sizes = {}
    for _, t, _, s in ROWS:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = goals(sizes)
    by = {(i, len((t or "").split())): s for i, t, _, s in ROWS}
    taken = {}
    for r in got:
        s = by[(r.id, r.size)]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in want.items():
        assert abs(taken.get(s, 0) - t) <= 4 * mixing.BLOCK, (s, t, taken.get(s))


def test_reruns_agree_and_ranks_are_dense(make_docs):
    docs = make_docs(ROWS[:300])
    a = {r.id: r.taken for r in mixing.mix_documents(docs).collect()}
    b = {r.id: r.taken for r in mixing.mix_documents(docs.repartition(7)).collect()}
    assert a == b
    goal = mixing.targets(mixing.sized(docs, "doc_id", "text", "source", 17))
    drawn = mixing.schedule(goal, 500, chunk=64).groupBy("skey").agg(
        F.count("rank").alias("n"), F.countDistinct("rank").alias("d"), F.max("rank").alias("m")).collect()
    assert sum(r.n for r in drawn) == 500 and all(r.n == r.d == r.m + 1 for r in drawn)


def test_schedule_follows_weights_everywhere(make_docs):
    goal = mixing.targets(mixing.sized(make_docs(ROWS), "doc_id", "text", "source", 17)).collect()
    total = sum(r.target for r in goal)
    spark = make_docs([]).sparkSession
    drawn = mixing.schedule(spark.createDataFrame(goal), 3000)
    for start in (0, 1000, 2500):
        part = {r.skey: r.n for r in drawn.where((F.col("slot") >= start) & (F.col("slot") < start + 500))
                .groupBy("skey").agg(F.count("slot").alias("n")).collect()}
        for r in goal:
            assert abs(part.get(r.skey, 0) - 500 * r.target / total) <= 5


def test_empty_tables(make_docs):
    assert mixing.mix_documents(make_docs([])).collect() == []
    assert [r.taken for r in mixing.mix_documents(make_docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_stage_keeps_columns(make_docs):
    docs = make_docs(ROWS[:60])
    out = mixing.stage(docs.sparkSession, docs, "")
    assert out.columns == docs.columns and out.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 2
