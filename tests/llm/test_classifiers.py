import numpy as np

from flowml.llm import langid, quality
from flowml.llm.ngrams import WordTable, word_features

DIR = "/root/testdata/sf0.01"


def test_features_do_not_depend_on_the_batch():
    words = ["the", "a", "naïve", "中文", "x" * 300, "the"]
    ids, owner = word_features(words, (2, 3), 12, True)
    for i, w in enumerate(words):
        alone, _ = word_features([w], (2, 3), 12, True)
        assert sorted(ids[owner == i]) == sorted(alone)
    assert ids.max() < 4096 and len(word_features([], (2,), 8, True)[0]) == 0


def test_word_table_sums_and_stays_bounded():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(256, 2)).astype(np.float32)
    t = WordTable(weights, (1, 2), 8, False, limit=50)
    for n in range(20):
        words = [f"w{i}" for i in range(n * 10, n * 10 + 30)]
        at = t.places(words)
        assert len(t.index) <= 50
        for w, row in zip(words, t.rows[at]):
            ids, _ = word_features([w], (1, 2), 8, False)
            assert np.allclose(row[:2], weights[ids].sum(0), atol=1e-4) and row[2] == len(ids)


def test_quality_held_out_accuracy(spark):
    got = quality.op3_quality(spark, DIR).toPandas()
    labels = spark.read.parquet(f"{DIR}/labels.parquet").toPandas()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert len(got) == 1000 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    good = held[held.quality == 1]
    assert (held.predicted == held.quality).mean() >= 0.95 and (good.predicted == 1).all()


def test_quality_edge_cases(spark, odd_docs, make_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(7, None), (None, 1)], "doc_id long, quality int")
    docs = make_docs([(i, "good calm words here " * 3 if i % 2 else "BAD!! BAD!! BAD!!", "en") for i in range(400)])
    model = quality.fit(docs, labels)
    assert len(quality.score(odd_docs, model).collect()) == odd_docs.count()
    kept = quality.keep_good(docs.unionByName(odd_docs), model)
    assert kept.columns == docs.columns and kept.where("text like 'good%'").count() == 200
    assert kept.where("text like 'BAD%'").count() == 0
    assert quality.score(make_docs([]), model).collect() == []
    one = quality.fit(docs, labels.where("quality = 1"))
    assert all(r.score > 0.99 for r in quality.score(odd_docs, one).collect())
    none = quality.fit(make_docs([]), labels)
    assert {r.score for r in quality.score(odd_docs, none).collect()} == {0.5}


def test_language_held_out_accuracy(spark):
    got = langid.op6_language_id(spark, DIR).toPandas()
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "lang").toPandas()
    held = got[got.held_out].merge(docs, on="doc_id")
    assert len(got) == 1000 and (held.lang_pred == held.lang).mean() >= 0.98


def test_language_edge_cases(spark, odd_docs, make_docs):
    docs = make_docs([(i, ("the and of " if i % 2 else "der die und ") * 5, "en" if i % 2 else "de") for i in range(200)])
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.predict(make_docs([(1, "the of and"), (2, "und der die"), (3, None), (4, ""),
                                                            (5, "123 !!! 456"), (6, "² 5")]), model).collect()}
    assert [got[i].lang_pred for i in range(1, 7)] == ["en", "de", "und", "und", "und", "und"]
    assert got[3].score == 0 and 0.5 < got[1].score <= 1
    assert langid.predict(odd_docs, model).count() == odd_docs.count()
    assert langid.predict(make_docs([]), model).collect() == []
    empty = langid.fit(make_docs([(1, "a", None), (2, None, "en")]))
    assert {r.lang_pred for r in langid.predict(docs, empty).collect()} == {"und"}


def test_codewords_are_apart():
    for n in (1, 2, 5, 30):
        code = langid.codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert code.shape[0] == n and (not apart or min(apart) >= 3)
