import numpy as np

from tessera.llm import quality as ql
from tessera.llm.common import crc_fold, read_table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_edges(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    held = crc_fold(3, 1)
    model = ql.fit_quality(docs, labels, held, sample_rows=400)
    out = docs.join(labels, "doc_id").select("quality", held(docs["doc_id"]).alias("h"), ql.quality_score(docs["text"], model).alias("s"))
    got = out.where("h").toPandas()
    assert ((got["s"] >= 0.5) == (got["quality"] == 1)).mean() > 0.95
    again = ql.fit_quality(docs.repartition(3), labels, held, sample_rows=400)
    assert np.allclose(model.network.w1, again.network.w1)
    assert len(model.scores([])) == 0
    edge = model.scores([None, "", "x", "word " * 200_000])
    assert edge[0] == edge[1] and ((edge >= 0) & (edge <= 1)).all()


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert list(ql.fit_quality(docs, none, crc_fold(3, 1)).scores(["a", None])) == [0.5, 0.5]


def test_index_vectors_and_pooling():
    v = ql.index_vector("word", 64)
    assert (v == ql.index_vector("word", 64)).all() and (v != 0).sum() == ql.NONZERO
    words, marks = ql.tokens("Big BIG dog dog!!\nx")
    assert words == ["big", "big", "dog", "dog", "!!", "\n", "x"] and marks[ql.REPEAT] == 2 and marks[ql.CAPITALS] == 1


def test_temperature_is_chosen_on_rows_kept_out():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] + 0.5 * rng.normal(size=600) > 0).astype(float)
    net = ql.train_network(x, y)
    p = net.probabilities(x)
    assert ((p > 0.5) == (y == 1)).mean() > 0.85 and net.temperature > 0


def test_unseen_words_have_vectors_of_their_own(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    model = ql.fit_quality(docs, labels, crc_fold(3, 1), sample_rows=200)
    words = ["alphq", "omegq", "kappq", "sigmq"]
    assert len(set(model.vectors.rows(words).tolist())) == 4


def test_rows_that_share_an_id_count_once(spark):
    from tessera.llm.common import bounded_labelled_ids, one_text_per_id

    rows = [(1 + i % 2, f"text {i}", "x", i) for i in range(400)] + [(None, "t", "x", 0), (3, None, "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text string, _y int")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (None, 1)], "doc_id long, quality int")
    ids = bounded_labelled_ids(labels, "doc_id", "quality", lambda c: c < 0, 10)
    got = [sorted(map(tuple, one_text_per_id(docs.repartition(n), ids, "doc_id", "text").select("_id", "_y", "_text").collect())) for n in (1, 7)]
    assert [r[:2] for r in got[0]] == [(1, 0), (2, 1), (3, 1)] and got[0] == got[1]
    model = ql.fit_quality(docs, labels, lambda c: c < 0)
    assert ((model.scores(["a", None]) >= 0) & (model.scores(["a", None]) <= 1)).all()
    empty = docs.limit(0)
    assert list(ql.fit_quality(empty, labels, lambda c: c < 0).scores(["a"])) == [0.5]
