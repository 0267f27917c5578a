import numpy as np

from tessera.llm import toxicity as tx
from tessera.llm.common import crc_fold

DOCS = "doc_id long, text string, score double, _text int"


def test_fold():
    assert tx.fold("IDI0T") == tx.fold("idiot") == tx.fold("іdіоt") == tx.fold("１d1ot") == tx.fold("id!ot")
    assert tx.fold("$cum") == tx.fold("scum") and tx.fold("mo​ron") == tx.fold("moron")
    assert tx.fold("wow!") == "wow!" and tx.fold(None) == ""


def test_hits_are_words_beginnings_and_not_in_exceptions():
    lexicon = tx.Lexicon({"trash": 2.0, "ab*": 3.0, "abc": 5.0})
    at = lambda t: [(a, w) for a, _, w in lexicon.hits(tx.fold(t))]
    assert at("trash, trashy tr4sh") == [(0, 2.0), (14, 2.0)]
    assert at("abx xab abc") == [(0, 3.0), (8, 5.0)]
    assert at("the trash can is trash") == [(17, 2.0)]
    assert tx.Lexicon({}, []).hits("x") == []


def corpus(spark, n=900):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("aeioumnrst"), 5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        body = list(rng.choice(words, 40))
        if toxic:
            body[5:5] = ["idiot"] if i % 4 == 0 else ["kvel" + "".join(rng.choice(list("aeiou"), 2)), "m0r0n"][: 1 + i % 2]
        rows.append((i, " ".join(body), 0.5, 1))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learned_markers_generalise_to_the_held_out_fold(spark):
    rows, labels = corpus(spark)
    docs = spark.createDataFrame(rows, DOCS)
    held = crc_fold(4, 2)
    model = tx.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), held, sample_rows=500)
    assert any(e.startswith("kv") for e in model.lexicon.weights)
    scores = np.array(model.scores([r[1] for r in rows]))
    y = np.array([y for _, y in labels])
    marked = np.array(["kvel" in r[1] or "idiot" in r[1] or "m0r0n" in r[1] for r in rows])
    assert (marked == (y == 1)).all() and ((scores >= 0.3) == marked).mean() > 0.99
    assert list(model.scores([None, ""])) == list(model.scores(["plain words"] * 2))
    got = docs.unionByName(spark.createDataFrame([(None, None, 0.0, 0), (7, "", 0.0, 0)], DOCS))
    out = got.select(tx.toxicity_score(got["text"], model).alias("s")).collect()
    assert len(out) == len(rows) + 2 and all(0 <= r["s"] <= 1 for r in out)


def test_without_labels_or_rows_the_fixed_list_scores(spark):
    docs = spark.createDataFrame([], DOCS)
    model = tx.fit_toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int"), crc_fold(4, 2))
    low, high = model.scores(["fine words", "you utter idiot"])
    assert low < 0.3 <= high
    one = spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert tx.fit_toxicity(spark.createDataFrame([(1, "a", 0.0, 0)], DOCS), one, crc_fold(4, 2)).scores(["a"])[0] < 0.3


def test_the_model_does_not_depend_on_the_partitioning(spark):
    """Near-copies with different labels, ids with several rows, null ids."""
    rows, labels = corpus(spark, 300)
    copies = [(i + 10_000, *r) for i, *r in rows] + rows[:50] + [(None, *r[1:]) for r in rows]
    more = spark.createDataFrame(rows + copies, DOCS)
    both = spark.createDataFrame(labels + [(i + 10_000, 1 - y) for i, y in labels], "doc_id long, toxic int")
    models = [tx.fit_toxicity(more.repartition(n), both.repartition(n), crc_fold(4, 2), sample_rows=250) for n in (1, 5, 8)]
    for m in models[1:]:
        assert m.lexicon.weights == models[0].lexicon.weights and (m.coefficients == models[0].coefficients).all()


def test_length_is_the_number_of_words():
    lexicon = tx.Lexicon({"trash": 2.0})
    words = ["trash", *["calm"] * 30]
    spaced, lined = (tx.features(lexicon, sep.join(words)) for sep in (" ", "\n"))
    assert spaced == lined == tx.features(lexicon, "  \n ".join(words))
