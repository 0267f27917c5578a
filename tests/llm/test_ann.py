import numpy as np

from tessera.llm import ann
from tessera.llm.common import read_table

SCHEMA = "vec_id long, embedding array<float>, shard int, vector string"
by20 = lambda c: c % 20 == 0


def brute(ids, vectors, query, k=20):
    s = vectors.astype(np.float64) @ vectors[list(ids).index(query)].astype(np.float64)
    other = np.array(ids) != query
    order = np.lexsort((np.array(ids)[other], -s[other]))[:k]
    return list(np.array(ids)[other][order])


def recall(found, ids, vectors, k=20):
    hit = total = 0
    for query, rows in found.groupby("query_id"):
        want = brute(ids, vectors, query, k)
        hit += len(set(rows["vec_id"]) & set(want))
        total += len(want)
    return hit / total


def test_recall_over_several_shards(spark):
    table = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    pdf = table.toPandas()
    vectors = np.array(pdf["embedding"].tolist())
    got = ann.nearest(table, by20, shard_vectors=1500, chunk_queries=100).toPandas()
    assert len(got) == 20 * (pdf["vec_id"] % 20 == 0).sum()
    assert recall(got, pdf["vec_id"].tolist(), vectors) >= 0.95
    assert (got.groupby("query_id")["rank"].max() == 20).all() and (got["query_id"] != got["vec_id"]).all()
    by_id = dict(zip(pdf["vec_id"], vectors.astype(np.float64), strict=True))
    assert np.allclose([by_id[a] @ by_id[b] for a, b in zip(got["query_id"], got["vec_id"], strict=True)], got["score"], rtol=1e-12)


def test_edges_ties_and_copies(spark):
    rows = [(i, [1.0, 2.0], 1, "x") for i in range(60)]  # one vector, very common
    rows += [(100 + i, [float(i), -1.0], 1, "x") for i in range(10)]
    rows += [(0, [1.0, 2.0], 1, "x")]  # a repeated row
    rows += [(200, None, 1, "x"), (220, [0.0, 0.0], 1, "x"), (240, [float("nan"), 1.0], 1, "x"), (260, [None, 1.0], 1, "x")]
    rows += [(280, [float("inf"), 1.0], 1, "x"), (None, [1.0, 1.0], 1, "x"), (300, [], 1, "x"), (320, [1.0, 2.0, 3.0], 1, "x")]
    got = ann.nearest(spark.createDataFrame(rows, SCHEMA), by20, shard_vectors=4).toPandas()
    assert sorted(got["query_id"].unique()) == [0, 20, 40, 100]
    valid = [(i, v) for i, v, *_ in rows[:70]]
    ids, vectors = [i for i, _ in valid], np.array([v for _, v in valid])
    for query, part in got.groupby("query_id"):
        assert part.sort_values("rank")["vec_id"].tolist() == brute(ids, vectors, query)
        assert part.sort_values("rank")["rank"].tolist() == list(range(1, 21))


def test_few_candidates_and_an_empty_table(spark):
    few = ann.nearest(spark.createDataFrame([(0, [1.0], 1, "x"), (1, [2.0], 1, "x")], SCHEMA), by20)
    assert [tuple(r) for r in few.collect()] == [(0, 1, 1, 2.0)]
    assert ann.nearest(spark.createDataFrame([], SCHEMA), by20).count() == 0
