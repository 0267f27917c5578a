import re

import numpy as np
import pytest

from tessera.llm import mix
from tessera.llm.common import read_table

SCHEMA = "doc_id long, text string, source string, shard int, _size int, mix_shard int"


def rows_of(seed=4):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(900):
        source = ["a", "b", "é", None][int(rng.choice(4, p=[0.6, 0.2, 0.15, 0.05]))]
        out.append((i, " ".join(["w"] * int(rng.integers(0, 60))), source, 1, 2, 3))
    return out + [(900, None, "a", 1, 2, 3), (None, "x y", "a", 1, 2, 3), (901, "x", "b", 1, 2, 3), (901, "x", "b", 1, 2, 3)]


def test_targets():
    assert mix.capped_targets([10, 10, 10], [1, 2, 3]) == [5.0, 10.0, 15.0]
    assert mix.capped_targets([100, 1], [1, 1]) == [98.0, 3.0]
    assert mix.capped_targets([0, 0], [1, 2]) == [0.0, 0.0] and mix.capped_targets([], []) == []
    sizes, weights = [5000, 10, 20, 3, 0], [1.0, 2.0, 3.0, 1.0, 2.0]
    got = mix.capped_targets(sizes, weights)
    assert sum(got) == pytest.approx(sum(sizes)) and all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes, strict=True))


def test_tree_meets_quotas_exactly_and_shards_are_disjoint():
    quotas = np.array([70, 0, 31, 500], dtype=np.int64)
    tree = mix.SplittingTree(9, quotas, 13)
    leaves = [tree.leaf(s) for s in range(13)]
    assert (sum(c for _, c in leaves) == quotas).all()
    at = np.zeros(4, dtype=np.int64)
    for first, count in leaves:
        assert (first == at).all()
        at = at + count
    sizes = [int(c.sum()) for _, c in leaves]
    assert max(sizes) - min(sizes) <= 1
    alone = mix.SplittingTree(9, quotas, 13).leaf(7)  # any order of asking gives the same
    assert (alone[1] == leaves[7][1]).all()


def test_permutation_and_its_inverse():
    factor, inverse, offset = mix.keyed_permutation(17, 2)
    for size in (1, 2, 64, 4096):
        at = [(b * factor + offset) % size for b in range(size)]
        assert sorted(at) == list(range(size))
        assert [((p - offset) * inverse) % size for p in at] == list(range(size))


def test_counts(spark):
    rows = rows_of()
    docs = spark.createDataFrame(rows, SCHEMA)
    options = {"block_docs": 8, "shard_blocks": 4}
    got = mix.mix_counts(docs, **options).toPandas()
    assert len(got) == len(rows)
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, *_ in rows}
    source = {d: s for d, _, s, *_ in rows}
    assert all(words[None if d != d else int(d)] == s for d, s in zip(got["doc_id"], got["size"], strict=True))
    assert (got["taken"] <= 3 * got["size"]).all() and (got["taken"] % got["size"].clip(lower=1) == 0).all()
    assert (got["shards"].map(len) == got["copies"]).all()
    got["source"] = [str(source[None if d != d else int(d)]) for d in got["doc_id"]]
    total = got["size"].sum()
    sizes = got.groupby("source")["size"].sum()
    want = mix.capped_targets([int(sizes[s]) for s in ("a", "b", "é", "None")], [1, 2, 3, 1])
    for name, target in zip(("a", "b", "é", "None"), want, strict=True):
        part = got[got["source"] == name]
        assert part["target"].iloc[0] == pytest.approx(target) and part["source_size"].iloc[0] == sizes[name]
        assert abs(part["taken"].sum() - target) < 60  # less than the longest document
    assert sum(want) == pytest.approx(total)
    again = mix.mix_counts(docs.repartition(5), **options).toPandas()
    key = ["doc_id", "size", "taken"]
    assert got[key].sort_values(key).values.tolist().__repr__() == again[key].sort_values(key).values.tolist().__repr__()


def test_documents_that_do_not_fit_are_passed_over(spark):
    rng = np.random.default_rng(3)
    sizes = [("a", 45_000)] + [("a", 100)] * 400 + [("b", 100)] * 300  # the long one is above the target of a
    sizes += [("c", int(n)) for n in 1 + rng.pareto(0.7, 500).clip(0, 20_000)]  # sizes of every order
    rows = [(i, "w " * n, s, 1, 2, 3) for i, (s, n) in enumerate(sizes)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    got = mix.mix_counts(docs, block_docs=8, shard_blocks=4).toPandas()
    got["source"] = [sizes[i][0] for i in got["doc_id"]]
    for _, part in got.groupby("source"):
        least = part["size"][part["copies"] == part["copies"].min()].min()  # of those left out of the last pass
        assert 0 <= part["target"].iloc[0] - part["taken"].sum() < least + 1
    assert len({x for shards in got["shards"] for x in shards}) > 1 and (got["shards"].map(len) == got["copies"]).all()


def test_mixed_rows_agree_with_the_counts(spark):
    docs = spark.createDataFrame(rows_of(), SCHEMA)
    options = {"block_docs": 8, "shard_blocks": 4}
    out = mix.mixed(docs, **options)
    assert out.columns == docs.columns + ["mix_shard_", "mix_position"]
    got = out.toPandas()
    counts = mix.mix_counts(docs, **options).toPandas()
    assert len(got) == counts["copies"].sum()
    assert got["doc_id"].value_counts().to_dict() == {
        k: v for k, v in counts.groupby("doc_id")["copies"].sum().to_dict().items() if v
    }
    for _, shard in got.groupby("mix_shard_"):
        assert sorted(shard["mix_position"]) == list(range(len(shard)))


def test_empty_and_wordless_tables(spark):
    assert mix.mix_counts(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mix.mixed(spark.createDataFrame([], SCHEMA)).count() == 0
    none = mix.mix_counts(spark.createDataFrame([(1, None, None, 1, 2, 3), (2, " ", "s", 1, 2, 3)], SCHEMA))
    assert sorted(tuple(r)[:5] for r in none.collect()) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_whole_table_comes_near_its_targets(spark):
    got = mix.mix_counts(read_table(spark, "/root/testdata/sf0.01", "documents")).toPandas()
    by_target = got.groupby(["source_size", "target"])["taken"].sum().reset_index()
    assert (abs(by_target["taken"] - by_target["target"]) <= 0.05 * by_target["target"]).all()
