import re

import numpy as np
import xxhash
from itertools import combinations

from tessera.llm import simhash as sh
from tessera.llm.common import read_table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, fp int, component_id string, kept_id int"


def brute_fingerprint(text):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(rows):
    ids, fps = [r[0] for r in rows], [brute_fingerprint(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(
        ((d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(zip(ids, fps, strict=True))), key=repr
    )


def edge_rows():
    long = " ".join(f"w{i % 5000}" for i in range(70_000))
    near = [f"{i} alpha beta gamma delta epsilon " + "zeta eta theta iota kappa lambda mu nu xi " * 30 for i in range(30)]
    texts = [None, "", " \t\n", "One", "one", "ONE two three", "É é É", "é É é", long, long + " x", *near, near[0]]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + [(None, "one"), (100, None), (100, None), (None, "solo text here")]
    return [(d, t, 7, "c", 1) for d, t in rows]


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_edges_and_clashing_columns_match_brute_force(spark):
    rows = edge_rows()
    assert result(sh.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute_components(rows)


def test_whole_table_matches_brute_force_also_where_lists_are_crowded(spark):
    docs = read_table(spark, SF, "documents")
    want = brute_components([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert result(sh.near_duplicates(docs)) == want
    rows = edge_rows()
    crowded = sh.near_duplicates(spark.createDataFrame(rows, SCHEMA), list_cap=1)
    assert result(crowded) == brute_components(rows)


def test_one_of_each_stays(spark):
    rows = edge_rows()
    out = sh.keep_one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "fp", "component_id", "kept_id"]
    want = {c for _, _, c in brute_components(rows)}
    got = [r["doc_id"] for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_unlinked_texts_stay_where_ids_repeat_or_are_missing(spark):
    texts = ["alpha beta gamma delta epsilon", "one two three four five six", "red green blue black white"]
    rows = [(i, t, 7, "c", 1) for i in (None, 4) for t in texts] * 2 + [(9, texts[0], 7, "c", 1), (None, None, 7, "c", 1)]
    out = sh.keep_one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in out if r["text"]) == sorted((4, t) for t in texts)
    assert [r["doc_id"] for r in out if r["text"] is None] == [None] and len(out) == 4
    no_ids = [(None, *r[1:]) for r in rows]
    assert sorted(r["text"] or "" for r in sh.keep_one_of_each(spark.createDataFrame(no_ids, SCHEMA)).collect()) == sorted(["", *texts])
    named = spark.createDataFrame([("b", texts[0]), ("a", texts[0]), (None, texts[0])], "doc_id string, text string")
    assert [r["doc_id"] for r in sh.keep_one_of_each(named).collect()] == ["a"]


def test_empty_table(spark):
    assert sh.keep_one_of_each(spark.createDataFrame([], SCHEMA)).count() == 0
    assert sh.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_key_positions_cover_every_shared_set():
    for shared in (1, 2, 3, 4, 5, 6, 7, 8):
        keys = [set(k) for k in sh.key_positions(shared)]
        assert all(any(k <= set(s) for k in keys) for s in combinations(range(8), shared))
    assert len(sh.key_positions(4)) == 20


def test_list_links_connect_what_is_linked():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 5, dtype=np.uint64)
    fps = np.unique([int(b) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) for b in base for _ in range(40)])
    fps = fps.astype(np.uint64)
    a, b = sh.list_links(fps, 4)
    assert len(a) < len(fps)
    parent = {int(f): int(f) for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a, b, strict=True):
        assert (int(x) ^ int(y)).bit_count() <= 4
        parent[find(int(x))] = find(int(y))
    for x, y in combinations(map(int, fps), 2):
        if (x ^ y).bit_count() <= 4:
            assert find(x) == find(y)
