import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import lexical as lx

DOCS = "doc_id long, text string, score string, item_id int"
ITEMS = "item_id long, text string, rank string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items, k=10):
    held = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in held]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), c, n in zip(docs, held, sizes):
            if not n:
                continue
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, **limits):
    d = spark.createDataFrame([(i, t, "x", 0) for i, t in docs], DOCS).repartition(3)
    b = spark.createDataFrame([(i, t, "y") for i, t in items], ITEMS)
    return sorted([tuple(r) for r in lx.ranked_search(d, b, **limits).collect()], key=repr)


def corpus(seed, n=300):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "日本", "a-b", "X", "the", "the", "the"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(r.choices(words, weights, k=r.randint(1, 40)))) for i in range(n)], [
        (i, " ".join(r.choices(words, k=r.randint(1, 12)))) for i in range(12)
    ]


EDGES = [(None, "w1 w2 w3"), (None, None), (901, ""), (902, " .,; "), (903, "w1 " * 50_000), (904, "w1 w2"), (904, "w1 w2"),
         (904, "w3"), (905, "ÀÉ àé Àé"), (906, "W1 W2")]


@pytest.mark.parametrize("limits", [{}, {"shard_postings": 200}, {"block_words": 15, "shard_postings": 50}])
def test_as_brute_force(spark, limits):
    docs, items = corpus(1)
    docs = docs + EDGES
    items = items + [(50, None), (51, ""), (52, "nowhere"), (None, "w1 w2 w2 ÀÉ"), (3, "w3 w3 w5")]
    assert found(spark, docs, items, **limits) == brute(docs, items)


def test_ties_take_the_smallest_ids(spark):
    docs = [(i, "same text here") for i in random.Random(2).sample(range(1000), 60)]
    assert found(spark, docs, [(1, "text")], shard_postings=7) == brute(docs, [(1, "text")])


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None)], [(1, "a")]) == []


def test_limited_accumulators_are_exact():
    """Many shards of random postings: the same best documents as a full evaluation."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        n, v = int(rng.integers(1, 80)), 8
        held = rng.random((n, v)) < rng.random(v)
        docs, which = np.nonzero(held)
        tf, m = rng.integers(1, 6, len(docs)), rng.integers(25, 200, n)
        shard = lx.Shard(np.arange(n), np.zeros(n, bool), m, docs, which + 1, tf)
        item = [(int(t) + 1, int(rng.integers(0, 50))) for t in np.argsort(held.sum(axis=0))]
        full = np.zeros(n, dtype=np.int64)
        for t, w in item:
            at = which == t - 1
            full[docs[at]] += w * lx.impacts(tf[at], m[docs[at]])
        order = np.lexsort((np.arange(n), -full))[:5]
        order = order[full[order] > 0]
        places, scores = shard.best(item, 5)
        assert places.tolist() == order.tolist() and scores.tolist() == full[order].tolist()
