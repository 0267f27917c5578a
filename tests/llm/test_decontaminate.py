import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import decontaminate as dc

DOCS = "doc_id long, text string, item_id long, benchmark_matches int"


def brute_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = 2 if a[i - 1] == b[j - 1] else -1
            h[i][j] = max(0, h[i - 1][j - 1] + step, h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=12), st.lists(st.integers(0, 4), max_size=20))
def test_alignment_matches_brute_force(a, b):
    score, first, end = dc.smith_waterman(np.array(a), np.array(b, dtype=np.int64))
    assert score == brute_alignment(a, b)
    if score:
        assert brute_alignment(a, b[first:end]) == score  # the span holds the whole alignment


def fixture(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("bcdfgaeiou"), 6)) for _ in range(2000)]
    items = [(i, " ".join(rng.choice(words, 40))) for i in range(30)]
    text = lambda n: " ".join(rng.choice(words, n))
    docs, leaks = [], set()
    for d in range(300):
        body = text(200)
        if d % 10 == 0:  # every tenth an edited copy
            words_of = items[d // 10][1].split()
            for at in rng.choice(40, 5, replace=False):
                words_of[at] = rng.choice(words)
            body += " " + " ".join(words_of).upper() + "! " + text(50)
            leaks.add((d, d // 10))
        elif d % 3 == 0:  # one item in very many documents
            body += " " + items[29][1]
            leaks.add((d, 29))
        docs.append((d, body, 1, 2))
    docs += [(900, None, 1, 2), (901, "", 1, 2), (None, items[3][1], 1, 2), (902, items[4][1] + " " + text(50_000), 1, 2)]
    docs += [(903, items[5][1], 1, 2), (903, items[5][1], 1, 2), (904, "shorty", 1, 2), (905, "not shorty at all", 1, 2)]
    leaks |= {(None, 3), (902, 4), (903, 5), (904, 50), (905, 50)}
    items += [(50, "Shorty"), (51, None), (52, " . "), (None, text(30)), (7, "a")]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), leaks


def test_copies_are_found_and_nothing_else(spark):
    docs, items, leaks = fixture(spark)
    got = dc.contaminated(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == leaks
    assert len(got) == len(leaks) + 1  # the repeated row
    blocks = dc.contaminated(docs, items, block_words=500).collect()
    assert {(r["doc_id"], r["item_id"]) for r in blocks} == leaks
    clean = dc.decontaminated(docs, items)
    assert clean.columns == docs.columns
    found = {d for d, _ in leaks}
    assert clean.count() == sum(r["doc_id"] not in found for r in docs.collect())


def test_empty_tables(spark):
    docs, items, _ = fixture(spark)
    assert dc.contaminated(docs, items.limit(0)).count() == 0
    assert dc.decontaminated(docs, items.limit(0)).count() == docs.count()
    assert dc.contaminated(docs.limit(0), items).count() == 0
