import hashlib
from collections import defaultdict

from tessera.llm import line_dedup as ld
from tessera.session import Scratch

SCHEMA = "doc_id long, text string, gone string, kept_lines int, n_chars long"
BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(BLANKS).translate({i: i + 32 for i in range(65, 91)})
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    rank = lambda d: (d is not None, d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or d == max(holders[key(x)], key=rank)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def edge_rows():
    common = "This line is held by very many documents"
    rows = [(i, f"own line number {i} of its own\n  {common.upper() if i % 2 else common} \t\nshort\nshort") for i in range(30)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, common + "\n" + common), (104, common), (104, common)]
    rows += [(None, common), (None, common + "\nx"), (105, "Éa" * 10), (106, "éa" * 10), (107, "Éa" * 10), (108, "Éa" * 10)]
    rows += [(200 + i, "held by two documents only, so it stays") for i in range(2)]
    rows += [(300, "\n".join(f"line {i % 50} of a very long text that repeats" for i in range(20_000)))]
    return rows


def digest(spark, df, docs):
    from pyspark.sql import functions as F

    all_, kept = ld.added_columns(docs)
    out = df.select("doc_id", F.size(all_), F.size(all_) - F.size(kept), F.sha2(F.array_join(kept, "\n"), 256))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_edges_and_clashing_columns_match_brute_force(spark):
    rows = edge_rows()
    docs = spark.createDataFrame([(d, t, "g", 3, len(t or "")) for d, t in rows], SCHEMA)
    for batches, fanout in ((1, 2), (5, 2)):
        assert digest(spark, ld.line_dedup(docs, batches=batches, fanout=fanout), docs) == brute(rows)


def test_texts_lose_their_lines_and_columns_stay(spark):
    rows = edge_rows()
    docs = spark.createDataFrame([(d, t, "g", 3, len(t or "")) for d, t in rows], SCHEMA)
    out = ld.without_frequent_lines(docs)
    assert out.dtypes == docs.dtypes
    got = sorted(
        ((r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in out.collect()), key=repr
    )
    assert got == sorted(((d, h) for d, _, _, h in brute(rows)), key=repr)
    assert all(r["n_chars"] == len(r["text"] or "") and r["gone"] == "g" for r in out.collect())


def test_rows_that_share_an_id_or_have_none_lose_their_own_lines_only(spark):
    common, other = "This line is held by very many documents", "Another line that many documents hold"
    rows = [(i, f"{common}\n{other}") for i in range(10, 15)]
    rows += [(d, t) for d in (None, 1) for t in (common, "a line that this row alone holds", f"mine\n{common}", None)]
    rows += [(None, f"the first of a row without an id\n{other}\n{common}\nlast"), (1, f"{other}\nof the row of id 1 only")]
    rows += [(14, f"row two of the keeper, whose lines stay\n{other}"), (1, common), (None, common)]
    docs = spark.createDataFrame([(d, t, "g", 3, len(t or "")) for d, t in rows], SCHEMA)
    assert digest(spark, ld.line_dedup(docs), docs) == brute(rows)
    texts = [r["text"] for r in ld.without_frequent_lines(docs).collect()]
    assert texts.count("a line that this row alone holds") == 2 and texts.count(None) == 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert ld.line_dedup(docs).count() == 0 and ld.without_frequent_lines(docs).count() == 0


def test_batches_add_only_their_new_keys_and_runs_are_merged(spark):
    store = ld.LineRuns(Scratch(spark), fanout=2)
    lines = lambda texts: ld.hashed_lines(
        spark.createDataFrame(texts, "doc_id long, text string"), "doc_id", "text", 1
    )
    assert store.add(lines([(1, "a\nb"), (2, "a")]), with_new_keys=True).count() == 2
    assert store.add(lines([(3, "b\nc")]), with_new_keys=True).count() == 1
    assert store.add(lines([(4, "a\nc")]), with_new_keys=True).count() == 0
    assert [len(level) for level in store.levels] == [1, 1]
    assert sorted((r["docs"], r["keeper"]) for r in store.merged().collect()) == [(2, 3), (2, 4), (3, 4)]
    assert store.frequent(3).count() == 1
