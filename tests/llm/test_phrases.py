import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import phrases as ph
from tessera.llm.automata import CountAutomaton

SCHEMA = "doc_id long, text string, lang string, phrase string, n int"


def brute(rows, least, top, percent=80, longest=4):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        inner = Counter()
        for g, a in candidates.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inner[g[i : i + k]] = max(inner[g[i : i + k]], a)
        scored = []
        for g, a in candidates.items():
            if 100 * inner[g] >= percent * a and inner[g]:
                continue
            cuts = [(2_000_000 * a // (counts[g[:k]] + counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(g).encode(), a, counts[g[:k]], counts[g[k:]], total[lang], score))
        for i, (_, _, phrase, *rest) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, phrase.decode(), *rest))
    return sorted(out)


def found(spark, rows, **limits):
    docs = spark.createDataFrame([(i, t, lang, "x", 0) for i, t, lang in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in ph.collocations(docs, filter_bits=16, **limits).collect())


def corpus(n=120):
    r = random.Random(4)
    words = ["New", "york", "city", "of", "the", "a\x01", "été", "日本", "x-y", "b"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(n):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", ". ", "\n", "  "]) for _ in range(r.randint(0, 60)))
        text += " new York City hall" * r.randint(0, 3) + "; the end of the day" * r.randint(0, 2)
        rows.append((i, text, r.choice(["en", "de", None, "und"])))
    return rows + [(None, None, "en"), (1, "", "xx"), (1, ".,;", None), (7, "new york " * 4000, "fr"), (8, "a b", "en"), (8, "a b", "en")]


@pytest.mark.parametrize(
    "limits",
    [{}, {"flush_words": 300, "run_grams": 40, "range_grams": 50}, {"flush_words": 1000, "run_grams": 7, "range_grams": 5}],
)
def test_as_brute_force(spark, limits):
    rows = corpus()
    assert found(spark, rows, least=3, top=50, **limits) == brute(rows, 3, 50)


def test_full_bit_table_loses_nothing(spark):
    """A table of 64 bits is all ones: everything is counted, nothing lost."""
    rows = corpus(40)
    docs = spark.createDataFrame([(i, t, lang, "x", 0) for i, t, lang in rows], SCHEMA)
    got = sorted(tuple(r) for r in ph.collocations(docs, filter_bits=6, least=3, top=50).collect())
    assert got == brute(rows, 3, 50)


def test_empty_tables(spark):
    assert found(spark, [], least=2) == []
    assert found(spark, [(1, None, None)], least=2) == []


def test_products_beyond_64_bits(spark):
    a = 10**14
    one = spark.createDataFrame([(a, a, a)], "a long, l long, r long")
    got = one.selectExpr("(CAST(a AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + r) AS score").first()[0]
    assert got == 2_000_000 * a // (2 * a)


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_automaton_lists_composes_and_unites(n):
    rng = np.random.default_rng(n)
    words = sorted(f"w{i}".encode() for i in range(12))

    def some():
        grams = Counter(tuple(g) for g in rng.integers(0, 12, (400, n)).tolist())
        rows = np.array(sorted(grams))
        counts = np.array([min(grams[tuple(r)], 2) for r in rows.tolist()])
        return {tuple(words[i] for i in r): int(c) for r, c in zip(rows.tolist(), counts)}, CountAutomaton.build(words, rows, counts, block=37)

    as_dict = lambda a: dict(zip(a.grams(a.listed()[0]), a.listed()[1].tolist()))
    first, a = some()
    second, b = some()
    a = CountAutomaton.from_bytes(a.to_bytes())
    assert as_dict(a) == first and list(as_dict(a)) == sorted(first)
    assert as_dict(CountAutomaton.union([a, b])) == dict(Counter(first) + Counter(second))
    pieces = a.cut([5, 5, 9])
    assert [len(x.listed()[0]) for x in pieces] == [5, 0, 4, len(first) - 9]
    wanted = list(second)[:50] + [(b"none",) * n]
    known = sorted({w for g in wanted for w in g})
    rows = np.array([[known.index(w) for w in g] for g in wanted])
    assert a.composed(known, rows).tolist() == [first.get(g, 0) for g in wanted]
    assert as_dict(a.at_least(2)) == {g: c for g, c in first.items() if c >= 2}


def test_equal_states_are_shared():
    """100 first words with the same followers have one state."""
    rows = np.array([(i, j) for i in range(100) for j in range(100, 110)])
    a = CountAutomaton.build([f"{i:03}".encode() for i in range(110)], rows, np.ones(len(rows), int), block=64)
    assert len(a.firsts[1]) - 1 == 1 and len(a.labels[1]) == 10


def test_parts_are_looked_up_in_bounded_memory():
    import tracemalloc

    import numpy as np

    from tessera.llm import phrases as ph

    n, bits = 1_000_000, 12
    words = [b"%d" % i for i in range(50)]
    stream = np.random.default_rng(0).integers(2, 52, n).astype(np.int32)
    full, none = np.full(1 << (bits - 6), 2**64 - 1, dtype=np.uint64), np.zeros(1 << (bits - 6), dtype=np.uint64)
    tracemalloc.start()
    assert len(ph._counted("en", words, stream, 4, [full, none], bits)[1]) == 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * n


def test_counted_ngrams_take_four_bytes_a_word():
    from tessera.llm.phrases import _counted

    words, rows, counts = _counted("en", [b"b", b"a"], np.array([3, 2, 3, 2, 1], dtype=np.int32), 2, [], 26)
    assert rows.dtype == np.int32
    assert words == [b"a", b"b"] and rows.tolist() == [[0, 1], [1, 0]] and counts.tolist() == [2, 1]


def test_wide_rows_are_written_in_small_row_groups(spark, monkeypatch):
    """Automata and streams of megabytes: neither a writer nor a reader holds a whole file of them."""
    import pyarrow.parquet as pq

    groups = []

    class Kept(ph.Scratch):
        def save(self, df, name="table", *args, **options):
            out = super().save(df, name, *args, **options)
            for path in out.inputFiles() if name.startswith(("streams", "runs", "counts")) else []:
                meta = pq.ParquetFile(path.removeprefix("file://")).metadata
                groups.extend(meta.row_group(i).num_rows for i in range(meta.num_row_groups))
            return out

    monkeypatch.setattr(ph, "Scratch", Kept)
    monkeypatch.setattr(ph, "_WIDE_ROWS", {**ph._WIDE_ROWS, "parquet.block.size": "1"})
    rows = corpus()
    assert found(spark, rows, least=3, top=50, flush_words=300, run_grams=40, range_grams=50) == brute(rows, 3, 50)
    assert len(groups) > 50 and max(groups) == 1


def test_runs_leave_a_task_one_at_a_time():
    rows = np.array([(i, i + 1) for i in range(10)], dtype=np.int32)
    batches = list(ph._as_runs("en", 11, [b"%02d" % i for i in range(11)], rows, np.ones(10, np.int64), 4))
    assert [b.num_rows for b in batches] == [1, 1, 1]
    assert [b.column(2)[0].as_py() for b in batches] == [4, 4, 2] and [b.column(3)[0].as_py() for b in batches] == [11, 0, 0]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_small_pieces_of_a_run_stay_small(n):
    """A run cut into many pieces: each as bytes is little more than its n-grams, and united they are the run."""
    rng = np.random.default_rng(n)
    words = sorted(f"w{i}".encode() for i in range(40))
    rows = np.unique(rng.integers(0, 40, (900, n)), axis=0)
    counts = rng.integers(1, 300, len(rows))
    run = CountAutomaton.build(words, rows, counts)
    places = sorted(rng.integers(0, len(rows) + 1, 60).tolist())
    blobs = [p.to_bytes() for p in run.cut(places)]
    assert len(blobs) == 61 and max(len(b) - 40 * n * (p - q) for b, q, p in zip(blobs, [0, *places], [*places, len(rows)])) < 400
    pieces = [CountAutomaton.from_bytes(b) for b in blobs]
    listed = [(g, c) for p in pieces if p.words for g, c in zip(p.grams(p.listed()[0]), p.listed()[1].tolist())]
    assert listed == list(zip(run.grams(rows), counts.tolist()))
    for least in (0, 150):
        whole, wanted = CountAutomaton.union(pieces, least), run.at_least(least)
        assert whole.to_bytes() == wanted.to_bytes()
