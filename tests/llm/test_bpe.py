import random

import pytest

from tessera.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, decoded int"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.load_vocabulary(PATH))


def wanted(library, text):
    e = library.encode(text or "", add_special_tokens=False)
    return e.ids, library.decode(e.ids, skip_special_tokens=False)


def test_random_texts_as_the_library(library, vocabulary):
    r = random.Random(1)
    symbols = "abcdefthing'ΣσİıÉéé \t\n\x1c\x1f\x85​0129<|endoftext|>-.,日本\U0001f600"
    for _ in range(5000):
        text = "".join(r.choice(symbols) for _ in range(r.randint(0, 50)))
        if r.random() < 0.2:
            text = text[:9] + "<|endoftext|>" + text[9:] + "<|startoftext|>"
        assert (vocabulary.encode(text), vocabulary.decode(vocabulary.encode(text))) == wanted(library, text)


def test_every_assigned_code_point(library, vocabulary):
    """Every 7th code point of all planes, and all of the first."""
    points = [c for c in [*range(0x10000), *range(0x10000, 0x110000, 7)] if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 512):
        text = " ".join(f"a{chr(c)}b" for c in points[i : i + 512])
        assert vocabulary.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_scan_and_heap_merge_alike(vocabulary):
    r = random.Random(2)
    words = [bytes(r.choice(b"etaoinshrdlu") for _ in range(r.randint(1, 90))) for _ in range(2000)]
    words += [bytes([b]) for b in range(256)]
    for word, ids in zip(words, vocabulary.merged(words)):
        assert ids.tolist() == vocabulary.merged_by_heap(word).tolist()


def test_long_words_and_texts(library, vocabulary):
    r = random.Random(3)
    for text in ("".join(r.choice("etaoinshrd") for _ in range(20_000)), "a" * 5000, "word " * 40_000, "é" * 3000):
        assert vocabulary.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_words_kept_are_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 10)
    monkeypatch.setattr(bpe, "TOGETHER", 1)
    texts = [f"w{i}x {i}" for i in range(500)]
    apart = [vocabulary.encode(t) for t in texts]
    assert [x.tolist() for x in vocabulary.encode_all(texts)] == apart
    assert len(vocabulary._kept) <= 20


def test_rows(spark, library):
    texts = [None, "", "  \n", "Hello World's <|endoftext|> 42", "Hello World's <|endoftext|> 42", "x" * 300_000, "ΑΣ ΟΔΟΣ"]
    docs = spark.createDataFrame([(i if i != 3 else None, t, "theirs", i) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    ids = bpe.added_column(docs, "ids")
    encoded = bpe.bpe_encode(docs, PATH)
    decoded = bpe.added_column(encoded, "decoded")
    got = bpe.bpe_decode(encoded, PATH, ids).collect()
    assert (ids, decoded) == ("ids_", "decoded_")
    assert sorted((r["text"] or "", r[ids], r[decoded]) for r in got) == sorted((t or "", *wanted(library, t)) for t in texts)
    assert {r["ids"] for r in got} == {"theirs"} and sorted(r["decoded"] for r in got) == list(range(7))


def test_null_ids_and_empty_tables(spark):
    lists = spark.createDataFrame([(None,), ([],), ([320],)], "ids array<int>")
    assert sorted(r["decoded"] for r in bpe.bpe_decode(lists, PATH).collect())[:2] == ["", ""]
    none = spark.createDataFrame([], SCHEMA)
    assert bpe.bpe_encode(none, PATH).count() == 0


def test_encoding_runs_once(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    both = bpe.bpe_decode(bpe.bpe_encode(docs, PATH), PATH).selectExpr("size(ids) AS n", "ids", "decoded")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [encode(") == 1 and plan.count("decode(encode(") == 0


def test_other_files_are_errors(tmp_path):
    file = tmp_path / "v.json"
    file.write_text('{"model": {"type": "WordLevel"}}')
    with pytest.raises(ValueError):
        bpe.Vocabulary(bpe.load_vocabulary(str(file)))
