import numpy as np

from tessera.llm import licences as lc
from tessera.llm.common import read_table

SF = "/root/testdata/sf0.01"


def test_altered_notices_are_told_apart_and_other_text_is_unknown(spark):
    unknown = lc.sample_paragraphs(read_table(spark, SF, "documents"), "doc_id", "text", 500)
    model = lc.train(unknown)
    rng = np.random.default_rng(99)
    others = sorted({w for p in unknown for w in lc.words_of(p)})
    right = total = 0
    for family, templates in lc.TEMPLATES.items():
        for template in templates:
            assert model.classify(template)[0] == family
            if len(lc.words_of(template)) < 8:
                continue
            for words in lc._variants(rng, lc.words_of(template), others, 10):
                right += model.classify(" ".join(words))[0] == family
                total += 1
    assert right / total > 0.8
    assert all(model.classify(s)[0] == lc.UNKNOWN for s in lc.NOT_LICENCES)
    fresh = [r["text"] for r in read_table(spark, "/root/testdata/sf0.001", "documents").collect()]
    lines = [x for t in fresh for x in t.split("\n") if "icens" not in x and "reserved" not in x]
    assert all(model.classify(x)[0] == lc.UNKNOWN for x in lines)


def test_whole_documents_and_edges(spark):
    notice = "Released under the MIT License."
    rows = [(1, f"é text\n{notice}\nmore"), (2, None), (3, ""), (4, "\n\n"), (5, "word " * 100_000 + "\n" + notice), (None, notice), (1, notice)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, found string")
    got = sorted(((r["doc_id"], r["families"], [(f["start"], f["end"]) for f in r["found"]]) for r in lc.licence_scan(docs).collect()), key=repr)
    end = 500_001 + len(notice)
    want = [(1, "mit", [(7, 38)]), (2, "", []), (3, "", []), (4, "", []), (5, "mit", [(500_001, end)]), (None, "mit", [(0, 31)]), (1, "mit", [(0, 31)])]
    assert got == sorted(want, key=repr)
    assert lc.licence_scan(docs.limit(0)).count() == 0


def test_dual_notices_and_texts_of_one_line_give_every_family(spark):
    model = lc.train(lc.sample_paragraphs(read_table(spark, SF, "documents"), "doc_id", "text", 500))
    families = lambda text: sorted({f["family"] for f in model.scan(text)})
    assert families("Licensed under the Apache License, Version 2.0 or the MIT License") == ["apache-2.0", "mit"]
    assert families("Released under the MIT License and the BSD 3-Clause License.") == ["bsd", "mit"]
    notices = {f: lc.TEMPLATES[f][0] for f in ("apache-2.0", "gpl", "mit", "mpl-2.0")}
    filler = "the story of the house goes on in the next part of the book " * 40
    text = filler + filler.join(notices.values()) + filler
    found = {f["family"]: text[f["start"] : f["end"]] for f in model.scan(text)}
    assert sorted(found) == sorted(notices) and len(model.scan(text)) == 4
    assert all(part in text and len(set(lc.words_of(part)) & set(lc.words_of(notices[f]))) >= 3 for f, part in found.items())
    assert families(notices["gpl"] + " " + notices["mit"]) == ["gpl", "mit"]
    for family, templates in lc.TEMPLATES.items():  # one notice is not taken for two
        assert all(families(t) == [family] for t in templates)
    assert all(families(t) == [] for t in [*lc.NOT_LICENCES, filler, " ".join(lc.NOT_LICENCES)])
