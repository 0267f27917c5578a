import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from tessera.llm.queries import ORACLES, QUERIES
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert digest(QUERIES[name](spark, SF).toPandas()) == digest(con.sql(ORACLES[name]).df())


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {x[: x.index("_") + 1] for x in names if x.startswith("op")}
    assert "pipeline" in names and [n for n, _ in cp.STAGES][2] == "near_duplicates"


def test_stages_make_their_operators_decisions(spark, tmp_path):
    """Every stage against its operator's own result, which the operator's tests hold against brute force."""
    from tessera.llm import decontaminate, line_dedup, simhash, toxicity
    from tessera.llm.common import crc_fold, read_table

    docs = read_table(spark, SF, "documents")
    model = toxicity.fit_toxicity(docs, read_table(spark, SF, "labels"), crc_fold(4, 2))
    rows = docs.collect()
    toxic = {r["doc_id"] for r, s in zip(rows, model.scores([r["text"] for r in rows]), strict=True) if s >= 0.3}
    at, seen = docs, {}
    for i, (name, stage) in enumerate(cp.STAGES):
        stage(spark, at, SF).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        assert after.columns[: len(docs.columns)] == docs.columns and (i == 4 or after.dtypes == docs.dtypes)
        seen[name] = {r["doc_id"]: r["text"] for r in after.collect()}
        if name == "near_duplicates":
            named = simhash.near_duplicates(at).collect()
            assert set(seen[name]) == {r["component_id"] for r in named}
        if name == "line_dedup":
            want = line_dedup.without_frequent_lines(at)
            assert seen[name] == {r["doc_id"]: r["text"] for r in want.collect()}
        if name == "decontamination":
            bad = {r["doc_id"] for r in decontaminate.contaminated(at, read_table(spark, SF, "benchmark")).collect()}
            assert set(seen[name]) == set(seen["near_duplicates"]) - bad and bad
        at = after
    assert set(seen["toxicity"]) == {r["doc_id"] for r in rows} - toxic
    assert set(seen["mix"]) <= set(seen["decontamination"])


def test_stages_stand_nulls_empty_tables_and_more_columns(spark):
    rows = [(1, None, None, None, None, 5), (2, "", "en", "s", 0, 5), (None, "some text", "en", "s", 9, 5), (2, "", "en", "s", 0, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp int")
    for _, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[:6] == docs.columns
        out.count()
        assert stage(spark, docs.limit(0), SF).count() == 0
