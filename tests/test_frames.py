import json

import pytest

from tessera.sources import frames as fr


def types(spark, rows, names):
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    return {r["column"]: (r["type"], r["n_missing"]) for r in fr.infer_types(df).collect()}


def test_types_of_columns(spark):
    rows = [("1", "1", "True", "2020-02-29", "x", "NaN", "99999999999999999999", "1"), ("-2", "2.5", "false", "2021-01-01", "1", "", "1", "inf"),
            (None, "NA", "n/a", None, "2", None, "2", "3e5")]
    got = types(spark, rows, list("abcdefgh"))
    assert got == {"a": ("bigint", 1), "b": ("double", 1), "c": ("boolean", 1), "d": ("date", 1), "e": ("string", 0), "f": ("double", 3),
                   "g": ("double", 0), "h": ("double", 0)}


def test_mixes_are_text(spark):
    got = types(spark, [("1", "True", "2020-01-01"), ("True", "2020-01-01", "2020-02-30")], list("abc"))
    assert {k: v[0] for k, v in got.items()} == {"a": "string", "b": "string", "c": "string"}


def test_a_late_value_widens_the_type(spark):
    rows = [(i, str(i)) for i in range(5000)]
    for late, kind in ((None, "bigint"), ("7.5", "double"), ("seven", "string")):
        df = spark.createDataFrame([*rows, (9999, late)], "i long, a string").repartitionByRange(4, "i").select("a")
        assert fr.infer_types(df).first()["type"] == kind


def test_csv_without_a_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,name,age,alive\n1,"Braund, Mr. ""O""",22,True\n2,"two\nlines",,False\n3,NA,38.5,True\n')
    got = fr.read_csv(spark, str(tmp_path / "t.csv"))
    assert got.dtypes == [("id", "bigint"), ("name", "string"), ("age", "double"), ("alive", "boolean")]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, 'Braund, Mr. "O"', 22.0, True), (2, "two\nlines", None, False), (3, None, 38.5, True)]


def out(spark, n):
    return spark.range(n).withColumnRenamed("id", "k").selectExpr("k", "k % 2 AS label")


def read(spark, path):
    return spark.read.schema("k long, label long").option("header", True).csv(fr.committed_path(spark, path)).count()


def test_a_failed_write_leaves_the_old_output(spark, tmp_path):
    path = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        fr.committed_path(spark, path)
    fr.write_predictions(out(spark, 10), path, "k", "label")
    broken = out(spark, 20).selectExpr("k", "CASE WHEN k = 13 THEN raise_error('lost') ELSE label END AS label").repartition(4)
    with pytest.raises(Exception):
        fr.write_predictions(broken, path, "k", "label")
    assert read(spark, path) == 10
    fr.write_predictions(out(spark, 30), path, "k", "label")
    assert read(spark, path) == 30


def test_a_switch_that_fails_leaves_the_old_output(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    fr.write_predictions(out(spark, 10), path, "k", "label")
    monkeypatch.setattr(fr._Store, "replace", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        fr.write_predictions(out(spark, 20), path, "k", "label")
    assert read(spark, path) == 10


def test_versions_before_the_last_go(spark, tmp_path):
    path = str(tmp_path / "out")
    folders = [fr.write_partitioned(out(spark, n), path, "label") for n in (3, 4, 5)]
    kept = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert kept == sorted(f.rpartition("/")[2] for f in folders[1:])
    manifest = json.loads((tmp_path / "out" / fr.MANIFEST).read_text())
    assert folders[2].endswith(manifest["version"]) and folders[1].endswith(manifest["previous"])
    assert spark.read.parquet(fr.committed_path(spark, path)).count() == 5


def test_a_version_that_lost_a_file_is_an_error(spark, tmp_path):
    path = str(tmp_path / "out")
    folder = fr.write_predictions(out(spark, 10), path, "k", "label")
    next(p for p in (tmp_path / "out" / folder.rpartition("/")[2]).iterdir() if p.name.startswith("part-")).unlink()
    with pytest.raises(OSError):
        fr.committed_path(spark, path)
