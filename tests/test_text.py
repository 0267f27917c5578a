from tessera.functions import text as tx

from conftest import rows


def test_extract_null_on_no_match(spark):
    df = spark.createDataFrame([(1, "Braund, Mr. Owen"), (2, "no title here"), (3, None)], "id int, s string")
    got = rows(df.select("id", tx.extract("s", r" ([A-Za-z]+)\.").alias("t")))
    assert got == [(1, "Mr"), (2, None), (3, None)]


def test_extract_between_default_and_strip(spark):
    df = spark.createDataFrame([(1, "Braund,   Mr. Owen"), (2, "Nobody"), (3, "Rothes, the Countess. of")], "id int, s string")
    got = rows(df.select("id", tx.extract_between("s").alias("t")))
    assert got == [(1, "Mr"), (2, "Unknown"), (3, "the Countess")]


def test_split_parts(spark):
    df = spark.createDataFrame([(1, " Smith , John"), (2, "Single")], "id int, s string")
    got = rows(df.select("id", tx.split_part("s", ",", 1).alias("a"), tx.split_part("s", ",", 2, strip=False).alias("b")))
    assert got == [(1, "Smith", " John"), (2, "Single", None)]


def test_tokens_and_first_token(spark):
    df = spark.createDataFrame([(1, "C23 C25  C27"), (2, None), (3, "   ")], "id int, s string")
    got = rows(df.select("id", tx.token_count("s").alias("n"), tx.first_token("s").alias("f")))
    assert got == [(1, 3, "C23"), (2, 0, "Unknown"), (3, 0, "Unknown")]


def test_normalize_and_first_char(spark):
    df = spark.createDataFrame([(1, "a/5 21171"), (2, None), (3, "")], "id int, s string")
    got = rows(df.select("id", tx.normalize_key("s").alias("k"), tx.first_char("s", "U").alias("c")))
    assert got == [(1, "A/521171", "a"), (2, None, "U"), (3, "", "U")]


def test_recode_map_vs_replace(spark):
    df = spark.createDataFrame([(1, "Mr"), (2, "Dr"), (3, "Zz"), (4, None)], "id int, s string")
    m = {"Mr": "Mr", "Dr": "Rare"}
    got = rows(df.select("id", tx.recode("s", m, "Rare").alias("a"), tx.recode_passthrough("s", m).alias("b"),
                         tx.recode("s", m).alias("c")))
    assert got == [(1, "Mr", "Mr", "Mr"), (2, "Rare", "Rare", "Rare"), (3, "Rare", "Zz", None), (4, "Rare", None, None)]


def test_composite_key_null_propagates_and_safe_text(spark):
    df = spark.createDataFrame([(1, "Smith", 3), (2, None, 2)], "id int, s string, n int")
    got = rows(df.select("id", tx.composite_key("s", "n").alias("k"), tx.safe_text("s").alias("t")))
    assert got == [(1, "Smith_3", "Smith"), (2, None, "nan")]
