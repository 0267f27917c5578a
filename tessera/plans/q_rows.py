"""Scans, sinks, set operations, projections and string features (S*, U*, P*, T*, B1/B2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import features as fx
from ..functions import text as tx
from ..operators import groups as gr
from ..sources import frames as fr
from .registry import register
from .tables import cases, docs, scores

WS = "[ \\t\\n\\r\\f\\x0B]"
WS_SQL = "[ \\t\\n\\r\\f\\x0B]"


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS_SQL}+|{WS_SQL}+$', '', 'g')"


def _read(spark, d, name):
    return fr.read_table(spark, d, name)


# ---------------------------------------------------------------- S: scans, sinks

@register("scan_schema", "SELECT * FROM cases", ["price", "balance"])
def scan_schema(spark, d):
    """Typed scan of the case table (both splits)."""
    return cases(spark, d)


# columns of the case table as text: whole numbers, fractions, dates, words, and mixes of them
TEXT_COLUMNS = {
    "id": "CAST(id AS {text})",
    "outcome": "CASE WHEN y IS NULL THEN 'NaN' ELSE CAST(y AS {text}) END",
    "price": "CAST(price AS {text})",
    "balance": "CAST(balance AS {text})",
    "whole_or_fraction": "CASE WHEN id % 1000 = 3 THEN '0.5' ELSE CAST(id AS {text}) END",
    "late_word": "CASE WHEN id = (SELECT max(id) FROM cases) THEN 'last' ELSE CAST(id AS {text}) END",
    "is_first_class": "CASE WHEN pclass = 1 THEN 'True' WHEN pclass = 2 THEN 'False' ELSE 'N/A' END",
    "flag_or_number": "CASE WHEN pclass = 1 THEN 'True' ELSE CAST(pclass AS {text}) END",
    "segment": "segment",
    "day": "CASE WHEN pclass = 5 THEN '' ELSE concat('2024-0', CAST(pclass AS {text}), '-15') END",
    "no_day": "CASE WHEN id % 1000 = 3 THEN '2024-02-30' ELSE '2024-02-28' END",
    "nothing": "CASE WHEN pclass = 1 THEN 'null' ELSE '' END",
}


def _infer_sql() -> str:
    tokens = ", ".join("'" + t + "'" for t in fr.NULL_TOKENS)
    columns = ", ".join(f"{e.format(text='VARCHAR')} AS {c}" for c, e in TEXT_COLUMNS.items())
    each = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, bit_or(m) AS marks, count(*) AS n, count(*) FILTER (WHERE m = 0) AS n_missing FROM (
            SELECT CASE WHEN {c} IS NULL OR {c} IN ({tokens}) THEN 0
              WHEN regexp_full_match({c}, '[ \\t]*[+-]?[0-9]+[ \\t]*') AND try_cast({c} AS BIGINT) IS NOT NULL THEN 1
              WHEN regexp_full_match({c}, '[ \\t]*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?[ \\t]*') THEN 2
              WHEN {c} IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false') THEN 4
              WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast({c} AS DATE) IS NOT NULL THEN 8
              ELSE 16 END AS m FROM t)"""
        for c in TEXT_COLUMNS
    )
    return f"""WITH t AS (SELECT {columns} FROM cases), u AS ({each})
        SELECT feature, CASE WHEN marks = 1 THEN 'bigint' WHEN marks IN (0, 2, 3) THEN 'double' WHEN marks = 4 THEN 'boolean'
          WHEN marks = 8 THEN 'date' ELSE 'string' END AS type, n, n_missing FROM u"""


@register("infer_types", _infer_sql().replace("\\\\", "\\"))
def infer_types(spark, d):
    """Types of text columns from all rows in one pass, as a schema-less CSV reader needs them."""
    c = cases(spark, d)
    last = c.agg(F.max("id")).first()[0]  # one number
    texts = {name: e.format(text="STRING").replace("(SELECT max(id) FROM cases)", str(last)) for name, e in TEXT_COLUMNS.items()}
    text = c.select(*[F.expr(e).alias(name) for name, e in texts.items()])
    return fr.infer_types(text).withColumnRenamed("column", "feature")


@register(
    "write_predictions",
    "SELECT id, CAST(p_a >= 0.5 AS INTEGER) AS label FROM scores WHERE split = 'test'",
)
def write_predictions(spark, d):
    """CSV sink of (id, label) for the unlabelled split, read back (round trip)."""
    s = scores(spark, d).where(F.col("split") == "test")
    pred = s.select("id", fx.binarize("p_a", 0.5).alias("label"))
    path = fr.output_path(spark, "predictions")
    fr.write_predictions(pred, path, "id", "label")
    return fr.read_csv(spark, fr.committed_path(spark, path), "id BIGINT, label INT")


@register(
    "table_profile",
    "SELECT split, y, count(*) AS n FROM cases GROUP BY split, y",
)
def table_profile(spark, d):
    """Rows per split and target value."""
    return fr.table_profile(cases(spark, d), ["split", "y"])


# ---------------------------------------------------------------- U: set operations

@register(
    "union_all",
    """SELECT id, cust, split, segment, price FROM cases WHERE split = 'train'
       UNION ALL
       SELECT id, cust, split, segment, price FROM cases WHERE split = 'test'""",
    ["price"],
)
def union_all(spark, d):
    """Labelled part without the target UNION ALL the unlabelled part."""
    c = cases(spark, d).select("id", "cust", "split", "segment", "price", "y")
    train = fr.split_back(c, "train").drop("y")
    test = fr.split_back(c, "test").drop("y")
    return fr.union_all([train, test])


@register(
    "union_missing_cols",
    """SELECT id, segment, y FROM cases WHERE split = 'train'
       UNION ALL
       SELECT id, segment, CAST(NULL AS INTEGER) AS y FROM cases WHERE split = 'test'""",
)
def union_missing_cols(spark, d):
    """Union keeping the target (missing on one side) as NULL, tagged by split."""
    c = cases(spark, d)
    train = fr.split_back(c, "train").select("id", "segment", "y")
    test = fr.split_back(c, "test").select("id", "segment")
    return fr.union_all([train, test], allow_missing=True)


@register(
    "split_back",
    "SELECT id, segment, price FROM cases WHERE split = 'test'",
    ["price"],
)
def split_back(spark, d):
    """U4: recover one part by its split tag (not by position)."""
    return fr.split_back(cases(spark, d), "test").select("id", "segment", "price")


@register(
    "key_intersect",
    """SELECT cust FROM cases WHERE split = 'train'
       INTERSECT
       SELECT cust FROM cases WHERE split = 'test'""",
)
def key_intersect(spark, d):
    """Distinct keys present in both parts."""
    c = cases(spark, d)
    return fr.split_back(c, "train").select("cust").intersect(fr.split_back(c, "test").select("cust"))


@register(
    "category_domain_union",
    """SELECT source FROM docs WHERE split = 'train'
       UNION
       SELECT source FROM docs WHERE split = 'test'""",
)
def category_domain_union(spark, d):
    """Union of the category domains of both parts."""
    x = docs(spark, d)
    return fr.split_back(x, "train").select("source").union(fr.split_back(x, "test").select("source")).distinct()


@register(
    "distinct_count",
    """SELECT count(DISTINCT cust) AS n_cust, count(DISTINCT nation) AS n_nation,
              count(DISTINCT segment) AS n_segment, count(DISTINCT priority) AS n_priority
       FROM cases""",
)
def distinct_count(spark, d):
    """Distinct counts of several columns in one aggregation."""
    c = cases(spark, d)
    return c.agg(
        F.countDistinct("cust").alias("n_cust"),
        F.countDistinct("nation").alias("n_nation"),
        F.countDistinct("segment").alias("n_segment"),
        F.countDistinct("priority").alias("n_priority"),
    )


# ---------------------------------------------------------------- P: projections and flags

@register(
    "derive_sum",
    "SELECT id, nation + pclass + 1 AS size_sum FROM cases",
)
def derive_sum(spark, d):
    """Additive derived column."""
    return cases(spark, d).select("id", (F.col("nation") + F.col("pclass") + 1).alias("size_sum"))


@register(
    "flag_equal",
    "SELECT id, CAST(COALESCE(pclass = 1, false) AS INTEGER) AS is_first FROM cases",
)
def flag_equal(spark, d):
    """Equality flag as 0/1."""
    return cases(spark, d).select("id", fx.flag(F.col("pclass") == 1).alias("is_first"))


@register(
    "flag_present",
    "SELECT id, CAST(balance IS NOT NULL AS INTEGER) AS has_balance FROM cases",
)
def flag_present(spark, d):
    """Not-null flag."""
    return cases(spark, d).select("id", fx.present("balance").alias("has_balance"))


@register(
    "flag_threshold",
    """SELECT id, CAST(COALESCE(balance <= 1200, false) AS INTEGER) AS low_incl,
              CAST(COALESCE(balance < 1200, false) AS INTEGER) AS low_excl FROM cases""",
)
def flag_threshold(spark, d):
    """Inclusive / exclusive threshold flags; missing compares False."""
    c = cases(spark, d)
    return c.select(
        "id",
        fx.threshold_flag("balance", 1200, "<=").alias("low_incl"),
        fx.threshold_flag("balance", 1200, "<").alias("low_excl"),
    )


@register(
    "flag_conjunction",
    """SELECT id, CAST(COALESCE(segment = 'BUILDING' AND balance >= 1800 AND pclass > 1
                              AND trim(string_split(priority, '-')[2]) = 'LOW', false) AS INTEGER) AS is_target
       FROM cases""",
)
def flag_conjunction(spark, d):
    """P5: multi-column conjunction flag (string, numeric, null-safe)."""
    c = cases(spark, d)
    title = tx.split_part("priority", "-", 2)
    cond = (F.col("segment") == "BUILDING") & (F.col("balance") >= 1800) & (F.col("pclass") > 1) & (title == "LOW")
    return c.select("id", fx.flag(cond).alias("is_target"))


@register(
    "flag_group_vs_row",
    """SELECT c.id, CAST(COALESCE(g.n > c.pclass, false) AS INTEGER) AS has_match
       FROM cases c LEFT JOIN (SELECT cust, count(*) AS n FROM cases GROUP BY cust) g ON c.cust = g.cust""",
)
def flag_group_vs_row(spark, d):
    """Compare a group statistic with a row value."""
    c = gr.group_size(cases(spark, d), "cust", "n")
    return c.select("id", fx.flag(F.col("n") > F.col("pclass")).alias("has_match"))


@register(
    "flag_has_group",
    """SELECT c.id, CAST(COALESCE(g.n > 1, false) AS INTEGER) AS has_group
       FROM docs c LEFT JOIN (SELECT source, count(source) AS n FROM docs GROUP BY source) g
       ON c.source = g.source""",
)
def flag_has_group(spark, d):
    """Flag from a group frequency (non-null count)."""
    c = gr.group_size(docs(spark, d), "source", "n", count_col="source")
    return c.select("id", fx.flag(F.col("n") > 1).alias("has_group"))


@register(
    "conditional_overwrite",
    """SELECT c.id, CASE WHEN c.segment = 'AUTOMOBILE' THEN 1 ELSE g.n END AS seg_size
       FROM cases c LEFT JOIN (SELECT segment, nation, count(*) AS n FROM cases GROUP BY segment, nation) g
       ON c.segment = g.segment AND c.nation = g.nation""",
)
def conditional_overwrite(spark, d):
    """``df.loc[mask, col] = v`` as ``when().otherwise()``."""
    c = gr.group_size(cases(spark, d), ["segment", "nation"], "seg_size")
    return c.select(
        "id", F.when(F.col("segment") == "AUTOMOBILE", F.lit(1).cast("bigint")).otherwise(F.col("seg_size")).alias("seg_size")
    )


@register(
    "ratio_per_member",
    """SELECT c.id, c.price / CAST(g.n AS DOUBLE) AS price_per_order
       FROM cases c LEFT JOIN (SELECT cust, count(*) AS n FROM cases GROUP BY cust) g ON c.cust = g.cust""",
    ["price_per_order"],
)
def ratio_per_member(spark, d):
    """Value divided by group size (division by zero -> NULL)."""
    c = gr.group_size(cases(spark, d), "cust", "n")
    return c.select("id", fx.ratio("price", "n").alias("price_per_order"))


@register(
    "numeric_interactions",
    """SELECT id, balance * pclass AS bal_x_class, price * pclass AS price_x_class,
              balance * price AS bal_x_price, nation * pclass AS nation_x_class,
              price * CASE segment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 0 END AS price_x_seg
       FROM cases""",
    ["bal_x_class", "price_x_class", "bal_x_price", "price_x_seg"],
)
def numeric_interactions(spark, d):
    """Products of columns, including a mapped category."""
    c = cases(spark, d)
    seg = tx.recode("segment", {"BUILDING": 1, "MACHINERY": 0})
    return c.select(
        "id",
        fx.product("balance", "pclass").alias("bal_x_class"),
        fx.product("price", "pclass").alias("price_x_class"),
        fx.product("balance", "price").alias("bal_x_price"),
        fx.product("nation", "pclass").alias("nation_x_class"),
        (F.col("price") * seg).alias("price_x_seg"),
    )


@register(
    "string_interactions",
    """SELECT id, segment || '_' || CAST(pclass AS VARCHAR) AS seg_class,
              trim(string_split(priority, '-')[2]) || '_' || segment AS title_seg
       FROM cases""",
)
def string_interactions(spark, d):
    """Two columns joined with ``_`` (numbers cast to text)."""
    c = cases(spark, d)
    return c.select(
        "id",
        fx.string_interaction("segment", "pclass").alias("seg_class"),
        fx.string_interaction(tx.split_part("priority", "-", 2), "segment").alias("title_seg"),
    )


@register(
    "outlier_flag",
    """SELECT id, CAST(COALESCE(price > s.mu + 2 * s.sd, false) AS INTEGER) AS is_outlier
       FROM cases CROSS JOIN (SELECT avg(price) AS mu, stddev_samp(price) AS sd FROM cases) s""",
)
def outlier_flag(spark, d):
    """``x > mean + 2 std`` with global statistics."""
    return gr.outlier_flag(cases(spark, d), "price", 2.0).select("id", "is_outlier")


@register(
    "diff_from_group_mean",
    """SELECT c.id, c.balance - g.m AS balance_diff
       FROM cases c LEFT JOIN (SELECT cust, avg(balance) AS m FROM cases GROUP BY cust) g ON c.cust = g.cust""",
    ["balance_diff"],
)
def diff_from_group_mean(spark, d):
    """Value minus its group mean."""
    return gr.diff_from_group_mean(cases(spark, d), "cust", "balance", "balance_diff").select("id", "balance_diff")


@register(
    "select_features",
    "SELECT id, split, y, segment, nation, pclass, price, balance FROM cases",
    ["price", "balance"],
)
def select_features(spark, d):
    """Drop an exclusion list."""
    return cases(spark, d).drop("cust", "name", "priority")


@register(
    "confident_rows",
    """SELECT id, p_a, CAST(p_a >= 0.5 AS INTEGER) AS label FROM scores
       WHERE split = 'test' AND (p_a >= 0.9 OR p_a <= 0.1)""",
    ["p_a"],
)
def confident_rows(spark, d):
    """Unlabelled rows in the confidence band ``p >= hi or p <= lo``."""
    s = scores(spark, d).where((F.col("split") == "test") & fx.confident("p_a", 0.9, 0.1))
    return s.select("id", "p_a", fx.binarize("p_a").alias("label"))


@register(
    "binarize",
    """SELECT id, CAST(p_a >= 0.5 AS INTEGER) AS label_ge, CAST(p_a > 0.5 AS INTEGER) AS label_gt FROM scores""",
)
def binarize(spark, d):
    """Probability to label with ``>=`` or ``>``."""
    s = scores(spark, d)
    return s.select("id", fx.binarize("p_a", 0.5, True).alias("label_ge"), fx.binarize("p_a", 0.5, False).alias("label_gt"))


@register(
    "risk_band",
    """SELECT id, CASE WHEN p_a < 0.3 THEN 'low' WHEN p_a < 0.5 THEN 'medium' WHEN p_a < 0.7 THEN 'high'
                       ELSE 'very_high' END AS band FROM scores""",
)
def risk_band(spark, d):
    """P20: if/elif banding."""
    return scores(spark, d).select("id", fx.band("p_a", [0.3, 0.5, 0.7], ["low", "medium", "high", "very_high"]).alias("band"))


@register(
    "blend_fixed",
    "SELECT id, 0.6 * p_a + 0.4 * p_b AS p_blend, 1 - y AS y_inv FROM scores",
    ["p_blend"],
)
def blend_fixed(spark, d):
    """Fixed-weight blend of two scores; target inversion."""
    s = scores(spark, d)
    return s.select("id", fx.blend({"p_a": 0.6, "p_b": 0.4}).alias("p_blend"), fx.invert("y").alias("y_inv"))


# ---------------------------------------------------------------- T: strings

@register(
    "extract_title",
    r"SELECT id, nullif(regexp_extract(text, ' ([A-Za-z]+)\.', 1), '') AS title FROM docs",
)
def extract_title(spark, d):
    """Leftmost word before a dot over the whole text (NULL when none)."""
    return docs(spark, d).select("id", tx.extract("text", r" ([A-Za-z]+)\.").alias("title"))


@register(
    "extract_between",
    "SELECT id, COALESCE(" + _strip_sql(f"nullif(regexp_extract(text, ',{WS_SQL}*([^\\.]+)\\.', 1), '')") + ", 'Unknown') AS clause FROM docs",
)
def extract_between(spark, d):
    """Text between the first comma and the next dot, stripped, default ``Unknown``."""
    return docs(spark, d).select("id", tx.extract_between("text", ",", ".", "Unknown").alias("clause"))


@register(
    "split_first",
    "SELECT p_partkey AS id, " + _strip_sql("string_split(p_name, ' ')[1]") + " AS first_word FROM part",
)
def split_first(spark, d):
    """First piece of a split, stripped."""
    return _read(spark, d, "part").select(F.col("p_partkey").alias("id"), tx.split_part("p_name", " ", 1).alias("first_word"))


@register(
    "split_second",
    "SELECT c_custkey AS id, string_split(c_name, '#')[2] AS number_part, string_split(c_name, '#')[3] AS absent FROM customer",
)
def split_second(spark, d):
    """T4: second / third piece of a split, NULL when absent."""
    c = _read(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        tx.split_part("c_name", "#", 2, strip=False).alias("number_part"),
        tx.split_part("c_name", "#", 3, strip=False).alias("absent"),
    )


@register(
    "normalize_key",
    f"SELECT p_partkey AS id, upper(regexp_replace(p_name, '{WS_SQL}+', '', 'g')) AS name_key FROM part",
)
def normalize_key(spark, d):
    """T5: remove whitespace, upper-case."""
    return _read(spark, d, "part").select(F.col("p_partkey").alias("id"), tx.normalize_key("p_name").alias("name_key"))


@register(
    "first_char",
    "SELECT id, COALESCE(nullif(substr(text, 1, 1), ''), 'X') AS first_char FROM docs",
)
def first_char(spark, d):
    """First character with a default."""
    return docs(spark, d).select("id", tx.first_char("text", "X").alias("first_char"))


@register(
    "first_token",
    f"SELECT id, COALESCE(list_filter(regexp_split_to_array(COALESCE(text, ''), '{WS_SQL}+'), lambda x: x <> '')[1], 'Unknown') AS first_token FROM docs",
)
def first_token(spark, d):
    """First whitespace token of the whole text, default ``Unknown``."""
    return docs(spark, d).select("id", tx.first_token("text").alias("first_token"))


@register(
    "extract_prefix",
    r"SELECT p_partkey AS id, COALESCE(nullif(regexp_extract(p_brand, '([A-Za-z/\.]+)', 1), ''), 'NONE') AS prefix FROM part",
)
def extract_prefix(spark, d):
    """Leading letters / slashes / dots, default ``NONE``."""
    p = _read(spark, d, "part")
    return p.select(F.col("p_partkey").alias("id"), F.coalesce(tx.extract("p_brand", r"([A-Za-z/\.]+)"), F.lit("NONE")).alias("prefix"))


@register(
    "extract_number",
    r"SELECT c_custkey AS id, COALESCE(TRY_CAST(nullif(regexp_extract(c_name, '(\d+)', 1), '') AS BIGINT), 0) AS number FROM customer",
)
def extract_number(spark, d):
    """First digit run as a number, 0 when absent."""
    c = _read(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("id"), F.coalesce(tx.extract("c_name", r"(\d+)").try_cast("bigint"), F.lit(0).cast("bigint")).alias("number")
    )


@register(
    "token_count",
    f"SELECT id, CAST(len(list_filter(regexp_split_to_array(COALESCE(text, ''), '{WS_SQL}+'), lambda x: x <> '')) AS BIGINT) AS n_tokens FROM docs",
)
def token_count(spark, d):
    """Whitespace token count over the whole text."""
    return docs(spark, d).select("id", tx.token_count("text").cast("bigint").alias("n_tokens"))


@register(
    "string_length",
    "SELECT id, CAST(length(text) AS BIGINT) AS n_chars FROM docs",
)
def string_length(spark, d):
    """Character length of the whole text."""
    return docs(spark, d).select("id", tx.string_length("text").cast("bigint").alias("n_chars"))


@register(
    "recode_default",
    """SELECT id, CASE trim(string_split(priority, '-')[2]) WHEN 'URGENT' THEN 'High' WHEN 'HIGH' THEN 'High'
                  WHEN 'MEDIUM' THEN 'Mid' ELSE 'Other' END AS urgency FROM cases""",
)
def recode_default(spark, d):
    """Dictionary recode, unmapped -> default."""
    title = tx.split_part("priority", "-", 2)
    m = {"URGENT": "High", "HIGH": "High", "MEDIUM": "Mid"}
    return cases(spark, d).select("id", tx.recode(title, m, "Other").alias("urgency"))


@register(
    "recode_passthrough",
    """SELECT p_partkey AS id,
              CASE p_type WHEN 'ECONOMY' THEN 'BUDGET' WHEN 'PROMO' THEN 'BUDGET' ELSE p_type END AS type_group,
              CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'Top' ELSE p_brand END AS brand_group
       FROM part""",
)
def recode_passthrough(spark, d):
    """``replace(dict)`` keeps unmapped values; ``replace(list, v)``."""
    p = _read(spark, d, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        tx.recode_passthrough("p_type", {"ECONOMY": "BUDGET", "PROMO": "BUDGET"}).alias("type_group"),
        tx.recode_list("p_brand", ["Brand#1", "Brand#2", "Brand#3"], "Top").alias("brand_group"),
    )


@register(
    "collapse_rare",
    """SELECT x.id, CASE WHEN g.n >= 5 THEN x.k ELSE 'RARE' END AS lang_source
       FROM (SELECT id, lang || '-' || source AS k FROM docs) x
       JOIN (SELECT lang || '-' || source AS k, count(*) AS n FROM docs GROUP BY 1) g ON x.k = g.k""",
)
def collapse_rare(spark, d):
    """Categories seen fewer than 5 times become ``RARE``."""
    x = docs(spark, d).select("id", tx.composite_key("lang", "source", sep="-").alias("lang_source"))
    return gr.collapse_rare(x, "lang_source", 5, "RARE").select("id", "lang_source")


@register(
    "composite_key",
    "SELECT id, segment || '_' || CAST(nation AS VARCHAR) AS family_id FROM cases",
)
def composite_key(spark, d):
    """Composite key (NULL-propagating)."""
    return cases(spark, d).select("id", tx.composite_key("segment", "nation").alias("family_id"))


# ---------------------------------------------------------------- B1/B2/B7: fixed-edge bins

_EDGES = [0, 1000, 2500, 5000, 7500, 10000]
_LABELS = ["Tiny", "Small", "Mid", "Large", "Huge"]


@register(
    "bin_fixed",
    """SELECT id,
         CASE WHEN balance > 0 AND balance <= 1000 THEN 'Tiny' WHEN balance > 1000 AND balance <= 2500 THEN 'Small'
              WHEN balance > 2500 AND balance <= 5000 THEN 'Mid' WHEN balance > 5000 AND balance <= 7500 THEN 'Large'
              WHEN balance > 7500 AND balance <= 10000 THEN 'Huge' END AS balance_bin,
         CASE WHEN nation + pclass > 0 AND nation + pclass <= 1 THEN 0 WHEN nation + pclass > 1 AND nation + pclass <= 4 THEN 1
              WHEN nation + pclass > 4 AND nation + pclass <= 20 THEN 2 END AS size_cat
       FROM cases""",
)
def bin_fixed(spark, d):
    """Right-closed fixed edges with labels; bin index for a size category."""
    c = cases(spark, d)
    return c.select(
        "id",
        fx.cut("balance", _EDGES, _LABELS).alias("balance_bin"),
        fx.cut(F.col("nation") + F.col("pclass"), [0, 1, 4, 20]).alias("size_cat"),
    )


@register(
    "bin_fixed_lowest",
    """SELECT id,
         COALESCE(CASE WHEN balance >= 0 AND balance <= 1000 THEN 'Tiny' WHEN balance > 1000 AND balance <= 2500 THEN 'Small'
              WHEN balance > 2500 AND balance <= 5000 THEN 'Mid' WHEN balance > 5000 AND balance <= 7500 THEN 'Large'
              WHEN balance > 7500 AND balance <= 10000 THEN 'Huge' END, 'nan') AS balance_bin
       FROM cases""",
)
def bin_fixed_lowest(spark, d):
    """Lowest edge included, out of range / missing -> text ``nan``."""
    c = cases(spark, d)
    return c.select("id", tx.safe_text(fx.cut("balance", _EDGES, _LABELS, include_lowest=True)).alias("balance_bin"))
