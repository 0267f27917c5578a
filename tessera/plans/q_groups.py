"""Aggregations, group statistics on rows, joins, top-k and imputation (A*, W*, J*, O*, I*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators import groups as gr
from ..operators import impute as im
from ..operators.ordered import exact_median
from .registry import register
from .tables import cases, docs, scores

# ---------------------------------------------------------------- A: aggregations


@register(
    "global_stats",
    """SELECT avg(price) AS price_mean, stddev_samp(price) AS price_std, median(price) AS price_median,
              min(price) AS price_min, max(price) AS price_max, median(balance) AS balance_median
       FROM cases""",
    ["price_mean", "price_std", "price_median", "price_min", "price_max", "balance_median"],
)
def global_stats(spark, d):
    """Global mean, sample std, exact median, min, max."""
    c = cases(spark, d)
    m = c.agg(
        F.avg("price").alias("price_mean"),
        F.stddev_samp("price").alias("price_std"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
    )
    # Both medians in one exact pass over an unpivoted (column, x) table.
    long = c.select(F.col("price").cast("double"), F.col("balance").cast("double")).unpivot(
        [], ["price", "balance"], "column", "x"
    )
    med = exact_median(long, "x", ["column"], "median").groupBy().pivot("column", ["price", "balance"]).agg(F.first("median"))
    return m.crossJoin(med.select(F.col("price").alias("price_median"), F.col("balance").alias("balance_median")))


@register(
    "global_mode",
    """SELECT (SELECT segment FROM cases WHERE segment IS NOT NULL GROUP BY segment
               ORDER BY count(*) DESC, segment LIMIT 1) AS segment_mode,
              (SELECT lang FROM docs GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS lang_mode""",
)
def global_mode(spark, d):
    """Most frequent value, smallest on ties."""
    a = gr.mode_table(cases(spark, d), "segment", (), "segment_mode")
    b = gr.mode_table(docs(spark, d), "lang", (), "lang_mode")
    return a.crossJoin(b)


@register(
    "group_median",
    "SELECT pclass, segment, median(balance) AS median FROM cases GROUP BY pclass, segment",
    ["median"],
)
def group_median(spark, d):
    """A3: exact group median over two keys."""
    return gr.group_median(cases(spark, d), ["pclass", "segment"], "balance", "median")


@register(
    "group_mean",
    "SELECT cust, avg(price) AS mean_price FROM cases GROUP BY cust",
    ["mean_price"],
)
def group_mean(spark, d):
    """A4: group mean."""
    return gr.fit_group_stats(cases(spark, d), "cust", {"mean_price": F.avg("price")})


@register(
    "group_multi_stats",
    """SELECT cust, avg(y) AS target_mean, count(y) AS n_known, stddev_samp(y) AS target_std
       FROM cases GROUP BY cust""",
    ["target_mean", "target_std"],
)
def group_multi_stats(spark, d):
    """A5: mean / non-null count / sample std in one aggregation."""
    return gr.fit_group_stats(
        cases(spark, d),
        "cust",
        {"target_mean": F.avg("y"), "n_known": F.count("y"), "target_std": F.stddev_samp("y")},
    )


@register(
    "group_conditional_count",
    """SELECT cust, CAST(count_if(priority = '1-URGENT') AS BIGINT) AS n_urgent,
              CAST(count_if(priority = '5-LOW') AS BIGINT) AS n_low
       FROM cases GROUP BY cust""",
)
def group_conditional_count(spark, d):
    """Conditional counts per group."""
    return gr.fit_group_stats(
        cases(spark, d),
        "cust",
        {"n_urgent": F.count_if(F.col("priority") == "1-URGENT"), "n_low": F.count_if(F.col("priority") == "5-LOW")},
    )


@register(
    "value_counts",
    "SELECT segment, count(*) AS count FROM cases WHERE segment IS NOT NULL GROUP BY segment",
)
def value_counts(spark, d):
    """Frequency table (NULL excluded)."""
    return gr.value_counts(cases(spark, d), "segment")


@register(
    "value_share",
    """SELECT split, segment, count(*) / sum(count(*)) OVER (PARTITION BY split) AS share
       FROM cases WHERE segment IS NOT NULL GROUP BY split, segment""",
    ["share"],
)
def value_share(spark, d):
    """Normalised frequency per split."""
    return gr.value_share(cases(spark, d), "segment", ["split"])


_CATS = ["segment", "priority", "nation"]


@register(
    "target_rate_by_category",
    """SELECT 'segment' AS feature, CAST(segment AS VARCHAR) AS value, avg(y) AS target_rate, count(*) AS n
       FROM cases WHERE y IS NOT NULL AND segment IS NOT NULL GROUP BY segment
       UNION ALL
       SELECT 'priority', CAST(priority AS VARCHAR), avg(y), count(*)
       FROM cases WHERE y IS NOT NULL AND priority IS NOT NULL GROUP BY priority
       UNION ALL
       SELECT 'nation', CAST(nation AS VARCHAR), avg(y), count(*)
       FROM cases WHERE y IS NOT NULL AND nation IS NOT NULL GROUP BY nation""",
    ["target_rate"],
)
def target_rate_by_category(spark, d):
    """Target rate and count per category for several columns in one groupBy."""
    return gr.target_rate_by_category(cases(spark, d), "y", _CATS)


def _describe_sql(col: str) -> str:
    return f"""SELECT '{col}' AS "column", count({col}) AS count, avg({col}) AS mean, stddev_samp({col}) AS std,
              min({col}) AS min, max({col}) AS max, quantile_cont({col}, 0.25) AS q25,
              quantile_cont({col}, 0.5) AS q50, quantile_cont({col}, 0.75) AS q75 FROM cases"""


@register(
    "describe_exact",
    _describe_sql("price") + "\nUNION ALL\n" + _describe_sql("balance"),
    ["mean", "std", "min", "max", "q25", "q50", "q75"],
)
def describe_exact(spark, d):
    """A10: describe() with exact quartiles."""
    return gr.describe_exact(cases(spark, d), ["price", "balance"])


@register(
    "missing_share",
    """SELECT 'balance' AS feature, avg(CAST(balance IS NULL AS DOUBLE)) * 100 AS missing_pct FROM cases
       UNION ALL SELECT 'y', avg(CAST(y IS NULL AS DOUBLE)) * 100 FROM cases
       UNION ALL SELECT 'segment', avg(CAST(segment IS NULL AS DOUBLE)) * 100 FROM cases""",
    ["missing_pct"],
)
def missing_share(spark, d):
    """Missing share (%) per column, one scan."""
    return gr.missing_share(cases(spark, d), ["balance", "y", "segment"])


@register(
    "prediction_share",
    """SELECT CAST(count_if(p_a < 0.5) AS BIGINT) AS n_zero, CAST(count_if(p_a >= 0.5) AS BIGINT) AS n_one,
              avg(CAST(p_a < 0.5 AS DOUBLE)) * 100 AS zero_pct
       FROM scores WHERE split = 'test'""",
    ["zero_pct"],
)
def prediction_share(spark, d):
    """Count and share of each predicted label."""
    s = scores(spark, d).where(F.col("split") == "test").withColumn("label", fx.binarize("p_a"))
    return s.agg(
        F.count_if(F.col("label") == 0).alias("n_zero"),
        F.count_if(F.col("label") == 1).alias("n_one"),
        (F.avg((F.col("label") == 0).cast("double")) * 100).alias("zero_pct"),
    )


@register(
    "score_stats_by_category",
    """SELECT split, segment, avg(p_a) AS mean_score, median(p_a) AS median_score, stddev_samp(p_a) AS std_score
       FROM scores GROUP BY split, segment""",
    ["mean_score", "median_score", "std_score"],
)
def score_stats_by_category(spark, d):
    """Mean / median / std of scores per (split, category), one pass + exact medians."""
    s = scores(spark, d)
    m = s.groupBy("split", "segment").agg(F.avg("p_a").alias("mean_score"), F.stddev_samp("p_a").alias("std_score"))
    med = exact_median(s, "p_a", ["split", "segment"], "median_score")
    return m.join(med, ["split", "segment"], "left")


# ---------------------------------------------------------------- W: group statistics on rows


@register(
    "group_size",
    """SELECT c.id, c.cust, g.n AS group_size
       FROM cases c LEFT JOIN (SELECT cust, count(*) AS n FROM cases GROUP BY cust) g ON c.cust = g.cust""",
)
def group_size(spark, d):
    """Rows per key on every row (``transform('size')``), over both splits."""
    return gr.group_size(cases(spark, d), "cust").select("id", "cust", "group_size")


@register(
    "group_count",
    """SELECT c.id, g.n AS n_balance
       FROM cases c LEFT JOIN (SELECT nation, count(balance) AS n FROM cases GROUP BY nation) g ON c.nation = g.nation""",
)
def group_count(spark, d):
    """Non-null count per key on every row."""
    return gr.group_size(cases(spark, d), "nation", "n_balance", count_col="balance").select("id", "n_balance")


@register(
    "group_median_rows",
    "SELECT id, median(balance) OVER (PARTITION BY pclass) AS class_median FROM cases",
    ["class_median"],
)
def group_median_rows(spark, d):
    """Group median broadcast to rows (agg + join, not a window)."""
    return gr.with_group_median(cases(spark, d), "pclass", "balance", "class_median").select("id", "class_median")


@register(
    "dense_rank_in_group",
    """SELECT id, CASE WHEN balance IS NULL THEN NULL
                  ELSE CAST(dense_rank() OVER (PARTITION BY nation ORDER BY balance) AS INTEGER) END AS balance_rank
       FROM cases""",
)
def dense_rank_in_group(spark, d):
    """Dense rank within a group; NULL value -> NULL rank."""
    ranked = gr.dense_rank_in_group(cases(spark, d), "nation", "balance", "balance_rank")
    return ranked.select("id", F.col("balance_rank").cast("int").alias("balance_rank"))


@register(
    "multi_key_group_sizes",
    """SELECT c.id, a.n AS cust_size, b.n AS nat_seg_size, p.n AS priority_size
       FROM cases c
       LEFT JOIN (SELECT cust, count(*) AS n FROM cases GROUP BY cust) a ON c.cust = a.cust
       LEFT JOIN (SELECT nation, segment, count(*) AS n FROM cases GROUP BY nation, segment) b
              ON c.nation = b.nation AND c.segment = b.segment
       LEFT JOIN (SELECT priority, count(*) AS n FROM cases GROUP BY priority) p ON c.priority = p.priority""",
)
def multi_key_group_sizes(spark, d):
    """Three group sizes with different keys on one frame."""
    out = gr.multi_key_group_sizes(
        cases(spark, d), {"cust_size": ["cust"], "nat_seg_size": ["nation", "segment"], "priority_size": ["priority"]}
    )
    return out.select("id", "cust_size", "nat_seg_size", "priority_size")


@register(
    "group_size_sentinel",
    """SELECT x.id, CASE WHEN x.lang = 'en' THEN 1 ELSE g.n END AS lang_size
       FROM docs x LEFT JOIN (SELECT lang, count(*) AS n FROM docs WHERE lang <> 'en' GROUP BY lang) g
       ON x.lang = g.lang""",
)
def group_size_sentinel(spark, d):
    """Group size where the (hot) sentinel key counts as its own group of 1."""
    return gr.group_size(docs(spark, d), "lang", "lang_size", sentinel="en").select("id", "lang_size")


@register(
    "average_rank",
    """SELECT nation, n, rank() OVER (ORDER BY n DESC) + (count(*) OVER (PARTITION BY n) - 1) / 2.0 AS rank
       FROM (SELECT nation, count(*) AS n FROM cases GROUP BY nation) t""",
    ["rank"],
)
def average_rank(spark, d):
    """Descending rank, ties share the mean rank (small fitted table)."""
    t = cases(spark, d).groupBy("nation").agg(F.count(F.lit(1)).alias("n"))
    return gr.average_rank_desc(t, "n", "rank").withColumn("rank", F.col("rank").cast("double"))


# ---------------------------------------------------------------- J: joins


@register(
    "lookup_default",
    """SELECT c.id, COALESCE(g.m, (SELECT avg(price) FROM cases WHERE split = 'train')) AS cust_mean_price
       FROM cases c LEFT JOIN (SELECT cust, avg(price) AS m FROM cases WHERE split = 'train' GROUP BY cust) g
       ON c.cust = g.cust
       WHERE c.split = 'test'""",
    ["cust_mean_price"],
)
def lookup_default(spark, d):
    """Statistic fitted on train, looked up for test rows, global default for unseen keys."""
    c = cases(spark, d)
    train = c.where(F.col("split") == "train")
    stats = gr.fit_group_stats(train, "cust", {"cust_mean_price": F.avg("price")})
    prior = train.agg(F.avg("price").alias("_prior"))
    out = gr.apply_stats(c.where(F.col("split") == "test"), stats, "cust").crossJoin(F.broadcast(prior))
    return out.select("id", F.coalesce("cust_mean_price", "_prior").alias("cust_mean_price"))


@register(
    "key_overlap_coverage",
    """SELECT count(*) AS n_train_rows_shared,
              count(*) * 100.0 / (SELECT count(*) FROM cases WHERE split = 'train') AS coverage_pct
       FROM cases t WHERE t.split = 'train'
         AND t.cust IN (SELECT cust FROM cases WHERE split = 'test')""",
    ["coverage_pct"],
)
def key_overlap_coverage(spark, d):
    """Semi join on keys of the other split, and the covered share of rows."""
    c = cases(spark, d)
    train = c.where(F.col("split") == "train")
    test_keys = c.where(F.col("split") == "test").select("cust")
    shared = train.join(test_keys, "cust", "left_semi").agg(F.count(F.lit(1)).alias("n_train_rows_shared"))
    total = train.agg(F.count(F.lit(1)).alias("_n"))
    return shared.crossJoin(total).select(
        "n_train_rows_shared", (F.col("n_train_rows_shared") * 100.0 / F.col("_n")).alias("coverage_pct")
    )


@register(
    "oof_matrix",
    "SELECT id, p_a AS p_model_a, p_b AS p_model_b FROM scores WHERE split = 'train'",
    ["p_model_a", "p_model_b"],
)
def oof_matrix(spark, d):
    """Per-model score rows (id, model, p) pivoted to one column per model."""
    s = scores(spark, d).where(F.col("split") == "train")
    long = s.select("id", F.lit("a").alias("model"), F.col("p_a").alias("p")).unionByName(
        s.select("id", F.lit("b").alias("model"), F.col("p_b").alias("p"))
    )
    wide = long.groupBy("id").pivot("model", ["a", "b"]).agg(F.first("p"))
    return wide.select("id", F.col("a").alias("p_model_a"), F.col("b").alias("p_model_b"))


# ---------------------------------------------------------------- O: sort / limit


@register(
    "top_k",
    "SELECT id, price FROM cases ORDER BY price DESC, id LIMIT 10",
    ["price"],
)
def top_k(spark, d):
    """O1: top 10 by score with a deterministic tie-break."""
    return gr.top_k(cases(spark, d).select("id", "price"), "price", 10, ["id"])


@register(
    "top_fraction",
    """SELECT nation, mean_price FROM (
         SELECT nation, mean_price, row_number() OVER (ORDER BY mean_price DESC, nation) AS rn,
                count(*) OVER () AS k
         FROM (SELECT nation, avg(price) AS mean_price FROM cases GROUP BY nation) t) u
       WHERE rn <= CAST(floor(k * 0.6) AS BIGINT)""",
    ["mean_price"],
)
def top_fraction(spark, d):
    """O2: keep the top ``int(n * 0.6)`` of a ranked table."""
    t = gr.fit_group_stats(cases(spark, d), "nation", {"mean_price": F.avg("price")})
    return gr.top_fraction(t, "mean_price", 0.6, "nation")


@register(
    "argmax_first",
    """SELECT nation, target_rate FROM (SELECT nation, avg(y) AS target_rate FROM cases
       WHERE y IS NOT NULL GROUP BY nation) t ORDER BY target_rate DESC, nation LIMIT 1""",
    ["target_rate"],
)
def argmax_first(spark, d):
    """Row with the largest metric, first position on ties."""
    t = gr.fit_group_stats(cases(spark, d).where(F.col("y").isNotNull()), "nation", {"target_rate": F.avg("y")})
    return gr.argmax_first(t, "target_rate", "nation")


@register(
    "first_n",
    "SELECT id FROM scores WHERE split = 'test' AND p_a >= 0.5 ORDER BY id LIMIT 10",
)
def first_n(spark, d):
    """First ten ids of a filtered set."""
    s = scores(spark, d).where((F.col("split") == "test") & (F.col("p_a") >= 0.5))
    return s.select("id").orderBy("id").limit(10)


# ---------------------------------------------------------------- I: imputation


@register(
    "impute_group_median",
    """SELECT id, COALESCE(balance, median(balance) OVER (PARTITION BY nation)) AS balance_filled FROM cases""",
    ["balance_filled"],
)
def impute_group_median(spark, d):
    """Fill with the group median over both splits."""
    out = im.impute_group_median(cases(spark, d), "balance", "nation", out="balance_filled")
    return out.select("id", "balance_filled")


@register(
    "impute_sequential",
    """WITH s1 AS (SELECT id, nation, segment,
                          COALESCE(balance, median(balance) OVER (PARTITION BY cust)) AS v FROM cases),
            s2 AS (SELECT id, segment, COALESCE(v, median(v) OVER (PARTITION BY nation, segment)) AS v FROM s1)
       SELECT id, COALESCE(v, median(v) OVER (PARTITION BY segment)) AS balance_filled FROM s2""",
    ["balance_filled"],
)
def impute_sequential(spark, d):
    """Sequential cascade, each level's median over already-filled values."""
    out = im.impute_sequential(cases(spark, d), "balance", [["cust"], ["nation", "segment"], ["segment"]], "balance_filled")
    return out.select("id", "balance_filled")


def _cascade_sql(levels: list[list[str]], fit_where: str, global_fallback: bool = True) -> str:
    joins, picks = [], []
    for i, keys in enumerate(levels):
        kl = ", ".join(keys)
        on = " AND ".join(f"c.{k} = l{i}.{k}" for k in keys)
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        joins.append(
            f"LEFT JOIN (SELECT {kl}, true AS p, median(balance) AS m FROM cases WHERE {fit_where} AND {nn} "
            f"GROUP BY {kl}) l{i} ON {on}"
        )
        picks.append(f"WHEN l{i}.p IS NOT NULL THEN l{i}.m")
    glob = f", (SELECT median(balance) FROM cases WHERE {fit_where})" if global_fallback else ""
    return (
        f"SELECT c.id, COALESCE(c.balance, CASE {' '.join(picks)} END{glob}) AS balance_filled\n"
        f"FROM cases c {' '.join(joins)}"
    )


_L2 = [["cust"], ["nation", "segment"]]
_L3 = [["cust"], ["nation", "segment"], ["segment"]]


@register("impute_cascade_train", _cascade_sql(_L2, "split = 'train'"), ["balance_filled"])
def impute_cascade_train(spark, d):
    """Key-exists cascade, statistics from the labelled split only."""
    c = cases(spark, d)
    out = im.impute_cascade(c, "balance", _L2, fit_on=c.where(F.col("split") == "train"), out="balance_filled")
    return out.select("id", "balance_filled")


@register("impute_cascade3_train", _cascade_sql(_L3, "split = 'train'"), ["balance_filled"])
def impute_cascade3_train(spark, d):
    """I4: three-level key-exists cascade, train statistics."""
    c = cases(spark, d)
    out = im.impute_cascade(c, "balance", _L3, fit_on=c.where(F.col("split") == "train"), out="balance_filled")
    return out.select("id", "balance_filled")


@register("impute_cascade3_pooled", _cascade_sql(_L3, "true"), ["balance_filled"])
def impute_cascade3_pooled(spark, d):
    """Three-level cascade on pooled statistics with a global fallback."""
    out = im.impute_cascade(cases(spark, d), "balance", _L3, out="balance_filled")
    return out.select("id", "balance_filled")


@register(
    "lookup_cascade",
    _cascade_sql([["nation", "segment", "pclass"], ["nation"]], "split = 'train'", global_fallback=False),
    ["balance_filled"],
)
def lookup_cascade(spark, d):
    """Composite-key lookup falling back to a coarser key, no global default."""
    c = cases(spark, d)
    out = im.impute_cascade(
        c, "balance", [["nation", "segment", "pclass"], ["nation"]],
        fit_on=c.where(F.col("split") == "train"), out="balance_filled", global_fallback=False,
    )
    return out.select("id", "balance_filled")


@register(
    "impute_group_train",
    """SELECT c.id, COALESCE(c.balance, g.m) AS balance_filled FROM cases c
       LEFT JOIN (SELECT pclass, median(balance) AS m FROM cases WHERE split = 'train' GROUP BY pclass) g
       ON c.pclass = g.pclass""",
    ["balance_filled"],
)
def impute_group_train(spark, d):
    """Group median fitted on train, applied to both splits."""
    c = cases(spark, d)
    out = im.impute_group_median(c, "balance", "pclass", fit_on=c.where(F.col("split") == "train"), out="balance_filled")
    return out.select("id", "balance_filled")


@register(
    "impute_global",
    "SELECT id, COALESCE(balance, (SELECT median(balance) FROM cases)) AS balance_filled FROM cases",
    ["balance_filled"],
)
def impute_global(spark, d):
    """Fill with the global (exact) median."""
    return im.impute_global_median(cases(spark, d), "balance", out="balance_filled").select("id", "balance_filled")


@register(
    "impute_mode",
    """SELECT id, COALESCE(quality, (SELECT quality FROM docs WHERE split = 'train' AND quality IS NOT NULL
                                    GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1)) AS quality_filled,
              COALESCE(y, 0) AS y_filled
       FROM docs""",
)
def impute_mode(spark, d):
    """Fill with the train mode (smallest on ties); fill with a constant."""
    x = docs(spark, d)
    out = im.impute_mode(x, "quality", fit_on=x.where(F.col("split") == "train"), out="quality_filled")
    out = out.withColumn("y_filled", F.col("y"))
    out = im.impute_constant(out, {"y_filled": 0})
    return out.select("id", "quality_filled", "y_filled")


@register(
    "group_size_range",
    """SELECT split, min(n) AS min_size, max(n) AS max_size
       FROM (SELECT split, count(*) OVER (PARTITION BY cust) AS n FROM cases) s GROUP BY split""",
)
def group_size_range(spark, d):
    """Smallest and largest group per split."""
    sized = gr.group_size(cases(spark, d).select("split", "cust"), "cust", "n")
    return sized.groupBy("split").agg(F.min("n").alias("min_size"), F.max("n").alias("max_size"))


@register(
    "frequency_table_ordered",
    """SELECT segment, n, n * 100.0 / sum(n) OVER () AS pct, row_number() OVER (ORDER BY n DESC, segment) AS position
       FROM (SELECT segment, count(*) AS n FROM cases WHERE segment IS NOT NULL GROUP BY segment) s""",
    ["pct"],
)
def frequency_table_ordered(spark, d):
    """Shares in falling order, ties by value; the window is over one row per category."""
    counts = cases(spark, d).where(F.col("segment").isNotNull()).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    falling = Window.orderBy(F.col("n").desc(), "segment")
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(
        "segment", "n", (F.col("n") * 100.0 / total).cast("double").alias("pct"),
        F.row_number().over(falling).cast("bigint").alias("position"),
    )


@register(
    "recompute_after_fill",
    """SELECT id, coalesce(balance, (SELECT median(balance) FROM cases)) AS balance_filled,
              coalesce(balance, (SELECT median(balance) FROM cases)) / nullif(price, 0) AS balance_per_price FROM cases""",
    ["balance_filled", "balance_per_price"],
)
def recompute_after_fill(spark, d):
    """Fill a column, then compute what depends on it from the filled values."""
    c = cases(spark, d).select("id", "price", "balance")
    median = exact_median(c, "balance", out="middle")
    filled = F.coalesce(F.col("balance"), F.col("middle"))
    out = c.crossJoin(F.broadcast(median))  # one row
    return out.select("id", filled.alias("balance_filled"), F.try_divide(filled, F.col("price")).alias("balance_per_price"))
