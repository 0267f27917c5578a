"""Target and label encodings.

Every encoder aggregates many columns at once: the frame is unpivoted to
``(feature, value)`` and grouped once, instead of one ``groupBy`` per column.
Modes:

* ``full``    -- mean target of the value over all labelled rows (leaky for
  the labelled rows themselves; kept because the reference uses it);
* ``kfold``   -- a labelled row sees only the other folds: fold sums are
  subtracted from the totals, so it is one pass, not k;
* ``loo``     -- leave-one-out: ``(sum - y) / (n - 1)``;
* ``ordered`` -- mean over the labelled rows *before* the row in a seeded
  hash order (ordered target statistics), via a range-partitioned running sum.

Unlabelled rows always get the full labelled mean of their value; values never
seen with a label fall back to the prior (labelled mean of the target).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .groups import join_back, unpivot
from .ordered import dense_codes, running_sums


def _prior(df: DataFrame, target: str) -> DataFrame:
    """One-row labelled mean of the target (safe to broadcast)."""
    return df.where(F.col(target).isNotNull()).agg(F.avg(F.col(target).cast("double")).alias("_prior"))


def _value_stats(df: DataFrame, target: str, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    labelled = df.where(F.col(target).isNotNull())
    long = unpivot(labelled, [target, *extra], cols)
    return long.groupBy("feature", "value", *extra).agg(
        F.sum(F.col(target).cast("double")).alias("_s"), F.count(F.lit(1)).alias("_n")
    )


def _attach(df: DataFrame, stats: DataFrame, col: str, names: Sequence[str]) -> DataFrame:
    """The row of ``stats`` fitted for a row's value of ``col``, by one join."""
    s = stats.where(F.col("feature") == col).select(F.col("value").alias("_v"), *names)
    return join_back(df.withColumn("_k", F.col(col).cast("string")), s.withColumnRenamed("_v", "_k"), ["_k"]).drop("_k")


def target_encode(
    df: DataFrame,
    target: str,
    cols: Sequence[str],
    mode: str = "kfold",
    fold: str = "fold",
    suffix: str = "_te",
    seed: int = 42,
    id_col: str = "id",
    prior: float | None = None,
) -> DataFrame:
    """Add ``<col><suffix>`` for each column; see module doc for the modes."""
    if mode == "ordered":
        return _ordered(df, target, cols, suffix, seed, id_col, prior)
    if mode not in ("full", "loo", "kfold"):
        raise ValueError(f"unknown mode {mode!r}")
    # One aggregation serves all columns, the totals and the folds.
    names = ["_s", "_n"]
    if mode == "kfold":
        per_fold = _value_stats(df, target, cols, [fold])
        entry = F.struct(F.col(fold), F.struct("_s", "_n"))
        fitted = per_fold.groupBy("feature", "value").agg(
            F.sum("_s").alias("_s"), F.sum("_n").alias("_n"),
            F.map_from_entries(F.collect_list(F.when(F.col(fold).isNotNull(), entry))).alias("_by_fold"),  # <= one entry a fold
        )
        names.append("_by_fold")
    else:
        fitted = _value_stats(df, target, cols)
    fitted = materialize(fitted, "target_stats")
    out = df.crossJoin(F.broadcast(_prior(df, target))) if prior is None else df.withColumn("_prior", F.lit(float(prior)))
    labelled = F.col(target).isNotNull()
    n = F.col("_n").cast("double")
    full_mean = F.try_divide(F.col("_s"), n)
    if mode == "full":
        enc = full_mean
    elif mode == "loo":
        enc = F.when(labelled, F.try_divide(F.col("_s") - F.col(target).cast("double"), n - 1)).otherwise(full_mean)
    else:
        own = F.try_element_at("_by_fold", F.col(fold))
        s_other = F.col("_s") - F.coalesce(own["_s"], F.lit(0.0))
        n_other = n - F.coalesce(own["_n"], F.lit(0)).cast("double")
        enc = F.when(labelled, F.try_divide(s_other, n_other)).otherwise(full_mean)
    for c in cols:
        out = _attach(out, fitted, c, names)
        out = out.withColumn(c + suffix, F.coalesce(enc, F.col("_prior"))).drop(*names)
    return out.drop("_prior")


def _ordered(df, target, cols, suffix, seed, id_col, prior):
    """Ordered target statistic: labelled rows see only earlier labelled rows."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))
    out = df.withColumn("_h", h)
    out = out.crossJoin(F.broadcast(_prior(df, target))) if prior is None else out.withColumn("_prior", F.lit(float(prior)))
    totals = materialize(_value_stats(df, target, cols), "target_stats")
    for c in cols:
        lab = (
            out.where(F.col(target).isNotNull() & F.col(c).isNotNull())
            .select(id_col, "_h", F.col(c).cast("string").alias("_k"), F.col(target).cast("double").alias("_y"))
            .withColumn("_one", F.lit(1))
        )
        cum = running_sums(lab, ["_h", id_col], ["_y", "_one"], by=["_k"])
        prev = cum.select(
            F.col(id_col).alias("_oid"),
            F.try_divide(F.col("cum__y") - F.col("_y"), (F.col("cum__one") - 1).cast("double")).alias("_ots"),
        )
        out = out.join(prev, F.col(id_col) == F.col("_oid"), "left").drop("_oid")
        out = _attach(out, totals, c, ["_s", "_n"])
        full_mean = F.try_divide(F.col("_s"), F.col("_n").cast("double"))
        enc = F.when(F.col(target).isNotNull(), F.col("_ots")).otherwise(full_mean)
        out = out.withColumn(c + suffix, F.coalesce(enc, F.col("_prior"))).drop("_ots", "_s", "_n")
    return out.drop("_h", "_prior")


def ordered_statistics(df: DataFrame, target: str, cols: Sequence[str], orders: Sequence[int], id_col: str = "id",
                       weight: float = 1.0, suffix: str = "_ots", trained: str | None = None) -> DataFrame:
    """Ordered target statistics of several columns in several row orders, from one range-partitioned pass.

    Adds ``<col><suffix><order>`` for each column and order: for a labelled row the mean
    target of the earlier labelled rows of its value in that order, drawn to the prior by
    ``weight`` rows; for any other row the mean of all labelled rows of its value, drawn
    alike.  ``trained`` names a boolean column of the rows whose labels may be used (default:
    all labelled).  A null value has the prior.  The prior is the mean of all labels used.
    """
    seen = F.col(target).isNotNull() if trained is None else F.col(target).isNotNull() & F.col(trained)
    y = F.col(target).cast("double")
    prior = df.where(seen).agg(F.avg(y)).first()[0] or 0.0  # one number
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    long = df.where(seen).select(F.col(id_col).alias("_id"), y.alias("_y"), F.inline(pairs)).where(F.col("value").isNotNull())
    turns = long.select("*", F.explode(F.array(*map(F.lit, orders))).alias("_order"))
    place = F.md5(F.concat_ws("|", F.col("_order").cast("string"), F.col("_id").cast("string")))
    cum = running_sums(
        turns.withColumn("_place", place).withColumn("_one", F.lit(1)),
        ["_place", "_id"], ["_y", "_one"], by=["feature", "value", "_order"],
    )

    def drawn(total, n):
        return (total + F.lit(weight * prior)) / (n + F.lit(weight))

    names = [(c, o, f"{c}{suffix}{o}") for c in cols for o in orders]
    own = cum.select("_id", "feature", "_order", drawn(F.col("cum__y") - F.col("_y"), F.col("cum__one") - 1).alias("_s"))
    wide = own.groupBy("_id").agg(
        *[F.max(F.when((F.col("feature") == c) & (F.col("_order") == o), F.col("_s"))).alias(f"_o{i}") for i, (c, o, _) in enumerate(names)]
    )
    totals = long.groupBy("feature", "value").agg(F.sum("_y").alias("_t"), F.count("*").alias("_n"))
    totals = materialize(totals.select("feature", "value", drawn(F.col("_t"), F.col("_n")).alias("_all")), "target_stats")
    out = df.join(wide, F.col(id_col) == F.col("_id"), "left").drop("_id")
    for j, c in enumerate(cols):
        out = _attach(out, totals, c, ["_all"]).withColumnRenamed("_all", f"_a{j}")
    values = {
        name: F.coalesce(F.when(seen, F.col(f"_o{i}")).otherwise(F.col(f"_a{list(cols).index(c)}")), F.lit(float(prior)))
        for i, (c, _, name) in enumerate(names)
    }
    return out.withColumns(values).drop(*[f"_o{i}" for i in range(len(names))], *[f"_a{j}" for j in range(len(cols))])


def group_target_stats(
    df: DataFrame, target: str, key: str, prefix: str, default_mean: float = 0.5, default_std: float = 0.0
) -> DataFrame:
    """Per-key target mean / known-label count / sample std over labelled rows.

    Groups with no label get ``default_mean``, count 0 and ``default_std``; a
    single-label group has a NULL sample std, which also becomes the default.
    """
    y = F.col(target).cast("double")
    stats = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(y).alias(f"{prefix}_mean"),
        F.count(y).alias(f"{prefix}_known"),
        F.stddev_samp(y).alias(f"{prefix}_std"),
    )
    out = join_back(df, stats, [key])
    return out.withColumns(
        {
            f"{prefix}_mean": F.coalesce(F.col(f"{prefix}_mean"), F.lit(float(default_mean))),
            f"{prefix}_std": F.coalesce(F.col(f"{prefix}_std"), F.lit(float(default_std))),
        }
    )


def label_encode(df: DataFrame, col: str, out: str | None = None, nan_text: bool = True) -> DataFrame:
    """Sorted distinct values -> 0..k-1 (``LabelEncoder`` on ``astype(str)``).

    ``nan_text``: NULL is encoded as the text ``nan`` (sorted with the rest),
    as ``astype(str)`` does; otherwise NULL gets code -1 (``cat.codes``).
    """
    out = out or f"{col}_code"
    key = F.coalesce(F.col(col).cast("string"), F.lit("nan")) if nan_text else F.col(col).cast("string")
    keyed = df.withColumn("_lk", key)
    codes = dense_codes(keyed, "_lk", (), "_code")
    res = join_back(keyed, codes, ["_lk"])
    code = F.col("_code") if nan_text else F.coalesce(F.col("_code"), F.lit(-1))
    return res.withColumn(out, code).drop("_lk", "_code")


def category_codes(df: DataFrame, cols: Sequence[str], suffix: str = "_code") -> DataFrame:
    """One shared dictionary per column fitted on the given frame (both splits), NULL -> -1."""
    out = df
    for c in cols:
        out = label_encode(out, c, c + suffix, nan_text=False)
    return out
