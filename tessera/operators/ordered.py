"""Exact order statistics without a single-task window.

``Window.orderBy(...)`` without ``partitionBy`` (and a window partitioned by a
hot key) runs in one task.  Every operator here that needs a cumulative count
in some global order (AUC, KS, stratified folds, exact quantiles, dense codes,
ordered target statistics) goes through :func:`running_sums` instead:

1. range-partition the rows on ``(by, order)`` -- a hot ``by`` group is split
   across many partitions by its order columns;
2. sort within each partition and take the cumulative sums there (one pandas
   ``cumsum`` per Arrow batch inside the task; other columns are passed on as they are);
3. add the sum of the *earlier* partitions holding the same ``by`` key.  Only
   the first key of a partition can continue from an earlier partition, so
   each task also emits two summary rows (first key; last key with its local
   total).  The driver chains those <= 2n rows into at most n offsets, which
   are broadcast back -- a size bound by the partition count, not the data.

The partition-local result is materialised once, because the offsets and the
rows must be computed against the same range boundaries.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, ship_package

_PID = "_tsr_pid"
_KIND = "_tsr_kind"


def _key_of(keys: pd.DataFrame, at: int) -> tuple:
    """One row's keys as Python values, each of its own type."""
    row = [keys[k].iloc[at] for k in keys.columns]
    return tuple(None if pd.isna(x) else x.item() if hasattr(x, "item") else x for x in row)


def running_sums(
    df: DataFrame,
    order: Sequence[str],
    values: Sequence[str],
    by: Sequence[str] = (),
    prefix: str = "cum_",
    num_partitions: int | None = None,
    part: str | None = None,
) -> DataFrame:
    """Add ``prefix + v`` = inclusive running sum of ``v`` within ``by``, in ``order``.

    ROWS semantics: the order must be unique within ``by`` for a deterministic
    result (callers pre-aggregate ties or append a key).  ``values`` must be
    non-null numerics.  ``part`` names a column for the number of the range partition a
    row lies in: ``(by, part)`` is a key that no hot group can make large.
    """
    by, order, values = list(by), list(order), list(values)
    keys = by + order
    # Without an explicit count, AQE sizes the range partitions from the data
    # (it only merges ADJACENT ranges, so key order across partitions holds).
    repart = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = (
        repart
        .sortWithinPartitions(*keys)
        .withColumn(_PID, F.spark_partition_id())
    )

    cum_names = [prefix + v for v in values]
    out_fields = [T.StructField(f.name, f.dataType, True) for f in ranged.schema.fields]
    cum_types = {}
    for v, name in zip(values, cum_names):
        dt = ranged.schema[v].dataType
        integral = isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        cum_types[name] = T.LongType() if integral else T.DoubleType()
        out_fields.append(T.StructField(name, cum_types[name], True))
    out_fields.append(T.StructField(_KIND, T.IntegerType(), False))
    out_schema = T.StructType(out_fields)
    col_names = [f.name for f in out_fields]

    whole = [cum_types[n] == T.LongType() for n in cum_names]

    def _cumsum(batches):
        # only the key and value columns go through pandas; all others stay Arrow arrays, untouched
        carry_key = carry = first_key = pid = types = None
        for batch in batches:
            if not batch.num_rows:
                continue
            types = batch.schema
            pdf = batch.select(list(dict.fromkeys([*by, *values]))).to_pandas(integer_object_nulls=True)
            vals = pd.DataFrame({v: pdf[v].astype("int64" if w else "float64") for v, w in zip(values, whole)})
            if by:
                keys_df = pdf[by]
                prev = keys_df.shift(1)
                same = (keys_df == prev) | (keys_df.isna() & prev.isna())
                seg = (~same.all(axis=1)).cumsum().to_numpy()
                local = vals.groupby(seg).cumsum()
                head_key = _key_of(keys_df, 0)
                if carry is not None and head_key == carry_key:
                    head = seg == seg[0]
                    for v in values:
                        local.loc[head, v] += carry[v]
                carry_key = _key_of(keys_df, -1)
                if first_key is None:
                    first_key = head_key
            else:
                local = vals.cumsum()
                if carry is not None:
                    for v in values:
                        local[v] += carry[v]
                carry_key = first_key = ()
            carry = {v: local[v].iloc[-1].item() for v in values}
            pid = batch.column(_PID)[0].as_py()
            sums = [pa.array(local[v].to_numpy(), pa.int64() if w else pa.float64()) for v, w in zip(values, whole)]
            kind = pa.array([0] * batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums, kind], names=col_names)
        if pid is not None:
            # Two summary rows per partition: its first key, and its last key
            # with that key's partition-local running total.
            given = {b: [first_key[i], carry_key[i]] for i, b in enumerate(by)}
            given[_PID] = [pid, pid]
            rows = [pa.array(given.get(f.name, [None, None]), f.type) for f in types]
            sums = [
                pa.array([None, carry[v]], pa.int64() if w else pa.float64()) for v, w in zip(values, whole)
            ]
            yield pa.RecordBatch.from_arrays([*rows, *sums, pa.array([1, 2], pa.int32())], names=col_names)

    # Materialise once (a table in the shared checkpoint folder): the offsets
    # and the rows must see the SAME range boundaries, and two executions of a
    # range exchange may sample different ones.  It also cuts the lineage, so
    # a lost executor re-reads the table instead of re-ranging.
    ship_package(df.sparkSession)
    local_cum = materialize(ranged.mapInArrow(_cumsum, out_schema), "running")

    # <= 2 summary rows per range partition: a bounded collect.
    summary = local_cum.where(F.col(_KIND) > 0).select(_PID, _KIND, *by, *cum_names).collect()
    offsets = _chain_offsets(summary, by, cum_names)
    rows = local_cum.where(F.col(_KIND) == 0)
    out_cols = [F.col(c) for c in ranged.columns if c != _PID] + ([F.col(_PID).alias(part)] if part else [])
    if not offsets:
        return rows.select(*out_cols, *cum_names)
    off_schema = T.StructType(
        [T.StructField("_o_pid", T.IntegerType(), False)]
        + [T.StructField("_o_" + b, ranged.schema[b].dataType, True) for b in by]
        + [T.StructField("_off_" + c, cum_types[c], False) for c in cum_names]
    )
    off_df = df.sparkSession.createDataFrame(offsets, off_schema)
    cond = F.col(_PID) == F.col("_o_pid")
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col("_o_" + b))
    joined = rows.join(F.broadcast(off_df), cond, "left")  # <= n rows
    return joined.select(
        *out_cols,
        *[(F.col(c) + F.coalesce(F.col("_off_" + c), F.lit(0))).alias(c) for c in cum_names],
    )


def _chain_offsets(summary, by, cum_names) -> list[tuple]:
    """Offset of each partition's first key: the running total it carries over.

    ``offset(p) = [last(p') == first(p)] * (total_last(p') + [first(p') == last(p')] * offset(p'))``
    with ``p'`` the previous non-empty partition.  Runs over <= 2 rows per partition.
    """
    per = {}
    for r in summary:
        d = per.setdefault(r[_PID], {})
        key = tuple(r[b] for b in by)
        if r[_KIND] == 1:
            d["first"] = key
        else:
            d["last"] = key
            d["total"] = [r[c] for c in cum_names]
    out = []
    prev = None
    prev_off = None
    for pid in sorted(per):
        d = per[pid]
        off = None
        if prev is not None and prev["last"] == d["first"]:
            off = list(prev["total"])
            if prev["first"] == prev["last"] and prev_off is not None:
                off = [a + b for a, b in zip(off, prev_off)]
        if off is not None:
            out.append((int(pid), *d["first"], *off))
        prev, prev_off = d, off
    return out


def dense_codes(
    df: DataFrame, col: str, by: Sequence[str] = (), out: str = "code", start: int = 0
) -> DataFrame:
    """Distinct ``(by, col)`` values with their ascending dense rank (``start``-based).

    Nulls are excluded.  Returns a dictionary table to be joined back.
    """
    distinct = df.select(*by, col).where(F.col(col).isNotNull()).distinct()
    ranked = running_sums(distinct.withColumn("_one", F.lit(1)), [col], ["_one"], by)
    return ranked.select(*by, col, (F.col("cum__one") - 1 + start).alias(out))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    prob_col: str = "prob",
    out: str = "quantile",
    keep_empty: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas default), nulls skipped.

    Returns ``(by..., prob, quantile)``.  Rows with a NULL ``by`` key are
    ignored.  A group whose values are all NULL is absent, or -- with
    ``keep_empty`` -- present with a NULL quantile (``groupby().median()``
    keeps such groups).  Work: one aggregation to distinct ``(by, value)``
    counts, one :func:`running_sums`, one join with the rank targets on group and
    range partition.
    """
    by = list(by)
    spark = df.sparkSession
    src = df
    for b in by:
        src = src.where(F.col(b).isNotNull())
    if not keep_empty:
        src = src.where(F.col(value).isNotNull())
    counts = src.groupBy(*by, value).agg(F.count(F.col(value)).alias("_c"))
    # NULL values sort first with weight 0, so they never take a rank.
    cum = running_sums(counts, [value], ["_c"], by, part="_part")
    # The ranks each range partition covers of each group: a row per group, and one more for
    # every partition that a large group goes on into.
    spans = cum.groupBy(*by, "_part").agg(
        F.min(F.col("cum__c") - F.col("_c")).alias("_from"), F.max("cum__c").alias("_to")
    )
    sizes = spans.groupBy(*by).agg(F.max("_to").alias("_n"))
    prob_df = spark.createDataFrame([(float(p),) for p in probs], f"{prob_col} double")
    pos = F.col(prob_col) * (F.col("_n") - 1)
    targets = (
        sizes.crossJoin(F.broadcast(prob_df))  # bounded by len(probs)
        .withColumn("_lo", F.floor(pos))
        .withColumn("_hi", F.ceil(pos))
        .withColumn("_frac", pos - F.floor(pos))
    )
    within = lambda rank, start, stop: (start <= F.col(rank)) & (F.col(rank) < stop)
    wanted = spans.join(targets, by, "inner") if by else spans.crossJoin(F.broadcast(targets))
    wanted = wanted.where(
        within("_lo", F.col("_from"), F.col("_to")) | within("_hi", F.col("_from"), F.col("_to"))
    ).drop("_from", "_to", "_n")

    # Each distinct value is matched to the ranks sought in its own range partition, so the
    # rows of a large group are never brought together.
    j = cum.join(wanted, [*by, "_part"], "inner")
    lo_hit = within("_lo", F.col("cum__c") - F.col("_c"), F.col("cum__c"))
    hi_hit = within("_hi", F.col("cum__c") - F.col("_c"), F.col("cum__c"))
    v = F.col(value).cast("double")
    both = (
        j.where(F.col(value).isNotNull() & (lo_hit | hi_hit))
        .groupBy(*by, prob_col)
        .agg(
            F.max(F.when(lo_hit, v)).alias("_vlo"),
            F.max(F.when(hi_hit, v)).alias("_vhi"),
            F.first("_frac").alias("_frac"),
        )
    )
    if keep_empty:
        both = targets.select(*by, prob_col).join(both, [*by, prob_col], "left")
    return both.select(
        *by,
        prob_col,
        (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias(out),
    )


def exact_median(
    df: DataFrame, value: str, by: Sequence[str] = (), out: str = "median", keep_empty: bool = False
) -> DataFrame:
    """Group (or global) median, exact and skew-safe; ``(by..., out)``."""
    return exact_quantiles(df, value, [0.5], by, out=out, keep_empty=keep_empty).drop("prob")
