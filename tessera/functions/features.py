"""Row-level feature expressions: flags, ratios, interactions, bins, blends.

All return ``Column``; nothing here shuffles.  pandas rules kept: a comparison
with a missing value is False (flag 0), ``x / 0`` is missing, ``pd.cut`` is
right-closed with out-of-range values missing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 with NULL (comparison against NaN) as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def present(col) -> Column:
    return _c(col).isNotNull().cast("int")


def threshold_flag(col, t: float, op: str = "<=") -> Column:
    c = _c(col)
    cond = {"<=": c <= t, "<": c < t, ">=": c >= t, ">": c > t, "==": c == t}[op]
    return flag(cond)


def ratio(num, den) -> Column:
    """``num / den`` with division by zero -> NULL (no ANSI error)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def product(*cols) -> Column:
    out = _c(cols[0])
    for c in cols[1:]:
        out = out * _c(c)
    return out


def string_interaction(a, b, sep: str = "_") -> Column:
    """``a + '_' + b.astype(str)`` (NULL-propagating)."""
    return F.concat(_c(a).cast("string"), F.lit(sep), _c(b).cast("string"))


def cut(
    col,
    edges: Sequence[float],
    labels: Sequence[str] | None = None,
    right: bool = True,
    include_lowest: bool = False,
) -> Column:
    """``pd.cut`` with explicit edges: label (or 0-based bin index), NULL outside."""
    c = _c(col).cast("double")
    out = None
    for i in range(len(edges) - 1):
        lo, hi = float(edges[i]), float(edges[i + 1])
        if right:
            low_ok = (c >= lo) if (include_lowest and i == 0) else (c > lo)
            cond = low_ok & (c <= hi)
        else:
            high_ok = (c <= hi) if (include_lowest and i == len(edges) - 2) else (c < hi)
            cond = (c >= lo) & high_ok
        val = F.lit(labels[i]) if labels is not None else F.lit(i)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def band(col, cutoffs: Sequence[float], labels: Sequence[str]) -> Column:
    """if/elif banding: first ``col < cutoffs[i]`` wins, else the last label."""
    c = _c(col)
    out = None
    for t, lab in zip(cutoffs, labels):
        out = F.when(c < t, F.lit(lab)) if out is None else out.when(c < t, F.lit(lab))
    return out.otherwise(F.lit(labels[len(cutoffs)]))


def binarize(p, threshold: float = 0.5, inclusive: bool = True) -> Column:
    """Probability -> 0/1 label; ``inclusive`` chooses ``>=`` over ``>``."""
    c = _c(p)
    return flag(c >= threshold if inclusive else c > threshold)


def confident(p, hi: float, lo: float, inclusive: bool = True) -> Column:
    """Confidence band predicate ``p >= hi or p <= lo`` (strict if not inclusive)."""
    c = _c(p)
    if inclusive:
        return (c >= hi) | (c <= lo)
    return (c > hi) | (c < lo)


def blend(weights: Mapping[str, float]) -> Column:
    """Fixed-weight linear blend of score columns."""
    out = None
    for name, w in weights.items():
        term = F.lit(float(w)) * _c(name)
        out = term if out is None else out + term
    return out


def invert(col) -> Column:
    return F.lit(1) - _c(col)


def round_to(col, digits: int) -> Column:
    """Round half away from zero on ``x * 10**digits``, keeping the sign of tiny
    negatives (-0.0) as numpy/pandas output does."""
    scale = float(10 ** digits)
    v = _c(col) * F.lit(scale)
    r = F.when(F.abs(v) >= F.lit(4503599627370496.0), v).otherwise(F.signum(v) * F.floor(F.abs(v) + F.lit(0.5)).cast("double"))
    return r / F.lit(scale)
