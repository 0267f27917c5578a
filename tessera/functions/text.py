"""String features as Column -> Column functions (all JVM-side expressions).

Null rules follow pandas where the reference relies on them:
``str.extract`` gives NULL on no match (Spark gives ''), ``astype(str)``
turns a missing value into the text ``nan``, concatenation with a missing
value is missing.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII whitespace as Python's str.split()/strip() see it; written as an
# explicit class so Java and RE2 regex engines agree (their \s differ on \x0B).
WS = "[ \\t\\n\\r\\f\\x0B]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    """Python ``str.strip()`` on ASCII whitespace (Spark ``trim`` drops spaces only)."""
    return F.regexp_replace(_c(col), f"^{WS}+|{WS}+$", "")


def extract(col, pattern: str, idx: int = 1) -> Column:
    """Leftmost regex group, NULL when there is no match (pandas ``str.extract``)."""
    return F.nullif(F.regexp_extract(_c(col), pattern, idx), F.lit(""))


def extract_between(col, left: str = ",", right: str = ".", default: str | None = "Unknown") -> Column:
    """Text between the first ``left`` and the next ``right``, stripped; default if absent."""
    l, r = re.escape(left), re.escape(right)
    pat = f"{l}{WS}*([^{r}]+){r}"
    got = strip_ws(extract(col, pat))
    return F.coalesce(got, F.lit(default)) if default is not None else got


def split_part(col, delim: str, n: int, strip: bool = True) -> Column:
    """``n``-th (1-based) piece of ``col.split(delim)``; NULL when absent."""
    piece = F.try_element_at(F.split(_c(col), re.escape(delim)), F.lit(n))
    return strip_ws(piece) if strip else piece


def normalize_key(col) -> Column:
    """Remove all whitespace and upper-case (ticket normalisation)."""
    return F.upper(F.regexp_replace(_c(col), f"{WS}+", ""))


def first_char(col, default: str = "X") -> Column:
    """First character, ``default`` for NULL or empty."""
    return F.coalesce(F.nullif(F.substring(_c(col), 1, 1), F.lit("")), F.lit(default))


def tokens(col) -> Column:
    """Whitespace tokens (``str.split()``), empty array for NULL."""
    return F.filter(F.split(F.coalesce(_c(col), F.lit("")), f"{WS}+"), lambda x: x != "")


def first_token(col, default: str = "Unknown") -> Column:
    """First whitespace token, ``default`` when there is none."""
    first = F.regexp_extract(_c(col), "[^" + WS[1:-1] + "]+", 0)
    return F.coalesce(F.nullif(first, F.lit("")), F.lit(default))


def token_count(col) -> Column:
    """Number of whitespace tokens over the whole text; NULL counts 0."""
    return F.size(tokens(col))


def string_length(col) -> Column:
    return F.length(_c(col))


def _literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def recode(col, mapping: Mapping, default=None) -> Column:
    """``Series.map(mapping).fillna(default)``: unmapped -> ``default`` (NULL if None)."""
    got = F.try_element_at(_literal_map(mapping), _c(col))
    return F.coalesce(got, F.lit(default)) if default is not None else got


def recode_passthrough(col, mapping: Mapping) -> Column:
    """``Series.replace(mapping)``: unmapped values are kept."""
    return F.coalesce(F.try_element_at(_literal_map(mapping), _c(col)), _c(col))


def recode_list(col, values, to: str) -> Column:
    """``Series.replace([v1, v2, ...], to)``."""
    return F.when(_c(col).isin(list(values)), F.lit(to)).otherwise(_c(col))


def safe_text(col) -> Column:
    """``astype(str)``: NULL becomes the text ``nan``."""
    return F.coalesce(_c(col).cast("string"), F.lit("nan"))


def composite_key(*cols, sep: str = "_") -> Column:
    """``a + sep + b.astype(str)``; NULL if any part is NULL (pandas NaN rule)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)
