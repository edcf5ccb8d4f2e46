"""Word similarity measures for correction pairs.

``sequence``: Ratcliff-Obershelp ratio as computed by Python's ``difflib.SequenceMatcher(None, a, b)``
(asymmetric; no SQL form), run as an Arrow-batched pandas UDF. Callers apply it to the table of
*distinct* pairs only, never per occurrence.

``edit``: ``1 - levenshtein(a, b) / greatest(len(a), len(b))`` on code points, a built-in expression.
"""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.pandas_udf(DoubleType())
def _sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b):
        if x is None or y is None:
            out.append(None)
        else:
            out.append(difflib.SequenceMatcher(None, x, y).ratio())
    return pd.Series(out, dtype="float64")


def sequence_similarity(a, b) -> Column:
    return _sequence_ratio(_c(a), _c(b))


def edit_similarity(a, b) -> Column:
    a, b = _c(a), _c(b)
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.levenshtein(a, b).cast("double") / longest.cast("double"))


def similarity(a, b, metric: str = "sequence") -> Column:
    if metric == "sequence":
        return sequence_similarity(a, b)
    if metric == "edit":
        return edit_similarity(a, b)
    raise ValueError(f"unknown similarity metric {metric!r}")
