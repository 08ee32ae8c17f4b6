"""Vector magnitude of multi-axis vibration readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def magnitude(*cols: Column | str, null_as_zero: bool = False) -> Column:
    """sqrt(x^2 + y^2 + ...). With ``null_as_zero`` a missing axis counts 0,
    otherwise any missing axis makes the result NULL (silver vs gold rule).
    """
    terms = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        if null_as_zero:
            col = F.coalesce(col, F.lit(0.0))
        terms.append(F.pow(col, 2))
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.sqrt(total)
