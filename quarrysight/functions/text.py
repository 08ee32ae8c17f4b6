"""String helpers: decimal commas, deterministic ids, JSON packing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma_to_double(col: Column | str) -> Column:
    """``"1,5"`` -> 1.5; anything still unparseable (``"1.234,5"``) -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c.cast("string"), ",", ".").try_cast("double")


def stable_id(*cols: Column | str) -> Column:
    """Deterministic 256-bit hex id of the key columns (replaces ``uuid()``).

    NULLs are written as ``\\N`` so that (NULL, 'a') != ('', 'a').
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\\N")) for c in cols]
    return F.sha2(F.concat_ws("|", *parts), 256)
