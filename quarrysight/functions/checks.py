"""Range checks, flag arrays and first-match ladders."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import QUALITY_BY_FLAGS, QUALITY_FLOOR, Band, RangeRule


def range_violation(col: Column | str, lo: float, hi: float) -> Column:
    """Non-null and outside the closed range [lo, hi].

    NaN compares greater than every number in Spark, so NaN is a violation.
    """
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & ((c < F.lit(lo)) | (c > F.lit(hi)))


def rule_violation(rule: RangeRule) -> Column:
    return range_violation(rule.column, rule.lo, rule.hi)


def hard_violation(rules: tuple[RangeRule, ...]) -> Column:
    """OR of every hard rule; FALSE when there is none."""
    hard = [rule_violation(r) for r in rules if r.hard]
    return reduce(or_, hard) if hard else F.lit(False)


def flag_reasons(rules: tuple[RangeRule, ...]) -> Column:
    """``array<string>`` of ``<column>_out_of_range`` in rule order."""
    return F.array_compact(
        F.array(*[F.when(rule_violation(r), F.lit(f"{r.column}_out_of_range")) for r in rules])
    )


def quality_from_flag_count(n: Column) -> Column:
    """1.0 / 0.7 / 0.4 / 0.1 for 0 / 1 / 2 / 3+ flags."""
    expr = None
    for k, score in enumerate(QUALITY_BY_FLAGS):
        expr = F.when(n == k, F.lit(score)) if expr is None else expr.when(n == k, F.lit(score))
    return expr.otherwise(F.lit(QUALITY_FLOOR))


def band_label(col: Column | str, bands: tuple[Band, ...]) -> Column:
    """First-match band ladder: exact rungs test equality, others ``>=``."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    default = None
    for b in bands:
        if b.lower is None:
            default = F.lit(b.label)
            continue
        cond = (c == F.lit(b.lower)) if b.exact else (c >= F.lit(b.lower))
        expr = F.when(cond, F.lit(b.label)) if expr is None else expr.when(cond, F.lit(b.label))
    return expr.otherwise(default) if default is not None else expr


def severity_rank(col: Column | str, order: tuple[str, ...]) -> Column:
    """Position of a severity in ``order`` (1-based), NULL when unknown."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, label in enumerate(order, start=1):
        expr = F.when(c == label, F.lit(i)) if expr is None else expr.when(c == label, F.lit(i))
    return expr


EXACT_SCALE = 6
# inputs are DECIMAL(18, 6): |x| < 1e12, and Spark keeps such values as
# compact longs (a 38-digit input would fall back to BigDecimal arithmetic)
EXACT_PRECISION = 18


def fixed_point(c: Column, scale: int = EXACT_SCALE) -> Column:
    """The value in fixed point; NULL for NaN, infinity and 1e12 or more."""
    return c.try_cast(f"decimal({EXACT_PRECISION},{scale})")


def keeps_digits(n_fixed: Column, n: Column, largest: Column, scale: int = EXACT_SCALE) -> Column:
    """Whether fixed point serves a group: all its values have one, and the
    largest magnitude is not so small that the scale would cut it short."""
    return (n_fixed == n) & ((largest >= 5000 * 10.0 ** -scale) | (largest == 0) | largest.isNull())


def _exact(agg, col: Column | str, scale: int) -> Column:
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    fixed = fixed_point(c, scale)
    good = keeps_digits(F.count(fixed), F.count(c), F.max(F.abs(c)), scale)
    return F.when(good, agg(fixed).cast("double")).otherwise(agg(c))


def exact_sum(col: Column | str, scale: int = EXACT_SCALE) -> Column:
    """Sum as double. A group whose values fit fixed point is summed so, which
    gives the same answer in any order of rows; else (NaN, infinity, very large
    values, or none but very small ones) it is the plain double sum."""
    return _exact(F.sum, col, scale)


def exact_avg(col: Column | str, scale: int = EXACT_SCALE) -> Column:
    """Mean as double, see :func:`exact_sum`; in fixed point rounded HALF_UP to
    ``scale + 4`` decimals."""
    return _exact(F.avg, col, scale)
