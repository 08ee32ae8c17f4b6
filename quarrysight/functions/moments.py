"""Moments of groups of readings that can be merged without losing digits.

A group is held as its count n, a whole-number anchor q near its mean, the mean's offset
from the anchor and the sum of squared distances from the mean, all in units of 10^-6 of
the reading. Values that fixed point holds (``functions.checks.fixed_point``) are added up
as whole numbers, so a group's moments do not depend on the order of its rows, and no
square of a large value is ever taken from another: of 1e9 + 1 and 1e9 - 1 the distance is
2. Groups with other values (NaN, infinity, very large or very small ones) have the plain
double moments around an anchor of 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .checks import EXACT_SCALE, fixed_point, keeps_digits

UNIT = 10 ** EXACT_SCALE
TYPE = "struct<n:double,q:bigint,off:double,m2:double>"


def in_units(x: Column) -> Column:
    """A reading in units of 10^-6 as a whole number; NULL if fixed point does not hold it."""
    return (fixed_point(x) * UNIT).cast("decimal(18,0)")


def moment_sums(x: Column) -> list[Column]:
    """Aggregates of a group that :func:`moments` needs; all merge exactly or stably."""
    u = in_units(x)
    return [
        F.count(x).alias("_n"), F.count(u).alias("_nu"), F.max(F.abs(x)).alias("_largest"),
        F.try_sum(u.cast("decimal(28,0)")).alias("_s1"), F.try_sum((u * u).cast("decimal(38,0)")).alias("_s2"),
        F.avg(x).alias("_mean"), F.var_pop(x).alias("_var"),
    ]


def moments() -> Column:
    """The group's moments, of the columns of :func:`moment_sums`."""
    n = F.col("_n").cast("double")
    q = F.expr("try_cast(floor(_s1 / _n) as bigint)")
    rest = F.expr("try_subtract(_s1, try_multiply(cast(try_cast(floor(_s1 / _n) as bigint) as decimal(19,0)), cast(_n as decimal(19,0))))")
    # the distances from q: s2 - q (s1 + rest), in whole numbers
    around = F.try_subtract(F.col("_s2"), F.try_multiply(
        q.cast("decimal(19,0)"), F.try_add(F.col("_s1").cast("decimal(38,0)"), rest.cast("decimal(38,0)")))).cast("double")
    good = keeps_digits(F.col("_nu"), F.col("_n"), F.col("_largest")) & q.isNotNull() & rest.isNotNull() & around.isNotNull()
    off = rest.cast("double")
    whole = F.struct(n.alias("n"), q.alias("q"), (off / n).alias("off"), (around - off * off / n).alias("m2"))
    plain = F.struct(n.alias("n"), F.lit(0).cast("bigint").alias("q"), (F.col("_mean") * UNIT).alias("off"),
                     (F.col("_var") * n * UNIT * UNIT).alias("m2"))
    return F.when(F.col("_n") > 0, F.when(good, whole.cast(TYPE)).otherwise(plain.cast(TYPE)))


def merged(groups: Column) -> Column:
    """Moments of several groups, merged pair by pair in the order of the array; NULL of none."""

    def merge(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        step = (b["q"] - a["q"]).cast("double") + (b["off"] - a["off"])
        return F.when(a.isNull(), b).otherwise(F.struct(
            n.alias("n"), a["q"].alias("q"), (a["off"] + step * b["n"] / n).alias("off"),
            (a["m2"] + b["m2"] + step * step * (a["n"] * b["n"] / n)).alias("m2")).cast(TYPE))

    return F.aggregate(groups, F.lit(None).cast(TYPE), merge)


def mean(m: Column) -> Column:
    return (m["q"].cast("double") + m["off"]) / UNIT


def std(m: Column) -> Column:
    """Sample standard deviation; NULL of fewer than two readings."""
    return F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1)) / UNIT)


def distance(x: Column, m: Column) -> Column:
    """A reading minus the mean, the large parts taken off as whole numbers first."""
    u = in_units(x)
    return F.when(u.isNotNull(), (u - m["q"].cast("decimal(19,0)")).cast("double") - m["off"]).otherwise(
        (x * UNIT - m["q"].cast("double")) - m["off"]) / UNIT
