"""Time-domain features of an ``array<double>`` signal, as higher-order
functions evaluated inside the JVM (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def signal_rms(sig: Column | str, digits: int = 6) -> Column:
    s = _c(sig)
    ssq = F.aggregate(s, F.lit(0.0), lambda acc, x: acc + F.pow(x, 2))
    return F.round(F.sqrt(F.try_divide(ssq, F.size(s))), digits)


def signal_peak(sig: Column | str, digits: int = 6) -> Column:
    return F.round(F.array_max(F.transform(_c(sig), lambda x: F.abs(x))), digits)


def signal_energy(sig: Column | str) -> Column:
    """Sum of the squared samples."""
    return F.aggregate(_c(sig), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def crest_factor(peak: Column | str, rms: Column | str, digits: int = 4) -> Column:
    return F.when(_c(rms) > 0, F.round(_c(peak) / _c(rms), digits)).otherwise(F.lit(0.0))


def _moments(sig: Column) -> Column:
    """One pass over the array: (n, sum, sum of squares)."""
    zero = F.struct(
        F.lit(0).cast("long").alias("n"),
        F.lit(0.0).alias("s1"),
        F.lit(0.0).alias("s2"),
    )
    return F.aggregate(
        sig,
        zero,
        lambda acc, x: F.struct(
            (acc["n"] + 1).alias("n"),
            (acc["s1"] + x).alias("s1"),
            (acc["s2"] + F.pow(x, 2)).alias("s2"),
        ),
    )


def signal_std(sig: Column | str, digits: int = 6) -> Column:
    """Population standard deviation from one (n, sum, sum-of-squares) pass.

    E[x^2] - E[x]^2 can dip below zero by rounding; it is clamped at 0
    instead of producing NaN.
    """
    m = _moments(_c(sig))
    mean = F.try_divide(m["s1"], m["n"])
    var = F.try_divide(m["s2"], m["n"]) - F.pow(mean, 2)
    return F.round(F.sqrt(F.greatest(var, F.lit(0.0))), digits)


def signal_central_moments(sig: Column | str) -> Column:
    """struct(mean, m2, m3, m4): population central moments, two passes
    over the array (mean first, then powers of the deviations)."""
    s = _c(sig)
    n = F.size(s)
    mean = F.try_divide(F.aggregate(s, F.lit(0.0), lambda acc, x: acc + x), n)
    dev = F.aggregate(
        s,
        F.struct(F.lit(0.0).alias("m2"), F.lit(0.0).alias("m3"), F.lit(0.0).alias("m4")),
        lambda acc, x: F.struct(
            (acc["m2"] + F.pow(x - mean, 2)).alias("m2"),
            (acc["m3"] + F.pow(x - mean, 3)).alias("m3"),
            (acc["m4"] + F.pow(x - mean, 4)).alias("m4"),
        ),
    )
    return F.struct(
        mean.alias("mean"),
        F.try_divide(dev["m2"], n).alias("m2"),
        F.try_divide(dev["m3"], n).alias("m3"),
        F.try_divide(dev["m4"], n).alias("m4"),
    )


def signal_skewness(sig: Column | str, digits: int = 6) -> Column:
    """Population skewness m3 / m2^1.5 (NULL for a constant signal)."""
    m = signal_central_moments(sig)
    return F.round(F.when(m["m2"] > 0, m["m3"] / F.pow(m["m2"], 1.5)), digits)


def signal_kurtosis(sig: Column | str, digits: int = 6) -> Column:
    """Population (non-excess) kurtosis m4 / m2^2 (NULL for a constant signal)."""
    m = signal_central_moments(sig)
    return F.round(F.when(m["m2"] > 0, m["m4"] / F.pow(m["m2"], 2)), digits)
