"""Score formulas: health components, status, trend, process and bearing scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from ..config import HealthParams


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clamp(x: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def temperature_score(max_temp: Column | str, limit: Column | str, p: HealthParams = C.HEALTH) -> Column:
    """Margin to the limit in percent, floored at 0 (no upper clamp). A zero
    limit scores 0 instead of failing the job with a division error."""
    t, lim = _c(max_temp), _c(limit)
    return (
        F.when(t.isNull(), F.lit(p.temp_when_no_reading))
        .when(lim.isNull(), F.lit(p.temp_when_no_limit))
        .otherwise(F.greatest(F.lit(0.0), F.round((F.lit(1.0) - F.try_divide(t, lim)) * 100, 2)))
    )


def pressure_score(oil: Column | str, hyd: Column | str, p: HealthParams = C.HEALTH) -> Column:
    """Oil pressure relative to its reference, else hydraulic deviation."""
    o, h = _c(oil), _c(hyd)
    return (
        F.when(o.isNull() & h.isNull(), F.lit(p.pressure_when_no_reading))
        .when(o.isNotNull(), clamp(F.round(o / F.lit(p.oil_reference_bar) * 100, 2), 0.0, 100.0))
        .otherwise(
            clamp(
                F.round((F.lit(1.0) - F.abs(h - F.lit(p.hydraulic_reference_bar)) / F.lit(p.hydraulic_reference_bar)) * 100, 2),
                0.0,
                100.0,
            )
        )
    )


def vibration_score(max_vib: Column | str, p: HealthParams = C.HEALTH) -> Column:
    v = _c(max_vib)
    expr = F.when(v.isNull(), F.lit(p.vibration_when_no_reading))
    for bound, score in p.vibration_ladder:
        expr = expr.when(v > F.lit(bound), F.lit(score))
    return expr.otherwise(F.round(F.lit(100.0) - v * F.lit(p.vibration_slope), 2))


def performance_score(quality: Column | str, utilization: Column | str, flags: Column | str, p: HealthParams = C.HEALTH) -> Column:
    return F.round(
        _c(quality) * F.lit(p.quality_weight)
        + F.least(_c(utilization), F.lit(100.0)) * F.lit(p.utilization_weight)
        + F.greatest(F.lit(0.0), F.lit(p.flag_allowance) - _c(flags) * F.lit(p.flag_penalty)),
        2,
    )


def health_score(temp: Column | str, pressure: Column | str, vib: Column | str, perf: Column | str, p: HealthParams = C.HEALTH) -> Column:
    w = p.weights
    return F.round(_c(temp) * w[0] + _c(pressure) * w[1] + _c(vib) * w[2] + _c(perf) * w[3], 2)


def health_status(score: Column | str, p: HealthParams = C.HEALTH) -> Column:
    """First-match ladder; a NULL score falls through to the default."""
    s = _c(score)
    expr = None
    for bound, label in p.status_ladder:
        expr = F.when(s < F.lit(bound), F.lit(label)) if expr is None else expr.when(s < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(p.status_default))


def health_trend(score: Column | str, prev: Column | str, p: HealthParams = C.HEALTH) -> Column:
    s, q = _c(score), _c(prev)
    return (
        F.when(q.isNull(), F.lit("stable"))
        .when(s - q > F.lit(p.trend_band), F.lit("improving"))
        .when(s - q < F.lit(-p.trend_band), F.lit("degrading"))
        .otherwise(F.lit("stable"))
    )


def days_to_maintenance(score: Column | str, prev: Column | str, trend: Column | str) -> Column:
    """Only for degrading units: max(1, round(score / max(1, |delta|)))."""
    s, q = _c(score), _c(prev)
    est = F.greatest(F.lit(1), F.round(s / F.greatest(F.lit(1.0), F.abs(s - q))).cast("int"))
    return F.when(_c(trend) == "degrading", est).otherwise(F.lit(None).cast("int"))


def silica_quality(silica: Column | str) -> Column:
    s = _c(silica)
    expr = F.when(s.isNull(), F.lit(C.SILICA_QUALITY_NULL))
    for bound, score in C.SILICA_QUALITY_LADDER:
        expr = expr.when(s <= F.lit(bound), F.lit(score))
    return expr.otherwise(F.lit(C.SILICA_QUALITY_ELSE))


def process_quality_score(breach_rate_pct: Column | str, avg_silica: Column | str) -> Column:
    """100 - 0.5*breach% - max(0, (silica - 2) * 10); an hour without silica
    values loses nothing on the second term (``greatest`` skips NULL)."""
    return F.round(
        F.lit(100)
        - _c(breach_rate_pct) * F.lit(C.BREACH_RATE_PENALTY)
        - F.greatest(F.lit(0), (_c(avg_silica) - F.lit(C.SILICA_TARGET_PCT)) * F.lit(C.SILICA_EXCESS_PENALTY)),
        2,
    )


def bearing_health_index(rms: Column | str, crest: Column | str) -> Column:
    return F.round(
        F.greatest(
            F.lit(0.0),
            F.lit(100.0) - _c(rms) * F.lit(C.RMS_PENALTY) - F.greatest(F.lit(0.0), (_c(crest) - F.lit(C.CREST_KNEE)) * F.lit(C.CREST_PENALTY)),
        ),
        2,
    )
