"""Vibration-signal features per (experiment, bearing, measurement)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .. import config as C
from ..functions import scores as S
from ..functions import signals as G
from ..functions.checks import exact_avg

FEATURE_COLUMNS = (
    "experiment_id", "bearing_id", "measurement_index", "timestamp",
    "rms_amplitude", "peak_amplitude", "crest_factor", "kurtosis", "skewness", "std_deviation",
    "dominant_frequency_hz", "spectral_energy", "bearing_health_index", "sample_count", "processed_at",
)

MATRIX = 1 << 20     # samples transformed at once, or one signal


@F.arrow_udf(DoubleType())
def dominant_frequency(signals: pa.Array, rates: pa.Array) -> pa.Array:
    """(Extension) Frequency of the largest bin of the mean-removed signal (DC left out; 0
    if there is none). The signals of one length are the rows of a matrix and are
    transformed together; NULL signals, rates and samples give NULL."""
    sizes = pc.list_value_length(signals).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = signals.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rate = rates.to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.full(len(sizes), np.nan)
    for n in np.unique(sizes[sizes > 0]).tolist():
        of_size = np.flatnonzero(sizes == n)
        for rows in np.array_split(of_size, -(-len(of_size) * n // MATRIX)):
            x = flat[starts[rows][:, None] + np.arange(n)]
            bins = np.abs(np.fft.rfft(x - x.mean(axis=1, keepdims=True), axis=1))
            bins[:, 0] = 0.0
            top = bins.argmax(axis=1)
            out[rows] = np.where(np.isnan(x).any(axis=1), np.nan, np.where(bins.max(axis=1) > 0, top * rate[rows] / n, 0.0))
    return pa.array(out, from_pandas=True)


def bearing_features(bronze: DataFrame, as_of: Column, signal_col: str = "vibration_signal",
                     with_moments: bool = True, with_spectrum: bool = False,
                     rate_col: str | None = "sample_rate_hz") -> DataFrame:
    """Time-domain features with JVM higher-order functions; empty signals
    are dropped first (no division by zero). ``kurtosis``/``skewness``
    (ours) use central moments. The spectrum (ours) is opt-in: the dominant
    frequency leaves the JVM in Arrow batches; the energy, which is the sum of
    the squared samples by Parseval, does not."""
    sig = F.col(signal_col)
    df = bronze.filter(F.size(sig) > 0)
    df = df.withColumns({
        "sample_count": F.size(sig),
        "rms_amplitude": G.signal_rms(sig),
        "peak_amplitude": G.signal_peak(sig),
        "std_deviation": G.signal_std(sig),
    })
    df = df.withColumn("crest_factor", G.crest_factor("peak_amplitude", "rms_amplitude"))
    df = df.withColumn("bearing_health_index", S.bearing_health_index("rms_amplitude", "crest_factor"))
    if with_moments:
        df = df.withColumns({"kurtosis": G.signal_kurtosis(sig), "skewness": G.signal_skewness(sig)})
    else:
        df = df.withColumns({"kurtosis": F.lit(None).cast("double"), "skewness": F.lit(None).cast("double")})
    if with_spectrum:
        rate = F.col(rate_col) if rate_col and rate_col in bronze.columns else F.lit(C.SAMPLE_RATE_HZ)
        # rounding stays in the JVM (HALF_UP, like every other rounded feature)
        df = df.withColumns({"dominant_frequency_hz": F.round(dominant_frequency(sig, rate.cast("double")), 6),
                             "spectral_energy": F.round(G.signal_energy(sig), 6)})
    else:
        df = df.withColumns({"dominant_frequency_hz": F.lit(None).cast("double"),
                             "spectral_energy": F.lit(None).cast("double")})
    return df.withColumn("processed_at", as_of)


def bearing_health_by_unit(features: DataFrame, keys: tuple[str, ...] = ("experiment_id", "bearing_id")) -> DataFrame:
    return features.groupBy(*keys).agg(
        F.round(exact_avg("bearing_health_index"), 2).alias("avg_health"),
        F.round(F.min("bearing_health_index"), 2).alias("min_health"),
        F.round(exact_avg("rms_amplitude"), 6).alias("avg_rms"),
        F.count("*").alias("measurements"),
    )
