"""Embedding whitening: pivoted Cholesky of the scatter, one-sided Jacobi on its factor.

An entry c becomes the integer x = floor(64 c) + 1,000,000, so that counts, sums and
scatter are exact in whole numbers and do not depend on how rows are dealt out:

1. every task adds up its x-vectors; the sums S and the count n fix an integer centre;
2. every task adds up the products of its vectors' distances from that centre, Spark
   adds the tasks' tables (one row for each pair of dimensions), and the rest of the
   mean is taken out as a fraction of whole numbers: the covariance V, rounded once;
3. V = L L' by Cholesky with diagonal pivoting, which also finds the rank; Jacobi
   rotations from the right make the columns of L orthogonal. Their squared norms are
   V's eigenvalues, the columns divided by their norms its eigenvectors.

The driver holds dimension x dimension numbers, whatever the number of rows.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries
are left out, and so are those of another length than most (of equally frequent ones
the longest); x is held within +-2^53 (entries beyond 1.4e14); rows with equal or
null ids, and equal vectors, all count and are all returned; directions without a
variance that doubles can tell from the largest's rounding have no component, so equal
vectors alone, a single one, or an empty table give no components; a deviation past a
long is null in ``whiten_components`` (``transform`` has it whole); other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
HELD = float(1 << 53)        # a double holds every whole number up to here
KEEP = 32                    # components, at most
SWEEPS = 60
EXACT = 1 << 53              # sums of products below this are exact in doubles
WIDE = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """A fit: ``components`` are unit columns by falling ``eigenvalues``."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace


def vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, vector as doubles) of the rows that have a whole finite vector."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (df.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v"))
            .where(F.col("v").isNotNull() & (F.size("v") > 0) & fine))


def dimension(rows: DataFrame) -> int:
    """The most frequent length; 0 of no rows."""
    got = (rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
           .orderBy(F.col("n").desc(), F.col("d").desc()).first())
    return got["d"] if got else 0


def whole(column: pa.Array, dim: int) -> np.ndarray:
    """x of a list column of doubles, one row each."""
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return np.clip(np.floor(SCALE * c) + OFFSET, -HELD, HELD).astype(np.int64)


def gram(d: np.ndarray) -> np.ndarray:
    """d'd in whole numbers."""
    top = int(np.abs(d).max()) ** 2 if len(d) else 0
    if top * len(d) < EXACT:
        f = d.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    if top * len(d) < WIDE:
        return d.T @ d
    big = d.astype(object)
    return big.T @ big


def _added(rows: DataFrame, dim: int, value: Callable[[np.ndarray], np.ndarray]) -> tuple[int, list[int]]:
    """Number of rows, and the flat whole-number table that ``value`` gives of a
    batch's x, added up over all rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = whole(batch.column(0), dim)
            if len(x):
                got = value(x).ravel().astype(object)
                n, total = n + len(x), got if total is None else total + got
        if n:
            yield pa.record_batch({
                "at": pa.array(range(-1, len(total)), pa.int32()),
                "value": pa.array([Decimal(n), *map(Decimal, total.tolist())], pa.decimal128(38, 0))})

    got = (rows.select("v").mapInArrow(add, "at int, value decimal(38,0)")
           .groupBy("at").agg(F.sum("value").alias("value")).collect())   # one row per pair of dimensions
    values = {r["at"]: int(r["value"]) for r in got}
    return values.get(-1, 0), [values[k] for k in range(len(values) - 1)]


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """L (dimension x rank), rows in v's order, with L L' = v: triangular but for the
    order of its rows."""
    a, d = v.astype(float).copy(), len(v)
    order = np.arange(d)
    out = np.zeros((d, d))
    least = d * np.finfo(float).eps * max(float(np.diag(a).max(initial=0.0)), 0.0)
    rank = 0
    for k in range(d):
        p = k + int(np.argmax(np.diag(a)[k:]))
        if a[p, p] <= least:
            break
        for m in (a, a.T):
            m[[k, p]] = m[[p, k]]
        out[[k, p]], order[[k, p]] = out[[p, k]], order[[p, k]]
        out[k, k] = np.sqrt(a[k, k])
        out[k + 1:, k] = a[k + 1:, k] / out[k, k]
        a[k + 1:, k + 1:] -= np.outer(out[k + 1:, k], out[k + 1:, k])
        rank += 1
    back = np.empty_like(out[:, :rank])
    back[order] = out[:, :rank]
    return back


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns, in rounds of pairs that share none."""
    m = n + n % 2
    ring = np.arange(m)
    for _ in range(m - 1):
        p, q = ring[:m // 2], ring[m // 2:][::-1]
        keep = (p < n) & (q < n)
        yield p[keep], q[keep]
        ring[1:] = np.roll(ring[1:], 1)


def jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of factor factor', by
    rotating pairs of the factor's columns until all are orthogonal."""
    a = factor.copy()
    for _ in range(SWEEPS):
        worst = 0.0
        for p, q in _rounds(a.shape[1]):
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            lean = np.abs(xy) / np.sqrt(np.maximum(xx * yy, np.finfo(float).tiny))
            worst = max(worst, float(lean.max(initial=0.0)))
            turn = lean > np.finfo(float).eps
            z = (yy - xx) / np.where(turn, 2 * xy, 1.0)
            t = np.where(turn, np.where(z < 0, -1.0, 1.0) / (np.abs(z) + np.hypot(1.0, z)), 0.0)
            c = 1 / np.hypot(1.0, t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
        if worst <= len(a) * np.finfo(float).eps:
            break
    values = (a * a).sum(0)
    order = np.argsort(-values, kind="stable")
    values, unit = values[order], a[:, order] / np.sqrt(values[order])
    if unit.size:
        unit *= np.where(unit[np.abs(unit).argmax(0), np.arange(unit.shape[1])] < 0, -1.0, 1.0)
    return values, unit


def fit(rows: DataFrame) -> Whitening | None:
    """Fit on all ``rows`` (of :func:`vectors`); None without any. Three passes, each a
    sum over rows: lengths, sums, products."""
    dim = dimension(rows)
    if not dim:
        return None
    rows = rows.where(F.size("v") == dim)
    n, sums = _added(rows, dim, lambda x: x.astype(object).sum(0) if np.abs(x).max() > WIDE // len(x) else x.sum(0))
    centre = [(2 * s + n) // (2 * n) for s in sums]
    near = np.array(centre, np.int64)
    _, products = _added(rows, dim, lambda x: gram(x - near))
    rest = [s - n * c for s, c in zip(sums, centre)]
    v = np.array([[(n * products[i * dim + j] - rest[i] * rest[j]) / (n * n) for j in range(dim)] for i in range(dim)])
    values, unit = jacobi(pivoted_cholesky(v))
    return Whitening(n, tuple(sums), unit, values, float(np.trace(v)))


def _distances(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n x - S, exact."""
    sums = np.array(model.sums, object)
    if model.n * (int(np.abs(x).max()) + 1) + max(map(abs, model.sums)) < WIDE:
        return model.n * x - sums.astype(np.int64)
    return model.n * x.astype(object) - sums


def _squares(d: np.ndarray) -> list[int]:
    if d.dtype != object and int(np.abs(d).max()) ** 2 * d.shape[1] < WIDE:
        return (d * d).sum(1).tolist()
    return (d.astype(object) ** 2).sum(1).tolist()


def transform(rows: DataFrame, model: Whitening, keep: int = KEEP) -> DataFrame:
    """(id, deviation, whitened) per row of the fit's length: the sum over dimensions of
    (n x - S)^2, a whole number, and the first ``keep`` whitened coordinates. No shuffle."""
    k = min(keep, len(model.eigenvalues))
    turned = model.components[:, :k] / np.sqrt(model.eigenvalues[:k])
    dim, kind = model.dim, rows.schema["id"].dataType.simpleString()

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = _distances(whole(batch.column(1), dim), model)
            flat = ((d / model.n).astype(float) @ turned).ravel()
            yield pa.record_batch({
                "id": batch.column(0),
                "deviation": pa.array(map(Decimal, _squares(d)), pa.decimal128(38, 0)),
                "whitened": pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, k, dtype=np.int32) if k else
                                                     np.zeros(len(d) + 1, np.int32), pa.array(flat, pa.float64()))})

    return rows.where(F.size("v") == dim).select("id", "v").mapInArrow(
        whiten, f"id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, in size. Each
    task centres on its own means before it multiplies; the means are set right in the sum."""
    k = min(KEEP, len(model.eigenvalues))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and k:
                w = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                mean = w.mean(0)
                d = w - mean
                size = w.shape[1]
                yield pa.record_batch({
                    "at": pa.array(np.arange(size * size), pa.int32()),
                    "n": pa.array(np.full(size * size, len(w)), pa.int64()),
                    "p": (d.T @ d).ravel(), "a": np.repeat(mean, size), "b": np.tile(mean, size)})

    got = (
        whitened.select("whitened").mapInArrow(products, "at int, n long, p double, a double, b double")
        .groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("p") + F.col("n") * F.col("a") * F.col("b")).alias("p"),
                           F.sum(F.col("n") * F.col("a")).alias("a"), F.sum(F.col("n") * F.col("b")).alias("b"))
        .select("at", ((F.col("p") - F.col("a") * F.col("b") / F.col("n")) / F.col("n")).alias("c")).collect())
    size = round(len(got) ** 0.5)
    return max((abs(r["c"] - (r["at"] % (size + 1) == 0)) for r in got), default=0.0)


def whiten_components(df: DataFrame, keep: int = KEEP) -> DataFrame:
    """One row per row of ``df`` (vec_id, embedding) and component: vec_id, component, n,
    deviation, whitened, explained, identity_error."""
    rows = vectors(df)
    model = fit(rows)
    kind = rows.schema["id"].dataType.simpleString()
    if model is None or not len(model.eigenvalues):
        return rows.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    out = transform(rows, model, keep)
    error = identity_error(out, model)
    share = F.array(*[F.lit(float(e)) for e in model.explained[:keep]])
    return (
        out.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(F.col("id").alias("vec_id"), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                F.expr("try_cast(deviation as bigint)").alias("deviation"), "whitened",
                F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
