"""Whitening of embeddings by eigenvectors of their covariance in mixed precision.

Every entry becomes a whole number.  The fit list holds each distinct vector
once; its size and its sums are exact.  The covariance is summed over the
partitions from centred rows.  Its eigenvectors are found in single precision
and then corrected by Ogita-Aishima iterations, which need matrix products
only, in extended precision.  Eigenvalues that lie too close together for the
correction are clusters: the covariance projected on a cluster's vectors,
shifted by its middle, is solved by itself and turns these vectors.  Rows are
projected on the first components and divided by the standard deviations.

The driver holds one covariance (dimension squared) per vector length; the
fit list and all rows stay in tasks.

Defined results: rows whose vector is NULL or holds a NULL or non-finite entry
take no part; entries beyond a long after scaling are the largest or smallest
long; vectors of another length are fitted by themselves, empty vectors have
no components, and a vector of fewer entries than components has as many as
entries.  A component without variance (one distinct vector, or a direction
that all vectors share) has a NULL ``whitened``; without any variance
``explained`` and ``identity_error`` are NULL too.  Equal eigenvalues may be
given any basis of their space, the same for all rows.  Repeated rows and NULL
ids are rows like any other; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import ship_package, stored

HIGH = np.longdouble
SAFE = 2**62
NO_VARIANCE = 2.0**-44  # of the largest eigenvalue
ROUNDS = 40


# --- eigenvectors -----------------------------------------------------------


def correction(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima step: the corrected vectors, their values, the error before it and the least gap it can part."""
    r = np.eye(len(a), dtype=HIGH) - x.T @ x
    s = x.T @ a @ x
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    size = np.linalg.norm(a.astype(np.float64), 2)
    error = max(np.linalg.norm(off.astype(np.float64), 2) / size, np.linalg.norm(r.astype(np.float64), 2))
    gap = 2 * (np.linalg.norm(off.astype(np.float64), 2) + size * np.linalg.norm(r.astype(np.float64), 2))
    apart = values[None, :] - values[:, None]
    far = np.abs(apart) > gap
    e = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
    return x + x @ e, values, float(error), float(gap)


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other within ``gap``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigenvectors(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Single precision, then corrections in extended precision until the error
    stops falling.  The entry of largest size of every vector is positive.
    """
    size = float(np.abs(covariance).max(initial=0.0))
    if not size:
        return np.zeros(len(covariance)), np.eye(len(covariance))
    a = covariance.astype(HIGH) / HIGH(size)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)
    best, floor, stale = None, 4 * float(np.finfo(HIGH).eps) * len(a), 0
    for _ in range(ROUNDS):
        corrected, values, error, gap = correction(a, x)
        if best is None or error < best[0]:
            stale = 0 if best is None or error < best[0] / 2 else stale + 1
            best = (error, values, x)
        else:
            stale += 1
        if error <= floor or stale > 3:
            break
        x = corrected
        for close in clusters(values, gap):
            part, middle = x[:, close], values[close].mean()
            inner = part.T @ (a @ part - middle * part)
            inner = (inner + inner.T) / 2
            spread = np.abs(inner).max()
            if spread > 0:
                turn = np.linalg.eigh((inner / spread).astype(np.float64))[1].astype(HIGH)
                x[:, close] = part @ (turn + turn @ (np.eye(len(turn), dtype=HIGH) - turn.T @ turn) / 2)
    _, values, x = best
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order]
    x = x / np.sqrt((x * x).sum(axis=0))
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(a))] < 0, -1, 1)
    return (values * HIGH(size)).astype(np.float64), x.astype(np.float64)


# --- vectors ----------------------------------------------------------------


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, x``: entries times ``scale``, rounded down."""
    entry = F.col(vector_col)
    finite = F.forall(entry, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    x = F.transform(entry, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(0).cast("long"))
    # NaN is larger than infinity here, so it is not finite either
    return rows.filter(entry.isNotNull() & finite).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def matrices(column: pa.ListArray):
    """(places, matrix of longs) of the vectors of each length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        if d:
            chosen = column if len(at) == len(column) else column.take(pa.array(at))
            yield at, chosen.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, int(d))


@dataclass
class Fit:
    """A vector length's fit list: size and exact sums, then components and their variances."""

    n: int
    sums: list[int]
    components: np.ndarray | None = None
    variances: np.ndarray | None = None
    explained: list[float] | None = None
    identity_error: float | None = None

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n·x - S, exact: longs where they suffice, else Python integers."""
        largest = max(int(x.max()), -int(x.min()), 1)
        if self.n * largest + max(map(abs, self.sums)) < SAFE:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n; the only rounding is the division's."""
        spread = self.spread(x)
        if spread.dtype == object:
            return np.array([[v / self.n for v in row] for row in spread.tolist()])
        if max(int(spread.max()), -int(spread.min())) < 2**53:
            return spread / self.n
        return (spread.astype(HIGH) / HIGH(self.n)).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int]:
        spread = self.spread(x)
        if spread.dtype != object and max(int(spread.max()), -int(spread.min())) ** 2 * x.shape[1] < SAFE:
            return (spread * spread).sum(axis=1).tolist()
        return [sum(v * v for v in row) for row in spread.tolist()]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Components that have a variance, over their standard deviations."""
        kept = self.variances > 0
        return self.centred(x) @ (self.components[:, kept] / np.sqrt(self.variances[kept]))


def _sums(fit: DataFrame) -> dict[int, Fit]:
    """Sizes and exact sums; one row per partition and entry before the shuffle."""

    def partial(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for _, x in matrices(batch.column(0)):
                n, total = found.get(x.shape[1], (0, np.zeros(x.shape[1], dtype=object)))
                exact = max(int(x.max()), -int(x.min())) * len(x) < SAFE
                found[x.shape[1]] = n + len(x), total + (x if exact else x.astype(object)).sum(axis=0).astype(object)
        for d, (n, total) in found.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d] * d, pa.int32()),
                    pa.array(range(d), pa.int32()),
                    pa.array([n] * d, pa.int64()),
                    pa.array(list(map(Decimal, total.tolist())), pa.decimal128(38, 0)),
                ],
                names=["d", "i", "n", "s"],
            )

    rows = fit.mapInArrow(partial, "d int, i int, n long, s decimal(38,0)")
    out: dict[int, Fit] = {}
    for r in rows.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d", "i").collect():
        out.setdefault(r["d"], Fit(r["n"], [])).sums.append(int(r["s"]))
    return out


def _products(fit: DataFrame, fits: dict[int, Fit], columns) -> dict[int, np.ndarray]:
    """Per vector length the mean over the fit list of the products of ``columns(fit, x)`` with themselves.

    A partition gives one matrix, row by row; a row's parts are added in the
    order of partitions, so a rerun gives the same bits.
    """

    def partial(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in matrices(batch.column(0)):
                d = x.shape[1]
                values = columns(fits[d], x)
                if values.shape[1]:
                    found[d] = found.get(d, 0.0) + values.T @ values
        for d, product in found.items():
            k = len(product)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d] * k, pa.int32()),
                    pa.array(range(k), pa.int32()),
                    pa.array([TaskContext.get().partitionId()] * k, pa.int32()),
                    pa.array(product.tolist(), pa.list_(pa.float64())),
                ],
                names=["d", "i", "part", "row"],
            )

    def added(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.array(table["row"].to_pylist()).sum(axis=0)
        return pa.table(
            {"d": table["d"][:1], "i": table["i"][:1], "row": pa.array([total.tolist()], pa.list_(pa.float64()))}
        )

    rows = fit.mapInArrow(partial, "d int, i int, part int, row array<double>")
    out: dict[int, list] = {}
    for r in rows.groupBy("d", "i").applyInArrow(added, "d int, i int, row array<double>").orderBy("d", "i").collect():
        out.setdefault(r["d"], []).append(r["row"])
    return {d: np.array(m) / fits[d].n for d, m in out.items()}


def _means(fit: DataFrame, fits: dict[int, Fit]) -> dict[int, np.ndarray]:
    """Per vector length the mean of the whitened fit list."""

    def partial(batches):
        for batch in batches:
            for _, x in matrices(batch.column(0)):
                total = fits[x.shape[1]].whitened(x).sum(axis=0)  # no entries without variance
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x.shape[1]] * len(total), pa.int32()),
                        pa.array(range(len(total)), pa.int32()),
                        pa.array(total, pa.float64()),
                    ],
                    names=["d", "i", "s"],
                )

    rows = fit.mapInArrow(partial, "d int, i int, s double").groupBy("d", "i").agg(F.sum("s").alias("s"))
    out: dict[int, list] = {}
    for r in rows.orderBy("d", "i").collect():
        out.setdefault(r["d"], []).append(r["s"] / fits[r["d"]].n)
    return {d: np.array(m) for d, m in out.items()}


def fit_whitening(vectors: DataFrame, components: int = 4) -> dict[int, Fit]:
    """The fits of the vectors ``x``, by length.

    Distinct vectors are found by grouping on the whole vector: a vector that
    makes up a third of the rows is one row per task before the shuffle.
    """
    fit = stored(vectors.select("x").distinct(), "fit-list")
    fits = _sums(fit)
    for d, covariance in _products(fit, fits, Fit.centred).items():
        values, vectors_of = eigenvectors((covariance + covariance.T) / 2)
        k, trace = min(components, d), float(np.trace(covariance))
        values = np.where(values > values[0] * NO_VARIANCE, values, 0.0)[:k]
        fits[d].components, fits[d].variances = vectors_of[:, :k], values
        fits[d].explained = [float(v) / trace if trace > 0 else None for v in values]
    means = _means(fit, fits)  # none for a length without variance
    for d, product in _products(fit, fits, lambda f, x: f.whitened(x) - means.get(x.shape[1], 0.0)).items():
        fits[d].identity_error = float(np.abs(product - np.eye(len(product))).max())
    return fits


def whiten(
    rows: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component.

    ``n`` is the size of the fit list, ``deviation`` the exact sum over the
    entries of (n·x - S)² as a decimal of 38 digits (NULL beyond), ``whitened``
    the row's component over its standard deviation.
    """
    ship_package(rows.sparkSession)
    vectors = whole_vectors(rows, id_col, vector_col, scale)
    fits = fit_whitening(vectors, components)

    def project(batches):
        for batch in batches:
            for at, x in matrices(batch.column(1)):
                fit = fits[x.shape[1]]
                k = len(fit.variances)
                values = np.full((len(x), k), np.nan)
                values[:, fit.variances > 0] = fit.whitened(x)
                exact = [Decimal(v) if v < 10**38 else None for v in fit.deviations(x)]
                times = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at[times])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(times), fit.n, dtype=np.int64)),
                        pa.array(exact, pa.decimal128(38, 0)).take(pa.array(times)),
                        pa.array(values.reshape(-1), pa.float64(), from_pandas=True),
                        pa.array(fit.explained * len(x), pa.float64()),
                        pa.array([fit.identity_error] * len(times), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return vectors.mapInArrow(project, schema)
