"""Embedding whitening by matrix-free block subspace iteration.

The covariance matrix is never formed: a Spark pass multiplies a block of columns
by it, as the sum over all rows of x (x' Q) with x centred first. The driver
orthonormalises the product against the blocks so far (QR), solves the small
projected problem (Rayleigh-Ritz) and takes the residuals of the leading pairs as
the next block, until the residuals of all wanted components are certified. What
the driver holds is a few blocks of as many rows as a vector has entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import matrix_of, summed, whole_vectors

#: Columns of a block, and blocks that the projected problem keeps before it
#: starts again from its leading pairs.
BLOCK, KEPT_BLOCKS = 64, 4
#: A component is certified when its residual is at most this share of the largest
#: eigenvalue; one with less than that share of the variance counts as none.
TOLERANCE, NOTHING = 1e-12, 1e-12


@dataclass
class Whitening:
    """What was fit: rows ``n``, exact ``sums`` of the entries, ``components`` as
    columns with their eigenvalues ``values``, the ``trace`` of the covariance, the
    ``passes`` it took, and the largest ``residual`` as a share of the largest value."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    residual: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def of(self, x: np.ndarray) -> np.ndarray:
        """The whitened coordinates of rows."""
        return ((x - self.mean) @ self.components) / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """The exact sum over entries of (n x - sum) squared, for each row."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        kind = np.int64 if most * most * x.shape[1] < 1 << 63 else object  # whole numbers of any size
        off = x.astype(kind) * self.n - np.array(self.sums, kind)
        return (off * off).sum(axis=1).tolist()


def orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns of what ``block`` has outside ``basis``."""
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
        q, r = np.linalg.qr(block)
        block = q[:, np.abs(np.diag(r)) > 1e-8]
    return block[:, : len(block) - basis.shape[1]]


def leading(rows: DataFrame, n: int, mean: np.ndarray, k: int, block: int, tolerance: float, most_passes: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray, int, float]:
    """(eigenvalues, eigenvectors, passes, residual) of the ``k`` largest
    eigenvalues of the covariance of ``rows``, which are read once in a pass."""
    d = len(mean)
    k = min(k, d)
    block = min(d, max(block, k))
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, block)))[0]
    basis, image = np.empty((d, 0)), np.empty((d, 0))

    def times(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ (centred @ q)

    for passes in range(1, most_passes + 1):
        basis, image = np.hstack([basis, q]), np.hstack([image, summed(rows, times) / n])
        small = basis.T @ image
        values, turned = np.linalg.eigh((small + small.T) / 2)
        values, turned = values[::-1][:block], turned[:, ::-1][:, :block]
        ritz, applied = basis @ turned, image @ turned
        off = applied - ritz * values
        largest = max(values[0], np.finfo(float).tiny)
        residual = float(np.linalg.norm(off[:, :k], axis=0).max() / largest)
        if residual <= tolerance or values[0] <= 0:
            return values[:k], ritz[:, :k], passes, residual
        if basis.shape[1] + block > KEPT_BLOCKS * block:
            basis, image = ritz, applied
        q = orthonormal(off, basis)
        if not q.shape[1]:  # the basis holds all that rows span
            return values[:k], ritz[:, :k], passes, residual
    raise RuntimeError(f"components not certified in {most_passes} passes: residual {residual}")


def fit(vectors: DataFrame, components: int = 4, block: int = BLOCK, tolerance: float = TOLERANCE, most_passes: int = 200) -> Whitening | None:
    """The whitening of the distinct vectors in column ``x`` (see
    ``whole_vectors``); None without any.

    Components come by falling eigenvalue, with the sign that makes the largest
    entry positive; those without variance are left out, so there may be less than
    asked for.
    """
    rows = written(vectors.select("x").distinct())
    # entries in two halves of 32 bits, so that the sums are exact for any entry
    counted = summed(rows, lambda x: np.vstack([np.full(x.shape[1], len(x)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]))
    if counted is None:
        return None
    n, sums = int(counted[0, 0]), [(int(high) << 32) + int(low) for high, low in counted[1:].T]
    mean = np.array([s / n for s in sums])
    trace = float(summed(rows, lambda x: np.array([((x - mean) ** 2).sum()]))[0] / n)
    values, found, passes, residual = leading(rows, n, mean, components, block, tolerance, most_passes)
    real = values > NOTHING * trace
    values, found = values[real], found[:, real]
    found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    out = Whitening(n, sums, found, values, trace, passes, residual)
    if len(values):
        spread = summed(rows, lambda x: (w := out.of(x)).T @ w) / n
        out.identity_error = float(np.abs(spread - np.eye(len(values))).max())
    return out


def whiten(embeddings: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> tuple[DataFrame, Whitening | None]:
    """Each usable row as (id_col, whitened array<double>, deviation), and what was
    fit on the distinct vectors.

    ``deviation`` is a decimal of 38 digits, null beyond them. Vectors that are
    null, empty, of an unusual length or with null or non-finite entries give no
    row; null ids and repeated rows give a row each; copies of a vector count once
    in the fit; equal eigenvalues leave their components' directions open, but one
    choice holds for all rows; an empty table gives no rows; other columns are not
    read.
    """
    rows = whole_vectors(embeddings, vector_col, id_col)
    model = fit(rows, components, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column(1))
            w = model.of(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            exact = [str(v) if v < 10**38 else None for v in model.deviations(x)]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(exact, pa.string())], [id_col, "whitened", "deviation"])

    typed = rows.select(F.col(f"`{id_col}`").cast("long").alias(id_col), "x")
    if model is None:
        return typed.limit(0).select(id_col, F.array().cast("array<double>").alias("whitened"), F.lit(None).cast("decimal(38,0)").alias("deviation")), None
    out = typed.mapInArrow(run, f"`{id_col}` long, whitened array<double>, deviation string")
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)")), model


def report(embeddings: DataFrame, components: int = 4) -> DataFrame:
    """A row for each usable row of ``embeddings`` and component: vec_id,
    component, n, deviation (null if it does not fit a long), whitened, explained,
    identity_error. ``whiten`` says what becomes of awkward rows."""
    rows, model = whiten(embeddings, components)
    shares = [float(v / model.trace) for v in model.values] if model else []
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.get(F.array(*map(F.lit, shares)).cast("array<double>"), F.col("place")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
