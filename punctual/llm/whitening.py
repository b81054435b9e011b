"""Whitening of embeddings by their principal components.

Entries become integers, ``floor(scale * c) + shift``. The fit list holds every
distinct vector once. Spark reduces it to three things as wide as a vector, each
one pass of partial sums per task: exact sums per dimension, the covariance of
the centred vectors, and in the end the covariance of the whitened ones. The
eigenpairs of the covariance come from contour integration (``contour``), whose
inertia counts prove that no component is missed. That matrix is as wide as a
vector whatever the number of rows; with the mean it is all that reaches the
driver and all that is sent to tasks.

Edge cases: rows whose vector is NULL, empty or has a NULL, non-finite or not
representable entry (``floor(scale * c)`` beyond 62 bits) take no part; neither
do vectors of another width than the most frequent one (the wider one on a tie);
rows without id or with one id get their components each; repeated vectors count
once in the fit. Components whose variance is below ``1e-10`` of the largest are
rounding and left out, so a single distinct vector gives no rows, as does an
empty table. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import give_back, stored
from punctual.llm.contour import largest

#: Components with less than this share of the largest variance are rounding.
NO_VARIANCE = 1e-10
_WHOLE = float(2**62)


@dataclass(frozen=True)
class Fit:
    """What whitening needs: ``n`` distinct vectors with sums ``sums``, their
    components (columns), variances and total variance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact: 64-bit where that fits, else Python's integers."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if most < 2**63 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of the squares of ``n * x - sums``, exact."""
        d = self.centred(x)
        most = int(np.abs(d).max(initial=0))
        d = d if d.shape[1] * most**2 < 2**63 else d.astype(object)
        return [int(v) for v in (d * d).sum(axis=1)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        y = self.centred(x).astype(np.float64) / self.n
        return y @ self.components / np.sqrt(self.variances)


# ---- vectors -----------------------------------------------------------------------


def whole_vectors(
    rows: DataFrame, vector: str = "embedding", scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """``vec_id, x``: usable vectors as integers, of the most frequent width."""
    lifted = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * scale))
    usable = F.forall(
        F.col(vector),
        # NULL and NaN are caught first, infinities by the bound
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < _WHOLE),
    )
    kept = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(usable)
    width = (
        kept.groupBy(F.size(vector).alias("width"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.desc("width"))
        .first()
    )
    whole = F.transform(lifted, lambda c: c.cast("long") + F.lit(shift).cast("long"))
    return kept.where(F.size(vector) == (width.width if width else -1)).select(
        "vec_id", whole.alias("x")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[np.ndarray]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield _matrix(batch.column("x").slice(start, rows))


# ---- sums over the fit list ----------------------------------------------------------


def dimension_sums(vectors: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Number of vectors and exact sums per dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for x in _blocks(batches):
            # Python's integers across blocks: a block's sums may be near 64 bits
            part = x.astype(object).sum(axis=0) if np.abs(x).max() >= 2**50 else x.sum(axis=0)
            total = part.astype(object) if total is None else total + part
            n += len(x)
        if n:
            values = [str(v) for v in total]
            dims = np.arange(len(values), dtype=np.int32)
            yield pa.RecordBatch.from_pydict({"dim": dims, "n": [n] * len(values), "s": values})
        give_back()

    parts = vectors.select("x").mapInArrow(add, "dim int, n long, s string")
    rows = (
        parts.groupBy("dim")
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        .orderBy("dim")
        .collect()  # one row per dimension
    )
    return (rows[0].n if rows else 0), tuple(int(r.s) for r in rows)


def mean_products(vectors: DataFrame, width: int, n: int, centred) -> np.ndarray:
    """Mean of the outer products of ``centred(x)``: a covariance for centred
    rows. Tasks send one row per matrix row, which add up elementwise."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((width, width)), False
        for x in _blocks(batches):
            y = centred(x)
            total += y.T @ y
            seen = True
        if seen:
            at = np.arange(width * width)
            yield pa.RecordBatch.from_pydict(
                {
                    "i": (at // width).astype(np.int32),
                    "j": (at % width).astype(np.int32),
                    "v": total.ravel(),
                }
            )
        give_back()

    parts = vectors.select("x").mapInArrow(multiply, "i int, j int, v double")
    out = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # width squared rows
        out[r.i, r.j] = r.v / n
    return (out + out.T) / 2


def fitted(vectors: DataFrame, most: int = 16) -> tuple[Fit, float]:
    """The fit over distinct vectors, and the largest absolute entry of the
    whitened fit list's covariance minus the identity."""
    distinct = stored(vectors.select("x").distinct(), "whitening-fit")
    n, sums = dimension_sums(distinct)
    width = len(sums)
    blank = Fit(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    if not n:
        return blank, 0.0
    covariance = mean_products(
        distinct, width, n, lambda x: blank.centred(x).astype(np.float64) / n
    )
    total = float(np.trace(covariance))
    # the largest variance is known only then: at first any share that may be enough
    values, components = largest(covariance, min(most, width), NO_VARIANCE * total / width)
    real = values > NO_VARIANCE * values[:1].sum()
    fit = Fit(n, sums, components[:, real], values[real], total)
    k = len(fit.variances)
    if not k:
        return fit, 0.0
    check = mean_products(distinct, k, n, fit.whitened)
    return fit, float(np.abs(check - np.eye(k)).max())


def whitened_rows(vectors: DataFrame, fit: Fit, error: float) -> DataFrame:
    """One row per vector and component. ``deviation`` is NULL where it exceeds
    64 bits."""
    k = len(fit.variances)
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows if k else 0, 1024):
                part = batch.slice(start, 1024)
                x = _matrix(part.column("x"))
                rows = len(x)
                exact = [v if v < 2**63 else None for v in fit.deviations(x)]
                each = pa.array(np.repeat(np.arange(rows), k))
                numbers = np.tile(np.arange(1, k + 1, dtype=np.int32), rows)
                share = np.tile(fit.variances / fit.total, rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(each),
                        pa.array(numbers),
                        pa.array(np.full(rows * k, fit.n, np.int64)),
                        pa.array(exact, pa.int64()).take(each),
                        pa.array(fit.whitened(x).ravel()),
                        pa.array(share),
                        pa.array(np.full(rows * k, error)),
                    ],
                    names=[c.split()[0] for c in schema.split(", ")],
                )

    return vectors.mapInArrow(project, schema)


def whitened(rows: DataFrame, most: int = 16, **knobs) -> DataFrame:
    """Every usable row's whitened components, up to ``most``."""
    vectors = whole_vectors(rows, **knobs)
    fit, error = fitted(vectors, most)
    return whitened_rows(vectors, fit, error)
