"""Operator 11: whitening of embeddings by a weighted covariance over distinct vectors.

A vector's entries c become the integers floor(SCALE * c) + SHIFT. Rows of equal integer
vectors share one entry of the fit list, whose weight is one or the number of its rows.

* Grouping: a row keeps its id and two 64-bit hashes of its vector; a distinct vector is
  written once, with its count. The hashes are 128 bits of key, so unequal vectors do not meet.
* Fit: sums are exact integers. The covariance is a sum of matrix products of centred
  vectors, one per batch in numpy (vectors are centred at the integer part of the mean first,
  so that no digits are lost); per task the products are added up, and their entries are
  summed by Spark. Only the matrix, ``dimensions`` squared numbers, comes to the driver,
  whose eigenvectors are then part of the tasks. Dimensions are bounded by ``MAX_DIMENSIONS``;
  the number of vectors is not.
* Whitening: every distinct vector once; the result is joined back to the rows by key. The
  covariance of what was written is taken anew and gives the identity error.

Defined results: rows whose vector is null, or holds a null, a non-finite or an unrepresentable
entry (beyond a long), are dropped, as are empty vectors. All others must have one length; a
table of several lengths stops the job. Components whose eigenvalue is not above ``RANK``
times the largest have no direction to scale: ``whitened`` is null for them, and they are no
part of the identity error, which is null where there is no component left; ``explained`` is
null where all vectors are equal. A null vec_id is kept. ``deviation`` is null where it exceeds
a long. Repeated rows are whitened alike; an empty table gives an empty result; other columns
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm.base import materialize, table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
MAX_DIMENSIONS = 2048
RANK = 1e-12
VECTORS_AT_ONCE = 4096
LONG = float(1 << 62)


def integer_vector(vector: Column) -> Column:
    """The vector in integers; null where it cannot be used."""
    doubles = F.transform(vector, lambda c: c.cast("double"))
    usable = (F.size(vector) > 0) & F.forall(doubles, lambda c: F.coalesce(F.abs(c) < LONG / SCALE, F.lit(False)))
    return F.when(usable, F.transform(doubles, lambda c: F.floor(c * SCALE) + SHIFT))


def _keyed(rows: DataFrame, vector: str, row_id: str) -> DataFrame:
    """(vec_id, k1, k2, x) of the usable rows."""
    plain = rows.select(F.col(f"`{row_id}`").alias("vec_id"), integer_vector(F.col(f"`{vector}`")).alias("x")).where("x is not null")
    return plain.select("vec_id", F.xxhash64(F.lit(1), "x").alias("k1"), F.xxhash64(F.lit(2), "x").alias("k2"), "x")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, VECTORS_AT_ONCE):
            yield batch.slice(start, VECTORS_AT_ONCE)


def _product_batches(batches: Iterator[pa.RecordBatch], whole: np.ndarray, rest: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Input (v, weight): the weighted product of the centred vectors, a row per line of the matrix."""
    product = np.zeros((len(whole), len(whole)))
    for part in _parts(batches):
        centred = _matrix(part.column(0), whole.dtype.type) - whole - rest
        product += (centred * part.column(1).to_numpy(zero_copy_only=False)[:, None]).T @ centred
    lines = pa.FixedSizeListArray.from_arrays(pa.array(product.ravel()), len(whole)).cast(pa.list_(pa.float64()))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(whole))), lines], names=["i", "line"])


def weighted_covariance(vectors: DataFrame, total: int, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Covariance of ``vectors`` (v, weight) about ``whole + rest``, divisor ``total``."""
    products = vectors.select("v", F.col("weight").cast("double")).mapInArrow(partial(_product_batches, whole=whole, rest=rest), "i long, line array<double>")
    cells = products.select("i", F.posexplode("line").alias("j", "p")).groupBy("i", "j").agg(F.sum("p").alias("p"))
    out = np.zeros((len(whole), len(whole)))
    found = cells.toArrow()  # the matrix, whatever the number of vectors
    i, j, p = (found.column(c).to_numpy() for c in ("i", "j", "p"))
    out[i, j] = p / total
    return out


def _sum_batches(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    """Input (x, weight): the exact weighted sum of each dimension, as text."""
    sums = [0] * dimensions
    for part in _parts(batches):
        x, weight = _matrix(part.column(0), np.int64), part.column(1).to_numpy(zero_copy_only=False)
        if float(np.abs(x).max(initial=0)) * float(weight.max(initial=0)) * len(x) >= LONG:
            x, weight = x.astype(object), weight.astype(object)
        sums = [s + int(e) for s, e in zip(sums, (x * weight[:, None]).sum(axis=0), strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(range(dimensions), pa.int32()), pa.array(map(str, sums), pa.string())], names=["i", "s"])


@dataclass
class Fit:
    """The integer sums of the fit list and its leading components."""

    total: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # one unit eigenvector per column
    trace: float

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.total for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.total / self.total for s in self.sums])

    @property
    def usable(self) -> np.ndarray:
        return self.values > max(self.values[0], 0.0) * RANK if len(self.values) else np.empty(0, bool)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The components of the distinct vectors ``(x, weight)``; None where there is none."""
    shape = distinct.agg(F.sum("weight"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if shape[0] is None:
        return None
    if shape[1] != shape[2] or shape[2] > MAX_DIMENSIONS:
        raise ValueError(f"vectors of {shape[1]} to {shape[2]} entries; one length of at most {MAX_DIMENSIONS} is needed")
    parts = distinct.select("x", "weight").mapInArrow(partial(_sum_batches, dimensions=shape[2]), "i int, s string")
    sums = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    by_place = {row.i: int(row.s) for row in sums.collect()}  # one row per dimension
    found = Fit(int(shape[0]), [by_place[i] for i in range(shape[2])], np.empty(0), np.empty((0, 0)), 0.0)
    covariance = weighted_covariance(distinct.select(F.col("x").alias("v"), "weight"), found.total, found.whole, found.rest)
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    found.values, found.vectors, found.trace = values[order], vectors[:, order], float(np.trace(covariance))
    return found


def _deviations(x: np.ndarray, fitted: Fit) -> list[int | None]:
    """Per vector the sum of (n x - S)^2, exactly."""
    shifted = x - fitted.whole  # n x - S = n (x - whole) - (S mod n)
    rests = [s % fitted.total for s in fitted.sums]
    largest = (float(np.abs(shifted).max(initial=0)) + 1) * fitted.total
    if largest * largest * max(1, x.shape[1]) < LONG:
        return ((shifted * fitted.total - np.array(rests, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((e * fitted.total - r) ** 2 for e, r in zip(row, rests, strict=True)) for row in shifted.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


def _whiten_batches(batches: Iterator[pa.RecordBatch], fitted: Fit) -> Iterator[pa.RecordBatch]:
    """Input (k1, k2, x, weight)."""
    scale = np.sqrt(np.where(fitted.usable, fitted.values, 1.0))
    for part in _parts(batches):
        x = _matrix(part.column(2), np.int64)
        white = (((x - fitted.whole) - fitted.rest) @ fitted.vectors) / scale
        flat = pa.array(white.ravel(), mask=np.tile(~fitted.usable, len(x)))
        lists = pa.FixedSizeListArray.from_arrays(flat, white.shape[1]).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array(_deviations(x, fitted), pa.int64()), lists], names=["k1", "k2", "weight", "deviation", "white"])


def _identity_error(white: DataFrame, fitted: Fit) -> float | None:
    """The largest entry by which the covariance of the whitened fit list differs from the identity."""
    used = np.flatnonzero(fitted.usable)
    if not len(used):
        return None
    kept = white.select(F.array(*[F.col("white")[int(i)] for i in used]).alias("v"), "weight")
    means = kept.agg(*[F.sum(F.col("v")[i] * F.col("weight")) / fitted.total for i in range(len(used))]).first()
    spread = weighted_covariance(kept, fitted.total, np.array(means, float), np.zeros(len(used)))
    return float(np.abs(spread - np.eye(len(used))).max())


RESULT = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double, weight long"


def whiten(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id", components: int = COMPONENTS, by_count: bool = False) -> DataFrame:
    """A row per usable row and component: (vec_id, component, n, deviation, whitened, explained, identity_error, weight).

    ``by_count`` weighs a distinct vector by its rows in the fit, else by one; ``weight`` is that weight.
    """
    keyed = _keyed(rows, vector, row_id)
    places = materialize(keyed.select("vec_id", "k1", "k2"), "vector-keys")
    weight = (F.count(F.lit(1)) if by_count else F.max(F.lit(1))).cast("long").alias("weight")
    distinct = materialize(keyed.groupBy("k1", "k2").agg(F.first("x").alias("x"), weight), "distinct-vectors")
    fitted = fit(distinct, components)
    if fitted is None:
        kind = keyed.schema["vec_id"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], RESULT.format(kind))
    white = distinct.select("k1", "k2", "x", "weight").mapInArrow(partial(_whiten_batches, fitted=fitted), "k1 long, k2 long, weight long, deviation long, white array<double>")
    white = materialize(white, "white-vectors")
    error = _identity_error(white, fitted)
    shares = F.array(*[F.lit(float(v / fitted.trace) if fitted.trace > 0 else None).cast("double") for v in fitted.values])
    joined = places.join(white, ["k1", "k2"]).select("vec_id", "deviation", "weight", F.posexplode("white").alias("place", "whitened"))
    return joined.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(fitted.total).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(error).cast("double").alias("identity_error"), "weight",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
