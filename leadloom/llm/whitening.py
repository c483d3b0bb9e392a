"""Whitening of embeddings by a polarisation covariance: only squares are summed, cross terms are differences of variances.

Every entry c of a vector becomes the whole number x = floor(256 c). The fit list holds each different x-vector once, n of
them with sums S by dimension. For y = n x - S, which is whole and centred, tasks sum y_i^2 for every dimension and
(y_i + y_j)^2 for every pair of dimensions, exactly: y is cut into limbs of 24 bits, whose products are summed in 64-bit
integers. Then 2 n^3 cov(i, j) = sum (y_i + y_j)^2 - sum y_i^2 - sum y_j^2 holds to the last digit, and the matrix that
eigh gets is rounded once. A task sends a few thousand sums whatever it has read; the driver gets these sums by dimension
pair (their number is a square of the dimension, not of the rows). The fit list is a table in the shared checkpoint
folder while the fit lasts.

Defined results: vectors that are null or hold null, NaN or infinite entries are left out; zero vectors stay. Vectors of
each length are whitened on their own; empty ones give no rows. Repeated rows (and null ids) give repeated results, but
count once in the fit. A component without variance has explained 0 (null if there is no variance at all) and a null
whitened value. x saturates at the range of long; a deviation beyond that range is null. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE, LIMB, SLAB = 256, 24, 4096
#: Largest y that is computed as long, and the largest whose square is a long.
_LONG, _ROOT = 1 << 62, 3_037_000_499


def _matrices(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(length, rows of that length) of an array column."""
    sizes, flat = pc.list_value_length(column).to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)
    for d in np.unique(sizes):
        if d:
            rows = flat if (sizes == d).all() else flat[np.repeat(sizes == d, sizes)]
            yield int(d), rows.reshape(-1, d)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's rows, by length and dimension: number, sum, least and largest x."""
    found: dict[int, list] = {}
    for b in batches:
        for d, x in _matrices(b.column(0)):
            high, low = (x >> 32).sum(axis=0).astype(object), (x & 0xFFFFFFFF).sum(axis=0).astype(object)
            n, total, least, most = found.get(d, (0, 0, x[0], x[0]))
            found[d] = [n + len(x), total + high * (1 << 32) + low, np.minimum(least, x.min(axis=0)), np.maximum(most, x.max(axis=0))]
    for d, (n, total, least, most) in found.items():
        columns = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(map(Decimal, total.tolist()), pa.decimal128(38, 0)), pa.array(least), pa.array(most)], ["d", "i", "n", "total", "least", "most"])


class Centre:
    """Of the vectors of one length: their number, sums, and the largest |y|."""

    def __init__(self, n: int, sums: list[int], largest: int):
        self.n, self.sums, self.largest = n, sums, largest
        self.limbs = max(1, -(-(largest.bit_length() + 1) // LIMB))

    @property
    def wide(self) -> bool:
        return self.largest + max(map(abs, self.sums)) >= _LONG

    def squares(self, x: np.ndarray) -> dict[int, np.ndarray]:
        """Exponent -> matrix of whole numbers; the sum of matrix * 2^(LIMB * exponent) has sum (y_i + y_j)^2 above the
        diagonal and sum y_i^2 on it."""
        kind = object if self.wide else np.int64
        y = x.astype(kind) * self.n - np.array(self.sums, dtype=kind)
        cut = [((y >> LIMB * t) & ((1 << LIMB) - 1) if t < self.limbs - 1 else y >> LIMB * t).astype(np.int64) for t in range(self.limbs)]
        d = y.shape[1]
        out = {e: np.zeros((d, d), dtype=object) for e in range(2 * self.limbs - 1)}
        for i in range(d):
            pairs = [np.concatenate([a[:, i : i + 1], a[:, i : i + 1] + a[:, i + 1 :]], axis=1) for a in cut]
            for s in range(self.limbs):
                for t in range(s, self.limbs):
                    out[s + t][i, i:] += np.einsum("rj,rj->j", pairs[s], pairs[t]).astype(object) * (1 if s == t else 2)
        return out


def _squares(fits: dict[int, Centre]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for d, rows in _matrices(b.column(0)):
                for at in range(0, len(rows), SLAB):
                    for e, m in fits[d].squares(rows[at : at + SLAB]).items():
                        found[d, e] = found[d, e] + m if (d, e) in found else m
        for (d, e), m in found.items():
            i, j = np.triu_indices(d)
            ints = [pa.array(np.asarray(c, dtype=np.int32)) for c in (np.full(len(i), d), i, j, np.full(len(i), e))]
            yield pa.RecordBatch.from_arrays([*ints, pa.array(map(Decimal, m[i, j].tolist()), pa.decimal128(38, 0))], ["d", "i", "j", "e", "part"])

    return run


def covariance(squares: list[list[int]], n: int) -> np.ndarray:
    """The covariance with divisor n from the exact sums of squares: y_i^2 on the diagonal, (y_i + y_j)^2 above it."""
    d, v = len(squares), np.empty((len(squares), len(squares)))
    for i in range(d):
        v[i, i] = squares[i][i] / n**3
        for j in range(i + 1, d):
            v[i, j] = v[j, i] = (squares[i][j] - squares[i][i] - squares[j][j]) / (2 * n**3)
    return v


def _centres(fit: DataFrame) -> dict[int, Centre]:
    each = fit.select("x").mapInArrow(_sums, "d int, i int, n bigint, total decimal(38,0), least bigint, most bigint")
    rows = each.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))
    by: dict[int, list] = {}
    for r in rows.orderBy("d", "i").collect():
        by.setdefault(r["d"], []).append((r["n"], int(r["total"]), r["least"], r["most"]))
    return {d: Centre(x[0][0], [s for _, s, _, _ in x], max(max(abs(n * a - s), abs(n * b - s)) for n, s, a, b in x)) for d, x in by.items()}


def _sums_of_squares(fit: DataFrame, fits: dict[int, Centre]) -> dict[int, list[list[int]]]:
    each = fit.select("x").mapInArrow(_squares(fits), "d int, i int, j int, e int, part decimal(38,0)")
    out = {d: [[0] * d for _ in range(d)] for d in fits}
    for r in each.groupBy("d", "i", "j", "e").agg(F.sum("part").alias("part")).toLocalIterator():
        out[r["d"]][r["i"]][r["j"]] += int(r["part"]) << LIMB * r["e"]
    return out


def _y(x: Column, wide: bool) -> Column:
    """array of n x - S, exact."""
    if wide:
        return F.zip_with(x, "sums", lambda a, s: (a.cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")).cast("decimal(38,0)") - s)
    return F.zip_with(x, "sums", lambda a, s: a * F.col("n") - s)


def _deviation(y: Column, wide: bool) -> Column:
    short = F.transform(y, lambda a: F.when(F.abs(a) <= _ROOT, a.cast("long"))) if wide else y
    return F.aggregate(short, F.lit(0).cast("long"), lambda total, a: F.try_add(total, F.try_multiply(a, a)))


def _projected(y: Column, weights: Column) -> Column:
    return F.aggregate(F.zip_with(y, weights, lambda a, w: a.cast("double") * w), F.lit(0.0), lambda total, a: total + a)


def whiten(vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error: a row for each vector that takes
    part and each of the components with the largest eigenvalues."""
    spark = vectors.sparkSession
    v = F.col(vector_col)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.where(v.isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(id_col).alias("vec_id"), F.transform(v, lambda c: F.floor(c.cast("double") * scale)).alias("x"))
    with written(rows.select("x").distinct()) as fit:
        fits = _centres(fit)
        squares = _sums_of_squares(fit, fits)
        wide = any(c.wide for c in fits.values())
        kind = "decimal(38,0)" if wide else "bigint"
        known = []
        for d, c in fits.items():
            e, u = np.linalg.eigh(covariance(squares[d], c.n))
            order = np.argsort(-e, kind="stable")[:components]
            trace, least = e.sum(), d * np.finfo(float).eps * max(e.max(), 0.0)
            parts = [(k + 1, [float(w) / sqrt(e[o]) / c.n for w in u[:, o]] if e[o] > least else None, float(max(e[o], 0.0) / trace) if trace > 0 else None) for k, o in enumerate(order)]
            known.append((d, c.n, [Decimal(s) for s in c.sums] if wide else c.sums, parts))
        schema = f"d int, n bigint, sums array<{kind}>, parts array<struct<component:int,weights:array<double>,explained:double>>"
        constants = F.broadcast(spark.createDataFrame(known, schema))
        # the error is measured on the fit list itself
        z = fit.withColumn("d", F.size("x")).join(constants, "d").select("d", "parts", _y(F.col("x"), wide).alias("y"))
        z = z.select("d", *[_projected(F.col("y"), F.get("parts", F.lit(k))["weights"]).alias(f"z{k}") for k in range(components)])
        pairs = [(a, b) for a in range(components) for b in range(a, components)]
        off = F.greatest(*[F.abs(F.covar_pop(f"z{a}", f"z{b}") - float(a == b)) for a, b in pairs], F.lit(0.0))
        errors = {r["d"]: r["error"] for r in z.groupBy("d").agg(off.alias("error")).collect()}
    constants = spark.createDataFrame([(*k, errors[k[0]]) for k in known], schema + ", identity_error double")
    each = rows.withColumn("d", F.size("x")).join(F.broadcast(constants), "d")
    each = each.select("vec_id", "n", "identity_error", "parts", _y(F.col("x"), wide).alias("y"))
    made = F.transform("parts", lambda p: F.struct(p["component"].alias("component"), _projected(F.col("y"), p["weights"]).alias("whitened"), p["explained"].alias("explained")))
    each = each.select("vec_id", "n", _deviation(F.col("y"), wide).alias("deviation"), "identity_error", F.inline(made))
    return each.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
