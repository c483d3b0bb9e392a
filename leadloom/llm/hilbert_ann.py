"""Approximate nearest neighbours by shifted space-filling curves.

Distinct vectors of one length are projected on the leading principal axes of a bounded sample; each curve turns and
shifts the projection by a rotation and an offset of its own and takes Hilbert keys. Spark range-partitions the keys of
every curve, so each vector gets its position along each curve. A query looks at the window of positions round its own
on every curve. Windows are read block by block (BLOCK positions each, whatever the table's size, by ASKED queries at a
time, so that no group grows with the table), with a byte for each component in place of the vectors; each block keeps a query's best, the blocks of all curves merge, and the best SPARE
of a query are reranked by distance, in double precision on the original vectors.

The window isn't set but measured: the true neighbours of PROBES rows are found against all rows, and the window is what
it takes for a share `target` of them to lie within it on some curve. Vectors that cluster need a few positions; vectors
that fill all their dimensions, as the given ones do, need a share of the table.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, neither as query nor
as candidate; a vector's candidates are those of its length; equal vectors are indexed once and tie by id; a row that
repeats with its id counts once; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .vectors import first_ids, unfolded, valid

#: Positions of a curve and queries that one task group holds, rows that the projection is fitted on, rows whose true
#: neighbours set the window, and candidates of a query that are reranked for each that is asked for.
BLOCK, ASKED, SAMPLE, PROBES, SPARE = 8192, 1024, 5000, 64, 4


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of cells (n x d, each of so many bits), by Skilling's transform (2004)."""
    x = np.array(cells, np.uint32).T.copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for axis in range(d):
            on = (x[axis] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(on, low, swap)
            if axis:
                x[axis] ^= swap
    for axis in range(1, d):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] & np.uint32(1 << level)) != 0, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn
    keys = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(d):
            keys = keys << 1 | (x[axis] >> np.uint32(level) & np.uint32(1)).astype(np.int64)
    return keys


class Curves:
    """The projection and the turn and shift of each curve, fitted on a bounded sample."""

    def __init__(self, sample: np.ndarray, curves: int, axes: int, seed: int):
        self.mean = sample.mean(axis=0)
        self.axes = min(axes, sample.shape[1])
        main = np.linalg.svd(sample - self.mean, full_matrices=False)[2][: self.axes]
        if len(main) < self.axes:  # fewer rows than axes
            main = np.vstack([main, np.zeros((self.axes - len(main), sample.shape[1]))])
        self.bits = max(1, min(3, 62 // self.axes))
        rng = np.random.default_rng(seed)
        turns = [np.linalg.qr(rng.normal(size=(self.axes, self.axes)))[0] for _ in range(curves)]
        self.maps = [main.T @ t for t in turns]
        self.half = max(3 * float(((sample - self.mean) @ main.T).std(axis=0).max()), 1e-12)
        self.shifts = rng.uniform(0, 0.5, size=(curves, self.axes))

    def keys(self, x: np.ndarray, curve: int) -> np.ndarray:
        place = ((x - self.mean) @ self.maps[curve] + self.half) / (4 * self.half) + self.shifts[curve]
        return hilbert_keys(np.clip((place * (1 << self.bits)).astype(np.int64), 0, (1 << self.bits) - 1), self.bits)


def nearest_by_curves(vectors: DataFrame, k: int = 10, curves: int = 16, axes: int = 16, target: float = 0.95, window_share: float | None = None, least_window: int = 256, query_step: int = 100, seed: int = 7, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose id is divisible by query_step.

    window_share: of the table, for a window that is set (least_window positions at least) instead of measured."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & valid(F.col("v")))
    found = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for (length,) in rows.select(F.size("v")).distinct().orderBy(F.size("v")).collect():
        found = found.unionByName(_of_one_length(rows.where(F.size("v") == length), k, curves, axes, (target, window_share, least_window), query_step, seed))
    return found


def along_curves(own: DataFrame, index: Curves, curves: int) -> DataFrame:
    """(curve, pos, own): the position of each of own (own, v) along each curve, from 0."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                keys = [index.keys(x, c) for c in range(curves)]
                ids = b.column(0).to_numpy(zero_copy_only=False)
                cols = [np.repeat(np.arange(curves, dtype=np.int32), len(ids)), np.concatenate(keys), np.tile(ids, curves)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["curve", "key", "own"])

    along = cut(own.select("own", "v").mapInArrow(keyed, "curve int, key bigint, own bigint").repartitionByRange("curve", "key", "own").sortWithinPartitions("curve", "key", "own"))
    # one count for each partition and curve: as many as there are partitions, whatever the rows
    counts = along.groupBy(F.spark_partition_id().alias("p"), "curve").count().collect()
    start: dict[tuple[int, int], int] = {}
    passed = [0] * curves
    for r in sorted(counts):
        start[r["p"], r["curve"]] = passed[r["curve"]]
        passed[r["curve"]] += r["count"]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            curve = b.column(0).to_numpy(zero_copy_only=False)
            at = np.empty(len(curve), np.int64)
            for c in np.unique(curve):
                mine = np.flatnonzero(curve == c)
                first = seen.get(c, start.get((p, int(c)), 0))
                at[mine] = first + np.arange(len(mine))
                seen[c] = first + len(mine)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at), b.column(2)], ["curve", "pos", "own"])

    return cut(along.mapInArrow(placed, "curve int, pos bigint, own bigint"))


def window_for(places: DataFrame, own: DataFrame, k: int, target: float) -> int:
    """Positions on either side within which a share `target` of the k nearest of PROBES rows lie on some curve."""
    probes = own.orderBy(F.xxhash64("own")).limit(PROBES).collect()
    ids, asked = np.array([r["own"] for r in probes]), np.array([r["v"] for r in probes])

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            gap = (asked**2).sum(axis=1)[:, None] - 2 * asked @ x.T + (x**2).sum(axis=1)
            best = np.argsort(gap, axis=1)[:, : k + 1]
            other = b.column(0).to_numpy(zero_copy_only=False)[best]
            cols = [np.repeat(ids, best.shape[1]), other.ravel(), np.take_along_axis(gap, best, axis=1).ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["own", "other", "gap"])

    true = first_of(own.select("own", "v").mapInArrow(nearest, "own bigint, other bigint, gap double"), k + 1, "gap").where("own <> other").select("own", "other")
    pairs = true.join(places.select("own", "curve", F.col("pos").alias("a")), "own").join(places.select(F.col("own").alias("other"), "curve", F.col("pos").alias("b")), ["other", "curve"])
    needed = pairs.groupBy("own", "other").agg(F.min(F.abs(F.col("a") - F.col("b"))).alias("w"))
    return int(needed.agg(F.percentile("w", F.lit(target))).first()[0] or 1) + 1


def _of_one_length(rows: DataFrame, k: int, curves: int, axes: int, windows: tuple[float, float | None, int], query_step: int, seed: int) -> DataFrame:
    sample = np.array([r["v"] for r in rows.orderBy(F.xxhash64("id")).limit(SAMPLE).collect()], float)
    index = Curves(sample, curves, axes, seed)
    step = max(float(np.abs(sample - index.mean).max()) / 127, 1e-300)
    mean = index.mean

    own = cut(rows.groupBy("v").agg(F.min("id").alias("own")))
    members = cut(rows.join(own, "v").select("id", "own").distinct())
    asking = members.where(F.col("id") % query_step == 0).select("own", F.col("id").alias("query_id"))
    places = along_curves(own, index, curves)
    target, share, least = windows
    window = window_for(places, own, k, target) if share is None else max(least, int(np.ceil(share * own.count())))
    most = SPARE * (k + 1)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            code = np.clip(np.rint((x - mean) / step), -127, 127).astype(np.int8)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.tobytes() for c in code], pa.binary())], ["own", "code"])

    codes = own.select("own", "v").mapInArrow(coded, "own bigint, code binary")
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    blocks = places.select("curve", block, "pos", "own").join(codes, "own")
    first, last = F.floor(F.greatest(F.col("pos") - window, F.lit(0)) / BLOCK), F.floor((F.col("pos") + window) / BLOCK)
    asked = asking.select("own").distinct().join(places.toDF("curve", "pos", "own"), "own").withColumn("block", F.explode(F.sequence(first, last)))
    # the queries of a block grow with the window and so with the table: they are dealt into parts, each with the block
    parts = asked.groupBy("curve", "block").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("parts"))
    asked = asked.join(parts, ["curve", "block"]).withColumn("part", F.pmod(F.xxhash64("own"), "parts").cast("int")).drop("parts").join(own, "own")
    blocks = blocks.join(parts, ["curve", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"own": [], "other": [], "gap": []})
        x = np.frombuffer(b"".join(c["code"]), np.int8).reshape(len(c), -1).astype(np.float32)
        v = ((np.stack(q["v"].to_numpy()) - mean) / step).astype(np.float32)
        gap = (v**2).sum(axis=1)[:, None] - 2 * v @ x.T + (x**2).sum(axis=1)
        gap[np.abs(q["pos"].to_numpy()[:, None] - c["pos"].to_numpy()) > window] = np.inf
        n = min(most, len(c))
        best = np.argpartition(gap, n - 1, axis=1)[:, :n]
        gap = np.take_along_axis(gap, best, axis=1)
        out = pd.DataFrame({"own": np.repeat(q["own"].to_numpy(), n), "other": c["own"].to_numpy()[best].ravel(), "gap": gap.ravel().astype(float)})
        return out[np.isfinite(out["gap"])]

    key = ["curve", "block", "part"]
    near = asked.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInPandas(search, "own bigint, other bigint, gap double")
    near = first_of(near.groupBy("own", "other").agg(F.min("gap").alias("gap")), most, "gap")
    # the few that are left by distance on the vectors themselves
    a, b = own.select("own", F.col("v").alias("a")), own.select(F.col("own").alias("other"), F.col("v").alias("b"))
    squares = F.aggregate(F.zip_with("a", "b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x)
    best = first_of(near.join(a, "own").join(b, "other").select("own", "other", F.sqrt(squares).alias("score")), k + 1)
    ids = first_ids(members.withColumnRenamed("own", "other"), "other", k + 1)
    return unfolded(best, ids, asking, "score", k)


def first_of(hits: DataFrame, k: int, measure: str = "score") -> DataFrame:
    """The k rows of least measure of each own."""
    from pyspark.sql import Window

    w = Window.partitionBy("own").orderBy(measure, "other")
    return hits.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).drop("n")
