"""Exact top-k search of binary codes by incremental multi-index hashing.

A code of b bits is cut into segments of about log2(n) - 4 bits, so that a bucket of a segment holds about 16 of n codes
at any size (LEAST to WIDEST bits; a code has at least one segment). In round r every open query probes, in each of its
m segments, the buckets whose value differs from its own in exactly r bits. After that round every code within distance
m (r + 1) - 1 of the query has been met, as one farther in all segments differs in r + 1 bits of each. A query closes
when its k-th verified distance is within that, so results are exact; the rounds end when no query is open, after as
many rounds as the widest segment has bits at the latest.

Codes and probes meet in Spark by (segment, shelf, chunk); a shelf is 16 neighbouring buckets. Shelves over MOST codes
are dealt into chunks, to each of which the shelf's probes go, so no task holds more than about MOST codes, and a chunk
passes on only the best of each query, and of these only such as are no farther than the worst of the k + 1 that the query
has already. Equal codes are folded to their k + 1 smallest ids. Of codes at one distance
those with the smallest least id are kept: any other is behind k + 1 rows.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part; codes meet codes of
their length only; ties go to the smaller id; a row that repeats with its id counts once; with fewer than k other rows,
all of them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut
from .vectors import first_ids, unfolded, valid

#: Bits of a word of a code, codes that a task holds, and bounds of a segment's bits.
WORD, MOST, LEAST, WIDEST = 64, 50_000, 4, 20


def sign_code(v: Column) -> Column:
    """array<long>: bit i (from the least) of word w is 1 if component 64 w + i is over zero."""
    bit = lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    word = lambda w: F.aggregate(F.transform(F.slice(v, w * WORD + 1, F.lit(WORD)), bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(v) / WORD).cast("int") - 1, F.lit(0))), word)


def segments(bits: int, n: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the segments of codes of so many bits, where there are n codes."""
    width = min(WIDEST, max(LEAST, round(math.log2(max(n, 1))) - 4), bits)
    m = -(-bits // width)
    cuts = [bits * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def segments_of(code: Column, cuts: list[tuple[int, int]]) -> Column:
    def value(first: int, width: int) -> Column:
        w, at = divmod(first, WORD)
        low = F.shiftrightunsigned(code[w], at)
        if at + width > WORD:
            low = low.bitwiseOR(F.shiftleft(code[w + 1], WORD - at))
        return low.bitwiseAND(F.lit((1 << width) - 1)).cast("int")

    return F.array(*[value(*c) for c in cuts])


def hamming_top_k(codes: DataFrame, k: int = 10, query_step: int = 100) -> DataFrame:
    """query_id, rank, vec_id, distance int: the k nearest rows by Hamming distance of every query row of codes(id, code,
    bits); code: array<long> of bits bits."""
    rows = codes.where("id is not null and code is not null").select(F.col("id").cast("long").alias("id"), "code", "bits").distinct()
    found = codes.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, distance int")
    for (bits,) in rows.select("bits").distinct().orderBy("bits").collect():
        found = found.unionByName(_of_one_length(rows.where(F.col("bits") == bits), bits, k, query_step))
    return found


def _of_one_length(rows: DataFrame, bits: int, k: int, query_step: int) -> DataFrame:
    index = cut(rows.groupBy("code").agg(F.min("id").alias("least")))
    cuts = segments(bits, index.count())
    m, widest = len(cuts), max(w for _, w in cuts)
    asking = rows.where(F.col("id") % query_step == 0).select(F.col("code").alias("own"), F.col("id").alias("query_id"))
    ids = first_ids(rows.withColumnRenamed("code", "other"), "other", k + 1)
    split = index.select("code", "least", F.posexplode(segments_of(F.col("code"), cuts))).select("code", "least", F.col("pos").alias("segment"), F.col("col").alias("value"))
    shelf = F.shiftright("value", 4).alias("shelf")
    # shelves that are dealt into several chunks: one in MOST codes a segment at most
    large = split.groupBy("segment", shelf).agg(F.ceil(F.count("*") / MOST).cast("int").alias("n")).where("n > 1")
    large = F.broadcast(cut(large))
    chunks = F.coalesce("n", F.lit(1))
    dealt = split.select("*", shelf).join(large, ["segment", "shelf"], "left").withColumn("chunk", F.pmod(F.xxhash64("code"), chunks).cast("int")).drop("n")

    def found_in(own: list, other: list, least, gap) -> pd.DataFrame:
        return pd.DataFrame({"own": pd.Series(own, dtype=object), "other": pd.Series(other, dtype=object), "least": least, "distance": gap})

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return found_in([], [], [], [])
        c = c.sort_values("value", kind="stable")
        values, least = c["value"].to_numpy(), c["least"].to_numpy()
        code, own = np.stack(c["code"].to_numpy()), np.stack(q["own"].to_numpy())
        lo, hi = (np.searchsorted(values, q["value"].to_numpy(), side) for side in ("left", "right"))
        n = hi - lo
        met = np.repeat(np.arange(len(q)), n)
        at = np.arange(len(met)) - np.repeat(np.cumsum(n) - n, n) + lo[met]
        gap = np.bitwise_count((code[at] ^ own[met]).view(np.uint64)).sum(axis=1, dtype=np.int32)
        near = gap <= q["far"].to_numpy()[met]  # a farther one can't be among the best any more
        met, at, gap = met[near], at[near], gap[near]
        _, who = np.unique(own, axis=0, return_inverse=True)
        who = who.reshape(-1)[met]
        order = np.lexsort((least[at], gap, who))
        who = who[order]
        first = np.flatnonzero(np.append(True, who[1:] != who[:-1])[: len(who)])
        place = np.arange(len(who)) - np.repeat(first, np.diff(np.append(first, len(who))))
        best = order[place <= k]
        return found_in(list(own[met[best]]), list(code[at[best]]), least[at[best]], gap[best])

    open_ = cut(asking.select("own", F.lit(bits).alias("far")).distinct())
    widths = F.array(*[F.lit(w) for _, w in cuts])
    found = None
    line = Window.partitionBy("own").orderBy("distance", "least")
    for r in range(widest + 1):
        values = open_.select("own", "far", F.posexplode(segments_of(F.col("own"), cuts)).alias("segment", "mine")).withColumn("width", widths[F.col("segment")])
        probes = values.join(F.broadcast(_masks(open_.sparkSession, {w for _, w in cuts}, r)), "width").select("own", "far", "segment", F.col("mask").bitwiseXOR(F.col("mine")).alias("value"))
        probes = probes.select("*", shelf).join(large, ["segment", "shelf"], "left").withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).drop("n")
        key = ["segment", "shelf", "chunk"]
        hits = probes.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInPandas(search, "own array<bigint>, other array<bigint>, least bigint, distance int")
        hits = (hits if found is None else hits.unionByName(found)).distinct()
        found = cut(hits.withColumn("n", F.row_number().over(line)).where(F.col("n") <= k + 1).drop("n"))
        worst = found.groupBy("own").agg(F.when(F.count("*") > k, F.max("distance")).otherwise(bits).alias("far"), (F.count("*") > k).alias("full"))
        left = open_.select("own").join(worst, "own", "left").where(~F.coalesce(F.col("full") & (F.col("far") < m * (r + 1)), F.lit(False)))
        open_ = cut(left.select("own", F.coalesce("far", F.lit(bits)).alias("far")))
        if open_.isEmpty():
            break
    return unfolded(found.drop("least"), ids, asking, "distance", k)


def _masks(spark: SparkSession, widths: set[int], r: int) -> DataFrame:
    """(width, mask): of each width the masks of r bits; two widths of WIDEST bits at most."""
    some = [spark.range(1 << w).select(F.lit(w).alias("width"), F.col("id").cast("int").alias("mask")).where(F.bit_count("mask") == r) for w in sorted(widths)]
    return reduce(DataFrame.unionByName, some)


def embedding_codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, code, bits): sign codes of the valid vectors, a bit for each component."""
    v = F.col(vec_col).cast("array<double>")
    return vectors.where(valid(v)).select(F.col(id_col).alias("id"), sign_code(v).alias("code"), F.size(v).alias("bits"))
