"""What the two vector searches share: valid vectors, copies folded, queries unfolded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid(v: Column) -> Column:
    """Not null, not zero, every component given and finite."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def first_ids(rows: DataFrame, key: str, k: int) -> DataFrame:
    """(key, id): at most the k smallest ids of each key; the limit applies before the shuffle as well."""
    w = Window.partitionBy(key).orderBy("id")
    return rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).select(key, "id")


def unfolded(found: DataFrame, ids: DataFrame, queries: DataFrame, measure: str, k: int) -> DataFrame:
    """query_id, rank, vec_id and the measure: the k best rows of each query.

    found: (own, other, measure), the best other keys of each key; ids: (other, id); queries: (own, query_id)."""
    w = Window.partitionBy("query_id").orderBy(measure, "vec_id")
    pairs = queries.join(found, "own").join(ids, "other").where("id <> query_id")
    best = pairs.select("query_id", F.col("id").alias("vec_id"), measure).withColumn("rank", F.row_number().over(w))
    return best.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", measure)
