"""Idempotent table writes: merges on natural keys, versions, exports. Merges return the new snapshot; a caller writes it
to a new path, or lets merge_snapshot replace the buckets that change."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.components import cut


def _joined(base: DataFrame, delta: DataFrame, keys: list[str], how: str) -> tuple[DataFrame, Column]:
    cols = [c for c in delta.columns if c not in keys]
    d = delta.select(*keys, *(F.col(c).alias(f"__{c}") for c in cols), F.lit(True).alias("__hit"))
    return base.join(d, keys, how), F.coalesce("__hit", F.lit(False))


def last_values(delta: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row a key: of each column its last non-null value by seq."""
    cols = [c for c in delta.columns if c not in (*keys, seq)]
    return delta.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in cols])


def upsert_coalesce(base: DataFrame, delta: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """Inserts or updates; only non-null values of delta overwrite. A delta of keys alone changes nothing."""
    cols = [c for c in delta.columns if c not in (*keys, seq)]
    if not cols:
        return base
    one = last_values(delta, keys, seq) if seq else delta
    both, _ = _joined(base, one, keys, "full_outer")
    return both.select(*keys, *[F.coalesce(f"__{c}", c).alias(c) if c in cols else F.col(c) for c in base.columns if c not in keys])


def insert_ignore(base: DataFrame, delta: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The first write of a key stays."""
    first = delta.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(seq))).where("__n = 1")
    return base.unionByName(first.select(*base.columns).join(base.select(*keys), keys, "left_anti").select(*base.columns))


def overwrite_flags(base: DataFrame, delta: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Columns of which 0 and null mean something: delta's values replace base's where the key is in delta."""
    both, hit = _joined(base, delta.select(*keys, *cols), keys, "left")
    return both.select(*[F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in base.columns])


def numbered(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Adds name: the rank (from 1) of each row among those of its key. A key of any size is spread over tasks: rows are
    range-partitioned by key and order, a partition ranks its own, and the counts of its key before it (a row a key and
    partition) are added."""
    placed = cut(rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("__p", F.spark_partition_id()))
    counts = placed.groupBy(key, "__p").agg(F.count("*").alias("__c"))
    # keys that are in one partition need no offset; of the others each begins or ends one, so they are few
    before = F.sum("__c").over(Window.partitionBy(key).orderBy("__p")) - F.col("__c")
    offsets = counts.withColumn("__before", before).where("__before > 0").drop("__c")
    own = F.row_number().over(Window.partitionBy(key, "__p").orderBy(*order))
    ranked = placed.withColumn(name, own).join(offsets, [key, "__p"], "left")
    return ranked.withColumn(name, (F.col(name) + F.coalesce("__before", F.lit(0))).cast("int")).drop("__p", "__before")


def append_versions(captures: DataFrame, new: DataFrame, seq: str = "seq") -> DataFrame:
    """(key, sha, version, content): content equal to any version of its key changes nothing; other content gets the
    next versions in the order of seq (of equal ones, of the hash). Null content is no capture.

    Versions are numbered by hashes alone; the content is shuffled once, to its number, and only if it is new."""
    hashed = new.where("content is not null").withColumn("sha", F.sha2(F.col("content").cast("binary"), 256))
    first = hashed.groupBy("key", "sha").agg(F.min(seq).alias("__seq")).join(captures.select("key", "sha"), ["key", "sha"], "left_anti")
    last = captures.groupBy("key").agg(F.max("version").alias("__last"))
    rows = numbered(first, "key", ["__seq", "sha"], "__n").join(last, "key", "left")
    rows = rows.select("key", "sha", "__seq", (F.coalesce("__last", F.lit(0)) + F.col("__n")).cast("int").alias("version"))
    fresh = hashed.select("key", "sha", F.col(seq).alias("__seq"), "content").join(rows, ["key", "sha", "__seq"]).dropDuplicates(["key", "sha"])
    return captures.select("key", "sha", "version", "content").unionByName(fresh.select("key", "sha", "version", "content"))


# --- snapshots in buckets, so that a small change rewrites little ---


def _bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def write_snapshot(table: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Writes a table as a snapshot whose rows lie in folders by a hash of their keys."""
    _bucketed(table, keys, buckets).repartition("bucket").write.partitionBy("bucket").parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def merge_snapshot(path: str, delta: DataFrame, keys: list[str], buckets: int, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Replaces the buckets of a snapshot in which delta has keys by merge(their rows, delta), such as an upsert, an
    insert that ignores what is there, flags or versions; returns these buckets. Other buckets aren't read or written.

    keys and buckets are those of write_snapshot, and merge has to keep rows within their keys. What replaces is made
    whole (in the checkpoint folder) before the first bucket goes. If the job is lost while buckets are replaced, the same
    call again ends it, as merges are idempotent. The driver gets the numbers of buckets only."""
    spark, rows = delta.sparkSession, _bucketed(delta, keys, buckets)
    touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())
    if not touched:
        return []
    base = spark.read.parquet(path).where(F.col("bucket").isin(*touched)).drop("bucket")
    merged = cut(_bucketed(merge(base, delta), keys, buckets))
    merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return touched


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header and a byte-order mark-free UTF-8; one file only if asked for."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_contact_sheet(sheet: DataFrame, path: str, single_file: bool = False) -> None:
    """The sheet as CSV; a byte-order mark before the first column's name lets spreadsheets read it as UTF-8."""
    first, *rest = sheet.columns
    write_csv(sheet.select(F.col(first).alias("﻿" + first), *rest), path, single_file)


def write_ranked_list(ranked: DataFrame, path: str, single_file: bool = False) -> None:
    """The list as CSV; in one file only if asked for (a list is as long as top_by_score makes it)."""
    write_csv(ranked, path, single_file)


def observed(rows: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """rows, counted while they are written: after the write, Observation.get holds n and each of the counts."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in counts.items()]), seen


def write_payloads(payloads: DataFrame, path: str) -> None:
    """One JSON object a venue."""
    payloads.write.mode("overwrite").json(path)


def audit_export(screened: DataFrame, path: str) -> None:
    """Rejected and suspect names with their reasons, written before anything changes."""
    rows = screened.where((F.size("hard") > 0) | F.col("soft").isNotNull())
    write_csv(rows.select("venue_id", "contact_name", "email", F.concat_ws("; ", "hard", "soft").alias("reasons")), path)


def append_run_log(counts: DataFrame, path: str) -> None:
    """counts: one row a run, as of Observation.get of what was written."""
    counts.withColumn("at", F.current_timestamp()).write.mode("append").parquet(path)


def append_failures(failures: DataFrame, path: str) -> None:
    """Errors are cut to 1000 characters."""
    failures.withColumns({"error": F.substring("error", 1, 1000), "at": F.current_timestamp()}).write.mode("append").parquet(path)
