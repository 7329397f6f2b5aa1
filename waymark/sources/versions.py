"""Versions of a table that can be compared without reading what is equal.

A version is written by bucket of its key, with one digest row per bucket beside it. Two
versions are compared by their digests first; rows are read, from the buckets' own folders,
and joined only where digests differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
_BUCKET = "__bucket"


def _hash(columns: Sequence[str]) -> Column:
    """64 bits that tell rows apart; a null is told from a missing neighbour by its place."""
    return F.xxhash64(*[c for name in columns for c in (F.lit(name), F.col(name).isNull(), F.col(name))])


def write_version(df: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write ``df`` under ``path`` as rows by bucket and their digests (rows, and sums of two hashes).

    ``keys`` identify a row. Rows are rebalanced by bucket, so a large bucket is several files.
    """
    spark = df.sparkSession
    parted = df.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    parted.hint("rebalance", F.col(_BUCKET)).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/rows")
    names = sorted(df.columns)
    written = spark.read.schema(parted.schema).parquet(f"{path}/rows")
    # Sums do not depend on the order of rows and see rows that repeat.
    sums = [F.sum(h.cast("decimal(20,0)")).alias(n) for n, h in (("one", _hash(names)), ("two", _hash(names[::-1])))]
    digests = written.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), *sums)
    digests.coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")


def read_version(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop(_BUCKET)


def differing_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """Buckets whose rows are not the same in both versions; there are no more than buckets."""
    a, b = (spark.read.parquet(f"{path}/digests") for path in (old, new))
    b = b.select(F.col(_BUCKET).alias("bucket"), *[F.col(c).alias(f"{c}2") for c in ("n", "one", "two")])
    same = F.lit(True)
    for c in ("n", "one", "two"):
        same = same & F.col(c).eqNullSafe(F.col(f"{c}2"))
    differ = a.join(b, F.col(_BUCKET) == F.col("bucket"), "full").filter(~same)
    return sorted(r[0] for r in differ.select(F.coalesce(_BUCKET, "bucket")).collect())


def changes(spark: SparkSession, old: str, new: str, keys: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed between two written versions, and the changed columns.

    ``change`` is one of these words and ``changed_columns`` lists names in their order, for
    changed rows only. A column that one version lacks is null there. Versions must have
    been written with the same number of buckets; keys must be unique in each.
    """
    buckets = differing_buckets(spark, old, new)
    sides = [spark.read.parquet(f"{path}/rows") for path in (old, new)]
    # Named buckets are the only folders that are read.
    a, b = (side.filter(F.col(_BUCKET).isin(buckets) if buckets else F.lit(False)).drop(_BUCKET) for side in sides)
    payload = [c for c in dict.fromkeys([*a.columns, *b.columns]) if c not in keys]
    names = [*keys, *payload]
    a, b = (side.select(*[F.col(c) if c in side.columns else F.lit(None).alias(c) for c in names]) for side in (a, b))
    a = a.select(*[F.col(c).alias(f"__a{i}") for i, c in enumerate(names)], F.lit(True).alias("__old"))
    b = b.select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate(names)], F.lit(True).alias("__new"))
    on = F.lit(True)
    for i in range(len(keys)):
        on = on & F.col(f"__a{i}").eqNullSafe(F.col(f"__b{i}"))
    differs = [
        F.when(~F.col(f"__a{i}").eqNullSafe(F.col(f"__b{i}")), F.lit(c)) for i, c in enumerate(names) if c not in keys
    ]
    changed = F.array_compact(F.array(*differs)) if differs else F.array().cast("array<string>")
    both = F.col("__old") & F.col("__new")
    joined = a.join(b, on, "full").withColumn("changed_columns", F.when(both, changed))
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").otherwise("changed")
    kept = joined.filter(F.col("__old").isNull() | F.col("__new").isNull() | (F.size("changed_columns") > 0))
    return kept.select(
        *[
            F.when(F.col("__old"), F.col(f"__a{i}")).otherwise(F.col(f"__b{i}")).alias(c) for i, c in enumerate(keys)
        ],
        change.alias("change"),
        "changed_columns",
    )
