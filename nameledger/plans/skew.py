"""Exact grouping and joining that can be spread when a few keys hold most of the rows."""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collect_in_parts(
    df: DataFrame,
    keys: Sequence[str],
    collected: Mapping[str, Column],
    spread_on: Column,
    finish: Mapping[str, Callable[[Column], Column]] | None = None,
    key_aggs: Mapping[str, Column] | None = None,
    buckets: int = 1,
) -> DataFrame:
    """Group by ``keys`` into set-valued columns, at most ``buckets`` rows per key.

    The rule is the same for every key and any size: an item belongs to the bucket that is the hash of ``spread_on``
    modulo ``buckets``, so equal items meet in one row and nothing is left out. The buckets a key has are its
    parts 0, 1, ...; with one bucket, the default, a key is one row. ``key_aggs`` describe the whole key and are
    equal in all its parts.
    """
    finish = finish or {}
    key_aggs = key_aggs or {}
    sets = [F.collect_set(item).alias(name) for name, item in collected.items()]
    facts = [agg.alias(name) for name, agg in key_aggs.items()]
    if buckets == 1:
        out = df.groupBy(*keys).agg(F.lit(0).alias("part"), *sets, *facts)
    else:
        bucket = F.pmod(F.xxhash64(spread_on), F.lit(buckets)).cast("int")
        placed = df.withColumn("_bucket", bucket)
        # a key's parts are numbered without gaps: what it has of ``buckets`` numbers is known for the whole key
        whole = placed.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
            F.array_sort(F.collect_set("_bucket")).alias("_used"), *facts
        )
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        parted = placed.groupBy(*keys, "_bucket").agg(*sets).join(whole, same)
        out = parted.withColumn("part", (F.array_position("_used", F.col("_bucket")) - 1).cast("int"))
    return out.select(
        *keys,
        "part",
        *[finish.get(name, F.array_sort)(F.col(name)).alias(name) for name in collected],
        *key_aggs,
    )


def join_spread(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left outer join as matches and misses, so that a key which repeats on either side can be split.

    Adaptive execution splits a hot partition of an inner join on both sides and one of an anti join on the
    left; of a left outer join it could not split the right side.
    """
    on = list(on)
    matches = left.join(right, on)
    misses = left.join(right.select(*on).distinct(), on, "left_anti")
    absent = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right.columns if c not in on]
    return matches.unionByName(misses.select("*", *absent))
