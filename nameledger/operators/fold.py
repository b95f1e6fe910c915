"""Folding events into keyed first-seen / last-seen state.

The fold is a min and a max per key: associative, commutative and idempotent, so any batch split,
order or replay gives the same state, and partial aggregation keeps popular keys from piling up.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nameledger.functions.domains import DEFAULT_SHARDS, shard_id

STATE_KEY = ["domain", "type", "value"]
SHARD_COUNT = "n_shards"  # metadata of a stored table's shard_id column


def _range_aggs(zero_is_missing: bool) -> list[Column]:
    first, last = F.col("first_seen"), F.col("last_seen")
    if not zero_is_missing:
        return [F.min(first).alias("first_seen"), F.max(last).alias("last_seen")]
    zero = F.lit(0).cast("bigint")
    return [
        F.coalesce(F.min(F.nullif(first, zero)), zero).alias("first_seen"),
        F.coalesce(F.max(F.nullif(last, zero)), zero).alias("last_seen"),
    ]


def fold_events(events: DataFrame, zero_is_missing: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """One row per (domain, type, value) with the widest time range seen.

    ``by`` names columns that follow from the key and are kept, so that filters on them reach the scan.

    Time 0 counts as unknown; with ``zero_is_missing=False`` it is an ordinary, earliest time.
    """
    return events.groupBy(*by, *STATE_KEY).agg(*_range_aggs(zero_is_missing))


def merge_state(state: DataFrame, batch: DataFrame, zero_is_missing: bool = True) -> DataFrame:
    """State after folding a batch of events (or of other state rows) into it, in one shuffle."""
    columns = [*STATE_KEY, "first_seen", "last_seen"]
    return fold_events(
        state.select(*columns).unionByName(batch.select(*columns)), zero_is_missing
    )


def with_shard(df: DataFrame, n_shards: int = DEFAULT_SHARDS, domain: str = "domain") -> DataFrame:
    return df.withColumn("shard_id", shard_id(domain, n_shards))


def shard_distribution(events: DataFrame, n_shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Number of distinct state keys per shard in a batch."""
    keys = events.select(*STATE_KEY).distinct()
    return (
        with_shard(keys, n_shards)
        .groupBy("shard_id")
        .agg(F.count(F.lit(1)).alias("distinct_keys"))
    )
