"""Reads and changes of keyed tables: multi-get, scans, history, change batches, retention.

Every function takes and returns DataFrames; a result that should last is written as a new table
version. ``key`` names the key column.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nameledger.operators.lookup import lookup



def multi_get(table: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """All requested keys in the order of their ``pos``; a miss has nulls."""
    return lookup(table, keys, [key]).drop("found").orderBy("pos")


def range_scan(
    table: DataFrame, low: object = None, high: object = None, key: str = "key"
) -> DataFrame:
    """Rows with low <= key < high in key order; a bound left out is open."""
    rows = table
    if low is not None:
        rows = rows.where(F.col(key) >= F.lit(low))
    if high is not None:
        rows = rows.where(F.col(key) < F.lit(high))
    return rows.orderBy(key)


def prefix_scan(table: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    return table.where(F.col(key).startswith(prefix)).orderBy(key)


def read_as_of(history: DataFrame, ts: int, key: str = "key") -> DataFrame:
    """Newest version per key at or before ``ts``; a key whose newest version is a delete is gone.

    Versions at the same time: a delete wins, then the greatest value.
    """
    newest = F.max(F.struct("ts", "is_delete", "value")).alias("_newest")
    seen = history.where(F.col("ts") <= ts).groupBy(key).agg(newest)
    live = seen.where(~F.col("_newest.is_delete"))
    return live.select(key, "_newest.ts", "_newest.value")


def multi_get_as_of(history: DataFrame, keys: DataFrame, ts: int, key: str = "key") -> DataFrame:
    """``multi_get`` on the table as it stood at ``ts``."""
    wanted = history.join(keys.select(key).distinct(), key, "left_semi")
    return multi_get(read_as_of(wanted, ts, key), keys, key)


def history_between(history: DataFrame, t0: int, t1: int, key: str = "key") -> DataFrame:
    """Every version in [t0, t1], deletes included: by key, newest first."""
    return history.where(F.col("ts").between(t0, t1)).orderBy(key, F.desc("ts"))


def delete_keys(table: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    return table.join(keys.select(key).distinct(), key, "left_anti")


def delete_range(table: DataFrame, low: object, high: object, key: str = "key") -> DataFrame:
    """The table without the keys in [low, high)."""
    inside = (F.col(key) >= F.lit(low)) & (F.col(key) < F.lit(high))
    return table.where(~F.coalesce(inside, F.lit(False)))


def apply_changes(
    table: DataFrame, ops: DataFrame, key: str = "key", seq: str = "seq"
) -> DataFrame:
    """(key, value) after an ordered batch of puts and deletes; the last one per key wins.

    ``ops`` has key, value, ``is_delete`` and the order column. One shuffle: the table's own rows
    take part as the earliest puts.
    """
    held = table.select(
        key, F.lit(None).cast("bigint").alias(seq), F.lit(False).alias("is_delete"), "value"
    )
    changes = ops.select(key, F.col(seq).cast("bigint").alias(seq), "is_delete", "value")
    last = F.max(F.struct(seq, "is_delete", "value")).alias("_last")
    merged = held.unionByName(changes).groupBy(key).agg(last)
    return merged.where(~F.col("_last.is_delete")).select(key, "_last.value")


_NUMERIC_MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


def merge_by_key(
    table: DataFrame, ops: DataFrame, how: str = "sum", key: str = "key", value: str = "value"
) -> DataFrame:
    """Base values merged with all operands of their key by an order-free rule."""
    both = table.select(key, value).unionByName(ops.select(key, value))
    return both.groupBy(key).agg(_NUMERIC_MERGES[how](value).alias(value))


def append_by_key(
    table: DataFrame,
    ops: DataFrame,
    key: str = "key",
    seq: str = "seq",
    separator: str = "",
    runs: int = 1,
) -> DataFrame:
    """Text operands joined onto the base text in the order of ``seq``: (key, part, value).

    With one run, the default, a key is one row. Otherwise every key's order is cut at its own quantiles of ``seq``
    into up to ``runs`` runs of about equally many operands, one row each; the parts joined in order are the
    whole text. The base text belongs to the first.
    """
    held = table.select(key, F.lit(None).cast("bigint").alias(seq), "value")
    every = held.unionByName(ops.select(key, F.col(seq).cast("bigint").alias(seq), "value"))
    if runs == 1:
        placed = every.withColumn("part", F.lit(0))
    else:
        shares = [i / runs for i in range(1, runs)]
        cuts = ops.groupBy(key).agg(F.percentile_approx(seq, shares, 100 * runs).alias("_cuts"))
        below = F.size(F.filter(F.array_distinct("_cuts"), lambda cut: cut < F.col(seq)))
        placed = every.join(cuts, key, "left").withColumn("part", F.coalesce(F.nullif(below, F.lit(-1)), F.lit(0)))
        placed = placed.withColumn("part", F.when(F.col(seq).isNull(), 0).otherwise(F.col("part")))
    in_order = F.array_sort(F.collect_list(F.struct(F.coalesce(seq, F.lit(-(2**63))).alias("seq"), "value")))
    texts = F.transform(in_order, lambda o: o["value"])
    return placed.groupBy(key, "part").agg(F.array_join(texts, separator).alias("value"))


def retain(
    table: DataFrame, keep: Column | None = None, rewrite: dict[str, Column] | None = None
) -> DataFrame:
    """A rewrite pass: rows that fail ``keep`` go (null fails), and columns get new values."""
    rows = table if keep is None else table.where(keep)
    return rows.withColumns(rewrite) if rewrite else rows


def expire(table: DataFrame, now: int, ttl: int, seen: str = "last_seen") -> DataFrame:
    """Rows seen within ``ttl`` before ``now``; rows whose time is unknown (0) stay."""
    return table.where((F.col(seen) == 0) | (F.col(seen) > now - ttl))


def changes_since(
    old: DataFrame, new: DataFrame, keys: Sequence[str] = ("key",),
    values: Sequence[str] = ("value",),
) -> DataFrame:
    """Keys that differ between two versions, with ``op`` and the new values (null on delete)."""
    before = old.select(*keys, F.struct(*values).alias("_old"))
    after = new.select(*keys, F.struct(*values).alias("_new"))
    both = before.join(after, list(keys), "full")
    op = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    changed = both.withColumn("op", op).where(F.col("op").isNotNull())
    return changed.select(*keys, "op", *[F.col(f"_new.{v}").alias(v) for v in values])
