"""Merging ordered operands into keyed values by the caller's own associative function.

Operands of a key are cut into runs in their order. A run is reduced in the task that holds it, the runs of a task are
reduced to one, and what tasks have of a key is combined in order and laid on the base value. Keys with more than a
task's share of the operands are cut at their own quantiles, so that several tasks reduce them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

#: Operands reduced at a time.
RUN = 4096


@dataclass(frozen=True)
class Merge:
    """``combine`` makes one operand of two that follow each other; ``apply`` lays an operand on the base value, null if there is none.

    ``combine`` has to be associative and to keep the operands' type; order is kept, so it need not be commutative.
    """

    combine: Callable[[Column, Column], Column]
    apply: Callable[[Column, Column], Column]


def _patched(base: Column, patch: Column) -> Column:
    old = F.filter(F.map_entries(base), lambda e: ~F.map_contains_key(patch, e["key"]))
    return F.map_from_entries(F.concat(old, F.map_entries(patch)))


def _apply_patch(base: Column, patch: Column) -> Column:
    whole = F.when(base.isNull(), patch).otherwise(_patched(base, patch))
    return F.map_filter(whole, lambda _, v: v.isNotNull())


#: Numbers added to a counter, lists put behind a list, text behind a text, and the least or greatest so far.
COUNTER = Merge(lambda a, b: a + b, lambda base, m: F.coalesce(base, F.lit(0)) + m)
APPEND = Merge(lambda a, b: F.concat(a, b), lambda base, m: F.when(base.isNull(), m).otherwise(F.concat(base, m)))
LEAST = Merge(lambda a, b: F.least(a, b), lambda base, m: F.least(base, m))
GREATEST = Merge(lambda a, b: F.greatest(a, b), lambda base, m: F.greatest(base, m))
#: Maps whose entries replace those of the map before; an entry of null removes one, as a JSON merge patch does.
PATCH = Merge(_patched, _apply_patch)
#: The last operand, whatever was there before.
REPLACE = Merge(lambda a, b: b, lambda base, m: m)


def _reduced(items: Column, merge: Merge, load: Callable[[Column], Column]) -> Column:
    """Structs (place..., value) in order, their values reduced from the left."""
    values = F.transform(F.array_sort(items), lambda i: load(i["value"]))
    return F.reduce(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), F.get(values, F.lit(0)), merge.combine)


def _hot_keys(ops: DataFrame, key: str, seq: str, parts: int) -> DataFrame:
    """(key, cuts) of keys with more than a part's share: fewer than there are parts, and so are the cuts of each."""
    counts = ops.groupBy(key).agg(F.count("*").alias("n"))
    share = max(RUN, (counts.agg(F.sum("n")).first()[0] or 0) // parts)
    hot = counts.where(F.col("n") > share).select(key)
    wanted = ops.join(F.broadcast(hot), ops[key].eqNullSafe(hot[key]), "left_semi")
    cuts = F.array_distinct(F.percentile_approx(seq, [i / parts for i in range(1, parts)] or [1.0], 20 * parts))
    return wanted.groupBy(F.col(key).alias("_hot")).agg(cuts.alias("_cuts"))


def merge_operands(
    table: DataFrame, ops: DataFrame, merge: Merge, key: str = "key", seq: str = "seq", value: str = "value"
) -> DataFrame:
    """(key, value): base values of ``table`` with all operands of ``ops`` laid on them in the order of ``seq``.

    A map is sent as its entries, since only those can be put in order. Keys without operands keep their value, keys without a base value get what their operands make of null. Operands
    with equal ``seq`` stand in the order of their xxhash64; null operands are left out. ``table`` has one row per key.
    The operands go through one exchange, their results and the table through another.
    """
    spark = ops.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    as_map = isinstance(ops.schema[value].dataType, MapType)
    store, load = (F.map_entries, F.map_from_entries) if as_map else (lambda x: x, lambda x: x)
    sent = store(F.col(value))
    given = ops.where(F.col(value).isNotNull()).select(
        F.col(key).alias("key"), F.col(seq).cast("bigint").alias("seq"), F.xxhash64(sent).alias("tie"), sent.alias("value")
    )
    hot = _hot_keys(given, "key", "seq", parts)
    placed = given.join(F.broadcast(hot), F.col("key").eqNullSafe(F.col("_hot")), "left")
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col("seq")))
    piece = F.when(F.col("_cuts").isNull(), 0).otherwise(below)
    part = F.pmod(F.xxhash64("key") + piece, F.lit(parts)).cast("int")
    dealt = placed.select(part.alias("part"), piece.alias("piece"), "key", "seq", "tie", "value").repartitionById(parts, F.col("part"))

    own = ["part", "key", "piece"]  # the exchange by part serves them all
    nth = F.row_number().over(Window.partitionBy(*own).orderBy("seq", "tie"))
    runs = dealt.withColumn("run", F.floor((nth - 1) / RUN)).groupBy(*own, "run")
    runs = runs.agg(store(_reduced(F.collect_list(F.struct("seq", "tie", "value")), merge, load)).alias("value"))
    pieces = runs.groupBy(*own).agg(store(_reduced(F.collect_list(F.struct("run", "value")), merge, load)).alias("value"))

    merged = pieces.select("key", F.struct("piece", "value").alias("operand"))
    base = table.select(F.col(key).alias("key"), F.struct(F.col(value).alias("value")).alias("base"))
    both = merged.unionByName(base, allowMissingColumns=True).groupBy("key")
    both = both.agg(F.collect_list("operand").alias("operands"), F.any_value("base", True).alias("base"))
    held = F.col("base")["value"]
    made = merge.apply(held, _reduced(F.col("operands"), merge, load))
    return both.select(F.col("key").alias(key), F.when(F.size("operands") == 0, held).otherwise(made).alias(value))
