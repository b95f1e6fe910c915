"""Predecessor join: every point meets the last range that starts at or before it, in one exchange of the points.

Points and ranges are dealt to parts by bounds at the points' own quantiles, sorted within a part, and each range is
carried forward to the points behind it. A range that spans a bound is sent to every part it reaches; of disjoint ranges
that is one per bound. A point value that is more than a part's worth by itself is several quantiles at once: its points
are spread over the parts between them, and the ranges that hold it go to each of these.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TREE = 64  # comparisons in one nested expression


def place_of(value: Column, bounds: Sequence[int] | Sequence[str]) -> Column:
    """How many of the sorted, different ``bounds`` are less than ``value``: a search tree, with short arrays below it."""

    def tree(low: int, high: int, of: Sequence) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > of[middle], tree(middle + 1, high, of)).otherwise(tree(low, middle, of))

    if len(bounds) <= _TREE:
        return tree(0, len(bounds), bounds)
    heads = bounds[_TREE - 1 :: _TREE]
    groups = [[F.lit(b) for b in bounds[i : i + _TREE]] for i in range(0, len(heads) * _TREE + 1, _TREE)]
    group = tree(0, len(heads), heads)
    kind = "string" if isinstance(bounds[0], str) else "bigint"
    rest = F.get(F.array(*[F.array(*g).cast(f"array<{kind}>") for g in groups]), group)
    return group * _TREE + F.size(F.filter(rest, lambda b: b < value))


@dataclass(frozen=True)
class Parts:
    """Parts ``first`` to ``first + len(bounds)``; equal bounds leave parts between them for one value."""

    first: int
    bounds: tuple[int, ...]

    def of(self, key: Column, last: bool = False) -> Column:
        """The first (or last) part a key may be in."""
        times = Counter(self.bounds)
        different = sorted(times)
        below = [0]
        for bound in different:
            below.append(below[-1] + times[bound])
        place = place_of(key, different)
        before = F.get(F.array(*[F.lit(b) for b in below]), place)
        if not last or not different:
            return before + self.first
        equal = F.get(F.array(*[F.lit(b) for b in different]), place) == key
        again = F.get(F.array(*[F.lit(times[b]) for b in different]), place)
        return before + self.first + F.when(equal, again).otherwise(0)


def deal(points: DataFrame, keys: Sequence[Column], parts: int) -> list[Parts]:
    """Bounds at the quantiles of each kind of points (a key is null for those of another kind), in one job.

    The driver gets fewer bounds than there are parts, for each kind.
    """
    shares = [i / parts for i in range(1, parts)] or [0.5]
    aggs = [a for key in keys for a in (F.count(key), F.percentile_approx(key, shares, 20 * parts))]
    facts = points.agg(*aggs).first()
    counts, quantiles = facts[0::2], facts[1::2]
    total, out, first = sum(counts), [], 0
    for n, found in zip(counts, quantiles, strict=True):
        mine = max(1, round(parts * n / total)) if total else 1
        bounds = [found[round(i * parts / mine) - 1] for i in range(1, mine)] if n and parts > 1 else []
        out.append(Parts(first, tuple(bounds)))
        first += len(bounds) + 1
    return out


def carry_forward(points: DataFrame, ranges: DataFrame, parts: int, slots: int) -> DataFrame:
    """The points' ``row`` and ``at``, with the last range of each slot before it as ``slot0``, ``slot1``...

    ``points`` has part, at, row; ``ranges`` has part, at, range, a struct with the field ``slot``. Ranges of a slot are
    disjoint; whether the last one reaches the point is left to the caller. The only exchange is that of the parts.
    """
    kinds = {f.name: f.dataType for f in [*points.schema, *ranges.schema]}
    sent = points.select("part", "at", F.lit(1).alias("kind"), "row", F.lit(None).cast(kinds["range"]).alias("range"))
    both = sent.unionByName(ranges.select("part", "at", F.lit(0).alias("kind"), F.lit(None).cast(kinds["row"]).alias("row"), "range"))
    so_far = Window.partitionBy("part").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    held = [F.last(F.when(F.col("range.slot") == i, F.col("range")), ignorenulls=True).over(so_far).alias(f"slot{i}") for i in range(slots)]
    dealt = both.repartitionById(parts, F.col("part"))
    return dealt.select("at", "kind", "row", *held).where("kind = 1").drop("kind")
