import random
import re
from functools import reduce

import pytest
from pyspark.sql import functions as F

from nameledger.operators import merging

BIG = "key string, seq bigint, value bigint, base string, operand int"


def operands(seed, n=3000, hot="h"):
    draw = random.Random(seed)
    seqs = list(range(n))
    draw.shuffle(seqs)
    return [(hot if draw.random() < 0.6 else draw.choice(["a", "b", "c", None]), s) for s in seqs]


@pytest.fixture
def small_runs(monkeypatch):
    monkeypatch.setattr(merging, "RUN", 16)


def by_key(ops):
    out = {}
    for key, seq, value in sorted(ops, key=lambda o: o[1]):
        out.setdefault(key, []).append(value)
    return out


def test_counter(rows, small_runs):
    ops = [(k, s, s % 7 - 3, "x", 1) for k, s in operands(1)]
    base = [("h", 10), ("z", 5), (None, None)]
    got = merging.merge_operands(rows(base, "key string, value bigint"), rows(ops, BIG), merging.COUNTER)
    want = {k: sum(v) for k, v in by_key([o[:3] for o in ops]).items()}
    want = {**want, "h": want["h"] + 10, "z": 5}
    assert {r.key: r.value for r in got.collect()} == want


def test_appended_lists_keep_their_order(rows, small_runs):
    ops = [(k, s, [s, s]) for k, s in operands(2)]
    schema = "key string, seq bigint, value array<bigint>"
    got = merging.merge_operands(rows([("h", [-1]), ("q", [])], "key string, value array<bigint>"), rows(ops, schema), merging.APPEND)
    want = {k: [x for v in vs for x in v] for k, vs in by_key(ops).items()}
    want["h"] = [-1, *want["h"]]
    want["q"] = []
    assert {r.key: r.value for r in got.collect()} == want


def test_patches(rows, small_runs):
    draw = random.Random(3)
    ops = [(k, s, {draw.choice("abcdef"): draw.choice([None, f"v{s}"]) for _ in range(draw.randint(0, 3))}) for k, s in operands(3, 900)]
    base = {"h": {"a": "old", "k": "kept"}, "only": {"x": "1"}}
    got = merging.merge_operands(
        rows(list(base.items()), "key string, value map<string,string>"), rows(ops, "key string, seq bigint, value map<string,string>"), merging.PATCH
    )
    want = dict(base)
    for key, patches in by_key(ops).items():
        whole = reduce(lambda a, b: {**a, **b}, patches, base.get(key, {}))
        want[key] = {k: v for k, v in whole.items() if v is not None}
    assert {r.key: r.value for r in got.collect()} == want


def test_callers_own_function(rows, small_runs):
    """Two-by-two matrices: associative, and the order matters."""

    def times(a, b):
        cell = lambda i, j: F.pmod(a[2 * i] * b[j] + a[2 * i + 1] * b[2 + j], F.lit(1_000_003))
        return F.array(cell(0, 0), cell(0, 1), cell(1, 0), cell(1, 1))

    ops = [(k, s, [s % 5, 1, s % 3, 2]) for k, s in operands(4, 700)]
    rule = merging.Merge(times, lambda base, m: F.when(base.isNull(), m).otherwise(times(base, m)))
    got = merging.merge_operands(rows([("a", [1, 2, 3, 4])], "key string, value array<bigint>"), rows(ops, "key string, seq bigint, value array<bigint>"), rule)

    def product(a, b):
        return [(a[2 * i] * b[j] + a[2 * i + 1] * b[2 + j]) % 1_000_003 for i in (0, 1) for j in (0, 1)]

    want = {k: reduce(product, [[1, 2, 3, 4], *v] if k == "a" else v) for k, v in by_key(ops).items()}
    assert {r.key: r.value for r in got.collect()} == want


def test_hot_key_is_reduced_by_several_tasks_and_operands_move_once(spark, rows, small_runs):
    ops = rows([(k, s, s, "x", 1) for k, s in operands(5)], BIG)
    hot = {r["_hot"]: r["_cuts"] for r in merging._hot_keys(ops, "key", "seq", 4).collect()}
    assert list(hot) == ["h"] and len(hot["h"]) == 3
    plan = merging.merge_operands(rows([], "key string, value bigint"), ops, merging.COUNTER)._jdf.queryExecution().executedPlan().toString()
    # besides the exchange by part: counts and quantiles of keys, both added up before, and the results
    assert plan.count("shufflepartitionidpassthrough") == 1 and len(re.findall("(?<!Broadcast)Exchange ", plan)) == 4


def test_rest(rows):
    some = rows([("a", 1, None, "x", 1), ("b", 1, 7, "x", 1), ("b", None, 2, "x", 1)], BIG)
    none, base = rows([], BIG), rows([("a", 4), ("c", None)], "key string, value bigint")
    assert {r.key: r.value for r in merging.merge_operands(base, some, merging.COUNTER).collect()} == {"a": 4, "b": 9, "c": None}
    assert {r.key: r.value for r in merging.merge_operands(base, some, merging.REPLACE).collect()} == {"a": 4, "b": 7, "c": None}
    assert {r.key: r.value for r in merging.merge_operands(base, some, merging.LEAST).collect()} == {"a": 4, "b": 2, "c": None}
    assert {r.key: r.value for r in merging.merge_operands(base, some, merging.GREATEST).collect()} == {"a": 4, "b": 7, "c": None}
    assert merging.merge_operands(none, none, merging.COUNTER).count() == 0
