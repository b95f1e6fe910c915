import itertools
import random
import uuid

import pytest
from pyspark.sql import functions as F

from nameledger.operators import fold, keyed
from nameledger.session import shared_dir
from nameledger.sources import files, state

EVENTS = "domain string, type string, value string, first_seen bigint, last_seen bigint"
KEYS = "domain string, type string, value string"


@pytest.fixture
def path(spark):
    return f"{shared_dir(spark)}/deletes-{uuid.uuid4().hex}"


def found(df):
    return sorted((r.domain, r.type, r.value, r.first_seen, r.last_seen) for r in df.collect())


def plain(batches):
    """What is left of (position, kind, data) batches, by their positions alone."""
    puts, gone, ranges = {}, {}, []
    for position, kind, data in batches:
        if kind == "put":
            for *key, first, last in data:
                puts.setdefault(tuple(key), []).append((position, first, last))
        elif kind == "keys":
            for key in data:
                gone[tuple(key)] = max(gone.get(tuple(key), -1), position)
        else:
            ranges.append((*data, position))
    out = []
    for key, entries in puts.items():
        text = "|".join(key)
        hidden = max([gone.get(key, -1)] + [p for low, high, p in ranges if low <= text < high])
        live = [e for e in entries if e[0] > hidden]
        if live:
            out.append((*key, min((f for _, f, _ in live if f), default=0), max((x for _, _, x in live if x), default=0)))
    return sorted(out)


def run(spark, rows, path, batch, explicit=True):
    position, kind, data = batch
    at = {"position": position} if explicit else {}
    if kind == "put":
        state.upsert_state(spark, path, rows(data, EVENTS), n_shards=2, **at)
    elif kind == "keys":
        state.delete_state(spark, path, rows(data, KEYS), **at)
    else:
        state.delete_state_range(spark, path, *data, **at)


def some_batches(seed, n):
    draw = random.Random(seed)
    batches = [(0, "put", [("a.com", "A", "0", 5, 6)])]
    for position in range(1, n):
        kind = draw.choice(["put", "put", "keys", "range"])
        key = lambda: (draw.choice("abcd") + ".com", draw.choice(["A", "CNAME"]), str(draw.randrange(2)))
        if kind == "put":
            data = [(*key(), draw.choice([0, draw.randrange(1, 99)]), draw.choice([0, draw.randrange(1, 99)])) for _ in range(6)]
        elif kind == "keys":
            data = [key() for _ in range(3)]
        else:
            data = tuple(sorted(["|".join(key()), "|".join(key()) + "x"]))
        batches.append((position, kind, data))
    return batches


def test_order_and_replay_of_batches_change_nothing(spark, rows, path):
    batches = some_batches(1, 10)
    want = plain(batches)
    draw = random.Random(2)
    for number in range(2):
        order = batches[1:] + draw.sample(batches, 3)
        draw.shuffle(order)
        here = f"{path}-{number}"
        for i, batch in enumerate([batches[0], *order]):
            run(spark, rows, here, batch)
            if i == 6:
                state.compact_state(spark, here)  # nothing is settled: everything must still be able to come
        assert found(state.read_state(spark, here)) == want
        made = state.compact_state(spark, here, settled=99)
        assert not made.loose and not made.ranges
        assert found(state.read_state(spark, here)) == want
        stored = state._scan(spark, here, {int(s): d for s, d in made.shards.items()})
        assert stored.where("is_delete").isEmpty() and stored.count() == len(want)


def test_without_positions_batches_count_as_committed(spark, rows, path):
    batches = some_batches(3, 12)
    for i, batch in enumerate(batches):
        run(spark, rows, path, batch, explicit=False)
        if i in (4, 8):
            made = state.compact_state(spark, path)
            assert not made.loose and not made.ranges and all(len(d) == 1 for d in made.shards.values())
        assert found(state.read_state(spark, path)) == plain(batches[: i + 1])


def test_partly_settled_deletes_stay(spark, rows, path):
    put = [("a.com", "A", "1", 5, 6)]
    state.upsert_state(spark, path, rows(put, EVENTS), position=1)
    state.delete_state(spark, path, rows([put[0][:3]], KEYS), position=5)
    made = state.compact_state(spark, path, settled=3)
    assert made.loose and state.read_state(spark, path).isEmpty()
    state.upsert_state(spark, path, rows(put, EVENTS), position=4)  # late, and from before the delete
    assert state.read_state(spark, path).isEmpty()
    state.upsert_state(spark, path, rows([("a.com", "A", "1", 8, 9)], EVENTS), position=6)
    assert found(state.read_state(spark, path)) == [("a.com", "A", "1", 8, 9)]


def test_ordered_change_batches(spark, rows, path):
    ops = rows([("a.com", "A", "1", 1, 2, False, 1), ("a.com", "A", "1", None, None, True, 2), ("a.com", "A", "1", 7, 8, False, 3),
                ("b.com", "A", "1", 1, 2, False, 4), ("b.com", "A", "1", None, None, True, 9)],
               f"{EVENTS}, is_delete boolean, seq int")
    state.apply_state_changes(spark, path, ops)
    assert found(state.read_state(spark, path)) == [("a.com", "A", "1", 7, 8)]
    state.apply_state_changes(spark, path, ops.where("seq < 3"))
    assert found(state.read_state(spark, path)) == [("a.com", "A", "1", 7, 8)]


def test_lookups_hide_deleted_keys_and_deletes_write_little(spark, rows, path):
    from nameledger.operators import lookup

    data = [(f"d{i}.com", "A", str(i), i, i) for i in range(1, 3000)]
    state.upsert_state(spark, path, rows(data, EVENTS))
    made = state.delete_state(spark, path, rows([("d7.com", "A", "7")], KEYS))
    assert made.kind == "delete" and len(made.added) == 1
    assert sum(files.bytes_in(spark, f"{path}/{d}") for d in made.added) < 4000
    table = state.read_state(spark, path)
    assert lookup.get_key(table, "d7.com", "A", "7").isEmpty() and lookup.query_domain(table, "d8.com").count() == 1
    assert table.count() == 2998


def test_only_shards_of_several_folders_are_folded(spark, rows, path):
    data = [(f"d{i}.com", "A", str(i), i, i) for i in range(1, 200)]
    state.upsert_state(spark, path, rows(data, EVENTS))
    assert "Exchange" not in state.read_state(spark, path)._jdf.queryExecution().executedPlan().toString()
    made = state.upsert_state(spark, path, rows([("d7.com", "A", "7", 1, 500)], EVENTS))
    several = [int(s) for s, dirs in made.shards.items() if len(dirs) > 1]
    assert len(several) == 1 and len(made.shards) == 4
    table = state.read_state(spark, path)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Union") == 1 and plan.count("HashAggregate") == 2
    alone = state.read_state(spark, path, shards=[s for s in range(4) if s not in several])
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
    assert table.count() == 199 and table.where("last_seen = 500").count() == 1


def test_changes_follow_the_version_list(spark, rows, path):
    batches = some_batches(5, 9)
    seen = {}
    for number, batch in enumerate(batches):
        run(spark, rows, path, batch, explicit=False)
        if number == 4:
            state.compact_state(spark, path)
        version = state.load_version(spark, path).version
        seen[version] = found(state.read_state(spark, path, version))

    def want(old, new):
        before, after = ({r[:3]: r[3:] for r in seen[v]} for v in (old, new))
        out = [(*k, "delete", None, None) for k in before if k not in after]
        out += [(*k, "insert" if k not in before else "update", *t) for k, t in after.items() if before.get(k) != t]
        return sorted(out, key=repr)

    for old, new in itertools.combinations(sorted(seen), 2):
        if (old + new) % 3 == 0 or new == max(seen):
            got = state.state_changes(spark, path, old, new)
            assert sorted(map(tuple, got.select(*fold.STATE_KEY, "op", "first_seen", "last_seen").collect()), key=repr) == want(old, new)
    last = max(seen)
    made = state.compact_state(spark, path)
    assert made.version == last + 1
    none = state.state_changes(spark, path, last)
    assert none.isEmpty() and "FileScan" not in none._jdf.queryExecution().optimizedPlan().toString()


def test_changes_read_the_change_and_not_the_table(spark, rows, path):
    many = [(f"d{i:05d}.com", "A", str(i), i, i) for i in range(1, 4000)]
    state.upsert_state(spark, path, rows(many, EVENTS))
    state.upsert_state(spark, path, rows([("d00007.com", "A", "7", 1, 9999), ("new.com", "A", "1", 1, 1)], EVENTS))
    got = state.state_changes(spark, path, 1)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "In(domain" in plan
    assert sorted((r.domain, r.op) for r in got.collect()) == [("d00007.com", "update"), ("new.com", "insert")]


def test_changes_after_a_rewrite_and_over_dropped_versions(spark, rows, path):
    for batch in some_batches(6, 6):
        run(spark, rows, path, batch, explicit=False)
    old = state.load_version(spark, path).version
    before = found(state.read_state(spark, path))
    kept = keyed.expire(state.read_state(spark, path), now=100, ttl=50)
    state.rewrite_state(spark, path, kept)
    changed = state.state_changes(spark, path, old)
    assert changed.where("op <> 'delete'").isEmpty()
    assert changed.count() == len(before) - state.read_state(spark, path).count()
    for i in range(3):
        state.upsert_state(spark, path, rows([(f"n{i}.com", "A", "1", 1, 1)], EVENTS))
    with state.pinned_version(spark, path, old + 1):
        state.drop_old_versions(spark, path, keep=1)
    assert state.versions(spark, path) == [old + 1, old + 4]
    assert sorted(r.domain for r in state.state_changes(spark, path, old + 1).collect()) == ["n0.com", "n1.com", "n2.com"]


def test_a_held_version_outlives_its_successors(spark, rows, path):
    state.upsert_state(spark, path, rows([("a.com", "A", "1", 1, 1)], EVENTS))
    with state.pinned_version(spark, path) as version:
        reader = state.read_state(spark, path, version)
        for i in range(4):
            state.upsert_state(spark, path, rows([("a.com", "A", "1", 1, i + 2)], EVENTS))
        state.compact_state(spark, path)
        assert state.drop_old_versions(spark, path, keep=1) == [2, 3, 4, 5]
        assert found(reader) == [("a.com", "A", "1", 1, 1)]
    _, lease = state.hold_version(spark, path, seconds=-1)
    assert state.drop_old_versions(spark, path, keep=1, min_age=3600) == []
    assert state.drop_old_versions(spark, path, keep=1) == [1] and not files.exists(spark, lease)
    with pytest.raises(ValueError):
        state.hold_version(spark, path, 1)


def test_versions_by_time_and_compaction_by_share(spark, rows, path):
    made = state.upsert_state(spark, path, rows([(f"d{i}.com", "A", str(i), i, i) for i in range(1, 2000)], EVENTS), n_shards=1)
    later = state.upsert_state(spark, path, rows([("a.com", "A", "1", 1, 1)], EVENTS))
    assert state.version_at(spark, path, made.time - 1) is None
    assert state.version_at(spark, path, later.time) == 2
    assert state.compact_state(spark, path, share=0.5) == later
    assert state.compact_state(spark, path).version == 3


def test_range_deletes_are_bounded_and_searched(spark, rows, path, monkeypatch):
    monkeypatch.setattr(state, "MOST_RANGES", 90)
    data = [(f"d{i:03d}", "A", "1", 1, i) for i in range(400)]
    state.upsert_state(spark, path, rows(data, EVENTS))
    for i in range(90):
        current = state.load_version(spark, path)
        if i < 88:  # one commit for most, to save time
            continue
        state.delete_state_range(spark, path, f"d{4 * i:03d}", f"d{4 * i + 1:03d}|A|1")
    ranges = [[f"d{4 * i:03d}", f"d{4 * i + 1:03d}|A|1", 9] for i in range(90)]
    got = spark.createDataFrame([(f"{d}|A|1",) for d, *_ in data], "k string").select("k", state._range_position(F.col("k"), ranges).alias("p")).collect()
    assert all((r.p == 9) == any(low <= r.k < high for low, high, _ in ranges) for r in got)
    assert state.read_state(spark, path).count() == 398
    assert state.delete_state_range(spark, path, "b", "a").version == state.load_version(spark, path).version
    monkeypatch.setattr(state, "MOST_RANGES", 2)
    with pytest.raises(ValueError):
        state.delete_state_range(spark, path, "a", "b")


def test_sketches_of_unchanged_shards_are_kept(spark, rows, path):
    data = [(f"d{i % 700}.com", "A" if i % 3 else "CNAME", f"v{i % 900}", 1, i) for i in range(1, 3000)]
    state.upsert_state(spark, path, rows(data, EVENTS))
    first = state.united_sketches(state.state_sketches(spark, path)).first()
    table = state.read_state(spark, path)
    want = table.agg(F.count("*").alias("records"), F.countDistinct(F.when(F.col("type") == "A", F.col("value"))).alias("ips"), F.countDistinct("domain").alias("domains")).first()
    assert first.records == want.records
    assert abs(first.ips - want.ips) <= 0.04 * want.ips and abs(first.domains - want.domains) <= 0.04 * want.domains
    before = spark.read.parquet(f"{path}/sketches").count()
    assert before == 4 and state.state_sketches(spark, path).count() == 4 and spark.read.parquet(f"{path}/sketches").count() == 4
    state.upsert_state(spark, path, rows([("one.com", "A", "new", 1, 1)], EVENTS))
    assert state.united_sketches(state.state_sketches(spark, path)).first().records == want.records + 1
    assert spark.read.parquet(f"{path}/sketches").count() == 5, "one shard was sketched again"
    assert state.united_sketches(state.state_sketches(spark, f"{path}-none")).first().records == 0
