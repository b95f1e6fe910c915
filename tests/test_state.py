from pathlib import Path
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from nameledger.operators import fold, keyed
from nameledger.session import shared_dir
from nameledger.sources import files, state

EVENTS = "domain string, type string, value string, first_seen bigint, last_seen bigint"


@pytest.fixture
def path(spark):
    return f"{shared_dir(spark)}/state-{uuid.uuid4().hex}"


def folded(df):
    return sorted((r.domain, r.type, r.value, r.first_seen, r.last_seen) for r in df.collect())


def one_key(rows, *times):
    return rows([("a", "A", "1", f, t) for f, t in times], EVENTS)


def test_zero_is_unknown_unless_told_otherwise(rows):
    def times(df, **kw):
        return folded(fold.fold_events(df, **kw))[0][3:]

    assert times(one_key(rows, (5, 5), (3, 9))) == (3, 9)
    assert times(one_key(rows, (0, 0), (7, 7))) == (7, 7)
    assert times(one_key(rows, (0, 0))) == (0, 0)
    assert times(one_key(rows, (0, 0), (7, 7)), zero_is_missing=False) == (0, 7)


def random_events(n, seed):
    rng = random.Random(seed)
    return [
        (f"d{rng.randrange(20)}.com", rng.choice(["A", "CNAME"]), f"v{rng.randrange(5)}",
         rng.choice([0, rng.randrange(1, 1000)]), rng.choice([0, rng.randrange(1, 1000)]))
        for _ in range(n)
    ]


def test_any_batch_split_gives_the_same_state(spark, rows, path):
    data = random_events(400, 3)
    batches = [data[:50], data[50:51], data[51:300], data[300:]]
    for number, batch in enumerate(batches):
        state.upsert_state(spark, path, rows(batch, EVENTS))
        if number == 1:
            state.compact_state(spark, path)
    whole = folded(fold.fold_events(rows(data, EVENTS)))
    assert folded(state.read_state(spark, path)) == whole

    state.upsert_state(spark, path, rows(batches[2], EVENTS))
    assert folded(state.read_state(spark, path)) == whole, "folding it again changes nothing"

    first = folded(state.read_state(spark, path, version=1))
    assert first == folded(fold.fold_events(rows(batches[0], EVENTS)))


def test_an_upsert_writes_its_batch_only(spark, rows, path):
    state.upsert_state(spark, path, rows(random_events(100, 1), EVENTS))
    made = state.upsert_state(spark, path, rows([("example.com", "A", "1", 1, 1)], EVENTS))
    assert [s for s, dirs in made.shards.items() if any("v=2" in d for d in dirs)] == ["2"]
    assert set(made.shards) == {"0", "1", "2", "3"}


def stored_bytes(spark, path, version):
    made = state.load_version(spark, path, version)
    folders = {d.rsplit("/", 1)[0] for dirs in made.shards.values() for d in dirs if f"v={version}-" in d}
    return sum(f.stat().st_size for d in folders for f in Path(f"{path}/{d}").rglob("*.parquet"))


def test_what_a_batch_writes_does_not_grow_with_the_table(spark, rows, path):
    sizes = []
    small = rows([(f"new{i}.com", "A", "1", 1, 1) for i in range(20)], EVENTS)
    for number in range(3):
        large = [(f"d{number}-{i}.com", "A", str(i), i, i) for i in range(3000)]
        state.upsert_state(spark, path, rows(large, EVENTS))
        sizes.append(stored_bytes(spark, path, state.upsert_state(spark, path, small).version))
    assert max(sizes) - min(sizes) < 64 and max(sizes) < stored_bytes(spark, path, 1) / 5


def test_compaction_keeps_the_rows_and_one_folder_a_shard(spark, rows, path):
    data = random_events(300, 5)
    for at in range(0, 300, 60):
        state.upsert_state(spark, path, rows(data[at : at + 60], EVENTS), n_shards=3, zero_is_missing=False)
    before = folded(state.read_state(spark, path))
    made = state.compact_state(spark, path)
    assert all(len(dirs) == 1 for dirs in made.shards.values())
    assert folded(state.read_state(spark, path)) == before
    assert before == folded(fold.fold_events(rows(data, EVENTS), zero_is_missing=False))
    assert state.compact_state(spark, path) == made
    assert folded(state.read_state(spark, path, version=made.version - 1)) == before


def test_lookups_know_the_tables_shards(spark, rows, path):
    from nameledger.operators import lookup

    state.upsert_state(spark, path, rows([("example.com", "A", "1.1.1.1", 1, 2)], EVENTS), n_shards=64)
    table = state.read_state(spark, path)
    for name in ("example.com", " Example.COM. "):
        assert lookup.resolve_domain(table, name).first().ips == ["1.1.1.1"]
        assert lookup.query_domain(table, name).count() == 1
        assert lookup.get_key(table, name, "A", "1.1.1.1").count() == 1
    shard = table.first().shard_id
    assert lookup.inspect_shard(table, shard).count() == 1 and shard >= 4
    with pytest.raises(ValueError):
        lookup.inspect_shard(table, 64)


def test_reads_are_pruned_to_the_shard(spark, rows, path):
    from nameledger.operators.lookup import query_domain

    state.upsert_state(spark, path, rows(random_events(100, 1), EVENTS))
    hit = query_domain(state.read_state(spark, path), "d3.com")
    plan = hit._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard_id" in plan
    assert "EqualTo(domain,d3.com)" in plan and "TakeOrderedAndProject" in plan
    assert hit.count() > 0


def test_a_second_writer_fails_and_bad_versions_are_named(spark, rows, path):
    state.upsert_state(spark, path, one_key(rows, (1, 1)))
    with pytest.raises(FileExistsError):
        files.write_new(spark, f"{path}/versions/{1:012d}.json", "{}")
    with pytest.raises(ValueError):
        state.read_state(spark, path, version=9)


def test_missing_shards_can_be_skipped(spark, rows, path):
    made = state.upsert_state(spark, path, rows(random_events(100, 1), EVENTS))
    text = json.loads(files.read_text(spark, f"{path}/versions/{1:012d}.json"))
    assert text["shards"] == made.shards
    gone = {**text, "version": 2, "shards": {**made.shards, "9": ["data/v=1/shard_id=9"]}}
    files.write_new(spark, f"{path}/versions/{2:012d}.json", json.dumps(gone))
    kept = state.read_state(spark, path, skip_unreadable=True)
    assert folded(kept) == folded(state.read_state(spark, path, version=1))


def test_empty_table_and_rewrite(spark, rows, path):
    assert state.read_state(spark, path).count() == 0
    assert state.upsert_state(spark, path, rows([], EVENTS)) is None
    data = random_events(80, 2)
    state.upsert_state(spark, path, rows(data[:50], EVENTS))
    state.bulk_upsert(spark, path, rows(data[50:], EVENTS))
    assert folded(state.read_state(spark, path)) == folded(fold.fold_events(rows(data, EVENTS)))
    full = folded(state.read_state(spark, path))
    live = keyed.expire(state.read_state(spark, path), now=1000, ttl=500)
    state.rewrite_state(spark, path, live)
    assert all(r.last_seen == 0 or r.last_seen > 500 for r in state.read_state(spark, path).collect())
    assert folded(state.read_state(spark, path, version=2)) == full
    assert state.read_state(spark, path).count() < len(full)


def test_old_versions_can_go(spark, rows, path):
    data = random_events(60, 4)
    for event in (data[:20], data[20:40], [("example.com", "A", "1", 1, 1)], data[40:]):
        state.upsert_state(spark, path, rows(event, EVENTS))
    whole = folded(state.read_state(spark, path))
    fourth = folded(state.read_state(spark, path, version=4))
    state.compact_state(spark, path)
    assert state.drop_old_versions(spark, path, keep=2) == [1, 2, 3]
    assert state.versions(spark, path) == [4, 5]
    assert folded(state.read_state(spark, path)) == whole
    assert folded(state.read_state(spark, path, version=4)) == fourth
    assert state.drop_old_versions(spark, path, keep=1) == [4]
    assert folded(state.read_state(spark, path)) == whole
    assert len(files.names_in(spark, f"{path}/data")) == 1, "folders of merged versions are gone"


def test_decoding_stored_pairs(rows):
    pairs = [("a|A|1", '{"first_seen":1,"last_seen":2}'), ("a|A", '{"first_seen":1}'),
             ("b|A|2", "{broken"), ("c|A|3", '{"first_seen":"x","last_seen":4}')]
    got = folded(state.decode_kv(rows(pairs, "key string, value string")))
    assert got == [("a", "A", "1", 1, 2), ("c", "A", "3", 0, 4)]


# --- keyed tables ------------------------------------------------------------------------------

HISTORY = "key string, ts bigint, value string, is_delete boolean"
VERSIONS = [
    ("mx.a", 10, "blue", False), ("mx.a", 20, "green", False), ("ns.b", 25, "seven", False),
    ("mx.a", 40, None, True), ("ns.b", 45, None, True), ("txt.c", 45, "open", False),
    ("mx.a", 60, "grey", False),
]


def test_reads_as_of_a_time(rows):
    history = rows(VERSIONS, HISTORY)

    def at(ts):
        return sorted((r.key, r.ts, r.value) for r in keyed.read_as_of(history, ts).collect())

    assert at(9) == []
    assert at(10) == [("mx.a", 10, "blue")]
    assert at(39) == [("mx.a", 20, "green"), ("ns.b", 25, "seven")]
    assert at(50) == [("txt.c", 45, "open")]
    assert at(99) == [("mx.a", 60, "grey"), ("txt.c", 45, "open")]
    listed = [(r.key, r.ts) for r in keyed.history_between(history, 15, 50).collect()]
    assert listed == [("mx.a", 40), ("mx.a", 20), ("ns.b", 45), ("ns.b", 25), ("txt.c", 45)]


def test_multi_get_keeps_the_order_and_the_misses(rows):
    table = rows([("left", "l"), ("right", "r")], "key string, value string")
    keys = rows([(0, "up"), (1, "right"), (2, "left"), (3, "right")], "pos int, key string")
    got = [(r.key, r.value) for r in keyed.multi_get(table, keys).orderBy("pos").collect()]
    assert got == [("up", None), ("right", "r"), ("left", "l"), ("right", "r")]
    asked = rows([(0, "mx.a"), (1, "ns.b"), (2, "none")], "pos int, key string")
    found = keyed.multi_get_as_of(rows(VERSIONS, HISTORY), asked, 30).orderBy("pos").collect()
    assert [r.value for r in found] == ["green", "seven", None]


def test_a_key_asked_for_very_often(rows):
    from nameledger.plans.skew import join_spread

    keys = rows([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "pos int, key string")
    table = rows([("hot", "a"), ("hot", "b"), ("k3", "c")], "key string, value string")
    plain = sorted(map(tuple, keys.join(table, "key", "left").collect()), key=repr)
    spread = join_spread(keys, table, ["key"])
    assert sorted(map(tuple, spread.collect()), key=repr) == plain


def test_scans(rows):
    table = rows([(f"key_{i}", "v") for i in range(1000)] + [("foo1", ""), ("foo2", ""), ("bar", "")],
                 "key string, value string")
    assert keyed.range_scan(table, high="keya").count() == 1003
    assert keyed.range_scan(table, "key_", "keya").count() == 1000
    assert [r.key for r in keyed.range_scan(table, "bar", "foo2").collect()] == ["bar", "foo1"]
    assert [r.key for r in keyed.prefix_scan(table, "foo").collect()] == ["foo1", "foo2"]


def test_change_batches(rows):
    table = rows([("gone", "old"), ("kept", "same")], "key string, value string")
    ops = rows([(7, "made", "one", False), (9, "made", "two", False), (8, "gone", None, True)],
               "seq int, key string, value string, is_delete boolean")
    after = keyed.apply_changes(table, ops)
    assert sorted((r.key, r.value) for r in after.collect()) == [("kept", "same"), ("made", "two")]
    assert [r.key for r in keyed.delete_range(after, "ka", "ma").collect()] == ["made"]
    assert keyed.delete_range(after, "x", "z").count() == 2
    assert [r.key for r in keyed.delete_keys(after, rows([("made",)], "key string")).collect()] == ["kept"]


def test_merges(rows):
    base = rows([("seen", "a.com,")], "key string, value string")
    ops = rows([(30, "seen", "c.com"), (4, "seen", "b.com,"), (1, "first", "z.com")],
               "seq int, key string, value string")
    got = {r.key: r.value for r in keyed.append_by_key(base, ops).collect()}
    assert got == {"seen": "a.com,b.com,c.com", "first": "z.com"}
    many = rows([(i, "k", f"{i};") for i in range(100)], "seq int, key string, value string")
    far = many.unionByName(rows([(10**12, "k", "end;")], "seq int, key string, value string".replace("int", "bigint", 1)))
    parts = keyed.append_by_key(base.limit(0), far, runs=10).orderBy("part").collect()
    assert len(parts) == 10 and max(r.value.count(";") for r in parts) <= 12
    assert "".join(r.value for r in parts) == "".join(f"{i};" for i in range(100)) + "end;"
    numbers = rows([("a", 1)], "key string, value bigint"), rows([("a", 5)], "key string, value bigint")
    for how, want in (("sum", 6), ("min", 1), ("max", 5)):
        assert keyed.merge_by_key(*numbers, how).first().value == want


def test_retention_and_changes(rows):
    table = rows([("stay", "v1"), ("drop", "v9")], "key string, value string")
    kept = keyed.retain(table, F.col("key") != "drop", {"value": F.upper("value")})
    assert [(r.key, r.value) for r in kept.collect()] == [("stay", "V1")]
    seen = rows([(0,), (10,), (90,)], "last_seen bigint")
    assert [r[0] for r in keyed.expire(seen, 100, 50).collect()] == [0, 90]
    new = rows([("stay", "v2"), ("born", None)], "key string, value string")
    got = {r.key: (r.op, r.value) for r in keyed.changes_since(table, new).collect()}
    assert got == {"stay": ("update", "v2"), "drop": ("delete", None), "born": ("insert", None)}
