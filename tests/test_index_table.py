import random
import uuid

import pytest

from nameledger.operators import index
from nameledger.session import shared_dir
from nameledger.sources import index_table, state

EVENTS = "domain string, type string, value string, first_seen bigint, last_seen bigint"


@pytest.fixture
def path(spark):
    return f"{shared_dir(spark)}/index-table-{uuid.uuid4().hex}"


def lists(df):
    out = {}
    for r in df.collect():
        domains, seen = out.setdefault(r.ip, ([], set()))
        domains.extend(r.domains)
        seen.add(r.last_seen)
    return {ip: (sorted(d), s) for ip, (d, s) in out.items()}


def events(seed, n=300, ips=60):
    draw = random.Random(seed)
    return [(f"d{draw.randrange(40)}.com", draw.choice(["A", "A", "CNAME"]), f"1.1.1.{draw.randrange(ips)}", 1, draw.randrange(1, 99)) for _ in range(n)]


@pytest.mark.parametrize("spread", [1, 3])
def test_updates_equal_a_new_index(spark, rows, path, spread):
    first, second = rows(events(1), EVENTS), rows(events(2, 40, 90), EVENTS)
    state.upsert_state(spark, f"{path}-state", first)
    whole = index.ip_index(state.read_state(spark, f"{path}-state"), buckets=spread)
    index_table.write_index_table(whole, f"{path}-0", 4, spread)
    assert lists(index_table.read_index_table(spark, f"{path}-0")) == lists(whole)

    state.upsert_state(spark, f"{path}-state", second)
    changes = state.state_changes(spark, f"{path}-state", 1)
    index_table.update_index_table(spark, f"{path}-0", f"{path}-1", changes)
    want = index.ip_index(state.read_state(spark, f"{path}-state"), buckets=spread)
    got = index_table.read_index_table(spark, f"{path}-1")
    assert lists(got) == lists(want)
    assert spread == 1 or got.where("part > 0").count() > 0

    state.delete_state(spark, f"{path}-state", first.limit(30))
    changes = state.state_changes(spark, f"{path}-state", 2)
    after = state.read_state(spark, f"{path}-state")
    index_table.update_index_table(spark, f"{path}-1", f"{path}-2", changes, after)
    assert lists(index_table.read_index_table(spark, f"{path}-2")) == lists(index.ip_index(after, buckets=spread))


def test_the_old_index_is_not_moved(spark, rows, path):
    index_table.write_index_table(index.ip_index(rows(events(1), EVENTS)), path, 4)
    old = index_table.read_index_table(spark, path)
    changed = index.address_pairs(rows(events(3, 20), EVENTS))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in ("-1", before):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            plan = index_table.updated_index(old, changed)._jdf.queryExecution().executedPlan().toString()
            lines = plan.splitlines()
            for at, line in enumerate(lines):
                if "FileScan parquet" in line:
                    depth = len(line) - len(line.lstrip(" :+-|"))
                    above = [x for x in lines[:at]]
                    # going up from the scan to the join, no exchange is passed
                    level = depth
                    for other in reversed(above):
                        own = len(other) - len(other.lstrip(" :+-|"))
                        if own < level:
                            level = own
                            assert "Exchange" not in other, plan
                            if "Join" in other:
                                break
            assert plan.count("FileScan parquet") == 2 and ("Bucketed: true" in plan or threshold != "-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_nothing_changed(spark, rows, path):
    whole = index.ip_index(rows(events(1), EVENTS))
    index_table.write_index_table(whole, f"{path}-0", 2)
    none = rows([], f"{EVENTS}, op string")
    index_table.update_index_table(spark, f"{path}-0", f"{path}-1", none)
    assert lists(index_table.read_index_table(spark, f"{path}-1")) == lists(whole)
