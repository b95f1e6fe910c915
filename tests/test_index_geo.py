import ipaddress
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from nameledger.functions import ip
from nameledger.operators import geo, index, lookup, predecessor, rollups
from nameledger.session import shared_dir
from nameledger.sources import geo as geo_files
from nameledger.sources import intel as intel_files

STATE = "domain string, type string, value string, first_seen bigint, last_seen bigint"
INTEL = "ip string, domains array<string>, last_seen bigint"


def hot_state(rows):
    """One IP holds most of the rows."""
    hot = [(f"d{i:04d}.com", "A", "9.9.9.9", 1, i) for i in range(500)]
    cold = [(f"d{i % 7}.net", "A", f"1.1.1.{i}", 1, i) for i in range(50)]
    other = [("z.com", "AAAA", "::1", 1, 999), ("z.com", "CNAME", "y.com", 1, 1), ("z.com", "A", "bad", 1, 1)]
    return rows(hot + cold + other, STATE)


def test_a_hot_ip_is_split_and_stays_whole(rows):
    state = hot_state(rows)
    whole = {r.ip: (r.domains, r.last_seen) for r in index.ip_index(state).collect()}
    parts = index.ip_index(state, buckets=13)
    spread = [r for r in parts.collect() if r.ip == "9.9.9.9"]
    assert len(spread) == 13 and {r.part for r in spread} == set(range(13))
    assert max(len(r.domains) for r in spread) < 100
    assert {r.last_seen for r in spread} == {499}
    assert sorted(d for r in spread for d in r.domains) == whole["9.9.9.9"][0]
    assert {r.ip for r in parts.collect() if r.part == 0} == set(whole)
    assert "bad" in whole and "::1" not in whole

    again = {r.ip: (r.domains, r.last_seen) for r in index.merge_ip_index(parts, parts).collect()}
    assert again == whole
    assert lookup.latest_by_ip(parts).count() == parts.count()
    assert rollups.intel_summary(parts).first() == rollups.intel_summary(index.ip_index(state)).first()
    assert rollups.intel_summary(parts).first().records == len(whole)


def test_domain_views_and_resolve_in_parts(rows):
    state = hot_state(rows)
    many = rows([("h.com", "A", f"2.2.{i // 250}.{i % 250}", 1, i) for i in range(300)]
                + [("h.com", "CNAME", "c.com", 1, 400), ("q.com", "AAAA", "::1", 1, 5)], STATE)
    parts = lookup.resolve(many, buckets=7).where("domain = 'h.com'").collect()
    assert len(parts) > 1 and {r.last_seen for r in parts} == {400}
    assert len({ip for r in parts for ip in r.ips}) == 300
    assert [c for r in parts for c in r.cnames] == ["c.com"]
    assert lookup.resolve(many).where("domain = 'q.com'").first().last_seen == 0
    view = lookup.domain_view(index.ip_index(many)).where("domain = 'h.com'").first()
    assert [r.last_seen for r in view.ips] == list(range(299, -1, -1))
    assert index.distinct_ips(state).count() == 52


def test_lookups(rows):
    intel = rows([("1.1.1.1", ["a"], 5), ("1.1.1.1", ["b"], 7), ("2.2.2.2", ["b", "", "c"], 7),
                  ("3.3.3.3", [], 1)], INTEL)
    keys = rows([("1.1.1.1",), ("8.8.8.8",)], "ip string")
    got = {r.ip: (r.domains, r.found) for r in lookup.lookup_ips(intel, keys).collect()}
    assert got == {"1.1.1.1": (["b"], True), "8.8.8.8": (None, False)}
    names = rows([("b",), ("zz",)], "domain string")
    found = sorted((r.domain, r.ip or "", r.found) for r in lookup.lookup_domains(intel, names).collect())
    assert found == [("b", "1.1.1.1", True), ("b", "2.2.2.2", True), ("zz", "", False)]
    listed = lookup.lookup_domains(intel, names, with_lists=True).where("ip = '2.2.2.2'").first()
    assert listed.domains == ["b", "", "c"]
    assert sorted(r.domain for r in lookup.explode_domains(intel).collect()) == ["a", "b", "b", "c"]


def test_shard_limits(rows):
    state = hot_state(rows)
    assert lookup.inspect_shard(state, 1, 0).count() == 20
    assert lookup.query_domain(state, "Z.com.", -1).count() == 3
    assert lookup.get_key(state, "z.com", "AAAA", "::1").count() == 1
    with pytest.raises(ValueError):
        lookup.inspect_shard(state, 4)


def test_staging_and_snapshots(rows):
    staged = rows([("1.1.1.1 ", "a", 1, 5, "x"), ("1.1.1.1", "b", 1, 9, "x"), ("1.1.1.1", "a", 1, 6, "y"),
                   ("junk", "a", 1, 1, "x")],
                  "ip string, domain string, first_seen bigint, last_seen bigint, source_batch string")
    assert index.compact_staging(staged, "recent").first().domain == "b"
    assert index.compact_staging(staged, "frequent").first().domain == "a"
    old, new = (rows(d, "ip string, domain string") for d in (
        [("1", "a"), ("2", "b")], [("1", "a"), ("2", "c"), ("3", "d")]))
    got = {r.ip: r.change for r in index.changed_ips(old, new).collect()}
    assert got == {"2": "changed", "3": "new"}


# --- geo ---------------------------------------------------------------------------------------

GEO4 = "start bigint, end bigint, country string, city string"
GEO6 = "start binary, end binary, country string, city string"


def n(ip):
    return int(ipaddress.ip_address(ip))


def b(ip):
    return ipaddress.ip_address(ip).packed


def places(df):
    return {r.ip: (r.country, r.city) for r in df.collect()}


@pytest.mark.parametrize("broadcast_bytes", [10**6, 0])
def test_geo_hits_and_misses(rows, broadcast_bytes):
    v4 = rows([(n("10.0.0.0"), n("10.0.0.255"), "NL", "Delft"), (n("10.0.2.0"), n("10.0.3.9"), "X", ""),
               (9, 5, "BAD", "")], GEO4)
    v6 = rows([(b("2001:db8::"), b("2001:db8::ff"), "SE", "Lund")], GEO6)
    ips = ["10.0.0.77", "10.0.0.0", "10.0.0.255", "10.0.1.0", "9.255.255.255", "10.0.3.9", "10.0.3.10",
           "192.0.2.1", "::ffff:10.0.0.77", "2001:db8::1", "2001:db8::ff", "2001:db8::100",
           "2001:db8:ffff::1", "not-an-ip", " 10.0.0.77"]
    df = rows([(i,) for i in ips], "ip string")
    got = places(geo.geo_join(df, v4, v6, broadcast_bytes=broadcast_bytes))
    t4, t6, none = ("NL", "Delft"), ("SE", "Lund"), (None, None)
    want = [t4, t4, t4, none, none, ("X", None), none, none, t4, t6, t6, none, none, none, t4]
    assert [got[i] for i in ips] == want
    assert set(places(geo.geo_join(df)).values()) == {none}


def brute(number, ranges):
    """The range with the greatest start; then the earliest end; then the smallest names."""
    held = [r for r in ranges if r[0] <= number <= r[1]]
    best = min(held, key=lambda r: (-r[0], r[1], r[2], r[3]), default=None)
    return (best[2] or None, best[3] or None) if best else (None, None)


@pytest.mark.parametrize("broadcast_bytes", [10**8, 0])
def test_overlapping_ranges_against_brute_force(rows, broadcast_bytes):
    rng = random.Random(5)
    ranges = [(0, 2**32 - 1, "ALL", ""), (5, 5, "S1", ""), (5, 9, "S2", "")]
    for i in range(120):
        start = rng.choice([rng.randrange(2**32), 167772160 + rng.randrange(70000)])
        width = rng.choice([0, 3, 300, 5000, 70000])
        ranges.append((start, min(start + width, 2**32 - 1), f"C{i}", f"t{i}" if i % 3 else ""))
    numbers = {0, 2**32 - 1, 5, 6, 9, 10}
    for r in ranges:
        numbers |= {r[0], r[1], max(r[0] - 1, 0), min(r[1] + 1, 2**32 - 1), (r[0] + r[1]) // 2}
    ips = [str(ipaddress.IPv4Address(i)) for i in numbers]
    got = places(geo.geo_join(rows([(i,) for i in ips], "ip string"), v4=rows(ranges, GEO4), broadcast_bytes=broadcast_bytes))
    assert got == {i: brute(n(i), ranges) for i in ips}


@pytest.mark.parametrize("broadcast_bytes", [10**8, 0])
def test_ipv6_ranges_of_all_widths_against_brute_force(rows, broadcast_bytes):
    rng = random.Random(6)
    base, top = n("2001:db8::"), 2**128 - 1
    ranges = [(top, top, "top", ""), (top - 2**64 - 5, top - 2**64 + 5, "mid", "")]
    for i in range(60):
        start = base + rng.randrange(2**98) * rng.choice([0, 1])
        width = rng.choice([0, 255, 2**64, 2**80, 2**90, 2**97, 2**113])
        ranges.append((start, min(start + width, top), f"c{i}", "t"))
    numbers = {v for r in ranges for v in (r[0], r[1], r[0] - 1, min(r[1] + 1, top), (r[0] + r[1]) // 2)}
    ips = [str(ipaddress.IPv6Address(i)) for i in numbers]
    table = rows([(s.to_bytes(16, "big"), e.to_bytes(16, "big"), c, t) for s, e, c, t in ranges], GEO6)
    got = places(geo.geo_join(rows([(i,) for i in ips], "ip string"), v6=table, broadcast_bytes=broadcast_bytes))
    assert got == {i: brute(n(i), ranges) for i in ips}


@pytest.mark.parametrize("version", [4, 6])
def test_narrow_ranges_in_wide_ones_stay_apart(rows, version):
    """One wide range over many narrow ones: no block gets more rows than its own kind, and hits are right."""
    width, schema = (32, GEO4) if version == 4 else (128, GEO6)
    value = (lambda x: x) if version == 4 else (lambda x: x.to_bytes(16, "big"))
    base = n("10.0.0.0") if version == 4 else n("2001:db8::")
    gap = 2**4 if version == 4 else 2**48
    ranges = [(base, base + 3000 * gap, "wide", ""), (base, base + 40 * gap, "mid", "")]
    ranges += [(base + i * gap + 2, base + i * gap + gap // 2, f"n{i}", "") for i in range(3000)]
    table = geo.prepare_geo(rows([(value(s), value(e), c, t) for s, e, c, t in ranges], schema), version)
    fullest = table.pieces.groupBy("level", "block").count().agg({"count": "max"}).first()[0]
    assert fullest <= 64
    numbers = {base + i * gap + d for i in (0, 1, 39, 41, 2999) for d in (0, 2, gap // 2, gap // 2 + 1)} | {base - 1, base + 3000 * gap}
    ips = [str((ipaddress.IPv4Address if width == 32 else ipaddress.IPv6Address)(i)) for i in numbers]
    kind = {"v4": table} if version == 4 else {"v6": table}
    for broadcast_bytes in (10**8, 0):
        got = places(geo.geo_join(rows([(i,) for i in ips], "ip string"), **kind, broadcast_bytes=broadcast_bytes))
        assert got == {i: brute(n(i), ranges) for i in ips}


@pytest.mark.parametrize("parts", [1, 2, 70])
def test_carried_ranges_with_hot_addresses_and_bounds(spark, rows, parts):
    """Both versions at once: a hot address, ranges that start, end or lie at the bounds, and text that is no address."""
    draw = random.Random(parts)
    four = [(0, 2**32 - 1, "all", ""), (n("9.9.9.9"), n("9.9.9.9"), "one", ""), (n("9.9.0.0"), n("9.9.255.255"), "wide", "")]
    four += [(i * 2**24 + 7, i * 2**24 + draw.choice([7, 900, 2**23]), f"c{i}", "t") for i in range(200)]
    base = n("2001:db8::")
    six = [(base, base + 2**90, "wide6", ""), (base + 5, base + 5, "one6", "")]
    six += [(base + i * 2**80, base + i * 2**80 + draw.choice([0, 2**20, 2**79]), f"s{i}", "") for i in range(150)]
    ips = ["9.9.9.9"] * 900 + ["2001:db8::5"] * 500 + [None, "", "text", "::ffff:9.9.9.9"] * 30
    ips += [str(ipaddress.IPv4Address(v)) for r in four for v in (r[0], r[1], max(r[0] - 1, 0))]
    ips += [str(ipaddress.IPv6Address(v)) for r in six for v in (r[0], r[1], r[1] + 1)]
    v4, v6 = rows(four, GEO4), rows([(s.to_bytes(16, "big"), e.to_bytes(16, "big"), c, t) for s, e, c, t in six], GEO6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = geo.geo_join(rows([(i, j) for j, i in enumerate(ips)], "ip string, part int"), v4=v4, v6=v6, broadcast_bytes=0).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(r.part for r in got) == list(range(len(ips)))

    def want(ip):
        if not ip or ip == "text":
            return None, None
        address = ipaddress.ip_address(ip)
        mapped = getattr(address, "ipv4_mapped", None)
        return brute(int(mapped or address), four if mapped or address.version == 4 else six)

    known = {ip: want(ip) for ip in set(ips)}
    assert all((r.country, r.city) == known[r.ip] and ips[r.part] == r.ip for r in got)


def test_carried_ranges_take_one_exchange_and_split_a_hot_address(spark, rows):
    ranges = rows([(i * 1000, i * 1000 + 900, f"c{i}", "") for i in range(2000)] + [(2**31, 2**31 + 2**24 - 1, "wide", "")], GEO4)
    table = geo.prepare_geo(ranges)
    assert len(table.levels) == 3
    df = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN '0.0.3.232' ELSE concat('128.77.', id % 200, '.1') END AS ip", "id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        points = df.select(F.lit(1).alias("x"), ip.ipv4_to_long("ip").alias("n"))
        (mine,) = predecessor.deal(points, [F.col("n")], 16)
        assert Counter(mine.bounds)[1000] >= 6  # half of the rows, so half of the parts
        joined = geo.geo_join(df, v4=table, broadcast_bytes=0)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        top = plan[: plan.index("Union")]
        assert top.count("Exchange") == 1 and "Join" not in plan
        assert joined.groupBy("country").count().where("country = 'c1'").first()["count"] == 2000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_place_of_is_a_search(spark):
    for size in (0, 1, 5, 64, 65, 500):
        bounds = [3 * i for i in range(size)]
        got = spark.range(-2, 3 * size + 3).select("id", predecessor.place_of(F.col("id"), bounds).cast("int").alias("p")).collect()
        assert all(r.p == sum(b < r.id for b in bounds) for r in got)


def test_prepared_table_and_plan(spark, rows):
    ranges = rows([(i * 1000, i * 1000 + 900, f"c{i}", "") for i in range(2000)]
                  + [(2**31, 2**31 + 2**24 - 1, "wide", "")], GEO4)
    table = geo.prepare_geo(ranges)
    assert len(table.levels) == 3 and table.size < 2_000_000
    df = rows([("0.0.3.232",), ("128.77.1.1",)], "ip string")
    joined = geo.geo_join(df, v4=table)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert places(joined) == {"0.0.3.232": ("c1", None), "128.77.1.1": ("wide", None)}


def test_overlay_keeps_what_it_cannot_improve(rows):
    intel = rows([("10.0.0.1", "ZZ", "Old"), ("10.0.9.1", "ZZ", "Old"), ("10.0.9.2", "", None)],
                 "ip string, country string, city string")
    v4 = rows([(n("10.0.0.0"), n("10.0.0.9"), "TC", "")], GEO4)
    assert places(geo.overlay_geo(intel, v4)) == {
        "10.0.0.1": ("TC", "Old"), "10.0.9.1": ("ZZ", "Old"), "10.0.9.2": (None, None)}


def folder(spark, what):
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def write_lines(spark, lines, what):
    path = folder(spark, what)
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def ranges_of(df):
    return sorted((r.start, r.end, r.country, r.city) for r in df.collect())


def test_headerless_geo_csv(spark):
    path = write_lines(spark, ["1.0.1.0,1.0.3.255,CN,x,y, City ,z", "1.0.4.0,1.0.4.9,US", "1.0.5.0,1.0.5.1,",
                               "1.0.6.0,1.0.6.1", "1.0.9.0,1.0.8.0,XX", "2001:db8::,2001:db8::f,V6", "junk"], "geo")
    assert ranges_of(geo_files.read_geo_csv(spark, path, 4)) == [
        (n("1.0.1.0"), n("1.0.3.255"), "CN", "City"), (n("1.0.4.0"), n("1.0.4.9"), "US", ""),
        (n("1.0.5.0"), n("1.0.5.1"), "", "")]
    assert ranges_of(geo_files.read_geo_csv(spark, path, 6)) == [
        (b("2001:db8::"), b("2001:db8::f"), "V6", "")]


def test_a_folder_may_mix_layouts(spark):
    path = folder(spark, "mixed geo")
    kinds = [
        ["1.0.0.0,1.0.0.9,XX,a,b,Plain"],
        ["network,country_iso_code,city_name", "2.0.0.0/24,NL,Delft"],
        ["city,country,end_ip,start_ip", "Lund,SE,3.0.0.9,3.0.0.0"],
        ["4.0.0.0,4.0.0.9,YY,a,b,Other", "5.0.0.0,5.0.0.9,ZZ,a,b,"],
        ["network,country_iso_code,city_name", "6.0.0.0/24,FI,"],
    ]
    for i, lines in enumerate(kinds):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{path}/f={i}")
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/f=9")
    assert sorted(len(p) for p in geo_files.layouts(spark, f"{path}/*").values()) == [1, 2, 2]
    assert ranges_of(geo_files.read_geo_csv(spark, f"{path}/*", 4)) == [
        (n("1.0.0.0"), n("1.0.0.9"), "XX", "Plain"), (n("2.0.0.0"), n("2.0.0.255"), "NL", "Delft"), (n("3.0.0.0"), n("3.0.0.9"), "SE", "Lund"),
        (n("4.0.0.0"), n("4.0.0.9"), "YY", "Other"), (n("5.0.0.0"), n("5.0.0.9"), "ZZ", ""), (n("6.0.0.0"), n("6.0.0.255"), "FI", ""),
    ]
    assert geo_files.read_geo_csv(spark, f"{path}/f=9", 4).count() == 0


def test_summaries_from_sketches(spark, rows):
    draw = random.Random(3)
    data = [(f"1.{i // 250}.{i % 250}.1", i % 2, [f"d{draw.randrange(5000)}.com" for _ in range(3)], i, "NL" if i % 3 else None) for i in range(8000)]
    intel = rows(data, "ip string, part int, domains array<string>, last_seen bigint, country string")
    exact = rollups.intel_summary(intel).first()
    united = rollups.united_summary(rollups.summary_sketches(intel.withColumn("by", F.col("last_seen") % 7), "by")).first()
    assert (united.records, united.enriched) == (exact.records, exact.enriched)
    for name in ("unique_ips", "unique_domains"):
        assert abs(united[name] - exact[name]) <= 4 * 0.0082 * exact[name]
    assert rollups.united_summary(rollups.summary_sketches(intel.where("false").withColumn("by", F.lit(1)), "by")).first().asDict() == {
        "records": 0, "unique_ips": 0, "unique_domains": 0, "enriched": 0}


def test_headered_geo_csv(spark):
    cidr = write_lines(spark, ["network,country_code,country,city", "1.0.0.7/24,,AU,Sydney", "bad,X,Y,Z",
                               "2001:db8::/120,DE,,"], "geo")
    assert ranges_of(geo_files.read_geo_csv(spark, cidr, 4)) == [
        (n("1.0.0.0"), n("1.0.0.255"), "AU", "Sydney")]
    assert ranges_of(geo_files.read_geo_csv(spark, cidr, 6)) == [
        (b("2001:db8::"), b("2001:db8::ff"), "DE", "")]
    ends = write_lines(spark, ["start_ip,end_ip,country_iso_code,city_name", "1.0.0.0,1.0.0.9,AU, X ",
                               "1.0.0.9,1.0.0.0,AU,X"], "geo")
    assert ranges_of(geo_files.read_geo_csv(spark, ends, 4)) == [(n("1.0.0.0"), n("1.0.0.9"), "AU", "X")]
    assert geo_files.has_header("a,1") and not geo_files.has_header("1.0.0.0,1.0.0.1,X")


def test_intel_files(spark, rows):
    path = write_lines(spark, ['{"ip":"1.1.1.1","domains":["a","b"],"last_seen":5,"country":""}', "", "junk",
                               '{"ip":"","domains":["x"]}', '{"domains":["x"]}', '{"ip":"2.2.2.2","domain":"old"}',
                               '{"ip":"3.3.3.3","domains":[],"last_seen":"soon","city":"C"}'], "intel")
    back = {r.ip: r for r in intel_files.read_ip_intel(spark, path).collect()}
    assert set(back) == {"1.1.1.1", "2.2.2.2", "3.3.3.3"}
    assert (back["1.1.1.1"].domains, back["1.1.1.1"].last_seen, back["1.1.1.1"].country) == (["a", "b"], 5, None)
    assert (back["2.2.2.2"].domains, back["3.3.3.3"].last_seen) == ([], 0)
    flat = {r.ip: r.domain for r in intel_files.ip_geo(intel_files.read_ip_intel(spark, path)).collect()}
    assert flat == {"1.1.1.1": "a", "2.2.2.2": "old"}

    out = folder(spark, "out")
    state = rows([("b.com", "A", "10.0.0.2", 1, 2), ("a.com", "A", "10.0.0.2", 1, 3), ("a.com", "A", "10.0.0.10", 1, 4)],
                 STATE)
    intel_files.write_ip_index(index.ip_index(state), out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines == ['{"ip":"10.0.0.10","domains":["a.com"],"last_seen":4}',
                     '{"ip":"10.0.0.2","domains":["a.com","b.com"],"last_seen":3}']
    listed = write_lines(spark, [" 1.1.1.1 ", "", "2.2.2.2"], "ips")
    assert [r.ip for r in intel_files.read_ip_list(spark, listed).collect()] == ["1.1.1.1", "2.2.2.2"]
    out = folder(spark, "geo")
    intel_files.write_ip_geo(rows([("1", "a", "", None)], "ip string, domain string, country string, city string"), out)
    assert [r.value for r in spark.read.text(out).collect()] == ['{"ip":"1","domain":"a"}']


def test_outputs_are_replaced_as_a_whole(spark, rows):
    from datetime import datetime, timezone

    root, moment = folder(spark, "out"), datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    assert intel_files.current_output(spark, root) is None
    first = intel_files.replace_output(rows([("1",)], "ip string"), root, now=moment)
    assert first.endswith("/intel-20240102030405")
    second = intel_files.replace_output(rows([("2",)], "ip string"), root)
    assert intel_files.current_output(spark, root) == second
    assert intel_files.current_output(spark, root, back=1) == first
    assert spark.read.json(first).first().ip == "1"


def test_rollups(rows):
    entry = "array<struct<domain string, answer_ips array<string>, final_domain string, temporal struct<ttl bigint, query_count bigint>>>"
    feeds = rows([("s", 3_600_000_000, [("cdn.a", ["1", "2"], "www.google.com", (60, 7)),
                                        ("b", ["1"], "tiktok.com", (61, 4)), ("c", None, None, None)])],
                 f"device_id string, timestamp bigint, domain_correlations {entry}")
    stats = rollups.feed_stats(feeds).first()
    assert tuple(stats)[2:] == (3, 11, 3, 7, 4)
    assert tuple(rollups.infra_patterns(feeds).first())[2:] == (1, 1, 1)
    assert tuple(rollups.behavior(feeds).first())[2:] == (121 / 3, 2)
    assert tuple(rollups.peak_hour(feeds).first()) == ("s", 1, 11)
