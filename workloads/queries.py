"""One registered query per operator, each with the SQL that gives the same rows on DuckDB.

Every query reads whole tables. Arrays are compared as joined text, counts and times as BIGINT.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nameledger.functions import domains as D
from nameledger.functions import ip as IP
from nameledger.functions import records as R
from nameledger.operators import fold, geo, index, ingest, keyed, lookup, merging, rollups
from nameledger.plans import intel as plans
from nameledger.session import shared_dir
from nameledger.sources import geo as geo_files
from nameledger.sources import index_table
from nameledger.sources import intel as intel_files
from nameledger.sources import messages, state as state_table
from nameledger.streaming import queries as streams
from workloads import inputs as I

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = I.oracle(oracle)
        return fn

    return keep


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def _text(array: str | Column) -> Column:
    return F.array_join(array, ",")


def _big(*names: str) -> dict[str, Column]:
    return {n: F.col(n).cast("bigint") for n in names}


# --- shared stages -----------------------------------------------------------------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.raw_to_events(I.dns_raw(spark, sf))


def _all_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events of every type, as when they are published without the raw path's type filter."""
    named = ingest.classify_raw(I.dns_raw(spark, sf))
    return named.where(F.col("name").isNotNull() & (F.trim("value") != "")).select(
        F.col("name").alias("domain"),
        "type",
        F.trim("value").alias("value"),
        F.col("timestamp").alias("first_seen"),
        F.col("timestamp").alias("last_seen"),
        "device_id",
    )


def _state(spark: SparkSession, sf: str) -> DataFrame:
    return fold.fold_events(_events(spark, sf))


def _state_all(spark: SparkSession, sf: str) -> DataFrame:
    return fold.fold_events(_all_events(spark, sf))


def _ip_index(spark: SparkSession, sf: str) -> DataFrame:
    return index.ip_index(_state(spark, sf))


def _intel(spark: SparkSession, sf: str) -> DataFrame:
    return geo.geo_join(_ip_index(spark, sf), v4=I.geo_v4(spark, sf))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """One index record per (IP, domain), so that IPs have several."""
    return index.address_pairs(_state(spark, sf)).select(
        "ip", F.array("domain").alias("domains"), "last_seen"
    )


# --- ingest ------------------------------------------------------------------------------------


@register("SELECT domain, type, value, first_seen, last_seen, device_id FROM dns_events")
def raw_to_events(spark, sf):
    return _events(spark, sf)


@register(
    """SELECT event_id, CASE WHEN trim(domain) = '' THEN 'blank domain'
         WHEN trim(value) = '' THEN 'blank value' WHEN name IS NULL THEN 'bad domain'
         ELSE 'unsupported type' END AS reason
       FROM raw_named
       WHERE trim(domain) = '' OR trim(value) = '' OR name IS NULL OR type NOT IN ('A', 'CNAME')"""
)
def raw_rejects(spark, sf):
    return ingest.raw_rejects(I.dns_raw(spark, sf)).select("event_id", "reason")


@register("SELECT domain, type, value, first_seen, last_seen, device_id FROM dns_events")
def parse_raw_messages(spark, sf):
    return ingest.raw_to_events(messages.parse_raw(I.raw_messages(spark, sf)))


@register(
    """SELECT domain, type, value, timestamp AS first_seen, timestamp AS last_seen, device_id
       FROM dns_raw WHERE event_id % 3 IN (0, 1)"""
)
def parse_event_messages(spark, sf):
    return messages.parse_events(I.event_messages(spark, sf))


@register(
    """SELECT 'not json' AS value, 'no parsable events' AS reason FROM dns_raw
       WHERE event_id % 3 = 2"""
)
def unparsed_event_messages(spark, sf):
    return messages.unparsed_events(I.event_messages(spark, sf))


def _mixed(spark, sf):
    junk = I.event_messages(spark, sf).where("value = 'not json'")
    return I.raw_messages(spark, sf).unionAll(I.feed_messages(spark, sf)).unionAll(junk)


@register(
    """SELECT 'raw' AS shape, count(*) AS n FROM dns_raw
       UNION ALL SELECT 'feed', count(DISTINCT (device_id, day)) FROM feed_rows
       UNION ALL SELECT 'rejected', count(*) FROM dns_raw WHERE event_id % 3 = 2"""
)
def route_messages(spark, sf):
    raw, feed, rejects = messages.route_messages(_mixed(spark, sf))
    shapes = [(raw, "raw"), (feed, "feed"), (rejects, "rejected")]
    counted = [d.groupBy(F.lit(name).alias("shape")).agg(F.count("*").alias("n")) for d, name in shapes]
    return counted[0].unionAll(counted[1]).unionAll(counted[2])


@register(
    """SELECT domain, type, value, first_seen, last_seen, device_id FROM dns_events
       UNION ALL SELECT domain, type, value, first_seen, last_seen, device_id FROM feed_events"""
)
def messages_to_events(spark, sf):
    return ingest.message_events(_mixed(spark, sf))


@register(
    """SELECT domain, type, value, first_seen, last_seen, device_id FROM dns_events
       UNION ALL SELECT domain, type, value, first_seen, last_seen, device_id FROM feed_events"""
)
def messages_to_event_arrays(spark, sf):
    """The same by way of one array of events per message, as the normaliser publishes them."""
    return ingest.events_of(ingest.messages_to_events(_mixed(spark, sf)))


@register("SELECT domain, type, value, first_seen, last_seen, device_id FROM feed_events")
def feed_to_events(spark, sf):
    return ingest.feed_to_events(I.feeds(spark, sf))


@register(
    """SELECT domain, type, value, first_seen, last_seen, device_id FROM feed_events
       WHERE NOT feed_has_blank"""
)
def messages_strict(spark, sf):
    """The same feeds as messages among others that give no events."""
    junk = I.event_messages(spark, sf).where("value = 'not json'")
    sent = I.feed_messages(spark, sf).unionAll(junk)
    return ingest.events_of(ingest.messages_to_events(sent, mode="strict"))


@register(
    """SELECT domain, type, value, first_seen, last_seen, device_id FROM feed_events
       WHERE NOT feed_has_blank"""
)
def typed_answers(spark, sf):
    """Typed by their address; the feeds' addresses are IPv4."""
    return ingest.feed_to_events(I.feeds(spark, sf), mode="strict", typed_answers=True)


@register(
    """SELECT domain, type, value, first_seen, last_seen, device_id FROM feed_events
       WHERE NOT feed_has_blank"""
)
def feed_to_events_strict(spark, sf):
    return ingest.feed_to_events(I.feeds(spark, sf), mode="strict")


@register(
    """SELECT device_id, feed_ts AS timestamp,
         concat('domain is required for domain_correlations[',
                min(pos) FILTER (WHERE trim(domain) = ''), ']') AS reason
       FROM feed_entries GROUP BY device_id, day, feed_ts HAVING bool_or(trim(domain) = '')"""
)
def validate_feed_reasons(spark, sf):
    return ingest.feed_rejects(I.feeds(spark, sf)).select("device_id", "timestamp", "reason")


@register("SELECT device_id, count(*) AS n_events FROM feed_events GROUP BY 1")
def feed_message_events(spark, sf):
    feeds = messages.parse_feed(I.feed_messages(spark, sf))
    return ingest.feed_to_events(feeds).groupBy("device_id").agg(F.count("*").alias("n_events"))


# --- functions ---------------------------------------------------------------------------------

_HOST = r"regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)"


@register(
    rf"""SELECT page_id, regexp_replace(lower({_HOST}), '\.+$', '') AS domain,
           (('0x' || substr(sha256(regexp_replace(lower({_HOST}), '\.+$', '')), 1, 8))::UBIGINT % 4)
             ::BIGINT AS shard
         FROM pages"""
)
def normalize_domain_pages(spark, sf):
    # Upper case and trailing dots are put on so that there is something to undo.
    messy = F.concat(F.lit(" "), F.upper("host"), F.lit(".. "))
    named = I.page_hosts(spark, sf).select("page_id", D.normalize_domain(messy).alias("domain"))
    return named.withColumn("shard", D.shard_id("domain").cast("bigint"))


@register("SELECT domain, hash, shard FROM shards")
def shard_id(spark, sf):
    names = _all_events(spark, sf).select("domain").distinct()
    return names.select(
        "domain", D.domain_hash("domain").alias("hash"), D.shard_id("domain").cast("bigint").alias("shard")
    )


@register(
    """SELECT shard AS shard_id, count(*) AS distinct_keys FROM state JOIN shards USING (domain)
       GROUP BY 1"""
)
def shard_distribution(spark, sf):
    return fold.shard_distribution(_events(spark, sf)).withColumns(_big("shard_id"))


@register(
    r"""SELECT event_id, regexp_replace(lower(trim(domain)), '\.$', '') AS domain FROM dns_raw"""
)
def normalize_domain_lite(spark, sf):
    return I.dns_raw(spark, sf).select("event_id", D.normalize_domain_lite("domain").alias("domain"))


@register(
    """SELECT event_id, contains(final_domain, 'google') AS is_google, value LIKE '%cdn.%' AS is_cdn,
         regexp_matches(final_domain, 'facebook|instagram|tiktok') AS is_social,
         regexp_matches(final_domain, 'facebook|instagram') AS is_facebook_related,
         contains(final_domain, 'whatsapp') AS is_whatsapp_related
       FROM feed_rows JOIN dns_raw USING (event_id)"""
)
def domain_tags(spark, sf):
    raw = I.dns_raw(spark, sf).select("event_id", "value")
    brands = I.table(spark, sf, "events").selectExpr("event_id", f"{I._BRAND} AS final_domain")
    tags = D.domain_tags("value", "final_domain")
    return raw.join(brands, "event_id").select("event_id", *[c.alias(n) for n, c in tags.items()])


@register(
    """SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'xn--mnchen-3ya.example' WHEN 1 THEN 'xn--fa-hia.de'
         WHEN 2 THEN 'xn--wgv71a.jp' WHEN 3 THEN 'example.com' WHEN 4 THEN 'xn--bcher-kva.example'
         WHEN 7 THEN 'host' || event_id || '.example.org' END AS domain FROM dns_raw"""
)
def normalize_domain_idna(spark, sf):
    """Names beyond ASCII, from a list of literals; two of them are no valid names."""
    given = F.array(*map(F.lit, ["München.Example.", "faß.de", "日本.jp", " EXAMPLE.com", "xn--bcher-kva.example", "-bad.com", "a_b.com"]))
    place = F.col("event_id") % 8
    names = F.when(place == 7, F.concat(F.lit("Host"), F.col("event_id").cast("string"), F.lit(".example.org")))
    raw = I.dns_raw(spark, sf).select("event_id", names.otherwise(F.get(given, place.cast("int"))).alias("domain"))
    return D.with_domain(raw, "domain", "name").select("event_id", F.col("name").alias("domain"))


@register(
    """SELECT domain || '|' || type || '|' || value AS key, domain, type, value FROM state"""
)
def parse_key(spark, sf):
    keyed_rows = _state(spark, sf).select(R.make_key("domain", "type", "value").alias("key"))
    return keyed_rows.select("key", R.parse_key("key").alias("_k")).select("key", "_k.*")


@register("SELECT domain, type, value, first_seen, last_seen FROM state")
def decode_kv(spark, sf):
    stored = _state(spark, sf).select(
        R.make_key("domain", "type", "value").alias("key"),
        F.to_json(F.struct("first_seen", "last_seen")).alias("value"),
    )
    torn = stored.select(F.substring_index("key", "|", 2).alias("key"), F.lit("{").alias("value"))
    return state_table.decode_kv(stored.unionAll(torn))


@register(
    r"""SELECT event_id, CASE WHEN regexp_full_match(value, '\d+\.\d+\.\d+\.\d+') THEN 4
          WHEN value LIKE '2001:db8::%' THEN 6 ELSE 0 END::BIGINT AS version,
          CASE WHEN regexp_full_match(value, '\d+\.\d+\.\d+\.\d+') THEN value || '/32'
          WHEN value LIKE '2001:db8::%' THEN value || '/128' END AS network
        FROM dns_raw"""
)
def ip_version(spark, sf):
    return I.dns_raw(spark, sf).select(
        "event_id",
        IP.ip_version("value").cast("bigint").alias("version"),
        IP.host_network("value").alias("network"),
    )


@register(
    r"""SELECT event_id, CASE
          WHEN regexp_full_match(value, '\d+\.\d+\.\d+\.\d+') THEN
            '00000000000000000000ffff' || lpad(lower(hex(
              split_part(value, '.', 1)::BIGINT * 16777216 + split_part(value, '.', 2)::BIGINT * 65536
              + split_part(value, '.', 3)::BIGINT * 256 + split_part(value, '.', 4)::BIGINT)), 8, '0')
          WHEN value LIKE '2001:db8::%' THEN
            '20010db8' || lpad(substr(value, 11), 24, '0') END AS bytes16
        FROM dns_raw"""
)
def ip_to_bytes16(spark, sf):
    return I.dns_raw(spark, sf).select(
        "event_id", F.lower(F.hex(IP.ip_to_bytes16("value"))).alias("bytes16")
    )


_OCTETS = "event_id % 256 AS a, user_id % 256 AS b"


@register(
    f"""SELECT event_id, NOT (a IN (0, 10, 127) OR a >= 224 OR (a = 172 AND b BETWEEN 16 AND 31)
          OR (a = 192 AND b = 168) OR (a = 169 AND b = 254)) AS is_public
        FROM (SELECT event_id, {_OCTETS} FROM events)"""
)
def public_ipv4(spark, sf):
    spread = I.table(spark, sf, "events").selectExpr("event_id", _OCTETS.split(",")[0], _OCTETS.split(",")[1])
    ip = F.concat_ws(".", "a", "b", F.lit("3"), F.lit("4"))
    return spread.select("event_id", IP.is_public_ipv4(ip).alias("is_public"))


@register(
    f"""SELECT event_id, (n // (1::BIGINT << (32 - bits))) * (1::BIGINT << (32 - bits)) AS low,
          (n // (1::BIGINT << (32 - bits)) + 1) * (1::BIGINT << (32 - bits)) - 1 AS high
        FROM (SELECT event_id, a * 16777216 + b * 65536 + 772 AS n, event_id % 33 AS bits
              FROM (SELECT event_id, {_OCTETS} FROM events))"""
)
def cidr_range(spark, sf):
    block = "concat(event_id % 256, '.', user_id % 256, '.3.4/', event_id % 33) AS block"
    blocks = I.table(spark, sf, "events").selectExpr("event_id", block)
    ends = blocks.select("event_id", IP.cidr_range_v4("block").alias("_r"))
    return ends.select("event_id", F.col("_r.start").alias("low"), F.col("_r.end").alias("high"))


@register(
    """SELECT event_id, '20010DB8' || printf('%04X', (event_id % 65536)::INT) || repeat('0', 20) AS low,
         '20010DB8' || printf('%04X', (event_id % 65536)::INT)
           || CASE event_id % 3 WHEN 0 THEN repeat('F', 20) WHEN 1 THEN '0000' || repeat('F', 16) ELSE repeat('0', 18) || 'FF' END AS high
       FROM dns_raw"""
)
def cidr_range_v6(spark, sf):
    """Blocks of /48, /64 and /120."""
    group = F.lower(F.hex(F.col("event_id") % 65536))
    bits = F.element_at(F.array(F.lit("/48"), F.lit("/64"), F.lit("/120")), (F.col("event_id") % 3 + 1).cast("int"))
    block = F.concat(F.lit("2001:db8:"), group, F.lit("::"), bits)
    ends = I.dns_raw(spark, sf).select("event_id", IP.cidr_range_v6(block).alias("_r"))
    return ends.select("event_id", F.hex("_r.start").alias("low"), F.hex("_r.end").alias("high"))


@register(
    """SELECT event_id, strftime(make_timestamp(timestamp), '%Y-%m-%d %H:%M:%S') AS ts, timestamp AS micros
       FROM dns_raw"""
)
def micros_and_timestamps(spark, sf):
    stamped = I.dns_raw(spark, sf).select("event_id", R.to_ts("timestamp").alias("t"))
    return stamped.select(
        "event_id",
        F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        R.to_micros("t").alias("micros"),
    )


# --- state -------------------------------------------------------------------------------------


@register("SELECT domain, type, value, first_seen, last_seen FROM state")
def fold_events(spark, sf):
    return _state(spark, sf)


@register(
    """SELECT domain, type, value, min(first_seen) AS first_seen, max(last_seen) AS last_seen
       FROM dns_events GROUP BY 1, 2, 3"""
)
def fold_events_zero_sticks(spark, sf):
    return fold.fold_events(_events(spark, sf), zero_is_missing=False)


def _by_device(spark, sf):
    """The events of odd and of even sensors, as two batches that together are all of them."""
    events = _events(spark, sf)
    odd = F.substring_index("device_id", "_", -1).cast("int") % 2 == 1
    return events.where(odd), events.where(~odd)


@register("SELECT domain, type, value, first_seen, last_seen FROM state")
def merge_state(spark, sf):
    first, second = _by_device(spark, sf)
    return fold.merge_state(fold.fold_events(first), second)


@register(
    """SELECT domain, type, value, first_seen, last_seen, shard AS shard_id
       FROM state JOIN shards USING (domain)"""
)
def upsert_state(spark, sf):
    """Two batches into a stored table, the second one sent twice."""
    path = _scratch(spark, "state")
    first, second = _by_device(spark, sf)
    state_table.upsert_state(spark, path, first)
    state_table.upsert_state(spark, path, second)
    state_table.upsert_state(spark, path, second)
    return state_table.read_state(spark, path).withColumns(_big("shard_id"))


@register(
    """SELECT domain, type, value, coalesce(min(nullif(first_seen, 0)), 0) AS first_seen,
         coalesce(max(nullif(last_seen, 0)), 0) AS last_seen
       FROM dns_events WHERE split_part(device_id, '_', 2)::INT % 2 = 1 GROUP BY 1, 2, 3"""
)
def read_state_pinned(spark, sf):
    """An earlier version, read after a later one was written."""
    path = _scratch(spark, "state")
    first, second = _by_device(spark, sf)
    pinned = state_table.upsert_state(spark, path, first)
    state_table.bulk_upsert(spark, path, fold.fold_events(second))
    return state_table.read_state(spark, path, version=pinned.version).drop("shard_id")


@register("SELECT domain, type, value, first_seen, last_seen FROM state")
def compact_state(spark, sf):
    """Four batches, merged into one folder a shard."""
    path = _scratch(spark, "state")
    for batch in (*_by_device(spark, sf), *_by_device(spark, sf)):
        state_table.upsert_state(spark, path, batch)
    made = state_table.compact_state(spark, path)
    return state_table.read_state(spark, path, version=made.version).drop("shard_id")


@register(
    """WITH named AS (SELECT *, domain || '|' || type || '|' || value AS key, split_part(device_id, '_', 2)::INT % 2 = 1 AS odd FROM dns_events),
       deleted AS (SELECT DISTINCT key FROM named WHERE odd AND type = 'CNAME'),
       puts AS (SELECT *, CASE WHEN odd THEN 1 ELSE 2 END AS position FROM named
         UNION ALL SELECT *, 5 FROM named WHERE odd AND type = 'A')
       SELECT domain, type, value, coalesce(min(nullif(first_seen, 0)), 0) AS first_seen, coalesce(max(nullif(last_seen, 0)), 0) AS last_seen
       FROM puts WHERE position > greatest(CASE WHEN key >= 'error' AND key < 'view.' THEN 4 ELSE -1 END,
         CASE WHEN key IN (SELECT key FROM deleted) THEN 3 ELSE -1 END) GROUP BY 1, 2, 3"""
)
def state_deletes(spark, sf):
    """Deletes of keys and of a range between batches that come late, twice, or after them; compacted half way."""
    path = _scratch(spark, "state")
    odd, even = _by_device(spark, sf)
    state_table.upsert_state(spark, path, odd, position=1)
    state_table.delete_state(spark, path, odd.where("type = 'CNAME'"), position=3)
    state_table.delete_state_range(spark, path, "error", "view.", position=4)
    state_table.compact_state(spark, path)
    state_table.upsert_state(spark, path, even, position=2)
    state_table.upsert_state(spark, path, odd.where("type = 'A'"), position=5)
    state_table.upsert_state(spark, path, odd, position=1)
    made = state_table.compact_state(spark, path, settled=5)
    return state_table.read_state(spark, path, made.version).drop("shard_id")


@register(
    """WITH ops AS (SELECT name AS domain, type, trim(value) AS value, timestamp, event_id AS seq, event_id % 13 = 0 AS gone
         FROM raw_named WHERE name IS NOT NULL AND trim(value) <> ''),
       last AS (SELECT domain, type, value, coalesce(max(seq) FILTER (WHERE gone), -1) AS hidden FROM ops GROUP BY 1, 2, 3)
       SELECT domain, type, value, coalesce(min(nullif(timestamp, 0)), 0) AS first_seen, coalesce(max(nullif(timestamp, 0)), 0) AS last_seen
       FROM ops JOIN last USING (domain, type, value) WHERE NOT gone AND seq > hidden GROUP BY 1, 2, 3"""
)
def state_change_batches(spark, sf):
    """Ordered puts and deletes in two batches, whose order is not that of their rows."""
    path = _scratch(spark, "state")
    named = ingest.classify_raw(I.dns_raw(spark, sf)).where(F.col("name").isNotNull() & (F.trim("value") != ""))
    time, gone = F.col("timestamp"), F.col("event_id") % 13 == 0
    ops = named.select(
        F.col("name").alias("domain"), "type", F.trim("value").alias("value"), F.col("event_id").alias("seq"), gone.alias("is_delete"),
        F.when(~gone, time).alias("first_seen"), F.when(~gone, time).alias("last_seen"),
    )
    state_table.apply_state_changes(spark, path, ops.where("seq % 3 <> 0"))
    state_table.apply_state_changes(spark, path, ops.where("seq % 3 = 0"))
    return state_table.read_state(spark, path).drop("shard_id")


def _stored_64(spark, sf):
    """The state in a stored table of 64 shards, in two batches."""
    path = _scratch(spark, "state")
    state = _state_all(spark, sf)
    even = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    state_table.upsert_state(spark, path, state.where(even), n_shards=64)
    state_table.upsert_state(spark, path, state.where(~even))
    return state_table.read_state(spark, path)


# --- index -------------------------------------------------------------------------------------


@register("SELECT ip, domains, last_seen FROM ip_index")
def ip_index(spark, sf):
    return _ip_index(spark, sf).select("ip", _text("domains").alias("domains"), "last_seen")


@register(
    """SELECT ip, string_agg(domain, ',' ORDER BY shard, domain) AS domains,
         max(last_seen) AS last_seen
       FROM ip_pairs JOIN shards USING (domain) GROUP BY 1"""
)
def ip_index_shard_order(spark, sf):
    out = index.ip_index(_state(spark, sf), shard_order=4)
    return out.select("ip", _text("domains").alias("domains"), "last_seen")


@register("SELECT p.ip, p.domain, i.last_seen FROM ip_pairs p JOIN ip_index i USING (ip)")
def ip_index_exploded(spark, sf):
    """Index rows in up to four parts for each IP."""
    parts = index.ip_index(_state(spark, sf), buckets=4)
    return lookup.explode_domains(parts).select("ip", "domain", "last_seen")


@register("SELECT ip, domains, last_seen FROM ip_index")
def merge_ip_index(spark, sf):
    first, second = _by_device(spark, sf)
    merged = index.merge_ip_index(
        index.ip_index(fold.fold_events(first)), index.ip_index(fold.fold_events(second))
    )
    return merged.select("ip", _text("domains").alias("domains"), "last_seen")


@register("SELECT ip, domains, last_seen FROM ip_index")
def ip_index_bucketed(spark, sf):
    """The parts of every IP put together again."""
    parts = index.merge_ip_index(*[index.ip_index(_state(spark, sf), buckets=4)] * 2, buckets=4)
    whole = parts.select("ip", "last_seen", F.explode("domains").alias("domain")).groupBy("ip", "last_seen")
    return whole.agg(_text(F.array_sort(F.collect_list("domain"))).alias("domains"))


@register(
    """SELECT ip, arg_min(domain, (shard, domain)) AS domain FROM ip_pairs JOIN shards USING (domain)
       GROUP BY 1"""
)
def ip_first_domain(spark, sf):
    return index.ip_first_domain(_state(spark, sf))


@register(
    r"""SELECT DISTINCT value AS ip FROM state_all WHERE type IN ('A', 'AAAA')
        AND (regexp_full_match(value, '\d+\.\d+\.\d+\.\d+') OR value LIKE '2001:db8::%')"""
)
def distinct_ips(spark, sf):
    return index.distinct_ips(_state_all(spark, sf))


@register("SELECT ip, domains, last_seen FROM ip_index")
def update_ip_index(spark, sf):
    """A bucketed index of half the events, brought up to date by what the other half changed in the stored state."""
    path = _scratch(spark, "state")
    first, second = _by_device(spark, sf)
    old = state_table.upsert_state(spark, path, first)
    index_table.write_index_table(index.ip_index(state_table.read_state(spark, path)), f"{path}-index", 8)
    state_table.upsert_state(spark, path, second)
    index_table.update_index_table(spark, f"{path}-index", f"{path}-index-2", state_table.state_changes(spark, path, old.version))
    return index_table.read_index_table(spark, f"{path}-index-2").select("ip", _text("domains").alias("domains"), "last_seen")


# --- geo ---------------------------------------------------------------------------------------


@register("SELECT ip, domains, last_seen, country, city FROM intel")
def geo_join_v4(spark, sf):
    return _intel(spark, sf).select("ip", _text("domains").alias("domains"), "last_seen", "country", "city")


@register(
    """SELECT value AS ip, (SELECT min(n_name) FROM nation
         WHERE ('0x' || substr(value, 11))::BIGINT - 16 - n_nationkey * 10 BETWEEN 0 AND 5) AS country
       FROM (SELECT DISTINCT value FROM state_all WHERE type = 'AAAA' AND value LIKE '2001:db8::%')"""
)
def geo_join_v6(spark, sf):
    ips = index.distinct_ips(_state_all(spark, sf).where("type = 'AAAA'"))
    v6_only = ips.where(IP.ip_version("ip") == 6)
    return geo.geo_join(v6_only, v4=I.geo_v4(spark, sf), v6=I.geo_v6(spark, sf)).select("ip", "country")


@register("SELECT ip, country, city FROM intel")
def geo_join_shuffled(spark, sf):
    """The same join with the range table taken as too large to broadcast."""
    joined = geo.geo_join(_ip_index(spark, sf), v4=I.geo_v4(spark, sf), broadcast_bytes=0)
    return joined.select("ip", "country", "city")


@register(
    """SELECT value AS ip, coalesce((SELECT min(n_name) FROM nation WHERE value LIKE '2001:db8::%'
           AND ('0x' || substr(value, 11))::BIGINT - 16 - n_nationkey * 10 BETWEEN 0 AND 5), country) AS country
       FROM (SELECT DISTINCT value FROM state_all WHERE type IN ('A', 'AAAA')) s LEFT JOIN intel i ON i.ip = s.value"""
)
def geo_join_carried(spark, sf):
    """Addresses of both versions, text that is none, and the mapped form, with both tables taken as too large to broadcast."""
    values = _state_all(spark, sf).where("type IN ('A', 'AAAA')").select(F.col("value").alias("ip")).distinct()
    joined = geo.geo_join(values, v4=I.geo_v4(spark, sf), v6=I.geo_v6(spark, sf), broadcast_bytes=0)
    return joined.select("ip", "country")


_NESTED_SQL = """WITH numbers AS (SELECT event_id AS id, 3323068416 + (event_id * 7919) % 65536 AS number FROM dns_raw)
       SELECT id, CASE WHEN number % 64 BETWEEN 8 AND 23 THEN 'narrow-' || number // 64
         WHEN number < 3323068416 + 20000 THEN 'half' ELSE 'wide' END AS country
       FROM numbers"""


@register(_NESTED_SQL)
def geo_join_nested(spark, sf):
    return _nested(spark, sf)


@register(_NESTED_SQL)
def geo_join_nested_carried(spark, sf):
    """The same with one exchange for all levels."""
    return _nested(spark, sf, broadcast_bytes=0)


def _nested(spark, sf, **options):
    """Addresses of one /16 against narrow ranges inside two wide ones."""
    first, n = 3323068416, F.col("number")
    addresses = I.dns_raw(spark, sf).select(F.col("event_id").alias("id"), (F.lit(first) + (F.col("event_id") * 7919) % 65536).alias("number"))
    dotted = F.concat_ws(".", *[F.shiftright(n, by).bitwiseAND(F.lit(255)).cast("string") for by in (24, 16, 8, 0)])
    narrow = spark.range(1024).select((F.col("id") * 64 + first + 8).alias("start"), (F.col("id") * 64 + first + 23).alias("end"),
                                      F.concat(F.lit("narrow-"), F.floor((F.col("id") * 64 + first) / 64).cast("string")).alias("country"))
    wide = spark.createDataFrame([(first, first + 65535, "wide"), (first, first + 19999, "half")], narrow.schema)
    ranges = narrow.unionByName(wide).withColumn("city", F.lit(""))
    return geo.geo_join(addresses.withColumn("ip", dotted), v4=ranges, **options).select("id", "country")


@register(
    """SELECT ip, coalesce(country, 'ZZ') AS country,
         coalesce(city, 'town_' || (length(ip) % 3)) AS city FROM intel"""
)
def geo_overlay(spark, sf):
    """Records that already have a country and a city, overlaid by a range table."""
    old_city = F.concat(F.lit("town_"), (F.length("ip") % 3).cast("string"))
    older = _ip_index(spark, sf).withColumns({"country": F.lit("ZZ"), "city": old_city})
    return geo.overlay_geo(older, v4=I.geo_v4(spark, sf)).select("ip", "country", "city")


_CSV_EXPECTED = """
    SELECT ip, nullif(g.country, '') AS country, nullif(g.city, '') AS city
    FROM ip_numbers LEFT JOIN (SELECT start, start + {span} AS stop, country, city FROM geo_v4) g
    ON n BETWEEN g.start AND g.stop"""


@register(_CSV_EXPECTED.format(span=27))
def geo_csv_plain(spark, sf):
    path = _scratch(spark, "geo-plain")
    I.geo_csv_plain(spark, sf).write.csv(path)
    ranges = geo_files.read_geo_csv(spark, path, 4)
    return geo.geo_join(_ip_index(spark, sf), v4=ranges).select("ip", "country", "city")


@register(_CSV_EXPECTED.format(span=27))
def geo_csv_bad_rows(spark, sf):
    """The plain layout among lines that are no ranges: each has to go, and nothing else."""
    path = _scratch(spark, "geo-bad")
    good = I.geo_csv_plain(spark, sf)
    bad = ["junk", "1.2.3.4", "300.1.1.1,300.1.1.2,XX", "9.0.0.9,9.0.0.1,XX", "x,y,z,a,b,c", "2001:db8::,2001:db8::f,V6"]
    lines = good.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in good.columns]).alias("value"))
    lines.unionByName(spark.createDataFrame([(x,) for x in bad], "value string")).write.text(path)
    ranges = geo_files.read_geo_csv(spark, path, 4)
    return geo.geo_join(_ip_index(spark, sf), v4=ranges).select("ip", "country", "city")


@register(_CSV_EXPECTED.format(span=15))
def geo_csv_named(spark, sf):
    path = _scratch(spark, "geo-named")
    I.geo_csv_named(spark, sf).write.option("header", True).csv(path)
    ranges = geo_files.read_geo_csv(spark, path, 4)
    return geo.geo_join(_ip_index(spark, sf), v4=ranges).select("ip", "country", "city")


@register(
    """SELECT ip, nullif(g.country, '') AS country, nullif(g.city, '') AS city
       FROM ip_numbers LEFT JOIN (SELECT start, start + CASE WHEN start % 64 = 32 THEN 15 ELSE 27 END AS stop, country, city FROM geo_v4) g
       ON n BETWEEN g.start AND g.stop"""
)
def geo_csv_mixed(spark, sf):
    """One folder of files without a header and with one: each is read by its own first line."""
    path = _scratch(spark, "geo-mixed")
    plain, named = I.geo_csv_plain(spark, sf), I.geo_csv_named(spark, sf)
    odd = F.element_at(F.split(F.element_at(F.split("network", "/"), 1), r"\."), -1).cast("int") % 64 >= 32
    named.where(odd).write.option("header", True).csv(f"{path}/named")
    even = F.element_at(F.split("c0", r"\."), -1).cast("int") % 64 < 32
    plain.where(even).write.csv(f"{path}/plain")
    ranges = geo_files.read_geo_csv(spark, f"{path}/*", 4)
    return geo.geo_join(_ip_index(spark, sf), v4=ranges).select("ip", "country", "city")


def _wanted_ips(spark, sf):
    """An IP list from the orders table: some in the index, some not."""
    return I.table(spark, sf, "orders").selectExpr(
        "concat('198.18.', o_custkey % 8, '.', o_orderkey % 200 + 1) AS ip"
    )


_WANTED = "SELECT DISTINCT concat('198.18.', o_custkey % 8, '.', o_orderkey % 200 + 1) AS ip FROM orders"


@register(f"SELECT ip, domains, last_seen FROM ip_index WHERE ip IN ({_WANTED})")
def restrict_to_ips(spark, sf):
    kept = index.restrict_to_ips(_ip_index(spark, sf), _wanted_ips(spark, sf))
    return kept.select("ip", _text("domains").alias("domains"), "last_seen")


@register(
    f"""SELECT ip, arg_min(domain, (shard, domain)) AS domain, any_value(country) AS country,
          any_value(city) AS city
        FROM ip_pairs JOIN shards USING (domain) JOIN intel USING (ip)
        WHERE ip IN ({_WANTED}) GROUP BY 1"""
)
def ip_geo(spark, sf):
    """The flat ip → domain, country, city output for a list of IPs."""
    return plans.ip_geo_for(
        _state(spark, sf), _wanted_ips(spark, sf), v4=I.geo_v4(spark, sf)
    )


@register("SELECT ip, min(domain) AS domain FROM ip_pairs GROUP BY 1")
def dedupe_ip_first(spark, sf):
    ordered = _records(spark, sf).withColumn("line", F.get("domains", F.lit(0)))
    return index.dedupe_ip_first(ordered, "line")


@register("SELECT ip, domains, last_seen, country, city FROM intel")
def ip_intel_round_trip(spark, sf):
    """The enriched index written as NDJSON and read back."""
    path = intel_files.replace_output(_intel(spark, sf), _scratch(spark, "intel"))
    back = intel_files.read_ip_intel(spark, path)
    return back.select("ip", _text("domains").alias("domains"), "last_seen", "country", "city")


@register("SELECT ip, domains, last_seen FROM ip_index")
def ip_index_file(spark, sf):
    path = _scratch(spark, "index")
    intel_files.write_ip_index(_ip_index(spark, sf), path)
    back = intel_files.read_ip_intel(spark, path)
    return back.select("ip", _text("domains").alias("domains"), "last_seen")


@register(
    r"""SELECT DISTINCT value AS ip FROM state_all WHERE type IN ('A', 'AAAA')
        AND (regexp_full_match(value, '\d+\.\d+\.\d+\.\d+') OR value LIKE '2001:db8::%')"""
)
def ip_list_file(spark, sf):
    path = _scratch(spark, "ips")
    intel_files.write_ip_list(index.distinct_ips(_state_all(spark, sf)), path)
    return intel_files.read_ip_list(spark, path)


# --- lookups -----------------------------------------------------------------------------------

_RESOLVED = """
    SELECT domain, coalesce(string_agg(DISTINCT value, ',' ORDER BY value)
                            FILTER (WHERE type = 'A'), '') AS ips,
           coalesce(string_agg(DISTINCT value, ',' ORDER BY value)
                    FILTER (WHERE type = 'CNAME'), '') AS cnames,
           CASE WHEN bool_or(type IN ('A', 'CNAME')) THEN max(last_seen) ELSE 0 END AS last_seen
    FROM state_all GROUP BY 1"""


def _resolved(df: DataFrame) -> DataFrame:
    return df.select("domain", _text("ips").alias("ips"), _text("cnames").alias("cnames"), "last_seen")


@register(_RESOLVED)
def resolve(spark, sf):
    return _resolved(lookup.resolve(_state_all(spark, sf)))


def _wanted_domains(spark, sf):
    """Domains asked for, from the customer table: some known, some not."""
    return I.table(spark, sf, "customer").selectExpr(
        "CASE WHEN c_custkey % 3 = 0 THEN 'error.service.local' WHEN c_custkey % 3 = 1 "
        "THEN concat('view', c_nationkey, '.example.net') ELSE lower(c_mktsegment) END AS domain"
    )


_WANTED_DOMAINS = """SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN 'error.service.local'
    WHEN c_custkey % 3 = 1 THEN concat('view', c_nationkey, '.example.net')
    ELSE lower(c_mktsegment) END AS domain FROM customer"""


@register(
    f"""SELECT domain, coalesce(ips, '') AS ips, coalesce(cnames, '') AS cnames,
          coalesce(last_seen, 0) AS last_seen
        FROM ({_WANTED_DOMAINS}) LEFT JOIN ({_RESOLVED}) USING (domain)"""
)
def resolve_listed(spark, sf):
    return _resolved(lookup.resolve(_state_all(spark, sf), _wanted_domains(spark, sf)))


@register(f"SELECT * FROM ({_RESOLVED}) WHERE domain = 'view.example.com'")
def resolve_domain(spark, sf):
    return _resolved(lookup.resolve_domain(fold.with_shard(_state_all(spark, sf)), " View.Example.COM. "))


@register(f"SELECT * FROM ({_RESOLVED}) WHERE domain = 'view.example.com'")
def resolve_domain_64(spark, sf):
    return _resolved(lookup.resolve_domain(_stored_64(spark, sf), " View.Example.COM. "))


@register(_RESOLVED)
def resolve_bucketed(spark, sf):
    """The answers of every domain in up to four parts, put together again."""
    parts = lookup.resolve(_state_all(spark, sf), buckets=4)
    lists = [F.array_sort(F.flatten(F.collect_list(c))) for c in ("ips", "cnames")]
    whole = parts.groupBy("domain", "last_seen").agg(lists[0].alias("ips"), lists[1].alias("cnames"))
    return _resolved(whole)


@register(
    """SELECT domain, type, value, first_seen, last_seen FROM state_all
       WHERE domain = 'view.example.com' ORDER BY type, value LIMIT 100"""
)
def query_domain_64(spark, sf):
    return lookup.query_domain(_stored_64(spark, sf), "View.example.com.").drop("shard_id")


@register(
    """SELECT domain, type, value, first_seen, last_seen FROM state_all
       WHERE domain = 'view.example.com' AND type = 'TXT' AND value = 'v=1'"""
)
def get_key_64(spark, sf):
    return lookup.get_key(_stored_64(spark, sf), "VIEW.example.com", "TXT", "v=1").drop("shard_id")


@register(
    """SELECT domain, type, value, first_seen, last_seen FROM state_all
       WHERE domain = 'view.example.com' ORDER BY type, value LIMIT 100"""
)
def query_domain_top(spark, sf):
    return lookup.query_domain(_state_all(spark, sf), "view.example.com")


@register(
    """SELECT domain || '|' || type || '|' || value AS key, first_seen, last_seen
       FROM state_all JOIN shards USING (domain) WHERE shard = 2 ORDER BY key LIMIT 20"""
)
def inspect_shard_top(spark, sf):
    return lookup.inspect_shard(_state_all(spark, sf), 2).select("key", "first_seen", "last_seen")


@register(
    """SELECT domain, type, value, first_seen, last_seen FROM state_all
       WHERE domain = 'view.example.com' AND type = 'TXT' AND value = 'v=1'"""
)
def get_key(spark, sf):
    return lookup.get_key(_state_all(spark, sf), "view.example.com", "TXT", "v=1")


@register("SELECT ip, arg_max(domain, (last_seen, domain)) AS domains, max(last_seen) AS last_seen FROM ip_pairs GROUP BY 1")
def latest_by_ip(spark, sf):
    out = lookup.latest_by_ip(_records(spark, sf))
    return out.select("ip", _text("domains").alias("domains"), "last_seen")


@register("SELECT domain, ip, max(last_seen) AS last_seen FROM ip_pairs GROUP BY 1, 2")
def latest_by_domain_ip(spark, sf):
    records = _records(spark, sf)
    older = records.withColumn("last_seen", F.greatest(F.col("last_seen") - 1, F.lit(0)))
    return lookup.latest_by_domain_ip(lookup.explode_domains(records.unionAll(older)))


@register(
    """SELECT p.domain, p.ip, i.last_seen, i.country, i.city FROM ip_pairs p JOIN intel i USING (ip)"""
)
def domain_view_flat(spark, sf):
    return lookup.domain_view_flat(_intel(spark, sf))


@register(
    """SELECT p.domain, count(*) AS n_ips,
         string_agg(p.ip || ':' || i.last_seen, ',' ORDER BY i.last_seen DESC, p.ip) AS ips
       FROM ip_pairs p JOIN ip_index i USING (ip) GROUP BY 1"""
)
def domain_view(spark, sf):
    view = lookup.domain_view(_ip_index(spark, sf))
    shown = F.transform("ips", lambda r: F.concat_ws(":", r["ip"], r["last_seen"].cast("string")))
    return view.select("domain", F.size("ips").cast("bigint").alias("n_ips"), _text(shown).alias("ips"))


@register(
    """SELECT count(*) AS records, count(DISTINCT ip) AS unique_ips,
         (SELECT count(DISTINCT domain) FROM ip_pairs) AS unique_domains,
         count(*) FILTER (WHERE country IS NOT NULL OR city IS NOT NULL) AS enriched FROM intel"""
)
def intel_summary(spark, sf):
    return rollups.intel_summary(_intel(spark, sf))


@register(
    """SELECT count(*) AS records, count(*) FILTER (WHERE country IS NOT NULL OR city IS NOT NULL) AS enriched,
         true AS ips_within, true AS domains_within FROM intel"""
)
def sketched_summary(spark, sf):
    """The summary from sketches of eight parts; its distinct counts are within four standard errors of the exact ones."""
    intel = _intel(spark, sf).withColumn("by", F.pmod(F.xxhash64("ip"), F.lit(8)))
    united = rollups.united_summary(rollups.summary_sketches(intel, "by"))
    exact = rollups.intel_summary(intel).withColumnsRenamed({"unique_ips": "ips", "unique_domains": "domains"}).select("ips", "domains", F.lit(1).alias("k"))
    both = united.withColumn("k", F.lit(1)).join(exact, "k")
    within = [(F.abs(F.col(f"unique_{c}") - F.col(c)) <= 4 * 0.0082 * F.col(c)).alias(f"{c}_within") for c in ("ips", "domains")]
    return both.select("records", "enriched", *within)


@register(
    f"""SELECT w.ip, i.domains, i.last_seen, i.country, i.ip IS NOT NULL AS found
        FROM ({_WANTED}) w LEFT JOIN intel i ON w.ip = i.ip"""
)
def lookup_ips(spark, sf):
    found = lookup.lookup_ips(_intel(spark, sf), _wanted_ips(spark, sf).distinct())
    return found.select("ip", _text("domains").alias("domains"), "last_seen", "country", "found")


@register(
    f"""SELECT w.domain, i.ip, i.last_seen, i.country, i.ip IS NOT NULL AS found
        FROM ({_WANTED_DOMAINS}) w LEFT JOIN (ip_pairs p JOIN intel i ON p.ip = i.ip)
        ON w.domain = p.domain"""
)
def lookup_domains(spark, sf):
    found = lookup.lookup_domains(_intel(spark, sf), _wanted_domains(spark, sf).distinct())
    return found.select("domain", "ip", "last_seen", "country", "found")


@register(
    f"""SELECT upper(w.domain) || '.' AS domain, i.ip, i.last_seen, i.country, i.ip IS NOT NULL AS found
        FROM ({_WANTED_DOMAINS}) w LEFT JOIN (ip_pairs p JOIN intel i ON p.ip = i.ip)
        ON w.domain = p.domain"""
)
def lookup_domains_canonical(spark, sf):
    """The same in upper case and with a final dot; keys come back as they were given."""
    keys = _wanted_domains(spark, sf).distinct().select(F.concat(F.upper("domain"), F.lit(".")).alias("domain"))
    found = lookup.lookup_domains(_intel(spark, sf), keys)
    return found.select("domain", "ip", "last_seen", "country", "found")


@register(
    """SELECT p.domain, p.ip, i.last_seen, row_number() OVER (PARTITION BY p.domain ORDER BY i.last_seen DESC, p.ip) AS place
       FROM ip_pairs p JOIN intel i ON p.ip = i.ip"""
)
def domain_view_ranked(spark, sf):
    """Each domain's IPs, latest first, from an index in parts."""
    parts = index.ip_index(_state(spark, sf), buckets=4)
    ranked = lookup.domain_view_ranked(parts)
    place = F.row_number().over(Window.partitionBy("domain").orderBy("order"))
    return ranked.select("domain", "ip", "last_seen", place.cast("bigint").alias("place"))


# --- rollups -----------------------------------------------------------------------------------


@register(
    """SELECT device_id, max(us) AS timestamp, count(*) AS total_correlations,
         coalesce(sum(query_count) FILTER (WHERE has_temporal), 0)::BIGINT AS total_queries,
         sum(len(answer_ips))::BIGINT AS total_responses,
         floor(coalesce(sum(query_count) FILTER (WHERE has_temporal), 0)::DOUBLE * 0.7::DOUBLE)::BIGINT AS cache_hits,
         (coalesce(sum(query_count) FILTER (WHERE has_temporal), 0)
           - floor(coalesce(sum(query_count) FILTER (WHERE has_temporal), 0)::DOUBLE * 0.7::DOUBLE))::BIGINT
           AS cache_misses
       FROM feed_rows GROUP BY device_id, day"""
)
def feed_stats(spark, sf):
    return rollups.feed_stats(I.feeds(spark, sf)).withColumns(
        _big("total_correlations", "cache_hits", "cache_misses")
    )


@register(
    """SELECT device_id, max(us) AS timestamp,
         count(*) FILTER (WHERE contains(final_domain, 'google')) AS google_domains,
         count(*) FILTER (WHERE contains(domain, 'cdn.')) AS cdn_domains,
         count(*) FILTER (WHERE regexp_matches(final_domain, 'facebook|instagram|tiktok'))
           AS social_media_domains
       FROM feed_rows GROUP BY device_id, day"""
)
def infra_patterns(spark, sf):
    return rollups.infra_patterns(I.feeds(spark, sf))


@register(
    """SELECT device_id, timestamp, average_ttl, coalesce(n, 0) AS unique_ip_count FROM
         (SELECT device_id, day, max(us) AS timestamp,
            coalesce(sum(ttl) FILTER (WHERE has_temporal), 0)::DOUBLE / count(*) AS average_ttl
          FROM feed_rows GROUP BY device_id, day)
       LEFT JOIN (SELECT device_id, day, count(DISTINCT ip) AS n
          FROM (SELECT device_id, day, unnest(answer_ips) AS ip FROM feed_rows) GROUP BY 1, 2)
       USING (device_id, day)"""
)
def behavior(spark, sf):
    return rollups.behavior(I.feeds(spark, sf))


@register(
    """SELECT device_id, arg_max(hour, (queries, -hour)) AS peak_query_time, max(queries) AS queries
       FROM (SELECT device_id, (feed_ts // 3600000000) % 24 AS hour, sum(queries)::BIGINT AS queries
             FROM (SELECT device_id, day, max(us) AS feed_ts,
                     coalesce(sum(query_count) FILTER (WHERE has_temporal), 0) AS queries
                   FROM feed_rows GROUP BY 1, 2) GROUP BY 1, 2) GROUP BY 1"""
)
def peak_hour(spark, sf):
    return rollups.peak_hour(I.feeds(spark, sf))


# --- staging and snapshots ---------------------------------------------------------------------


def _staging(spark, sf):
    events = _events(spark, sf).where("type = 'A'")
    return events.select(
        F.concat(F.lit(" "), "value").alias("ip"),
        "domain",
        "first_seen",
        "last_seen",
        F.col("device_id").alias("source_batch"),
    )


_STAGED = r"""
    SELECT value AS ip, domain, count(*) AS times, max(last_seen) AS last_seen FROM dns_events
    WHERE type = 'A' AND regexp_full_match(value, '\d+\.\d+\.\d+\.\d+') GROUP BY 1, 2"""


@register(
    f"""SELECT ip, domain, times, last_seen FROM (SELECT *, row_number() OVER
          (PARTITION BY ip ORDER BY last_seen DESC, domain DESC) AS rn FROM ({_STAGED})) WHERE rn = 1"""
)
def compact_recent(spark, sf):
    return index.compact_staging(_staging(spark, sf), "recent")


@register(
    f"""SELECT ip, domain, times, last_seen FROM (SELECT *, row_number() OVER
          (PARTITION BY ip ORDER BY times DESC, last_seen DESC, domain DESC) AS rn FROM ({_STAGED}))
        WHERE rn = 1"""
)
def compact_frequent(spark, sf):
    return index.compact_staging(_staging(spark, sf), "frequent")


_HALF = "WHERE split_part(device_id, '_', 2)::INT % 2 = 1"


@register(
    f"""SELECT n.ip, n.domain, CASE WHEN o.ip IS NULL THEN 'new' ELSE 'changed' END AS change
        FROM (SELECT value AS ip, min(domain) AS domain FROM dns_events WHERE type = 'A' GROUP BY 1) n
        LEFT JOIN (SELECT value AS ip, min(domain) AS domain FROM dns_events {_HALF} AND type = 'A'
                   GROUP BY 1) o ON n.ip = o.ip
        WHERE o.ip IS NULL OR o.domain <> n.domain"""
)
def changed_ips(spark, sf):
    def snapshot(events):
        return events.where("type = 'A'").groupBy(F.col("value").alias("ip")).agg(
            F.min("domain").alias("domain")
        )

    return index.changed_ips(snapshot(_by_device(spark, sf)[0]), snapshot(_events(spark, sf)))


# --- keyed tables ------------------------------------------------------------------------------

_TABLE = "SELECT key, value FROM as_of_end"


def _table(spark, sf):
    """A keyed table: what all puts and deletes of the history leave."""
    ops = I.history(spark, sf)
    empty = ops.select("key", "value").where(F.lit(False))
    return keyed.apply_changes(empty, ops)


@register(_TABLE)
def apply_changes(spark, sf):
    return _table(spark, sf)


@register(
    f"""SELECT pos, w.key, t.value FROM
          (SELECT o_orderkey AS pos, concat('198.18.', o_custkey % 8, '.', o_orderkey % 200 + 1) AS key
           FROM orders) w LEFT JOIN ({_TABLE}) t ON w.key = t.key"""
)
def multi_get(spark, sf):
    keys = I.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS pos", "concat('198.18.', o_custkey % 8, '.', o_orderkey % 200 + 1) AS key"
    )
    return keyed.multi_get(_table(spark, sf), keys).select("pos", "key", "value")


@register(f"SELECT * FROM ({_TABLE}) WHERE key >= '198.18.1' AND key < '198.18.3'")
def range_scan(spark, sf):
    return keyed.range_scan(_table(spark, sf), "198.18.1", "198.18.3")


@register(f"SELECT * FROM ({_TABLE}) WHERE starts_with(key, '2001:db8::1')")
def prefix_scan(spark, sf):
    return keyed.prefix_scan(_table(spark, sf), "2001:db8::1")


_MID = 1705276800000000  # 2024-01-15, the middle of the events


@register(
    f"""SELECT key, ts, value FROM (SELECT *, row_number() OVER
          (PARTITION BY key ORDER BY ts DESC, is_delete DESC, value DESC) AS rn
          FROM history WHERE ts <= {_MID}) WHERE rn = 1 AND NOT is_delete"""
)
def read_as_of(spark, sf):
    return keyed.read_as_of(I.history(spark, sf), _MID)


@register(
    f"""SELECT pos, w.key, t.ts, t.value FROM
          (SELECT o_orderkey AS pos, concat('198.18.', o_custkey % 8, '.', o_orderkey % 200 + 1) AS key
           FROM orders) w
        LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER
            (PARTITION BY key ORDER BY ts DESC, is_delete DESC, value DESC) AS rn
            FROM history WHERE ts <= {_MID}) WHERE rn = 1 AND NOT is_delete) t ON w.key = t.key"""
)
def multi_get_as_of(spark, sf):
    keys = I.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS pos", "concat('198.18.', o_custkey % 8, '.', o_orderkey % 200 + 1) AS key"
    )
    found = keyed.multi_get_as_of(I.history(spark, sf), keys, _MID)
    return found.select("pos", "key", "ts", "value")


@register(f"SELECT key, ts, value, is_delete, seq FROM history WHERE ts BETWEEN 1 AND {_MID}")
def history(spark, sf):
    return keyed.history_between(I.history(spark, sf), 1, _MID)


@register(f"SELECT * FROM ({_TABLE}) WHERE NOT (key >= '198.18.1' AND key < '198.18.3')")
def delete_range(spark, sf):
    return keyed.delete_range(_table(spark, sf), "198.18.1", "198.18.3")


@register(f"SELECT * FROM ({_TABLE}) WHERE key NOT IN ({_WANTED})")
def delete_keys(spark, sf):
    return keyed.delete_keys(_table(spark, sf), _wanted_ips(spark, sf).withColumnRenamed("ip", "key"))


@register(
    """SELECT key, sum(n)::BIGINT AS value FROM
         (SELECT value AS key, event_id AS n FROM dns_raw
          UNION ALL SELECT value, timestamp % 1000 FROM dns_raw) GROUP BY 1"""
)
def merge_by_key(spark, sf):
    raw = I.dns_raw(spark, sf)
    base = raw.selectExpr("value AS key", "event_id AS value")
    operands = raw.selectExpr("value AS key", "timestamp % 1000 AS value")
    return keyed.merge_by_key(base, operands, "sum")


@register(
    """SELECT key, 'base' || string_agg(value, '' ORDER BY seq) AS value FROM history GROUP BY 1"""
)
def append_by_key(spark, sf):
    ops = I.history(spark, sf)
    base = ops.select("key").distinct().withColumn("value", F.lit("base"))
    return keyed.append_by_key(base, ops).select("key", "value")


@register(
    """SELECT key, value, row_number() OVER (PARTITION BY key ORDER BY seq) AS place FROM history"""
)
def append_by_key_in_parts(spark, sf):
    """Runs of some operands each, taken apart again: the parts' order is the operands' order."""
    ops = I.history(spark, sf)
    none = ops.select("key", "value").where(F.lit(False))
    runs = keyed.append_by_key(none, ops, separator=";", runs=5)
    pieces = runs.select("key", "part", F.posexplode(F.split("value", ";")).alias("at", "value"))
    order = Window.partitionBy("key").orderBy("part", "at")
    return pieces.select("key", "value", F.row_number().over(order).cast("bigint").alias("place"))


@register(
    """SELECT key, 'base;' || string_agg(value, ';' ORDER BY seq) AS value FROM history GROUP BY 1
       UNION ALL SELECT 'no operands', 'base'"""
)
def merge_lists(spark, sf):
    """Lists put behind a base list in the order of the operands."""
    ops = I.history(spark, sf)
    base = ops.select("key").distinct().unionByName(spark.createDataFrame([("no operands",)], "key string"))
    lists = ops.withColumn("value", F.array("value"))
    merged = merging.merge_operands(base.withColumn("value", F.array(F.lit("base"))), lists, merging.APPEND)
    return merged.select("key", F.array_join("value", ";").alias("value"))


@register("SELECT key, sum(seq % 1000)::BIGINT AS value FROM history GROUP BY 1")
def merge_counters(spark, sf):
    ops = I.history(spark, sf).withColumn("value", F.col("seq") % 1000)
    return merging.merge_operands(ops.select("key", "value").where(F.lit(False)), ops, merging.COUNTER)


@register(
    """WITH fields AS (SELECT key, concat('f', seq % 7) AS field, seq, CASE WHEN NOT is_delete THEN value END AS value FROM history),
       last AS (SELECT key, field, arg_max(coalesce(value, ''), seq) AS value FROM fields GROUP BY 1, 2)
       SELECT key, coalesce(string_agg(field || '=' || value, ',' ORDER BY field) FILTER (WHERE value <> ''), '') AS value FROM last GROUP BY 1"""
)
def merge_patches(spark, sf):
    """Patches of one field each; a delete removes its field."""
    field = F.concat(F.lit("f"), (F.col("seq") % 7).cast("string"))
    ops = I.history(spark, sf).withColumn("value", F.create_map(field, F.when(~F.col("is_delete"), F.col("value"))))
    merged = merging.merge_operands(ops.select("key", "value").where(F.lit(False)), ops, merging.PATCH)
    shown = F.transform(F.array_sort(F.map_entries("value")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return merged.select("key", _text(shown).alias("value"))


@register(
    """SELECT domain, type, CASE WHEN type = 'CNAME' THEN upper(value) ELSE value END AS value,
         first_seen, last_seen FROM state WHERE value <> 'not-an-ip'"""
)
def retain(spark, sf):
    louder = F.when(F.col("type") == "CNAME", F.upper("value")).otherwise(F.col("value"))
    return keyed.retain(_state(spark, sf), F.col("value") != "not-an-ip", {"value": louder})


@register(f"SELECT * FROM state WHERE last_seen = 0 OR last_seen > {_MID} - 86400000000")
def expire(spark, sf):
    return keyed.expire(_state(spark, sf), _MID, 86_400_000_000)


_CHANGED = f"""WITH old AS (SELECT domain, type, value, coalesce(min(nullif(first_seen, 0)), 0) AS first_seen,
            coalesce(max(nullif(last_seen, 0)), 0) AS last_seen FROM dns_events {_HALF} GROUP BY 1, 2, 3)
        SELECT n.domain, n.type, n.value, CASE WHEN o.domain IS NULL THEN 'insert' ELSE 'update' END AS op,
          n.first_seen, n.last_seen
        FROM state n LEFT JOIN old o
          ON n.domain = o.domain AND n.type = o.type AND n.value = o.value
        WHERE o.domain IS NULL OR o.first_seen <> n.first_seen OR o.last_seen <> n.last_seen"""


@register(_CHANGED)
def changes_since(spark, sf):
    """What the second half of the sensors changed in the state."""
    old = fold.fold_events(_by_device(spark, sf)[0])
    return keyed.changes_since(
        old, _state(spark, sf), fold.STATE_KEY, ("first_seen", "last_seen")
    )


@register(_CHANGED)
def state_changes(spark, sf):
    """The same between two versions of a stored table, a compaction and a batch that comes twice in between."""
    path = _scratch(spark, "state")
    first, second = _by_device(spark, sf)
    old = state_table.upsert_state(spark, path, first)
    state_table.upsert_state(spark, path, second)
    state_table.compact_state(spark, path)
    state_table.upsert_state(spark, path, second)
    return state_table.state_changes(spark, path, old.version)


# --- streams -----------------------------------------------------------------------------------


@register("SELECT domain, type, value, first_seen, last_seen, device_id FROM dns_events")
def stream_normalizer(spark, sf):
    """Raw messages in files, read as a stream, normalised, and read back as events."""
    source, target, marks = (_scratch(spark, n) for n in ("messages", "events", "position"))
    I.raw_messages(spark, sf).repartition(4).write.text(source)
    stream = messages.read_stream(spark, source, max_per_batch=3)
    streams.start_normalizer(stream, target, marks, once=True).awaitTermination()
    return messages.parse_events(spark.read.text(target))


@register("SELECT domain, type, value, first_seen, last_seen FROM state")
def stream_aggregator(spark, sf):
    """Event messages in files, folded into the state table batch by batch."""
    source, table, marks = (_scratch(spark, n) for n in ("events", "state", "position"))
    sent = ingest.messages_to_events(I.raw_messages(spark, sf))
    intel_files.event_messages(sent).repartition(4).write.text(source)
    stream = messages.read_stream(spark, source, max_per_batch=2)
    streams.start_aggregator(stream, table, marks, once=True).awaitTermination()
    return state_table.read_state(spark, table).drop("shard_id")


@register(
    """SELECT event_id, CASE WHEN event_id % 4 = 0 OR event_id % 4 = 1 THEN 'missing domain, type or value' END AS reason
       FROM dns_raw"""
)
def event_rejects(spark, sf):
    """Events judged for missing fields: every fourth has no domain, every fourth a blank type."""
    place = F.col("event_id") % 4
    made = I.dns_raw(spark, sf).select(
        "event_id", F.when(place != 0, F.lit("a.com")).alias("domain"), F.when(place == 1, "").otherwise("A").alias("type"),
        F.lit("1.1.1.1").alias("value"), F.lit(None).cast("bigint").alias("first_seen"), F.lit(None).cast("bigint").alias("last_seen"),
    )
    return ingest.classify_events(made).select("event_id", "reason")


@register(
    """SELECT value, 'neither raw records nor a feed' AS reason
       FROM (SELECT 'junk-' || event_id AS value FROM dns_raw)"""
)
def reject_files(spark, sf):
    """Refused messages written as JSON and read back."""
    path = _scratch(spark, "rejects")
    junk = I.dns_raw(spark, sf).select(F.concat(F.lit("junk-"), F.col("event_id").cast("string")).alias("value"))
    both = junk.unionByName(I.raw_messages(spark, sf).select("value"))
    intel_files.write_rejects(ingest.messages_to_events(both).select("value", "reason"), path)
    return spark.read.json(path).select("value", "reason")


@register(
    """SELECT ip, arg_min(domain, domain) AS domain, any_value(country) AS country, any_value(city) AS city
       FROM ip_pairs JOIN intel USING (ip) GROUP BY 1"""
)
def ip_geo_file(spark, sf):
    """The flat output of an index in parts, written and read back."""
    path = _scratch(spark, "ip-geo")
    parts = geo.geo_join(index.ip_index(_state(spark, sf), buckets=4), v4=I.geo_v4(spark, sf))
    intel_files.write_ip_geo(intel_files.ip_geo(parts), path)
    return spark.read.schema("ip string, domain string, country string, city string").json(path)


@register(
    """SELECT count(*) AS records, count(DISTINCT ip) AS unique_ips,
         (SELECT count(DISTINCT domain) FROM ip_pairs) AS unique_domains,
         count(*) FILTER (WHERE country IS NOT NULL OR city IS NOT NULL) AS enriched FROM intel"""
)
def intel_summary_bucketed(spark, sf):
    return rollups.intel_summary(geo.geo_join(index.ip_index(_state(spark, sf), buckets=4), v4=I.geo_v4(spark, sf)))


@register("SELECT domain, type, value, first_seen, last_seen FROM state")
def stream_stateful(spark, sf):
    """The fold kept in the stream's state, in batches and over a restart; only changed keys go to the table."""
    source, table, marks = (_scratch(spark, n) for n in ("events", "state", "position"))
    for number, part in enumerate(_by_device(spark, sf)):
        part.select(F.to_json(F.array(F.struct(*part.columns))).alias("value")).repartition(2).write.text(f"{source}/part={number}")
        stream = messages.read_stream(spark, f"{source}/*", max_per_batch=2)
        streams.start_stateful_aggregator(stream, table, marks, once=True).awaitTermination()
    return state_table.read_state(spark, table).drop("shard_id")


@register(
    """SELECT (SELECT count(*) FROM dns_events) AS events, 0::BIGINT AS rejects, shard, count(*) AS n
       FROM dns_events JOIN shards USING (domain) GROUP BY shard"""
)
def stream_figures(spark, sf):
    """Events, rejects and events per shard as the running query observed them."""
    source, table, marks = (_scratch(spark, n) for n in ("events", "state", "position"))
    events = _events(spark, sf)
    events.select(F.to_json(F.array(F.struct(*events.columns))).alias("value")).repartition(2).write.text(source)
    query = streams.start_aggregator(messages.read_stream(spark, source, max_per_batch=1), table, marks, once=True)
    query.awaitTermination()
    sums = streams.figures(query)["total"]
    rows = [(sums["events"], sums["rejects"], int(name[6:]), n) for name, n in sums.items() if name.startswith("shard_") and n]
    return spark.createDataFrame(rows, "events bigint, rejects bigint, shard bigint, n bigint")


@register("SELECT domain, type, value, first_seen, last_seen FROM state")
def two_aggregators(spark, sf):
    """Two streams with a position each and one name, into one table, one after the other."""
    table = _scratch(spark, "state")
    for part in _by_device(spark, sf):
        source, marks = _scratch(spark, "events"), _scratch(spark, "position")
        part.select(F.to_json(F.array(F.struct(*part.columns))).alias("value")).repartition(2).write.text(source)
        stream = messages.read_stream(spark, source)
        streams.start_aggregator(stream, table, marks, once=True).awaitTermination()
    return state_table.read_state(spark, table).drop("shard_id")


@register("SELECT ip, domains, last_seen, country, city FROM intel")
def ip_intelligence(spark, sf):
    """Raw records all the way to the enriched index: which domains and country has each IP."""
    out = plans.ip_intelligence(I.dns_raw(spark, sf), v4=I.geo_v4(spark, sf))
    return out.select("ip", _text("domains").alias("domains"), "last_seen", "country", "city")
