"""DNS-shaped inputs that Spark derives from the given tables, and the same derivations as SQL.

The tables hold no DNS data, so every row of ``events``, ``nation`` and ``pages`` is mapped to one
record; each derivation exists once for Spark (a DataFrame) and once for DuckDB (``SQL``).
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEED_TYPE = "dns_intelligence_comprehensive"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_DOMAIN = """
    CASE WHEN event_id % 97 = 0 THEN '   '
         WHEN event_id % 4 = 0 THEN concat('  ', upper(event_type), '.Example.COM.. ')
         WHEN event_id % 4 = 1 THEN concat(event_type, user_id % 7, '.example.net.')
         WHEN event_id % 4 = 2 THEN concat('api.', event_type, '.internal')
         ELSE concat(event_type, '.service.local') END
"""
_TYPE = """
    CASE event_id % 10 WHEN 0 THEN 'CNAME' WHEN 1 THEN 'AAAA' WHEN 2 THEN 'TXT' ELSE 'A' END
"""
_VALUE = """
    CASE WHEN event_id % 89 = 0 THEN ' '
         WHEN event_id % 83 = 0 THEN 'not-an-ip'
         WHEN event_id % 10 = 0 THEN concat('cdn.', event_type, '.example.com')
         WHEN event_id % 10 = 1 THEN concat('2001:db8::', lower(hex(event_id % 254 + 16)))
         WHEN event_id % 10 = 2 THEN 'v=1'
         ELSE concat('198.18.', user_id % 4, '.', event_id % 254 + 1) END
"""
_BRAND = """
    CASE event_type WHEN 'view' THEN 'www.google.com' WHEN 'click' THEN 'instagram.com'
         WHEN 'purchase' THEN 'facebook.com' WHEN 'signup' THEN 'tiktok.com'
         ELSE 'whatsapp.net' END
"""
_ANSWER_1 = "concat('198.18.', user_id % 4, '.', event_id % 254 + 1)"
_ANSWER_3 = "concat('203.0.113.', event_id % 200 + 1)"


def dns_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw DNS record per event."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        f"{_DOMAIN} AS domain",
        f"{_TYPE} AS type",
        f"{_VALUE} AS value",
        "CASE WHEN event_id % 61 = 0 THEN 0L ELSE unix_micros(cast(ts AS timestamp)) END AS timestamp",
        "concat('sensor_', user_id + 1) AS device_id",
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dns_raw`` as JSON text: bare objects for odd events, one-element arrays for even ones."""
    record = F.to_json(F.struct("domain", "type", "value", "timestamp", "device_id"))
    return dns_raw(spark, sf_dir).select(
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), record, F.lit("]")))
        .otherwise(record)
        .alias("value")
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of every record type as JSON text, in both message layouts."""
    raw = dns_raw(spark, sf_dir).withColumns(
        {"first_seen": F.col("timestamp"), "last_seen": F.col("timestamp")}
    )
    event = F.to_json(F.struct("domain", "type", "value", "first_seen", "last_seen", "device_id"))
    layout = F.col("event_id") % 3
    return raw.select(
        F.when(layout == 0, F.concat(F.lit("["), event, F.lit("]")))
        .when(layout == 1, F.concat(F.lit('{"events":['), event, F.lit("]}")))
        .otherwise(F.lit("not json"))
        .alias("value")
    )


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed per device and day, its entries in event order."""
    entry = table(spark, sf_dir, "events").selectExpr(
        "concat('sensor_', user_id + 1) AS device_id",
        "cast(ts AS date) AS day",
        "unix_micros(cast(ts AS timestamp)) AS us",
        "event_id",
        f"{_DOMAIN} AS domain",
        f"slice(array({_ANSWER_1}, ' ', {_ANSWER_3}), 1, cast(event_id % 4 AS int)) AS answer_ips",
        "CASE WHEN event_id % 3 = 0 THEN concat('CDN.', event_type, '.Example.com.') END AS cname_target",
        f"{_BRAND} AS final_domain",
        """CASE WHEN event_id % 5 <> 0 THEN named_struct(
             'first_seen', unix_micros(cast(ts AS timestamp)) - (event_id % 7) * 1000000L,
             'last_seen', unix_micros(cast(ts AS timestamp)),
             'ttl', 60L + event_id % 3541,
             'query_count', 1L + event_id % 100) END AS temporal""",
    )
    ordered = F.array_sort(
        F.collect_list(
            F.struct("event_id", "domain", "answer_ips", "cname_target", "final_domain", "temporal")
        )
    )
    return entry.groupBy("device_id", "day").agg(
        F.lit(FEED_TYPE).alias("feed_type"),
        F.lit("1.0").alias("version"),
        F.max("us").alias("timestamp"),
        F.transform(ordered, lambda c: c.dropFields("event_id")).alias("domain_correlations"),
    )


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.struct("feed_type", "version", "device_id", "timestamp", "domain_correlations")
    return feeds(spark, sf_dir).select(F.to_json(doc).alias("value"))


def geo_v4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "3323068416L + (n_nationkey % 4) * 256 + (n_nationkey div 4) * 32 AS start",
        "3323068416L + (n_nationkey % 4) * 256 + (n_nationkey div 4) * 32 + 27 AS end",
        "n_name AS country",
        "CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE concat('city_', n_regionkey) END AS city",
    )


def geo_v6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2001:db8::(16 + 10 k) to 2001:db8::(16 + 10 k + 5) for nation k."""
    low = "unhex(concat('20010db8', lpad(hex(16 + n_nationkey * 10), 24, '0')))"
    high = "unhex(concat('20010db8', lpad(hex(16 + n_nationkey * 10 + 5), 24, '0')))"
    return table(spark, sf_dir, "nation").selectExpr(
        f"{low} AS start", f"{high} AS end", "n_name AS country", "'' AS city"
    )


def geo_csv_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of 16 addresses as CIDR text, host bits set, with country and city columns."""
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('198.18.', n_nationkey % 4, '.', (n_nationkey div 4) * 32 + 5, '/28') AS network",
        "n_name AS country_iso_code",
        "CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE concat('city_', n_regionkey) END AS city_name",
    )


def geo_csv_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end address, country, two unused cells, city."""
    return table(spark, sf_dir, "nation").selectExpr(
        "concat('198.18.', n_nationkey % 4, '.', (n_nationkey div 4) * 32) AS c0",
        "concat('198.18.', n_nationkey % 4, '.', (n_nationkey div 4) * 32 + 27) AS c1",
        "n_name AS c2",
        "'-' AS c3",
        "'-' AS c4",
        "CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE concat('city_', n_regionkey) END AS c5",
    )


def page_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", F.try_parse_url("url", F.lit("HOST")).alias("host")
    )


# The same derivations as common table expressions. Each may use those before it.
CTES = {
    "dns_raw": f"""
        SELECT event_id, {_DOMAIN} AS domain, {_TYPE} AS type, {_VALUE} AS value,
               CASE WHEN event_id % 61 = 0 THEN 0 ELSE epoch_us(ts) END AS timestamp,
               concat('sensor_', user_id + 1) AS device_id
        FROM events""",
    "raw_named": r"""
        SELECT *, nullif(regexp_replace(lower(trim(domain)), '\.+$', ''), '') AS name FROM dns_raw""",
    "dns_events": """
        SELECT name AS domain, type, trim(value) AS value, timestamp AS first_seen,
               timestamp AS last_seen, device_id
        FROM raw_named
        WHERE name IS NOT NULL AND trim(value) <> '' AND type IN ('A', 'CNAME')""",
    "state": """
        SELECT domain, type, value, coalesce(min(nullif(first_seen, 0)), 0) AS first_seen,
               coalesce(max(nullif(last_seen, 0)), 0) AS last_seen
        FROM dns_events GROUP BY 1, 2, 3""",
    "state_all": """
        SELECT name AS domain, type, trim(value) AS value,
               coalesce(min(nullif(timestamp, 0)), 0) AS first_seen,
               coalesce(max(nullif(timestamp, 0)), 0) AS last_seen
        FROM raw_named WHERE name IS NOT NULL AND trim(value) <> '' GROUP BY 1, 2, 3""",
    "shards": """
        SELECT domain, (('0x' || substr(sha256(domain), 1, 8))::UBIGINT)::BIGINT AS hash,
               (('0x' || substr(sha256(domain), 1, 8))::UBIGINT % 4)::BIGINT AS shard
        FROM (SELECT DISTINCT name AS domain FROM raw_named WHERE name IS NOT NULL)""",
    "ip_pairs": """
        SELECT value AS ip, domain, max(last_seen) AS last_seen FROM state WHERE type = 'A'
        GROUP BY 1, 2""",
    "ip_index": """
        SELECT ip, string_agg(domain, ',' ORDER BY domain) AS domains,
               max(last_seen) AS last_seen FROM ip_pairs GROUP BY 1""",
    "geo_v4": """
        SELECT 3323068416 + (n_nationkey % 4) * 256 + (n_nationkey // 4) * 32 AS start,
               3323068416 + (n_nationkey % 4) * 256 + (n_nationkey // 4) * 32 + 27 AS "end",
               n_name AS country,
               CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE concat('city_', n_regionkey) END AS city
        FROM nation""",
    "ip_numbers": r"""
        SELECT ip, CASE WHEN regexp_full_match(ip, '\d+\.\d+\.\d+\.\d+') THEN
               split_part(ip, '.', 1)::BIGINT * 16777216 + split_part(ip, '.', 2)::BIGINT * 65536
               + split_part(ip, '.', 3)::BIGINT * 256 + split_part(ip, '.', 4)::BIGINT END AS n
        FROM (SELECT DISTINCT ip FROM ip_index)""",
    "intel": """
        SELECT i.ip, i.domains, i.last_seen, nullif(g.country, '') AS country,
               nullif(g.city, '') AS city
        FROM ip_index i JOIN ip_numbers USING (ip)
        LEFT JOIN geo_v4 g ON n BETWEEN g.start AND g."end" """,
    "feed_rows": f"""
        SELECT concat('sensor_', user_id + 1) AS device_id, ts::DATE AS day, epoch_us(ts) AS us,
               event_id, {_DOMAIN} AS domain,
               list_slice([{_ANSWER_1}, ' ', {_ANSWER_3}], 1, event_id % 4) AS answer_ips,
               CASE WHEN event_id % 3 = 0 THEN concat('CDN.', event_type, '.Example.com.') END
                 AS cname_target,
               {_BRAND} AS final_domain,
               event_id % 5 <> 0 AS has_temporal,
               epoch_us(ts) - (event_id % 7) * 1000000 AS first_seen,
               60 + event_id % 3541 AS ttl, 1 + event_id % 100 AS query_count
        FROM events""",
    "feed_entries": r"""
        SELECT *, max(us) OVER feed AS feed_ts,
               nullif(regexp_replace(lower(trim(domain)), '\.+$', ''), '') AS name,
               nullif(regexp_replace(lower(trim(cname_target)), '\.+$', ''), '') AS cname,
               row_number() OVER (PARTITION BY device_id, day ORDER BY event_id) - 1 AS pos,
               bool_or(trim(domain) = '') OVER feed AS feed_has_blank
        FROM feed_rows WINDOW feed AS (PARTITION BY device_id, day)""",
    "feed_events": """
        SELECT name AS domain, 'A' AS type, ip AS value,
               CASE WHEN has_temporal THEN first_seen ELSE feed_ts END AS first_seen,
               CASE WHEN has_temporal THEN us ELSE feed_ts END AS last_seen,
               device_id, feed_has_blank
        FROM (SELECT *, unnest(answer_ips) AS ip FROM feed_entries)
        WHERE name IS NOT NULL AND trim(ip) <> ''
        UNION ALL
        SELECT name, 'CNAME', cname,
               CASE WHEN has_temporal THEN first_seen ELSE feed_ts END,
               CASE WHEN has_temporal THEN us ELSE feed_ts END,
               device_id, feed_has_blank
        FROM feed_entries WHERE name IS NOT NULL AND cname IS NOT NULL""",
    "history": """
        SELECT value AS key, timestamp AS ts, concat(event_id, ':', type) AS value,
               event_id % 13 = 0 AS is_delete, event_id AS seq
        FROM dns_raw""",
    "as_of_end": """
        SELECT key, arg_max(value, seq) AS value FROM history GROUP BY 1
        HAVING NOT arg_max(is_delete, seq)""",
}


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of keyed values: one put or delete per event."""
    return dns_raw(spark, sf_dir).selectExpr(
        "value AS key",
        "timestamp AS ts",
        "concat(event_id, ':', type) AS value",
        "event_id % 13 = 0 AS is_delete",
        "event_id AS seq",
    )


def oracle(query: str) -> str:
    """``query`` with the common table expressions it reaches, in order, put before it."""
    needed, text = [], query
    for name in reversed(list(CTES)):
        if _mentions(text, name):
            needed.append(name)
            text += CTES[name]
    if not needed:
        return query
    parts = [f"{n} AS ({CTES[n]})" for n in reversed(needed)]
    own = query.lstrip().removeprefix("WITH ")
    joint = ", " if own != query.lstrip() else "\n"
    return "WITH " + ",\n".join(parts) + joint + own


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None
