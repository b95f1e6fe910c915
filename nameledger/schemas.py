"""Explicit schemas for every record the library reads or writes.

Times are epoch microseconds held as BIGINT; 0 means "time not known".
"""

from pyspark.sql import types as T

_S, _L = T.StringType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


RAW_RECORD = _struct(domain=_S, type=_S, value=_S, timestamp=_L, device_id=_S)

TEMPORAL = _struct(first_seen=_L, last_seen=_L, ttl=_L, query_count=_L)

CORRELATION = _struct(
    domain=_S,
    answer_ips=T.ArrayType(_S),
    cname_target=_S,
    final_domain=_S,
    temporal=TEMPORAL,
)

FEED = _struct(
    feed_type=_S,
    version=_S,
    device_id=_S,
    timestamp=_L,
    domain_correlations=T.ArrayType(CORRELATION),
)

EVENT = _struct(domain=_S, type=_S, value=_S, first_seen=_L, last_seen=_L, device_id=_S)

EVENT_ENVELOPE = _struct(events=T.ArrayType(EVENT))

STATE = _struct(domain=_S, type=_S, value=_S, first_seen=_L, last_seen=_L)

IP_INTEL = _struct(
    ip=_S,
    part=T.IntegerType(),
    domains=T.ArrayType(_S),
    domain=_S,
    last_seen=_L,
    country=_S,
    city=_S,
)

# The feed exactly as sensors emit it: FEED plus summaries nothing downstream needs.
_I, _B, _D = T.IntegerType(), T.BooleanType(), T.DoubleType()

FULL_CORRELATION = _struct(
    domain=_S,
    answer_ips=T.ArrayType(_S),
    cname_target=_S,
    final_domain=_S,
    ndpi_protocol=_struct(
        protocol_id=_I,
        protocol_name=_S,
        master_id=_I,
        master_name=_S,
        by_ip_id=_I,
        by_ip_name=_S,
        bytes_sent=_L,
        bytes_received=_L,
        packets_sent=_L,
        packets_received=_L,
    ),
    intelligence=_struct(
        is_whatsapp_related=_B,
        is_facebook_related=_B,
        is_suspicious=_B,
        is_malware=_B,
        is_vpn=_B,
        threat_score=_D,
        confidence_score=_D,
    ),
    temporal=TEMPORAL,
)

FULL_FEED = _struct(
    feed_type=_S,
    version=_S,
    device_id=_S,
    timestamp=_L,
    feed_stats=_struct(
        total_correlations=_I,
        total_queries=_I,
        total_responses=_I,
        cache_hits=_I,
        cache_misses=_I,
    ),
    domain_correlations=T.ArrayType(FULL_CORRELATION),
    ml_insights=_struct(
        infrastructure_patterns=_struct(google_domains=_I, cdn_domains=_I, social_media_domains=_I),
        behavioral_analysis=_struct(peak_query_time=_I, average_ttl=_D, unique_ip_count=_I),
    ),
)
