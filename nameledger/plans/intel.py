"""Whole flows, from raw records or stored state to what consumers read."""

from pyspark.sql import DataFrame

from nameledger.functions.domains import DEFAULT_SHARDS
from nameledger.operators.fold import fold_events
from nameledger.operators.geo import GeoTable, geo_join
from nameledger.operators.index import ip_first_domain, ip_index, restrict_to_ips
from nameledger.operators.ingest import raw_to_events

Geo = GeoTable | DataFrame | None


def enriched_index(state: DataFrame, v4: Geo = None, v6: Geo = None) -> DataFrame:
    """(ip, part, domains, last_seen, country, city) of the state's addresses."""
    return geo_join(ip_index(state), v4, v6)


def ip_intelligence(raw: DataFrame, v4: Geo = None, v6: Geo = None, idna: bool = True) -> DataFrame:
    """Which domains and which place each IP has, from raw records."""
    return enriched_index(fold_events(raw_to_events(raw, idna)), v4, v6)


def ip_geo_for(
    state: DataFrame, ips: DataFrame, v4: Geo = None, v6: Geo = None, n_shards: int = DEFAULT_SHARDS
) -> DataFrame:
    """Flat (ip, domain, country, city) of the listed IPs, with the domain listed first.

    The list cuts the state down before anything is grouped, so a list of changed IPs re-enriches
    only those.
    """
    addresses = state.where("type = 'A'").withColumnRenamed("value", "ip")
    kept = restrict_to_ips(addresses, ips).withColumnRenamed("ip", "value")
    return geo_join(ip_first_domain(kept, n_shards), v4, v6)
