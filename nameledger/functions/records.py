"""Field-level helpers for events, state rows and index records."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from nameledger.functions.text import as_column, non_empty


def make_key(domain: Column | str, rtype: Column | str, value: Column | str) -> Column:
    return F.concat_ws("|", as_column(domain), as_column(rtype), as_column(value))


def parse_key(key: Column | str) -> Column:
    """STRUCT<domain, type, value> of a composite key; null when a part is missing.

    Text after a third ``|`` is dropped, as any reader of such keys does.
    """
    parts = F.split(as_column(key), r"\|")
    return F.when(
        F.size(parts) >= 3,
        F.struct(
            F.get(parts, 0).alias("domain"),
            F.get(parts, 1).alias("type"),
            F.get(parts, 2).alias("value"),
        ),
    )


def temporal_range(temporal: Column, fallback: Column) -> tuple[Column, Column]:
    """(first_seen, last_seen): the fallback only when ``temporal`` is absent altogether."""

    def end(field: str) -> Column:
        return F.when(temporal.isNull(), F.coalesce(fallback, F.lit(0))).otherwise(
            F.coalesce(temporal[field], F.lit(0))
        )

    return end("first_seen"), end("last_seen")


def last_seen_or_zero(value: Column | str) -> Column:
    return F.coalesce(as_column(value).try_cast("bigint"), F.lit(0).cast("bigint"))


def first_domain(domains: Column | str, legacy: Column | str | None = None) -> Column:
    """First listed domain, else the older single-domain field, else null."""
    listed = F.get(as_column(domains), F.lit(0))
    if legacy is None:
        return non_empty(listed)
    has_list = F.coalesce(F.size(as_column(domains)), F.lit(0)) > 0
    return non_empty(F.when(has_list, listed).otherwise(as_column(legacy)))


def to_ts(micros: Column | str) -> Column:
    return F.timestamp_micros(as_column(micros))


def to_micros(ts: Column | str) -> Column:
    return F.unix_micros(as_column(ts).cast("timestamp"))


def to_intel_json(record: Column) -> Column:
    """JSON text of a record struct, null fields left out."""
    return F.to_json(record, {"ignoreNullFields": "true"})
