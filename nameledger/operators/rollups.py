"""Per-feed rollups and load summaries.

Feeds are nested documents, so a rollup over one feed's own entries is an array expression inside
the row: no explode, no shuffle. ``feed_keys`` name the columns that identify a feed.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nameledger.functions.domains import domain_tags
from nameledger.functions.records import to_ts

FEED_KEYS = ("device_id", "timestamp")
CACHE_HIT_SHARE = 0.7  # fixed value



def _sum(values: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.aggregate(values, zero, lambda total, v: total + F.coalesce(v, zero))


def _n(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")


def _count_tag(tag: str) -> Column:
    def tagged(entry: Column) -> Column:
        return F.coalesce(domain_tags(entry["domain"], entry["final_domain"])[tag], F.lit(False))

    return _n(F.size(F.filter("domain_correlations", tagged)))


def feed_stats(feeds: DataFrame, feed_keys: Sequence[str] = FEED_KEYS) -> DataFrame:
    """Entries, queries and answers of each feed, with the cache hit / miss split."""
    queries = _n(_sum(F.transform("domain_correlations", lambda c: c["temporal"]["query_count"])))
    answers = _n(_sum(F.transform("domain_correlations", lambda c: F.size(F.coalesce(
        c["answer_ips"], F.array().cast("array<string>"))).cast("bigint"))))
    counted = feeds.select(
        *feed_keys,
        F.greatest(_n(F.size("domain_correlations")), F.lit(1)).alias("total_correlations"),
        queries.alias("total_queries"),
        answers.alias("total_responses"),
    )
    hits = (F.col("total_queries") * F.lit(CACHE_HIT_SHARE)).cast("bigint")
    return counted.select(
        "*",
        F.greatest(hits, F.lit(0)).alias("cache_hits"),
        F.greatest(F.col("total_queries") - hits, F.lit(0)).alias("cache_misses"),
    )


def infra_patterns(feeds: DataFrame, feed_keys: Sequence[str] = FEED_KEYS) -> DataFrame:
    """How many entries of each feed carry the search, CDN and social tags."""
    return feeds.select(
        *feed_keys,
        _count_tag("is_google").alias("google_domains"),
        _count_tag("is_cdn").alias("cdn_domains"),
        _count_tag("is_social").alias("social_media_domains"),
    )


def behavior(feeds: DataFrame, feed_keys: Sequence[str] = FEED_KEYS) -> DataFrame:
    """Mean TTL over all entries and number of different answer IPs of each feed."""
    entries = _n(F.size("domain_correlations"))
    ttl = _n(_sum(F.transform("domain_correlations", lambda c: c["temporal"]["ttl"])))
    ips = F.flatten(
        F.transform(
            "domain_correlations",
            lambda c: F.coalesce(c["answer_ips"], F.array().cast("array<string>")),
        )
    )
    return feeds.select(
        *feed_keys,
        F.when(entries > 0, ttl.cast("double") / entries).otherwise(0.0).alias("average_ttl"),
        _n(F.size(F.array_distinct(ips))).alias("unique_ip_count"),
    )


def peak_hour(feeds: DataFrame, by: Sequence[str] = ("device_id",)) -> DataFrame:
    """Hour of day with the most queries per group; ties go to the earlier hour."""
    queries = _n(_sum(F.transform("domain_correlations", lambda c: c["temporal"]["query_count"])))
    hourly = (
        feeds.select(*by, F.hour(to_ts("timestamp")).cast("bigint").alias("hour"),
                     queries.alias("queries"))
        .groupBy(*by, "hour")
        .agg(F.sum("queries").alias("queries"))
    )
    best = F.max(F.struct("queries", (-F.col("hour")).alias("_minus_hour"))).alias("_best")
    return hourly.groupBy(*by).agg(best).select(
        *by,
        (-F.col("_best._minus_hour")).alias("peak_query_time"),
        F.col("_best.queries").alias("queries"),
    )


def _summary_rows(intel: DataFrame) -> DataFrame:
    """A row per record and domain, with what the summaries count; ``by`` columns are the caller's."""
    columns = intel.columns
    located = F.lit(False)
    for field in ("country", "city"):
        if field in columns:
            located = located | (F.coalesce(F.col(field), F.lit("")) != "")
    part = F.coalesce("part", F.lit(0)) if "part" in columns else F.lit(0)
    kept = [c for c in columns if c not in ("ip", "domains", "domain", "part", "pos", "located", "head")]
    rows = intel.select(*kept, "ip", F.posexplode_outer("domains").alias("pos", "domain"), located.alias("located"), part.alias("part"))
    head = (F.coalesce("pos", F.lit(0)) == 0) & (F.col("part") == 0)
    return rows.select(*kept, "ip", F.nullif("domain", F.lit("")).alias("domain"), "located", head.alias("head"))


def intel_summary(intel: DataFrame) -> DataFrame:
    """One row: records, different IPs, different domains, and records with a country or city.

    A record in several parts counts once, by its part 0.

    The distinct counts run as two-step aggregations, so no task holds a whole set.
    """
    return _summary_rows(intel).agg(
        F.count_if("head").alias("records"),
        F.countDistinct("ip").alias("unique_ips"),
        F.countDistinct("domain").alias("unique_domains"),
        F.count_if(F.col("head") & F.col("located")).alias("enriched"),
    )


#: Sketches have 2**LG_K registers: a standard error of about 0.8 % at 14.
LG_K = 14


def summary_sketches(intel: DataFrame, by: str, lg_k: int = LG_K) -> DataFrame:
    """The figures of ``intel_summary`` for each ``by``, its distinct counts as sketches that can be united later."""
    return _summary_rows(intel).groupBy(by).agg(
        F.count_if("head").alias("records"),
        F.hll_sketch_agg("ip", lg_k).alias("ips"),
        F.hll_sketch_agg("domain", lg_k).alias("domains"),
        F.count_if(F.col("head") & F.col("located")).alias("enriched"),
    )


def united_summary(sketches: DataFrame) -> DataFrame:
    """One row like that of ``intel_summary``, from any number of sketched parts; distinct counts are estimates."""

    def estimate(name: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0))

    return sketches.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        estimate("ips").alias("unique_ips"),
        estimate("domains").alias("unique_domains"),
        F.coalesce(F.sum("enriched"), F.lit(0)).alias("enriched"),
    )
