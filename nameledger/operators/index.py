"""The IP → domains index and what is derived from it.

Index rows are (ip, part, domains, last_seen). With the default of one bucket every IP is one row, part 0; with
more, the domains of every IP are spread over parts that all carry its overall ``last_seen``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameledger.functions.domains import DEFAULT_SHARDS, shard_id
from nameledger.functions.ip import ip_version
from nameledger.functions.records import first_domain
from nameledger.plans.skew import collect_in_parts


def address_pairs(state: DataFrame) -> DataFrame:
    """(ip, domain, last_seen) of the A rows; the value is not checked to be an address."""
    return state.where(F.col("type") == "A").select(
        F.col("value").alias("ip"), "domain", F.coalesce("last_seen", F.lit(0)).alias("last_seen")
    )


def ip_index(
    state: DataFrame, shard_order: int | None = None, buckets: int = 1
) -> DataFrame:
    """Inverted index of the A rows: the distinct domains of each IP and its latest time.

    Domains are in alphabetical order, or by (shard, domain) for ``shard_order`` shards.
    """
    return _collect(address_pairs(state), shard_order, buckets)


def _collect(pairs: DataFrame, shard_order: int | None, buckets: int) -> DataFrame:
    if shard_order is None:
        item, finish = F.col("domain"), F.array_sort
    else:
        item = F.struct(
            shard_id("domain", shard_order).alias("shard"), F.col("domain").alias("domain")
        )

        def finish(items):
            return F.transform(F.array_sort(items), lambda i: i["domain"])

    out = collect_in_parts(
        pairs,
        keys=["ip"],
        collected={"domains": item},
        spread_on=F.col("domain"),
        finish={"domains": finish},
        key_aggs={"last_seen": F.max("last_seen")},
        buckets=buckets,
    )
    return out.select("ip", "part", "domains", "last_seen")


def merge_ip_index(
    old: DataFrame, new: DataFrame, buckets: int = 1
) -> DataFrame:
    """Union of two indexes: all domains of both and the later time of each IP."""
    both = old.select("ip", "domains", "last_seen").unionByName(
        new.select("ip", "domains", "last_seen")
    )
    pairs = both.select("ip", F.explode("domains").alias("domain"), "last_seen")
    return _collect(pairs, None, buckets)


def ip_first_domain(state: DataFrame, n_shards: int = DEFAULT_SHARDS) -> DataFrame:
    """(ip, domain): the domain a fresh index lists first, without building the lists."""
    ranked = F.struct(shard_id("domain", n_shards).alias("shard"), F.col("domain").alias("domain"))
    best = address_pairs(state).groupBy("ip").agg(F.min(ranked).alias("_first"))
    return best.select("ip", F.col("_first.domain").alias("domain"))


def distinct_ips(state: DataFrame) -> DataFrame:
    """Every valid address among the A and AAAA rows, once."""
    addresses = state.where(F.col("type").isin("A", "AAAA") & (ip_version("value") > 0))
    return addresses.select(F.col("value").alias("ip")).distinct()


def restrict_to_ips(df: DataFrame, ips: DataFrame) -> DataFrame:
    """Rows whose ``ip`` is in the list."""
    return df.join(ips.select("ip").distinct(), "ip", "left_semi")


def dedupe_ip_first(df: DataFrame, order_col: str) -> DataFrame:
    """(ip, domain) of the first usable record of each IP in the order of ``order_col``."""
    legacy = "domain" if "domain" in df.columns else None
    usable = df.select("ip", first_domain("domains", legacy).alias("domain"), order_col).where(
        F.col("domain").isNotNull() & (F.coalesce("ip", F.lit("")) != "")
    )
    firsts = usable.groupBy("ip").agg(
        F.min(F.struct(F.col(order_col), F.col("domain"))).alias("_first")
    )
    return firsts.select("ip", F.col("_first.domain").alias("domain"))


def changed_ips(old: DataFrame, new: DataFrame) -> DataFrame:
    """IPs of ``new`` that ``old`` lacks or maps to another domain; ``change`` says which."""
    before = old.select("ip", F.col("domain").alias("_old_domain"), F.lit(True).alias("_known"))
    compared = new.select("ip", "domain").join(before, "ip", "left")
    same = F.col("domain").eqNullSafe(F.col("_old_domain"))
    return compared.where(F.col("_known").isNull() | ~same).select(
        "ip",
        "domain",
        F.when(F.col("_known").isNull(), "new").otherwise("changed").alias("change"),
    )


def compact_staging(staging: DataFrame, how: str = "recent") -> DataFrame:
    """One domain per valid IP: the most recently seen, or the most often seen.

    Ties go to the later time, then to the alphabetically later domain.
    """
    ip = F.trim("ip")
    valid = staging.where(ip_version(ip) > 0).withColumn("ip", ip)
    pairs = valid.groupBy("ip", "domain").agg(
        F.count(F.lit(1)).alias("times"), F.max("last_seen").alias("last_seen")
    )
    ranks = {
        "recent": F.struct("last_seen", "domain"),
        "frequent": F.struct("times", "last_seen", "domain"),
    }
    best = pairs.groupBy("ip").agg(
        F.max_by(F.struct("domain", "times", "last_seen"), ranks[how]).alias("_best")
    )
    return best.select("ip", "_best.*")
