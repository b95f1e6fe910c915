"""Lookups by IP and by domain, over one key or a whole table of keys."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nameledger.functions.domains import DEFAULT_SHARDS, normalize_domain, shard_id
from nameledger.functions.text import once
from nameledger.functions.records import make_key
from nameledger.operators.fold import SHARD_COUNT
from nameledger.plans.skew import collect_in_parts, join_spread


def _latest(df: DataFrame, keys: list[str]) -> DataFrame:
    """The row with the greatest last_seen per key; ties go to the greatest other columns."""
    rest = [c for c in df.columns if c not in (*keys, "last_seen")]
    newest = F.max(F.struct("last_seen", *rest)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def latest_by_ip(df: DataFrame) -> DataFrame:
    """The record with the greatest last_seen per IP; all parts of it when it is in parts."""
    if "part" not in df.columns:
        return _latest(df, ["ip"])
    # the parts of an IP meet in one exchange, which serves the grouping by IP and part as well
    newest = F.max("last_seen").over(Window.partitionBy("ip"))
    current = df.withColumn("_newest", newest).where(F.col("last_seen") == F.col("_newest"))
    return _latest(current.drop("_newest"), ["ip", "part"])


def explode_domains(df: DataFrame) -> DataFrame:
    """One row per (domain, record); empty domain names are left out."""
    rest = [c for c in df.columns if c not in ("domains", "domain")]
    pairs = df.select(F.explode("domains").alias("domain"), *rest)
    return pairs.where(F.col("domain") != "")


def latest_by_domain_ip(df: DataFrame) -> DataFrame:
    """For exploded records: the one with the greatest last_seen per (domain, ip)."""
    return _latest(df, ["domain", "ip"])


def domain_view_flat(intel: DataFrame) -> DataFrame:
    """One row per (domain, ip): what a domain lookup lists, for every domain.

    The IP's own list of domains is left out: it would be repeated for every one of them.
    """
    wanted = [c for c in ("ip", "domains", "last_seen", "country", "city") if c in intel.columns]
    return latest_by_domain_ip(explode_domains(intel.select(*wanted)))


def domain_view(intel: DataFrame, buckets: int = 1) -> DataFrame:
    """(domain, part, ips): the IP records of each domain, latest first within a part, ties by IP.

    ``domain_view_ranked`` has the order over a whole domain, however many IPs it has.
    """
    flat = domain_view_flat(intel)
    fields = [c for c in flat.columns if c not in ("domain", "last_seen", "ip")]
    record = F.struct((-F.col("last_seen")).alias("_order"), "ip", "last_seen", *fields)

    def newest_first(items: Column) -> Column:
        return F.transform(
            F.array_sort(items),
            lambda r: F.struct(*[r[name].alias(name) for name in ("ip", "last_seen", *fields)]),
        )

    return collect_in_parts(
        flat,
        keys=["domain"],
        collected={"ips": record},
        spread_on=F.col("ip"),
        finish={"ips": newest_first},
        buckets=buckets,
    )


def domain_view_ranked(intel: DataFrame) -> DataFrame:
    """``domain_view_flat`` with ``order``, which sorts a domain's rows latest first, ties by IP."""
    flat = domain_view_flat(intel)
    return flat.withColumn("order", F.struct((-F.col("last_seen")).alias("age"), F.col("ip")))


def canonical(keys: DataFrame, idna: bool = True) -> DataFrame:
    """The keys with ``name``, the canonical form of ``domain``; text that is no domain stands for itself."""
    return once(keys, "name", F.coalesce(normalize_domain("domain", idna=idna), F.col("domain")))


def resolve(
    state: DataFrame,
    domains: DataFrame | None = None,
    buckets: int = 1,
    idna: bool = True,
) -> DataFrame:
    """(domain, part, ips, cnames, last_seen) of each domain, or of the listed ``domains``.

    ``last_seen`` is over all record types, but 0 when there is neither an address nor an alias.
    Listed domains are looked up, and come back, in canonical form; one without state has empty arrays and 0.
    """
    if domains is not None:
        wanted = canonical(domains.select("domain"), idna).select(F.col("name").alias("domain")).distinct()
        state = state.join(wanted, "domain", "left_semi")
    is_a, is_cname = F.col("type") == "A", F.col("type") == "CNAME"
    answered = F.count_if(is_a | is_cname) > 0
    out = collect_in_parts(
        state,
        keys=["domain"],
        collected={
            "ips": F.when(is_a & (F.col("value") != ""), F.col("value")),
            "cnames": F.when(is_cname & (F.col("value") != ""), F.col("value")),
        },
        spread_on=F.col("value"),
        key_aggs={
            "last_seen": F.when(answered, F.coalesce(F.max("last_seen"), F.lit(0))).otherwise(0)
        },
        buckets=buckets,
    )
    if domains is None:
        return out
    empty = F.array().cast("array<string>")
    found = wanted.join(out, "domain", "left")
    return found.select(
        "domain",
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("ips", empty).alias("ips"),
        F.coalesce("cnames", empty).alias("cnames"),
        F.coalesce("last_seen", F.lit(0)).alias("last_seen"),
    )


def _attach(keys: DataFrame, hits: DataFrame, on: list[str]) -> DataFrame:
    marked = hits.withColumn("found", F.lit(True))
    return join_spread(keys, marked, on).withColumn("found", F.coalesce("found", F.lit(False)))


def lookup(table: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Every key row with its matches in ``table``; ``found`` is false and the rest null without.

    The keys cut the table down first (a semi join Spark broadcasts when the keys are small), so a
    large table is not shuffled to answer a short list.
    """
    hits = table.join(keys.select(*on).distinct(), on, "left_semi")
    return _attach(keys, hits, on)


def lookup_ips(intel: DataFrame, keys: DataFrame) -> DataFrame:
    """The latest record of each requested IP.

    An IP has one record, or as many as it has parts, so only the keys can repeat: a left join splits them when hot.
    """
    hits = intel.join(keys.select("ip").distinct(), "ip", "left_semi")
    latest = latest_by_ip(hits).withColumn("found", F.lit(True))
    return keys.join(latest, "ip", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def lookup_domains(
    intel: DataFrame, keys: DataFrame, with_lists: bool = False, idna: bool = True
) -> DataFrame:
    """One row per IP of each requested domain; a domain without any gives one row of nulls.

    Keys are looked up in canonical form and come back as they were given. ``with_lists`` adds the IP's own
    ``domains`` list (by parts where the IP has several).
    """
    keys = canonical(keys, idna)
    wanted = keys.select(F.col("name").alias("domain")).distinct()
    hits = latest_by_domain_ip(explode_domains(intel.drop("part")).join(wanted, "domain", "left_semi"))
    if with_lists:
        named = intel.join(hits.select("ip").distinct(), "ip", "left_semi")
        lists = latest_by_ip(named).select(
            "ip", *[c for c in ("part", "domains") if c in intel.columns]
        )
        hits = hits.join(lists, "ip")
    return _attach(keys, hits.withColumnRenamed("domain", "name"), ["name"]).drop("name")


def _shard_count(state: DataFrame) -> int | None:
    """The number of shards of a stored table, which ``read_state`` notes on its shard column."""
    return state.schema["shard_id"].metadata.get(SHARD_COUNT) if "shard_id" in state.columns else None


def _in_its_shard(state: DataFrame, domain: Column) -> Column:
    """Narrows a scan to the domain's shard where the table says how many it has; true otherwise."""
    count = _shard_count(state)
    return F.lit(True) if count is None else F.col("shard_id") == shard_id(domain, count)


def _canonical_text(state: DataFrame, domain: str) -> str:
    unusual = not domain.isascii() or "xn--" in domain.lower()
    name = F.coalesce(normalize_domain(F.lit(domain), idna=unusual), F.lit(domain))
    return state.sparkSession.range(1).select(name).first()[0]


def _one_domain(state: DataFrame, domain: str) -> DataFrame:
    """State rows of one domain; names the shard too where the table is laid out by shard.

    The canonical name is worked out first, so that the scan gets a plain value to prune by.
    """
    name = F.lit(_canonical_text(state, domain))
    return state.where((F.col("domain") == name) & _in_its_shard(state, name))


def resolve_domain(state: DataFrame, domain: str) -> DataFrame:
    """``resolve`` for one name given as text."""
    return resolve(_one_domain(state, domain))


def query_domain(state: DataFrame, domain: str, limit: int = 100) -> DataFrame:
    """First records of a domain in key order; a limit of 0 or less means 100."""
    return _one_domain(state, domain).orderBy("type", "value").limit(limit if limit > 0 else 100)


def inspect_shard(
    state: DataFrame, shard: int, limit: int = 20, n_shards: int | None = None
) -> DataFrame:
    """First records of one shard in key order; a limit of 0 or less means 20.

    The number of shards is that of the stored table; ``n_shards`` is for rows that come from none.
    """
    count = _shard_count(state) or n_shards or DEFAULT_SHARDS
    if not 0 <= shard < count:
        raise ValueError(f"shard {shard} is out of range for {count} shards")
    if "shard_id" not in state.columns:
        state = state.withColumn("shard_id", shard_id("domain", count))
    keyed = state.where(F.col("shard_id") == shard).withColumn(
        "key", make_key("domain", "type", "value")
    )
    return keyed.orderBy("key").limit(limit if limit > 0 else 20)


def get_key(state: DataFrame, domain: str, rtype: str, value: str) -> DataFrame:
    """The state row of one exact key; the domain is taken in canonical form."""
    hit = (F.col("type") == rtype) & (F.col("value") == value)
    return _one_domain(state, domain).where(hit)
