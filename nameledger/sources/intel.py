"""Index and list files: NDJSON intel records, IP lists, and how they are written."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nameledger import schemas
from nameledger.functions.records import first_domain, last_seen_or_zero, to_intel_json
from nameledger.functions.text import non_empty, once, trimmed
from nameledger.sources import files

# The last field receives text that does not fit the schema.
_LINE = schemas.T.StructType(
    [
        *[
            schemas.T.StructField(f.name, schemas.T.StringType() if f.name == "last_seen" else f.dataType)
            for f in schemas.IP_INTEL
        ],
        schemas.T.StructField("_misfit", schemas.T.StringType()),
    ]
)


def read_ip_intel(spark: SparkSession, path: str) -> DataFrame:
    """(ip, part, domains, domain, last_seen, country, city) from NDJSON lines.

    Blank and malformed lines and lines without an IP are left out. A missing list is empty, a
    missing or non-numeric time is 0, and the older single ``domain`` field is kept as it is.
    """
    lines = spark.read.text(path).where(trimmed("value") != "")
    parsed = once(lines, "_r", F.from_json("value", _LINE, {"columnNameOfCorruptRecord": "_misfit"}))
    # a line is read again only if it did not fit: mistyped fields are tolerated, text that is no JSON is not
    readable = F.col("_r._misfit").isNull() | F.try_parse_json("_r._misfit").isNotNull()
    named = parsed.where(readable & (F.coalesce(F.col("_r.ip"), F.lit("")) != "")).select("_r.*").drop("_misfit")
    return named.withColumns(
        {
            "part": F.coalesce("part", F.lit(0)),
            "domains": F.coalesce("domains", F.array().cast("array<string>")),
            "last_seen": last_seen_or_zero("last_seen"),
            "country": non_empty("country"),
            "city": non_empty("city"),
        }
    )


def read_ip_list(spark: SparkSession, path: str) -> DataFrame:
    """One ``ip`` per non-blank line."""
    return spark.read.text(path).select(trimmed("value").alias("ip")).where(F.col("ip") != "")


def ip_geo(intel: DataFrame) -> DataFrame:
    """Flat (ip, domain, country, city) of each record that names a domain.

    Of an IP in several parts one row comes out, with the alphabetically first of what its parts list first.
    """
    legacy = "domain" if "domain" in intel.columns else None
    flat = intel.select("*", first_domain("domains", legacy).alias("_first")).where(F.col("_first").isNotNull())
    if "part" in intel.columns:
        flat = flat.groupBy("ip", "country", "city").agg(F.min("_first").alias("_first"))
    return flat.select("ip", F.col("_first").alias("domain"), "country", "city")


def write_ip_index(df: DataFrame, path: str, by_ip: bool = True) -> None:
    """NDJSON in IP order; nulls are left out, and so is ``part`` for IPs that have only one."""
    out = df
    if "part" in df.columns:
        out = out.withColumn("part", F.nullif("part", F.lit(0)))
    if by_ip:
        out = out.orderBy("ip", *([F.col("part").asc_nulls_first()] if "part" in df.columns else []))
    _write_lines(out, path)


def _write_lines(df: DataFrame, path: str) -> None:
    df.select(to_intel_json(F.struct(*df.columns)).alias("value")).write.mode("errorifexists").text(path)


def write_ip_list(df: DataFrame, path: str) -> None:
    df.select("ip").write.mode("errorifexists").text(path)


def write_ip_geo(df: DataFrame, path: str) -> None:
    out = df.select("ip", "domain", non_empty("country").alias("country"), non_empty("city").alias("city"))
    _write_lines(out, path)


# --- versioned outputs -------------------------------------------------------------------------


def versioned_path(prefix: str, now: datetime | None = None) -> str:
    """``prefix-YYYYMMDDHHMMSS`` in UTC."""
    moment = now or datetime.now(timezone.utc)
    return f"{prefix}-{moment.astimezone(timezone.utc):%Y%m%d%H%M%S}"


def replace_output(
    df: DataFrame, root: str, prefix: str = "intel", fmt: str = "json", now: datetime | None = None
) -> str:
    """Writes a new version under ``root`` and then makes it the current one; returns its path.

    Readers go through ``current_output``, so they see the old output or the whole new one.
    """
    spark = df.sparkSession
    path = versioned_path(f"{root}/{prefix}", now)
    df.write.mode("errorifexists").format(fmt).option("ignoreNullFields", True).save(path)
    pointer = int((_pointers(spark, root) or ["0"])[-1]) + 1
    files.write_new(spark, f"{root}/_current/{pointer:012d}", path.rsplit("/", 1)[1])
    return path


def _pointers(spark: SparkSession, root: str) -> list[str]:
    return [n for n in files.names_in(spark, f"{root}/_current") if n[0] != "."]


def current_output(spark: SparkSession, root: str, back: int = 0) -> str | None:
    """Path of the current output, or of the one ``back`` versions before it."""
    pointers = _pointers(spark, root)
    if len(pointers) <= back:
        return None
    name = files.read_text(spark, f"{root}/_current/{pointers[-1 - back]}")
    return f"{root}/{name.strip()}"


# --- events and rejects ------------------------------------------------------------------------


def event_messages(messages: DataFrame) -> DataFrame:
    """One JSON array per message that has events, in a ``value`` column."""
    # The outer form, as a filter on the array would be pushed down and work the events out a second time.
    text = F.when(F.size("events") > 0, F.to_json("events"))
    return messages.select(F.explode_outer(F.array(text)).alias("value")).where(F.col("value").isNotNull())


def write_events(messages: DataFrame, path: str) -> None:
    event_messages(messages).write.mode("append").text(path)


def write_rejects(rejects: DataFrame, path: str) -> None:
    """Refused rows as JSON, each with its ``reason``."""
    rejects.where(F.col("reason").isNotNull()).write.mode("append").json(path)
