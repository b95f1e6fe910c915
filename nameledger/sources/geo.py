"""Geo range CSV files, with or without a header."""

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nameledger.functions.ip import (
    cidr_range_v4,
    cidr_range_v6,
    ipv4_to_long,
    ipv6_to_bytes,
)
from nameledger.functions.text import non_empty, trimmed

# Column names looked for in headered files, in order of preference.
NETWORK = "network"
START_COLUMNS = ("ip_range_start", "start_ip")
END_COLUMNS = ("ip_range_end", "end_ip")
COUNTRY_COLUMNS = ("country_iso_code", "country_code", "country")
CITY_COLUMNS = ("city_name", "city")

_PLAIN_SCHEMA = ", ".join(f"c{i} string" for i in range(6)) + ", _odd string"


def has_header(first_line: str) -> bool:
    """A first line is data only if its first two cells both start with a digit."""
    cells = [cell.strip() for cell in first_line.split(",")]
    return len(cells) >= 2 and not all(cell[:1].isdigit() for cell in cells[:2])


def layouts(spark: SparkSession, path: str) -> dict[str | None, list[str]]:
    """The files of a folder by header line; those without a header under None. One job; the driver gets a line per file."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    firsts = lines.where("file_block_start = 0").groupBy("file_path").agg(F.min_by("value", "at").alias("first"))
    found: dict[str | None, list[str]] = {}
    for row in sorted(firsts.collect()):
        found.setdefault(row["first"] if has_header(row["first"]) else None, []).append(unquote(row.file_path))
    return found


def read_geo_csv(spark: SparkSession, path: str, version: int) -> DataFrame:
    """(start, end, country, city) of the rows of one IP version; unusable rows are left out.

    Every file is read by its own first line: a folder may mix files with a header, with other columns or another order
    of them, and without one. Files of one layout are read together.
    """
    out = None
    for header, paths in layouts(spark, path).items():
        if header is None:
            rows = _from_plain(spark, paths, version)
        else:
            rows = _from_named(spark.read.option("header", True).csv(paths), version)
        out = rows if out is None else out.unionByName(rows)
    return _from_plain(spark, [path], version) if out is None else out


def _from_plain(spark: SparkSession, paths: list[str], version: int) -> DataFrame:
    # Lines of more or fewer than six cells are also kept as text, in ``_odd``: an empty third cell
    # and a missing one both read as null, and only the latter makes the line too short.
    plain = (
        spark.read.schema(_PLAIN_SCHEMA)
        .option("columnNameOfCorruptRecord", "_odd")
        .option("columnPruning", False)  # the cells of a line are only counted when all are read
        .csv(paths)
    )
    too_short = F.col("c2").isNull() & (F.size(F.split("_odd", ",")) < 3)
    wide_enough = plain.where(~F.coalesce(too_short, F.lit(False)))
    ends = _bounds(F.col("c0"), F.col("c1"), version)
    return _usable(wide_enough, ends, F.col("c2"), F.col("c5"))


def _from_named(rows: DataFrame, version: int) -> DataFrame:
    def pick(names: tuple[str, ...]) -> Column:
        present = [non_empty(name) for name in names if name in rows.columns]
        return F.coalesce(*present, F.lit(None).cast("string"))

    ends = _bounds(pick(START_COLUMNS), pick(END_COLUMNS), version)
    if NETWORK in rows.columns:
        cidr = cidr_range_v4(NETWORK) if version == 4 else cidr_range_v6(NETWORK)
        ends = F.when(non_empty(NETWORK).isNotNull(), cidr).otherwise(ends)
    return _usable(rows, ends, pick(COUNTRY_COLUMNS), pick(CITY_COLUMNS))


def _bounds(start: Column, end: Column, version: int) -> Column:
    number = ipv4_to_long if version == 4 else ipv6_to_bytes
    return F.struct(number(trimmed(start)).alias("start"), number(trimmed(end)).alias("end"))


def _usable(rows: DataFrame, ends: Column, country: Column, city: Column) -> DataFrame:
    placed = rows.select(
        ends.alias("_ends"),
        F.coalesce(trimmed(country), F.lit("")).alias("country"),
        F.coalesce(trimmed(city), F.lit("")).alias("city"),
    )
    whole = F.col("_ends.start").isNotNull() & (F.col("_ends.end") >= F.col("_ends.start"))
    return placed.where(whole).select("_ends.start", "_ends.end", "country", "city")
