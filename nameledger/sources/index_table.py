"""The IP index kept in hash buckets, and brought up to date at the price of what changed.

A bucketed table is read as it lies: joining it by ``ip`` moves the other side to its buckets and not the table. An update
therefore passes the untouched addresses through and regroups the touched ones alone.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nameledger.operators.index import address_pairs, ip_index
from nameledger.plans.skew import collect_in_parts
from nameledger.sources import files

COLUMNS = ["ip", "part", "domains", "last_seen"]
_ABOUT = "_buckets.json"


def write_index_table(index: DataFrame, path: str, buckets: int, spread: int = 1) -> None:
    """Writes index rows in ``buckets`` by ip; ``spread`` is the number of parts its addresses may have.

    The folder must not exist. The catalog entry that writing needs is dropped again: the folder describes itself.
    """
    spark = index.sparkSession
    name = f"index_{uuid.uuid4().hex}"
    rows = index.select(*COLUMNS).repartition(buckets, "ip").sortWithinPartitions("ip")
    rows.write.format("parquet").option("path", path).bucketBy(buckets, "ip").sortBy("ip").mode("error").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    files.write_new(spark, f"{path}/{_ABOUT}", json.dumps({"buckets": buckets, "spread": spread}))


def _about(spark: SparkSession, path: str) -> dict[str, int]:
    return json.loads(files.read_text(spark, f"{path}/{_ABOUT}"))


def read_index_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a written index, with its buckets known to the planner."""
    buckets = _about(spark, path)["buckets"]
    name = f"index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (ip STRING, part INT, domains ARRAY<STRING>, last_seen BIGINT) USING parquet "
        f"CLUSTERED BY (ip) SORTED BY (ip) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def updated_index(old: DataFrame, changed: DataFrame, spread: int = 1) -> DataFrame:
    """``old`` with the pairs (ip, domain, last_seen) of ``changed`` added: all domains of both and the later time.

    Addresses that ``changed`` doesn't name pass as they are. Domains of the others are opened and collected again.
    """
    touched = changed.select("ip").distinct()
    same = old.join(touched, "ip", "left_anti").select(*COLUMNS)
    opened = old.join(touched, "ip", "left_semi").select("ip", F.explode("domains").alias("domain"), "last_seen")
    pairs = opened.unionByName(changed.select("ip", "domain", "last_seen"))
    made = collect_in_parts(
        pairs, ["ip"], {"domains": F.col("domain")}, F.col("domain"), key_aggs={"last_seen": F.max("last_seen")}, buckets=spread
    )
    return same.unionByName(made.select(*COLUMNS))


def rebuilt_index(old: DataFrame, state: DataFrame, gone: DataFrame, spread: int = 1) -> DataFrame:
    """``old`` after changes that may take domains away: the addresses of ``gone`` (ip) are collected anew from ``state``."""
    touched = gone.select("ip").distinct()
    same = old.join(touched, "ip", "left_anti").select(*COLUMNS)
    rows = state.join(touched.withColumnRenamed("ip", "value"), "value", "left_semi")
    return same.unionByName(ip_index(rows, buckets=spread).select(*COLUMNS))


def update_index_table(spark: SparkSession, old: str, new: str, changes: DataFrame, state: DataFrame | None = None) -> None:
    """Writes the index of folder ``old`` after ``changes`` to the folder ``new``.

    ``changes`` are what ``state_changes`` gives: state rows with ``op``. Deletes need ``state``, the table after them:
    a domain that one type of record lost an address may still have it by another, and times may fall.
    """
    about = _about(spark, old)
    grown = changes.where("op <> 'delete'")
    held = read_index_table(spark, old)
    addresses = changes.where("type = 'A'")
    if state is None:
        made = updated_index(held, address_pairs(grown), about["spread"])
    else:
        made = rebuilt_index(held, state, addresses.select(F.col("value").alias("ip")), about["spread"])
    write_index_table(made, new, about["buckets"], about["spread"])
