"""Small helpers the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, nullcontext

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from nameledger.functions.text import let
from nameledger.session import shared_dir
from nameledger.sources.files import delete_tree

#: Words are separated by these characters: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
ROWS_OUT = 20_000
#: Spark's setting by which a query's shuffle files are removed when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting for how many rows go to a Python worker in one Arrow batch.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Spark's setting by which a stage's operators become one piece of generated code.
WHOLE_STAGE = "spark.sql.codegen.wholeStage"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text, in order, repeats included; null or blank text has none."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^{SPACES}", "")
    return let(F.split(bare, SPACES), lambda found: F.array_remove(found, ""))


def new_folder(spark: SparkSession, what: str) -> str:
    """A folder of its own for each call, where all executors can read and write."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session's setting has this value for what runs in the block."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, what: str, at_once: int | None = None) -> DataFrame:
    """The rows of ``df`` after they went to the shared folder: the plan behind them ends here.

    ``at_once`` bounds the rows that go to a Python worker in one batch, for rows of many kilobytes.
    """
    spark = df.sparkSession
    folder = new_folder(spark, what)
    with setting(spark, ARROW_ROWS, str(at_once)) if at_once else nullcontext():
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


class Scratch:
    """Tables in the shared folder that go when the block ends: what is still needed has to be written elsewhere by then.

    ``dictionaries`` has, by a table's name, how many bytes of different values may name a column's repeated ones in a file.
    """

    def __init__(self, spark: SparkSession, what: str, dictionaries: dict[str, int] | None = None):
        self.spark, self.folder, self.dictionaries = spark, new_folder(spark, what), dictionaries or {}

    def keep(self, df: DataFrame, what: str, at_once: int | None = None) -> DataFrame:
        """The rows of ``df`` after they were written, packed well: the plan behind them ends here, and its shuffle files go.

        ``at_once`` bounds the rows that go to a Python worker in one batch, as in ``written``.
        """
        to = df.write.option("compression", "zstd")
        if what in self.dictionaries:
            to = to.option("parquet.dictionary.page.size", self.dictionaries[what])
        with setting(self.spark, CLEANUP, "true"), setting(self.spark, ARROW_ROWS, str(at_once)) if at_once else nullcontext():
            to.parquet(f"{self.folder}/{what}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{what}")

    def drop(self, what: str) -> None:
        delete_tree(self.spark, f"{self.folder}/{what}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        delete_tree(self.spark, self.folder)


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterable[tuple]], schema: str, at_once: int | None = None) -> DataFrame:
    """Streams each partition through ``rows``: column lists of a batch in, tuples out, in Arrow batches.

    ``at_once`` bounds the rows taken from a batch and given out at a time, for rows of many kilobytes.
    """
    kind = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        parts = batches if at_once is None else (b.slice(i, at_once) for b in batches for i in range(0, b.num_rows, at_once))
        for row in rows(b.to_pydict() for b in parts):
            held.append(row)
            if len(held) >= (at_once or ROWS_OUT):
                yield batch()
                held = []
        if held:
            yield batch()

    return df.mapInArrow(run, kind)


def most_frequent(words: DataFrame, count: int, slots: int = 64) -> list[tuple[object, int]]:
    """The about ``count`` most frequent values of the column ``word`` and their estimated counts, most frequent first.

    Every row is counted, by sketches of bounded size. A value belongs to one of ``slots`` by its hash, and each slot's
    sketches are merged in a task of its own; the driver gets some values per slot.
    """
    per_slot = max(8, 4 * count // slots)
    slot = F.pmod(F.xxhash64("word"), F.lit(slots)).alias("slot")
    top = F.expr(f"approx_top_k(word, {per_slot}, {max(512, 8 * per_slot)})").alias("top")
    found = [x for row in words.where("word IS NOT NULL").groupBy(slot).agg(top).collect() for x in row["top"] or []]
    return sorted(((x["item"], x["count"]) for x in found), key=lambda x: (-x[1], x[0]))[:count]
