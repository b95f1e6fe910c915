"""Message payloads (JSON text) to typed rows, for batch and streaming DataFrames."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nameledger import schemas
from nameledger.functions.text import as_column, once, trimmed


FETCH_MESSAGES = 100  # fixed value
FETCH_WAIT = "5s"  # fixed value


def raw_records(payload: Column | str) -> Column:
    """ARRAY of raw records: a JSON array, or one object taken as a one-element array."""
    return F.from_json(as_column(payload), T.ArrayType(schemas.RAW_RECORD))


def feed_document(payload: Column | str, full: bool = False) -> Column:
    """A feed; ``full`` also reads the summaries that sensors add and nothing downstream needs."""
    return F.from_json(as_column(payload), schemas.FULL_FEED if full else schemas.FEED)


def event_list(payload: Column | str) -> Column:
    """ARRAY of events from ``[...]`` or ``{"events": [...]}``; null for any other payload."""
    text = trimmed(payload)
    wrapped = F.from_json(text, schemas.EVENT_ENVELOPE)["events"]
    return F.when(
        text.startswith("["), F.from_json(text, T.ArrayType(schemas.EVENT))
    ).when(text.startswith("{") & (F.size(wrapped) > 0), wrapped)


# One object of either shape; the last field receives text that does not fit the schema.
_DOCUMENT = T.StructType(
    [
        *schemas.RAW_RECORD.fields,
        *[f for f in schemas.FEED.fields if f.name not in schemas.RAW_RECORD.names],
        T.StructField("_misfit", T.StringType()),
    ]
)


def with_payload(df: DataFrame, col: str = "value") -> DataFrame:
    """Adds ``_raw`` (ARRAY of records), ``_feed`` and ``_shape`` ('raw', 'feed' or 'unknown').

    Each payload is parsed once, by its first character. An object with ``domain_correlations`` is
    a feed and any other object a raw record; ``null`` is an empty raw message.
    """
    text = trimmed(col)
    document = F.from_json(text, _DOCUMENT, {"columnNameOfCorruptRecord": "_misfit"})
    parsed = once(
        df,
        "_parsed",
        F.struct(
            F.when(text.startswith("["), raw_records(text)).alias("list"),
            F.when(text.startswith("{"), document).alias("doc"),
            (text == "null").alias("null"),
        ),
    )
    items, doc = F.col("_parsed.list"), F.col("_parsed.doc")
    # A mistyped field is tolerated, text that is not JSON at all is not.
    readable = doc["_misfit"].isNull() | F.try_parse_json(doc["_misfit"]).isNotNull()
    records = (F.size(items) == 0) | F.exists(items, lambda r: r.isNotNull())
    shape = (
        F.when(records | F.col("_parsed.null"), "raw")
        .when(doc.isNotNull() & readable,
              F.when(doc["domain_correlations"].isNotNull(), "feed").otherwise("raw"))
        .otherwise("unknown")
    )
    fields = lambda schema: F.struct(*[doc[name] for name in schema.names])
    shaped = parsed.withColumn("_shape", shape)
    is_raw, is_feed = F.col("_shape") == "raw", F.col("_shape") == "feed"
    lone = F.when(is_raw & doc.isNotNull(), F.array(fields(schemas.RAW_RECORD)))
    return shaped.withColumns(
        {
            "_raw": F.coalesce(F.when(is_raw, items), lone),
            "_feed": F.when(is_feed, fields(schemas.FEED)),
        }
    ).drop("_parsed")


def _exploded(df: DataFrame, items: Column, keep: Sequence[str]) -> DataFrame:
    # The outer form, as Spark would work the array out twice to skip empty ones beforehand.
    rows = df.select(*keep, F.explode_outer(items).alias("_item"))
    return rows.where(F.col("_item").isNotNull()).select(*keep, "_item.*")


def parse_raw(df: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per raw record; columns named in ``keep`` are carried along."""
    return _exploded(df, raw_records(col), keep)


def parse_feed(
    df: DataFrame, col: str = "value", keep: Sequence[str] = (), full: bool = False
) -> DataFrame:
    """One row per feed document; text that is not a feed object is left out."""
    parsed = df.select(*keep, feed_document(col, full).alias("_feed"))
    named = parsed.where(
        F.col("_feed.feed_type").isNotNull() | F.col("_feed.domain_correlations").isNotNull()
    )
    return named.select(*keep, "_feed.*")


def parse_events(df: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per event; payloads without events give no row (see ``unparsed_events``)."""
    return _exploded(df, event_list(col), keep)


def unparsed_events(df: DataFrame, col: str = "value") -> DataFrame:
    """Payloads no event list can be read from, with a reason."""
    text = trimmed(col)
    bad = event_list(col).isNull() & (F.coalesce(text, F.lit("")) != "null")
    return df.where(bad).withColumn("reason", F.lit("no parsable events"))


def shaped_messages(df: DataFrame, col: str = "value") -> DataFrame:
    """The messages with their ``shape`` ('raw', 'feed' or 'unknown') and, for the last, a ``reason``.

    Each payload is parsed once. Whoever writes the three kinds apart can persist this, or partition by ``shape``.
    """
    unknown = F.col("_shape") == "unknown"
    reason = F.when(unknown, "neither raw records nor a feed")
    return with_payload(df, col).select(*df.columns, F.col("_shape").alias("shape"), reason.alias("reason"))


def route_messages(df: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw, feed, rejects) by message shape; rejects carry a reason.

    Three views of one parse: persist ``shaped_messages`` and pass it as ``df`` to read the source once.
    """
    shaped = df if {"shape", "reason"} <= set(df.columns) else shaped_messages(df, col)
    raw, feed, unknown = (shaped.where(F.col("shape") == name).drop("shape") for name in ("raw", "feed", "unknown"))
    return raw.drop("reason"), feed.drop("reason"), unknown


def read_stream(
    spark: SparkSession,
    source: str,
    fmt: str = "text",
    max_per_batch: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stream of payloads in a ``value`` column.

    ``fmt`` is a file format (``source`` is a folder) or ``kafka`` (``source`` is a topic, and
    ``options`` name the brokers). Everything present is delivered from the start; the query's
    checkpoint keeps the position. A topic's batch starts with ``FETCH_MESSAGES`` messages or after ``FETCH_WAIT``,
    whichever is first, and takes all there is; ``max_per_batch`` bounds messages, or files, on request only.
    """
    options = options or {}
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").options(**topic_options(source, max_per_batch))
        return reader.options(**options).load().select(F.col("value").cast("string"))
    reader = spark.readStream.format(fmt)
    if max_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_batch)
    if fmt == "text":
        reader = reader.schema("value string")
    return reader.options(**options).load(source)


def topic_options(topic: str, max_per_batch: int | None = None) -> dict[str, str]:
    found = {
        "subscribe": topic,
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(FETCH_MESSAGES),
        "maxTriggerDelay": FETCH_WAIT,
    }
    if max_per_batch is not None:
        found["maxOffsetsPerTrigger"] = str(max_per_batch)
    return found
