"""The running queries: messages → events, events → state, and their figures.

Delivery is at least once: Spark commits a batch's position after the batch is written, and folding a
replayed batch again changes nothing. Failed tasks are retried
by Spark (``spark.task.maxFailures``); a query that stops resumes from its checkpoint.
"""

import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from nameledger.functions.domains import DEFAULT_SHARDS, shard_id
from nameledger.functions.text import once as once_per_row
from nameledger.operators.fold import STATE_KEY, fold_events, shard_distribution
from nameledger.operators.ingest import judged_events, messages_to_events
from nameledger.sources.intel import event_messages
from nameledger.sources.state import compact_state, delete_state, drop_old_versions, load_version, upsert_state

T = TypeVar("T")
log = logging.getLogger(__name__)

RETRIES = 3  # fixed value
RETRY_WAIT = 0.5  # fixed value, seconds; it grows by itself with each attempt
PUBLISH_WAIT = 1.0  # fixed value, seconds; likewise
#: The name under which a stream's batches report their events, rejects and events per shard.
OBSERVED = "figures"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def retried(action: Callable[[], T], attempts: int = RETRIES, wait: float = RETRY_WAIT) -> T:
    """Runs a step that may safely be repeated, waiting a little longer before each new attempt."""
    for attempt in range(1, attempts):
        try:
            return action()
        except Exception as error:  # any failure of the step; the last one is passed on
            log.warning("attempt %d of %d failed: %s", attempt, attempts, error)
            time.sleep(wait * attempt)
    return action()


class Totals(StreamingQueryListener):
    """Batches, rows and busy time of every query since it started, also those Spark no longer keeps.

    ``figures`` are the sums of what a query observes in its batches, ``last_figures`` those of the last batch.
    """

    def __init__(self) -> None:
        self.runs: dict[str, dict[str, float]] = {}
        self.figures: dict[str, dict[str, int]] = {}
        self.last_figures: dict[str, dict[str, int]] = {}

    def take(self, progress) -> None:
        observed = (progress.observedMetrics or {}).get(OBSERVED)
        figures = observed.asDict() if observed is not None else None
        self.add(str(progress.runId), progress.batchId, progress.numInputRows, progress.durationMs.get("triggerExecution", 0) / 1000, figures)

    def add(self, run: str, batch: int, rows: int, seconds: float, figures: dict[str, int] | None = None) -> None:
        held = self.runs.setdefault(run, {"last": -1, "batches": 0.0, "rows": 0.0, "seconds": 0.0, "last_batch_rows": 0.0})
        if batch <= held["last"]:
            return
        held["last"] = batch
        if figures:
            sums = self.figures.setdefault(run, {})
            for name, n in figures.items():
                sums[name] = sums.get(name, 0) + (n or 0)
            self.last_figures[run] = {name: n or 0 for name, n in figures.items()}
        if rows:
            held["batches"] += 1
            held["rows"] += rows
            held["seconds"] += seconds
            held["last_batch_rows"] = float(rows)

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the interface's name
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.take(event.progress)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


_listeners: dict[str, Totals] = {}


def totals_of(spark: SparkSession) -> Totals:
    """The session's listener; it is added with the first query."""
    app = spark.sparkContext.applicationId
    if app not in _listeners:
        _listeners[app] = Totals()
        spark.streams.addListener(_listeners[app])
    return _listeners[app]


def _started(
    writer: DataStreamWriter, checkpoint: str, once: bool, every: str | None = None, one_batch: bool = False
) -> StreamingQuery:
    """Starts a query whose batches follow each other at once, or every so often (``every``)."""
    totals_of(SparkSession.active())
    writer = writer.option("checkpointLocation", checkpoint)
    if once and one_batch:
        writer = writer.trigger(once=True)
    elif once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def start_normalizer(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    rejects: str | None = None,
    mode: str = "lenient",
    once: bool = False,
    idna: bool = True,
    name: str | None = None,
    topic: dict[str, str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Raw-record and feed messages to event messages in ``target``, refused ones to ``rejects``.

    ``target`` is a folder, or a topic when ``topic`` gives the options of its brokers. Without ``rejects``
    the query is a plain map over the stream. With it, each batch is read once, kept while its two
    outputs are written, and writing is tried again when it fails.
    """
    routed = messages_to_events(messages, mode=mode, idna=idna)
    if rejects is None:
        writer = event_messages(routed).writeStream
        if topic is None:
            writer = writer.format("text").option("path", target)
        else:
            writer = writer.format("kafka").options(**{**topic, "topic": target})
    else:

        def publish(batch: DataFrame, number: int) -> None:
            if topic is None:
                event_messages(batch).write.mode("overwrite").text(f"{target}/batch={number}")
            else:
                event_messages(batch).write.format("kafka").options(**{**topic, "topic": target}).save()

        def write(batch: DataFrame, number: int) -> None:
            batch.persist()
            try:
                retried(lambda: publish(batch, number), wait=PUBLISH_WAIT)
                bad = batch.where(F.col("reason").isNotNull()).select("value", "reason")
                retried(lambda: bad.write.mode("overwrite").json(f"{rejects}/batch={number}"))
            finally:
                batch.unpersist()

        writer = routed.writeStream.foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    return _started(writer, checkpoint, once, every)


def start_aggregator(
    events: DataFrame,
    state_path: str,
    checkpoint: str,
    n_shards: int = DEFAULT_SHARDS,
    rejects: str | None = None,
    zero_is_missing: bool = True,
    once: bool = False,
    name: str = "aggregator",
    compact_every: int = 50,
    keep_versions: int = 0,
    compact_share: float = 0.5,
    every: str | None = None,
) -> StreamingQuery:
    """Event messages folded into the state table, one new version per batch.

    A batch writes its own folded rows only. Every ``compact_every`` batches those shards are merged whose newer folders
    have ``compact_share`` of the bytes of the largest one; 0 leaves it to a job of its own. Versions go only if
    ``keep_versions`` says how many stay, and never one that a reader holds. The batch is read once.
    """

    spark = events.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            usable = batch.where(F.col("reason").isNull()).drop("payload", "reason")
            retried(lambda: upsert_state(spark, state_path, usable, n_shards, zero_is_missing))
            if rejects is not None:
                write_bad(batch, f"{rejects}/batch={number}")
        finally:
            batch.unpersist()
        if compact_every and number % compact_every == compact_every - 1:
            compact_state(spark, state_path, share=compact_share)
            if keep_versions:
                drop_old_versions(spark, state_path, keep_versions)

    writer = observed(judged_events(events), spark, state_path, n_shards).writeStream.foreachBatch(write).queryName(name)
    return _started(writer, checkpoint, once, every)


def write_bad(batch: DataFrame, target: str) -> None:
    """The refused rows of judged events: the payload as it came, or the event as JSON."""
    event = F.to_json(F.struct(*[c for c in batch.columns if c not in ("payload", "reason")]))
    bad = batch.where(F.col("reason").isNotNull()).select(F.coalesce("payload", event).alias("value"), "reason")
    retried(lambda: bad.write.mode("overwrite").json(target))


def observed(judged: DataFrame, spark: SparkSession, state_path: str, n_shards: int) -> DataFrame:
    """Judged events that report, with each batch and without a scan of their own, events, rejects and events per shard."""
    current = load_version(spark, state_path)
    n_shards = current.n_shards if current else n_shards
    usable = F.col("reason").isNull()
    sharded = once_per_row(judged, "_shard", F.when(usable, shard_id("domain", n_shards)))
    counts: list[Column] = [F.count_if(usable).alias("events"), F.count_if(~usable).alias("rejects")]
    counts += [F.count_if(F.col("_shard") == k).alias(f"shard_{k}") for k in range(n_shards)]
    return sharded.observe(OBSERVED, *counts).drop("_shard")


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """A query takes the session's settings as it starts; the state store is RocksDB for those started in this block."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def _fold_key(zero_is_missing: bool, ttl: int) -> Callable:
    """Keeps a key's range in the stream's state; lets it go when the clock is ``ttl`` microseconds past its last time."""

    def known(t: int) -> bool:
        return t != 0 or not zero_is_missing

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names = [*STATE_KEY, "first_seen", "last_seen", "expired"]
        if state.hasTimedOut:
            yield pd.DataFrame([(*key, *state.get, True)], columns=names)
            state.remove()
            return
        first, last = state.get if state.exists else (None, None)
        for batch in batches:
            for t in batch["first_seen"]:
                first = int(t) if known(t) and (first is None or t < first) else first
            for t in batch["last_seen"]:
                last = int(t) if known(t) and (last is None or t > last) else last
        state.update((first, last))
        if last:  # a key whose time is unknown stays
            left = (last + ttl) // 1000 - state.getCurrentProcessingTimeMs()
            state.setTimeoutDuration(max(1, left))
        yield pd.DataFrame([(*key, first or 0, last or 0, False)], columns=names)

    return fold


def start_stateful_aggregator(
    events: DataFrame,
    state_path: str,
    checkpoint: str,
    n_shards: int = DEFAULT_SHARDS,
    zero_is_missing: bool = True,
    ttl: int | None = None,
    once: bool = False,
    name: str = "stateful_aggregator",
    compact_every: int = 50,
    compact_share: float = 0.5,
    every: str | None = None,
) -> StreamingQuery:
    """The fold kept in the stream's own state (RocksDB), and of each batch only the keys it changed go to the table.

    A key's row is its whole range, so a batch that comes again puts the same row. With ``ttl`` (microseconds) a key
    leaves state and table when the clock is that far past its last time, at the next batch; without, keys stay, and
    the fold is an aggregation in update mode. Batches and deletes are ordered by the batch's number, so the table is
    this query's own. Refused rows are counted among the figures; ``start_aggregator`` also writes them.
    """
    spark = events.sparkSession
    judged = observed(judged_events(events), spark, state_path, n_shards)
    usable = judged.where(F.col("reason").isNull()).select(*STATE_KEY, "first_seen", "last_seen")
    if ttl is None:
        folded = fold_events(usable, zero_is_missing).withColumn("expired", F.lit(False))
    else:
        kinds = "domain string, type string, value string, first_seen bigint, last_seen bigint, expired boolean"
        folded = usable.groupBy(*STATE_KEY).applyInPandasWithState(
            _fold_key(zero_is_missing, ttl), kinds, "first_seen bigint, last_seen bigint", "update", GroupStateTimeout.ProcessingTimeTimeout
        )

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            gone = batch.where("expired")
            if ttl is not None:
                retried(lambda: delete_state(spark, state_path, gone, position=2 * number + 1))
            live = batch.where("NOT expired").drop("expired")
            retried(lambda: upsert_state(spark, state_path, live, n_shards, zero_is_missing, position=2 * number + 2))
        finally:
            batch.unpersist()
        if compact_every and number % compact_every == compact_every - 1:
            compact_state(spark, state_path, share=compact_share, settled=2 * number)

    writer = folded.writeStream.outputMode("update").foreachBatch(write).queryName(name)
    with _rocksdb(spark):  # with timers there is always another batch to run: ``once`` then means one batch
        return _started(writer, checkpoint, once, every, one_batch=ttl is not None)


def console_sink(events: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Prints every row; with a checkpoint of its own it is a second, independent reader.

    Rows come to the driver one partition at a time.
    """

    def show(batch: DataFrame, number: int) -> None:
        for row in batch.toLocalIterator():
            print(*row, sep="\t")

    return _started(events.writeStream.foreachBatch(show), checkpoint, once)


def throughput(query: StreamingQuery) -> dict[str, float]:
    """Batches, rows, and rows per second of a query since it started."""
    totals = totals_of(SparkSession.active())
    for p in query.recentProgress:  # what the listener has not been told yet
        totals.take(p)
    held = totals.runs.get(str(query.runId), {})
    seconds = held.get("seconds", 0.0)
    return {
        "batches": held.get("batches", 0.0),
        "rows": held.get("rows", 0.0),
        "last_batch_rows": held.get("last_batch_rows", 0.0),
        "rows_per_second": held.get("rows", 0.0) / seconds if seconds else 0.0,
    }


def figures(query: StreamingQuery) -> dict[str, dict[str, int]]:
    """Events, rejects and events per shard: of all batches since the query started, and of the last one.

    Counts are taken as the batch is written; a task that runs twice may count twice.
    """
    throughput(query)
    totals, run = totals_of(SparkSession.active()), str(query.runId)
    return {"total": totals.figures.get(run, {}), "last": totals.last_figures.get(run, {})}


def batch_report(batch: DataFrame, n_shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Distinct state keys per shard in one batch of events; ``figures`` has the events of a running query."""
    return shard_distribution(batch, n_shards)


def batch_rate(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """``throughput`` as a one-row DataFrame."""
    return spark.createDataFrame([throughput(query)])
