import json
import random
import time
import uuid

from pyspark.sql import functions as F

from nameledger.operators import fold, ingest
from nameledger.session import shared_dir
from nameledger.sources import intel, messages, state
from nameledger.streaming import queries as streams

FEED = {
    "feed_type": "dns_intelligence_comprehensive", "device_id": "s", "timestamp": 9,
    "domain_correlations": [{"domain": "Q.com", "answer_ips": ["1.2.3.4"], "cname_target": "é.com"}],
}


def sent():
    raw = [
        json.dumps([{"domain": f"D{i % 7}.com.", "type": "A", "value": f"1.1.1.{i % 5}", "timestamp": i}])
        for i in range(200)
    ]
    return [*raw, json.dumps(FEED), "junk", "{}"]


def folder(spark, what):
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def triples(df):
    return sorted((r.domain, r.type, r.value, r.first_seen, r.last_seen) for r in df.collect())


def test_messages_to_events_to_state(spark, rows):
    source, events, table, bad, odd = (folder(spark, n) for n in ("in", "ev", "st", "bad", "odd"))
    marks, marks2 = folder(spark, "m"), folder(spark, "m")
    messages_in = rows([(m,) for m in sent()], "value string")
    messages_in.repartition(6).write.text(source)

    stream = messages.read_stream(spark, source, max_per_batch=2)
    query = streams.start_normalizer(stream, events, marks, rejects=bad, once=True)
    query.awaitTermination()
    report = streams.throughput(query)
    assert report["rows"] == 203 and report["batches"] >= 3 and report["rows_per_second"] > 0
    assert [r.value for r in spark.read.json(bad).collect()] == ["junk"]

    want = ingest.events_of(ingest.messages_to_events(messages_in))
    published = spark.read.text(f"{events}/*")
    assert triples(messages.parse_events(published)) == triples(want)

    flow = messages.read_stream(spark, f"{events}/*", max_per_batch=2)
    streams.start_aggregator(flow, table, marks2, rejects=odd, once=True).awaitTermination()
    assert triples(state.read_state(spark, table)) == triples(fold.fold_events(want))

    # New messages resume from the checkpoint; what was read is not read again.
    known = state.versions(spark, table)
    late = [json.dumps([{"domain": "late.com", "type": "A", "value": "9.9.9.9", "timestamp": 5}]), "x"]
    rows([(m,) for m in late], "value string").write.mode("append").text(source)
    stream = messages.read_stream(spark, source, max_per_batch=2)
    again = streams.start_normalizer(stream, events, marks, rejects=bad, once=True)
    again.awaitTermination()
    assert sum(p.numInputRows for p in again.recentProgress) == 2
    flow = messages.read_stream(spark, f"{events}/*", max_per_batch=50)
    streams.start_aggregator(flow, table, marks2, rejects=odd, once=True).awaitTermination()
    assert len(state.versions(spark, table)) == len(known) + 1
    assert ("late.com", "A", "9.9.9.9", 5, 5) in triples(state.read_state(spark, table))


def test_aggregator_rejects(spark, rows):
    source, table, odd = (folder(spark, n) for n in ("in", "st", "odd"))
    texts = ['[{"domain":"a.com","type":"A"}]', "no json", '{"events":[{"domain":"a.com","type":"A","value":"1"}]}']
    rows([(t,) for t in texts], "value string").coalesce(1).write.text(source)
    flow = messages.read_stream(spark, source)
    streams.start_aggregator(flow, table, folder(spark, "m"), rejects=odd, once=True).awaitTermination()
    assert triples(state.read_state(spark, table)) == [("a.com", "A", "1", 0, 0)]
    reasons = sorted(r.reason for r in spark.read.json(odd).collect())
    assert reasons == ["missing domain, type or value", "no parsable events"]


def test_plain_normalizer_and_console(spark, rows, capsys):
    source, events = folder(spark, "in"), folder(spark, "ev")
    rows([(m,) for m in sent()], "value string").write.text(source)
    stream = messages.read_stream(spark, source)
    streams.start_normalizer(stream, events, folder(spark, "m"), once=True, mode="strict").awaitTermination()
    assert messages.parse_events(spark.read.text(events)).count() == 202
    shown = streams.console_sink(stream, folder(spark, "m"), once=True)
    shown.awaitTermination()
    assert capsys.readouterr().out.count("\n") == 203, "every row is printed"
    assert streams.throughput(shown)["rows"] == 203, "a second reader gets everything too"


def test_event_and_reject_files(spark, rows):
    path, bad = folder(spark, "ev"), folder(spark, "bad")
    held = ingest.messages_to_events(rows([(m,) for m in sent()], "value string"))
    intel.write_events(held, path)
    intel.write_rejects(held.select("value", "reason"), bad)
    assert spark.read.text(path).count() == 201
    assert spark.read.json(bad).first().value == "junk"


def test_a_failing_step_is_tried_again():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("not yet")
        return "done"

    assert streams.retried(flaky, wait=0) == "done" and len(calls) == 3
    calls.clear()
    try:
        streams.retried(flaky, attempts=2, wait=0)
        raise AssertionError("the last failure is passed on")
    except OSError:
        assert len(calls) == 2


def test_totals_outlive_what_spark_keeps():
    totals = streams.Totals()
    for batch in range(250):
        totals.add("run", batch, 2, 0.5)
        totals.add("run", batch, 2, 0.5)  # told twice
    assert totals.runs["run"]["rows"] == 500 and totals.runs["run"]["batches"] == 250


def test_topics_are_read_without_a_ceiling():
    options = messages.topic_options("dns")
    assert options["minOffsetsPerTrigger"] == "100" and options["maxTriggerDelay"] == "5s"
    assert "maxOffsetsPerTrigger" not in options
    assert messages.topic_options("dns", 7)["maxOffsetsPerTrigger"] == "7"


def test_two_streams_of_one_name_lose_nothing(spark, rows):
    table = folder(spark, "st")
    for name in ("a.com", "b.com"):
        source = folder(spark, "in")
        rows([(json.dumps([{"domain": name, "type": "A", "value": "1.1.1.1"}]),)], "value string").write.text(source)
        stream = messages.read_stream(spark, source)
        streams.start_aggregator(stream, table, folder(spark, "m"), once=True).awaitTermination()
    assert [r.domain for r in state.read_state(spark, table).orderBy("domain").collect()] == ["a.com", "b.com"]


def test_the_aggregator_compacts_and_forgets(spark, rows):
    source, table = folder(spark, "in"), folder(spark, "st")
    texts = [json.dumps([{"domain": f"d{i}.com", "type": "A", "value": "1"}]) for i in range(8)]
    rows([(t,) for t in texts], "value string").repartition(8).write.text(source)
    stream = messages.read_stream(spark, source, max_per_batch=1)
    streams.start_aggregator(stream, table, folder(spark, "m"), once=True, compact_every=4, keep_versions=2).awaitTermination()
    assert len(state.versions(spark, table)) <= 5
    assert state.read_state(spark, table).count() == 8


def events_file(spark, source, number, data):
    texts = [json.dumps([dict(zip(("domain", "type", "value", "first_seen", "last_seen"), e, strict=True)) for e in data])]
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(f"{source}/part={number}")


def test_figures_come_with_the_batches(spark, rows):
    source, table = folder(spark, "in"), folder(spark, "st")
    data = [(f"d{i}.com", "A", "1", 1, 1) for i in range(40)]
    events_file(spark, source, 0, [*data, ("", "A", "1", 1, 1)])
    rows([("no json",), ("null",)], "value string").coalesce(1).write.text(f"{source}/part=1")
    query = streams.start_aggregator(messages.read_stream(spark, f"{source}/*", max_per_batch=1), table, folder(spark, "m"), once=True)
    query.awaitTermination()
    got = streams.figures(query)["total"]
    want = {f"shard_{r.shard_id}": r.n for r in state.read_state(spark, table).groupBy("shard_id").agg(F.count("*").alias("n")).collect()}
    assert got == {"events": 40, "rejects": 2, **{f"shard_{k}": want.get(f"shard_{k}", 0) for k in range(4)}}
    assert sum(streams.figures(query)["last"].values()) in (1, 81)


def test_state_kept_in_the_stream_equals_the_folded_table(spark, rows):
    source, table, plain, marks = (folder(spark, n) for n in ("in", "st", "plain", "m"))
    draw = random.Random(4)
    batches = [[(f"d{draw.randrange(9)}.com", "A", str(draw.randrange(3)), draw.choice([0, 5, 9, 20]), draw.choice([0, 5, 9, 20])) for _ in range(30)] for _ in range(4)]
    for number, batch in enumerate(batches):
        events_file(spark, source, number, batch)
        if number % 2:  # the query stops and starts again from its checkpoint
            flow = messages.read_stream(spark, f"{source}/*", max_per_batch=1)
            streams.start_stateful_aggregator(flow, table, marks, once=True, compact_every=3).awaitTermination()
    flow = messages.read_stream(spark, f"{source}/*", max_per_batch=1)
    streams.start_aggregator(flow, plain, folder(spark, "m"), once=True).awaitTermination()
    want = triples(state.read_state(spark, plain))
    assert triples(state.read_state(spark, table)) == want
    last = state.load_version(spark, table)
    state.upsert_state(spark, table, rows(batches[3], "domain string, type string, value string, first_seen bigint, last_seen bigint"), position=last.top)
    assert triples(state.read_state(spark, table)) == want, "a batch that comes again changes nothing"
    assert spark.conf.get(streams.STATE_STORE) != streams.ROCKSDB


def test_keys_expire_in_stream_and_table(spark):
    source, table, marks = (folder(spark, n) for n in ("in", "st", "m"))
    now, ttl = int(time.time() * 1_000_000), 3600 * 1_000_000
    batches = [
        [("old.com", "A", "1", 5, now - 2 * ttl), ("back.com", "A", "1", 7, now - 2 * ttl), ("new.com", "A", "1", 9, now), ("unknown.com", "A", "1", 0, 0)],
        [("other.com", "A", "1", now, now)],
        [("back.com", "A", "1", now - 5, now), ("other.com", "A", "1", 3, 3)],
    ]
    seen = []
    for number, batch in enumerate(batches):
        events_file(spark, source, number, batch)
        flow = messages.read_stream(spark, f"{source}/*", max_per_batch=1)
        streams.start_stateful_aggregator(flow, table, marks, ttl=ttl, once=True, compact_every=2, compact_share=0).awaitTermination()
        seen.append(triples(state.read_state(spark, table)))
    assert [r[0] for r in seen[0]] == ["back.com", "new.com", "old.com", "unknown.com"]
    assert [r[0] for r in seen[1]] == ["new.com", "other.com", "unknown.com"]
    assert seen[2] == sorted([("back.com", "A", "1", now - 5, now), ("new.com", "A", "1", 9, now), ("other.com", "A", "1", 3, now), ("unknown.com", "A", "1", 0, 0)])
