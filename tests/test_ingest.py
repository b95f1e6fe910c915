import json

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nameledger.functions import domains
from nameledger.operators import ingest
from nameledger.sources import intel, messages

FEED = "dns_intelligence_comprehensive"


def events_of(df):
    return sorted(
        (r.domain, r.type, r.value, r.first_seen, r.last_seen, r.device_id) for r in df.collect()
    )


def feed(**changes):
    base = {
        "feed_type": FEED, "version": "1.0", "device_id": "s1", "timestamp": 9,
        "domain_correlations": [{"domain": "q.com", "answer_ips": ["1.2.3.4"], "temporal": None}],
    }
    return json.dumps({**base, **changes})


def feeds(rows, *docs):
    return messages.parse_feed(rows([(d,) for d in docs], "value string"))


def test_raw_records(rows):
    raw = rows(
        [
            ("A.com.", "A", " 1.1.1.1 ", 5, "d"), (" ", "A", "1.1.1.1", 5, "d"),
            ("a.com", "A", "　", 5, "d"), ("a.com", "a", "1.1.1.1", 5, "d"),
            ("a.com", "TXT", "x", 5, "d"), ("a_b.com", "A", "x", 5, "d"),
            ("b.com", "CNAME", "Target.COM.", None, None), (None, "A", "x", 1, "d"),
            ("b.com", None, "x", 1, "d"),
        ],
        "domain string, type string, value string, timestamp bigint, device_id string",
    )
    want = [("a.com", "A", "1.1.1.1", 5, 5, "d"), ("b.com", "CNAME", "Target.COM.", 0, 0, "")]
    assert events_of(ingest.raw_to_events(raw)) == want
    assert events_of(ingest.raw_to_events(raw, idna=False)) == want
    reasons = sorted(r.reason for r in ingest.raw_rejects(raw).collect())
    assert reasons == ["bad domain", "blank domain", "blank domain", "blank value"] + [
        "unsupported type"] * 3


def test_feed_events(rows):
    doc = feed(domain_correlations=[
        {"domain": "Q.com", "answer_ips": ["1.2.3.4", " ", "2001:db8::1"], "cname_target": "Z.com.",
         "temporal": {"first_seen": 3}},
        {"domain": "r.com", "answer_ips": [], "cname_target": "t.com", "temporal": None},
        {"domain": " ", "answer_ips": ["9.9.9.9"]},
        {"domain": "s.com", "cname_target": "a_b.com"},
    ])
    df = feeds(rows, doc)
    want = [
        ("q.com", "A", "1.2.3.4", 3, 0, "s1"), ("q.com", "A", "2001:db8::1", 3, 0, "s1"),
        ("q.com", "CNAME", "z.com", 3, 0, "s1"), ("r.com", "CNAME", "t.com", 9, 9, "s1"),
    ]
    assert events_of(ingest.feed_to_events(df)) == want
    assert events_of(ingest.feed_to_events(df, mode="strict")) == []
    typed = events_of(ingest.feed_to_events(df, typed_answers=True))
    assert [e[1] for e in typed] == ["A", "AAAA", "CNAME", "CNAME"]


def test_feed_verdicts(rows):
    entry = {"domain": "a.com", "answer_ips": []}
    cases = [
        (feed(), None),
        (feed(feed_type="other"), "invalid feed_type"),
        (feed(domain_correlations=[]),
         "domain_correlations is required and must be non-empty"),
        (feed(domain_correlations=[entry, {"domain": " ", "answer_ips": []}]),
         "domain is required for domain_correlations[1]"),
        (feed(domain_correlations=[entry, entry, {"domain": "b.com"}]),
         "answer_ips must be an array for domain_correlations[2]"),
        (feed(domain_correlations=[{"domain": "...", "answer_ips": []}]),
         "domain normalization resulted in empty domain"),
        (feed(domain_correlations=[{"domain": "a_b", "answer_ips": []}]),
         "failed to normalize domain"),
        (feed(domain_correlations=[{**entry, "cname_target": "a_b"}]),
         "failed to normalize cname_target"),
        (feed(domain_correlations=[{**entry, "cname_target": " . "}]), None),
    ]
    for doc, verdict in cases:
        got = ingest.validate_feed(feeds(rows, doc)).collect()
        assert [r.verdict for r in got] == [verdict], doc
    lenient = ingest.validate_feed(feeds(rows, feed(feed_type="other")), "lenient").collect()
    assert lenient[0].verdict == "invalid feed_type"
    assert len(events_of(ingest.feed_to_events(feeds(rows, feed(feed_type="other"))))) == 1


MESSAGES = [
    ('[{"domain":"a.com","type":"A","value":"1.1.1.1","timestamp":5,"device_id":"d"},'
     '{"domain":"b.com","type":"A","value":"2.2.2.2","timestamp":6,"device_id":"d"}]', "raw", 2),
    ('{"domain":"c.com","type":"CNAME","value":"x.com"}', "raw", 1),
    ('{"domain":"c.com","type":"A","value":"3.3.3.3","timestamp":"soon"}', "raw", 1),
    (feed(), "feed", 1),
    ("{}", "raw", 0),
    ("[]", "raw", 0),
    ("null", "raw", 0),
    ("[1,2]", "unknown", 0),
    ("junk", "unknown", 0),
    ('{"domain":', "unknown", 0),
    ("", "unknown", 0),
]


def test_routing(rows):
    df = rows([(m,) for m, _, _ in MESSAGES], "value string")
    shapes = [r._shape for r in messages.with_payload(df).collect()]
    assert shapes == [s for _, s, _ in MESSAGES]
    raw, feed_rows, rejects = messages.route_messages(df)
    assert raw.count() == 6 and feed_rows.count() == 1 and rejects.count() == 4
    assert {r.reason for r in rejects.collect()} == {"neither raw records nor a feed"}


def test_mixed_messages(rows):
    df = rows([(m,) for m, _, _ in MESSAGES], "value string")
    held = ingest.messages_to_events(df).collect()
    assert [len(r.events) for r in held] == [n for _, _, n in MESSAGES]
    assert [r.reason is not None for r in held] == [s == "unknown" for _, s, _ in MESSAGES]
    strict = ingest.messages_to_events(
        rows([(feed(feed_type="x"),)], "value string"), mode="strict").collect()
    assert strict[0].reason == "invalid feed_type" and strict[0].events == []


def test_event_messages(rows):
    texts = ['[{"domain":"a","type":"A","value":"1"}]', '{"events":[{"domain":"b"}]}',
             '{"events":[]}', "[]", "null", "x", "{}"]
    df = rows([(t,) for t in texts], "value string")
    assert sorted(r.domain for r in messages.parse_events(df).collect()) == ["a", "b"]
    bad = [r.value for r in messages.unparsed_events(df).collect()]
    assert bad == ['{"events":[]}', "x", "{}"]
    judged = ingest.classify_events(messages.parse_events(df)).orderBy("domain").collect()
    assert [r.reason for r in judged] == [None, "missing domain, type or value"]
    assert ingest.valid_events(messages.parse_events(df)).first().first_seen == 0


def test_flat_events_are_those_of_the_arrays(rows):
    payloads = [
        '[{"domain":"A.com.","type":"A","value":" 1.1.1.1 ","timestamp":5},{"domain":"b.com","type":"TXT","value":"x"}]',
        '{"domain":"é.com","type":"CNAME","value":"c.com","device_id":"d"}', "null", "[]", "junk", "{}",
        '{"feed_type":"f","device_id":"s","timestamp":9,"domain_correlations":[{"domain":"Q.com","answer_ips":["1.2.3.4"," ","::1"],'
        '"cname_target":"ü.com"},{"domain":"","answer_ips":["9.9.9.9"]},{"domain":"r.com","cname_target":"-bad"},{"domain":"s.com"}]}',
    ]
    df = rows([(p,) for p in payloads], "value string")
    for typed in (False, True):
        flat = ingest.message_events(df, typed_answers=typed)
        arrays = ingest.events_of(ingest.messages_to_events(df, typed_answers=typed))
        assert flat.columns == arrays.columns
        assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, arrays.collect())) and flat.count() >= 5
    plan = ingest.message_events(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_full_feeds_keep_their_summaries(rows):
    text = (
        '{"feed_type":"f","device_id":"s","timestamp":9,"feed_stats":{"total_queries":7},"domain_correlations":'
        '[{"domain":"a.com","ndpi_protocol":{"protocol_name":"DNS","bytes_sent":5},"intelligence":{"threat_score":0.5}}],'
        '"ml_insights":{"behavioral_analysis":{"peak_query_time":13}}}'
    )
    df = rows([(text,), ("junk",)], "value string")
    got = messages.parse_feed(df, full=True).first()
    assert (got.feed_stats.total_queries, got.ml_insights.behavioral_analysis.peak_query_time) == (7, 13)
    [entry] = got.domain_correlations
    assert (entry.ndpi_protocol.protocol_name, entry.intelligence.threat_score) == ("DNS", 0.5)
    assert "feed_stats" not in messages.parse_feed(df).columns


def test_events_of_messages_are_worked_out_once(rows):
    """Messages without events are left out by what was worked out for the text, not by a second pass before it."""
    record = '{"domain": "%s", "type": "A", "value": "1.1.1.1", "timestamp": 5}'
    messages = ingest.messages_to_events(rows([(record % "a.com",), (record % "münchen.example",), (record % "",), ("junk",)], "value string"))
    sent = intel.event_messages(messages)
    assert sent._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(json.loads(r.value)[0]["domain"] for r in sent.collect()) == ["a.com", "xn--mnchen-3ya.example"]


def test_no_null_lists_go_to_the_names_udf(rows, monkeypatch):
    """A null list makes Spark go over all nulls before it, row by row: rows that need no UDF send an empty one."""
    known = domains.idna_ascii_array.func

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def strict(lists: pa.Array) -> pa.Array:
        assert lists.null_count == 0
        return known(lists)

    monkeypatch.setattr(domains, "idna_ascii_array", strict)
    data = [(["a.com", "B.net."],), (None,), ([],), (["münchen.example", None, "-bad.com", "ok.org"],)]
    found = domains.with_domain_arrays(rows(data, "given array<string>"), {"names": F.col("given")})
    want = [["a.com", "b.net"], None, [], ["xn--mnchen-3ya.example", None, None, "ok.org"]]
    assert [r.names for r in found.collect()] == want
