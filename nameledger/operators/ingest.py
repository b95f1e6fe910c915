"""Raw records, feeds and events: validate, normalise, flatten.

Everything here is row-wise, so it works on batch and streaming DataFrames and never shuffles.
A feed becomes an array of events inside its own row first, and one explode ends the work.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nameledger import schemas
from nameledger.functions.domains import bare_domain, with_domain, with_domain_arrays, with_domains
from nameledger.functions.ip import ip_version
from nameledger.functions.records import temporal_range
from nameledger.functions.text import is_blank, once, trimmed
from nameledger.sources.messages import event_list, with_payload

# The accepted feed type, record types and verdict texts.
FEED_TYPE = "dns_intelligence_comprehensive"
RAW_TYPES = ("A", "CNAME")
BAD_FEED_TYPE = "invalid feed_type"
NO_CORRELATIONS = "domain_correlations is required and must be non-empty"
NO_DOMAIN = "domain is required for domain_correlations[{}]"
NO_ANSWERS = "answer_ips must be an array for domain_correlations[{}]"
EMPTY_DOMAIN = "domain normalization resulted in empty domain"
BAD_DOMAIN = "failed to normalize domain"
BAD_CNAME = "failed to normalize cname_target"

_EVENTS = T.ArrayType(schemas.EVENT)


def _no_events() -> Column:
    return F.array().cast(_EVENTS)


def _event(domain, rtype, value, first, last, device) -> Column:
    return F.struct(
        domain.alias("domain"),
        rtype.alias("type"),
        value.alias("value"),
        first.alias("first_seen"),
        last.alias("last_seen"),
        device.alias("device_id"),
    )


# --- raw records -------------------------------------------------------------------------------


def _raw_reason(domain: Column, rtype: Column, value: Column, name: Column) -> Column:
    return (
        F.when(is_blank(domain), "blank domain")
        .when(is_blank(value), "blank value")
        .when(name.isNull(), "bad domain")
        .when(~F.coalesce(rtype.isin(*RAW_TYPES), F.lit(False)), "unsupported type")
    )


def classify_raw(df: DataFrame, idna: bool = True) -> DataFrame:
    """Raw rows with their canonical ``name`` and a reject ``reason`` (null when usable)."""
    named = with_domain(df, "domain", "name", idna)
    reason = _raw_reason(F.col("domain"), F.col("type"), F.col("value"), F.col("name"))
    return named.withColumn("reason", reason)


def raw_to_events(df: DataFrame, idna: bool = True) -> DataFrame:
    """Raw rows (domain, type, value, timestamp, device_id) to events."""
    named = with_domain(df, "domain", "_name", idna)
    usable = named.where(
        F.col("_name").isNotNull() & F.col("type").isin(*RAW_TYPES) & ~is_blank("value")
    )
    seen = F.coalesce("timestamp", F.lit(0))
    return usable.select(
        F.col("_name").alias("domain"),
        "type",
        trimmed("value").alias("value"),
        seen.alias("first_seen"),
        seen.alias("last_seen"),
        F.coalesce("device_id", F.lit("")).alias("device_id"),
    )


def raw_rejects(df: DataFrame, idna: bool = True) -> DataFrame:
    return classify_raw(df, idna).where(F.col("reason").isNotNull()).drop("name")


def _raw_event_array(records: Column, names: Column) -> Column:
    """ARRAY<event> of an array of raw records and the canonical names at the same positions."""

    def build(record: Column, name: Column) -> Column:
        seen = F.coalesce(record["timestamp"], F.lit(0))
        event = _event(
            name,
            record["type"],
            trimmed(record["value"]),
            seen,
            seen,
            F.coalesce(record["device_id"], F.lit("")),
        )
        reason = _raw_reason(record["domain"], record["type"], record["value"], name)
        return F.when(reason.isNull(), event)

    return F.filter(F.zip_with(records, names, build), lambda e: e.isNotNull())


# --- feeds -------------------------------------------------------------------------------------


def _with_names(df: DataFrame, correlations: Column, idna: bool) -> DataFrame:
    return with_domain_arrays(
        df,
        {
            "_names": F.transform(correlations, lambda c: c["domain"]),
            "_cnames": F.transform(correlations, lambda c: c["cname_target"]),
        },
        idna,
    )


def _first_text(texts: Column) -> Column:
    return F.get(F.filter(texts, lambda t: t.isNotNull()), F.lit(0))


def _text_at(template: str, index: Column) -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), index.cast("string"), F.lit(after))


def _shape_issue(correlations: Column) -> Column:
    return _first_text(
        F.transform(
            correlations,
            lambda c, i: F.when(is_blank(c["domain"]), _text_at(NO_DOMAIN, i)).when(
                c["answer_ips"].isNull(), _text_at(NO_ANSWERS, i)
            ),
        )
    )


def _name_issue(correlations: Column, names: Column, cnames: Column) -> Column:
    found = F.zip_with(
        names, cnames, lambda n, c: F.struct(n.alias("name"), c.alias("cname"))
    )

    def issue(c: Column, got: Column) -> Column:
        return (
            F.when(bare_domain(c["domain"]).isNull(), EMPTY_DOMAIN)
            .when(got["name"].isNull(), BAD_DOMAIN)
            .when(bare_domain(c["cname_target"]).isNotNull() & got["cname"].isNull(), BAD_CNAME)
        )

    return _first_text(F.zip_with(correlations, found, issue))


def validate_feed(df: DataFrame, mode: str = "strict", idna: bool = True) -> DataFrame:
    """Adds ``verdict``: null for a usable feed, else the reason it is refused.

    ``strict`` refuses a whole feed over one bad entry. ``lenient`` refuses none: bad entries are
    skipped when the feed is flattened, and the verdict only reports a wrong feed type.
    """
    _check_mode(mode)
    if mode == "lenient":
        return df.withColumn("verdict", F.when(_wrong_type(), BAD_FEED_TYPE))
    named = _with_names(df, F.col("domain_correlations"), idna)
    return named.withColumn("verdict", _strict_verdict()).drop("_names", "_cnames")


def _wrong_type() -> Column:
    return F.coalesce(F.col("feed_type"), F.lit("")) != FEED_TYPE


def _strict_verdict() -> Column:
    """First thing wrong with a feed whose canonical names are already at hand."""
    correlations = F.col("domain_correlations")
    return (
        F.when(_wrong_type(), BAD_FEED_TYPE)
        .when(F.coalesce(F.size(correlations), F.lit(0)) < 1, NO_CORRELATIONS)
        .otherwise(
            F.coalesce(
                _shape_issue(correlations),
                _name_issue(correlations, F.col("_names"), F.col("_cnames")),
            )
        )
    )


def _feed_event_array(
    correlations: Column, names: Column, cnames: Column, timestamp: Column, device: Column,
    typed_answers: bool,
) -> Column:
    """ARRAY<event> of one feed: address answers in order, then the alias, entry by entry."""
    found = F.zip_with(names, cnames, lambda n, c: F.struct(n.alias("name"), c.alias("cname")))
    sensor = F.coalesce(device, F.lit(""))

    def answer_type(ip: Column) -> Column:
        if not typed_answers:
            return F.lit("A")
        return F.when(ip_version(trimmed(ip)) == 6, "AAAA").otherwise("A")

    def entry(c: Column, got: Column) -> Column:
        first, last = temporal_range(c["temporal"], timestamp)
        answers = F.transform(
            F.filter(c["answer_ips"], lambda ip: ~is_blank(ip)),
            lambda ip: _event(got["name"], answer_type(ip), ip, first, last, sensor),
        )
        alias = F.array(_event(got["name"], F.lit("CNAME"), got["cname"], first, last, sensor))
        return F.when(
            got["name"].isNotNull(),
            F.concat(
                F.coalesce(answers, _no_events()),
                F.when(got["cname"].isNotNull(), alias).otherwise(_no_events()),
            ),
        ).otherwise(_no_events())

    events = F.flatten(F.zip_with(correlations, found, entry))
    return F.coalesce(events, _no_events())


def _events_of_named_feed(
    named: DataFrame, mode: str, typed_answers: bool
) -> tuple[DataFrame, Column]:
    """The event array of feeds that carry ``_names`` and ``_cnames``; strict adds ``verdict``."""
    _check_mode(mode)
    events = _feed_event_array(
        F.col("domain_correlations"), F.col("_names"), F.col("_cnames"), F.col("timestamp"),
        F.col("device_id"), typed_answers,
    )
    if mode == "strict":
        named = named.withColumn("verdict", _strict_verdict())
        events = F.when(F.col("verdict").isNull(), events).otherwise(_no_events())
    return named, events


def with_feed_events(
    df: DataFrame, mode: str = "lenient", typed_answers: bool = False, idna: bool = True
) -> DataFrame:
    """Feeds with an ``events`` array column; a feed refused in strict mode has none."""
    named = _with_names(df, F.col("domain_correlations"), idna)
    judged, events = _events_of_named_feed(named, mode, typed_answers)
    return judged.withColumn("events", events).drop("_names", "_cnames")


def _feed_entries(correlations: Column, timestamp: Column, device: Column) -> Column:
    """One struct per correlation, in the shape all kinds of entries share."""

    def entry(c: Column) -> Column:
        first, last = temporal_range(c["temporal"], timestamp)
        return _entry(c["domain"], None, None, c["answer_ips"], c["cname_target"], first, last, device)

    return F.transform(correlations, entry)


def _raw_entries(records: Column) -> Column:
    def entry(r: Column) -> Column:
        seen = F.coalesce(r["timestamp"], F.lit(0))
        return _entry(r["domain"], r["type"], r["value"], None, None, seen, seen, r["device_id"])

    return F.transform(records, entry)


def _entry(domain, rtype, value, answers, alias, first, last, device) -> Column:
    values = {
        "domain": domain, "type": rtype, "value": value, "answers": answers, "alias": alias,
        "first": first, "last": last, "device": device,
    }
    kinds = {"answers": "array<string>", "first": "bigint", "last": "bigint"}
    return F.struct(
        *[(F.lit(None) if v is None else v).cast(kinds.get(n, "string")).alias(n) for n, v in values.items()],
        F.lit(answers is None).alias("is_raw"),
    )


def _events_of_entries(df: DataFrame, entries: Column, typed_answers: bool, idna: bool) -> DataFrame:
    """One row per event: names are worked out as plain columns, after entries are rows of their own."""
    rows = df.select(F.explode_outer(entries).alias("_entry")).where(F.col("_entry").isNotNull()).select("_entry.*")
    named = with_domains(rows, {"_name": "domain", "_cname": "alias"}, idna).where(F.col("_name").isNotNull())
    name, first, last = F.col("_name"), F.col("first"), F.col("last")
    device = F.coalesce("device", F.lit(""))

    def answer_type(ip: Column) -> Column:
        if not typed_answers:
            return F.lit("A")
        return F.when(ip_version(trimmed(ip)) == 6, "AAAA").otherwise("A")

    usable = _raw_reason(F.col("domain"), F.col("type"), F.col("value"), name).isNull()
    own = F.when(usable, F.array(_event(name, F.col("type"), trimmed("value"), first, last, device)))
    answers = F.transform(
        F.filter("answers", lambda ip: ~is_blank(ip)), lambda ip: _event(name, answer_type(ip), ip, first, last, device)
    )
    alias = F.when(F.col("_cname").isNotNull(), F.array(_event(name, F.lit("CNAME"), F.col("_cname"), first, last, device)))
    fed = F.concat(F.coalesce(answers, _no_events()), F.coalesce(alias, _no_events()))
    events = F.when(F.col("is_raw"), own).otherwise(fed)
    out = named.select(F.explode_outer(events).alias("_event"))
    return out.where(F.col("_event").isNotNull()).select("_event.*")


def feed_to_events(
    df: DataFrame, mode: str = "lenient", typed_answers: bool = False, idna: bool = True
) -> DataFrame:
    """One row per event of each feed; only the strict mode has to judge feeds as a whole."""
    _check_mode(mode)
    if mode == "strict":
        return events_of(with_feed_events(df, mode, typed_answers, idna))
    entries = _feed_entries(F.col("domain_correlations"), F.col("timestamp"), F.col("device_id"))
    return _events_of_entries(df, entries, typed_answers, idna)


def message_events(
    df: DataFrame, col: str = "value", typed_answers: bool = False, idna: bool = True
) -> DataFrame:
    """One row per event of payloads of either shape, leniently: what ``events_of(messages_to_events(df))`` gives,
    without arrays of events in between."""
    fed = _feed_entries(F.col("_feed.domain_correlations"), F.col("_feed.timestamp"), F.col("_feed.device_id"))
    entries = F.when(F.col("_shape") == "raw", _raw_entries(F.col("_raw"))).otherwise(fed)
    return _events_of_entries(with_payload(df, col), entries, typed_answers, idna)


def feed_rejects(df: DataFrame, idna: bool = True) -> DataFrame:
    """Feeds the strict mode refuses, with the reason."""
    judged = validate_feed(df, "strict", idna)
    return judged.where(F.col("verdict").isNotNull()).withColumnRenamed("verdict", "reason")


def _check_mode(mode: str) -> None:
    if mode not in ("strict", "lenient"):
        raise ValueError("mode is 'strict' or 'lenient'")


# --- mixed messages ----------------------------------------------------------------------------


def messages_to_events(
    df: DataFrame, col: str = "value", mode: str = "lenient", typed_answers: bool = False,
    idna: bool = True,
) -> DataFrame:
    """Payloads of either shape with an ``events`` array and a ``reason`` for those refused.

    One pass, no union: each row is routed by its own shape.
    """
    parsed = with_payload(df, col).select(
        "*", *[f"_feed.{name}" for name in ("feed_type", "timestamp", "device_id", "domain_correlations")]
    )
    correlations = F.col("domain_correlations")
    named = with_domain_arrays(
        parsed,
        {
            "_raw_names": F.transform(F.col("_raw"), lambda r: r["domain"]),
            "_names": F.transform(correlations, lambda c: c["domain"]),
            "_cnames": F.transform(correlations, lambda c: c["cname_target"]),
        },
        idna,
    )
    fed, feed_events = _events_of_named_feed(named, mode, typed_answers)
    from_raw = _raw_event_array(F.col("_raw"), F.col("_raw_names"))
    events = F.when(
        F.col("_shape") == "raw", F.coalesce(from_raw, _no_events())
    ).otherwise(feed_events)
    reason = F.when(F.col("_shape") == "unknown", "neither raw records nor a feed")
    if mode == "strict":
        reason = reason.when(F.col("_shape") == "feed", F.col("verdict"))
    return fed.select(*df.columns, events.alias("events"), reason.alias("reason"))


def events_of(messages: DataFrame) -> DataFrame:
    """One row per event of messages that carry an ``events`` array."""
    # The outer form, as Spark would work the array out twice to skip empty ones beforehand.
    rows = messages.select(F.explode_outer("events").alias("_event"))
    return rows.where(F.col("_event").isNotNull()).select("_event.*")


# --- events ------------------------------------------------------------------------------------


def classify_events(df: DataFrame) -> DataFrame:
    """Events with times defaulted to 0 and a reject ``reason`` (null when usable)."""
    missing = F.lit(False)
    for field in ("domain", "type", "value"):
        missing = missing | (F.coalesce(F.col(field), F.lit("")) == "")
    return df.withColumns(
        {
            "first_seen": F.coalesce("first_seen", F.lit(0)),
            "last_seen": F.coalesce("last_seen", F.lit(0)),
            "reason": F.when(missing, "missing domain, type or value"),
        }
    )


def valid_events(df: DataFrame) -> DataFrame:
    return classify_events(df).where(F.col("reason").isNull()).drop("reason")


def judged_events(df: DataFrame, col: str = "value") -> DataFrame:
    """One row per event with a reject ``reason`` (null when usable), and one per payload no event list can be read from.

    Each payload is read once. Of the latter the payload is in ``payload``; events leave that null.
    """
    parsed = once(df.select(col), "_items", F.struct(event_list(col).alias("list")))
    items, text = F.col("_items.list"), F.coalesce(trimmed(col), F.lit(""))
    bad = items.isNull() & (text != "null")
    rows = parsed.select(F.when(bad, F.coalesce(col, F.lit(""))).alias("payload"), F.explode_outer(items).alias("_item"))
    events = classify_events(rows.where(F.col("_item").isNotNull() | F.col("payload").isNotNull()).select("payload", "_item.*"))
    unread = F.when(F.col("payload").isNotNull(), F.lit("no parsable events"))
    return events.withColumn("reason", F.coalesce(unread, F.col("reason")))
