"""The state table: Parquet laid out by shard, in immutable versions.

``<path>/versions/<n>.json`` lists the folders of every shard as of version n, and what the version added. An upsert
folds its batch and adds the folded rows in folders of their own, ``<path>/data/v=<n>-<id>/shard_id=<k>``, so what a
batch writes depends on the batch alone. A read folds the shards that have several folders; ``compact_state`` merges
them, as a batch job. Readers see a version whole or not at all, and a version already read stays as it is. Within a
shard, rows are range-partitioned and sorted by key, so shards of any size are written by many tasks and Parquet
statistics serve key lookups. Folding twice changes nothing, so a batch that comes again does no harm.

A delete is a batch too. Every row has the position of its batch, and a delete hides what has its key, or a key in its
range, and its position or a lesser one; so neither the order in which batches arrive nor a replay changes what is left.
"""

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nameledger import schemas
from nameledger.functions.domains import DEFAULT_SHARDS
from nameledger.functions.records import make_key, parse_key
from nameledger.operators.fold import SHARD_COUNT, STATE_KEY, fold_events, with_shard
from nameledger.operators.keyed import changes_since
from nameledger.operators.predecessor import place_of
from nameledger.operators.rollups import LG_K
from nameledger.sources import files

_STORED = "domain string, type string, value string, first_seen bigint, last_seen bigint, position bigint, is_delete boolean"
_ROW = [*STATE_KEY, "first_seen", "last_seen", "position", "is_delete"]
#: Range deletes a version may hold; compaction takes them in.
MOST_RANGES = 1000
#: So many names are looked for by name when changes are read; more are met by the semi join alone.
FEW_NAMES = 1000


@dataclass(frozen=True)
class StateVersion:
    """``kind`` says how a version was made: upsert, delete, range, compact or rewrite.

    ``added`` are the folders it brought, ``loose`` those in which a key may have several rows or a delete, ``ranges``
    the range deletes [low, high, position], ``explicit`` whether any position came from a caller, ``top`` the greatest
    position there was, ``time`` the commit in milliseconds.
    """

    version: int
    n_shards: int
    shards: dict[str, list[str]] = field(default_factory=dict)
    zero_is_missing: bool = True
    kind: str = "rewrite"
    added: list[str] = field(default_factory=list)
    loose: list[str] = field(default_factory=list)
    ranges: list[list] = field(default_factory=list)
    explicit: bool = False
    top: int = 0
    time: int = 0


def versions(spark: SparkSession, path: str) -> list[int]:
    found = files.names_in(spark, f"{path}/versions")
    return sorted(int(name[:-5]) for name in found if name.endswith(".json") and name[0] != ".")


def load_version(spark: SparkSession, path: str, version: int | None = None) -> StateVersion | None:
    known = versions(spark, path)
    if version is None:
        if not known:
            return None
        version = known[-1]
    if version not in known:
        raise ValueError(f"no version {version} in {path}")
    return StateVersion(**json.loads(files.read_text(spark, _version_file(path, version))))


def version_at(spark: SparkSession, path: str, millis: int) -> int | None:
    """The newest version committed at or before a time."""
    held = [v for v in versions(spark, path) if load_version(spark, path, v).time <= millis]
    return held[-1] if held else None


def _version_file(path: str, version: int) -> str:
    return f"{path}/versions/{version:012d}.json"


def read_state(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    shards: list[int] | None = None,
    skip_unreadable: bool = False,
) -> DataFrame:
    """State rows with their ``shard_id``, from the newest or a pinned version; deleted keys are not among them.

    A shard of one folder is read as it is, only the others are folded. ``skip_unreadable`` leaves out missing or
    corrupt files instead of failing.
    """
    current = load_version(spark, path, version)
    held = _held(spark, path, current, shards, skip_unreadable)
    if not held:
        rows = spark.createDataFrame([], schemas.STATE).withColumn("shard_id", F.lit(0))
        return _counted(rows, current)
    loose = set(current.loose)
    deletes = bool(current.ranges) or any(d in loose for dirs in held.values() for d in dirs)
    single = {s: dirs for s, dirs in held.items() if len(dirs) == 1 and not current.ranges and not loose.intersection(dirs)}
    several = {s: dirs for s, dirs in held.items() if s not in single}
    out = None
    columns = [*STATE_KEY, "first_seen", "last_seen", "shard_id"]
    if single:
        out = _scan(spark, path, single, skip_unreadable).select(*columns)
    if several:
        rows = _scan(spark, path, several, skip_unreadable)
        if deletes:
            folded = _live(rows, current).select(*columns)
        else:
            folded = fold_events(rows, current.zero_is_missing, by=["shard_id"]).select(*columns)
        out = folded if out is None else out.unionByName(folded)
    return _counted(out, current)


def _held(spark: SparkSession, path: str, current: StateVersion | None, shards: list[int] | None, skip_missing: bool) -> dict[int, list[str]]:
    known = {} if current is None else current.shards
    held = {int(s): dirs for s, dirs in known.items() if shards is None or int(s) in shards}
    if skip_missing:
        held = {s: [d for d in dirs if files.exists(spark, f"{path}/{d}")] for s, dirs in held.items()}
    return {s: dirs for s, dirs in held.items() if dirs}


def _scan(spark: SparkSession, path: str, held: dict[int, list[str]], skip_unreadable: bool = False) -> DataFrame:
    return (
        spark.read.schema(f"{_STORED}, v string, shard_id int")
        .option("basePath", f"{path}/data")
        .option("ignoreMissingFiles", str(skip_unreadable).lower())
        .option("ignoreCorruptFiles", str(skip_unreadable).lower())
        .parquet(*sorted(f"{path}/{d}" for dirs in held.values() for d in dirs))
        .drop("v")
    )


def _entries(rows: DataFrame, current: StateVersion) -> DataFrame:
    """Per key: ``gone``, the position up to which it is deleted (-1: nowhere), and its puts behind that.

    A key has an entry per folder and position at most, so the list is as long as the table has uncompacted batches.
    """
    position = F.coalesce("position", F.lit(0))
    deleted = F.coalesce("is_delete", F.lit(False))
    put = F.when(~deleted, F.struct(position.alias("position"), "first_seen", "last_seen"))
    grouped = rows.groupBy("shard_id", *STATE_KEY).agg(
        F.coalesce(F.max(F.when(deleted, position)), F.lit(-1)).alias("gone"), F.collect_list(put).alias("puts")
    )
    if current.ranges:
        grouped = grouped.withColumn("gone", F.greatest("gone", _range_position(make_key(*STATE_KEY), current.ranges)))
    return grouped.withColumn("puts", F.filter("puts", lambda p: p["position"] > F.col("gone")))


def _range_position(key: Column, ranges: list[list]) -> Column:
    """The greatest position of the ranges [low, high) that hold a key, or -1."""
    bounds = sorted({end for low, high, _ in ranges for end in (low, high)})
    over = [max((p for low, high, p in ranges if low <= start < high), default=-1) for start in bounds]
    below = place_of(key, bounds)
    starts = F.array(*[F.lit(b) for b in bounds])
    segment = below - F.when(F.coalesce(F.get(starts, below) == key, F.lit(False)), 0).otherwise(1)
    return F.coalesce(F.get(F.array(*[F.lit(p) for p in over]).cast("array<bigint>"), segment), F.lit(-1))


def _ends(puts: Column, zero_is_missing: bool) -> list[Column]:
    def times(name: str) -> Column:
        found = F.transform(puts, lambda p: p[name])
        return F.filter(found, lambda t: t != 0) if zero_is_missing else found

    first, last = F.array_min(times("first_seen")), F.array_max(times("last_seen"))
    if zero_is_missing:
        first, last = (F.coalesce(x, F.lit(0).cast("bigint")) for x in (first, last))
    return [first.alias("first_seen"), last.alias("last_seen")]


def _live(rows: DataFrame, current: StateVersion) -> DataFrame:
    kept = _entries(rows, current).where(F.size("puts") > 0)
    return kept.select(*STATE_KEY, *_ends(F.col("puts"), current.zero_is_missing), "shard_id")


def _counted(rows: DataFrame, current: StateVersion | None) -> DataFrame:
    """Notes the table's number of shards on ``shard_id``, where lookups find it."""
    about = {} if current is None else {SHARD_COUNT: current.n_shards}
    return rows.withColumn("shard_id", F.col("shard_id").alias("shard_id", metadata=about))


def upsert_state(
    spark: SparkSession,
    path: str,
    events: DataFrame,
    n_shards: int = DEFAULT_SHARDS,
    zero_is_missing: bool = True,
    position: int | None = None,
) -> StateVersion | None:
    """Folds events (or state rows) and adds them to the table; returns the version now current.

    Only the folded batch is written. A table keeps the number of shards and the meaning of zero it was made with.
    ``position`` orders the batch among deletes and stays the same when it comes again; without it, batches are ordered
    as they are committed. One writer at a time: a second one fails on commit.
    """
    current = load_version(spark, path)
    if current is not None:
        n_shards, zero_is_missing = current.n_shards, current.zero_is_missing
    folded = fold_events(events, zero_is_missing).withColumn("is_delete", F.lit(False))
    at = _position(current, position)
    return _append(spark, path, current, folded.withColumn("position", F.lit(at)), n_shards, zero_is_missing, "upsert", position is not None, at)


def delete_state(spark: SparkSession, path: str, keys: DataFrame, position: int | None = None) -> StateVersion | None:
    """Deletes the keys (domain, type, value): a small batch of its own, no row of the table is rewritten.

    What is hidden is everything of these keys at ``position`` or before, also what arrives later.
    """
    current = load_version(spark, path)
    if current is None:
        return None
    none = F.lit(None).cast("bigint")
    rows = keys.select(*STATE_KEY).distinct().select(*STATE_KEY, none.alias("first_seen"), none.alias("last_seen"), F.lit(True).alias("is_delete"))
    at = _position(current, position)
    return _append(spark, path, current, rows.withColumn("position", F.lit(at)), current.n_shards, current.zero_is_missing, "delete", position is not None, at)


def delete_state_range(spark: SparkSession, path: str, low: str, high: str, position: int | None = None) -> StateVersion | None:
    """Deletes the keys ``domain|type|value`` in [low, high): one line in the new version."""
    current = load_version(spark, path)
    if current is None or low >= high:
        return current
    if len(current.ranges) >= MOST_RANGES:
        raise ValueError(f"{MOST_RANGES} range deletes are open: compact the table first")
    at = _position(current, position)
    ranges = [*current.ranges, [low, high, at]]
    made = replace(current, ranges=ranges, kind="range", added=[], explicit=current.explicit or position is not None, top=max(current.top, at))
    return _commit(spark, path, current, made)


def apply_state_changes(spark: SparkSession, path: str, ops: DataFrame, seq: str = "seq", n_shards: int = DEFAULT_SHARDS) -> StateVersion | None:
    """An ordered batch of puts and deletes (key columns, times, ``is_delete`` and ``seq``, the rows' own positions)."""
    current = load_version(spark, path)
    zero_is_missing = True
    if current is not None:
        n_shards, zero_is_missing = current.n_shards, current.zero_is_missing
    placed = ops.withColumns({"position": F.col(seq).cast("bigint"), "is_delete": F.coalesce("is_delete", F.lit(False))})
    rows = fold_events(placed, zero_is_missing, by=["position", "is_delete"])
    top = placed.agg(F.max("position")).first()[0] or 0
    return _append(spark, path, current, rows, n_shards, zero_is_missing, "delete", True, top)


def _position(current: StateVersion | None, position: int | None) -> int:
    """The caller's position; without one, behind all that the table has."""
    if position is not None:
        return position
    return max(current.version, current.top) + 1 if current else 1


def _append(
    spark: SparkSession, path: str, current: StateVersion | None, rows: DataFrame, n_shards: int, zero_is_missing: bool, kind: str, explicit: bool, top: int
) -> StateVersion | None:
    added = _written(spark, path, current, with_shard(rows, n_shards))
    if not added:
        return current
    held = current.shards if current else {}
    shards = {s: [*held.get(s, []), *added.get(s, [])] for s in {**held, **added}}
    fresh = [d for dirs in added.values() for d in dirs]
    made = StateVersion(
        0, n_shards, shards, zero_is_missing, kind, fresh,
        [*(current.loose if current else []), *(fresh if kind == "delete" else [])],
        current.ranges if current else [], explicit or bool(current and current.explicit), max(top, current.top if current else 0),
    )
    return _commit(spark, path, current, made)


def compact_state(
    spark: SparkSession, path: str, min_folders: int = 2, share: float = 0.0, settled: int | None = None
) -> StateVersion | None:
    """Merges the folders of every shard that has at least ``min_folders``; other shards stay as they are.

    With a ``share``, a shard waits until its other folders have that share of the bytes of the largest one, so that
    what is written over time stays in proportion to what came in. Deletes up to ``settled`` are carried out and
    dropped: no batch at or before that position may come again. Where callers give no positions of their own, all
    batches are settled; where they do, none is unless they say so.
    """
    current = load_version(spark, path)
    if current is None:
        return None
    if settled is None:
        settled = -1 if current.explicit else current.top
    done = [r for r in current.ranges if r[2] <= settled]
    loose = set(current.loose)
    due = []
    for s, folders in current.shards.items():
        if len(folders) >= max(2, min_folders):
            sizes = [files.bytes_in(spark, f"{path}/{d}") for d in folders] if share else [0]
            if sum(sizes) - max(sizes) >= share * max(sizes):
                due.append(int(s))
                continue
        if done or (settled >= 0 and loose.intersection(folders)):
            due.append(int(s))
    if not due and not done:
        return current
    whole = _scan(spark, path, {s: current.shards[str(s)] for s in due})
    kept = {s: folders for s, folders in current.shards.items() if int(s) not in due}
    open_deletes = bool(loose) or bool(current.ranges) or current.explicit
    merged = _written(spark, path, current, _settle(whole, current, settled) if open_deletes else _plain(whole, current))
    fresh = [d for dirs in merged.values() for d in dirs]
    still = [d for d in current.loose if any(d in dirs for dirs in kept.values())]
    made = replace(
        current, shards={**kept, **merged}, kind="compact", added=fresh,
        loose=[*still, *(fresh if open_deletes and settled < current.top else [])],
        ranges=[r for r in current.ranges if r[2] > settled],
    )
    return _commit(spark, path, current, made)


def _plain(rows: DataFrame, current: StateVersion) -> DataFrame:
    return fold_events(rows, current.zero_is_missing, by=["shard_id"]).select("*", F.lit(current.top).alias("position"), F.lit(False).alias("is_delete"))


def _settle(rows: DataFrame, current: StateVersion, settled: int) -> DataFrame:
    """What is left of every key: one row for all that is settled, and the rows and the delete that are not."""
    entries = _entries(rows, current)
    old = F.filter("puts", lambda p: p["position"] <= settled)
    new = F.filter("puts", lambda p: p["position"] > settled)
    none = F.lit(None).cast("bigint")

    def row(position: Column, first: Column, last: Column, deleted: bool) -> Column:
        return F.struct(position.cast("bigint").alias("position"), first.alias("first_seen"), last.alias("last_seen"), F.lit(deleted).alias("is_delete"))

    first, last = _ends(old, current.zero_is_missing)
    merged = F.when(F.size(old) > 0, F.array(row(F.array_max(F.transform(old, lambda p: p["position"])), first, last, False)))
    kept = F.transform(new, lambda p: row(p["position"], p["first_seen"], p["last_seen"], False))
    gone = F.when(F.col("gone") > settled, F.array(row(F.col("gone"), none, none, True)))
    empty = F.filter(kept, lambda _: F.lit(False))
    every = F.concat(F.coalesce(merged, empty), kept, F.coalesce(gone, empty))
    return entries.select(*STATE_KEY, "shard_id", F.inline(every))


def rewrite_state(
    spark: SparkSession, path: str, state: DataFrame, n_shards: int = DEFAULT_SHARDS
) -> StateVersion:
    """Replaces the whole table by the given rows, as a new version."""
    current = load_version(spark, path)
    zero_is_missing = True
    if current is not None:
        n_shards, zero_is_missing = current.n_shards, current.zero_is_missing
    at = F.lit(_position(current, None))
    rows = with_shard(state.select(*STATE_KEY, "first_seen", "last_seen", at.alias("position"), F.lit(False).alias("is_delete")), n_shards)
    shards = _written(spark, path, current, rows)
    fresh = [d for dirs in shards.values() for d in dirs]
    return _commit(spark, path, current, StateVersion(0, n_shards, shards, zero_is_missing, "rewrite", fresh, top=_position(current, None)))


def _written(spark: SparkSession, path: str, current: StateVersion | None, rows: DataFrame) -> dict[str, list[str]]:
    """Writes rows in a folder no other writer touches; the folders by shard."""
    folder = f"data/v={(current.version if current else 0) + 1}-{uuid.uuid4().hex[:8]}"
    target = f"{path}/{folder}"
    (
        rows.select(*[F.col(c).cast("bigint") if c == "position" else F.col(c) for c in _ROW], "shard_id")
        .repartitionByRange("shard_id", *STATE_KEY)
        .sortWithinPartitions("shard_id", *STATE_KEY)
        .write.mode("overwrite")
        .partitionBy("shard_id")
        .parquet(target)
    )
    names = [n for n in files.names_in(spark, target) if n.startswith("shard_id=")]
    return {name.split("=")[1]: [f"{folder}/{name}"] for name in names}


def _commit(spark: SparkSession, path: str, current: StateVersion | None, made: StateVersion) -> StateVersion:
    made = replace(made, version=(current.version if current else 0) + 1, time=int(time.time() * 1000))
    files.write_new(spark, _version_file(path, made.version), json.dumps(made.__dict__))
    return made


def bulk_upsert(spark: SparkSession, path: str, state: DataFrame, **options) -> StateVersion | None:
    """Loads ready-made state rows (for instance read from Parquet files) in one large batch."""
    return upsert_state(spark, path, state, **options)


def state_changes(spark: SparkSession, path: str, old: int, new: int | None = None) -> DataFrame:
    """Keys that differ between two versions, with ``op`` (insert, update, delete) and their new times.

    Only the folders that versions after ``old`` brought are read whole; their keys are then looked up in either
    version, by name while there are few. A compaction changes nothing and is not read. Where a version between
    the two is no longer kept, or was a rewrite, the folders the two do not share stand in for it.
    """
    after = load_version(spark, path, new)
    before = load_version(spark, path, old)
    known = set(versions(spark, path))
    steps = range(old + 1, after.version + 1)
    log = [load_version(spark, path, v) for v in steps] if known.issuperset(steps) else []
    read_before, read_after = read_state(spark, path, old), read_state(spark, path, after.version)
    if len(log) == len(steps) and all(v.kind != "rewrite" for v in log):
        fresh = [d for v in log if v.kind in ("upsert", "delete") for d in v.added]
    else:
        sides = [{d for dirs in v.shards.values() for d in dirs} for v in (before, after)]
        fresh = sorted(sides[0] ^ sides[1])
    ranges = [r for r in after.ranges if r not in before.ranges]
    ranges += [r for v in log for r in v.ranges if r not in before.ranges and r not in ranges]
    keys = []
    shards = {int(d.rsplit("=", 1)[1]) for d in fresh}
    if fresh:
        keys.append(_scan(spark, path, {0: fresh}).select(*STATE_KEY))
    for low, high, _ in ranges:
        key = make_key(*STATE_KEY)
        keys.append(read_before.where((key >= low) & (key < high)).select(*STATE_KEY))
        shards |= {int(s) for s in before.shards}
    values = ("first_seen", "last_seen")
    if not keys:
        return changes_since(read_before.limit(0), read_after.limit(0), STATE_KEY, values)
    asked = keys[0]
    for more in keys[1:]:
        asked = asked.unionByName(more)
    asked = asked.distinct()
    names = [r.domain for r in asked.select("domain").distinct().limit(FEW_NAMES + 1).collect()]

    def cut(version: int) -> DataFrame:
        rows = read_state(spark, path, version, sorted(shards)).drop("shard_id")
        rows = rows.where(F.col("domain").isin(names)) if len(names) <= FEW_NAMES else rows
        return rows.join(asked, STATE_KEY, "left_semi")

    return changes_since(cut(old), cut(after.version), STATE_KEY, values)


def state_sketches(spark: SparkSession, path: str, version: int | None = None, lg_k: int = LG_K) -> DataFrame:
    """A row per shard: its number of keys and sketches of its domains and addresses, for ``united_sketches``.

    A shard's row is kept under the folders it was made from, so only shards that changed since are read again.
    """
    current = load_version(spark, path, version)
    kind = "shard_id int, name string, records bigint, ips binary, domains binary"
    if current is None or not current.shards:
        return spark.createDataFrame([], kind)
    names = {
        int(s): hashlib.sha256(json.dumps([lg_k, sorted(dirs), current.ranges]).encode()).hexdigest() for s, dirs in current.shards.items()
    }
    folder = f"{path}/sketches"
    held = spark.read.schema(kind).parquet(folder) if files.exists(spark, folder) else spark.createDataFrame([], kind)
    held = held.where(F.col("name").isin(*names.values()))
    known = {r["name"] for r in held.select("name").collect()}
    due = [s for s, name in names.items() if name not in known]
    if due:
        address = F.when(F.col("type").isin("A", "AAAA"), F.col("value"))
        rows = read_state(spark, path, current.version, due).groupBy("shard_id").agg(
            F.count("*").alias("records"), F.hll_sketch_agg(address, lg_k).alias("ips"), F.hll_sketch_agg("domain", lg_k).alias("domains")
        )
        named = F.create_map(*[F.lit(x) for s in due for x in (s, names[s])])
        rows.select("shard_id", F.element_at(named, F.col("shard_id")).alias("name"), "records", "ips", "domains").write.mode("append").parquet(folder)
        held = spark.read.schema(kind).parquet(folder).where(F.col("name").isin(*names.values()))
    return held.dropDuplicates(["name"])


def united_sketches(sketches: DataFrame) -> DataFrame:
    """One row: the number of keys and the estimated numbers of different domains and addresses."""

    def estimate(name: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0))

    return sketches.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"), estimate("ips").alias("ips"), estimate("domains").alias("domains"))


def hold_version(spark: SparkSession, path: str, version: int | None = None, seconds: float = 3600) -> tuple[int, str]:
    """Takes a lease: until it ends or is given back, ``drop_old_versions`` leaves the version and its folders alone."""
    current = load_version(spark, path, version)
    if current is None:
        raise ValueError(f"no version in {path}")
    lease = f"{path}/leases/{current.version}-{uuid.uuid4().hex}.json"
    files.write_new(spark, lease, json.dumps({"version": current.version, "until": time.time() + seconds}))
    load_version(spark, path, current.version)  # it may have gone in between: then this fails, and nothing was read
    return current.version, lease


def release_version(spark: SparkSession, lease: str) -> None:
    files.delete_tree(spark, lease)


@contextmanager
def pinned_version(spark: SparkSession, path: str, version: int | None = None, seconds: float = 3600) -> Iterator[int]:
    """The newest or a given version, held for as long as the block runs, ``seconds`` at most."""
    held, lease = hold_version(spark, path, version, seconds)
    try:
        yield held
    finally:
        release_version(spark, lease)


def _leased(spark: SparkSession, path: str) -> set[int]:
    """The versions with a lease that has not ended; ended ones are removed."""
    out = set()
    for name in files.names_in(spark, f"{path}/leases"):
        if name[0] == ".":
            continue
        lease = json.loads(files.read_text(spark, f"{path}/leases/{name}"))
        if lease["until"] > time.time():
            out.add(lease["version"])
        else:
            files.delete_tree(spark, f"{path}/leases/{name}")
    return out


def drop_old_versions(spark: SparkSession, path: str, keep: int = 10, min_age: float = 0) -> list[int]:
    """Removes all but the newest ``keep`` versions and the shard folders only they used.

    Versions with a lease stay, and so do those committed within ``min_age`` seconds.
    """
    known = versions(spark, path)
    if keep < 1 or len(known) <= keep:
        return []
    held = _leased(spark, path)
    latest = (time.time() - min_age) * 1000
    loaded = {v: load_version(spark, path, v) for v in known}
    gone = [v for v in known[:-keep] if v not in held and (not min_age or loaded[v].time < latest)]
    kept = [v for v in known if v not in gone]
    if not gone:
        return []
    needed = {d for v in kept for folders in loaded[v].shards.values() for d in folders}
    for version in gone:
        files.delete_tree(spark, _version_file(path, version))
    for folder in files.names_in(spark, f"{path}/data"):
        # A folder of a version still to come belongs to a writer at work.
        if int(folder.removeprefix("v=").split("-")[0]) > kept[-1]:
            continue
        used = [d for d in needed if d.startswith(f"data/{folder}/")]
        if not used:
            files.delete_tree(spark, f"{path}/data/{folder}")
            continue
        for name in files.names_in(spark, f"{path}/data/{folder}"):
            if name.startswith("shard_id=") and f"data/{folder}/{name}" not in needed:
                files.delete_tree(spark, f"{path}/data/{folder}/{name}")
    return gone


def decode_kv(df: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """State rows from ``domain|type|value`` keys and JSON time ranges; unreadable rows go."""
    parsed = df.select(
        parse_key(key).alias("_key"),
        F.from_json(value, "first_seen string, last_seen string", {"mode": "PERMISSIVE"}).alias("_range"),
        F.try_parse_json(value).isNotNull().alias("_json"),
    )
    usable = parsed.where(F.col("_key").isNotNull() & F.col("_json"))
    zero = F.lit(0).cast("bigint")
    return usable.select(
        "_key.*",
        *[
            F.coalesce(F.col(f"_range.{end}").try_cast("bigint"), zero).alias(end)
            for end in ("first_seen", "last_seen")
        ],
    )
