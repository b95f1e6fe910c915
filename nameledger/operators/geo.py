"""IP → geo range, at most one range per address.

A range table is prepared once. Each range is filed, cut to size, under aligned blocks of the address space: those of the
level, eight bits apart from the next, at which its two ends part. So a block holds ranges of about its own size only,
at most some twenty unless they overlap, whatever wider or narrower ranges surround it. Overlaps within a block are
settled there; those between levels are settled at lookup, where the greatest start wins. While the range table is
small enough to broadcast, the lookup is one equi-join per level in use, with the range test as its condition; it does
not fan out and the address side is not shuffled. Beyond that, addresses and pieces of all levels and both IP versions go
through one exchange together, and the last piece of each level is carried forward to the addresses behind it.
"""

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from nameledger.functions.ip import lookup_v4, lookup_v6
from nameledger.functions.text import non_empty, once
from nameledger.operators.predecessor import carry_forward, deal

BROADCAST_BYTES = 256 << 20
#: What a broadcast row takes besides its text.
_ROW_BYTES = 96


@dataclass(frozen=True)
class _Space:
    """How the addresses of one IP version are cut into blocks; levels go from fine to coarse."""

    width: int
    levels: tuple[int, ...]

    def number(self, ip: Column | str) -> Column:
        return lookup_v4(ip) if self.width == 32 else lookup_v6(ip)

    def block(self, address: Column, level: int) -> Column:
        """The name of the block an address is in: a number, or the leading hex digits."""
        if self.width == 32:
            return F.shiftright(address, 32 - level)
        return F.left(F.hex(address), F.lit(level // 4))

    def agreed(self) -> Column:
        """How many leading hex digits start and end have in common."""
        if self.width == 32:
            apart = F.col("start").bitwiseXOR(F.col("end"))
            return F.when(apart == 0, F.lit(8)).otherwise(F.floor((32 - F.length(F.bin(apart))) / 4)).cast("int")
        both = F.concat_ws("|", F.hex("start"), F.hex("end"))
        return F.length(F.regexp_extract(both, r"^([0-9A-F]*)[0-9A-F]*\|\1", 1))

    def blocks(self, agreed: Column, digits: Column) -> Column:
        """The blocks of so many hex digits from start to end: one, sixteen at most, or 256 of the coarsest."""
        if self.width == 32:
            size = F.lit(32) - 4 * digits
            return F.sequence(*[F.call_function("shiftright", F.col(c), size) for c in ("start", "end")])
        head, counted = F.left(F.hex("start"), agreed), digits - agreed
        ends = [F.conv(F.substring(F.hex(c), agreed + 1, counted), 16, 10).cast("bigint") for c in ("start", "end")]
        several = F.transform(F.sequence(*ends), lambda n: F.concat(head, F.lpad(F.hex(n), counted, F.lit("0"))))
        return F.when(counted == 0, F.array(head)).otherwise(several)

    def bounds(self, block: Column, level: Column | int) -> tuple[Column, Column]:
        """First and last address of a block."""
        if self.width == 32:
            size = F.pow(F.lit(2), F.lit(32) - level).cast("bigint")
            return block * size, block * size + size - 1
        return F.unhex(F.rpad(block, 32, "0")), F.unhex(F.rpad(block, 32, "F"))

    def ordered(self, address: Column) -> Column:
        """The address as bytes in numeric order."""
        return F.unhex(F.lpad(F.hex(address), 8, F.lit("0"))) if self.width == 32 else address

    def dealing_key(self, address: Column) -> Column:
        """A number to deal addresses by: the address itself, or its leading 60 bits."""
        return address if self.width == 32 else F.conv(F.left(F.hex(address), F.lit(15)), 16, 10).cast("bigint")

    def step(self, address: Column, by: int) -> Column:
        return address + by if self.width == 32 else _step_bytes16(address, by)


_SPACES = {4: _Space(32, (32, 24, 16, 8)), 6: _Space(128, tuple(range(128, 0, -8)))}


def _step_bytes16(address: Column, by: int) -> Column:
    """The neighbour of a 16-byte address, worked out on its two 64-bit halves."""
    digits = F.hex(address)
    top = F.lit(Decimal(2**64))

    def number(half: Column) -> Column:
        return F.conv(half, 16, 10).cast("decimal(20,0)")

    def hex16(value: Column) -> Column:
        return F.lpad(F.conv(value.cast("decimal(20,0)").cast("string"), 10, 16), 16, "0")

    high, low = number(F.left(digits, F.lit(16))), number(F.right(digits, F.lit(16)))
    low_moved = low + by
    carried = (low_moved < 0) | (low_moved >= top)
    high_moved = F.when(carried, high + by).otherwise(high)
    return F.unhex(F.concat(hex16(high_moved), hex16(F.pmod(low_moved, top))))


def _filed(geo: DataFrame, space: _Space) -> DataFrame:
    """A row for each block of each range, cut to the block; unusable ranges are left out, equal ones are one."""
    usable = geo.where(F.col("start").isNotNull() & (F.col("end") >= F.col("start")))
    single = usable.groupBy("start", "end").agg(F.min(F.struct("country", "city")).alias("_place"))
    filed = once(single, "_agreed", space.agreed())
    ahead = F.col("_agreed") + 1
    digits = F.least(F.greatest(ahead - ahead % 2, F.lit(2)), F.lit(space.width // 4))
    filed = once(filed, "_digits", digits.cast("int"))
    blocks = space.blocks(F.col("_agreed"), F.col("_digits"))
    placed = filed.select("*", (4 * F.col("_digits")).alias("level"), F.explode(blocks).alias("block"))
    first, last = space.bounds(F.col("block"), F.col("level"))
    return placed.select(
        "level",
        "block",
        F.greatest("start", first).alias("start"),
        F.least("end", last).alias("end"),
        F.col("start").alias("from"),
        F.col("end").alias("upto"),
        "_place.*",
    )


_PLACE = ["level", "block"]


def _settle(pieces: DataFrame, space: _Space) -> DataFrame:
    """Overlapping pieces of a block cut into segments; each goes to the range with the greatest start.

    Of ranges with the same start the one that ends first wins. A segment meets the pieces of its own block only.
    """
    # A cut is (address, side): side 0 lies before the address, side 1 after it.
    edges = F.explode(
        F.array(
            F.struct(F.col("start").alias("at"), F.lit(0).alias("side")),
            F.struct(F.col("end").alias("at"), F.lit(1).alias("side")),
        )
    )
    cuts = pieces.select(*_PLACE, edges.alias("cut")).distinct()
    following = F.lead("cut").over(Window.partitionBy(*_PLACE).orderBy("cut"))
    segments = cuts.withColumn("next", following).where(F.col("next").isNotNull())
    at, side = F.col("cut.at"), F.col("cut.side")
    next_at, next_side = F.col("next.at"), F.col("next.side")
    bounded = segments.select(
        *_PLACE,
        F.when(side == 0, at).otherwise(space.step(at, 1)).alias("seg_start"),
        F.when(next_side == 1, next_at).otherwise(space.step(next_at, -1)).alias("seg_end"),
    ).where(F.col("seg_start") <= F.col("seg_end"))
    covering = bounded.join(pieces, _PLACE).where(
        (F.col("start") <= F.col("seg_start")) & (F.col("end") >= F.col("seg_end"))
    )
    # of those with the greatest start (first), the one that ends first
    latest = F.max("from").over(Window.partitionBy(*_PLACE, "seg_start"))
    ahead = covering.withColumn("_latest", latest).where(F.col("from") == F.col("_latest"))
    owner = F.min(F.struct("upto", "country", "city", "from")).alias("_owner")
    settled = ahead.groupBy(*_PLACE, "seg_start", "seg_end").agg(owner)
    return settled.select(
        *_PLACE, F.col("seg_start").alias("start"), F.col("seg_end").alias("end"), "_owner.*"
    )


@dataclass(frozen=True)
class GeoTable:
    """A prepared range table: filed pieces without overlap in a block, their size and the levels in use."""

    pieces: DataFrame
    version: int
    size: int
    levels: tuple[int, ...]


def prepare_geo(geo: DataFrame, version: int = 4) -> GeoTable:
    """Files the ranges (start, end, country, city) of one IP version and settles overlaps within blocks.

    Runs one small job over the range table (two when ranges overlap): it finds out whether they
    do, how many bytes a join would broadcast over all levels, and which levels are in use.
    """
    space = _SPACES[version]
    pieces = _filed(geo, space)
    facts = _facts(pieces)
    if facts["clash"]:
        pieces = _settle(pieces, space)
        facts = _facts(pieces)
    levels = tuple(level for level in space.levels if level in facts["levels"])
    return GeoTable(pieces, version, facts["size"], levels)


def _facts(pieces: DataFrame) -> Row:
    by_start = Window.partitionBy(*_PLACE).orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    text = F.coalesce(F.length("country"), F.lit(0)) + F.coalesce(F.length("city"), F.lit(0))
    judged = pieces.select("level", text.alias("text"), (reach >= F.col("start")).alias("clash"))
    return judged.agg(
        F.coalesce(F.bool_or("clash"), F.lit(False)).alias("clash"),
        F.coalesce(F.sum(F.col("text") + _ROW_BYTES), F.lit(0)).alias("size"),
        F.collect_set("level").alias("levels"),
    ).first()


def _geo_columns(df: DataFrame, table: GeoTable, ip: str) -> tuple[DataFrame, list[str]]:
    """Adds a struct column per level, the finest first, null where nothing covers the address; ranges are broadcast."""
    space, v = _SPACES[table.version], table.version
    out, hits = once(df, f"_ip{v}", space.number(ip)), []
    for level in table.levels:
        hit = f"_geo{v}_{level}"
        ranges = table.pieces.where(F.col("level") == level).select(
            F.col("block").alias("_block"),
            F.col("start").alias("_start"),
            F.col("end").alias("_end"),
            F.struct("from", "upto", "country", "city").alias(hit),
        )
        keyed = out.withColumn("_key", space.block(F.col(f"_ip{v}"), level))
        covered = (
            (keyed["_key"] == ranges["_block"])
            & (keyed[f"_ip{v}"] >= ranges["_start"])
            & (keyed[f"_ip{v}"] <= ranges["_end"])
        )
        joined = keyed.join(F.broadcast(ranges), covered, "left")
        out = joined.drop("_key", "_block", "_start", "_end")
        hits.append(hit)
    return out.drop(f"_ip{v}"), hits


def _carried(df: DataFrame, tables: list[GeoTable], ip: str) -> DataFrame:
    """Adds ``_place``, the struct of the range that holds each address, however large the tables: one exchange of ``df``."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(tables))
    points = df
    for t in tables:
        points = once(points, f"_ip{t.version}", _SPACES[t.version].number(ip))
    keys = [_SPACES[t.version].dealing_key(F.col(f"_ip{t.version}")) for t in tables]
    dealt = deal(points, keys, parts)
    parts = max(parts, dealt[-1].first + len(dealt[-1].bounds) + 1)

    spread = F.monotonically_increasing_id()
    part = F.pmod(spread, F.lit(parts)).cast("int")  # text that is no address meets nothing anywhere
    at = F.lit(None).cast("binary")
    pieces = None
    for t, key, mine in zip(tables, keys, dealt, strict=True):
        space, number = _SPACES[t.version], F.col(f"_ip{t.version}")
        first, last = mine.of(key), mine.of(key, last=True)
        part = F.when(number.isNotNull(), (first + F.pmod(spread, last - first + 1)).cast("int")).otherwise(part)
        at = F.when(number.isNotNull(), space.ordered(number)).otherwise(at)
        low, high = mine.of(space.dealing_key(F.col("start"))), mine.of(space.dealing_key(F.col("end")), last=True)
        slot = F.array_position(F.array(*[F.lit(x) for x in t.levels]), F.col("level")) - 1
        ends = [space.ordered(F.col(c)).alias(c) for c in ("end", "from", "upto")]
        sent = t.pieces.select(
            F.explode(F.sequence(low, high).cast("array<int>")).alias("part"),
            space.ordered(F.col("start")).alias("at"),
            F.struct(slot.alias("slot"), *ends, "country", "city").alias("range"),
        )
        pieces = sent if pieces is None else pieces.unionByName(sent)
    rows = points.select(part.alias("part"), at.alias("at"), F.struct(*df.columns).alias("row"))
    slots = max(len(t.levels) for t in tables)
    held = carry_forward(rows, pieces, parts, slots)
    hits = [F.when(F.col(f"slot{i}")["end"] >= F.col("at"), F.col(f"slot{i}")) for i in range(slots)]
    # each is needed by name: the choice compares them with one another
    named = held.select("row", *[h.alias(f"hit{i}") for i, h in enumerate(hits)])
    place = _best([F.col(f"hit{i}") for i in range(slots)])
    found = F.coalesce(*[F.col(f"hit{i}") for i in range(slots)]).isNotNull()
    chosen = F.when(found, F.struct(place["country"].alias("country"), place["city"].alias("city")))
    return named.select("row.*", chosen.alias("_place"))


def _best(hits: list[Column]) -> Column:
    """Of the levels' hits, the one with the greatest start, and of equal starts the one that ends first."""
    best = hits[0]
    for hit in hits[1:]:
        ahead = (hit["from"] > best["from"]) | ((hit["from"] == best["from"]) & (hit["upto"] < best["upto"]))
        best = F.when(best.isNull() | ahead, hit).otherwise(best)
    return best


def geo_join(
    df: DataFrame,
    v4: GeoTable | DataFrame | None = None,
    v6: GeoTable | DataFrame | None = None,
    ip: str = "ip",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with ``country`` and ``city`` of the range that holds each address, else null.

    IPv4-mapped IPv6 addresses use the IPv4 table; text that is no address keeps its row.
    ``broadcast_bytes`` bounds what all levels of a table together may broadcast.
    """
    base = df.drop("country", "city")
    out, found, large = base, [], []
    for version, table in ((4, v4), (6, v6)):
        if table is None:
            continue
        if isinstance(table, DataFrame):
            table = prepare_geo(table, version)
        if table.levels and table.size > broadcast_bytes:
            large.append(table)
            continue
        out, added = _geo_columns(out, table, ip)
        if added:
            name = f"_best{version}"
            place = _best([F.col(h) for h in added])
            chosen = F.struct(place["country"].alias("country"), place["city"].alias("city"))
            out = out.withColumn(name, F.when(F.coalesce(*added).isNotNull(), chosen)).drop(*added)
            found.append(name)
    if large:
        out = _carried(out, large, ip)
        found.append("_place")
    if not found:
        none = F.lit(None).cast("string")
        return base.withColumns({"country": none, "city": none})
    hit = F.coalesce(*found)
    return out.select(
        *base.columns,
        non_empty(hit["country"]).alias("country"),
        non_empty(hit["city"]).alias("city"),
    )


def overlay_geo(
    intel: DataFrame,
    v4: GeoTable | DataFrame | None = None,
    v6: GeoTable | DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Index records with geo laid over what they had: only non-empty values replace."""
    held = [c for c in ("country", "city") if c in intel.columns]
    kept = intel.withColumnsRenamed({c: f"_{c}" for c in held})
    joined = geo_join(kept, v4, v6, broadcast_bytes=broadcast_bytes)
    for c in held:
        joined = joined.withColumn(c, F.coalesce(F.col(c), non_empty(f"_{c}")))
    return joined.drop(*[f"_{c}" for c in held])
