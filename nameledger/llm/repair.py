"""Repair of conversations whose roles should alternate, by the cheapest edits.

Turns come to one task per conversation, the last turn first, and stream through it: what an Arrow batch leaves open
goes on with the next one. The state is the least cost from here to the end for each of four places in
``(s?(ua)+)?``; every turn leaves one byte that says which edit is best at each place. These bytes, and the turns
themselves, go to a spooled file that leaves memory when a conversation is long. When the first turn has come, the bytes
are followed forward: that gives the edits, and of equally cheap ones the least in ASCII order, as no two edits of a
letter lead from a place to different ones.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from tempfile import SpooledTemporaryFile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Costs of the edits; a truncated turn that is not deleted adds ``TRUNCATED``.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
IN_MEMORY = 1 << 20
ROWS_OUT = 2_000

START, SYSTEM, USER, ASSISTANT = range(4)
#: Where the next role of a place leads, which role that is, and where a conversation may end.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
MAY_END = (START, ASSISTANT)
#: The edits in ASCII order; two bits of a turn's byte for each place.
LETTERS = "DIKR"
D, I, K, R = range(4)
ENDLESS = 1 << 40
#: A turn for the costs: its role's initial and its fault.
OTHER_ROLE, GOOD, CUT, UNFIT = 3, 0, 1, 2

REPORT = (
    "conv_id bigint, has_conv boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint,"
    " cost bigint, audit string, repaired_sha256 string"
)
TURNS = "conv_id bigint, has_conv boolean, position bigint, edit string, role string, text string"


def _step(after: tuple[int, ...], kind: int | None) -> tuple[tuple[int, ...], int]:
    """Costs to the end from before a turn (None: from the end itself), and the best edit of each place as two bits."""
    best = []
    for place in range(4):
        if kind is None:
            best.append((0 if place in MAY_END else ENDLESS, D))
            continue
        initial, fault = divmod(kind, 3)
        ways = [(DELETE + after[place], D)]
        if fault != UNFIT:
            more = TRUNCATED if fault == CUT else 0
            to = {0: SYSTEM if place == START else None, 1: USER, 2: ASSISTANT, OTHER_ROLE: None}[initial]
            if to is not None and (to == SYSTEM or to == NEXT[place]):
                ways.append((KEEP + more + after[to], K))
            ways.append((REROLE + more + after[NEXT[place]], R))
        best.append(min(ways))
    for _ in range(3):  # two turns are the most that can be missing in a row; costs are positive
        best = [min(b, (INSERT + best[NEXT[p]][0], I)) for p, b in enumerate(best)]
    return tuple(b for b, _ in best), sum(letter << 2 * place for place, (_, letter) in enumerate(best))


class _Steps(dict):
    """The step for (costs less the least of them, kind), worked out once each: there are few."""

    def __missing__(self, key):
        costs, byte = _step(*key)
        low = min(costs)
        self[key] = low, tuple(c - low for c in costs), byte
        return self[key]


STEPS = _Steps()
NOTHING_AFTER = STEPS[(0, 0, 0, 0), None]


class _Turns:
    """Turns of one conversation, added from the last to the first and read from the first to the last."""

    def __init__(self):
        self.file = SpooledTemporaryFile(max_size=IN_MEMORY)
        self.size = 0

    def add(self, byte: int, role: bytes, text: bytes) -> None:
        self.file.write(role + text + struct.pack("<QQB", len(role), len(text), byte))
        self.size += len(role) + len(text) + 17

    def forward(self) -> Iterator[tuple[int, bytes, bytes]]:
        """Reads backwards in large pieces; one turn is the most that is held above that."""
        held, start, end = b"", self.size, self.size

        def need(n: int) -> bytes:
            nonlocal held, start
            while end - start < n:
                size = min(max(n - (end - start), IN_MEMORY), start)
                start -= size
                self.file.seek(start)
                held = self.file.read(size) + held[: end - start - size]
            return held[end - start - n : end - start]

        while end > 0:
            role_size, text_size, byte = struct.unpack("<QQB", need(17))
            both = need(role_size + text_size + 17)
            yield byte, both[:role_size], both[role_size : role_size + text_size]
            end -= role_size + text_size + 17


class _Conversation:
    def __init__(self, conv: tuple[int, bool]):
        self.conv, self.turns = conv, _Turns()
        low, self.costs, self.end_byte = NOTHING_AFTER
        self.cost = low
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.distinct = 0
        self.next_initial = self.last = self.least = None

    def add(self, turn: int, has_turn: bool, role: str, text: str, fault: str) -> None:
        """The turn before all that were added."""
        if has_turn:
            if self.last is None:
                self.last = turn
            if turn != self.least:
                self.distinct += 1
            self.least = turn
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.next_initial is not None and initial + self.next_initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.next_initial = initial
        at = "sua".find(initial) if initial else OTHER_ROLE
        kind = 3 * (OTHER_ROLE if at < 0 else at) + (CUT if fault == "truncated" else UNFIT if fault else GOOD)
        low, self.costs, byte = STEPS[self.costs, kind]
        self.cost += low
        self.turns.add(byte, role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass"))

    def edits(self) -> Iterator[tuple[str, bytes, bytes]]:
        """(letter, role, text) of every edit in order; a deleted turn as it was."""
        place = START

        def missing(byte: int) -> Iterator[tuple[str, bytes, bytes]]:
            nonlocal place
            while byte >> 2 * place & 3 == I:
                place = NEXT[place]
                yield "I", ROLE_OF[place].encode(), b""

        for byte, role, text in self.turns.forward():
            yield from missing(byte)
            letter = byte >> 2 * place & 3
            if letter == K:
                place = SYSTEM if role[:1] == b"s" else NEXT[place]
            elif letter == R:
                place = NEXT[place]
                role = ROLE_OF[place].encode()
            yield LETTERS[letter], role, text
        yield from missing(self.end_byte)

    def report(self) -> Iterator[tuple]:
        audit, digest, between = bytearray(), hashlib.sha256(), b""
        for letter, role, text in self.edits():
            audit += letter.encode()
            if letter != "D":
                for part in (between, role, b":", text):
                    digest.update(part)
                between = b"\n"
        gaps = 0 if self.last is None else self.last - self.least + 1 - self.distinct
        gaps = (gaps + (1 << 63)) % (1 << 64) - (1 << 63)
        cost = self.cost + self.costs[START]
        yield (*self.conv, gaps, *self.counts.values(), self.illegal, cost, audit.decode(), digest.hexdigest())

    def repaired(self) -> Iterator[tuple]:
        position = 0
        for letter, role, text in self.edits():
            if letter != "D":
                yield (*self.conv, position, letter, role.decode("utf-8", "surrogatepass"), text.decode("utf-8", "surrogatepass"))
                position += 1


def _stream(what: str, names: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, open_one = [], None

        def full(least: int) -> Iterator[pd.DataFrame]:
            if len(held) >= least:
                yield pd.DataFrame(held, columns=names)
                held.clear()

        def close() -> Iterator[pd.DataFrame]:
            if open_one is not None:
                for row in getattr(open_one, what)():
                    held.append(row)
                    yield from full(ROWS_OUT)
                open_one.turns.file.close()

        columns = ["conv_id", "has_conv", "here", "turn", "has_turn", "role", "text", "fault"]
        for batch in batches:
            for conv, has, here, *turn in zip(*[batch[c].tolist() for c in columns], strict=True):
                if open_one is None or open_one.conv != (conv, has):
                    yield from close()
                    open_one = _Conversation((conv, has))
                if here:
                    open_one.add(*turn)
        yield from close()
        yield from full(1)

    return run


def _last_to_first(conversations: DataFrame) -> DataFrame:
    """Turns with their faults, a conversation in one partition, the last turn first: one exchange.

    Only the first of equal turns is none of the duplicates. The window and the sort stay within the partitions by
    conversation; both spill.
    """
    visible = F.rtrim(F.col("text"), F.lit(SPACE_CHARS))
    here = F.col("here") if "here" in conversations.columns else F.lit(True)
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("conv_id"),
        F.col("conv_id").isNotNull().alias("has_conv"),
        here.alias("here"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
        F.col("turn").isNotNull().alias("has_turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )
    order = ["has_turn", "turn", "role", "text"]
    same = Window.partitionBy("conv_id", "has_conv", "here", "role", F.xxhash64(F.lit(1), "text"), F.xxhash64(F.lit(2), "text"))
    at = rows.repartition("conv_id", "has_conv").withColumn("nth", F.row_number().over(same.orderBy(*order)))
    fault = (
        F.when(visible == "", "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.right(visible, F.lit(1)).isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    told = at.withColumn("fault", fault)
    return told.sortWithinPartitions("conv_id", "has_conv", *[F.col(c).desc() for c in [*order, "nth"]]).drop("nth")


def _run(conversations: DataFrame, what: str, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    out = _last_to_first(conversations).mapInPandas(_stream(what, names), schema)
    conv = F.when(F.col("has_conv"), F.col("conv_id")).alias("conv_id")
    return out.select(conv, *[c for c in names if c not in ("conv_id", "has_conv")])


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of (conv_id, turn, role, text): faults, cost and edits of its cheapest repair.

    Turns stand in the order of turn (null first), then role, then text; a null role or text is one space. A turn's
    first fault counts: blank; duplicate (role and text seen earlier in the conversation); truncated (no end mark). Blank
    and duplicate turns have to go. A boolean column ``here``, if there is one, is false for rows that only name their
    conversation: one without turns has zeros, no edits and the digest of nothing. Turns without a conv_id are a
    conversation of their own, other columns are ignored, and an empty table gives no row.
    """
    return _run(conversations, "report", REPORT)


def repaired_turns(conversations: DataFrame) -> DataFrame:
    """The turns of every repaired conversation, numbered from 0, each with the edit that made it (K, R or I)."""
    return _run(conversations, "repaired", TURNS)


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with faults dealt by the checksum of ``conv_id:turn``; a dropped one stays with ``here`` false."""

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = F.when(lot == 1, "").when(lot == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(lot == 4, "user").otherwise(known("role"))
    copies = F.explode(F.array_repeat(lot != 0, F.when(lot == 3, 2).otherwise(1))).alias("here")
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies)
