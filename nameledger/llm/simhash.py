"""SimHash fingerprints and near-duplicate groups by a self-join of binary tries.

Texts with equal fingerprints are one class, so copies never meet each other. The distinct fingerprints are dealt out
by ``KEYS`` selections of bits such that two within the error budget agree on at least one selection whole (pigeonhole,
three times over). Below each selection the fingerprints form a binary trie, and pairs of its nodes are walked down
together: the bits in which they differ add up, and a pair over the budget is left. A selection fixes so many of the
64 bits that no trie has more than 2**20 leaves, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameledger.llm.common import map_rows, written
from nameledger.llm.components import components

SEED = 42
WIDTH = 3
BUDGET = 2
#: Slots that pairs of trie nodes may take at a time before the walk goes on with a part of them.
PAIRS_AT_ONCE = 1 << 18


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, or of all words if there are fewer; none without words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return np.zeros(0, dtype="<u8")
    shingles = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8")


def fingerprint(text: str, width: int = WIDTH) -> int:
    """64 bits, each set if it is set in over half of the shingles' XXH64 hashes; no words: zero."""
    return fingerprint_of(shingle_hashes(text, width))


def fingerprint_of(hashes: np.ndarray) -> int:
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        total += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def split_three(bits: list[int]) -> list[list[int]]:
    third = -(-len(bits) // 3)
    return [bits[:third], bits[third : 2 * third], bits[2 * third :]]


def selections() -> list[int]:
    """Masks of fixed bits: of each third, of each third of the rest, of each third of the rest after that."""
    out = []
    for first in split_three(list(range(64))):
        rest = [b for b in range(64) if b not in first]
        for second in split_three(rest):
            rest2 = [b for b in rest if b not in second]
            out += [sum(1 << b for b in [*first, *second, *third]) for third in split_three(rest2)]
    return out


MASKS = selections()
KEYS = len(MASKS)


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_pairs(values: np.ndarray, group: np.ndarray, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of ``values`` of one group that differ in 1 to ``budget`` bits.

    ``values`` are sorted within ``group``, and a group's stand together: every trie node is a range of them. Node
    pairs start as each group with itself and are split bit by bit, from the highest; equal ranges pair with
    themselves once. Pairs of single leaves are compared at once.
    """
    ends = np.flatnonzero(np.concatenate([group[1:] != group[:-1], [True]])) + 1
    lo = np.concatenate([[0], ends[:-1]])
    work = [(63, lo, ends, lo, ends, np.zeros(len(lo), np.int64))]
    ones: dict[int, np.ndarray] = {}
    while work:
        bit, alo, ahi, blo, bhi, off = work.pop()
        live = (alo != blo) | (ahi - alo > 1)
        leaf = live & (ahi - alo == 1) & (bhi - blo == 1)
        if leaf.any():
            a, b = alo[leaf], blo[leaf]
            apart = np.bitwise_count(values[a] ^ values[b])
            good = (apart >= 1) & (apart <= budget)
            yield np.minimum(a, b)[good], np.maximum(a, b)[good]
        live &= ~leaf
        alo, ahi, blo, bhi, off = (x[live] for x in (alo, ahi, blo, bhi, off))
        if not len(alo) or bit < 0:
            continue
        if len(alo) > PAIRS_AT_ONCE:
            half = len(alo) // 2
            work += [(bit, *(x[:half] for x in (alo, ahi, blo, bhi, off))), (bit, *(x[half:] for x in (alo, ahi, blo, bhi, off)))]
            continue
        if bit not in ones:
            ones[bit] = np.concatenate([[0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        count = ones[bit]
        amid, bmid = ahi - (count[ahi] - count[alo]), bhi - (count[bhi] - count[blo])
        same = alo == blo
        children = [
            (alo, amid, blo, bmid, off, off <= budget),
            (amid, ahi, bmid, bhi, off, off <= budget),
            (alo, amid, bmid, bhi, off + 1, off < budget),
            (amid, ahi, blo, bmid, off + 1, (off < budget) & ~same),
        ]
        parts = []
        for a0, a1, b0, b1, o, ok in children:
            ok = ok & (a1 > a0) & (b1 > b0)
            parts.append([x[ok] for x in (a0, a1, b0, b1, o)])
        work.append((bit - 1, *(np.concatenate(x) for x in zip(*parts))))


def link_fingerprints(distinct: DataFrame) -> DataFrame:
    """(a, b): pairs of distinct fingerprints (column fp, as signed 64-bit integers) within the error budget."""
    masks = F.array(*[F.lit(signed(m)) for m in MASKS])
    dealt = distinct.select("fp", F.posexplode(masks).alias("key", "mask")).select(
        "fp", "key", F.col("fp").bitwiseAND(F.col("mask")).alias("fixed")
    )
    known = np.array(MASKS, dtype=np.uint64)

    def rows(batches: Iterator[dict]) -> Iterable[tuple]:
        key, fixed, fp = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            new = [np.array(batch[c], dtype=np.int64) for c in ("key", "fixed", "fp")]
            key, fixed, fp = (np.concatenate(x) for x in zip((key, fixed, fp), new))
            last = np.flatnonzero((key != key[-1]) | (fixed != fixed[-1]))
            cut = last[-1] + 1 if len(last) else 0  # the last group may go on in the next batch
            yield from found(key[:cut], fixed[:cut], fp[:cut])
            key, fixed, fp = key[cut:], fixed[cut:], fp[cut:]
        yield from found(key, fixed, fp)

    def found(key: np.ndarray, fixed: np.ndarray, fp: np.ndarray) -> Iterable[tuple]:
        if not len(fp):
            return
        new = np.concatenate([[False], (key[1:] != key[:-1]) | (fixed[1:] != fixed[:-1])])
        group = np.cumsum(new)
        values = fp.view(np.uint64)
        order = np.lexsort((values, group))
        values, group, key, fp = values[order], group[order], key[order], fp[order]
        for a, b in near_pairs(values, group):
            # a pair meets under several selections: the first of them tells it
            agree = ((values[a] ^ values[b])[:, None] & known[None, :]) == 0
            first = agree.argmax(axis=1) == key[a]
            yield from zip(fp[a[first]].tolist(), fp[b[first]].tolist())

    ordered = dealt.repartition("key", "fixed").sortWithinPartitions("key", "fixed")
    return map_rows(ordered.select("key", "fixed", "fp"), rows, "a bigint, b bigint")


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_hash and fp (signed) of every row; null texts are empty, rows are taken one by one."""

    def rows(batches: Iterator[dict]) -> Iterable[tuple]:
        for batch in batches:
            for doc, of, text in zip(batch["doc_id"], batch["text_hash"], batch["text"], strict=True):
                yield doc, of, signed(fingerprint(text, width))

    text = F.coalesce("text", F.lit("")).alias("text")
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text)
    return map_rows(source, rows, "doc_id bigint, text_hash bigint, fp bigint")


def fingerprint_groups(marked: DataFrame) -> DataFrame:
    """(fp, part): every distinct fingerprint of ``marked`` and the least one that can be reached over links."""
    distinct = marked.select("fp").distinct()
    parts = written(components(link_fingerprints(distinct)), "components")
    return distinct.join(parts, distinct.fp == parts.node, "left").select("fp", F.coalesce("component", "fp").alias("part"))


def near_groups(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least doc_id reachable over links of at most
    ``BUDGET`` differing bits; one row per row of ``docs``.

    Reads doc_id and text, other columns are passed over. Null and blank texts have fingerprint zero and are linked like
    any other. Rows with equal ids are kept, each with its own fingerprint; a row without an id is part of the links
    but names no component: one of such rows alone has none.
    """
    marked = written(fingerprints(docs, width), "fingerprints")
    least_of = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = fingerprint_groups(marked).join(least_of, "fp")
    least = named.groupBy("part").agg(F.min("least").alias("component_id"))
    # a fingerprint that a third of the rows share is met in 16 places
    found = named.join(least, "part").select("fp", "component_id", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    salted = marked.withColumn("salt", F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(16)))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return salted.join(found, ["fp", "salt"]).select("doc_id", hexed, "component_id")


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the least doc_id (and, of equal ids, the least
    hash of the text) stays, with all its columns. Rows without an id come last; of rows equal in id and text one stays.
    """
    marked = written(fingerprints(docs, width), "fingerprints")
    last = F.lit((1 << 63) - 1)
    least_of = marked.groupBy("fp").agg(F.min(F.struct(F.coalesce("doc_id", last).alias("__id"), F.col("text_hash").alias("__hash"))).alias("row"))
    stay = fingerprint_groups(marked).join(least_of, "fp").groupBy("part").agg(F.min("row").alias("row")).select("row.*")
    return kept_rows(docs, stay)


def kept_rows(docs: DataFrame, stay: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (__id, __hash) of ``stay``: doc_id, null as the greatest number, and hash of the text."""
    last = F.lit((1 << 63) - 1)
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), last).alias("__id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("__hash"), F.struct("*").alias("__row")
    )
    kept = keyed.join(stay, ["__id", "__hash"], "left_semi")
    return kept.groupBy("__id", "__hash").agg(F.first("__row").alias("__row")).select("__row.*")
