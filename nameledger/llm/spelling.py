"""Spelling variants: words that one insertion, deletion or replacement parts, grouped under the more frequent one.

Words are searched in blocks by a bit-sliced position index: for every position and letter a bitset of the block's
words that have it there. A query word goes through its letters once and carries four bitsets: the words equal so far,
and those with one replacement, with one letter more and with one letter less, read at the position itself, one behind
and one before. A step is a handful of operations on whole bitsets.

Blocks come from the pigeonhole: with a word in three pieces, one edit leaves two of them alone. Two words meet under
(length of the shorter, which pieces, these pieces' letters), and the first of at most three such places counts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameledger.llm.common import map_rows, written

RUN = re.compile("[a-zÀ-ÿ]+")
#: The least length and number of occurrences of a word, and how many times as frequent as a word its form is.
LEAST_LETTERS, LEAST_COUNT, TIMES = 5, 3, 2
#: One in so many runs loses a letter (``typed_runs``).
ONE_IN = 97
#: Different words a task counts before it gives them out, and words of an index. Larger blocks are cut; every word of
#: such a block asks all its pieces.
COUNTED_AT_ONCE, INDEX_WORDS = 200_000, 8_192
PIECES = 3


def run_counts(texts: DataFrame, damage: bool = False) -> DataFrame:
    """(word, n) of the letter runs of ``text``, A-Z lower-cased. With ``damage`` runs lose a letter by the checksum of doc_id and run.

    A null text has no runs; a null doc_id is empty. Tasks count what they read, and only counts are shuffled.
    """

    def rows(batches: Iterator[dict]) -> Iterator[tuple[str, int]]:
        counted: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                if text is None:
                    continue
                # bytes.lower changes ASCII letters alone
                runs = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
                if damage:
                    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for run in list(runs):
                        mark = zlib.crc32(run.encode(), start)
                        if mark % ONE_IN == 0:
                            at = mark % len(run)
                            counted[run[:at] + run[at + 1 :]] += runs.pop(run)
                counted.update(runs)
                if len(counted) >= COUNTED_AT_ONCE:
                    yield from counted.items()
                    counted.clear()
        yield from counted.items()

    found = map_rows(texts.select("doc_id", "text"), rows, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def keys_for(word: str, shorter: int) -> list[str]:
    """The blocks of a word for pairs whose shorter word has so many letters.

    The pieces in front and behind stand at the ends of either word; the edit is in the last, the middle or the first one.
    """
    n, first, middle = len(word), shorter // PIECES, 2 * shorter // PIECES
    rest = n - shorter
    letters = word[:middle], word[:first] + word[rest + middle :], word[rest + first :]
    return [f"{shorter}|{i}|{x}" for i, x in enumerate(letters)]


def piece_keys(word: str) -> list[str]:
    """All blocks of a word: it may be the shorter of a pair, or have a letter more than the other."""
    return [key for shorter in (len(word), len(word) - 1) if shorter >= 0 for key in keys_for(word, shorter)]


class PositionIndex:
    """Bitsets by (position, letter) over some words; bit i stands for word i."""

    def __init__(self, words: list[str]):
        size = (len(words) + 7) // 8
        bits: dict[tuple[int, str], bytearray] = {}
        lengths: dict[int, bytearray] = {}
        for i, word in enumerate(words):
            byte, bit = i >> 3, 1 << (i & 7)
            lengths.setdefault(len(word), bytearray(size))[byte] |= bit
            for key in enumerate(word):
                if key not in bits:
                    bits[key] = bytearray(size)
                bits[key][byte] |= bit
        self.words = words
        self.all = (1 << len(words)) - 1
        self.bits = {k: int.from_bytes(b, "little") for k, b in bits.items()}
        self.lengths = {k: int.from_bytes(b, "little") for k, b in lengths.items()}

    def near(self, word: str) -> list[int]:
        """Places of the words that exactly one edit parts from ``word``."""
        at = self.bits.get
        equal, replaced, longer, shorter = self.all, 0, 0, 0
        for i, letter in enumerate(word):
            here, behind = at((i, letter), 0), at((i + 1, letter), 0)
            before = at((i - 1, letter), 0)
            # a word with a letter more goes on one position behind, one with a letter less one before
            longer = (longer | equal) & behind
            shorter = (shorter & before) | equal
            replaced = (replaced & here) | (equal & ~here)
            equal &= here
            if not (equal or replaced or longer or shorter):
                return []
        n, of = len(word), self.lengths.get
        found = (replaced & of(n, 0)) | ((longer | equal) & of(n + 1, 0)) | (shorter & of(n - 1, 0))
        places = []
        while found:
            low = found & -found
            places.append(low.bit_length() - 1)
            found ^= low
        return places


def _answers(index: PositionIndex, counts: list[int], block: str, words: list[str]) -> Iterator[tuple]:
    shorter = int(block[: block.index("|")])
    for word in words:
        own, found, best = None, 0, None
        for place in index.near(word):
            other = index.words[place]
            if min(len(word), len(other)) != shorter:
                continue
            own = own or keys_for(word, shorter)
            if next(x for x, y in zip(own, keys_for(other, shorter), strict=True) if x == y) == block:
                found += 1
                offer = (-counts[place], other)
                best = offer if best is None else min(best, offer)
        if found:
            yield word, found, -best[0], best[1]


def _search(batches: Iterator[dict]) -> Iterator[tuple]:
    """Rows of one (block, part) after another, its own words first, then those that only ask.

    Out comes a row per block and asking word: its neighbours and the best of them.
    """
    now, words, counts, index = None, [], [], None
    for batch in batches:
        for block, part, own, word, n in zip(*[batch[c] for c in ("block", "part", "own", "word", "n")], strict=True):
            if (block, part) != now:
                if index is None and len(words) > 1:
                    yield from _answers(PositionIndex(words), counts, now[0], words)
                now, words, counts, index = (block, part), [], [], None
            if own:
                words.append(word)
                counts.append(n)
            else:
                if index is None:
                    index = PositionIndex(words)
                    yield from _answers(index, counts, block, words)
                yield from _answers(index, counts, block, [word])
    if index is None and len(words) > 1:
        yield from _answers(PositionIndex(words), counts, now[0], words)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near): how many words are near, and the most frequent of them (ties: least in code-point order).

    ``vocabulary`` has one row (word, n) per word. Each block is searched in a task; a pair counts in one block only, so
    a word's figures add up. No pairs are given out: a block yields a row per word with neighbours.
    """

    def rows(batches: Iterator[dict]) -> Iterator[tuple[str, str, int]]:
        for batch in batches:
            for word, n in zip(batch["word"], batch["n"], strict=True):
                for key in piece_keys(word):
                    yield key, word, n

    keyed = written(map_rows(vocabulary.select("word", "n"), rows, "block string, word string, n bigint"), "word-blocks")
    sizes = keyed.groupBy("block").agg(F.count("*").alias("size")).where("size > 1")
    placed = keyed.join(sizes, "block")
    # a word is in the index of one part; in a block of several it asks them all
    parts = F.ceil(F.col("size") / INDEX_WORDS).cast("int")
    home = F.pmod(F.xxhash64("word"), parts).cast("int")
    dealt = placed.select("block", "word", "n", home.alias("home"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    dealt = dealt.select("block", "part", (F.col("home") == F.col("part")).alias("own"), "word", "n")
    sorted_rows = dealt.repartition("block", "part").sortWithinPartitions("block", "part", F.desc("own"))
    found = map_rows(sorted_rows, _search, "word string, n_near bigint, near_n bigint, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("low"), F.col("near").alias("near")))
    grouped = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return grouped.select("word", "n_near", (-F.col("best.low")).alias("near_n"), F.col("best.near").alias("near"))


def with_roots(forms: DataFrame) -> DataFrame:
    """Adds ``root`` to (word, form, ...): the last word that forms lead to. Paths are doubled in length each round.

    A form is at least ``TIMES`` as frequent as its word, so no path has more than 63 steps.
    """
    links = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = written(moved, "forms")
        links = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return forms.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(counts: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of (word, n) that is long and frequent enough.

    Rows of one word are added up, null words and other columns are ignored. A word's form is the most frequent near
    word (ties: least in code-point order) if it is at least twice as frequent; a word without one is its own root.
    """
    added = counts.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    words = written(added.where((F.char_length("word") >= LEAST_LETTERS) & (F.col("n") >= LEAST_COUNT)), "vocabulary")
    told = words.join(near_words(words), "word", "left")
    follows = F.col("near_n") >= TIMES * F.col("n")
    told = told.select(
        "word",
        F.when(follows, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(follows, F.col("near_n")).alias("form_n"),
    )
    told = written(told, "word-forms")
    return with_roots(told).select("word", "form", "root", "n", "n_near", "form_n")
