"""Packing of tokenised documents into windows of equal capacity.

Karmarkar-Karp multiway differencing: the two partial partitions with the largest imbalance are merged so
that the fullest window of one meets the emptiest of the other, until one partition is left. Its windows are
nearly equal; if one exceeds the capacity, the number of windows rises and the differencing is done again.

Work is one pass over the documents, with no shuffle: each task packs blocks of at most ``BLOCK`` document
ends. Whole windows of a long document stand alone. A share of the documents is kept back and cut to fill up
what the differencing left free; what remains at a block's end goes to windows of a power of two, which need
no padding. Nothing is dropped, and memory holds one block, whatever the size of the input.
"""

from __future__ import annotations

import heapq
import os
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameledger.llm.common import map_rows

CAPACITY = 2048
END_ID = 1
BLOCK = 1024
FILLER = 1 / 16
CACHED_WORDS = 1_000_000

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, sequence_length bigint"
)


def differencing(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item after Karmarkar-Karp differencing into ``windows`` windows."""
    parent = np.arange(len(lengths))
    heap = [(-int(n), i, np.array([n], dtype=np.int64), np.array([i])) for i, n in enumerate(lengths)]
    if windows == 1 or not heap:
        return np.zeros(len(lengths), dtype=np.int64)
    heapq.heapify(heap)
    tick = len(heap)
    while len(heap) > 1:
        _, _, a, slots_a = heapq.heappop(heap)
        _, _, b, slots_b = heapq.heappop(heap)
        shared = len(a) + len(b) - windows
        if shared > 0:  # the emptiest windows of one take the fullest of the other
            parent[slots_b[-shared:][::-1]] = slots_a[-shared:]
            a = a.copy()
            a[-shared:] += b[-shared:][::-1]
            b, slots_b = b[:-shared], slots_b[:-shared]
        sums, slots = np.concatenate([a, b]), np.concatenate([slots_a, slots_b])
        order = np.argsort(-sums, kind="stable")
        sums, slots = sums[order], slots[order]
        if len(sums) == windows:
            sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), tick, sums, slots))
        tick += 1
    while (up := parent[parent]).tolist() != parent.tolist():
        parent = up
    return np.unique(parent, return_inverse=True)[1].astype(np.int64)


def balanced(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Windows of at most ``capacity``: their number rises for as long as one of them is too full."""
    windows = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        of = differencing(lengths, windows)
        if len(of) == 0 or np.bincount(of, weights=lengths).max() <= capacity:
            return of, windows
        windows += max(1, windows // 100)


def plan_block(lengths: np.ndarray, capacity: int, filler: float) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (item, start, length); every item is cut into pieces that cover it once.

    Every ``1 / filler``-th item is kept back as filling; the share doubles until it fills all that is free.
    """
    step = max(1, round(1 / filler))
    while True:
        back = np.arange(len(lengths)) % step == step - 1 if step > 1 else np.ones(len(lengths), bool)
        whole = np.flatnonzero(~back)
        of, count = balanced(lengths[whole], capacity) if len(whole) else (np.zeros(0, np.int64), 0)
        if step == 1 or count * capacity - lengths[whole].sum() <= lengths[back].sum():
            break
        step //= 2
    windows: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    free = [capacity] * count
    for item, window in zip(whole.tolist(), of.tolist(), strict=True):
        windows[window].append((item, 0, int(lengths[item])))
        free[window] -= int(lengths[item])
    rest = int(lengths[back].sum()) - sum(free)  # goes to further windows, the last ones powers of two
    while rest > 0:
        size = capacity if rest >= capacity else 1 << (rest.bit_length() - 1)
        windows.append([])
        free.append(size)
        rest -= size
    pieces = ((item, int(lengths[item])) for item in np.flatnonzero(back).tolist())
    item, start, left = -1, 0, 0
    for window, room in enumerate(free):
        while room > 0:
            if left == 0:
                item, left = next(pieces, (-1, 0))
                start = 0
                if left == 0:
                    break
            n = min(room, left)
            windows[window].append((item, start, n))
            start, left, room = start + n, left - n, room - n
    return windows


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(others)}


class WordIds(dict):
    """The ids, as bytes, of each white-space-free stretch of text; kept between batches up to a bound.

    The tokenizer drops white space, so words can be encoded one by one. A word of Latin letters alone goes to
    the merge model at once; anything else takes the whole way through the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = byte_letters()

    def __missing__(self, word: str) -> bytes:
        if word.isalpha() and (word.isascii() or max(word) < "\u0250" and word.lower().isalpha()):
            if (low := word.lower()) != word:
                ids = self[low]
            else:
                found = self.merge(low if low.isascii() else "".join(map(self.letters.__getitem__, low.encode())))
                ids = array("I", [x.id for x in found]).tobytes()
        elif word == "":
            ids = b""
        elif word[-1] in ".," and (before := word[-2:-1]).isascii() and before.isalpha():
            ids = self[word[:-1]] + self[word[-1]]  # a letter and a mark are never one match
        else:
            ids = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        """The ids of a whole text."""
        if len(self) > CACHED_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_word_ids: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _word_ids:
        _word_ids[path] = WordIds(path)
    return _word_ids[path]


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, block: int = BLOCK, filler: float = FILLER
) -> DataFrame:
    """Cuts and packs all documents into sequences of at most ``capacity`` tokens.

    Reads doc_id and text, other columns are passed over. Null and empty texts become the end id alone; rows
    with equal or null ids are packed each for itself. One row per piece: the document, where the piece starts
    in it and how long it is, the CRC-32 of its ids, the sequence and the place in it, and how long that is.
    ``tokenizer`` is a file every executor has. Sequence ids are unique; they number a task's own sequences.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def rows(batches: Iterator[dict]) -> Iterable[tuple]:
        encoder = word_ids(tokenizer)
        sequence = TaskContext.get().partitionId() << 40
        held: list[tuple] = []  # (doc_id, start of the document's last part, its ids, tokens of the document)

        def packed() -> Iterable[tuple]:
            nonlocal sequence
            for window in plan_block(np.array([len(x[2]) // 4 for x in held], dtype=np.int64), capacity, filler):
                at, size = 0, sum(n for _, _, n in window)
                for item, start, n in window:
                    doc, base, ids, total = held[item]
                    crc = zlib.crc32(ids[4 * start : 4 * (start + n)])
                    yield doc, base + start, n, crc, total, sequence, at, size
                    at += n
                sequence += 1

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encoder.of(text or "") + end
                total = len(ids) // 4
                whole = total // capacity * capacity
                for start in range(0, whole, capacity):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + capacity)])
                    yield doc, start, capacity, crc, total, sequence, 0, capacity
                    sequence += 1
                if whole < total:
                    held.append((doc, whole, ids[4 * whole :], total))
                if len(held) >= block:
                    yield from packed()
                    held.clear()
        if held:
            yield from packed()

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), rows, PIECES)
