"""Removal of repeated byte strings across documents, by longest-previous-factor arrays in parallel.

A byte goes if a string of ``LENGTH`` bytes over it also starts in a document with a smaller id. Every window of that
length has one anchor, the least hash of its k-grams, so equal windows have equal anchors:

1. Texts are put into blobs of a few megabytes, and a blob's distinct anchors are sent, as hashes, to buckets that find
   those found in more than one document. One bit per anchor comes back; windows without a shared anchor are done.
2. The windows in a row that have one anchor cover a stretch of text. The hashes of the stretches around shared anchors
   are sent, each distinct one once per blob; back come the first document that has the stretch and whether other
   stretches have the same anchor. If none has, that document is the first of all the stretch's windows.
3. The others, where copies begin, end or differ, are sent as text, by the blob of the first document. A bucket puts
   all their windows into suffix order (prefix doubling, up to ``LENGTH`` bytes) and takes the previous and next
   smaller document in that order: the longest previous factor reaches ``LENGTH`` where either is equal so far. The
   first document of each window comes back.
4. Every blob marks the bytes of windows whose first document has a smaller id.

The number of buckets follows the size of the input. An anchor found in very many blobs has its windows hashed and
spread one by one. No document is compared with another, and no step holds more than a bucket or a blob; hashes have 64
bits, and two of them, the anchor's and the stretch's, have to agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameledger.llm.common import map_rows, written
from nameledger.llm.rolling import BASE, kgrams_of, mixed, powers, prefix_sums, sliding_min

LENGTH = 50
K = 24
BLOB_BYTES = 2 << 20
#: Windows looked at in one piece of a very long text.
SLICE = 1 << 20
#: Text bytes behind one bucket, and blobs beyond which an anchor's windows are spread.
BUCKET_BYTES = 2 << 20
MANY_BLOBS = 256
ROWS_AT_ONCE = 64
#: The kind of row that holds a blob; it stands after all answers to it.
BLOB = 9
NO_ID = (1 << 63) - 1

SENT = "`to` bigint, sender bigint, kind int, payload binary"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def packed(ids: list, texts: list[bytes]) -> bytes:
    head = np.array([len(ids), *[NO_ID if i is None else i for i in ids], *[i is None for i in ids], *map(len, texts)], dtype="<i8")
    data = head.tobytes() + b"".join(texts)
    return len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Ids (the greatest where there is none), whether there is none, and texts."""
    data = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    head = np.frombuffer(data, "<i8", 1 + 3 * n)
    ends = head[1 + 2 * n :].cumsum() + 8 * (1 + 3 * n)
    return head[1 : 1 + n], head[1 + n : 1 + 2 * n] > 0, [data[e - s : e] for e, s in zip(ends.tolist(), head[1 + 2 * n :].tolist(), strict=True)]


def to_blobs(docs: DataFrame) -> DataFrame:
    """sender, n_bytes and blob: the documents of a task, some megabytes at a time; written, so that it stays as it is."""

    def rows(batches: Iterator[dict]) -> Iterable[tuple]:
        sender, ids, texts, size = TaskContext.get().partitionId() << 40, [], [], 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                ids.append(doc)
                texts.append(data)
                size += len(data)
                if size >= BLOB_BYTES:
                    yield sender, size, packed(ids, texts)
                    sender, ids, texts, size = sender + 1, [], [], 0
        if ids:
            yield sender, size, packed(ids, texts)

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return written(map_rows(source, rows, "sender bigint, n_bytes bigint, blob binary"), "blobs")


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from starts to ends, whatever stands before them."""
    return mixed((sums[ends] - sums[starts]) * powers(BASE, len(sums))[starts] + (ends - starts).astype(np.uint64))


def anchored(text: bytes, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: first window, last window, the anchor's hash and the stretch's."""
    found = [[np.zeros(0, t)] for t in (np.int64, np.int64, np.uint64, np.uint64)]
    values = np.frombuffer(text, np.uint8)
    for at in range(0, len(text) - length + 1, SLICE):
        sums = prefix_sums(values[at : at + SLICE + length - 1])
        grams = kgrams_of(sums, k)
        keys = (grams & ~np.uint64(0xFFFFFFFF)) | (np.uint64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64))
        place = (np.uint64(0xFFFFFFFF) - (sliding_min(keys, length - k + 1) & np.uint64(0xFFFFFFFF))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [len(place)]]) - 1
        for part, new in zip(found, (first + at, last + at, grams[place[first]], stretch_hashes(sums, first, last + length)), strict=True):
            part.append(new)
    return tuple(np.concatenate(x) for x in found)


def windows_of(text: bytes, first: int, last: int) -> np.ndarray:
    """The hash of each window by itself."""
    starts = np.arange(last - first + 1)
    return stretch_hashes(prefix_sums(np.frombuffer(text[first : last + LENGTH], np.uint8)), starts, starts + LENGTH)


class Anchors:
    """A blob's runs, and its distinct anchors by bucket, always in the same order."""

    def __init__(self, blob: bytes, bits: int):
        self.ids, self.missing, self.texts = unpacked(blob)
        runs = [anchored(t) for t in self.texts]
        self.starts, self.ends, self.hashes, self.stretch = (np.concatenate(x) for x in zip(*runs, strict=True))
        self.doc = np.repeat(np.arange(len(runs)), [len(r[0]) for r in runs])
        self.distinct, self.at = np.unique(self.hashes, return_inverse=True)
        some = np.zeros(len(self.distinct), np.int64)
        some[self.at] = self.doc
        # found in two documents of this blob
        self.several = np.bincount(self.at, weights=self.doc != some[self.at], minlength=len(self.distinct)) > 0
        self.bucket = (self.distinct >> np.uint64(64 - bits)).astype(np.int64)  # ascending, as the hashes are
        self.bits = bits

    def by_bucket(self) -> Iterator[tuple[int, slice]]:
        if len(self.bucket):
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(self.bucket)) + 1, [len(self.bucket)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield int(self.bucket[a]), slice(a, b)

    def flags(self, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct anchor: whether it is shared, and whether by very many blobs."""
        both = np.zeros((2, len(self.distinct)), dtype=bool)
        for bucket, part in self.by_bucket():
            n = part.stop - part.start
            both[:, part] = np.unpackbits(np.frombuffer(answers[bucket], np.uint8), count=2 * n).reshape(2, n)
        return both[0], both[1]

    def shared_stretches(self, answers: dict[int, bytes]) -> "Stretches":
        """All stretches with a shared anchor, in order; those of an anchor in very many blobs window by window."""
        shared, spread = self.flags(answers)
        use = np.flatnonzero(shared[self.at])
        alone = spread[self.at[use]]
        parts = [(self.doc[use], self.starts[use], self.ends[use], self.hashes[use], self.stretch[use], self.stretch[use] & np.uint64(0))]
        parts = [tuple(x[~alone] for x in parts[0])]
        for i in use[alone].tolist():
            first, last = int(self.starts[i]), int(self.ends[i])
            each = np.arange(first, last + 1)
            own = windows_of(self.texts[self.doc[i]], first, last)
            parts.append((np.full(len(each), self.doc[i]), each, each, np.full(len(each), self.hashes[i]), own, np.ones(len(each), np.uint64)))
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        order = np.lexsort((columns[1], columns[0]))
        return Stretches(self, *(c[order] for c in columns))


class Stretches:
    """Where a blob's stretches stand (document, first and last window), and the distinct ones by bucket.

    A single window of a much shared anchor goes to the bucket of its own hash, which also stands in for its anchor.
    """

    def __init__(self, anchors: Anchors, doc, start, end, anchor, stretch, single):
        self.anchors, self.doc, self.start, self.end = anchors, doc, start, end
        route = np.where(single > 0, stretch, anchor)
        route_bucket = (route >> np.uint64(64 - anchors.bits)).astype(np.int64)
        order = np.lexsort((stretch, route_bucket))
        b, s, a = route_bucket[order], stretch[order], anchor[order]
        new = np.concatenate([[True], (b[1:] != b[:-1]) | (s[1:] != s[:-1]) | (a[1:] != a[:-1])]) if len(order) else np.zeros(0, bool)
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        self.bucket, self.stretch, self.single = b[first], s[first], single[order][first]
        # a single window has an anchor of its own here, so that it never counts as one of several stretches
        self.anchor = np.where(self.single > 0, mixed(a[first] ^ self.stretch), a[first])
        ids = anchors.ids[doc]
        self.least = np.minimum.reduceat(ids[order], first) if len(first) else np.zeros(0, np.int64)
        self.example = order[first]

    def by_bucket(self) -> Iterator[tuple[int, slice]]:
        if len(self.bucket):
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(self.bucket)) + 1, [len(self.bucket)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield int(self.bucket[a]), slice(a, b)

    def questions(self) -> Iterator[tuple[int, bytes]]:
        for bucket, part in self.by_bucket():
            yield bucket, b"".join([self.anchor[part].tobytes(), self.stretch[part].tobytes(), self.least[part].tobytes()])

    def told(self, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each distinct stretch: the first document that has it, and whether its anchor has others."""
        first, several = np.zeros(len(self.bucket), np.int64), np.zeros(len(self.bucket), bool)
        for bucket, part in self.by_bucket():
            n = part.stop - part.start
            first[part] = np.frombuffer(answers[bucket], "<i8", n)
            several[part] = np.frombuffer(answers[bucket], np.uint8, n, 8 * n) > 0
        return first, several

    def text(self, i: int) -> bytes:
        at = self.example[i]
        return self.anchors.texts[self.doc[at]][self.start[at] : self.end[at] + LENGTH]

    def open_ones(self, several: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        for bucket, part in self.by_bucket():
            if len(found := np.flatnonzero(several[part])):
                yield bucket, (found + part.start).tolist()


def short_hashes(distinct: np.ndarray, several: np.ndarray, bits: int) -> bytes:
    """48 bits of each hash below the bucket's, the lowest of them telling of several documents."""
    values = ((distinct << np.uint64(bits)) >> np.uint64(16)) & ~np.uint64(1) | several.astype(np.uint64)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def shared_anchors(parts: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """For each blob's hashes in one bucket, which are shared and which by very many blobs, as bits."""
    sizes = [len(p) // 6 for _, p in parts]
    raw = np.zeros((sum(sizes), 8), np.uint8)
    raw[:, :6] = np.frombuffer(b"".join(p for _, p in parts), np.uint8).reshape(-1, 6)
    values = raw.view("<u8")[:, 0]
    _, at, counts = np.unique(values >> np.uint64(1), return_inverse=True, return_counts=True)
    several = np.bincount(at, weights=values & np.uint64(1)) > 0
    flags = np.stack([((counts > 1) | several)[at], (counts > MANY_BLOBS)[at]])
    begin = 0
    for (sender, _), size in zip(parts, sizes, strict=True):
        yield sender, np.packbits(flags[:, begin : begin + size]).tobytes()
        begin += size


def window_ranks(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The rank of each window in suffix order, up to ``length`` bytes: equal windows have equal ranks.

    Prefix doubling: the rank of twice as many bytes is that of the pair of ranks of its halves; the last step takes
    two halves that overlap.
    """
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
    n = len(data)
    rank = np.zeros(n + length, np.uint64)
    for i in range(8):
        rank = (rank << np.uint64(8)) | padded[i : i + n + length]
    rank = np.unique(rank, return_inverse=True)[1].astype(np.uint64)
    width = 8
    while width < length:
        step = min(width, length - width)
        last = width + step >= length
        at = starts if last else np.arange(len(rank) - step)
        rank = np.unique((rank[at] << np.uint64(32)) | rank[at + step], return_inverse=True)[1].astype(np.uint64)
        width += step
    return rank.astype(np.int64)


def nearest_smaller(docs: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The nearest place before each with a smaller document in the same run, or -1 (next ones: on the reverse).

    Everything between a place and its pointer is at least as great, so a pointer may follow the one it points to.
    """
    before = np.arange(len(docs)) - 1
    open_ones = np.arange(len(docs))
    while len(open_ones):
        to = before[open_ones]
        outside = (to < 0) | (run[to] != run[open_ones])
        before[open_ones[outside]] = -1
        open_ones = open_ones[~outside]
        open_ones = open_ones[docs[before[open_ones]] >= docs[open_ones]]
        before[open_ones] = before[before[open_ones]]
    return before


def first_documents(stretches: list[bytes], docs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each stretch (with the least document that has it), runs of its windows: how many, and their first document.

    A window's longest previous factor reaches the whole length where a smaller document stands before or after it
    in suffix order with nothing but equal windows between; the run's least document is the first of all.
    """
    counts = np.array([len(s) - LENGTH + 1 for s in stretches], dtype=np.int64)
    ends = np.cumsum([len(s) for s in stretches])
    owner = np.repeat(np.arange(len(stretches)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = within + np.repeat(ends - np.array([len(s) for s in stretches]), counts)
    rank = window_ranks(np.frombuffer(b"".join(stretches), np.uint8), starts)
    order = np.argsort(rank, kind="stable")
    run, own = rank[order], docs[owner[order]]
    before = nearest_smaller(own, run)
    after = nearest_smaller(own[::-1], run[::-1])[::-1]
    has_earlier = (before >= 0) | (after >= 0)
    heads = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    least = np.repeat(np.minimum.reduceat(own, heads), np.diff(np.concatenate([heads, [len(run)]])))
    first = np.empty(len(own), np.int64)
    first[order] = np.where(has_earlier, least, own)
    changes = np.concatenate([[True], (first[1:] != first[:-1]) | (owner[1:] != owner[:-1])])
    at = np.flatnonzero(changes)
    length = np.diff(np.concatenate([at, [len(first)]]))
    of = owner[at]
    cuts = np.searchsorted(of, np.arange(len(stretches) + 1))
    return [(length[a:b], first[at[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def answer_hashes(parts: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """For each blob's stretch hashes in one bucket: the first document of each, and whether its anchor has others."""
    sizes = [len(p) // 24 for _, p in parts]
    anchor, stretch, least = (
        np.concatenate([np.frombuffer(p, kind, n, 8 * n * i) for (_, p), n in zip(parts, sizes, strict=True)])
        for i, kind in enumerate(("<u8", "<u8", "<i8"))
    )
    order = np.lexsort((stretch, anchor))
    a, s = anchor[order], stretch[order]
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    new = new_anchor | np.concatenate([[True], s[1:] != s[:-1]])
    heads, group = np.flatnonzero(new), np.cumsum(new) - 1
    first = np.minimum.reduceat(least[order], heads)
    of_anchor = np.cumsum(new_anchor) - 1
    several = np.bincount(of_anchor[heads]) > 1
    out_first, out_several = np.empty(len(order), "<i8"), np.empty(len(order), np.uint8)
    out_first[order], out_several[order] = first[group], several[of_anchor]
    begin = 0
    for (sender, _), n in zip(parts, sizes, strict=True):
        yield sender, out_first[begin : begin + n].tobytes() + out_several[begin : begin + n].tobytes()
        begin += n


def text_payload(stretches: Stretches, which: list[int], first: np.ndarray) -> bytes:
    """Open stretches: their hashes, first documents and sizes, and the text of those that start in this blob."""
    texts = [stretches.text(i) if stretches.least[i] == first[i] else b"" for i in which]
    head = np.array([len(which), *first[which].tolist(), *map(len, texts)], dtype="<i8")
    return head.tobytes() + stretches.stretch[which].tobytes() + b"".join(texts)


def answer_texts(parts: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
    """Each blob's open stretches in one bucket, in their order: the number of runs, then their sizes and documents."""
    asked: list[tuple[int, list[int]]] = []
    known: dict[int, tuple[bytes, int]] = {}
    for sender, payload in parts:
        n = int(np.frombuffer(payload, "<i8", 1)[0])
        head = np.frombuffer(payload, "<i8", 1 + 2 * n)
        hashes = np.frombuffer(payload, "<u8", n, 8 * (1 + 2 * n)).tolist()
        at = 8 * (1 + 3 * n)
        for h, doc, size in zip(hashes, head[1 : 1 + n].tolist(), head[1 + n :].tolist(), strict=True):
            if size:
                known[h] = payload[at : at + size], doc
                at += size
        asked.append((sender, hashes))
    found = dict(zip(known, first_documents([t for t, _ in known.values()], np.array([d for _, d in known.values()], dtype=np.int64)), strict=True))
    for sender, hashes in asked:
        runs = [found[h] for h in hashes]
        counts = np.array([len(r[0]) for r in runs], dtype="<i8")
        yield sender, b"".join([counts.tobytes(), *(x.astype("<i8").tobytes() for r in runs for x in r)])


def removed_spans(stretches: Stretches, told: dict[int, bytes], answers: dict[int, bytes]) -> list[list[list[int]]]:
    """Each document's removed stretches of bytes, apart from each other and in order."""
    first, several = stretches.told(told)
    runs: dict[int, tuple[list[int], list[int]]] = {}
    for bucket, which in stretches.open_ones(several):
        data = np.frombuffer(answers[bucket], "<i8").tolist()
        at = len(which)
        for i, n in zip(which, data[: len(which)], strict=True):
            runs[i] = data[at : at + n], data[at + n : at + 2 * n]
            at += 2 * n
    ids = stretches.anchors.ids
    closed = ~several[stretches.at]
    hit = closed & (first[stretches.at] < ids[stretches.doc])
    docs, begins, ends = [stretches.doc[hit]], [stretches.start[hit]], [stretches.end[hit] + LENGTH]
    more: list[tuple[int, int, int]] = []
    for i in np.flatnonzero(~closed).tolist():
        doc, start = int(stretches.doc[i]), int(stretches.start[i])
        for size, earliest in zip(*runs[int(stretches.at[i])], strict=True):
            if earliest < ids[doc]:
                more.append((doc, start, start + size + LENGTH - 1))
            start += size
    extra = np.array(more, dtype=np.int64).reshape(-1, 3)
    doc, begin, end = (np.concatenate([x[0], extra[:, i]]) for i, x in enumerate((docs, begins, ends)))
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    spans: list[list[list[int]]] = [[] for _ in stretches.anchors.texts]
    if len(doc):  # later windows end later, so the one before tells whether a span goes on
        heads = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (begin[1:] > end[:-1])]))
        tails = np.concatenate([heads[1:], [len(doc)]]) - 1
        for d, a, b in zip(doc[heads].tolist(), begin[heads].tolist(), end[tails].tolist(), strict=True):
            spans[d].append([a, b])
    return spans


def grouped(batches: Iterator[dict]) -> Iterator[tuple[int, Iterator[tuple[int, int, bytes]]]]:
    """Rows that stand together by receiver: (receiver, [(kind, sender, payload)])."""
    rows = (x for b in batches for x in zip(b["to"], b["kind"], b["sender"], b["payload"], strict=True))
    to, held = None, []
    for receiver, *row in rows:
        if held and receiver != to:
            yield to, held
            held = []
        to = receiver
        held.append(tuple(row))
    if held:
        yield to, held


def said(rows: list[tuple[int, int, bytes]], kind: int) -> dict[int, bytes]:
    return {bucket: payload for k, bucket, payload in rows if k == kind}


def delivered(sent: DataFrame) -> DataFrame:
    return sent.repartition("to").sortWithinPartitions("to", "kind", "sender")


def remove_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; with ``texts`` also kept, the bytes left.

    Reads doc_id and text, other columns are passed over; null texts are empty. Strings are judged on the input, in
    UTF-8, and never cross documents. Rows with equal ids do not count as earlier than each other; rows without an id
    come after all others.
    """
    blobs = to_blobs(docs)
    total = blobs.agg(F.sum("n_bytes")).first()[0] or 0
    bits = max(1, (total // BUCKET_BYTES).bit_length())

    def ask_anchors(batches: Iterator[dict]) -> Iterable[tuple]:
        for batch in batches:
            for sender, blob in zip(batch["sender"], batch["blob"], strict=True):
                anchors = Anchors(blob, bits)
                for bucket, part in anchors.by_bucket():
                    yield bucket, sender, 0, short_hashes(anchors.distinct[part], anchors.several[part], bits)

    def tell_anchors(batches: Iterator[dict]) -> Iterable[tuple]:
        for bucket, rows in grouped(batches):
            for sender, bits_of in shared_anchors([(s, p) for _, s, p in rows]):
                yield sender, bucket, 0, bits_of

    def ask_stretches(batches: Iterator[dict]) -> Iterable[tuple]:
        for sender, rows in grouped(batches):
            stretches = Anchors(rows[-1][2], bits).shared_stretches(said(rows, 0))
            for bucket, payload in stretches.questions():
                yield bucket, sender, 0, payload

    def tell_stretches(batches: Iterator[dict]) -> Iterable[tuple]:
        for bucket, rows in grouped(batches):
            for sender, payload in answer_hashes([(s, p) for _, s, p in rows]):
                yield sender, bucket, 1, payload

    def ask_texts(batches: Iterator[dict]) -> Iterable[tuple]:
        for sender, rows in grouped(batches):
            stretches = Anchors(rows[-1][2], bits).shared_stretches(said(rows, 0))
            first, several = stretches.told(said(rows, 1))
            for bucket, which in stretches.open_ones(several):
                yield bucket, sender, 0, text_payload(stretches, which, first)

    def tell_texts(batches: Iterator[dict]) -> Iterable[tuple]:
        for bucket, rows in grouped(batches):
            for sender, payload in answer_texts([(s, p) for _, s, p in rows]):
                yield sender, bucket, 2, payload

    def finish(batches: Iterator[dict]) -> Iterable[tuple]:
        for _, rows in grouped(batches):
            anchors = Anchors(rows[-1][2], bits)
            spans_of = removed_spans(anchors.shared_stretches(said(rows, 0)), said(rows, 1), said(rows, 2))
            for doc, missing, text, spans in zip(anchors.ids.tolist(), anchors.missing, anchors.texts, spans_of, strict=True):
                edges = [0, *(x for span in spans for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                row = None if missing else doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()
                yield (*row, kept) if texts else row

    whole = blobs.select(F.col("sender").alias("to"), F.lit(0).cast("bigint").alias("sender"), F.lit(BLOB).alias("kind"), F.col("blob").alias("payload"))

    def step(sent: DataFrame, rows: Callable[[Iterator[dict]], Iterable[tuple]]) -> DataFrame:
        return map_rows(delivered(sent), rows, SENT, ROWS_AT_ONCE)

    asked = map_rows(blobs.select("sender", "blob"), ask_anchors, SENT, ROWS_AT_ONCE)
    # few rows at a time on the way to the Python workers too: else a task's blobs and answers all stand in one batch
    shared = written(step(asked, tell_anchors), "shared-anchors", ROWS_AT_ONCE).unionByName(whole)
    told = written(step(step(shared, ask_stretches), tell_stretches), "first-documents", ROWS_AT_ONCE).unionByName(shared)
    answers = written(step(step(told, ask_texts), tell_texts), "window-documents", ROWS_AT_ONCE).unionByName(told)
    schema = f"{RESULT}, kept binary" if texts else RESULT
    return written(map_rows(delivered(answers), finish, schema, ROWS_AT_ONCE), "without-repeats", ROWS_AT_ONCE)
