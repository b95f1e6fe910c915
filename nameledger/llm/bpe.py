"""Byte-level BPE encoding by overlapping chunks, and decoding.

A long text is cut into chunks that overlap, which are pre-tokenised in parallel, wherever they fall. The
pre-token pattern looks only forward, so two scans that share one start agree from there on: neighbouring chunks
are stitched at the first start both have in their overlap, clear of the first chunk's end. Where a single run
is longer than the overlap, the chunks are joined and scanned again from the last sure start. The pieces between
the stitched starts are then encoded by rank. A text of one chunk needs no stitching and is not moved at all.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameledger.llm.common import map_rows

CHUNK = 32_768
OVERLAP = 1_024
#: A start so near a chunk's end may depend on what follows; the pattern looks at most three characters ahead.
MARGIN = 8
CACHED_PIECES = 500_000

ENCODED = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class PieceIds(dict):
    """The ids, as bytes, of each pre-token; kept between batches up to a bound."""

    def __init__(self, ranks_file: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks_file, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.model = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)

    def __missing__(self, piece: str) -> bytes:
        found = self.ranks.get(piece.encode())
        ids = array("I", [found] if found is not None else self.model._encode_single_piece(piece)).tobytes()
        self[piece] = ids
        return ids

    def encode(self, pieces: Iterable[str]) -> bytes:
        if len(self) > CACHED_PIECES:
            self.clear()
        return b"".join(map(self.__getitem__, pieces))

    def decode(self, ids: bytes) -> bytes:
        """The raw bytes of the tokens, one after the other."""
        return b"".join(map(self.tokens.__getitem__, array("I", ids)))


_piece_ids: dict[tuple[str, str], PieceIds] = {}


def piece_ids(ranks_file: str, pattern: str) -> PieceIds:
    key = (ranks_file, pattern)
    if key not in _piece_ids:
        _piece_ids[key] = PieceIds(*key)
    return _piece_ids[key]


def starts_of(model: PieceIds, text: str) -> list[int]:
    return [m.start() for m in model.pattern.finditer(text)]


def stitched(model: PieceIds, chunks: Iterable[tuple[int, str, list[int]]]) -> Iterator[list[str]]:
    """The pieces of one text, chunk by chunk: (begin, text with its overlap, starts counted from the text's begin)."""
    begin, text, starts = 0, "", []
    for at, more, found in chunks:
        if not text:
            begin, text, starts = at, more, found
            continue
        low, high = bisect_left(starts, at), bisect_left(starts, begin + len(text) - MARGIN)
        seam = next((s for s in starts[low:high] if (i := bisect_left(found, s)) < len(found) and found[i] == s), None)
        if seam is None:
            sure = starts[max(0, low - 1)] if starts[0] < at else starts[0]
            yield [text[a - begin : b - begin] for a, b in zip(starts, starts[1:]) if b <= sure]
            text = text[sure - begin : at - begin] + more
            begin = sure
            # a run that fills the whole chunk brings no start: it is scanned when its end comes
            starts = [sure] if len(found) == 1 else [sure + s for s in starts_of(model, text)]
            continue
        own = starts[: bisect_left(starts, seam)] + [seam]
        yield [text[a - begin : b - begin] for a, b in zip(own, own[1:])]
        begin, text, starts = at, more, found[bisect_left(found, seam) :]
    if text:
        if len(starts) == 1:
            starts = [starts[0] + s for s in starts_of(model, text[starts[0] - begin :])]
        yield [text[a - begin : b - begin] for a, b in zip(starts, [*starts[1:], begin + len(text)])]


def digests(model: PieceIds, parts: Iterable[list[str]]) -> tuple[int, str, str]:
    n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
    for pieces in parts:
        ids = model.encode(pieces)
        n += len(ids) // 4
        ids_hash.update(ids)
        text_hash.update(model.decode(ids))
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


def encode_documents(
    docs: DataFrame, ranks_file: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """Encodes every whole text and decodes it again.

    Reads doc_id and text, other columns are passed over; null and empty texts have no tokens; every row is encoded
    for itself, also rows with equal or null ids. Returns per row: doc_id, n_tokens, ids_sha256 (ids as
    little-endian unsigned 32-bit integers) and decoded_sha256. Only texts over one chunk are shuffled, chunk by
    chunk; memory holds a chunk and the run that crosses its end.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    is_long = F.length("text") > chunk + overlap

    def whole(batches: Iterator[dict]) -> Iterable[tuple]:
        model = piece_ids(ranks_file, pattern)
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                yield doc, *digests(model, [model.pattern.findall(text)])

    def cut(batches: Iterator[dict]) -> Iterable[tuple]:
        for batch in batches:
            for doc, text, row in zip(batch["doc_id"], batch["text"], batch["row"], strict=True):
                for at in range(0, max(1, len(text) - overlap), chunk):
                    yield doc, row, at, text[at : at + chunk + overlap]

    def scan(batches: Iterator[dict]) -> Iterable[tuple]:
        model = piece_ids(ranks_file, pattern)
        for batch in batches:
            for doc, row, at, text in zip(batch["doc_id"], batch["row"], batch["at"], batch["text"], strict=True):
                yield doc, row, at, text, np.array(starts_of(model, text), dtype="<i4").tobytes()

    def stitch(batches: Iterator[dict]) -> Iterable[tuple]:
        model = piece_ids(ranks_file, pattern)
        rows = (
            x for b in batches for x in zip(b["row"], b["doc_id"], b["at"], b["text"], b["starts"], strict=True)
        )
        ahead = next(rows, None)

        def chunks_of(row: int) -> Iterator[tuple[int, str, list[int]]]:
            nonlocal ahead
            while ahead is not None and ahead[0] == row:
                _, _, at, text, starts = ahead
                yield at, text, (np.frombuffer(starts, dtype="<i4").astype(np.int64) + at).tolist()
                ahead = next(rows, None)

        while ahead is not None:
            row, doc = ahead[:2]
            yield doc, *digests(model, stitched(model, chunks_of(row)))

    chunk_schema = "doc_id bigint, row bigint, at bigint, text string"
    chunks = map_rows(source.where(is_long), cut, chunk_schema).repartition("row", "at")
    scanned = map_rows(chunks, scan, f"{chunk_schema}, starts binary")
    ordered = scanned.repartition("row").sortWithinPartitions("row", "at")
    short = map_rows(source.where(~is_long).drop("row"), whole, ENCODED)
    return short.unionByName(map_rows(ordered, stitch, ENCODED))
