"""Document fingerprints by winnowing, and how alike they are.

Every run of ``k`` code points gets a rolling hash; of each ``window`` consecutive hashes the least is kept, of
equal ones the rightmost, with its position. Two texts that share a stretch of ``k + window - 1`` code points
share a fingerprint there.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameledger.llm.common import map_rows
from nameledger.llm.rolling import kgram_hashes, sliding_min

K = 25
WINDOW = 26
#: Ranges of ids are finer than tasks, so that a task gets several and none much more than the others.
RANGES_PER_TASK = 4
LEAST_ID = -(1 << 63)

FINGERPRINTS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, positions array<int>"
)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """The kept hashes (32 bits) and their positions, in the order of the text.

    A text too short for one run of ``k`` is one run; too few runs for one window are one window. No text, no hash.
    """
    values = code_points(text)
    if not len(values):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    hashes = kgram_hashes(values, min(k, len(values))) >> np.uint64(32)
    place = np.arange(len(hashes), dtype=np.uint64)
    # the least key is the least hash, and of equal hashes the one furthest to the right
    keys = (hashes << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - place)
    least = sliding_min(keys, min(window, len(keys)))
    at = np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))
    first = np.concatenate([[True], at[1:] != at[:-1]])
    return (least[first] >> np.uint64(32)).astype(np.uint32), at[first].astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of sorted distinct hashes; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def id_ranges(keyed: DataFrame, ranges: int) -> np.ndarray:
    """The first id of each of up to ``ranges`` ranges of about equally many ids: one number per range."""
    shares = [i / ranges for i in range(ranges)]
    cuts = keyed.agg(F.percentile_approx("key", shares, 10 * max(ranges, 1000)), F.min("key")).first()
    if cuts[1] is None:
        return np.zeros(0, np.int64)
    bounds = np.unique(np.array([cuts[1], *cuts[0]], dtype=np.int64))

    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), "right") - 1)

    firsts = keyed.groupBy(F.pandas_udf(range_of, "bigint")("key").alias("part")).agg(F.min("key").alias("first"))
    return np.sort(np.array([r["first"] for r in firsts.collect()], dtype=np.int64))


def fingerprint_documents(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited text, which takes its last quarter from the next document.

    Reads doc_id and text, other columns are passed over. Null texts are empty; null ids come before all others;
    rows with equal ids follow each other by text; the row after the last is the first. An empty text has an empty
    fingerprint. Rows are dealt by ranges of ids, and the first row of a range is also sent, as a guest, to the
    range before it, so every row meets the next one without a global order in one task.
    """
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST_ID)).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    firsts = id_ranges(keyed.select("key"), RANGES_PER_TASK * tasks)

    def parts_of(keys: pd.Series) -> pd.Series:
        at = np.searchsorted(firsts, keys.to_numpy(), "right") - 1
        guest = firsts[at] == keys.to_numpy()
        before = (at - 1) % max(1, len(firsts))
        return pd.Series([[int(a), int(b)] if g else [int(a)] for a, b, g in zip(at, before, guest, strict=True)])

    dealt = keyed.select(
        "*", F.posexplode(F.pandas_udf(parts_of, "array<int>")("key")).alias("is_guest", "part")
    )
    ordered = dealt.repartition(tasks, "part").sortWithinPartitions("part", "is_guest", "key", "text")

    def rows(batches: Iterator[dict]) -> Iterable[tuple]:
        stream = (
            x for b in batches for x in zip(b["part"], b["is_guest"], b["doc_id"], b["text"], strict=True)
        )
        held = None

        def finished(doc, text, own, following, theirs) -> tuple:
            changed = edited(text, following)
            (hashes, at), (other, _), (theirs, _) = own, winnow(changed, k, window), theirs
            a, b, c = np.unique(hashes), np.unique(other), np.unique(theirs)
            sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
            name, changed_name = (x.astype(">u4").tobytes().hex() for x in (hashes, other))
            return doc, len(text), sha, name, changed_name, likeness(a, b), likeness(a, c), at.tolist()

        for part, is_guest, doc, text in stream:
            marks = winnow(text, k, window)
            if held is not None and held[0] == part:
                yield finished(*held[1:], text, marks)
            # only the first guest of a range follows its last row; others are equal ids' further rows
            held = None if is_guest else (part, doc, text, marks)

    return map_rows(ordered, rows, FINGERPRINTS)
