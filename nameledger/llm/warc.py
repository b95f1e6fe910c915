"""WARC archives: one gzip member per record, written by many tasks and read back in sequence.

Archives go to the folder all executors share. A task's archives have names of their own and only those in the
list that the write job commits are read, so a lost or repeated task leaves nothing double. The reader streams an
archive block by block: members are inflated one after the other, framed by Content-Length, and both digests of
a record are verified.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nameledger.llm.common import map_rows, new_folder, written

LEAST_PAYLOAD = 1000
ROLL_BYTES = 64 << 20
BLOCK_BYTES = 1 << 18
LEVEL = 6
#: Archives beyond this number share tasks.
MOST_READERS = 1 << 16
SALTS = 16
#: The pages carry no time of their own, and equal input has to give equal archives.
DATE = "1970-01-01T00:00:00Z"
VISIBLE = "".join(map(chr, range(33, 127)))
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVES = "path string, records bigint, bytes bigint"
RECORDS = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, verified boolean, payload binary"
)


def digest_text(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def member(headers: dict[str, str], block: bytes, level: int = LEVEL) -> bytes:
    """One record as one gzip member."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"WARC-Block-Digest: {digest_text(block)}"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    return press.compress(head + block + b"\r\n\r\n") + press.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, is_revisit: bool) -> bytes:
    """A response with its payload, or a revisit that has the HTTP header only and names the response."""
    headers = {
        "WARC-Type": "revisit" if is_revisit else "response",
        "WARC-Record-ID": page_urn(page_id),
        "WARC-Date": DATE,
        # a URI holds no control characters or blanks
        **({} if url is None else {"WARC-Target-URI": quote(url, safe=VISIBLE)}),
        "WARC-Payload-Digest": digest_text(payload),
        **({"WARC-Refers-To": page_urn(refers_to), "WARC-Profile": PROFILE} if is_revisit else {}),
        "Content-Type": "application/http; msgtype=response",
    }
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return member(headers, http if is_revisit else http + payload)


def members(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """The inflated gzip members of a stream, one at a time."""
    inflate, held = zlib.decompressobj(31), []
    for block in blocks:
        while block:
            held.append(inflate.decompress(block))
            if not inflate.eof:
                break
            yield b"".join(held)
            block, inflate, held = inflate.unused_data, zlib.decompressobj(31), []
    if any(held):
        raise ValueError("the archive ends inside a record")


def parsed(record: bytes) -> tuple[dict[str, str], bytes, bool]:
    """Header fields (names in lower case), block and whether the block's digest holds."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record where one should begin")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"the record {fields.get('warc-record-id')} is not as long as it says")
    return fields, rest[:length], fields.get("warc-block-digest") in (None, digest_text(rest[:length]))


def mark_revisits(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, url, payload, is_revisit, refers_to: of equal payloads of at least ``least`` bytes, the row with the
    greatest id is the response (all rows of that id, if it is repeated), the others revisit it.

    A row without an id is always a response. Digests are counted before anything is joined, and only repeated ones
    are; each of them stands under every salt, so a payload that a third of the pages share is spread over tasks.
    """
    base = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload")
    )
    keyed = base.select("*", F.sha1("payload").alias("digest"), F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).alias("salt"))
    repeated = (
        keyed.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count("page_id").alias("n"))
        .where("n > 1")
        .select("digest", "response", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"))
    )
    joined = keyed.join(repeated.hint("shuffle_hash"), ["digest", "salt"], "left")
    is_revisit = F.coalesce(F.col("page_id") != F.col("response"), F.lit(False))
    return joined.select("page_id", "url", "payload", is_revisit.alias("is_revisit"), F.when(is_revisit, F.col("response")).alias("refers_to"))


def write_archives(marked: DataFrame, folder: str, roll: int = ROLL_BYTES) -> DataFrame:
    """Writes the records of ``mark_revisits`` as archives in ``folder``; one row per archive, once committed."""

    def rows(batches: Iterator[dict]) -> Iterable[tuple]:
        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        task, out, path, count, size = TaskContext.get(), None, "", 0, 0
        for batch in batches:
            columns = (batch[c] for c in ("page_id", "url", "payload", "refers_to", "is_revisit"))
            for row in zip(*columns, strict=True):
                if out is None:
                    path = f"{root}/{task.partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, count = store.open_output_stream(path, compression=None), 0
                    info = member({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:archive:{task.partitionId()}>", "WARC-Date": DATE, "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    size = len(info)
                data = page_record(*row)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= roll:
                    out.close()
                    yield path, count, size
                    out = None
        if out is not None:
            out.close()
            yield path, count, size

    return written(map_rows(marked, rows, ARCHIVES), "warc-list").withColumn("folder", F.lit(folder))


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The page records of archives (columns path and folder), one row each, with what was verified.

    Records of other types are passed over. A record that breaks off or is not framed as it says is an error; one
    whose digests do not hold has verified = false. ``payloads=False`` leaves the payload column null.
    """

    def rows(batches: Iterator[dict]) -> Iterable[tuple]:
        for batch in batches:
            for path, root in zip(batch["path"], batch["folder"], strict=True):
                store, _ = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
                with store.open_input_stream(path, compression=None) as source:
                    for record in members(iter(lambda: source.read(BLOCK_BYTES), b"")):
                        fields, block, holds = parsed(record)
                        kind = fields["warc-type"]
                        if kind not in ("response", "revisit"):
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        said = fields["warc-payload-digest"]
                        size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
                        if kind == "response":
                            holds = holds and said == digest_text(payload) and size == len(payload)
                        yield (
                            page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, page_of(fields.get("warc-refers-to")),
                            size, base64.b32decode(said.removeprefix("sha1:")).hex(), holds, payload if payloads and kind == "response" else None,
                        )

    # the list of archives is small and its rows are much work: a number of partitions keeps them from being merged
    at_once = max(1, min(archives.count(), MOST_READERS))
    return map_rows(archives.select("path", "folder").repartition(at_once), rows, RECORDS)


def archive_pages(pages: DataFrame, least: int = LEAST_PAYLOAD, roll: int = ROLL_BYTES, payloads: bool = False) -> DataFrame:
    """Writes every page as a WARC record and reads the archives back.

    Reads page_id, url and html, other columns are passed over; null html is an empty payload. A null url has no
    target field, a null id becomes null again; repeated rows are records each for itself.
    """
    folder = new_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(mark_revisits(pages, least), folder, roll), payloads)
