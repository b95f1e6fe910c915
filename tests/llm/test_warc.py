import hashlib

import pytest
from pyspark.sql import functions as F

from nameledger.llm.common import new_folder
from nameledger.llm.warc import archive_pages, mark_revisits, member, members, parsed, read_archives, write_archives

SCHEMA = "page_id bigint, url string, html string, digest int"
LONG = "<p>ä</p>" * 400


def pages():
    data = [(i, f"http://a.example/{i}", f"<p>{i}</p>" * 300, 0) for i in range(20)]
    data += [(100 + i, None, LONG, 0) for i in range(9)] + [(200 + i, "http://b.example/x y\r\n", "short", 0) for i in range(3)]
    return data + [(300, "u", None, 0), (301, "u", "", 0), (108, "again", LONG, 1), (None, "u", LONG, 1), (400, "v", "\r\n\r\nWARC/1.1\r\n" * 90, 0)]


@pytest.mark.parametrize("roll", [1, 2_000, 1 << 26])
def test_round_trip(rows, roll):
    out = archive_pages(rows(pages(), SCHEMA).repartition(3), roll=roll, payloads=True).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.verified) for r in out]
    want = []
    for page, _, html, _ in pages():
        payload = (html or "").encode()
        same = [p for p, _, h, _ in pages() if p is not None and (h or "").encode() == payload]
        revisit = len(payload) >= 1000 and page is not None and page != max(same)
        want.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None, True))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = {r.page_id: r.payload for r in out if r.record_type == "response"}
    assert all(kept[p].decode() == (h or "") for p, _, h, _ in pages() if p in kept)
    assert {r.url for r in out if r.page_id in (100, 101)} == {None}


def test_members_and_frames():
    records = [member({"WARC-Type": "response", "WARC-Record-ID": f"<{n}>"}, b"x" * n) for n in (0, 1, 70_000)]
    data = b"".join(records)
    for step in (1, 7, 1 << 20):
        found = [parsed(m) for m in members(data[i : i + step] for i in range(0, len(data), step))]
        assert [len(block) for _, block, holds in found if holds] == [0, 1, 70_000]
    with pytest.raises(ValueError):
        list(members([data[:-5]]))
    with pytest.raises(ValueError):
        parsed(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n")


def test_damage_is_seen(spark, rows):
    folder = new_folder(spark, "warc-damage")
    archives = write_archives(mark_revisits(rows([(1, "u", "abc", 0)], SCHEMA)), folder)
    [archive] = archives.collect()
    with open(archive.path, "rb") as file:
        whole = list(members([file.read()]))
    broken = [w.replace(b"abc", b"abd") for w in whole]
    assert [parsed(w)[2] for w in broken] == [True, False]
    assert [r.verified for r in read_archives(archives).collect()] == [True]


def test_archives_are_read_by_as_many_tasks(spark, rows):
    pages = spark.range(400).selectExpr("id AS page_id", "concat('http://a/', id) AS url", "repeat(cast(id AS string), 300) AS html")
    archives = write_archives(mark_revisits(pages), new_folder(spark, "warc-many"), roll=2_000)
    n = archives.count()
    out = read_archives(archives).groupBy(F.spark_partition_id()).count().collect()
    assert n > 20 and len(out) == n and sum(r["count"] for r in out) == 400


def test_no_pages(rows):
    assert archive_pages(rows([], SCHEMA)).count() == 0
