"""Archives: exact round trips, range reads of selected records, leftovers of lost tasks."""

import gzip
import hashlib
import os

import pytest

from claimwright.llm import warc
from claimwright.session import scratch_path

LONG = "<html>" + "x" * 200
ROWS = [
    (1, "http://a/1", LONG),
    (2, "http://a/2", LONG),
    (3, None, LONG + "é€\r\n\r\nWARC/1.1\r\n\x00"),
    (4, "http://a/4\r\nX: y", None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "short"),
    (7, "http://a/7", "short"),
    (8, "http://a/8", "y" * 300_000),
    (9, "http://a/9", "y" * 300_000),
    (None, "http://a/n", LONG),
    (1, "http://a/1", LONG),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, "f", 3) for r in ROWS]
    return spark.createDataFrame(rows, "page_id long, url string, html string, file string, offset int")


@pytest.fixture(scope="module")
def archive(spark, pages):
    folder = scratch_path(spark, "warc-test").removeprefix("file:")
    return folder, warc.write_archives(pages.coalesce(2), folder, archive_bytes=1000)


def test_round_trip(pages):
    got = sorted(warc.round_trip(pages).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    assert len(got) == len(ROWS)
    html = {r[0]: r[2] for r in ROWS}
    for r in got:
        payload = (html[r.page_id] or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kinds == {
        1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("response", None),
        5: ("response", None), 6: ("response", None), 7: ("response", None), 8: ("response", None),
        9: ("revisit", 8), None: ("revisit", 1),
    }


def test_payloads_and_urls_come_back(archive):
    folder, index = archive
    rows = {r.page_id: r for r in warc.read_records(index, folder).collect()}
    assert bytes(rows[3].payload).decode() == ROWS[2][2] and rows[3].url is None
    assert rows[4].url == "http://a/4 X: y" and bytes(rows[4].payload) == b""
    assert rows[2].payload is None and rows[2].refers_to == 1


def test_archives_are_plain_warc(archive):
    folder, index = archive
    files = os.listdir(folder)
    assert len(files) > 2
    text = b"".join(gzip.open(f"{folder}/{f}").read() for f in files)
    assert text.count(b"WARC-Type: revisit") == index.filter("record_type = 'revisit'").count()
    assert text.startswith(b"WARC/1.1\r\n")


def test_selected_records_only(archive):
    folder, index = archive
    chosen = index.filter("page_id in (2, 6, 8)")
    assert sorted(r.page_id for r in warc.read_records(chosen, folder).collect()) == [2, 6, 8]
    reads = warc.planned_reads(index, gap=0, read_bytes=1 << 30).collect()
    assert len(reads) == index.select("file").distinct().count()  # neighbours became one read
    assert sum(len(r.records) for r in reads) == len(ROWS)
    apart = warc.planned_reads(index, gap=-1, read_bytes=1 << 30).collect()
    assert len(apart) == len(ROWS)
    assert sorted(r.page_id or 0 for r in warc.read_records(index, folder, read_bytes=50).collect()) == sorted(
        r[0] or 0 for r in ROWS
    )


def test_leftover_files_are_not_read(archive):
    folder, index = archive
    with open(f"{folder}/lost.warc.gz", "wb") as file:
        file.write(b"half a record of a lost task")
    assert warc.read_records(index, folder).count() == len(ROWS)
    os.remove(f"{folder}/lost.warc.gz")


def test_wrong_index_is_noticed(archive):
    folder, index = archive
    wrong = index.selectExpr("*").withColumn("payload_digest", index["url"])
    with pytest.raises(Exception, match="isn't the record"):
        warc.read_records(wrong, folder).count()


def test_empty_table(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0
