"""op1: archives read back to the same records, by Zstandard's own rules."""

import hashlib

import pytest
import zstandard

from meterflow.llm import scratch, warc
from tests.llm import tables

BIG = "<p>" + "same page " * 40


def archived(spark, rows):
    path = scratch.new_folder(spark, "warc-test")
    warc.write_archives(warc.plan_records(rows), path)
    return path


def test_round_trip(spark):
    html = [None, "", "short", "short", BIG, BIG, "other " * 60 + "\u00e9\x00", BIG, "x" * 99, "x" * 99, "x" * 100, "x" * 100]
    rows = [(10 - i, f"http://h/{i}\r\n", h) for i, h in enumerate(html)] + [(None, None, BIG), (3, "http://again", BIG)]
    got = warc.read_archives(spark, archived(spark, tables.pages(spark, rows))).collect()
    assert len(got) == len(rows)
    first = {}
    for page, _, h in rows:
        if page is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, page), page)
    want = sorted(
        (
            (page, len(body), hashlib.sha256(body).hexdigest(), *(("revisit", first[h]) if revisit else ("response", None)))
            for page, _, h in rows
            for body in [(h or "").encode()]
            for revisit in [h in first and page != first[h]]
        ),
        key=str,
    )
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want
    bodies = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    assert bodies[4] == html[6].encode() and bodies[10] == b""
    assert {r.url for r in got if r.page_id == 10} == {"http://h/0%0D%0A"}


def test_many_archives_and_plain_zstandard(spark, monkeypatch):
    rows = [(i, f"http://h/{i}", tables.prose(i, 200)) for i in range(60)]
    records = [warc.record_bytes("response", i, None, u, "0" * 64, len(h), h.encode()) for i, u, h in rows]
    archive = warc.archive_bytes(records)
    assert archive[:4] == warc.DICT_MAGIC and len(archive) < sum(map(len, records)) / 2
    size = int.from_bytes(archive[4:8], "little")
    words = zstandard.ZstdCompressionDict(archive[8 : 8 + size])
    assert words.dict_id()  # a trained dictionary
    alone = zstandard.ZstdDecompressor(dict_data=words).stream_reader(archive, read_across_frames=True).read()
    assert alone == b"".join(records)
    assert list(warc.records_of(archive + warc.EMPTY_FRAME.encode())) == records


def test_damage_is_noticed():
    record = warc.record_bytes("response", 1, None, "http://a", hashlib.sha256(b"abc").hexdigest(), 3, b"abd")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(record)


def test_empty_table(spark):
    path = archived(spark, tables.no_rows(spark, tables.PAGES))
    assert warc.read_archives(spark, path).count() == 0
