import base64
import gzip
import hashlib
import io

import pytest

from opsledger.llm import warc
from opsledger.session import new_run_dir

PAGES = [(1, "http://a/", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://c/\r\nX: y", ""), (4, "http://d/", None),
         (5, "http://e/é", "é" * 300_000), (9, "http://f/", "a\r\n\r\nWARC/1.1\r\n\r\n"), (9, "http://f/", "a\r\n\r\nWARC/1.1\r\n\r\n"),
         (None, None, "<p>same</p>"), (None, "u", "alone")]


def test_round_trip(spark):
    frame = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, key string").repartition(3)
    folder = new_run_dir(spark, "warc-test")
    got = warc.read_archives(warc.write_archives(frame, folder), folder).collect()
    assert len(got) == len(PAGES)
    largest = {}
    for i, _, html in PAGES:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if i is None else i)
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        row = next(r for r in got if r.page_id == page_id and r.payload_bytes == len(data))
        assert row.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        original = largest[html or ""]
        if original == -1 or page_id == original:
            assert (row.record_type, row.refers_to, bytes(row.payload)) == ("response", None, data)
        else:
            assert (row.record_type, row.refers_to, row.payload) == ("revisit", original, None)


def test_small_payloads_may_stay_responses(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    folder = new_run_dir(spark, "warc-test")
    got = warc.read_archives(warc.write_archives(frame, folder, min_bytes=12), folder).collect()
    assert {r.record_type for r in got if r.payload_bytes < 12} == {"response"}


def test_members_are_readable_and_damage_is_seen():
    one = warc.record(7, "http://x/", b"hello", None)
    packed = warc._gzip(one, 6)
    assert gzip.decompress(packed * 3) == one * 3
    assert [r["page_id"] for r in warc.read_archive(io.BytesIO(packed * 3))] == [7, 7, 7]
    assert len(list(warc.members(io.BytesIO(packed * 3), chunk=5))) == 3
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(packed + packed[:-20])))
    with pytest.raises(ValueError):
        warc.parse(one.replace(b"hello", b"jello"))
    with pytest.raises(ValueError):
        warc.parse(one.replace(b"hello", b"hell"))


def test_every_cut_is_seen():
    packed = [warc._gzip(warc.record(i, "http://x/", b"hello world" * i, None), 6) for i in (1, 2)]
    for cut in range(1, len(packed[1])):
        for chunk in (7, 1 << 16):
            with pytest.raises((ValueError, warc.zlib.error)):
                list(warc.members(io.BytesIO(packed[0] + packed[1][:cut]), chunk))
    # a cut between records shows by their number
    assert len(list(warc.read_archive(io.BytesIO(packed[0]), 1))) == 1
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(packed[0]), 2))
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(b""), 1))


def test_a_wrong_http_length_is_seen():
    one = warc.record(7, "http://x/", b"hello", None)
    block = one.split(b"\r\n\r\n", 1)[1][:-4]
    wrong = block.replace(b"Content-Length: 5", b"Content-Length: 6")
    made = one.replace(block, wrong).replace(warc.digest(block).encode(), warc.digest(wrong).encode())
    assert wrong != block
    with pytest.raises(ValueError, match="payload length"):
        warc.parse(made)


def test_empty_table(spark):
    folder = new_run_dir(spark, "warc-test")
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(frame, folder), folder).count() == 0
