from __future__ import annotations

import base64
import glob
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stratalake.llm.warc import chained, read_archives, write_archives
from stratalake.sources.scratch import scratch_folder

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 7\r\n\r\nHTTP/1.1\r\n\r\n"
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def expected(rows, least):
    first, count = {}, {}
    for page, _, html in rows:
        body = (html or "").encode()
        count[body] = count.get(body, 0) + 1
        if page is not None:
            first[body] = min(first.get(body, page), page)
    for page, _, html in rows:
        body = (html or "").encode()
        at = first.get(body) if len(body) >= least and count[body] > 1 else None
        again = at is not None and (page is None or page > at)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        yield page, len(body), digest, "revisit" if again else "response", at if again else None


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip_with_records_inside_payloads(spark, least):
    rng = random.Random(2)
    forms = [None, "", "x", "<p>é</p>", FAKE, FAKE * 5, "WARC/1.1\r\n" * 3, "\r\n\r\n" + FAKE, "y" * 5000, FAKE + "z" * 3000]
    rows = [(rng.choice([None, *range(200)]), rng.choice([None, "http://a\r\nX: y"]), rng.choice(forms)) for _ in range(150)]
    rows += [(i, "u", FAKE + str(i)) for i in range(300, 330)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("first", F.lit(1)).repartition(2)
    folder = scratch_folder(spark, "warc")
    write_archives(pages, folder, least)
    found = read_archives(spark, folder, range_bytes=1000)
    assert sorted(str(tuple(r)) for r in found.select(*COLUMNS).collect()) == sorted(map(str, expected(rows, least)))
    body = {r.page_id: r.payload for r in found.filter("page_id >= 300").collect()}
    assert body[305] == (FAKE + "305").encode()


def test_no_pages(spark):
    folder = scratch_folder(spark, "warc")
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert read_archives(spark, folder).collect() == []


def test_a_broken_chain_is_an_error(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(FAKE.encode() + b"rest")
    with pytest.raises(ValueError, match="chain"):
        read_archives(spark, tmp_path.as_uri())
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.warc").write_bytes(b"no record")
    with pytest.raises(ValueError, match="start"):
        read_archives(spark, (tmp_path / "b").as_uri())


def test_chains_leave_their_range():
    assert chained([(0, 10), (10, 25), (12, 13), (15, 40)], 20) == {0: 25, 10: 25, 12: -1, 15: 40}


def parsed(data):
    """Records of one file, by their lengths alone."""
    at = 0
    while at < len(data):
        head, _, rest = data[at:].partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        assert version == "WARC/1.1" and rest[size : size + 4] == b"\r\n\r\n"
        yield fields, rest[:size]
        at += len(head) + 4 + size + 4


def test_long_headers_false_lengths_and_an_independent_reader(spark):
    huge = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99999999999999999999\r\n\r\n"
    beyond = huge.replace("9" * 20, "9" * 15)
    endless = "WARC/1.1\r\nno end of the line " + "x" * 300_000
    rows = [(1, "http://a/" + "u" * 200_000, "p" * 900), (2, "b", huge * 3), (3, "c", beyond), (4, "d", endless), (None, "e", "n")]
    rows += [(i, "same", "s") for i in range(10, 40)]
    folder = scratch_folder(spark, "warc")
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder, date="2024-05-06T07:08:09Z")
    found = read_archives(spark, folder, range_bytes=700)
    assert found.rdd.getNumPartitions() > 100  # a task for each range, not one for all
    found = found.collect()
    assert sorted(str(r.page_id) for r in found) == sorted(str(r[0]) for r in rows)
    assert {r.page_id: r.payload for r in found if r.page_id in (2, 4)} == {2: (huge * 3).encode(), 4: endless.encode()}
    data = b"".join(open(name, "rb").read() for name in sorted(glob.glob(folder.removeprefix("file:") + "/part-*")))
    records = list(parsed(data))
    assert len(records) == len(rows) and {f["WARC-Date"] for f, _ in records} == {"2024-05-06T07:08:09Z"}
    assert len({f["WARC-Record-ID"] for f, _ in records}) == len(rows)
    assert sum(f["WARC-Type"] == "revisit" for f, _ in records) == 29
