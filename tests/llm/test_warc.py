"""Archives written, normalised and read back against the pages."""

import glob
import gzip
import hashlib

import pytest

from carelake.llm import warc

LONG = "<p>" + "x" * 120_000 + "</p>\r\n\r\nWARC/1.0\r\n"
PAGE = "<html>" + "page " * 40 + "</html>"


def pages_of(spark, rows):
    full = [(*r, "clash", "clash") for r in rows]
    return spark.createDataFrame(full, "page_id bigint, url string, html string, digest string, record string")


ROWS = [
    (3, "http://a/3", PAGE), (1, "http://a/1", PAGE), (2, None, PAGE), (1, "http://a/1", PAGE), (None, "http://n", PAGE),
    (4, "", None), (5, "http://a/\r\nX: y z", ""), (6, "http://é/6", "short"), (7, "http://a/7", "short"),
    (8, "http://a/8", LONG), (9, "http://a/9", LONG), (10, "http://a/10", "x" * 100), (11, "http://a/11", "x" * 100),
    (12, "u", "x" * 99), (13, "u", "x" * 99), (14, "u", "é" * 50), (15, "u", "é" * 50), (16, "u", "\x00﻿\n\r\n\r\n"),
    (None, "u", "y" * 200), (None, "u", "y" * 200),
]


def brute(rows, least=100):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        ids = [i for i, _, h in rows if (h or "").encode() == payload and i is not None]
        first = min(ids, default=None) if len(payload) >= least else None
        again = first is not None and page_id != first
        digest = hashlib.sha256(payload).hexdigest()
        out.append((page_id, len(payload), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def found(index):
    rows = []
    for r in warc.read(index).collect():
        page, first = (int(u[10:-1]) if u and u != "<urn:page:>" else None for u in (r.record_id, r.refers_to))
        rows.append((page, r.payload_bytes, r.payload_digest, r.record_type, first))
    return sorted(rows, key=repr)


def test_pages_survive_the_archives(spark, tmp_path):
    index = warc.archived(pages_of(spark, ROWS), str(tmp_path))
    assert found(index) == brute(ROWS)
    bodies = {r.record_id: r.payload for r in warc.read(index, payload=True).collect() if r.record_type == "response"}
    assert bodies["<urn:page:8>"].decode() == LONG and bodies["<urn:page:16>"].decode() == ROWS[17][2]
    uris = {r.record_id: r.target_uri for r in index.collect()}
    assert uris["<urn:page:5>"] == "http://a/%0D%0AX:%20y%20z" and uris["<urn:page:6>"] == "http://é/6"
    assert uris["<urn:page:4>"] is None and uris["<urn:page:2>"] is None


def test_whole_archives_are_one_stream_and_normal_ones_a_member_a_record(spark, tmp_path):
    pages = pages_of(spark, ROWS).coalesce(1)
    whole = warc.write_whole(warc.records(pages), f"{tmp_path}/whole", most=8)
    index = warc.normalised(spark, whole, f"{tmp_path}/normal")
    before = sorted(gzip.open(f).read() for f in glob.glob(f"{whole}/*.gz"))
    after = glob.glob(f"{tmp_path}/normal/archives/*.warc.gz")
    assert len(before) == 3 and before == sorted(gzip.open(f).read() for f in after)
    for row in index.collect():
        with open(row.path, "rb") as file:
            file.seek(row.offset)
            record = gzip.decompress(file.read(row.length))
        assert record.startswith(b"WARC/1.0\r\n") and record.endswith(b"\r\n\r\n")
        assert row.record_id.encode() in record.split(b"\r\n\r\n")[0]
    by_path = {}
    for row in index.orderBy("path", "offset").collect():
        assert row.offset == by_path.get(row.path, 0)
        by_path[row.path] = row.offset + row.length
    assert found(index) == brute(ROWS)


def test_normal_archives_may_be_normalised_again(spark, tmp_path):
    index = warc.archived(pages_of(spark, ROWS), str(tmp_path))
    again = warc.normalised(spark, f"{tmp_path}/normal/archives", f"{tmp_path}/again")
    assert found(again) == found(index)


def test_cutting_does_not_depend_on_how_bytes_arrive():
    record = b"WARC/1.0\r\nContent-Length: 6\r\n\r\na\r\n\r\nb\r\n\r\n"
    for step in (1, 2, 5, 1000):
        cutter, got = warc._Cutter(), []
        data = record * 3
        for at in range(0, len(data), step):
            got += [r for _, r in cutter.feed(data[at : at + step])]
        cutter.finish()
        assert got == [record] * 3
    cutter = warc._Cutter()
    assert list(cutter.feed(record[:-1])) == []
    with pytest.raises(ValueError, match="ends inside"):
        cutter.finish()
    with pytest.raises(ValueError, match="no WARC record"):
        list(warc._Cutter().feed(b"HTTP/1.1 200 OK\r\n\r\n"))


def test_a_cut_off_archive_and_a_wrong_payload_are_errors(spark, tmp_path):
    rows = [(1, "u", "one page of text")]
    whole = warc.write_whole(warc.records(pages_of(spark, rows).coalesce(1)), f"{tmp_path}/whole")
    (name,) = glob.glob(f"{whole}/*.gz")
    data = gzip.open(name).read()
    for folder, changed in (("cut", data[:-9]), ("wrong", data.replace(b"one page", b"two page"))):
        (tmp_path / folder).mkdir()
        with gzip.open(tmp_path / folder / "a.warc.gz", "wb") as file:
            file.write(changed)
    with pytest.raises(Exception, match="ends inside a record"):
        warc.normalised(spark, f"{tmp_path}/cut", f"{tmp_path}/cut-normal")
    wrong = warc.normalised(spark, f"{tmp_path}/wrong", f"{tmp_path}/wrong-normal")
    with pytest.raises(Exception, match="not the one its digest names"):
        warc.read(wrong).collect()


def test_empty_table(spark, tmp_path):
    index = warc.archived(pages_of(spark, []), str(tmp_path))
    assert index.collect() == [] and warc.read(index).collect() == []
