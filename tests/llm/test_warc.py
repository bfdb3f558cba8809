import hashlib
import io
import zlib
from pathlib import Path

import pytest

from tidemark.llm import warc


def restated(rows):
    first = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 100 and i is not None:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        again = html in first and i != first[html]
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    return sorted(out, key=repr)


def test_round_trip_with_every_odd_payload(spark, tmp_path):
    long, odd = "ü" * 60, "WARC/1.1\r\n\r\nx\r\n\r\n" * 20 + "\x00\x1f tail"
    rows = [(i, f"http://h/{i} a\r\nWARC-Type: x", t) for i, t in enumerate([long] * 50 + [odd, odd + "\r\n", "short", "short", "", None])]
    rows += [(3, "again", long), (None, None, long), (None, "n", None), (9, "b", "ß" * 200_000), (8, "b", "ß" * 200_000), (8, "c", "ß" * 200_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    path = f"{tmp_path}/w"
    warc.write_archives(warc.resolve(pages), path, file_bytes=2000)
    got = warc.read_archives(spark, path)
    found = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()), key=repr)
    assert found == restated(rows)
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got.where("record_type = 'response'").collect())
    files = sorted(Path(path).glob("file=*/*.warc.gz"))
    assert len(files) > 4
    ids, pages = [], 0
    for file in files:
        records = members(file.read_bytes())
        assert records[0][1]["warc-type"] == "warcinfo" and len(records) > 1
        ids += [h["warc-record-id"] for _, h, _ in records]
        pages += len(records) - 1
        # any record can be read from its place alone
        at, headers, block = records[-1]
        again, = warc._records(io.BytesIO(zlib.decompressobj(31).decompress(file.read_bytes()[at:])))
        assert again == (headers, block)
        # the archive without its last record is below the bound
        assert records[-1][0] < 2000 + 200
        assert all(("warc-refers-to-target-uri" in h and "warc-profile" in h) == (h["warc-type"] == "revisit") for _, h, _ in records if h.get("warc-target-uri"))
    assert pages == len(rows) and len(set(ids)) == len(ids)


def members(raw):
    """An independent reader: place, headers and block of each record, member by member."""
    out, at = [], 0
    while at < len(raw):
        one = zlib.decompressobj(31)
        text = one.decompress(raw[at:])
        assert one.eof
        here, at = at, len(raw) - len(one.unused_data)
        if text == b"\r\n\r\n":
            continue
        head, _, block = text.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        assert len(block) == int(headers["content-length"])
        out.append((here, headers, block))
    return out


def test_pages_of_300_kb_make_files_of_bounded_size(spark, tmp_path):
    pages = spark.range(40).selectExpr("id AS page_id", "'http://h' AS url", "repeat(sha2(string(id), 256), 4800) || id AS html").coalesce(1)
    path = f"{tmp_path}/w"
    warc.write_archives(warc.resolve(pages), path, file_bytes=10_000)
    sizes = [p.stat().st_size for p in Path(path).glob("file=*/*.warc.gz")]
    assert len(sizes) > 2 and max(sizes) < 20_000
    got = warc.read_archives(spark, path).selectExpr("page_id", "payload_bytes", "sha2(payload, 256) = payload_digest AS fits").collect()
    assert sorted(r.page_id for r in got) == list(range(40)) and all(r.fits and r.payload_bytes > 300_000 for r in got)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(warc.resolve(pages), f"{tmp_path}/w")
    assert warc.read_archives(spark, f"{tmp_path}/w").count() == 0


def test_broken_archives_are_errors():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc._records(io.BytesIO(good * 2))] == [b"abc"] * 2
    with pytest.raises(ValueError):
        list(warc._records(io.BytesIO(good[:-6])))
    with pytest.raises(ValueError):
        list(warc._records(io.BytesIO(b"junk\r\n" + good)))
