import base64
import gzip
import hashlib

import pytest

from advisorium.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, extra string")


ROWS = [(3, "http://a/", "<p>x", None), (1, "http://b/ c\r\nd", "<p>x", "e"), (2, None, None, None), (4, "http://c/", "", "e"),
        (5, "http://d/", "é" * 3000, None), (None, "http://e/", "<p>x", None), (6, "http://f/", "WARC/1.1\r\n\r\n\x1f\x8b\x08", None),
        (7, "http://g/", "<p>x", None), (7, "http://g/", "<p>x", None)]


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 4, 5])
def test_round_trip(spark, tmp_path, least):
    warc.write_archives(pages(spark, ROWS), str(tmp_path / "w"), least)
    got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert {r.kind for r in got} == {"record"}
    first = {"": 2, "<p>x": 1}
    want = []
    for number, _, html, _ in ROWS:
        text = html or ""
        top = first.get(text, number)
        again = number != top and len(text.encode()) >= least
        want.append((number, len(text.encode()), sha1(text), "revisit" if again else "response", top if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == sorted(want, key=repr)
    assert all(hashlib.sha1(r.payload).digest() == base64.b32decode(r.payload_digest) for r in got if r.record_type == "response")
    for file in (tmp_path / "w").glob("part-*"):
        gzip.decompress(file.read_bytes())  # any gzip reader can open the files


def member(number, size=200):
    body = f"<p>{number}</p>".encode() * size
    return warc.member(warc.record(number, f"http://x/{number}", body, warc.base32_sha1(body), None, False))


def test_salvage_after_damage():
    parts = [member(i) for i in range(6)]
    broken = bytearray(parts[1])
    broken[len(broken) // 2] ^= 0xFF
    data = parts[0] + bytes(broken) + parts[2] + b"garbage" * 50 + parts[3] + parts[4][:40] + parts[5][:-9]
    found = list(warc.salvage(data))
    assert [f["page_id"] for _, _, f in found if f["kind"] == "record"] == [0, 2, 3]
    gaps = [(a, b) for a, b, f in found if f["kind"] == "gap"]
    assert sum(b - a for a, b in gaps) + sum(len(parts[i]) for i in (0, 2, 3)) == len(data)
    assert all(f["reason"] for _, _, f in found if f["kind"] == "gap")


def test_salvage_of_plain_records():
    raw = [warc.record(i, "u", b"body %d" % i, warc.base32_sha1(b"body %d" % i), None, False) for i in range(4)]
    damaged = raw[1].replace(b"body", b"bady")
    found = list(warc.salvage(raw[0] + damaged + raw[2] + b"\x00\x00" + raw[3]))
    assert [f["page_id"] for _, _, f in found if f["kind"] == "record"] == [0, 2, 3]


def test_large_record_ends_in_zero():
    content = b"x" * (warc.LARGE + 5)
    packed = warc.member(content)
    assert packed[-1] == 0 and gzip.decompress(packed) == content


def test_empty_table(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS).limit(0), str(tmp_path / "w"))
    assert warc.read_archives(spark, str(tmp_path / "w")).collect() == []
