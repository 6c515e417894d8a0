import hashlib
import io

import pytest

from stakefold.llm import common, queries, warc


def archive(n=6, compressed=True):
    parts = []
    for i in range(n):
        payload = (f"<p>page {i}</p>" * (i + 3)).encode()
        record = warc.record_bytes(i, f"http://h/{i}", payload, hashlib.sha256(payload).hexdigest(), None)
        parts.append(warc.member(record) if compressed else record)
    return parts


def read(data):
    out = list(warc.salvage(io.BytesIO(data), len(data)))
    assert [a for a, _, _ in out] == [0, *(b for _, b, _ in out)][:len(out)] and (not out or out[-1][1] == len(data))
    return [r.page_id for _, _, r in out if r], [(a, b) for a, b, r in out if r is None]


@pytest.mark.parametrize("compressed", [True, False])
def test_whole_archives(compressed):
    assert read(b"".join(archive(6, compressed))) == ([0, 1, 2, 3, 4, 5], [])
    assert read(b"") == ([], [])


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("where", [0, 0.93, 0.99])
def test_a_damaged_record_is_a_gap_and_later_ones_are_read(compressed, where):
    parts = archive(6, compressed)
    bad = bytearray(parts[2])
    at = min(int(where * len(bad)), len(bad) - 1)
    bad[at] ^= 0xFF
    start = len(parts[0]) + len(parts[1])
    pages, gaps = read(b"".join([*parts[:2], bytes(bad), *parts[3:]]))
    assert pages == [0, 1, 3, 4, 5]
    assert gaps == [(start, start + len(bad))]


@pytest.mark.parametrize("compressed", [True, False])
def test_junk_and_cut_ends(compressed):
    parts = archive(4, compressed)
    junk = b"\x00junk \x1f\x8b\x08 WARC/1. no record\r\n\r\n" * 3
    pages, gaps = read(junk + parts[0] + parts[1][:len(parts[1]) // 2] + parts[2] + junk + parts[3][:-7])
    assert pages == [0, 2]
    assert len(gaps) == 3
    assert gaps[0] == (0, len(junk))


def test_a_false_digest_is_quarantined():
    record = warc.record_bytes(1, None, b"x" * 200, "0" * 64, None)
    assert read(warc.member(record) + archive(1)[0]) == ([0], [(0, len(warc.member(record)))])


def test_headers_of_any_length():
    parts = archive(3, False)
    head, sign, rest = parts[1].partition(b"\r\n\r\n")
    long = head + b"".join(b"\r\nX-Note-%d: %s" % (i, b"v" * 50) for i in range(3000)) + b"\r\n folded on" + sign + rest
    assert len(long) > 1 << 17
    assert read(parts[0] + long + parts[2]) == ([0, 1, 2], [])
    assert read(warc.member(parts[0] + long) + warc.member(parts[2])) == ([0, 1, 2], [])
    stray = b"WARC/1.1\r\nX: y\r\nno field here\r\n"
    assert read(stray * 50 + parts[0])[0] == [0]


def test_several_records_in_a_member():
    parts = archive(6, False)
    data = warc.member(b"".join(parts[:3])) + warc.member(b"".join(parts[3:]))
    assert read(data) == ([0, 1, 2, 3, 4, 5], [])
    bad = bytearray(parts[1])
    bad[-20] ^= 0xFF
    first = warc.member(parts[0] + bytes(bad) + parts[2])
    assert read(first + warc.member(parts[3])) == ([0, 2, 3], [(0, len(first))])
    assert read(warc.member(b"") + warc.member(parts[3]))[0] == [3]


def test_magic_across_blocks(monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 7)
    parts = archive(3, False)
    assert read(b"zz" * 31 + parts[0] + b"y" + parts[1])[0] == [0, 1]


PAGES = [(1, "http://a", "x" * 120), (2, "http://b", "x" * 120), (3, None, "x" * 120), (4, "http://c é\r\n", "short"), (5, "u", "short"),
         (6, "u", None), (7, "u", ""), (None, "u", "x" * 120), (2, "http://b", "x" * 120), (8, "u", "é" * 50), (9, "u", "é" * 50)]


def test_revisits_messy_rows_and_round_trip(spark):
    pages = spark.createDataFrame([(*p, "extra", "f") for p in PAGES], "page_id long, url string, html string, digest string, first string")
    manifest = warc.write_archives(pages, common.new_folder(spark, "warc"), archive_bytes=600)
    rows = warc.read_archives(manifest)
    assert rows.where("kind = 'gap'").count() == 0
    got = sorted([(r["page_id"] is not None, r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows.collect()],
                 key=str)
    want = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        first = min([p for p, _, h in PAGES if h == html and p is not None], default=None)
        again = page is not None and len(payload) >= 100 and page > first
        want.append((page is not None, page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=str)
    assert manifest.agg({"records": "sum"}).first()[0] == len(PAGES)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, common.new_folder(spark, "warc"))
    assert warc.read_archives(manifest).collect() == []


def test_query_against_duckdb(spark, folder):
    import duckdb

    duckdb.sql(f"create or replace view pages as select * from '{folder}/pages.parquet'")
    want = duckdb.sql(queries.ORACLES["op5_warc"]).fetchall()
    got = queries.op5_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
