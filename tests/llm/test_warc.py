"""Archives: an exact round trip, and what is broken in them."""

import base64
import glob
import gzip
import hashlib

import pytest

from panelcast.llm import queries, warc

SCHEMA = "page_id long, url string, html string, digest string, first long, version string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)


def base32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


LONG = "".join(f"<p>paragraph {i} \r\n\r\nWARC/1.1\r\n é漢</p>" for i in range(3000))
ROWS = [
    (1, "http://a/ä b", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://c", None), (4, "http://d", ""), (5, "http://e", LONG), (6, "http://f", LONG + "!"),
    (7, "http://g", "text\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (1, "http://a/ä b", "<p>same</p>"), (8, "http://h", LONG), (5, "http://e", LONG),
    (None, "http://none", "without an id"), (None, "http://none", "<p>same</p>"), (9, "http://i", "9"), (9, "http://i", "another text of page nine"),
]


def test_round_trip(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS), f"{tmp_path}/archives", records_per_file=4)
    got = warc.read_pages(spark, f"{tmp_path}/archives").collect()
    assert len(got) == len(ROWS) and all(r["problem"] is None for r in got)
    first = {}
    for page, _, html in ROWS:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    want = sorted(
        (str(page), base32(html), "response" if page is not None and first[html or ""] == page or (html or "") not in first else "revisit",
         None if page is not None and first[html or ""] == page or (html or "") not in first else (html or "").encode())
        for page, _, html in ROWS
    )
    seen = sorted(
        (str(warc.page_of(r["name"])), r["digest"], r["type"], None if r["type"] == "response" else {base32(h): (h or "").encode() for _, _, h in ROWS}[r["digest"]])
        for r in got
    )
    assert seen == want
    texts = {base32(h): (h or "").encode() for _, _, h in ROWS}
    assert all(bytes(r["payload"]) == texts[r["digest"]] for r in got if r["type"] == "response")


def test_query_on_odd_rows(spark, tmp_path):
    pages(spark, ROWS).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((tuple(r) for r in queries.op3_warc(spark, str(tmp_path)).collect()), key=repr)
    first = {}
    for page, _, html in ROWS:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    want = []
    for page, _, html in ROWS:
        own = first.get(html or "")
        again = own is not None and own != page
        want.append((page, len((html or "").encode()), base32(html), "revisit" if again else "response", own if again else None))
    assert got == sorted(want, key=repr)


def test_empty_table(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS).limit(0), f"{tmp_path}/none")
    assert warc.read_pages(spark, f"{tmp_path}/none").collect() == []


def test_least_length_of_revisits(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, None, "ab"), (2, None, "ab"), (3, None, "long enough"), (4, None, "long enough")]), f"{tmp_path}/a", least=5)
    assert {warc.page_of(r["name"]): r["type"] for r in warc.read_pages(spark, f"{tmp_path}/a").collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def _archive(tmp_path, records):
    (tmp_path / "broken").mkdir()
    with gzip.open(f"{tmp_path}/broken/a.warc.gz", "wb") as file:
        file.write(b"\r\n\r\n".join(records) + b"\r\n\r\n")
    return f"{tmp_path}/broken"


@pytest.mark.parametrize(
    "change, said",
    [
        (lambda r: r, None), (lambda r: [r[0], *r[2:]], "missing"), (lambda r: r[1:], "missing"), (lambda r: r[:-1], "length"),
        (lambda r: [x.replace(b"Total-Length: ", b"Total-Length: 9") for x in r], "total length"),
        (lambda r: [r[0].replace(b"\r\n\r\n64\r\n", b"\r\n\r\n63\r\n", 1), *r[1:]], "chunk"),
        (lambda r: [r[0].replace(b"<p>paragraph 0", b"<p>paragraph 1", 1), *r[1:]], "another digest"), (lambda r: r[::-1], None), (lambda r: r * 2, None),
        (lambda r: [*r, r[1]], "different number"),
    ],
)
def test_broken_segments(spark, tmp_path, change, said):
    records = warc.page_records(1, "http://a", LONG[:1500].replace("\r\n", "").encode(), None, 400, 100)
    assert len(records) >= 4
    got = warc.read_pages(spark, _archive(tmp_path, change(records))).collect()
    assert len(got) == (2 if change(records) == records * 2 else 1)
    for row in got:
        if said is None:
            assert row["problem"] is None and bytes(row["payload"]) == LONG[:1500].replace("\r\n", "").encode()
        else:
            assert said in row["problem"] and row["payload"] is None


def test_chunked_framing():
    for payload in (b"", b"a", b"x" * 4096, b"0\r\n\r\n" * 50):
        for size in (1, 7, 4096):
            assert warc.dechunked(warc.chunked(payload, size)) == payload
    for broken in (b"", b"5\r\nabc", b"zz\r\nabc\r\n0\r\n\r\n", b"3\r\nabcd\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def test_archives_are_gzip_files(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS), f"{tmp_path}/archives")
    files = glob.glob(f"{tmp_path}/archives/*.gz")
    text = b"".join(gzip.open(f).read() for f in files)
    assert files and text.count(b"WARC-Type: response") + text.count(b"WARC-Type: revisit") == len(ROWS)
