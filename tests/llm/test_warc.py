import base64
import hashlib

import pytest
import zstandard

from punctual.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, min_payload=0):
    heads, counts = {}, {}
    for page_id, _, html, _ in rows:
        body = (html or "").encode()
        if len(body) >= min_payload:
            counts[body] = counts.get(body, 0) + 1
            if page_id is not None:
                heads[body] = max(page_id, heads.get(body, page_id))
    out = []
    for page_id, _, html, _ in rows:
        body = (html or "").encode()
        head = heads.get(body) if counts.get(body, 0) > 1 else None
        revisit = head is not None and head != page_id
        kind = "revisit" if revisit else "response"
        out.append((page_id, len(body), digest(body), kind, head if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/é?x=1 2\n", "<p>same</p>", None),
    (7, None, "<p>same</p>", None),
    (3, "u", "<p>same</p>", None),
    (7, "twice", "<p>same</p>", None),
    (4, "u", None, None),
    (9, "u", "", None),
    (None, "u", "<p>same</p>", None),
    (-5, "u", "ü" * 300_000, None),
    (11, "u", "a: b\r\n\r\nWARC/1.1\r\n", None),
]


@pytest.mark.parametrize("how", [warc.Archiving(), warc.Archiving(archive_bytes=200, min_payload=5)])
def test_round_trip(spark, how):
    rows = ROWS + [(100 + i, f"http://h/{i}", f"<html>page {i} of many</html>", "") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in warc.archived_pages(df, how).collect()), key=str)
    assert got == expected(rows, how.min_payload)


def test_empty_table(spark):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_payloads_and_headers_come_back(spark, small):
    from punctual.session import scratch_folder

    pages = spark.read.parquet(f"{small}/pages.parquet")
    folder = scratch_folder(spark, "test-warc")
    names = warc.write_archives(pages, folder)
    assert names.selectExpr("sum(records)").first()[0] == pages.count()
    back = {r.record_id: r for r in warc.read_archives(spark, folder, names).collect()}
    for page in pages.collect():
        row = back[f"<urn:x-page:{page.page_id}>"]
        assert row.url is not None
        if row.record_type == "response":
            assert bytes(row.payload) == page.html.encode()


def records(n=40):
    return [
        warc.record(i, "u", b"some payload %d" % i, digest(b"some payload %d" % i), None, "d")
        for i in range(n)
    ]


def test_archive_layout():
    data = warc.archive(records())
    assert data[:4] == warc.DICTIONARY_MAGIC
    assert list(warc.frames(data)) == records()
    # few records: a dictionary of their heads, still one frame each
    assert list(warc.frames(warc.archive(records(2)))) == records(2)
    # an uncompressed dictionary is read as well
    size = int.from_bytes(data[4:8], "little")
    plain = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    other = data[:4] + len(plain).to_bytes(4, "little") + plain + data[8 + size :]
    assert list(warc.frames(other)) == records()


def test_broken_archives_are_refused():
    data = warc.archive(records())
    for broken in (data[:-3], data[:20], data[:6000:], data + b"junk"):
        if broken == data:
            continue
        with pytest.raises((warc.ArchiveError, zstandard.ZstdError)):
            list(warc.frames(broken))


@pytest.mark.parametrize(
    "old, new",
    [
        (b"WARC/1.1", b"HTTP/1.1"),
        (b"WARC-Date: d\r\n", b""),
        (b"payload 3", b"payload 4"),
        (b"WARC-Type: response", b"WARC-Type: other"),
        (b"\r\n\r\nsome", b"\r\nsome"),
        (b"sha1:", b"sha1:A"),
    ],
)
def test_broken_records_are_refused(old, new):
    raw = records(4)[3]
    assert warc.parse(raw)["payload"] == b"some payload 3"
    assert old in raw
    with pytest.raises(warc.ArchiveError):
        warc.parse(raw.replace(old, new))
    with pytest.raises(warc.ArchiveError):
        warc.parse(raw + raw)


@pytest.mark.parametrize("n", [1, 2, 30])
def test_a_dictionary_is_always_there(n):
    # long records first, very short ones, none alike
    long = warc.record(99, "u", b"x" * 3_000_000, digest(b"x" * 3_000_000), None, "d")
    for some in (records(n), [long, *records(n)], [long], [b"a"] * n):
        data = warc.archive(some)
        assert data[:4] == warc.DICTIONARY_MAGIC
        assert list(warc.frames(data)) == some
