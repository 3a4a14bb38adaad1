import hashlib

import pytest

from haltwise.llm import warc

SHAPE = "page_id long, url string, html string, digest string, body string"


def pages():
    long = "<p>" + "x" * 2000 + "é</p>"
    return [
        (1, "http://a/1", long),
        (5, "http://a/5?q=\r\nSet: x", long),
        (3, None, long),
        (5, "http://a/5", long),
        (7, "http://b/7", "short"),
        (8, "http://b/8", "short"),
        (9, "http://b/9", None),
        (10, "http://b/10", ""),
        (11, "http://c/11", "y" * 999),
        (12, "http://c/12", "y" * 999),
        (13, "http://c/13", "z" * 1000),
        (14, "http://c/14", "z" * 1000),
        (15, "http://c/15", "long " * 60_000),
        (None, "http://c/n", long),
        (None, None, None),
        (16, "http://d/0", "0\r\n\r\nWARC/1.1\r\n\r\n" * 80),
    ]


def expected(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        top = max(same, default=None)
        again = len(data) >= 1000 and page is not None and page != top
        kind = "revisit" if again else "response"
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), kind, top if again else None, True))
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [{}, {"segment_bytes": 100, "file_bytes": 3000}])
def test_round_trip(spark, how):
    rows = [(*r, "x", "y") for r in pages()]
    found = warc.round_trip(spark.createDataFrame(rows, SHAPE).repartition(3), **how)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete"]
    assert found.columns == columns
    assert sorted(map(tuple, found.collect()), key=str) == expected(pages())


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SHAPE)).count() == 0


def test_broken_records_are_not_complete(spark):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"abc" * 50, 20)

    def row(name, kind, segment, total, data):
        return (f"{name}-{segment}", kind, name, segment, total, 7, None, "d", data)

    rows = [
        row("good", "continuation", 2, len(block), block[60:]),
        row("good", "response", 1, None, block[:60]),
        row("gap", "response", 1, None, block[:60]),
        row("gap", "continuation", 3, len(block), block[60:]),
        row("short", "response", 1, None, block[:60]),
        row("short", "continuation", 2, len(block) + 1, block[60:]),
        row("lost", "response", 1, None, block[:60]),
        row("frame", "response", 1, None, block.replace(b"14\r\n", b"13\r\n")),
    ]
    found = warc.reassemble(spark.createDataFrame(rows, warc.PARSED)).collect()
    assert [bytes(r.payload) for r in found if r.complete] == [b"abc" * 50]
    assert sum(not r.complete for r in found) == 4


def test_archives_are_read_by_their_headers():
    data = b"".join(warc.page_records(4, "http://a/ü", b"q" * 500, "00" * 20, None, 200))
    read = list(warc.records(data))
    assert [h["warc-type"] for h, _ in read] == ["response", "continuation", "continuation", "continuation"][: len(read)]
    assert read[0][0]["warc-target-uri"] == "http://a/%C3%BC"
    assert warc.payload(b"".join(b for _, b in read)) == b"q" * 500
    assert int(read[-1][0]["warc-segment-total-length"]) == sum(len(b) for _, b in read)


def test_large_groups_and_very_long_pages(spark):
    """Copies of one page, as many as a third of a table, and a page of more than 2^24 bytes."""
    rows = [(k, f"http://e/{k}", "copy " * 300) for k in range(400)]
    rows += [(1000 + k, None, f"page {k} " * (200 + k)) for k in range(100)]
    rows += [(2000, None, "long é " * (1 << 21)), (2001, None, "long é " * (1 << 21))]
    found = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_ordinary_pages_are_segmented(spark):
    rows = [(k, None, f"<p>{k}</p>" * 900) for k in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = warc.fresh_dir(spark, "warc")
    read = warc.parse(warc.write(df, folder))
    assert read.filter("record_type = 'continuation'").count() >= 10
    assert {r.page_id for r in warc.reassemble(read).filter("complete").collect()} == set(range(10))


def test_records_at_every_border_of_a_read(monkeypatch):
    data = b"".join(b for k in range(30) for b in warc.page_records(k, None, b"q" * 40 * k, "00" * 20, None, 200))
    want = list(warc.records(data))
    assert len(want) > 60
    for size in (1, 7, 97, 1 << 20):
        monkeypatch.setattr(warc, "READ_BYTES", size)
        assert list(warc.records(data)) == want
    with pytest.raises(ValueError, match="ends within"):
        list(warc.records(data[:-5]))
