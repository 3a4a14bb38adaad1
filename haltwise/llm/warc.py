"""WARC archives of pages: written with revisits and segments, read back and reassembled."""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.llm import common
from haltwise.session import fresh_dir

REVISIT_BYTES = 1000  # payloads of at least so many bytes are stored once
SEGMENT_BYTES = 4 << 10  # longer record blocks go on in continuation records
CHUNK_BYTES = 8 << 10  # of the HTTP body's chunked framing
FILE_BYTES = 16 << 20  # an archive of more compressed bytes is closed
READ_BYTES = 16 << 10  # of an archive handed to the decompressor at a time
DATE = "2024-01-01T00:00:00Z"

PARSED = (
    "record_id string, record_type string, origin string, segment int, total long, page_id long, "
    "refers_to long, digest string, block binary"
)


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(data: bytes) -> bytes:
    """The body that a chunked framing holds; ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        line = data.index(b"\r\n", at)
        size = int(data[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk ends early")
        out.append(data[at : at + size])
        at += size + 2


def payload(block: bytes) -> bytes:
    """Body of an HTTP response block, its transfer framing taken off."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" in head.lower():
        return dechunked(body)
    return body


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = [f"{k}: {v}" for k, v in [*headers, ("Content-Length", len(block))] if v is not None]
    data = "WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data.encode() + block + b"\r\n\r\n") + packer.flush()


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive of gzip members; ValueError where the
    archive ends within one. A member's decompressor sees little of what follows, so the work is
    in proportion to the archive."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpacker = zlib.decompressobj(31)
        pieces = []
        while not unpacker.eof:
            part = view[at : at + READ_BYTES]
            if not part:
                raise ValueError("an archive ends within a record")
            pieces.append(unpacker.decompress(part))
            at += len(part) - len(unpacker.unused_data)
        raw = b"".join(pieces)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
        yield headers, rest[: int(headers["content-length"])]


def page_records(
    page_id: int | None, url: str | None, body: bytes, digest: str, refers_to: int | None, size: int
) -> list[bytes]:
    """The records of a page: a revisit without payload, or a response and its continuations."""
    name = f"<urn:uuid:{uuid.uuid4()}>"
    common_part = [
        ("WARC-Record-ID", name),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%-._~")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("X-Page-ID", page_id),
    ]
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        more = [("WARC-Profile", profile), ("X-Refers-To-Page-ID", refers_to)]
        return [record([("WARC-Type", "revisit"), *common_part, *more], b"")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(body)
    kind = ("Content-Type", "application/http; msgtype=response")
    if len(block) <= size:
        return [record([("WARC-Type", "response"), *common_part, kind], block)]
    parts = [block[i : i + size] for i in range(0, len(block), size)]
    out = [
        record(
            [("WARC-Type", "response"), *common_part, kind, ("WARC-Segment-Number", 1)], parts[0]
        )
    ]
    for k, part in enumerate(parts[1:], 2):
        headers = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", DATE),
            ("WARC-Segment-Origin-ID", name),
            ("WARC-Segment-Number", k),
            ("WARC-Segment-Total-Length", len(block) if k == len(parts) else None),
        ]
        out.append(record(headers, part))
    return out


def chosen(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, body, digest, refers_to): of equal payloads of at least `least` bytes, all
    but the one of the largest page_id refer to it."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("body"))
    rows = rows.withColumn("digest", F.sha1("body"))
    long = F.octet_length("body") >= least
    top = rows.filter(long).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n"))
    top = top.filter("n > 1").drop("n")
    refers = F.when(long & (F.col("page_id") < F.col("top")), F.col("top"))
    return rows.join(top, "digest", "left").select(
        "page_id", "url", "body", "digest", refers.alias("refers_to")
    )


def write(
    pages: DataFrame,
    folder: str,
    segment_bytes: int = SEGMENT_BYTES,
    file_bytes: int = FILE_BYTES,
    least: int = REVISIT_BYTES,
) -> DataFrame:
    """Write `pages` (page_id, url, html) as archives below `folder`; the manifest (path,
    n_records, n_bytes), saved. Every attempt of a task writes files of its own, and only those
    of the attempt that counts are in the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = common.file_system(folder)
        system.create_dir(base, recursive=True)
        held: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.gz"
            with system.open_output_stream(f"{base}/{name}", compression=None) as f:
                for x in held:
                    f.write(x)
            return pa.RecordBatch.from_pydict(
                {"path": [f"{folder}/{name}"], "n_records": [len(held)], "n_bytes": [size]}
            )

        for batch in batches:
            columns = ("page_id", "url", "body", "digest", "refers_to")
            for row in zip(*(batch.column(c) for c in columns), strict=True):
                page, url, body, digest, refers = (x.as_py() for x in row)
                for x in page_records(page, url, body, digest, refers, segment_bytes):
                    held.append(x)
                    size += len(x)
                    if size >= file_bytes:
                        yield close()
                        held, size = [], 0
        if held:
            yield close()

    common.settle(pages.sparkSession)
    made = chosen(pages, least).mapInArrow(run, "path string, n_records long, n_bytes long")
    return common.save(made, "manifest")


def parse(manifest: DataFrame) -> DataFrame:
    """Every record of the archives that `manifest` names, one file at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, base = common.file_system(path)
                with system.open_input_stream(base, compression=None) as f:
                    data = f.read()
                out: dict[str, list] = {c.split()[0]: [] for c in PARSED.split(", ")}
                for h, block in records(data):
                    name = h["warc-record-id"]
                    row = (
                        name,
                        h["warc-type"],
                        h.get("warc-segment-origin-id", name),
                        int(h.get("warc-segment-number", 1)),
                        _number(h.get("warc-segment-total-length")),
                        _number(h.get("x-page-id")),
                        _number(h.get("x-refers-to-page-id")),
                        _hex(h.get("warc-payload-digest")),
                        block,
                    )
                    for column, v in zip(out.values(), row, strict=True):
                        column.append(v)
                    if len(out["block"]) == 500:
                        yield _batch(out)
                        out = {c: [] for c in out}
                yield _batch(out)

    files = common.partitions(manifest.sparkSession)
    return manifest.select("path").repartition(files, "path").mapInArrow(run, PARSED)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _hex(digest: str | None) -> str | None:
    return None if digest is None else base64.b32decode(digest.removeprefix("sha1:")).hex()


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    shape = [c.split() for c in PARSED.split(", ")]
    return pa.RecordBatch.from_pydict(columns, schema=pa.schema([(n, types[t]) for n, t in shape]))


def reassemble(parsed: DataFrame) -> DataFrame:
    """One row per record that is no continuation: page_id, record_type, refers_to, digest (of
    the header), payload, complete. Continuations go to their origin in the order of their
    segment numbers; a block whose numbers have gaps, whose total length differs or whose framing
    is broken is not complete and has no payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, good = [], []
            for parts, total, kind in zip(
                batch.column("parts"), batch.column("total"), batch.column("record_type"), strict=True
            ):
                parts = parts.as_py()
                block = b"".join(p["block"] for p in parts)
                ok = [p["segment"] for p in parts] == list(range(1, len(parts) + 1))
                ok &= len(parts) == 1 and total.as_py() is None or total.as_py() == len(block)
                body = None
                if ok and kind.as_py() == "response":
                    try:
                        body = payload(block)
                    except ValueError:
                        ok = False
                whole.append(body)
                good.append(ok)
            names = ["page_id", "record_type", "refers_to", "digest"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(whole, pa.binary()), pa.array(good)],
                [*names, "payload", "complete"],
            )

    first = F.col("record_type") != "continuation"
    grouped = parsed.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        F.max("total").alias("total"),
        *(F.max(F.when(first, F.col(c))).alias(c) for c in ("record_type", "page_id", "refers_to", "digest")),
    )
    return grouped.mapInArrow(
        run,
        "page_id long, record_type string, refers_to long, digest string, payload binary, complete boolean",
    )


def round_trip(pages: DataFrame, folder: str | None = None, **how) -> DataFrame:
    """Write `pages` (page_id, url, html) and read the archives back: page_id, payload_bytes,
    payload_digest (hex SHA-1), record_type, refers_to, complete.

    Of equal payloads of at least `REVISIT_BYTES` that with the largest page_id is a response;
    the others are revisits, which hold no payload: theirs is looked up in the response they
    refer to, and `complete` says that the digests agree. A null html is an empty payload; a null
    url has no header; rows with a null page_id are responses; rows that repeat a response's id
    and payload are responses too; other columns are left out; an empty table gives an empty
    result and no archive.
    """
    folder = folder or fresh_dir(pages.sparkSession, "warc")
    manifest = write(pages, folder, **how)
    read = reassemble(parse(manifest)).select(
        "page_id",
        "record_type",
        "refers_to",
        "digest",
        "complete",
        F.octet_length("payload").cast("long").alias("size"),
        F.sha1("payload").alias("own"),
    )
    read = common.save(read, "records")
    answers = (
        read.filter("record_type = 'response' and page_id is not null")
        .groupBy(F.col("page_id").alias("refers_to"), F.col("own").alias("digest"))
        .agg(F.max("size").alias("far_size"), F.lit(True).alias("met"))
    )
    both = read.join(answers, ["refers_to", "digest"], "left")
    revisit = F.col("record_type") == "revisit"
    return both.select(
        "page_id",
        F.when(revisit, F.col("far_size")).otherwise(F.col("size")).alias("payload_bytes"),
        F.when(revisit, F.when(F.col("met"), F.col("digest"))).otherwise(F.col("own")).alias("payload_digest"),
        "record_type",
        "refers_to",
        F.when(revisit, F.coalesce("met", F.lit(False))).otherwise(F.col("complete") & (F.col("own") == F.col("digest"))).alias("complete"),
    )
