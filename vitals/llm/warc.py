"""Operator 7: WARC archives with segmented records and chunked transfer framing.

Writing: each page is a record whose block is an HTTP response in chunked framing. Blocks longer than a segment
go on in continuation records (WARC-Segment-Origin-ID, -Number, -Total-Length). Of pages with equal
payloads the one with the smallest page_id is the response, the others are revisit records. Archives are
written by Spark's text writer, so any store and Spark's commit protocol serve; records
end with CRLF CRLF, and segments and chunks are cut between characters, so files are valid WARC.

Reading: files are split where a blank line is followed by a version line, and a record whose Content-Length isn't met yet goes on
with the next pieces of its file, so payloads of other writers may hold such text. (Our writer cuts a chunk inside
it, so it never occurs in a block; an uncompressed file that Spark reads in splits is cut there only by others' payloads, which is reported.) Records without segments are decoded at once;
segments alone are shuffled, grouped by origin, ordered by number, checked against the total length and joined; then
the chunked framing is taken off.

Cases: null html is empty; null url gives a record without target; null page_id gives a record without
one; rows that repeat page_id and html are each written and read; repeated page_ids with other html are other
records; a record whose lengths or framing are wrong comes back with ``error`` set and null payload; a
segment without its fellows is such a record; an empty table gives an empty archive and no rows.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import prepare, rows_batches

VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
SEPARATOR = END + VERSION
CHUNK_BYTES, SEGMENT_BYTES = 4096, 32768
#: A record that says it is longer isn't put together; Spark's text rows are bounded likewise.
MOST_BYTES = 1 << 30


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _before(data: bytes, at: int) -> int:
    """The next place from ``at`` down that doesn't cut a UTF-8 character."""
    while at < len(data) and at > 0 and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing; a chunk ends inside every record separator of the payload."""
    out, at = [], 0
    while at < len(payload):
        end = _before(payload, min(len(payload), at + size))
        found = payload.find(SEPARATOR, at, min(len(payload), end + len(SEPARATOR)))
        if 0 <= found < end and found + 6 < end:
            end = found + 6
        out.append(b"%x\r\n%b\r\n" % (end - at, payload[at:end]))
        at = end
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(data: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        eol = data.find(b"\r\n", at)
        if eol < 0:
            raise ValueError("chunk size missing")
        size = int(data[at:eol].split(b";")[0], 16)
        at = eol + 2
        if not size:
            return b"".join(out)  # trailers, if any, are not payload
        if data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk length wrong")
        out.append(data[at : at + size])
        at += size + 2


def segments(block: bytes, size: int) -> list[bytes]:
    out, at = [], 0
    while True:
        end = _before(block, min(len(block), at + size))
        while block[end : end + len(VERSION)] == VERSION:  # a segment must not start like a record
            end -= 1
        out.append(block[at:end])
        at = end
        if at >= len(block):
            return out


def _header(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return VERSION + lines.encode("utf-8", "replace") + b"Content-Length: %d\r\n\r\n" % len(block) + block


def _clean(value: str | None) -> str | None:
    return None if value is None else value.replace("\r", "%0D").replace("\n", "%0A")


def records(page_id, url, html: str | None, rep, segment_bytes: int = SEGMENT_BYTES, date: str = "1970-01-01T00:00:00Z") -> list[bytes]:
    """The record of a page, without its final CRLF CRLF, and its continuations. ``rep``: the page it revisits;
    ``date``: their WARC-Date."""
    payload = ("" if html is None else html).encode("utf-8", "replace")
    digest = base32_sha1(payload)

    def rid(page):
        return f"<urn:page:{'' if page is None else page}:{digest}>"

    fields = [("WARC-Record-ID", rid(page_id)), ("WARC-Date", date), ("WARC-Target-URI", _clean(url)), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if rep is not None and rep != page_id:
        extra = [("WARC-Type", "revisit"), ("WARC-Refers-To", rid(rep)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        return [_header(extra + fields, http.rstrip(b"\r\n"))]
    block = http + chunked(payload)
    parts = segments(block, segment_bytes)
    if len(parts) == 1:
        return [_header([("WARC-Type", "response"), *fields], block)]
    out = [_header([("WARC-Type", "response"), *fields, ("WARC-Segment-Number", "1")], parts[0])]
    for i, part in enumerate(parts[1:], 2):
        total = str(len(block)) if i == len(parts) else None
        out.append(
            _header(
                [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{rid(page_id)[:-1]}:{i}>"), ("WARC-Date", date), ("WARC-Segment-Origin-ID", rid(page_id)), ("WARC-Segment-Number", str(i)), ("WARC-Segment-Total-Length", total)],
                part,
            )
        )
    return out


def _write(segment_bytes: int, date: str):
    def rows(batches):
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "rep")), strict=True):
                for record in records(*r, segment_bytes, date):
                    yield (record,)

    def run(batches):
        for batch in rows_batches(rows(batches), pa.schema([("value", pa.binary())]), 200):
            yield batch.cast(pa.schema([("value", pa.string())]))

    return run


def write_warc(pages: DataFrame, out: str, min_revisit_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, date: dt.datetime | None = None) -> None:
    """Write ``pages`` (page_id, url, html) as gzipped WARC files under ``out``; ``date``: the time of capture,
    else that of this call (one for all records, so a task that is run again writes the same).

    Equal payloads of at least ``min_revisit_bytes`` share their response. Their smallest page_id is a map-side combined
    minimum per digest; payloads that occur once meet no revisit.
    """
    prepare(pages.sparkSession)
    stamp = (date or dt.datetime.now(dt.UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("digest"))
    size = F.octet_length(F.coalesce("html", F.lit("")))
    first = (
        rows.where(size >= min_revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("digest", "rep")
    )
    joined = rows.join(first, "digest", "left").select("page_id", "url", "html", "rep")
    joined.mapInArrow(_write(segment_bytes, stamp), "value string").write.option("lineSep", END.decode()).option("compression", "gzip").text(out)


_PARSED = "type string, record_id string, origin string, number int, total long, refers_to string, block binary, error string"
_PARSED_PA = pa.schema([("type", pa.string()), ("record_id", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("refers_to", pa.string()), ("block", pa.binary()), ("error", pa.string())])


def parse(record: bytes) -> tuple:
    """A record, with or without its version line and final CRLF CRLF, as a row of ``_PARSED``."""
    record = record.removeprefix(VERSION)
    head, _, rest = record.partition(END)
    h = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        k, _, v = line.partition(":")
        h[k.strip().lower()] = v.strip()
    error, length = None, h.get("content-length", "")
    if not length.isdigit() or rest[int(length) :] not in (b"", END) or len(rest) < int(length):
        error = "content length wrong"
    else:
        rest = rest[: int(length)]
    number, total = h.get("warc-segment-number", ""), h.get("warc-segment-total-length", "")
    return h.get("warc-type"), h.get("warc-record-id"), h.get("warc-segment-origin-id"), int(number) if number.isdigit() else None, int(total) if total.isdigit() else None, h.get("warc-refers-to"), rest, error


def lacking(piece: bytes) -> int:
    """Bytes that a record's first piece lacks by its Content-Length (0: none, or it can't be told)."""
    head, mark, rest = piece.partition(END)
    for line in head.split(b"\r\n"):
        k, _, v = line.partition(b":")
        if k.strip().lower() == b"content-length" and v.strip().isdigit():
            length = int(v)
            return max(0, length - len(rest)) if mark and length <= MOST_BYTES else 0
    return 0


def framed(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a stream of pieces, in which every separator has been taken out.

    A record goes on with the next pieces until its Content-Length is met. Where it is never met, as the next file begins or
    the pieces end beyond it, its first piece comes as it is (``parse`` reports it), and the others are read on their own.
    """
    ahead: deque[bytes] = deque()
    while True:
        first = ahead.popleft() if ahead else next(pieces, None)
        if first is None:
            return
        need, used = lacking(first), 0
        while need > 0:
            if used == len(ahead):
                more = next(pieces, None)
                if more is None:
                    break
                ahead.append(more)
            if ahead[used].startswith(VERSION):  # a file's first piece
                break
            need -= len(SEPARATOR) + len(ahead[used])
            used += 1
        if need in (0, -len(END)):  # the last record of a file has its end still
            first = SEPARATOR.join([first, *(ahead.popleft() for _ in range(used))])
        yield first


def _parse(batches):
    def pieces():
        for batch in batches:
            for value in batch.column("value").cast(pa.binary()).to_pylist():
                if value.strip():
                    yield value

    def rows():
        for record in framed(pieces()):
            yield parse(record)

    return rows_batches(rows(), _PARSED_PA, 200)


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, mark, body = block.partition(END)
    if not mark:
        raise ValueError("HTTP header without end")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


_PAGE = "record_id string, type string, refers_to string, payload binary, error string"
_PAGE_PA = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary()), ("error", pa.string())])


def _page(record_id, kind, refers_to, block, error):
    if kind == "revisit":
        return record_id, kind, refers_to, None, error
    try:
        return (record_id, kind, None, None, error) if error else (record_id, kind, None, payload_of(block), None)
    except ValueError as e:
        return record_id, kind, None, None, str(e)


def _decode(batches):
    def rows():
        for batch in batches:
            for r in batch.to_pylist():
                yield _page(r["record_id"], r["type"], r["refers_to"], r["block"], r["error"])

    return rows_batches(rows(), _PAGE_PA, 200)


def reassemble(parts: list[dict]) -> list[tuple[bytes, str | None]]:
    """The blocks made of the segments of one origin; equal records that were written m times come back m times."""
    by: dict[int, list[dict]] = {}
    for p in parts:
        by.setdefault(p["number"], []).append(p)
    copies = len(by.get(1, [])) or 1
    chain = [by[k][0] for k in sorted(by, key=lambda k: -1 if k is None else k)]
    block = b"".join(p["block"] for p in chain)
    total = next((p["total"] for p in chain if p["total"] is not None), None)
    error = next((p["error"] for p in chain if p["error"]), None)
    if [p["number"] for p in chain] != list(range(1, len(chain) + 1)) or total is None:
        error = error or "segment missing"
    elif total != len(block):
        error = error or "total length wrong"
    return [(block, error)] * copies


def _join_segments(batches):
    def rows():
        for batch in batches:
            for origin, parts in zip(batch.column("origin").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                for block, error in reassemble(parts):
                    yield _page(origin, "response", None, block, error)

    return rows_batches(rows(), _PAGE_PA, 50)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, type, refers_to, payload, error of every page record of the archives under ``path``."""
    prepare(spark)
    parsed = spark.read.option("lineSep", SEPARATOR.decode()).text(path).mapInArrow(_parse, _PARSED)
    whole = parsed.where("number is null and type <> 'continuation'").mapInArrow(_decode, _PAGE)
    parts = parsed.where("number is not null or type = 'continuation'")
    # a group is one record's segments (identical copies of a record share it)
    grouped = parts.groupBy(F.coalesce("origin", "record_id").alias("origin")).agg(F.collect_list(F.struct("number", "total", "block", "error")).alias("parts"))
    return whole.unionAll(grouped.mapInArrow(_join_segments, _PAGE))


def resolve(read: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, error: revisits get the size and digest
    of the response they refer to."""
    page = F.nullif(F.regexp_extract("record_id", "^<urn:page:([^:]*):", 1), F.lit("")).cast("long")
    measured = read.select(
        "record_id",
        page.alias("page_id"),
        "type",
        F.col("refers_to").alias("target"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("sha1"),
        "error",
    )
    responses = measured.where("type = 'response'").dropDuplicates(["record_id"]).select(F.col("record_id").alias("r"), F.col("payload_bytes").alias("rb"), F.col("sha1").alias("rs"), F.col("page_id").alias("rp"))
    joined = measured.join(responses, measured["target"] == responses["r"], "left")
    return joined.select(
        "page_id",
        F.coalesce("payload_bytes", "rb").alias("payload_bytes"),
        base32_of(F.coalesce("sha1", "rs")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("rp").alias("refers_to"),
        F.when(F.col("target").isNotNull() & F.col("r").isNull(), "response missing").otherwise(F.col("error")).alias("error"),
    )


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of(hex_digest):
    """Upper-case base32 of a 160-bit hex digest: five hex digits at a time are a number of four letters."""
    numbers = [F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 10).cast("int") for i in range(8)]
    letters = [F.substring(F.lit(_LETTERS), F.shiftright(n, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for n in numbers for shift in (15, 10, 5, 0)]
    return F.when(hex_digest.isNotNull(), F.concat(*letters))
