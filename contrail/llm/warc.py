"""WARC archives: a writer, and a salvage reader.

The writer makes one record a page. Of the pages with equal payloads (SHA-256)
the one with the smallest id is a ``response``; the others are ``revisit`` records
that refer to it and hold no payload. Records go out through Spark's text sink
(one record a row, record end as line separator), so task commit, retries and
any file system that Spark knows hold for archives too.

The reader checks each record: version line (any WARC version), header (lines may be folded),
length, record end, and the payload against the digest that its header states
(``digest_agrees``). A digest that it cannot compute, or of a payload with a transfer
coding, does not damage a record: ``verified`` is false then, and NULL without a digest. After a failed check it searches
for the next version line or gzip member, whatever the file began with, at which a
record passes all checks, goes on there, and logs the bytes between as a ``gap`` with the
reason. Of a damaged member the records that inflate before the damage are kept, and
the member is logged as a gap as well. One archive is parsed in one task, so archives are kept small
(``records_per_file``, fewer where payloads are large); payloads are handed on record by
record.

Defined results: a NULL payload is an empty one; a NULL id is an empty id in the
record and NULL when read; of repeated rows with the smallest id all are
responses; NULL and odd characters of a URL are percent-coded; payloads of under
``min_revisit_bytes`` are always responses; an empty table gives no records;
extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import by_value, checked_join
from contrail.session import materialize, staging_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = re.compile(rb"WARC/[0-9]{1,3}\.[0-9]{1,3}\r\n")
FOLD = re.compile(rb"\r\n[\x20\t]+")
ALGORITHMS = ("md5", "sha1", "sha256", "sha384", "sha512")
MEMBER = b"\x1f\x8b\x08"
CHUNK = 1 << 16
ID = re.compile(r"<urn:page:(-?\d*)>")
RECORD = ("file string, kind string, start bigint, end bigint, reason string, record_type string, "
          "record_id string, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes bigint, verified boolean, payload binary")


def base32_of_hex(digest: Column) -> Column:
    """The base32 text of a 40-digit hexadecimal SHA-1."""
    five = [F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 10).cast("int") for i in range(8)]
    return F.concat(*(F.substr(F.lit(BASE32), F.shiftright(n, 15 - 5 * j).bitwiseAND(31) + 1,
                               F.lit(1)) for n in five for j in range(4)))


def safe_uri(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F<>]", "%20")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html", min_revisit_bytes: int = 0,
            date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One column ``record``: the text of each page's record, without its end."""
    p = pages.select(F.col(id_col).cast("bigint").alias("id"), safe_uri(F.col(url_col)).alias("uri"),
                     F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    p = p.withColumn("size", F.octet_length("payload")).withColumn("sha", F.sha2("payload", 256))
    # Ids and hashes alone are grouped, and only payloads that occur again are joined back.
    again = materialize(p.filter(F.col("size") >= min_revisit_bytes).groupBy("sha").agg(
        F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "again")
    p = checked_join(p, again, ["sha"], ["id"], "left")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    urn = lambda c: F.concat(F.lit("<urn:page:"), text(c), F.lit(">"))
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), text(F.col("size")), F.lit(END))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("id"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.sha1("payload")))),
        line("X-Payload-Length", text(F.col("size"))))
    block = F.when(revisit, F.concat(
        line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", urn(F.col("first"))),
        line("Content-Length", F.lit("0")), F.lit("\r\n"))).otherwise(F.concat(
            line("Content-Type", F.lit("application/http; msgtype=response")),
            line("Content-Length", text(F.octet_length(http) + F.col("size"))), F.lit("\r\n"),
            http, F.col("payload")))
    return p.select(F.concat(head, block).alias("record"))


def write_warc(pages: DataFrame, path: str, records_per_file: int = 2_000,
               small_bytes: int = 1 << 18, **columns) -> None:
    """Archives of ``records_per_file`` records under ``path``. Payloads above ``small_bytes``
    go by sixteenfold steps of size to sub-folders, with fewer records a file, so that no file
    but that of a single record exceeds ``records_per_file * small_bytes`` and the headers."""
    size = F.coalesce(F.octet_length(columns.get("payload_col", "html")), F.lit(0))
    longest = pages.agg(F.max(size)).first()[0] or 0
    step, low, high = 0, 0, small_bytes
    while not step or low <= longest:  # equal payloads are equally long, so they stay together
        part = pages.filter(size.between(low, high)) if longest > small_bytes else pages
        (records(part, **columns).write.mode("overwrite").option("lineSep", END)
         .option("maxRecordsPerFile", max(1, records_per_file >> 4 * step))
         .text(f"{path}/larger-{step}" if step else path))
        step, low, high = step + 1, high + 1, high << 4


def digest_agrees(header: str, payload: bytes) -> bool | None:
    """Whether ``payload`` has the digest that a header states (``algorithm:value`` in any case,
    the value in hex, base32 or base64; SHA-1 without a name); None where that cannot be told."""
    name, colon, value = header.rpartition(":")
    name, value = (name.strip().lower().replace("-", "") if colon else "sha1"), value.strip()
    if name not in ALGORITHMS:
        return None
    raw = hashlib.new(name, payload, usedforsecurity=False).digest()
    if len(value) == 2 * len(raw):
        return value.lower() == raw.hex()
    value = value.rstrip("=")
    thirty_two = base64.b32encode(raw).decode().rstrip("=")
    if len(value) == len(thirty_two):
        return value.upper() == thirty_two
    sixty_four = base64.b64encode(raw).decode().rstrip("=")
    if len(value) == len(sixty_four):
        return value.replace("-", "+").replace("_", "/") == sixty_four
    return None  # no encoding that is known


def _record(data, at: int):
    """(fields, end) of the record at ``at``, or (None, reason)."""
    if not VERSION.match(data, at):
        return None, "version line"
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        return None, "header end"
    fields = {}
    for row in FOLD.sub(b" ", data[at:stop]).split(b"\r\n")[1:]:
        name, colon, value = row.partition(b":")
        if not colon:
            return None, "header line"
        fields[name.strip().lower()] = value.strip().decode("utf-8", "replace")
    kind, length = fields.get(b"warc-type"), fields.get(b"content-length", "")
    if not kind or b"warc-record-id" not in fields:
        return None, "header field"
    if not (length.isascii() and length.isdigit()):
        return None, "length field"
    begin, end = stop + 4, stop + 4 + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        return None, "record end"
    payload, coded = data[begin:end], False
    if fields.get(b"content-type", "").startswith("application/http"):
        body = payload.find(b"\r\n\r\n")
        if body < 0:
            return None, "http header"
        # Writers differ in whether a transfer coding counts as payload.
        coded = b"transfer-encoding:" in payload[:body].lower()
        payload = payload[body + 4:]
    stated, verified = fields.get(b"warc-payload-digest", ""), None
    digest = fields.get(b"warc-payload-digest", "").removeprefix("sha1:")
    size = len(payload)
    if kind == "revisit":
        n = fields.get(b"x-payload-length", "")
        size = int(n) if n.isascii() and n.isdigit() else None
    else:
        if stated:
            verified = digest_agrees(stated, payload)
            if verified is False and not coded:
                return None, "payload digest"
            verified = bool(verified)
        digest = base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()
    return ({"kind": "record", "reason": None, "record_type": kind,
             "record_id": fields[b"warc-record-id"], "target_uri": fields.get(b"warc-target-uri"),
             "refers_to": fields.get(b"warc-refers-to"), "payload_digest": digest or None,
             "payload_bytes": size, "verified": verified, "payload": payload}, end + 4)


def _gap(start: int, end: int, reason: str) -> dict:
    return {"kind": "gap", "start": start, "end": end, "reason": reason}


def salvage_plain(data: bytes):
    """The records and gaps of an archive that is not compressed, in order."""
    at, n = 0, len(data)
    while at < n:
        record, end = _record(data, at)
        if record:
            yield {**record, "start": at, "end": end}
            at = end
            continue
        start, reason = at, end
        while True:
            m = VERSION.search(data, at + 1)
            at = m.start() if m else n
            if at >= n or _record(data, at)[0]:
                break
        yield _gap(start, at, reason)


def _inflated(data: bytes, at: int):
    """(contents, end, place) of the gzip member at ``at``. Of a damaged one the contents are what
    inflates before the damage, the end is None, and the place is that of the damage."""
    out, inflate, view, begin, step = [], zlib.decompressobj(31), memoryview(data), at, CHUNK
    careful = False
    while at < len(data) and not inflate.eof:
        before = inflate.copy() if careful else None
        try:
            out.append(inflate.decompress(view[at:at + step]))
            at += step
        except zlib.error:
            if not careful:  # once more from the beginning, able to go back a step
                out, inflate, at, careful = [], zlib.decompressobj(31), begin, True
            elif step > 1:
                inflate, step = before, step // 2
            else:
                return b"".join(out), None, at
    at = min(at, len(data)) - len(inflate.unused_data)
    return b"".join(out), at if inflate.eof else None, at


def _place(data: bytes, at: int, size: int) -> int:
    """The place by which ``size`` bytes of the member at ``at`` have been inflated."""
    inflate, view, step = zlib.decompressobj(31), memoryview(data), CHUNK
    while size > 0:
        before = inflate.copy()
        try:
            more = len(inflate.decompress(view[at:at + step]))
        except zlib.error:
            more = size  # the damage is in these bytes, and after the place
        if more >= size and step > 1:
            inflate, step = before, step // 2
        else:
            at, size = at + step, size - more
    return at


def _reads(data: bytes, at: int) -> bool:
    """Whether a record that passes all checks begins at ``at``, plain or in a member."""
    if data.startswith(MEMBER, at):
        return any(r["kind"] == "record" for r in salvage_plain(_inflated(data, at)[0]))
    return _record(data, at)[0] is not None


def _next(data: bytes, at: int) -> int:
    """The next place from ``at`` on, a member's or a version line's, at which a record is read."""
    n, member, version = len(data), -1, -1
    while True:
        if member < at:
            member = data.find(MEMBER, at)
            member = n if member < 0 else member
        if version < at:
            m = VERSION.search(data, at)
            version = m.start() if m else n
        place = min(member, version)
        if place >= n or _reads(data, place):
            return place
        at = place + 1


def salvage(data: bytes):
    """The records and gaps of an archive of plain records, gzip members or both, in order;
    places of records in a member are those of the member."""
    at, n = 0, len(data)
    while at < n:
        start = at
        if data.startswith(MEMBER, at):
            out, end, damage = _inflated(data, at)
            if end is not None:
                for row in salvage_plain(out):
                    yield {**row, "start": start, "end": end}
                at = end
                continue
            kept = [r for r in salvage_plain(out) if r["kind"] == "record"]
            # What stands before the end of its last whole record belongs to the member.
            inner = _place(data, start, kept[-1]["end"]) if kept else start + 1
            at = _next(data, inner)
            yield from ({**r, "start": start, "end": at} for r in kept)
            yield _gap(start, at, "member end" if damage >= n else "member data")
            continue
        record, end = _record(data, at)
        if record:
            yield {**record, "start": at, "end": end}
            at = end
        else:
            at = _next(data, start + 1)
            yield _gap(start, at, end)


def _parse(with_payload: bool):
    names = [c.split()[0] for c in RECORD.split(", ")]

    def parse(batches):
        import pyarrow as pa

        types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(),
                 "boolean": pa.bool_()}
        schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in RECORD.split(", ")])
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                out, size = [], 0
                for row in salvage(content.as_py()):
                    if not with_payload:
                        row.pop("payload", None)
                    size += len(row.get("payload") or b"")
                    out.append({n: row.get(n) for n in names} | {"file": path.as_py()})
                    if len(out) >= 2_000 or size > 1 << 24:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    return parse


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps of all archives under ``path`` (columns of ``RECORD``)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .filter("length > 0"))
    return files.select("path", "content").mapInArrow(_parse(with_payload), RECORD)


def page_number(urn: Column) -> Column:
    return F.regexp_extract(urn, ID.pattern, 1).try_cast("bigint")


def warc_round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Writes ``pages`` to the shared folder and reports what is read back; a gap in archives that
    were just written is an error."""
    path = staging_path(pages.sparkSession, "warc")
    write_warc(pages, path, **columns)
    rows = read_warc(pages.sparkSession, path, with_payload=False)
    gap = F.raise_error(F.concat_ws(" ", F.lit("gap in a written archive:"), "file", "reason"))
    page = F.when(F.col("kind") == "record", page_number(F.col("record_id"))).otherwise(
        gap.cast("bigint"))
    return rows.select(page.alias("page_id"), "payload_bytes",
                       "payload_digest", "record_type",
                       page_number(F.col("refers_to")).alias("refers_to"))


by_value(__name__)
