"""WARC archives: a writer with revisit records, and a reader that salvages damaged files."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm import files
from casemill.llm.shared import materialize, n_partitions, new_path, small

#: Payloads of fewer bytes are written again each time.
LEAST_BYTES = 100
#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 32_000_000
GZIP, VERSION = b"\x1f\x8b\x08", b"WARC/1."
#: Bytes of a file that are read at one time.
BLOCK = 1 << 20
DATE = "2000-01-01T00:00:00Z"


def _clean(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A gzip member with one record. With refers_to it is a revisit: the payload's digest and size, no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = lambda x: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{x}')}>"
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": name(page_id), "WARC-Date": DATE}
    if url is not None:
        head["WARC-Target-URI"] = _clean(url)
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    if refers_to is not None:
        head |= {"WARC-Refers-To": name(refers_to), "X-Refers-To-Page-ID": str(refers_to), "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    head |= {"WARC-Payload-Digest": f"sha256:{digest}", "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "X-Payload-Bytes": str(len(payload))}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Writes a record for each row; returns one row for each archive: path, n_records, n_bytes.

    Of rows with equal payloads of least_bytes or more, those with the smallest id are responses, the
    others revisits of it. A null payload is empty. A null id is larger than all others, and such rows are
    responses if no other row has their payload. Repeated rows with the smallest id are all responses. A null
    url is left out; white space and control characters in urls are percent-encoded. A very long payload is one record, written whole. An empty table gives no
    archive. Other columns aren't read. A task that runs twice writes files of other names, and only those
    of the attempt that Spark accepts are listed.

    Only digests and ids are shuffled, unless the repeated payloads are too many to broadcast.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    digests = materialize(rows.filter(F.octet_length("payload") >= least_bytes).select("page_id", "digest"), "digests")
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = materialize(firsts.select(F.col("digest").alias("f_digest"), "first_id"), "firsts")
    # Short payloads find nothing: no digest of theirs is in the table.
    known = rows.join(small(firsts), F.col("digest") == F.col("f_digest"), "left")
    refers = F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    known = known.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, n, size = None, "", 0, 0
        listed = []

        def done() -> None:
            out.close()
            listed.append({"path": path, "n_records": n, "n_bytes": size})

        for batch in batches:
            for a, b, c, d, e in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if out is None:
                    path, n, size = files.fresh(folder, ".warc.gz"), 0, 0
                    out = files.open_at(path, "w")
                out.write(member := record(a, b, c, d, e))
                n, size = n + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    done()
                    out = None
        if out is not None:
            done()
        if listed:
            yield pa.RecordBatch.from_pylist(listed, schema=pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))

    return materialize(known.mapInArrow(write, "path string, n_records long, n_bytes long"), "archives")


class _Bytes:
    """Parts of a file, read in blocks of which the last few are held."""

    def __init__(self, file):
        self.file, self.size, self.blocks = file, file.size(), {}

    def read(self, at: int, n: int) -> bytes:
        parts = []
        while n > 0 and at < self.size:
            k = at // BLOCK
            if k not in self.blocks:
                if len(self.blocks) >= 4:
                    self.blocks.pop(next(iter(self.blocks)))
                self.file.seek(k * BLOCK)
                self.blocks[k] = self.file.read(min(BLOCK, self.size - k * BLOCK))
            part = self.blocks[k][at - k * BLOCK :][:n]
            parts.append(part)
            at, n = at + len(part), n - len(part)
        return b"".join(parts)

    def find(self, what: bytes, at: int) -> int:
        """The first place from `at` on, or -1."""
        while at < self.size:
            if (found := self.read(at, BLOCK + len(what) - 1).find(what)) >= 0:
                return at + found
            at += BLOCK
        return -1


class Damaged(ValueError):
    pass


def _fields(head: bytes) -> dict[str, str]:
    version, *lines = head.split(b"\r\n")
    if not version.startswith(VERSION) or not version[7:].isdigit():
        raise Damaged("no version line")
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damaged("a header line has no name")
        out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def _checked(fields: dict[str, str], block: bytes) -> bytes:
    """The payload, if the digests hold."""
    _, blank, payload = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"x", block)
    for name, data in (("warc-block-digest", block), ("warc-payload-digest", payload)):
        kind, _, value = fields.get(name, "").partition(":")
        if name == "warc-payload-digest" and fields.get("warc-type") == "revisit":
            continue
        if kind == "sha256" and hashlib.sha256(data).hexdigest() != value.lower():
            raise Damaged(f"{name} differs")
    return payload if blank else b""


def _record_at(data: _Bytes, at: int) -> tuple[int, dict[str, str], bytes]:
    """The record that begins there: its end in the file, header fields, payload. Raises Damaged."""
    if data.read(at, 3) == GZIP:
        unpacker, pos, parts = zlib.decompressobj(31), at, []
        while not unpacker.eof:
            if not (piece := data.read(pos, 1 << 16)):
                raise Damaged("the member is cut off")
            try:
                parts.append(unpacker.decompress(piece))
            except zlib.error as e:
                raise Damaged(f"the member can't be unpacked: {e}"[:100]) from None
            pos += len(piece)
            if len(parts) == 1 and not (parts[0] or b"").startswith(VERSION[: len(parts[0])]):
                raise Damaged("the member has no version line")
        end, whole = pos - len(unpacker.unused_data), b"".join(parts)
        head, blank, rest = whole.partition(b"\r\n\r\n")
        if not blank:
            raise Damaged("the header doesn't end")
        fields = _fields(head)
        length = fields.get("content-length", "")
        if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
            raise Damaged("the block's length differs")
        return end, fields, _checked(fields, rest[:-4])
    if data.read(at, len(VERSION)) != VERSION:
        raise Damaged("neither a member nor a version line")
    if (stop := data.find(b"\r\n\r\n", at)) < 0:
        raise Damaged("the header doesn't end")
    fields = _fields(data.read(at, stop - at))
    length = fields.get("content-length", "")
    if not length.isdigit() or stop + 8 + int(length) > data.size:
        raise Damaged("the block is cut off")
    block = data.read(stop + 4, int(length) + 4)
    if block[-4:] != b"\r\n\r\n":
        raise Damaged("the block's length differs")
    return stop + 8 + int(length), fields, _checked(fields, block[:-4])


def salvage(file) -> Iterator[tuple[int, int, dict[str, str] | None, bytes | str]]:
    """What a file holds, in order: (begin, end, fields, payload), or (begin, end, None, reason) for lost bytes.

    After a record that fails a check, each later gzip member or version line is tried in turn until one
    holds a whole record; the bytes up to it are one gap. Memory is bounded by the largest record.
    """
    data, at = _Bytes(file), 0
    while at < data.size:
        try:
            end, fields, payload = _record_at(data, at)
        except Damaged as e:
            places = {what: data.find(what, at + 1) for what in (GZIP, VERSION)}
            while any(p >= 0 for p in places.values()):
                what, to = min(((w, p) for w, p in places.items() if p >= 0), key=lambda x: x[1])
                try:
                    _record_at(data, to)
                    break
                except Damaged:
                    places[what] = data.find(what, to + 1)
            else:
                to = data.size
            yield at, to, None, str(e)
            at = to
        else:
            yield at, end, fields, payload
            at = end


def read_warc(archives: DataFrame) -> DataFrame:
    """The records and gaps of archives (column path), one task for each archive.

    Columns: path, begin, end (bytes of the file), gap (the failed check, for quarantined bytes; else null),
    fields (header fields by lower-case name), payload. Gzip and plain archives, and mixtures, are read.
    Without damage there are no gaps. An empty file gives no rows.
    """
    schema = pa.schema([("path", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("gap", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with files.open_at(path, "r") as f:
                    rows, size = [], 0
                    for begin, end, fields, got in salvage(f):
                        good = fields is not None
                        rows.append((path, begin, end, None if good else got, list(fields.items()) if good else None, got if good else None))
                        size += len(got)
                        if size > 4_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    spread = archives.select("path").repartition(n_partitions(archives.sparkSession), "path")
    return spread.mapInArrow(read, "path string, begin long, end long, gap string, fields map<string,string>, payload binary")


def pages_of(archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pages that archives of write_warc() hold, and the byte gaps that had to be left out of them, both written to shared storage.

    Pages: page_id, payload_bytes, payload_digest, record_type, refers_to, and lost_bytes, which the reader quarantined in the
    page's archive. Gaps: path, begin, end, reason. Damaged records are in no row of the pages; an archive without damage
    has no gap and 0 lost bytes.
    """
    field = lambda name: F.col("fields")[name]
    response = field("warc-type") == "response"
    found = read_warc(archives).select(
        "path", "begin", "end", "gap",
        field("x-page-id").cast("long").alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(field("x-payload-bytes").cast("int")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.regexp_replace(field("warc-payload-digest"), "^sha256:", "")).alias("payload_digest"),
        field("warc-type").alias("record_type"),
        field("x-refers-to-page-id").cast("long").alias("refers_to"),
    )
    found = materialize(found, "records")
    gaps = materialize(found.filter("gap IS NOT NULL").select("path", "begin", "end", F.col("gap").alias("reason")), "quarantine")
    lost = gaps.groupBy(F.col("path").alias("l_path")).agg(F.sum(F.col("end") - F.col("begin")).alias("lost"))
    pages = found.filter("gap IS NULL").join(small(lost), F.col("path") == F.col("l_path"), "left")
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.coalesce("lost", F.lit(0)).cast("long").alias("lost_bytes")), gaps


def op1_warc(spark, sf_dir: str) -> DataFrame:
    pages, _ = pages_of(write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), new_path(spark, "warc")))
    return pages


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to, 0::BIGINT AS lost_bytes
FROM f
"""
