"""WARC archives written with an index, and read back through it.

Every task writes its records, one gzip member each, to files of its own in the shared folder and hands on an index row per
record: file, offset, length, URL, digest. The index is a table; readers select index rows first, sort them by place,
and fetch neighbouring records in one byte range. A repeated task writes new files, and only those of the attempt
whose index rows were committed are ever read.

Of pages with one payload the smallest id is written as response, the others as revisits that name it.

Defined results: a null payload is empty; payloads under `least` bytes are all responses; a null id is never the one
referred to, unless all are null; rows that repeat the smallest id are all responses; a null URL has no target header and
control characters in one are percent-encoded; an empty table gives an empty index; further columns are not looked at.
"""

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .common import filesystem, shared_path, slices, text_bytes

FILE_BYTES = 1 << 30  # a file is closed beyond this
RANGE_BYTES = 8 << 20  # most bytes fetched at once, unless one record is longer
GAP_BYTES = 64 << 10  # a hole between records up to this is fetched along
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("page_id bigint, url string, payload_digest string, payload_bytes bigint, record_type string, refers_to bigint, "
         "file string, offset bigint, length bigint")
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: every 5 hexadecimal digits are 4 letters."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def deduplicated(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Pages with digest, record type and the page a revisit refers to. Only digests are counted; payloads move once."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": base32_sha1(F.col("payload")), "payload_bytes": F.octet_length("payload").cast("bigint")})
    again = rows.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(again, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", "payload_digest", "payload_bytes",
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("first_id")).alias("refers_to"))


def _record(page_id, url, payload: bytes, digest: str, size: int, revisit: bool, refers_to, date: str) -> bytes:
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z", **options) -> DataFrame:
    """Writes all pages and returns the stored index."""
    folder = folder or shared_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = filesystem(folder)
        out, path, at = None, "", 0
        try:
            for batch in slices(batches, "payload"):
                rows, files, offsets, lengths = batch.drop_columns(["payload"]).to_pylist(), [], [], []
                for row, payload in zip(rows, text_bytes(batch.column("payload")), strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        else:
                            store.create_dir(place, recursive=True)
                        path, at = f"{place}/{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(path, compression=None)  # members are compressed here
                    packer = zlib.compressobj(4, wbits=31)
                    data = packer.compress(_record(row["page_id"], row["url"], payload, row["payload_digest"], row["payload_bytes"],
                                                   row["record_type"] == "revisit", row["refers_to"], date)) + packer.flush()
                    out.write(data)
                    files.append(f"{folder}/{path.rpartition('/')[2]}")
                    offsets.append(at)
                    lengths.append(len(data))
                    at += len(data)
                columns = [batch.column(c) for c in ("page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    ["page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return stored(deduplicated(pages, **options).mapInArrow(run, INDEX), "warc-index")


def parse(record: bytes) -> dict:
    """The parts of one uncompressed record; the payload of a response is checked against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(digits) if (digits := name[len("<urn:page:"):-1]) else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    out = {"page_id": number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "refers_to": None, "payload": None}
    if out["record_type"] == "revisit":
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        return out | {"refers_to": number(fields["WARC-Refers-To"]), "payload_bytes": size, "payload_digest": digest}
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if found != digest:
        raise ValueError(f"payload of {out['page_id']} does not match its digest")
    return out | {"payload_bytes": len(payload), "payload_digest": found, "payload": payload}


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the given index rows. Rows are dealt out by stretch of file and read in order of place."""
    stretch = F.floor(F.col("offset") / RANGE_BYTES)
    names = RECORD.replace(" bigint", "").replace(" string", "").replace(" binary", "").split(", ")

    def ranges(rows: Iterator[tuple]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """Neighbouring records as (file, their offsets and lengths)."""
        file, held = None, []
        for name, offset, length in rows:
            if held and (name != file or offset - sum(held[-1]) > GAP_BYTES or offset + length - held[0][0] > RANGE_BYTES):
                yield file, held
                held = []
            file = name
            held.append((offset, length))
        if held:
            yield file, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in ("file", "offset", "length")], strict=True))
        for file, places in ranges(rows):
            if file != opened:
                if source is not None:
                    source.close()
                store, path = filesystem(file)
                opened, source = file, store.open_input_file(path)
            first = places[0][0]
            data = source.read_at(sum(places[-1]) - first, first)
            records = [parse(zlib.decompress(data[a - first:a - first + n], 31)) for a, n in places]
            columns = {c: [r[c] for r in records] for c in names}
            if not payloads:
                columns["payload"] = [None] * len(records)
            yield pa.record_batch([pa.array(columns[c], t) for c, t in zip(names, (
                pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()), strict=True)], names)

    placed = index.select("file", "offset", "length", stretch.alias("stretch")).repartition("file", "stretch")
    return placed.sortWithinPartitions("file", "offset").select("file", "offset", "length").mapInArrow(run, RECORD)
