"""WARC archives: an index of offsets first, then coalesced reads of byte ranges.

Writing: every page becomes a WARC/1.1 record. Of records with equal payloads of ``MIN_REVISIT`` bytes
or more, the one with the smallest page_id is a response with the payload and the others are revisits
that refer to it; smaller ones are all responses. Each task writes archives of about ``ARCHIVE_BYTES``
under names of its own, each record a gzip member, and returns one index row per record with file,
offset, length, URL and digest. Only index rows of tasks that ended well are kept, so files that a
lost executor has left are never read.

Reading: selected index rows are sorted by file and offset; neighbours at most ``GAP`` bytes apart
become one read of at most ``READ_BYTES`` (a longer record is one read). A task opens a file, reads the
range once and parses its records; digests of the bytes that were read are compared with the index.

Files are reached through ``pyarrow.fs`` by the URI of the shared folder, on whatever store it is.

Defined cases: a null html is an empty payload, a null url is left out of the header; a record with a
null page_id is never referred to unless all of its group are, and then all are responses; rows that
repeat the smallest page_id with the same payload are responses too. An empty table gives an empty
index and no archives. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimwright.session import scratch_path, settle

MIN_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 4 << 20
GAP = 64 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "file string, offset long, length long, page_id long, url string, record_type string, "
    "refers_to long, payload_digest string, payload_bytes long"
)
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "payload_bytes long, payload binary"
)


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; a plain path is local."""
    if re.match(r"[a-z][a-z0-9+.-]*:", uri):
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def _record(page_id, url, kind, refers_to, digest, payload: bytes) -> bytes:
    """A record with its header, as a gzip member."""
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "text/html; charset=utf-8",
    }
    if url is not None:
        fields["WARC-Target-URI"] = re.sub(r"[\r\n]+", " ", url)
    if kind == "revisit":
        fields |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    body = payload if kind == "response" else b""
    fields["Content-Length"] = str(len(body))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + body + b"\r\n\r\n") + packer.flush()


def _parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and body of a record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def _page(field: str | None) -> int | None:
    number = (field or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "None") else None


def _with_kind(pages: DataFrame) -> DataFrame:
    """Pages with payload, digest, record type and the page referred to."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("payload_digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= MIN_REVISIT
    groups = (
        rows.filter(large)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("payload_digest", "first")
    )
    # A hot payload is on the left only, where adaptive execution splits it.
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(groups, "payload_digest", "left").select(
        "page_id",
        "url",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
        "payload_digest",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages to archives under ``folder``; the index, stored in the shared folder."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        out, name, at = None, "", 0
        for batch in batches:
            index = {f: [] for f in ("file", "offset", "length")}
            for row in _rows(batch):
                member = _record(
                    row["page_id"], row["url"], row["record_type"], row["refers_to"],
                    row["payload_digest"], row["payload"] or b"",
                )
                if out is None or at + len(member) > archive_bytes:
                    if out is not None:
                        out.close()
                    store.create_dir(root, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                out.write(member)
                index["file"].append(name)
                index["offset"].append(at)
                index["length"].append(len(member))
                at += len(member)
            kept = ("page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(index["file"], pa.string()),
                    pa.array(index["offset"], pa.int64()),
                    pa.array(index["length"], pa.int64()),
                    *[batch.column(k) for k in kept],
                ],
                ["file", "offset", "length", *kept],
            )
        if out is not None:
            out.close()

    return settle(_with_kind(pages).mapInArrow(write, INDEX), "warc-index")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def planned_reads(index: DataFrame, gap: int = GAP, read_bytes: int = READ_BYTES) -> DataFrame:
    """One row per read: file, start, end and the records in it, from any selection of index rows.

    Records are grouped by file and block of ``read_bytes`` first, so a read never spans two blocks
    (except for the end of its last record) and no file is gathered in one task.
    """
    block = F.floor(F.col("offset") / read_bytes)
    rows = index.select(
        "file", block.alias("block"), "offset", (F.col("offset") + F.col("length")).alias("stop"), "payload_digest"
    )
    order = Window.partitionBy("file", "block").orderBy("offset", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (F.col("offset") - before > gap)).cast("int")
    part = F.sum("opens").over(order)
    record = F.struct("offset", "stop", "payload_digest")
    return (
        rows.withColumn("opens", opens)
        .withColumn("part", part)
        .groupBy("file", "block", "part")
        .agg(
            F.min("offset").alias("start"),
            F.max("stop").alias("end"),
            F.sort_array(F.collect_list(record)).alias("records"),
        )
        .select("file", "start", "end", "records")
    )


def read_records(index: DataFrame, folder: str, gap: int = GAP, read_bytes: int = READ_BYTES) -> DataFrame:
    """Records of the selected index rows as they are in the archives, see ``RECORD``.

    A response's digest and length are taken from the bytes that were read, which must match the
    index. A revisit has the digest of its header and no payload.
    """
    reads = planned_reads(index, gap, read_bytes).sortWithinPartitions("file", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        name, source = None, None
        for batch in batches:
            for row in _rows(batch):
                if row["file"] != name:
                    if source is not None:
                        source.close()
                    name, source = row["file"], store.open_input_file(f"{root}/{row['file']}")
                source.seek(row["start"])
                data = source.read(row["end"] - row["start"])
                yield _decoded(data, row["start"], row["records"])
        if source is not None:
            source.close()

    return reads.mapInArrow(read, RECORD)


def _decoded(data: bytes, start: int, records: list[dict]) -> pa.RecordBatch:
    rows = []
    for record in records:
        fields, body = _parse(data[record["offset"] - start : record["stop"] - start])
        kind = fields["WARC-Type"]
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
        if digest != record["payload_digest"]:
            raise ValueError(f"{fields['WARC-Record-ID']} isn't the record in the index")
        rows.append(
            {
                "page_id": _page(fields["WARC-Record-ID"]),
                "url": fields.get("WARC-Target-URI"),
                "record_type": kind,
                "refers_to": _page(fields.get("WARC-Refers-To")),
                "payload_digest": digest,
                "payload_bytes": len(body) if kind == "response" else None,
                "payload": body if kind == "response" else None,
            }
        )
    return pa.RecordBatch.from_pylist(
        rows,
        schema=pa.schema(
            [
                ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                ("refers_to", pa.int64()), ("payload_digest", pa.string()),
                ("payload_bytes", pa.int64()), ("payload", pa.binary()),
            ]
        ),
    )


def resolved(records: DataFrame, *columns: str) -> DataFrame:
    """Records in which revisits have the ``columns`` of the response they refer to."""
    responses = records.filter("record_type = 'response'")
    revisits = records.filter("record_type = 'revisit'")
    found = responses.select(
        F.col("page_id").alias("_response"),
        F.col("payload_digest").alias("_digest"),
        *[F.col(c).alias(f"_{c}") for c in columns],
    ).dropDuplicates(["_response", "_digest"])
    joined = revisits.join(
        found,
        (F.col("refers_to") == F.col("_response")) & (F.col("payload_digest") == F.col("_digest")),
        "left",
    )
    return responses.unionByName(
        joined.select(*[_own(c, columns).alias(c) for c in records.columns])
    )


def _own(name: str, columns: tuple[str, ...]) -> Column:
    return F.col(f"_{name}") if name in columns else F.col(name)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, read all records back and resolve the lengths of revisits."""
    folder = scratch_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder)
    records = settle(read_records(index, folder).drop("payload"), "warc-records")
    return resolved(records, "payload_bytes")
