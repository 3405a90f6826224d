"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that are compressed on their own; a bundle is some frames and, in a skippable frame at
its end, the seek table: the compressed and plain size of every frame. An index gives the frame, the place in the
frame and the size of each record, so one record is read by decompressing one frame. A bundle is a valid .warc.zst
file; bundles are kept as rows of a table, because any store that Spark reaches can hold that, and `export` writes
them as files.

Of records with the same payload of at least `least` bytes, the one with the smallest id is a response and the others
are revisits: headers that refer to it, without the payload. Digests are grouped with partial aggregation, so a
payload that a third of all pages share meets in one row.

Defined cases: NULL html is an empty payload; a NULL id is written as `none`, refers to another page's record if one
with an id holds the payload, and is a response otherwise; a NULL or unusual URL is left out or percent-encoded; rows
that share the smallest id are all responses; an empty table gives no bundles; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import column, pieces

#: Payloads below this size are never revisits. Plain bytes of a frame, and of a bundle.
LEAST_BYTES, FRAME_BYTES, BUNDLE_BYTES = 100, 256 << 10, 8 << 20
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the formats: the skippable frame's and the seek table's magic numbers, and the revisit profile.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD_ID = "urn:page:"
BUNDLES = "bundle string, archive binary, records array<struct<record_id: string, frame: int, offset: int, size: int>>"
RECORDS = "page_id long, record_type string, url string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def typed_pages(pages: DataFrame, least: int = LEAST_BYTES, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """`page_id`, `url`, `payload`, `digest`, `refers_to` (NULL for responses)."""
    rows = pages.select(
        column(id_column).cast("long").alias("page_id"),
        column(url_column).cast("string").alias("url"),
        F.coalesce(column(html_column).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    shared = (
        rows.filter(F.length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "first")
    )
    is_first = F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(~is_first, F.col("first")).alias("refers_to")
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit if it refers to another."""
    is_revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if is_revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <{_RECORD_ID}{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if is_revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_RECORD_ID}{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record. The payload of a revisit is None; its full size stands in its HTTP header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line.split(b": ")[1]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length: "))
    number = lambda x: int(x) if (x := x.strip("<>").removeprefix(_RECORD_ID)) != "none" else None
    is_revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "record_type": fields["WARC-Type"],
        "url": urllib.parse.unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "refers_to": number(fields["WARC-Refers-To"]) if is_revisit else None,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "payload_bytes": size,
        "payload": None if is_revisit else payload,
    }


class Bundle:
    """Collects records into frames."""

    def __init__(self, level: int = 3):
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.places: list[dict] = []
        self.open: list[bytes] = []
        self.filled = self.total = 0

    def add(self, record_id: str, raw: bytes) -> None:
        self.places.append({"record_id": record_id, "frame": len(self.frames), "offset": self.filled, "size": len(raw)})
        self.open.append(raw)
        self.filled += len(raw)
        self.total += len(raw)
        if self.filled >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            frame = self.compress(b"".join(self.open))
            self.frames.append(frame)
            self.sizes.append((len(frame), self.filled))
            self.open, self.filled = [], 0

    def archive(self) -> bytes:
        self.close_frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(archive: bytes) -> list[tuple[int, int, int]]:
    """Begin, compressed size and plain size of each frame, from the footer."""
    n, descriptor, magic = struct.unpack("<IBI", archive[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if descriptor & 0x80 else 8
    table = archive[len(archive) - 9 - n * width : -9]
    out, at = [], 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", table, i * width)
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(archive: bytes, place: tuple[int, int, int]) -> bytes:
    begin, packed, plain = place
    return zstandard.ZstdDecompressor().decompress(archive[begin : begin + packed], max_output_size=max(plain, 1))


def read_record(archive: bytes, place: dict) -> dict:
    """One record by its index entry: a single frame is decompressed."""
    frame = read_frame(archive, seek_table(archive)[place["frame"]])
    return parse(frame[place["offset"] : place["offset"] + place["size"]])


def bundles(typed: DataFrame) -> DataFrame:
    """`bundle`, `archive`, `records` (the index) from the output of `typed_pages`; a bundle holds rows of one task."""

    def run(batches):
        from pyspark import TaskContext

        task, n, bundle = TaskContext.get().partitionId(), 0, Bundle()

        def row() -> pa.RecordBatch:
            archive = bundle.archive()
            place = pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int32()), ("size", pa.int32())])
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{task:06d}-{n:06d}"]), pa.array([archive], pa.binary()), pa.array([bundle.places], pa.list_(place))],
                ["bundle", "archive", "records"],
            )

        for batch in batches:
            for piece in pieces(batch):
                for r in piece.to_pylist():
                    raw = record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"])
                    bundle.add(_RECORD_ID + ("none" if r["page_id"] is None else str(r["page_id"])), raw)
                    if bundle.total >= BUNDLE_BYTES:
                        yield row()
                        n, bundle = n + 1, Bundle()
        if bundle.places:
            yield row()

    return typed.mapInArrow(run, BUNDLES)


def _batches(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    names = [x.split()[0] for x in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in names], names)


def read_bundles(bundled: DataFrame) -> DataFrame:
    """All records of the bundles, frame after frame: ids, types, digests and payloads (NULL for revisits)."""

    def frames(archive: bytes, places: list[dict]) -> Iterator[list[dict]]:
        table = seek_table(archive)
        by_frame: dict[int, list[dict]] = {}
        for place in places:
            by_frame.setdefault(place["frame"], []).append(place)
        for number, own in by_frame.items():
            frame = read_frame(archive, table[number])
            yield [parse(frame[p["offset"] : p["offset"] + p["size"]]) for p in own]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                for records in frames(row["archive"], row["records"]):
                    yield _batches(records)

    return bundled.select("archive", "records").mapInArrow(run, RECORDS)


def export(bundled: DataFrame, folder: str) -> DataFrame:
    """Write each bundle as a .warc.zst file and its index beside it, for a folder that all executors mount."""

    def run(batches):
        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            for row in batch.to_pylist():
                path = os.path.join(folder, row["bundle"] + ".warc.zst")
                with open(path + ".part", "wb") as file:
                    file.write(row["archive"])
                os.replace(path + ".part", path)
                yield pa.RecordBatch.from_pydict({"path": [path], "n_records": pa.array([len(row["records"])], pa.int64())})

    return bundled.mapInArrow(run, "path string, n_records long")
