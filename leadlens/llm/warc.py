"""WARC records in seekable Zstandard bundles, written and read by Spark.

A bundle holds whole WARC/1.1 records in independent Zstandard frames of bounded size, and ends in a footer: a
skippable frame with the seek table (compressed and plain size of each frame). A reader of one record fetches the
footer, one frame, and cuts the record out of it; a plain ``zstd -d`` gives the WARC file.

Bundles are rows (``bundle`` name, ``content`` bytes, ``records``: the index) of a Parquet table in the shared
folder, so Spark's committer decides which attempt counts when an executor is lost. ``find`` reads single records,
``read`` whole bundles.

Records with equal payloads of ``REVISIT_FROM`` bytes or more: the smallest id holds the payload, the others are
revisit records that name it. Null payloads are empty and null targets are left out of the record. Rows with the smallest id of a
payload that repeat are responses all (a record can't refer to itself); rows with a null id are responses where
their payload occurs with null ids only, else revisits. Empty tables give no bundle. Other columns are not archived.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REVISIT_FROM = 100
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

BUNDLES = "bundle string, content binary, records array<struct<id:bigint,frame:int,start:bigint,length:bigint>>"
RECORDS = "record_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _record(row_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    revisit = payload is None
    body = b"" if revisit else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:record:{'' if row_id is None else row_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c not in "\r\n" else "%%%02X" % ord(c) for c in url))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:record:{refers_to}>"]
    head += ["Content-Type: application/octet-stream", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, body and the end of the record that starts at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record at this place")
    head = dict(line.split(": ", 1) for line in lines[1:])
    first = stop + 4
    last = first + int(head["Content-Length"])
    return head, data[first:last], last + 4


def _footer(sizes: list[tuple[int, int]]) -> bytes:
    table = b"".join(struct.pack("<II", packed, plain) for packed, plain in sizes)
    table += struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table


def seek_table(content: bytes) -> list[tuple[int, int]]:
    """(offset, compressed size) of each frame, from the footer."""
    frames, _flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the bundle has no seek table")
    out, at = [], 0
    for k in range(frames):
        packed, _plain = struct.unpack_from("<II", content, len(content) - 9 - 8 * (frames - k))
        out.append((at, packed))
        at += packed
    return out


def _frame(content: bytes, where: tuple[int, int]) -> bytes:
    return zstandard.ZstdDecompressor().decompressobj().decompress(content[where[0] : where[0] + where[1]])


def _write_part(frame_bytes: int, bundle_bytes: int, level: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, bundle = TaskContext.get().partitionId(), 0
        zstd = zstandard.ZstdCompressor(level=level)
        plain, body, index, sizes = bytearray(), bytearray(), [], []

        def close_frame() -> None:
            packed = zstd.compress(bytes(plain))
            sizes.append((len(packed), len(plain)))
            body.extend(packed)
            plain.clear()

        def close_bundle() -> pd.DataFrame:
            nonlocal bundle
            if plain:
                close_frame()
            out = pd.DataFrame({"bundle": [f"part-{part:06d}-{bundle:06d}.warc.zst"], "content": [bytes(body) + _footer(sizes)], "records": [list(index)]})
            bundle += 1
            body.clear(), index.clear(), sizes.clear()
            return out

        for batch in batches:
            for x in batch.itertuples(index=False):
                row_id = None if pd.isna(x.id) else int(x.id)
                refers_to = None if pd.isna(x.refers_to) else int(x.refers_to)
                record = _record(row_id, x.url, None if refers_to is not None else bytes(x.payload), int(x.size), x.digest, refers_to)
                if plain and len(plain) + len(record) > frame_bytes:
                    close_frame()
                index.append({"id": row_id, "frame": len(sizes), "start": len(plain), "length": len(record)})
                plain.extend(record)
                if len(body) + len(plain) > bundle_bytes:
                    yield close_bundle()
        if index:
            yield close_bundle()

    return write


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = 3) -> DataFrame:
    """The bundles of all rows; write the result to a table before reading from it."""
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("digest"))
    # Only payloads that occur twice or more meet the rows, and they are counted before the shuffle.
    first = (
        rows.where(F.col("size") >= REVISIT_FROM)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    found = rows.join(first, "digest", "left").select(
        "id", "url", "size", "digest", F.when(F.col("id").isNull() | (F.col("id") != F.col("first")), F.col("first")).alias("refers_to"), "payload"
    )
    found = found.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))
    return found.mapInPandas(_write_part(frame_bytes, bundle_bytes, level), BUNDLES)


def _rows(records: list[tuple[dict[str, str], bytes]]) -> pd.DataFrame:
    out = []
    for head, body in records:
        revisit = head["WARC-Type"] == "revisit"
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        if not revisit and (len(body) != int(head["X-Payload-Length"]) or hashlib.sha256(body).hexdigest() != digest):
            raise ValueError(f"record {head['WARC-Record-ID']} is damaged")
        name = lambda x: int(n) if (n := x[len("<urn:record:") : -1]) else None
        out.append(
            (
                name(head["WARC-Record-ID"]),
                head.get("WARC-Target-URI"),
                None if revisit else body,
                int(head["X-Payload-Length"]),
                digest,
                head["WARC-Type"],
                name(head["WARC-Refers-To"]) if revisit else None,
            )
        )
    frame = pd.DataFrame(out, columns=["record_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"], dtype=object)
    return frame


def _read_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content in batch["content"]:
            content = bytes(content)
            for where in seek_table(content):
                data, at, records = _frame(content, where), 0, []
                while at < len(data):
                    head, body, at = _parse(data, at)
                    records.append((head, body))
                yield _rows(records)


def read(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles; payloads are checked against their digests, revisits have none."""
    return bundles.select("content").mapInPandas(_read_part, RECORDS)


def locate(bundles: DataFrame) -> DataFrame:
    """The index: ``record_id``, ``bundle``, ``frame``, ``start`` (inside the frame), ``length``."""
    return bundles.select("bundle", F.explode("records").alias("r")).select(F.col("r.id").alias("record_id"), "bundle", "r.frame", "r.start", "r.length")


def _find_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for content, wanted in zip(batch["content"], batch["wanted"]):
            content = bytes(content)
            table = seek_table(content)
            for w in wanted:
                data = _frame(content, table[w["frame"]])
                head, body, _ = _parse(data[w["start"] : w["start"] + w["length"]])
                yield _rows([(head, body)])


def find(bundles: DataFrame, ids: list[int]) -> DataFrame:
    """The records of a short list of ids; of each bundle only the frames that hold them are decompressed."""
    picked = F.filter("records", lambda r: r["id"].isin([int(i) for i in ids]))
    return bundles.select("content", picked.alias("wanted")).where(F.size("wanted") > 0).mapInPandas(_find_part, RECORDS)
