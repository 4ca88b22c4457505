"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole records, and a
footer in the seekable format: a skippable frame with the compressed and plain size of every
frame. An index maps each record's id to its bundle, its frame and its place within the plain
bytes of the frame, so that one record is read by decompressing one frame.

Records with equal payloads are written once: that with the largest page id as response, the
others as revisits that name it.

Tasks write bundles next to each other in a shared folder, each under a name of its own
attempt and then moved to the partition's name, so that a task which runs again replaces its
own files with the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from clipwire.llm.common import joined_apart, stored

#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 64 * 1024 * 1024
#: Plain bytes of the frames that a task reads back.
TASK_BYTES = 16 * 1024 * 1024
LEVEL = 3
RECORD = "page_id long, url string, payload binary, payload_digest string, payload_bytes long, record_type string, refers_to long"
INDEX = "record_id string, page_id long, bundle string, frame int, start long, length long"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """The records of ``RECORD`` for ``pages`` (page_id, url, html), one per row.

    A null ``html`` is an empty payload. Payloads are equal if length and SHA-1 are. Of equal
    payloads of ``least`` bytes or more, rows with the largest ``page_id`` are responses and
    the others revisits. Rows that share that id are all responses; a null id is never
    the largest unless all are null. Other columns are ignored.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.select("*", F.unhex(F.sha1("payload")).alias("sha"), F.octet_length("payload").alias("size"))
    rows = rows.withColumn("same", F.struct("sha", "size"))
    first = rows.where(F.col("size") >= least).groupBy("same").agg(F.max("page_id").alias("first"))
    both = joined_apart(rows, first, "same", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))

    @F.pandas_udf("string")
    def base32(sha: pd.Series) -> pd.Series:
        return sha.map(lambda b: base64.b32encode(b).decode())

    return both.select(
        "page_id",
        "url",
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        base32("sha").alias("payload_digest"),
        F.col("size").cast("long").alias("payload_bytes"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record_id: str | None) -> int | None:
    return None if record_id in (None, "<urn:page:none>") else int(record_id[len("<urn:page:") : -1])


def _line(text: str | None) -> str:
    """A header value: line breaks would end it, so they are percent-coded."""
    return (text or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def serialize(row: dict) -> bytes:
    """One WARC/1.1 record of a row with the fields of ``RECORD``."""
    payload = row["payload"]
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {_record_id(row['page_id'])}",
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
        f"Content-Length: {len(payload)}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {_line(row['url'])}")
    if row["record_type"] == "revisit":
        head.append(f"WARC-Refers-To: {_record_id(row['refers_to'])}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at ``at``, and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    block = data[end + 4 : end + 4 + size]
    if data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} has no end")
    return headers, block, end + 8 + size


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer for (compressed, plain) sizes of frames."""
    body = b"".join(struct.pack("<II", *f) for f in frames)
    body += struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(file) -> list[tuple[int, int, int]]:
    """(offset, compressed, plain) of each frame of an open bundle, from its footer."""
    file.seek(0, 2)
    size = file.tell()
    file.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("the file has no seek table")
    entry = 12 if flags & 0x80 else 8
    file.seek(size - 9 - entry * count)
    table = np.frombuffer(file.read(entry * count), "<u4").reshape(count, entry // 4)
    starts = np.concatenate(([0], np.cumsum(table[:, 0], dtype=np.int64)))
    return [(int(s), int(c), int(p)) for s, (c, p) in zip(starts, table[:, :2])]


def read_frame(file, frame: tuple[int, int, int]) -> bytes:
    import zstandard

    file.seek(frame[0])
    return zstandard.ZstdDecompressor().decompress(file.read(frame[1]), max_output_size=max(frame[2], 1))


def filesystem(folder: str):
    """pyarrow's file system for a folder that all executors share, and its path there."""
    from pyarrow import fs

    if folder.startswith("file:") or "://" not in folder:
        return fs.LocalFileSystem(), folder.removeprefix("file:").removeprefix("//")
    return fs.FileSystem.from_uri(folder)


def write_bundles(
    rows: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL
) -> DataFrame:
    """Writes ``rows`` (as of :func:`records`) as bundles under ``folder``; the index of its records.

    Each partition writes bundles of its own. A frame ends once it has ``frame_bytes`` plain bytes, a
    bundle once it has ``bundle_bytes`` compressed ones. A record larger than a frame has a frame to
    itself. The files are written when the result is computed; no rows write no files. Only the
    index says which files count: those of the attempts that came to their end. What other attempts
    of a task wrote, perhaps in another order of rows, has other names and is read by no-one.
    """

    schema = to_arrow_schema(StructType.fromDDL(INDEX))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        store, base = filesystem(folder)
        store.create_dir(base, recursive=True)
        compressor = zstandard.ZstdCompressor(level=level)
        partition, number = TaskContext.get().partitionId(), 0
        out, name, own, sizes, index, plain, held = None, "", "", [], [], [], 0

        def end_frame() -> None:
            nonlocal plain, held
            if plain:
                data = b"".join(plain)
                packed = compressor.compress(data)
                out.write(packed)
                sizes.append((len(packed), len(data)))
                plain, held = [], 0

        def end_bundle() -> pa.RecordBatch:
            nonlocal out, sizes, index, number
            end_frame()
            out.write(seek_table(sizes))
            out.close()
            store.move(own, f"{base}/{name}")
            made = pa.RecordBatch.from_pylist(index, schema)
            out, sizes, index, number = None, [], [], number + 1
            return made

        for batch in batches:
            for row in (r for k in range(0, batch.num_rows, 64) for r in batch.slice(k, 64).to_pylist()):
                if out is None:
                    # Named by this attempt: another one of the task has files of its own.
                    name = f"pages-{partition:06d}-{number:04d}-{uuid.uuid4().hex}.warc.zst"
                    own = f"{base}/.{name}"
                    out = store.open_output_stream(own, compression=None)
                data = serialize(row)
                index.append(
                    {
                        "record_id": _record_id(row["page_id"]),
                        "page_id": row["page_id"],
                        "bundle": name,
                        "frame": len(sizes),
                        "start": held,
                        "length": len(data),
                    }
                )
                plain.append(data)
                held += len(data)
                if held >= frame_bytes:
                    end_frame()
                    if sum(s for s, _ in sizes) >= bundle_bytes:
                        yield end_bundle()
        if out is not None:
            yield end_bundle()

    return rows.mapInArrow(write, INDEX)


def read_bundles(index: DataFrame, folder: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Every record of the bundles that ``index`` names, read frame by frame.

    Frames are dealt to tasks of some ``task_bytes`` plain bytes, at least one for each core there
    is. A task reads the seek tables of its bundles, then its frames only. Payloads are checked
    against their digest. The columns of ``RECORD``.
    """
    frames = stored(index.groupBy("bundle", "frame").agg(F.sum("length").alias("plain")), "warc-frames")
    size = frames.agg(F.sum("plain")).first()[0] or 0
    tasks = max(frames.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes))
    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        for batch in batches:
            wanted: dict[str, list[int]] = {}
            for row in batch.to_pylist():
                wanted.setdefault(row["bundle"], []).append(row["frame"])
            for bundle, frames in wanted.items():
                with store.open_input_file(f"{base}/{bundle}") as file:
                    table = frames_of(file)
                    for k in sorted(frames):
                        yield pa.RecordBatch.from_pylist(_rows(read_frame(file, table[k])), schema)

    # A number of partitions that is asked for is not merged by AQE, however small the rows are.
    return frames.select("bundle", "frame").repartition(tasks, "bundle", "frame").mapInArrow(read, RECORD)


def _rows(data: bytes) -> list[dict]:
    """The records of a frame, with the fields of ``RECORD``."""
    at, rows = 0, []
    while at < len(data):
        head, block, at = parse(data, at)
        sha = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response" and digest(block) != sha:
            raise ValueError(f"the payload of {head['WARC-Record-ID']} is damaged")
        url = head.get("WARC-Target-URI")
        rows.append(
            {
                "page_id": _page_id(head["WARC-Record-ID"]),
                "url": None if url is None else _unline(url),
                "payload": block,
                "payload_digest": sha,
                "payload_bytes": int(head["X-Payload-Length"]),
                "record_type": head["WARC-Type"],
                "refers_to": _page_id(head.get("WARC-Refers-To")),
            }
        )
    return rows


def read_record(folder: str, bundle: str, frame: int, start: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: reads the seek table and one frame."""
    store, base = filesystem(folder)
    with store.open_input_file(f"{base}/{bundle}") as file:
        data = read_frame(file, frames_of(file)[frame])
    headers, block, end = parse(data, start)
    if end - start != length:
        raise ValueError("the index is of another bundle")
    return headers, block
