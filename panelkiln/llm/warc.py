"""WARC archives whose records are compressed one by one with a Zstandard dictionary of their own.

An archive starts with a skippable frame that holds the dictionary, built
from the first records that the archive takes; every record follows as a frame of
its own, and a last skippable frame holds their number, so that an archive which
ends early is told from a whole one. Archives are written by Spark's text writer, so that they reach any
store that Spark reaches and a lost executor leaves no half-written file. That
writer ends each row with a line feed; a row of frames ends with the header of a skippable frame
of one byte, which the line feed fills, so that readers pass over it. The writer also
starts a new file after a fixed number of rows, and a new archive starts there.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

DICTIONARY_FRAME = 0x184D2A5D
FILLER_FRAME = 0x184D2A50
END_FRAME = 0x184D2A5E
_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
_FILLER = struct.pack("<II", FILLER_FRAME, 1)
_END = struct.Struct("<IIQ")

#: Bytes of frames that a row takes before the next one starts, and rows of an archive: about 128 MB, since Spark reads
#: it back as one binary value.
ROW_BYTES = 1 << 20
ROWS = 128

#: Bytes of records that an archive's dictionary is built from at most, and the dictionary's size.
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One WARC record. A revisit leaves the payload out; extension fields keep ids and the payload's length."""
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _id(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": " ".join(url.split()) if url else "",
        "WARC-Payload-Digest": "sha1:" + base32_sha1(payload),
        "Page-ID": "" if page_id is None else str(page_id),
        "Payload-Length": str(len(payload)),
    }
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _id(refers_to), "Refers-To-Page-ID": "" if refers_to is None else str(refers_to)}
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v)
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """The fields of ``RECORD``; the payload of a response is held against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if base32_sha1(payload) != digest:
            raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("Page-ID"), int(fields["Payload-Length"]), digest, kind, number("Refers-To-Page-ID"), fields.get("WARC-Target-URI"), payload


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """None where there is too little to learn from."""
    sample = sum(map(len, records))
    if len(records) < 16 or sample < 1 << 15:
        return None
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sample // 8), records, k=512, d=8)
    except zstandard.ZstdError:  # all alike, or shorter than the shortest match
        return None


def rows_of(records: Iterator[bytes], level: int = 6, rows: int = ROWS, row_bytes: int = ROW_BYTES) -> Iterator[bytes]:
    """Rows of as many archives as it takes, ``rows`` (3 at least) each but for the last: dictionary, frames, number of records."""
    following = next(records, None)
    while True:
        sample, size = [], 0
        while following is not None and size < SAMPLE_BYTES:
            sample.append(following)
            size += len(following)
            following = next(records, None)
        learned = dictionary(sample)
        raw = b"" if learned is None else learned.as_bytes()
        yield (struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw if raw else b"") + _FILLER
        press = zstandard.ZstdCompressor(level=level, dict_data=learned, write_checksum=True)
        made, count, frames, held = 1, 0, [], 0
        sample.reverse()
        while sample or following is not None:
            if made == rows - 1:
                break
            if sample:
                frame = press.compress(sample.pop())
            else:
                frame, following = press.compress(following), next(records, None)
            frames.append(frame)
            count, held = count + 1, held + len(frame)
            if held >= row_bytes:
                yield b"".join(frames) + _FILLER
                made, frames, held = made + 1, [], 0
        if frames:
            yield b"".join(frames) + _FILLER
        yield _END.pack(END_FRAME, 9, count)  # its last byte is the line feed
        if not sample and following is None:
            return
        if sample:  # taken for the dictionary, but for the next archive
            sample.reverse()
            records = chain(sample[1:], [] if following is None else [following], records)
            following = sample[0]


def read_frames(archive: bytes, step: int = 1 << 16, counted: bool = True) -> Iterator[bytes]:
    """The records of an archive, whoever wrote it; what ends early is an error.

    Archives of other writers don't say how many records they hold: read them with
    ``counted=False``, and a cut between two records goes unnoticed.
    """
    view, at, learned, read, ended = memoryview(archive), 0, None, 0, False
    unpress = zstandard.ZstdDecompressor()
    while at < len(view):
        if len(view) - at < 8:
            raise ValueError("the archive ends within a frame")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in _SKIPPABLE:
            if at + 8 + size > len(view):
                raise ValueError("the archive ends within a frame")
            if magic == DICTIONARY_FRAME and learned is None:
                learned = zstandard.ZstdCompressionDict(bytes(view[at + 8 : at + 8 + size]))
                unpress = zstandard.ZstdDecompressor(dict_data=learned)
            elif magic == END_FRAME and size == 9:
                if _END.unpack_from(view, at)[2] != read:
                    raise ValueError("the archive has lost records")
                ended = True
            at += 8 + size
            continue
        frame, out = unpress.decompressobj(), []
        while not frame.eof:
            if at >= len(view):
                raise ValueError("the archive ends within a record")
            part = view[at : at + step]
            out.append(frame.decompress(part))
            at += len(part) - len(frame.unused_data)
        read, ended = read + 1, False
        yield b"".join(out)
    if counted and not ended:
        raise ValueError("the archive has no end")


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, date: str = DATE, level: int = 6, rows: int = ROWS, row_bytes: int = ROW_BYTES
) -> None:
    """Write (page_id, url, html) as archives below ``folder``, one or more for each partition.

    Of records with equal payloads of at least ``least_bytes`` bytes, that with the largest
    page_id is the response and the others revisit it; rows that repeat the largest id
    are responses too. A null html is an empty payload, a null page_id the smallest.
    Other columns play no part; an empty table writes no record.
    """
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        (F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    last = own.groupBy("digest").agg(F.max("page_id").alias("response_id"))
    known = own.join(last, "digest").select(
        "page_id", "url", "payload", "response_id",
        (~F.col("page_id").eqNullSafe(F.col("response_id")) & (F.length("payload") >= least_bytes)).alias("revisit"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                columns = [batch.column(i) for i in range(5)]
                for i in range(batch.num_rows):
                    page_id, url, payload, response_id, revisit = (c[i].as_py() for c in columns)
                    yield record(page_id, url, payload, response_id, revisit, date)

        out, size = [], 0
        for row in rows_of(records(), level, rows, row_bytes):
            out.append(row)
            size += len(row)
            if size > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    archives = known.mapInArrow(scan, "value binary").select(F.col("value").cast("string"))
    archives.write.option("lineSep", "\n").option("maxRecordsPerFile", rows).text(folder)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives below ``folder``, in the columns of ``RECORD``.

    Records come as they were written: without a page id or url where the page had none, with an empty payload for a null
    one, repeated where rows were. A revisit has no payload. A folder of archives without records gives an empty table.
    An archive that ends early, has lost records or holds a damaged payload is an error.
    """
    names = [part.split()[0] for part in RECORD.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out, size = [], 0
                for data in read_frames(batch.column(0)[i].as_py()):
                    out.append(parse(data))
                    size += len(data)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(scan, RECORD)


#: DuckDB's way to the rows of the query.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT h, max(page_id) AS last_id FROM p GROUP BY h)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(p.h, CAST(5 * (k // 4) + 1 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)
         FOR k IN range(32)], '') AS payload_digest,
       CASE WHEN p.page_id IS NOT DISTINCT FROM r.last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM r.last_id THEN r.last_id END AS refers_to
FROM p JOIN r USING (h)
"""
