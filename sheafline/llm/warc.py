"""WARC archives in Zstandard: writing pages as records, and reading archives back.

An archive (`.warc.zst`) is one Zstandard frame per record, so any record can be read by itself. If it has a
dictionary, this stands in a leading skippable frame (magic 0x184D2A5D, length, then the dictionary, which may
itself be a Zstandard frame), and all record frames use it.

Writing: pages with equal payloads are found by digest and length; the one with the largest id becomes a response
with the payload, the others become revisits that refer to it and hold only HTTP headers. Shorter payloads than
`least` are always responses. Every task writes archives of about ARCHIVE bytes into the shared folder and trains
its dictionary on its own first records (TRAIN bytes at most); a task that runs again replaces its own files.

Reading: one task per archive, one record in memory at a time. Checked per record: version line, the headers that
the standard demands, header syntax, block length against Content-Length, one record in the frame and nothing after
its two line ends, block and payload digests. A record that fails has `error` set and its other fields as far as
known. What follows a damaged frame cannot be found, so it ends its archive with one such row. A zero-length archive
has no rows.

Null html is an empty payload, null urls are empty targets. Pages that repeat the id of a response are responses
too. A null id is a record whose page is null; ids compare with null as the smallest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.session import new_path
from .shared import filesystem, put, store

DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
ARCHIVE = 32 << 20
TRAIN = 1 << 20
DICTIONARY = 32 << 10
LONGEST_HEADER = 1 << 20
DATE = "2000-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("warc-record-id", "content-length", "warc-date", "warc-type")
READ_SCHEMA = ("archive STRING, offset BIGINT, record_id STRING, record_type STRING, target STRING, date STRING, "
               "refers_to STRING, payload_bytes BIGINT, payload_digest STRING, payload BINARY, error STRING")


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- writing ------------------------------------------------------------------------------------

def _record(page_id, url, payload: bytes, length: int, digest: str, refers_to) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
            f"WARC-Block-Digest: sha1:{digest_of(block)}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _archive(records: list[bytes]) -> bytes:
    samples, size = [], 0
    for r in records:
        samples.append(r)
        size += len(r)
        if size >= TRAIN:
            break
    try:
        known = zstandard.train_dictionary(DICTIONARY, samples)
    except zstandard.ZstdError:  # too few or too uniform records
        known = None
    packer = zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=True)
    out = []
    if known is not None:
        body = zstandard.ZstdCompressor(level=9).compress(known.as_bytes())
        out = [struct.pack("<II", DICTIONARY_MAGIC, len(body)), body]
    return b"".join(out + [packer.compress(r) for r in records])


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, serial, records, size, done = TaskContext.get().partitionId(), 0, [], 0, []

        def close():
            nonlocal serial, records, size
            name = f"{folder}/part-{part:06d}-{serial:04d}.warc.zst"
            put(name, _archive(records))
            done.append((name, len(records)))
            serial, records, size = serial + 1, [], 0

        for batch in batches:
            ids, urls, pages, lengths, digests, refs = batch.columns
            for i in range(batch.num_rows):
                html = pages[i].as_buffer()
                payload = b"" if html is None else html.to_pybytes()
                hexed = digests[i].as_py()
                record = _record(ids[i].as_py(), urls[i].as_py(), payload, lengths[i].as_py(),
                                 base64.b32encode(bytes.fromhex(hexed)).decode(), refs[i].as_py())
                records.append(record)
                size += len(record)
                if size >= ARCHIVE:
                    close()
        if records:
            close()
        yield pa.RecordBatch.from_pydict({"archive": pa.array([d[0] for d in done], pa.string()),
                                          "records": pa.array([d[1] for d in done], pa.int64())})

    return write


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0,
                   columns: tuple[str, str, str] = ("page_id", "url", "html")) -> DataFrame:
    """Writes every page as a record below `folder` (default: a new one in the shared folder).

    Returns archive (path) and records, one row per archive."""
    folder = folder or new_path(pages.sparkSession, "warc")
    page_id, url, html = (F.col(c) for c in columns)
    pages = pages.select(page_id.cast("long").alias("page_id"), url.cast("string").alias("url"),
                         F.coalesce(html, F.lit("")).alias("html"))
    pages = pages.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "digest": F.sha1(F.encode("html", "UTF-8"))})
    groups = (pages.where(F.col("payload_bytes") >= least).groupBy("digest", "payload_bytes")
              .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"))
    groups = store(groups, "warc-copies")  # as a table: the join below can then split a hot digest
    plan = pages.join(groups, ["digest", "payload_bytes"], "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    plan = plan.select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "payload_bytes", "digest",
                       F.when(revisit, F.col("original")).alias("refers_to"))
    return store(plan.mapInArrow(_writer(folder), "archive STRING, records BIGINT"), "warc-manifest")


# ---- reading ------------------------------------------------------------------------------------

class _Source:
    """Bytes of a stream, some at a time."""

    def __init__(self, stream, step: int = 1 << 20):
        self.stream, self.step, self.buffer, self.offset = stream, step, b"", 0

    def fill(self, n: int) -> bool:
        while len(self.buffer) < n:
            more = self.stream.read(self.step)
            if not more:
                return False
            self.buffer += more
        return True

    def take(self, n: int) -> bytes:
        self.fill(n)
        data, self.buffer = self.buffer[:n], self.buffer[n:]
        self.offset += len(data)
        return data


def _frames(source: _Source) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(offset, content, error) of every frame that holds a record."""
    known, leading = None, True
    while source.fill(1):
        at = source.offset
        if not source.fill(8):
            yield at, None, "truncated frame"
            return
        magic, length = struct.unpack("<II", source.buffer[:8])
        if magic in SKIPPABLE:
            source.take(8)
            body = source.take(length)
            if len(body) < length:
                yield at, None, "truncated skippable frame"
                return
            if leading and magic == DICTIONARY_MAGIC:
                try:
                    if body[:4] == struct.pack("<I", FRAME_MAGIC):
                        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                    known = zstandard.ZstdCompressionDict(body)
                except zstandard.ZstdError as e:
                    yield at, None, f"bad dictionary: {e}"
                    return
            leading = False
            continue
        leading = False
        unpack = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
        parts = []
        try:
            while not unpack.eof and source.fill(1):
                data = source.take(len(source.buffer))
                parts.append(unpack.decompress(data))
                if unpack.eof and unpack.unused_data:
                    source.offset -= len(unpack.unused_data)
                    source.buffer = unpack.unused_data + source.buffer
        except zstandard.ZstdError as e:
            yield at, None, f"bad frame: {e}"
            return
        if not unpack.eof:
            yield at, None, "truncated frame"
            return
        yield at, b"".join(parts), None


def _fields(lines: list[bytes]) -> tuple[dict[str, str], str | None]:
    found, last, error = {}, None, None
    for line in lines:
        if line[:1] in (b" ", b"\t") and last:
            found[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon or not name or re.search(rb"[\x00-\x20\x7f]", name):
            error = error or "bad header line"
            continue
        last = name.decode("latin-1").lower()
        if last in found and last != "warc-concurrent-to":
            error = error or f"header {last} twice"
        found[last] = value.strip().decode("utf-8", "replace")
    return found, error


def parse_record(data: bytes) -> dict:
    """The fields of one record; `error` says what is wrong with it."""
    out: dict = {"error": None}

    def wrong(what: str) -> None:
        out["error"] = out["error"] or what

    end = data.find(b"\r\n\r\n", 0, LONGEST_HEADER)
    if end < 0:
        return out | {"error": "no end of headers"}
    first, *lines = data[:end].split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", first):
        wrong("bad version line")
    head, error = _fields(lines)
    if error:
        wrong(error)
    for name in MANDATORY:
        if not head.get(name):
            wrong(f"no {name}")
    if head.get("warc-date") and not re.fullmatch(r"\d{4}(-\d\d(-\d\d(T\d\d:\d\d(:\d\d(\.\d{1,9})?)?Z)?)?)?", head["warc-date"]):
        wrong("bad warc-date")
    out |= {"record_id": head.get("warc-record-id"), "record_type": head.get("warc-type"), "target": head.get("warc-target-uri"),
            "date": head.get("warc-date"), "refers_to": head.get("warc-refers-to")}
    length = head.get("content-length", "")
    if not re.fullmatch("0*[0-9]{1,18}", length):
        wrong("bad content-length")
        return out
    stated = int(length[-18:])  # more digits are zeros in front
    block, tail = data[end + 4:end + 4 + stated], data[end + 4 + stated:]
    if len(block) != stated:
        wrong("block shorter than content-length")
    elif tail != b"\r\n\r\n":
        wrong("block longer than content-length, or bytes after the record")
    said = head.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:] != digest_of(block):
        wrong("block digest differs")
    payload, size = block, len(block)
    if head.get("content-type", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        if cut < 0:
            wrong("no end of HTTP headers")
        else:
            http, error = _fields(block[:cut].split(b"\r\n")[1:])
            if error:
                wrong(f"HTTP: {error}")
            payload = block[cut + 4:]
            size = len(payload)
            stated = http.get("content-length")
            if stated is not None and not re.fullmatch("0*[0-9]{1,18}", stated):
                wrong("HTTP: bad content-length")
            elif stated is not None and head.get("warc-type") == "revisit":
                size = int(stated[-18:])
            elif stated is not None and int(stated[-18:]) != size:
                wrong("payload length differs from HTTP content-length")
    said = head.get("warc-payload-digest", "")
    if head.get("warc-type") == "revisit":
        out |= {"payload": None, "payload_digest": said.removeprefix("sha1:") or None}
        if not head.get("warc-profile"):
            wrong("revisit without profile")
    else:
        out |= {"payload": payload, "payload_digest": digest_of(payload)}
        if said.startswith("sha1:") and said[5:] != out["payload_digest"]:
            wrong("payload digest differs")
    return out | {"payload_bytes": size}


def _reader(columns: list[tuple[str, pa.DataType]], batch_bytes: int = 4 << 20):
    def pack(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({c: pa.array([r.get(c) for r in rows], t) for c, t in columns})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store_, name = filesystem(path)
                rows, size = [], 0
                with store_.open_input_stream(name, compression=None) as stream:
                    for offset, data, error in _frames(_Source(stream)):
                        rows.append({"archive": path, "offset": offset} | ({"error": error} if error else parse_record(data)))
                        size += len(rows[-1].get("payload") or b"") + 500
                        if size > batch_bytes:
                            yield pack(rows)
                            rows, size = [], 0
                if rows:
                    yield pack(rows)

    return read


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives listed in column `archive`, as READ_SCHEMA says (without payload on request).

    Paths may be of any store that pyarrow reaches. Archives are dealt out one per task, up to the shuffle width."""
    spark = archives.sparkSession
    kinds = {"STRING": pa.string(), "BIGINT": pa.int64(), "BINARY": pa.binary()}
    columns = [(c, kinds[t]) for c, t in (x.split() for x in READ_SCHEMA.split(", ")) if payloads or c != "payload"]
    schema = ", ".join(x for x in READ_SCHEMA.split(", ") if payloads or not x.startswith("payload BINARY"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("archive").repartition(width, "archive").mapInArrow(_reader(columns), schema)
