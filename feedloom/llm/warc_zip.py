"""Web archives (WARC) packed in ZIP files: writing them, and reading records by range without unpacking.

An archive holds ``archive/data.warc.gz``, records compressed one by one, and ``indexes/index.cdx``, a line per record
with where it lies. Both are stored in the ZIP file as they are, so a record can be read by its range. Reading takes
two steps: one task per archive reads its directories (classic or ZIP64) and index and cuts the records into ranges of
some megabytes; then many tasks read ranges.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import blocks
from feedloom.operators.joins import lookup, settled
from feedloom.session import scratch
from feedloom.sources.files import filesystem_of, store_options

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Payloads of fewer bytes are never revisits.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
CHUNK = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "urn:x-page:"
_BLANK = re.compile(rb"[\r\n]*")
_DATE = "2020-01-01T00:00:00Z"


# --- writing


def _record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, revisit: bool) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_RECORD}{'' if page is None else page}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        fields.append(f"WARC-Target-URI: {quote(url, safe='!#$&()*+,/:;=?@[]~-._ ')}")
    if revisit:
        fields += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_RECORD}{refers}>"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _store(folder: str, records: list[bytes], options: dict[str, str]) -> tuple[str, int, int]:
    lines, at = [], 0
    for r in records:
        lines.append(f"{at} {len(r)}\n")
        at += len(r)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr(zipfile.ZipInfo(DATA), b"".join(records))
        archive.writestr(zipfile.ZipInfo(INDEX), "".join(lines))
    path = f"{folder}/part-{uuid.uuid4().hex}.zip"
    filesystem, at_path = filesystem_of(path, options)
    filesystem.create_dir(at_path.rpartition("/")[0], recursive=True)
    with filesystem.open_output_stream(at_path) as out:
        out.write(held.getbuffer())
    return path, held.tell(), len(records)


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int, options: dict[str, str]) -> Iterator[pa.RecordBatch]:
    def stored(records: list[bytes]) -> pa.RecordBatch:
        path, size, count = _store(folder, records, options)
        return pa.RecordBatch.from_pydict({"path": pa.array([path]), "length": pa.array([size]), "records": pa.array([count])})

    records, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit")), strict=True):
            records.append(_record(*(v.as_py() for v in row)))
            size += len(records[-1])
            if size >= archive_bytes:
                yield stored(records)
                records, size = [], 0
    if records:
        yield stored(records)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row into ZIP archives below ``folder``, which all tasks must reach; the archives written:
    ``path``, ``length``, ``records``.

    The payload is ``html`` in UTF-8, a null one empty. Of rows with equal payloads of at least ``REVISIT_BYTES``
    bytes the one with the largest ``page_id`` becomes a response, the others revisits that refer to it; shorter ones
    are all responses. Rows that share that largest id are all responses; null ids are smaller than any, and if there
    are no others all are responses. A null ``url`` is left out. An empty table gives no archive. Other columns are
    ignored.

    Payloads are not shuffled for large groups of equal pages: the larger groups' digests alone are grouped, and each
    row looks up the one of its own. Archives of tasks that failed stay behind unlisted.
    """
    options = store_options(pages.sparkSession)
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    sizes = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("digest"), F.length(payload).alias("n"))
    repeated = sizes.where(F.col("n") >= REVISIT_BYTES).groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    marked = lookup(rows, settled(repeated.drop("n"), "repeated-payloads"), ["digest"])
    revisit = F.col("refers_to").isNotNull() & ~F.col("refers_to").eqNullSafe(F.col("page_id"))
    marked = marked.select("page_id", "url", "payload", "digest", "refers_to", revisit.alias("revisit"))
    return settled(marked.mapInArrow(lambda b: _write(b, folder, archive_bytes, options), "path string, length long, records long"), "archives")


# --- reading


@dataclass
class Member:
    """A file in an archive: its name, whether it is stored as it is, its size, and where its header is."""

    name: str
    stored: bool
    size: int
    header: int


def members(file, length: int) -> Iterator[Member]:
    """The central directory of a ZIP file, classic or ZIP64. Reads the end of the file and the directory only."""
    tail_at = max(0, length - (22 + 65535 + 20))
    file.seek(tail_at)
    tail = file.read(length - tail_at)
    end = len(tail) - 22
    while end >= 0:
        end = tail.rfind(b"PK\5\6", 0, end + 4)
        if end < 0 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
        end -= 1
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    count, size, offset = struct.unpack_from("<HII", tail, end + 10)
    start_of_end = tail_at + end
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\6\7":
        start_of_end = struct.unpack_from("<Q", tail, end - 12)[0]
        file.seek(start_of_end)
        wide = file.read(56)
        if wide[:4] != b"PK\6\6":
            raise ValueError("broken ZIP64 end of central directory")
        count, size, offset = struct.unpack_from("<QQQ", wide, 32)
    shift = start_of_end - size - offset  # bytes put before the archive
    file.seek(offset + shift)
    directory, at = file.read(size), 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\1\2":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, full = struct.unpack_from("<II", directory, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, at + 28)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n_name]
        extra, i = directory[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while i + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, i)
            if kind == 1:
                # Only the fields that do not fit are there, in this order.
                wide, k = extra[i + 4 : i + 4 + n], 0
                if full == 0xFFFFFFFF:
                    full, k = struct.unpack_from("<Q", wide, k)[0], k + 8
                if packed == 0xFFFFFFFF:
                    packed, k = struct.unpack_from("<Q", wide, k)[0], k + 8
                if header == 0xFFFFFFFF:
                    header = struct.unpack_from("<Q", wide, k)[0]
            i += 4 + n
        yield Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method == 0 and not flags & 1, packed, header + shift)
        at += 46 + n_name + n_extra + n_comment


def data_start(file, member: Member) -> int:
    """Where a member's bytes begin: after its local header, whose lengths are its own."""
    file.seek(member.header)
    head = file.read(30)
    if head[:4] != b"PK\3\4":
        raise ValueError(f"broken local header of {member.name}")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def _ranges(batches: Iterator[pa.RecordBatch], range_bytes: int, options: dict[str, str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
            filesystem, at_path = filesystem_of(path, options)
            with filesystem.open_input_file(at_path) as file:
                found = list(members(file, length))
                data = [m for m in found if m.name.endswith((".warc.gz", ".warc"))]
                if any(not m.stored for m in data):
                    raise ValueError(f"{path}: archives must be stored, not compressed once more")
                index = {m.name: m for m in found if m.stored}.get(INDEX) if [m.name for m in data] == [DATA] else None
                out = []
                for member in data:
                    start = data_start(file, member)
                    cuts = _cuts(file, index, range_bytes) if index else []
                    edges = [0, *cuts, member.size]
                    out += [(path, start + a, start + b, member.name.endswith(".gz")) for a, b in zip(edges, edges[1:], strict=False) if b > a]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "start", "end", "packed"])


def _cuts(file, index: Member, range_bytes: int) -> list[int]:
    """Offsets at which to cut the records into ranges of about a size; the index is read in chunks."""
    at, end, rest, cuts, last = data_start(file, index), 0, b"", [], 0
    end = at + index.size
    while at < end:
        file.seek(at)
        chunk = file.read(min(CHUNK, end - at))
        at += len(chunk)
        *lines, rest = (rest + chunk).split(b"\n")
        for line in lines:
            offset = int(line.split()[0])
            if offset - last >= range_bytes:
                cuts.append(offset)
                last = offset
    return cuts


def _chunks(file, start: int, end: int) -> Iterator[bytes]:
    while start < end:
        file.seek(start)
        chunk = file.read(min(CHUNK, end - start))
        if not chunk:
            raise ValueError("archive ends early")
        start += len(chunk)
        yield chunk


def records(chunks: Iterator[bytes], packed: bool) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and blocks of consecutive records; ``packed`` ones are gzip members, one each or
    several records to one."""
    held, at, looked, need, headers = bytearray(), 0, 0, -1, {}
    for piece in _unpacked(chunks) if packed else chunks:
        held += piece
        while True:
            if need < 0:
                at = _BLANK.match(held, at).end()
                end = held.find(b"\r\n\r\n", max(at, looked))
                if end < 0:
                    looked = max(at, len(held) - 3)
                    break
                headers = _headers(bytes(held[at:end]))
                at, looked, need = end + 4, 0, int(headers["content-length"])
            if len(held) - at < need:
                break
            yield headers, bytes(held[at : at + need])
            at, need = at + need, -1
        # What is left moves once per piece, not once per record.
        del held[:at]
        at, looked = 0, max(0, looked - at)
    if need >= 0 or held.strip():
        raise ValueError("a record is cut off")


def _unpacked(chunks: Iterator[bytes]) -> Iterator[bytes]:
    unpacker = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            yield unpacker.decompress(chunk)
            chunk = unpacker.unused_data
            if unpacker.eof:
                unpacker = zlib.decompressobj(31)


def _headers(head: bytes) -> dict[str, str]:
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _page(identifier: str) -> int | None:
    text = identifier.strip("<>").removeprefix(_RECORD)
    return int(text) if text.lstrip("-").isdigit() else None


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool, options: dict[str, str]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    rows, size = [], 0
    for batch in batches:
        for path, start, end, packed in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end", "packed")), strict=True):
            filesystem, at_path = filesystem_of(path, options)
            with filesystem.open_input_file(at_path) as file:
                for headers, block in records(_chunks(file, start, end), packed):
                    if headers.get("warc-type") not in ("response", "revisit"):
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    revisit = headers["warc-type"] == "revisit"
                    digest = headers["warc-payload-digest"].partition(":")[2]
                    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{path}: payload of {headers['warc-record-id']} is not what its digest says")
                    lengths = [x.partition(b":")[2] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                    url = headers.get("warc-target-uri")
                    rows.append((
                        _page(headers["warc-record-id"]),
                        None if url is None else unquote(url),
                        int(lengths[0]) if revisit and lengths else len(payload),
                        digest,
                        headers["warc-type"],
                        _page(headers["warc-refers-to"]) if revisit else None,
                        payload if with_payload and not revisit else None,
                    ))
                    size += len(payload) if with_payload else 0
                    if len(rows) == 4096 or size >= blocks.SLICE_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
    if rows:
        yield batch_of(rows)


def read_archives(archives: DataFrame, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The response and revisit records of ZIP-packaged WARC files (``path``, ``length``).

    Result: ``page_id``, ``url``, ``payload_bytes``, ``payload_digest`` (SHA-1), ``record_type``, ``refers_to`` (of
    revisits), and the ``payload`` of responses (null for revisits, or without ``with_payload``). Payloads are held
    against their digests. Members that are WARC files must be stored; with an index they are cut into ranges, without
    one a member is one range. Broken archives and records fail the job. No archives, or empty ones, give no rows.
    """
    tasks, options = blocks.buckets_of(archives), store_options(archives.sparkSession)
    parts = archives.select("path", "length").repartition(tasks, "path").mapInArrow(
        lambda b: _ranges(b, range_bytes, options), "path string, start long, end long, packed boolean"
    )
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    return parts.repartition(tasks, "path", "start").mapInArrow(lambda b: _read(b, with_payload, options), schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as archives to the shared scratch folder and read back: a row per page, without payloads."""
    archives = write_archives(pages, scratch(pages.sparkSession, "warc"))
    return read_archives(archives, with_payload=False).drop("payload")
