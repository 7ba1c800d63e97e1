"""WARC archives with a two-level capture index.

Pages are written as WARC records, each a gzip member of its own, into archives in the shared folder; every task writes
archives of its own and hands back where each record lies. Pages with equal payloads are found by hash, and all but one
become revisit records without a payload.

The index holds one line per record, sorted by the url with its host reversed, so that a domain's pages lie together. The
lines are cut into blocks that are compressed one by one; a directory with the first line of each block ends every part
of the index, and the parts have a list of their first lines. A search is three binary searches (parts, directory, lines
of one block), then a range read of the record. Searched keys are sorted, so that a task reads each block once.

A task that is lost and repeated writes under new names; only the files named by the rows of the finished attempt are
used. Archives go through ``pyarrow.fs``, which takes local paths and the stores that it knows by URI. A payload is held
whole, everything else in bounded pieces.

Defined cases: a NULL payload is empty, a NULL url has no target header and an empty key. Control characters and blanks
of a url are percent-encoded in headers. Of pages with equal payloads those with the largest id are responses (several
if that row repeats); a NULL id is smaller than all others, and equal payloads that all have a NULL id are responses. An
empty table has no archives.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basinspark.llm.common import stored
from basinspark.session import broadcast_if_small, fresh_folder

RECORD_END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
ID_PREFIX = "urn:x-page:"
UNPRINTABLE = re.compile(r"[\x00-\x20\x7f]")
HOST = re.compile(r"^([^/?#]*)")
READ_BYTES = 1 << 16
ROWS = 4096

CAPTURE = "page_id string, line string, archive string, offset long, size long"
PART = "first string, path string, directory_offset long, directory_size long, captures long"
READ = "page_id string, record_type string, payload_bytes long, payload_digest string, refers_to string, probe string"
FOUND = "probe string, page_id string, record_type string, archive string, offset long, size long, payload_bytes long, payload_digest string, payload binary"


@dataclass(frozen=True)
class ArchiveParameters:
    least_shared: int = 1000  # bytes from which equal payloads are written once
    archive_bytes: int = 1 << 30  # an archive is closed beyond this size
    segment_bytes: int = 32 << 20  # what one read of the archives covers
    block_lines: int = 3000  # lines of one compressed index block
    level: int = 6  # of compression
    date: str = "2024-01-01T00:00:00Z"  # of capture, as pages have none


@dataclass(frozen=True)
class Archive:
    """Where the records and the index lie: tables of captures (one row per record) and of index parts."""

    captures: DataFrame
    parts: DataFrame


def capture_key(url: str | None) -> str:
    """``http://www.Example.com/a?b`` as ``com,example,www)/a?b``: host reversed, in lower case, then all that follows."""
    if url is None:
        return ""
    rest = UNPRINTABLE.sub(lambda m: f"%{ord(m[0]):02X}", url)
    rest = rest[rest.find("://") + 3 :] if "://" in rest else rest
    host = HOST.match(rest)[1]
    return ",".join(reversed(host.lower().split("."))) + ")" + rest[len(host) :]


def exact_probe(url: str | None, page_id: str | None, digest: str) -> str:
    """How the index line of a record begins, whose url, page and payload are known."""
    return f"{capture_key(url)}\t{record_name(page_id)}\t{digest}\t"


def record_name(page_id: str | None) -> str:
    return ID_PREFIX if page_id is None else ID_PREFIX + "=" + quote(page_id, safe="")


def page_of(name: str) -> str | None:
    return None if name == ID_PREFIX else unquote(name[len(ID_PREFIX) + 1 :])


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(uri)
    return store, path.rstrip("/")


def record(kind: str, headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One WARC record as a gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{name}: {value}" for name, value in headers), f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines)).encode() + RECORD_END
    return packer.compress(head) + packer.compress(block) + packer.compress(RECORD_END) + packer.flush()


def page_record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers: tuple[str | None, str | None] | None, params: ArchiveParameters) -> bytes:
    """A response, or a revisit of the page (id, url) that ``refers`` names."""
    headers = [("WARC-Record-ID", f"<{record_name(page_id)}>"), ("WARC-Date", params.date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    target = lambda value: [] if value is None else [UNPRINTABLE.sub(lambda m: f"%{ord(m[0]):02X}", value)]
    headers += [("WARC-Target-URI", u) for u in target(url)]
    if refers is None:
        block = f"{HTTP_HEAD}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
        return record("response", [*headers, ("Content-Type", "application/http;msgtype=response")], block, params.level)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_name(refers[0])}>"), ("WARC-Refers-To-Date", params.date)]
    headers += [("WARC-Refers-To-Target-URI", u) for u in target(refers[1])]
    return record("revisit", [*headers, ("Content-Type", "application/http;msgtype=response")], f"{HTTP_HEAD}\r\n".encode(), params.level)


class ArchiveWriter:
    """Records one after the other into archives of bounded size."""

    def __init__(self, folder: str, params: ArchiveParameters) -> None:
        self.store, self.folder = _folder(folder)
        self.uri = folder.rstrip("/")
        self.params = params
        self.stream = None
        self.path, self.offset = "", 0

    def add(self, member: bytes) -> tuple[str, int]:
        """Archive and offset of the record."""
        if self.stream is not None and self.offset + len(member) > self.params.archive_bytes:
            self.close()
        if self.stream is None:
            name = f"capture-{uuid.uuid4().hex}.warc.gz"
            self.path, self.stream = f"{self.uri}/{name}", self.store.open_output_stream(f"{self.folder}/{name}", compression=None)
            head = record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", self.params.date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", self.params.level)
            self.stream.write(head)
            self.offset = len(head)
        place = self.offset
        self.stream.write(member)
        self.offset += len(member)
        return self.path, place

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def _written(folder: str, params: ArchiveParameters):
    """Task function: rows (page_id, url, payload, refers_id, refers_url, revisit) to records and their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(folder, params)
        for batch in batches:
            rows = []
            ids, urls, payloads, refers_ids, refers_urls, revisits = batch.columns
            for i in range(batch.num_rows):
                page_id, url = ids[i].as_py(), urls[i].as_py()
                payload = payloads[i].as_buffer().to_pybytes() if payloads[i].is_valid else b""
                digest = hashlib.sha1(payload).hexdigest()
                refers = (refers_ids[i].as_py(), refers_urls[i].as_py()) if revisits[i].as_py() else None
                member = page_record(page_id, url, payload, digest, refers, params)
                path, offset = writer.add(member)
                kind = "response" if refers is None else "revisit"
                line = exact_probe(url, page_id, digest) + f"{kind}\t{path}\t{offset}\t{len(member)}"
                rows.append({"page_id": page_id, "line": line, "archive": path, "offset": offset, "size": len(member)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("page_id", pa.string()), ("line", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("size", pa.int64())]))
        writer.close()

    return run


def _indexed(folder: str, params: ArchiveParameters):
    """Task function: sorted lines to one part of the index, whose directory stands at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _folder(folder)
        path, stream, directory, block, offset, captures = "", None, [], [], 0, 0

        def flush() -> None:
            nonlocal offset
            packed = zlib.compress(b"\n".join(block))
            stream.write(packed)
            directory.append(b"%s\t%d\t%d" % (block[0], offset, len(packed)))
            offset += len(packed)
            block.clear()

        for batch in batches:
            for value in batch.column(0):
                if stream is None:
                    name = f"index-{uuid.uuid4().hex}"
                    path, stream = f"{folder.rstrip('/')}/{name}", store.open_output_stream(f"{base}/{name}", compression=None)
                block.append(value.as_buffer().to_pybytes())
                captures += 1
                if len(block) >= params.block_lines:
                    flush()
        if stream is None:
            return
        if block:
            flush()
        packed = zlib.compress(b"\n".join(directory))
        stream.write(packed)
        stream.close()
        first = directory[0].rsplit(b"\t", 2)[0].decode()
        yield pa.RecordBatch.from_pylist([{"first": first, "path": path, "directory_offset": offset, "directory_size": len(packed), "captures": captures}])

    return run


def written(pages: DataFrame, params: ArchiveParameters = ArchiveParameters(), page_id: str = "page_id", url: str = "url", payload: str = "html") -> Archive:
    """Archives and index of all pages, in the shared folder. They are written when this is called.

    The table of shared payloads has one row per payload with copies, whatever their number. It is broadcast where it is
    small, and joined by a shuffle that splits hot payloads otherwise.
    """
    spark = pages.sparkSession
    folder = fresh_folder(spark, "archive")
    store, path = _folder(folder)
    store.create_dir(path, recursive=True)
    body = F.coalesce(F.encode(F.col(payload).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("payload_key", F.when(F.octet_length("payload") >= params.least_shared, F.sha2("payload", 256)))
    top = F.max(F.struct("page_id", "url")).alias("top")
    shared = rows.where("payload_key IS NOT NULL").groupBy(F.col("payload_key").alias("shared_key")).agg(top, F.count("*").alias("copies"))
    shared = shared.where("copies > 1 AND top.page_id IS NOT NULL").select("shared_key", F.col("top.page_id").alias("refers_id"), F.col("top.url").alias("refers_url"))
    shared, _ = stored(shared, "shared")
    marked = rows.join(broadcast_if_small(shared), F.col("payload_key") == F.col("shared_key"), "left")
    revisit = F.col("refers_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_id"))
    marked = marked.select(F.col("page_id").cast("string"), "url", "payload", F.col("refers_id").cast("string"), "refers_url", revisit.alias("revisit"))
    captures, _ = stored(marked.mapInArrow(_written(folder, params), CAPTURE), "captures")
    parts, _ = stored(captures.select("line").orderBy("line").mapInArrow(_indexed(folder, params), PART), "parts")
    return Archive(captures, parts)


def parsed(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, with names in lower case, and block of a record."""
    end = content.index(RECORD_END)
    headers = dict(line.split(": ", 1) for line in content[:end].decode().split("\r\n")[1:])
    headers = {name.lower(): value for name, value in headers.items()}
    begin = end + len(RECORD_END)
    size = int(headers["content-length"])
    if content[begin + size :] != RECORD_END:
        raise ValueError("A record does not end where its length says.")
    return headers, content[begin : begin + size]


def payload_of(headers: dict[str, str], block: bytes) -> tuple[bytes, str]:
    """Payload of a response with its digest, which is compared with the header."""
    payload = block[block.index(RECORD_END) + len(RECORD_END) :]
    digest = hashlib.sha1(payload).hexdigest()
    if headers["warc-payload-digest"] != f"sha1:{digest}":
        raise ValueError(f"The payload of {headers['warc-record-id']} does not have its digest.")
    return payload, digest


def records_between(stream, begin: int, end: int) -> Iterator[bytes]:
    """The records whose gzip members fill the bytes from ``begin`` to ``end``, read in small pieces."""
    stream.seek(begin)
    rest, place = b"", begin
    while place < end or rest:
        unpacker, pieces = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest:
                rest = stream.read(min(READ_BYTES, end - place))
                place += len(rest)
                if not rest:
                    raise ValueError("An archive ends within a record.")
            pieces.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
        yield b"".join(pieces)


def _between(headers: dict[str, str], name: str) -> str:
    return headers[name].strip("<>")


def _reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: segments (archive, begin, end) to the facts of their records; revisits get the probe of their response."""
    schema = pa.schema([("page_id", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("probe", pa.string())])
    for batch in batches:
        for segment in batch.to_pylist():
            store, path = _folder(segment["archive"])
            rows = []
            with store.open_input_file(path) as stream:
                for content in records_between(stream, segment["begin"], segment["end"]):
                    headers, block = parsed(content)
                    row = {"page_id": page_of(_between(headers, "warc-record-id")), "record_type": headers["warc-type"]}
                    if row["record_type"] == "response":
                        payload, row["payload_digest"] = payload_of(headers, block)
                        row["payload_bytes"] = len(payload)
                    else:
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        row["refers_to"] = page_of(_between(headers, "warc-refers-to"))
                        row["probe"] = exact_probe(headers.get("warc-refers-to-target-uri"), row["refers_to"], digest)
                    rows.append(row)
                    if len(rows) >= ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_records(archive: Archive, params: ArchiveParameters = ArchiveParameters()) -> DataFrame:
    """One row per record, read from the archives in segments that tasks share out."""
    place = F.floor(F.col("offset") / params.segment_bytes)
    segments = archive.captures.groupBy("archive", place.alias("place")).agg(F.min("offset").alias("begin"), F.max(F.col("offset") + F.col("size")).alias("end"))
    segments, _ = stored(segments.select("archive", "begin", "end"), "segments")
    n = segments.count()
    # The rows are few and tiny, each a read of up to one segment: their tasks are counted, not sized by their bytes.
    spread = segments.repartitionByRange(max(1, min(n, max(256, n // 8))), "archive", "begin")
    return spread.mapInArrow(_reading, READ)


class CaptureIndex:
    """Binary searches in an index; the last part's directory and its last block are kept."""

    def __init__(self, parts: list[tuple[bytes, str, int, int]]) -> None:
        self.parts = sorted(parts)
        self.firsts = [first for first, *_ in self.parts]
        self.part, self.block = -1, (-1, -1)
        self.directory: list[tuple[bytes, int, int]] = []
        self.lines: list[bytes] = []

    def _open(self, part: int) -> None:
        if self.part != part:
            _, path, offset, size = self.parts[part]
            store, path = _folder(path)
            with store.open_input_file(path) as stream:
                entries = zlib.decompress(stream.read_at(size, offset)).split(b"\n")
            self.directory = [(first, int(at), int(n)) for first, at, n in (e.rsplit(b"\t", 2) for e in entries)]
            self.starts = [first for first, _, _ in self.directory]
            self.part = part

    def _lines(self, part: int, block: int) -> list[bytes]:
        if self.block != (part, block):
            _, offset, size = self.directory[block]
            store, path = _folder(self.parts[part][1])
            with store.open_input_file(path) as stream:
                self.lines = zlib.decompress(stream.read_at(size, offset)).split(b"\n")
            self.block = (part, block)
        return self.lines

    def find(self, probe: bytes) -> Iterator[bytes]:
        """The lines that begin with ``probe``, in order."""
        for part in range(max(0, bisect_left(self.firsts, probe) - 1), len(self.parts)):
            if self.firsts[part] > probe and not self.firsts[part].startswith(probe):
                return
            self._open(part)
            for block in range(max(0, bisect_left(self.starts, probe) - 1), len(self.directory)):
                if self.starts[block] > probe and not self.starts[block].startswith(probe):
                    return
                lines = self._lines(part, block)
                for place in range(bisect_left(lines, probe), len(lines)):
                    if not lines[place].startswith(probe):
                        return
                    yield lines[place]


def _searching(parts, first_only: bool, with_payload: bool):
    """Task function: sorted probes to the records whose lines begin with them, read by range; ``parts`` is broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, streams = CaptureIndex(parts.value), OrderedDict()
        schema = pa.schema([("probe", pa.string()), ("page_id", pa.string()), ("record_type", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for probe in batch.column(0).to_pylist():
                rows, held = [], 0
                for line in index.find(probe.encode()):
                    _, name, _, kind, path, offset, size = line.decode().split("\t")
                    if path not in streams:
                        store, place = _folder(path)
                        streams[path] = store.open_input_file(place)
                        if len(streams) > 16:
                            streams.popitem(last=False)[1].close()
                    row = {"probe": probe, "page_id": page_of(name), "record_type": kind, "archive": path, "offset": int(offset), "size": int(size)}
                    if kind == "response":
                        content = next(records_between(streams[path], row["offset"], row["offset"] + row["size"]))
                        payload, row["payload_digest"] = payload_of(*parsed(content))
                        row["payload_bytes"] = len(payload)
                        if with_payload:
                            row["payload"] = payload
                            held += len(payload)
                    rows.append(row)
                    if len(rows) >= ROWS or held > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                    if first_only:
                        break
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
        for stream in streams.values():
            stream.close()

    return run


def searched(archive: Archive, probes: DataFrame, first_only: bool = False, with_payload: bool = True) -> DataFrame:
    """The records whose index lines begin with the texts of the column ``probe``, each read from its archive.

    ``probes`` should hold every text once. Only the first lines of the index parts, as many as the sort had partitions,
    go to the tasks whole.
    """
    spark = probes.sparkSession
    parts = [(r["first"].encode(), r["path"], r["directory_offset"], r["directory_size"]) for r in archive.parts.collect()]
    probes, _ = stored(probes.select("probe").where("probe IS NOT NULL"), "probes")
    tasks = max(1, min(4096, probes.count() // 500))
    ordered = probes.repartitionByRange(tasks, "probe").sortWithinPartitions("probe")
    return ordered.mapInArrow(_searching(spark.sparkContext.broadcast(parts), first_only, with_payload), FOUND)


def captures_of(archive: Archive, urls: DataFrame, url: str = "url") -> DataFrame:
    """All captures of each url of a table, with their payloads; every url is searched once."""
    key = F.pandas_udf(lambda values: values.map(lambda v: capture_key(v) + "\t"), "string")
    return searched(archive, urls.select(key(F.col(url)).alias("probe")).distinct())


def read_back(archive: Archive, params: ArchiveParameters = ArchiveParameters()) -> DataFrame:
    """Every record with the facts of its full payload: a revisit's come from the response that the index finds.

    ``page_id`` and ``refers_to`` are texts. The facts of a response are read once, however many records revisit it.
    """
    records, _ = stored(read_records(archive, params), "records")
    wanted = records.where("record_type = 'revisit'").select("probe").distinct()
    facts = searched(archive, wanted, first_only=True, with_payload=False)
    facts, _ = stored(facts.select(F.col("probe").alias("found"), F.col("payload_bytes").alias("found_bytes"), F.col("payload_digest").alias("found_digest")), "facts")
    joined = records.join(broadcast_if_small(facts), F.col("probe") == F.col("found"), "left")
    return joined.select(
        "page_id",
        F.coalesce("payload_bytes", "found_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "found_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
