"""WARC archives as tables of chunks.

A payload of any size is rows of a record's identifier and a chunk's number. Writer and reader
stream: a task holds one chunk, the state of two digests and a buffer, never a record. Each chunk
carries the digest of the payload up to its end, so that the last one has that of the whole.

Archives are gzip files with one member per record. Tasks open them through ``pyarrow.fs``, which
knows local and mounted folders, HDFS and object stores; their list is a table that Spark commits.
What a lost or repeated task has left behind is in no list.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.stage import cut
from daybook.session import scratch_folder

#: Bytes of a payload in one row, and about how many compressed bytes make a file.
CHUNK = 1 << 20
FILE_BYTES = 128 << 20
#: Header lines of a record, and of what it holds, may have so many bytes; more is no WARC file.
HEADER_BYTES = 1 << 20
#: Runs that a group of equal payloads is counted in before its runs are merged.
RUNS = 64
#: Most tasks that a list of archives is spread over.
MOST_TASKS = 10_000

#: Fixed values of the format.
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_LINE = b"\r\n\r\n"

#: Header fields for what the format has no field for: the identifier in the caller's table.
OWN_ID, REFERS_OWN_ID = "X-Row-Id", "X-Refers-To-Row-Id"

ARCHIVES = "archive string, n_records long, n_bytes long"
CHUNKS = (
    "archive string, record_no long, offset long, length long, record_id string, record_type string, uri string, "
    "id string, refers_to string, refers_to_id string, stated_bytes long, stated_digest string, "
    "chunk_no long, content binary, n_bytes long, digest string, crc long, last boolean"
)
#: Chunks that go on in one batch: so many rows, or bytes.
BATCH_ROWS, BATCH_BYTES = 4096, 4 << 20


def _store(uri: str):
    """File system and path of a file."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


class _Writer:
    """Writes gzip members to new archives in ``folder``, the next once one has ``limit`` bytes."""

    def __init__(self, folder: str, limit: int | None = None):
        self.folder, self.limit, self.out, self.done = folder, limit, None, []

    def begin(self) -> None:
        if self.out is None:
            self.name = f"{self.folder}/{uuid.uuid4().hex}.warc.gz"
            store, path = _store(self.name)
            store.create_dir(path.rpartition("/")[0], recursive=True)
            self.out, self.records, self.size = store.open_output_stream(path, compression=None), 0, 0
        self.zip = zlib.compressobj(6, zlib.DEFLATED, 31)

    def put(self, data) -> None:
        self.raw(self.zip.compress(data))

    def raw(self, data) -> None:
        self.out.write(data)
        self.size += len(data)

    def end(self) -> None:
        self.raw(self.zip.flush())
        self.records += 1
        if self.limit and self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.records, self.size))
            self.out = None

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.close()
        if self.done:
            yield pa.record_batch([*map(pa.array, zip(*self.done))], ["archive", "n_records", "n_bytes"])


def _header(fields: dict[str, object], size: int) -> bytes:
    lines = [VERSION.decode(), *(f"{k}: {_line(v)}" for k, v in fields.items() if v is not None)]
    return "\r\n".join([*lines, f"Content-Length: {size}"]).encode() + EMPTY_LINE


def _line(value: object) -> str:
    """A value on one line; what cannot stand in a header line is percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in str(value))


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}".encode() + EMPTY_LINE


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunked(df: DataFrame, id_col: str, uri_col: str, payload_col: str, chunk: int = CHUNK) -> DataFrame:
    """``id, uri, sha, size, at, content``: the payload of each row cut into chunks, the chunks of a
    row one after the other. A null payload is an empty one; an empty one has one empty chunk."""
    if chunk < 1:
        raise ValueError("a chunk has at least one byte")
    data = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = df.select(
        F.col(id_col).cast("string").alias("id"), F.col(uri_col).cast("string").alias("uri"), data.alias("data"))
    rows = rows.withColumns({"sha": F.unhex(F.sha1("data")), "size": F.octet_length("data").cast("long")})
    last = F.greatest(F.col("size") - 1, F.lit(0))
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(chunk).cast("long"))))
    piece = F.substring("data", (F.col("at") + 1).cast("int"), F.lit(chunk))
    return rows.select("id", "uri", "sha", "size", "at", piece.alias("content"))


def write_chunks(chunks: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a response record for each run of ``chunks`` (columns as ``chunked`` gives them, those of
    a record one after the other) and return the list of archives (``ARCHIVES``). ``folder`` is a URI
    that all executors can write to, by default a new folder below ``spark.checkpoint.dir``."""
    folder = folder or scratch_folder(chunks.sparkSession, "warc")

    def write(batches):
        out, left = _Writer(folder, file_bytes), 0
        for batch in batches:
            columns = [batch.column(c) for c in ("id", "uri", "sha", "size", "at", "content")]
            for number in range(batch.num_rows):
                id, uri, sha, size, at = (c[number].as_py() for c in columns[:5])
                if at == 0:
                    http = _http(size)
                    fields = {
                        "WARC-Type": "response",
                        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                        "WARC-Date": _now(),
                        "WARC-Target-URI": uri,
                        OWN_ID: id,
                        "WARC-Payload-Digest": f"sha1:{base32(sha)}",
                        "Content-Type": "application/http; msgtype=response",
                    }
                    out.begin()
                    out.put(_header(fields, len(http) + size) + http)
                    left = size
                content = columns[5][number].as_buffer()
                out.put(content)
                left -= content.size
                if left == 0:
                    out.put(EMPTY_LINE)
                    out.end()
        yield from out.rows()

    return cut(chunks.mapInArrow(write, ARCHIVES), "archives")


def write_archives(
    df: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    chunk: int = CHUNK,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a response record for every row of ``df``; see ``write_chunks``.

    A null payload is written as an empty one; null identifiers and addresses leave their header
    field out. Repeated rows are records of their own. An empty table makes no archive. Other
    columns of ``df`` are ignored.
    """
    return write_chunks(chunked(df, id_col, uri_col, payload_col, chunk), folder, file_bytes)


class _Reader:
    """The unpacked bytes of an archive, in order."""

    def __init__(self, stream, block: int = 1 << 18):
        self.stream, self.block = stream, block
        self.raw, self.ready, self.pos, self.at = stream.read(block), b"", 0, 0
        self.zip = zlib.decompressobj(31) if self.raw[:2] == b"\x1f\x8b" else None
        self.begun = False

    def _packed(self) -> bool:
        self.raw = self.raw or self.stream.read(self.block)
        return bool(self.raw)

    def _fill(self) -> bool:
        """Unpack until something is ready; False where the member or the file ends."""
        while self.pos == len(self.ready):
            if self.zip is None:
                if not self._packed():
                    return False
                self.ready, self.pos, self.raw = self.raw, 0, b""
            elif self.zip.eof:
                return False
            else:
                more = self._packed()
                size = len(self.raw)
                self.ready, self.pos = self.zip.decompress(self.raw, self.block), 0
                self.raw = self.zip.unused_data if self.zip.eof else self.zip.unconsumed_tail
                self.at += size - len(self.raw)
                self.begun = True
                if not more and not self.ready and not self.zip.eof:
                    raise ValueError("the archive is cut off")
        return True

    def more(self) -> bool:
        """Whether another record follows, in this member or the next."""
        if self.zip is None or self.begun:
            if self._fill():
                return True
            if self.zip is None or not self._packed():
                return False
            self.zip, self.begun = zlib.decompressobj(31), False
        return self._packed()

    def boundary(self) -> int | None:
        """The place in the file, between records; None inside a member."""
        if self.zip is not None and self.begun and self._fill():
            return None
        return self.at

    def read(self, n: int) -> bytes:
        """Up to ``n`` bytes; none at the end of the member or the file."""
        if not self._fill():
            return b""
        out = self.ready[self.pos : self.pos + n]
        self.pos += len(out)
        if self.zip is None:
            self.at += len(out)
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            part = self.read(n)
            if not part:
                raise ValueError("the archive is cut off")
            n -= len(part)
            yield part

    def until(self, mark: bytes, limit: int) -> bytes:
        """Up to and with ``mark``; without it, what is there within ``limit`` bytes."""
        held = b""
        while mark not in held and len(held) < limit:
            part = self.read(min(4096, limit - len(held)))
            if not part:
                return held
            held += part
        stop = held.find(mark) + len(mark) if mark in held else len(held)
        back = len(held) - stop  # all of it from the last part
        self.pos -= back
        if self.zip is None:
            self.at -= back
        return held[:stop]


def _fields(header: bytes) -> dict[str, str]:
    """Header fields by lower-case name; continued lines are joined."""
    out, last = {}, ""
    for line in header.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def _chunks_of(reader: _Reader, chunk: int, content: bool) -> Iterator[list]:
    """Rows of ``CHUNKS`` without the archive."""
    record_no = 0
    while reader.more():
        offset = reader.boundary()
        header = reader.until(EMPTY_LINE, HEADER_BYTES)
        fields = _fields(header)
        size = _number(fields.get("content-length"))
        if not header.startswith(b"WARC/") or not header.endswith(EMPTY_LINE) or size is None:
            raise ValueError(f"no WARC record where record {record_no} should begin")
        stated = None
        if fields.get("content-type", "").startswith("application/http"):
            http = reader.until(EMPTY_LINE, min(size, HEADER_BYTES))
            size -= len(http)
            stated = _number(_fields(http).get("content-length"))
        known = [fields.get(x) for x in (
            "warc-record-id", "warc-type", "warc-target-uri", OWN_ID.lower(), "warc-refers-to", REFERS_OWN_ID.lower())]
        known += [stated, fields.get("warc-payload-digest", "").rpartition(":")[2] or None]
        sha, crc, done, number = hashlib.sha1(), 0, 0, 0
        while done < size or not number:
            held, room = [], min(chunk, size - done)
            for part in reader.exactly(room):
                sha.update(part)
                crc = zlib.crc32(part, crc)
                if content:
                    held.append(part)
            done += room
            last, length = done == size, None
            if last:
                for _ in reader.exactly(len(EMPTY_LINE)):
                    pass
                stop = reader.boundary()
                length = stop - offset if None not in (stop, offset) else None
            own = b"".join(held) if content else None
            yield [record_no, offset, length, *known, number, own, done, base32(sha.copy().digest()), crc, last]
            number += 1
        record_no += 1


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """``archive`` of all files at ``path`` (a folder, a file or a pattern), without reading them."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"))


def _spread(archives: DataFrame) -> DataFrame:
    """One archive to a task, as far as tasks go."""
    return archives.repartition(max(1, min(archives.count(), MOST_TASKS)))


def read_chunks(archives: DataFrame, chunk: int = CHUNK, content: bool = True) -> DataFrame:
    """The chunk table (``CHUNKS``) of all records in the files that column ``archive`` names.

    Payloads come as chunks of ``chunk`` bytes, the last one shorter; an empty payload is one empty
    chunk. ``n_bytes``, ``digest`` (base32 SHA-1) and ``crc`` are those of the payload up to the end of
    the chunk. In records of HTTP messages the payload is what follows the HTTP header; transfer
    codings are not undone. ``offset`` and ``length``, on last chunks, tell where the record lies in its
    file; ``length`` is null where records share a gzip member. Without ``content`` that column is null.

    Reads files with a gzip member per record, files zipped as a whole and plain ones. A file that is
    cut off or is no archive fails the read.
    """
    schema = CHUNKS
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches):
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                store, path = _store(name)
                held, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for row in _chunks_of(_Reader(stream), chunk, content):
                        held.append([name, *row])
                        size += len(row[names.index("content") - 1] or b"")
                        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield rows_of(held)
                            held, size = [], 0
                if held:
                    yield rows_of(held)

    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def rows_of(held):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    return _spread(archives.select("archive")).mapInArrow(read, schema)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: the running figures of its last chunk are those of the whole payload.
    ``intact``: the payload has the digest that its header states, or none is stated."""
    stated = F.coalesce(F.upper("stated_digest"), F.col("digest"))
    intact = (F.col("record_type") == "revisit") | (stated == F.col("digest"))
    return chunks.filter("last").drop("chunk_no", "content", "last").withColumn("intact", intact)


def find_revisits(found: DataFrame, least_bytes: int = 0, id_type: str = "long", runs: int = RUNS) -> DataFrame:
    """``found`` (as ``records`` gives it), stored, with ``best``: of the responses with an equal payload,
    that with the greatest identifier, itself included. Payloads are equal if SHA-1, CRC and length are.
    Null for records that are no responses and payloads below ``least_bytes``.

    Identifiers rank as ``id_type``, null lowest; of equal ones the record later in the greater file
    name ranks first. Groups are counted in runs that are merged after, and winners go back run by
    run, so that no key gathers a large group.
    """
    key = ["digest", "n_bytes", "crc"]
    rank = F.struct(F.col("id").cast(id_type).alias("id"), "archive", "record_no", "record_id", "uri")
    run = F.pmod(F.xxhash64("archive", "record_no"), F.lit(runs)).cast("int")
    stored = cut(found.withColumns({"rank": rank, "run": run}), "records")
    alike = (F.col("record_type") == "response") & (F.col("n_bytes") >= least_bytes)
    first = stored.filter(alike).groupBy("run", *key).agg(F.max("rank").alias("best"))
    winners = first.groupBy(*key).agg(F.max("best").alias("best"))
    per_run = first.select("run", *key).join(winners, key).withColumn("alike", F.lit(True))
    marked = stored.withColumn("alike", alike).join(per_run, ["run", *key, "alike"], "left")
    return marked.drop("run", "alike")


def write_revisits(archives: DataFrame, marked: DataFrame, folder: str | None = None) -> DataFrame:
    """The list of archives in which every response that is not the ``best`` of its group is a revisit
    record instead, without payload. Files that hold none are kept as they are; of the others the
    members that stay are copied as they are, and the old files are left alone.

    ``marked`` is what ``find_revisits`` gave for these ``archives``, which need a member per record.
    """
    folder = folder or scratch_folder(archives.sparkSession, "warc")
    again = marked.filter(F.col("best").isNotNull() & (F.col("rank") != F.col("best")))
    fields = F.struct(
        "offset", "length", "record_id", "uri", "id", "n_bytes", "digest",
        F.col("best.record_id").alias("refers_to"), F.col("best.uri").alias("refers_to_uri"),
        F.col("best.id").cast("string").alias("refers_to_id"),
    )
    lists = again.groupBy("archive").agg(F.collect_list(fields).alias("list"))
    todo = cut(archives.select("archive", "n_records").join(lists, "archive"), "revisits")

    def revisit(r) -> bytes:
        http = _http(r["n_bytes"])
        header = {
            "WARC-Type": "revisit",
            "WARC-Record-ID": r["record_id"],
            "WARC-Date": _now(),
            "WARC-Target-URI": r["uri"],
            "WARC-Profile": IDENTICAL,
            "WARC-Refers-To": r["refers_to"],
            "WARC-Refers-To-Target-URI": r["refers_to_uri"],
            OWN_ID: r["id"],
            REFERS_OWN_ID: r["refers_to_id"],
            "WARC-Payload-Digest": f"sha1:{r['digest']}",
            "Content-Type": "application/http; msgtype=response",
        }
        return _header(header, len(http)) + http + EMPTY_LINE

    def parts(stream, n):
        while n is None or n:
            part = stream.read(min(n or CHUNK, CHUNK))
            if not part:
                return
            n = n and n - len(part)
            yield part

    def rewrite(batches):
        for batch in batches:
            for name, n_records, found in zip(*(batch.column(c) for c in ("archive", "n_records", "list"))):
                found = found.as_py()
                if any(r["length"] is None for r in found):
                    raise ValueError(f"{name} has no member per record")
                found.sort(key=lambda r: r["offset"])
                out, at = _Writer(folder), 0
                store, path = _store(name.as_py())
                with store.open_input_stream(path, compression=None) as stream:
                    for r in found:
                        out.begin()
                        for part in parts(stream, r["offset"] - at):
                            out.raw(part)
                        for part in parts(stream, r["length"]):
                            pass
                        at = r["offset"] + r["length"]
                        out.put(revisit(r))
                        out.end()
                    for part in parts(stream, None):
                        out.raw(part)
                out.records = n_records.as_py()
                yield from out.rows()

    written = cut(_spread(todo).mapInArrow(rewrite, ARCHIVES), "archives")
    return archives.join(todo.select("archive"), "archive", "left_anti").unionByName(written)


def archive(
    df: DataFrame,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    folder: str | None = None,
    id_type: str = "long",
    chunk: int = CHUNK,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write ``df`` as WARC files in ``folder``, equal payloads once, and return their list.

    Of rows with equal payloads of at least ``least_bytes`` bytes, that with the greatest identifier
    becomes a response, the others revisit it; a null identifier ranks lowest, of repeated rows one is
    the response. Smaller payloads are responses all. Null payloads are empty ones. An empty table
    gives an empty list.
    """
    written = write_archives(df, folder, id_col, uri_col, payload_col, chunk, file_bytes)
    found = records(read_chunks(written, chunk, content=False))
    return write_revisits(written, find_revisits(found, least_bytes, id_type), folder)


def contents(archives: DataFrame, id_type: str = "long") -> DataFrame:
    """What ``archives`` hold, one row per response or revisit: ``id, uri, payload_bytes,
    payload_digest`` (base32 SHA-1; both of the full payload, read again for responses and as stated
    for revisits), ``record_type, refers_to`` (identifier of the response, for revisits), ``intact``."""
    found = records(read_chunks(archives, content=False)).filter("record_type IN ('response', 'revisit')")
    again = F.col("record_type") == "revisit"
    return found.select(
        F.col("id").cast(id_type).alias("id"),
        "uri",
        F.when(again, F.col("stated_bytes")).otherwise(F.col("n_bytes")).alias("payload_bytes"),
        F.when(again, F.col("stated_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        F.when(again, F.col("refers_to_id").cast(id_type)).alias("refers_to"),
        "intact",
    )
