"""WARC archives compressed with Zstandard, a dictionary and one frame a record.

Writing: pages with equal payloads keep one full record (``response``), the one
with the largest page id; the others become ``revisit`` records that refer to
it.  Each task writes archive files of bounded size.  A file begins with a
skippable frame that holds the dictionary, fitted on the first records of that
file, and every record is a frame of its own.  The paths of whole files come
back as a table, and only files named there are read: what a lost task left
behind is never seen.

Reading: the dictionary is loaded from the leading skippable frame, frames are
decoded one by one, and headers, lengths and digests are checked.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raremine.llm.store import shared_path, written

#: Magic number of the skippable frame that holds the dictionary.
DICT_FRAME = 0x184D2A5D
#: The dictionary is fitted on at most so many records and bytes of its file.
SAMPLE_RECORDS, SAMPLE_BYTES, DICT_BYTES = 200, 2 << 20, 32 << 10
FILE_BYTES, CHUNK, LEVEL = 32 << 20, 16 << 10, 3
#: Pages carry no crawl time; records need one.
NO_DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class ArchiveError(ValueError):
    """A file or record that is not as it should be."""


def open_store(uri: str):
    """File system and path of a folder on any store that Spark shares."""
    uri = re.sub(r"^file:/+", "file:///", uri)
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ----------------------------------------------------------------- records --

def _record_id(page: str | None) -> str:
    return "<urn:page:null>" if page is None else f"<urn:page:id:{quote(page, safe='')}>"


def _page_of(record_id: str) -> str | None:
    m = re.fullmatch(r"<urn:page:(?:null|id:([^>]*))>", record_id)
    if not m:
        raise ArchiveError(f"unknown record id {record_id!r}")
    return None if m[1] is None else unquote(m[1])


def encode_record(page: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the HTTP header without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page)}",
            f"WARC-Date: {NO_DATE}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
            f"WARC-Block-Digest: sha1:{payload_digest(block)}", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, what: str) -> tuple[str, dict, bytes]:
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not mark:
        raise ArchiveError(f"{what}: no end of headers")
    first, *lines = head.decode("utf-8").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise ArchiveError(f"{what}: header line without a colon")
        fields[name.lower()] = value.strip()
    return first, fields, rest


def decode_record(data: bytes) -> dict:
    """Fields of a record after checking its headers, lengths and digests."""
    version, head, rest = _headers(data, "record")
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise ArchiveError(f"not a WARC record: {version[:20]!r}")
    kind = head.get("warc-type")
    if kind not in ("response", "revisit"):
        raise ArchiveError(f"unknown record type {kind!r}")
    for name in ("warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in head:
            raise ArchiveError(f"record lacks {name}")
    if not head["content-length"].isdigit() or len(rest) != int(head["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ArchiveError("record length does not fit its header")
    block = rest[:-4]
    if "warc-block-digest" in head and head["warc-block-digest"] != f"sha1:{payload_digest(block)}":
        raise ArchiveError("block digest does not fit")
    status, http, payload = _headers(block, "HTTP block")
    if not status.startswith("HTTP/") or not http.get("content-length", "").isdigit():
        raise ArchiveError("bad HTTP header")
    size, digest = int(http["content-length"]), head["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != size or payload_digest(payload) != digest:
            raise ArchiveError("payload does not fit its length or digest")
        refers = None
    else:
        if payload or "warc-refers-to" not in head:
            raise ArchiveError("a revisit has a payload or no reference")
        refers = head["warc-refers-to"]
    return {"page": _page_of(head["warc-record-id"]), "url": head.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "has_reference": refers is not None,
            "refers_to": None if refers is None else _page_of(refers), "payload": payload if kind == "response" else None}


# ------------------------------------------------------------------- files --

def fit_dictionary(samples: list[bytes]) -> bytes:
    """Zstandard dictionary of a bounded sample; empty if it is too small."""
    kept, size = [], 0
    for s in samples[:SAMPLE_RECORDS]:
        kept.append(s[:64 << 10])
        size += len(kept[-1])
        if size > SAMPLE_BYTES:
            break
    if len(kept) < 16 or size < 8 * DICT_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, kept, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:         # nothing in common
        return b""


class ArchiveWriter:
    """One archive file; records are held back until the dictionary is fitted."""

    def __init__(self, store, path: str):
        self.path, self.records, self.bytes, self.waiting, self.packer = path, 0, 0, [], None
        self.out = store.open_output_stream(path)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def _begin(self) -> None:
        fitted = fit_dictionary(self.waiting)
        options = {"level": LEVEL, "write_checksum": True, "write_content_size": True}
        if fitted:
            stored = zstandard.ZstdCompressor(level=LEVEL).compress(fitted)
            self._put(struct.pack("<II", DICT_FRAME, len(stored)) + stored)
            options["dict_data"] = zstandard.ZstdCompressionDict(fitted)
            options["dict_data"].precompute_compress(level=LEVEL)
        self.packer = zstandard.ZstdCompressor(**options)
        for record in self.waiting:
            self._put(self.packer.compress(record))
        self.waiting = []

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.packer:
            self._put(self.packer.compress(record))
            return
        self.waiting.append(record)
        if len(self.waiting) >= SAMPLE_RECORDS or sum(map(len, self.waiting)) > 2 * SAMPLE_BYTES:
            self._begin()

    def close(self) -> None:
        if not self.packer:
            self._begin()
        self.out.close()


def iterate_archive(stream):
    """Decoded records of an open archive, frame by frame."""
    data = stream.read(8)
    unpack = zstandard.ZstdDecompressor
    make = unpack()
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICT_FRAME:
        stored = stream.read(struct.unpack("<I", data[4:])[0])
        raw = unpack().decompress(stored) if stored[:4] == b"\x28\xb5\x2f\xfd" else stored
        make, data = unpack(dict_data=zstandard.ZstdCompressionDict(raw)), b""
    while True:
        data = data or stream.read(CHUNK)
        if not data:
            return
        frame, parts = make.decompressobj(), []
        try:
            while not frame.eof:
                if not data:
                    data = stream.read(CHUNK)
                    if not data:
                        raise ArchiveError("the archive ends inside a frame")
                parts.append(frame.decompress(data))
                data = frame.unused_data if frame.eof else b""
        except zstandard.ZstdError as e:
            raise ArchiveError(f"broken frame: {e}") from e
        yield decode_record(b"".join(parts))


# ------------------------------------------------------------------- Spark --

def mark_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                  least_bytes: int = 0) -> DataFrame:
    """(page, url, html, revisit, refers): of the rows with equal payloads of at
    least ``least_bytes`` bytes the one with the largest key is no revisit.
    Null keys are below all others.  Of equal rows that share that key one is
    taken; only such rows, seen in counts, are ever numbered in a window."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("page"), F.col(url).cast("string").alias("url"), body.alias("html"),
                        F.sha1(body.cast("binary")).alias("sha"))
    large = F.octet_length("html") >= least_bytes
    names = written(rows.filter(large).groupBy("sha", "page").agg(F.count(F.lit(1)).alias("n")), "warc-names")
    top = names.groupBy("sha").agg(F.max(F.struct(F.col("page").isNotNull().alias("has"), F.col("page").alias("page"),
                                                  F.col("n").alias("n"))).alias("top")) \
        .select(F.col("sha").alias("t_sha"), F.col("top.page").alias("refers"), F.col("top.n").alias("n"))
    joined = rows.join(top, rows.sha == top.t_sha, "left")
    first = F.col("page").eqNullSafe(F.col("refers"))
    small = F.octet_length("html") < least_bytes
    marked = joined.withColumn("several", ~small & first & (F.col("n") > 1)).withColumn("revisit", ~small & ~first)
    plain = marked.filter(~F.col("several"))
    columns = ["page", "url", "html", "revisit", "refers"]
    if names.filter("n > 1").first() is None:
        return plain.select(*columns)
    ties = marked.filter("several").withColumn(
        "revisit", F.row_number().over(Window.partitionBy("sha").orderBy("url")) > 1)
    return plain.select(*columns).union(ties.select(*columns))


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes every row as a record below ``folder`` (any shared store) and
    returns (path, records, bytes) of the files."""
    marked = mark_revisits(pages, key, url, html, least_bytes)
    marked = marked.withColumn("page", F.col("page").cast("string")).withColumn("refers", F.col("refers").cast("string"))

    def run(batches):
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        writer = None

        def done():
            writer.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([writer.path]), pa.array([writer.records]), pa.array([writer.bytes])], names=["path", "records", "bytes"])

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page, link, text, revisit, refers = (c[i].as_py() for c in columns)
                if writer is None:
                    writer = ArchiveWriter(store, f"{root}/{uuid.uuid4().hex}.warc.zst")
                writer.add(encode_record(page, link, text.encode(), refers, revisit))
                if writer.bytes >= file_bytes:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    return written(marked.mapInArrow(run, "path string, records long, bytes long"), "warc-files")


def read_archives(files: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """(page, url, payload_bytes, payload_digest, record_type, has_reference,
    refers_to [, payload]) of every record of the files in the table ``files``
    (path, records), which must hold as many records as it says."""
    names = ["page", "url", "payload_bytes", "payload_digest", "record_type", "has_reference", "refers_to"]
    kinds = ["string", "string", "long", "string", "string", "boolean", "string"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string()]
    if payloads:
        names, kinds, types = [*names, "payload"], [*kinds, "binary"], [*types, pa.binary()]

    def run(batches):
        store, _ = open_store(folder)
        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, count, size = [], 0, 0
                with store.open_input_stream(path) as stream:
                    for record in iterate_archive(stream):
                        held.append(record)
                        count += 1
                        size += len(record["payload"] or b"") if payloads else 200
                        if size > 4 << 20:
                            yield _batch(held, names, types)
                            held, size = [], 0
                if count != records:
                    raise ArchiveError(f"{path}: {count} records, {records} expected")
                if held:
                    yield _batch(held, names, types)

    n = max(1, files.count())
    schema = ", ".join(f"{a} {b}" for a, b in zip(names, kinds))
    return files.select("path", "records").repartition(n, "path").mapInArrow(run, schema)


def _batch(records: list[dict], names, types) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in records], t) for n, t in zip(names, types)], names=names)


def archive_round_trip(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url",
                       html: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes all rows and reads them back: (key, payload_bytes,
    payload_digest, record_type, refers_to) from the archives.

    Null html is an empty payload; null keys and urls come back as null;
    repeated rows give a record each; an empty table gives no files and an
    empty result; further columns are not read.
    """
    folder = folder or shared_path(pages.sparkSession, "warc")
    files = write_archives(pages, folder, key, url, html, least_bytes)
    kind = pages.schema[key].dataType.simpleString()
    return read_archives(files, folder).select(
        F.col("page").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))
