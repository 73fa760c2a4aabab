"""WARC archives of pages with a two-level capture index.

Each task writes its pages as gzip members, one per record, to archives of bounded size in
the shared folder. The index holds one line per capture, sorted by a key of the reversed
host and the path and packed into compressed blocks; beside each index file lies its sparse
directory, the first key of every block. A lookup finds the index files by their key
ranges, binary-searches the directory, range-reads the blocks that can hold the key, and
then range-reads the records.

Files carry a random name and count only once a row names them, so a repeated task leaves
unnamed files behind and nothing wrong.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import KEY_ROWS, small_batches, spread_join
from headway.session import materialise, own, shared_folder, small_table

ARCHIVE_BYTES = 64 * 1024 * 1024
# Compressed bytes that a task reads back.
READ_BYTES = 8 * 1024 * 1024
BLOCK_LINES = 500
DATE = "2024-01-01T00:00:00Z"
LEVEL = 1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = "key string, page_id long, archive string, offset long, length long"
_CAPTURES = pa.schema(
    [("key", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()),
     ("length", pa.int64())]
)
DIRECTORY = "file string, first_key string, last_key string, blocks long, rows long"
RECORDS = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
    "refers_to long, intact boolean, payload binary"
)
_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
     ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("intact", pa.bool_()), ("payload", pa.binary())]
)


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: http://a.example.com/x becomes com,example,a)/x. Null is ')'."""
    rest = (url or "").partition("://")[2] or (url or "")
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut].rpartition("@")[2].lower(), rest[cut:]
    return f"{','.join(reversed(host.split('.')))}){path}"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(url: str | None, page_id: int | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has the HTTP head of the page but not its payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = head.encode() + (b"" if revisit else payload)
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url is not None else "urn:none",
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(body)),
    }
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record, its payload, and whether the payload fits its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
    said = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload_digest": said,
        "payload_bytes": size,
        "refers_to": _page(fields.get("WARC-Refers-To", "")),
        "intact": revisit or (len(payload) == size and digest(payload) == said),
        "payload": None if revisit else payload,
    }


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


class _Archive:
    """Archives under a folder, one after the other, each up to a size."""

    def __init__(self, folder: str, limit: int):
        self.store, self.path = _store(folder)
        self.limit, self.stream, self.name, self.at = limit, None, "", 0

    def put(self, data: bytes) -> tuple[str, int, int]:
        if self.stream is None or self.at >= self.limit:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.stream = self.store.open_output_stream(f"{self.path}/{self.name}", compression=None)
            info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: %s\r\n"
            self._write(info % (str(uuid.uuid4()).encode(), DATE.encode()) + b"Content-Length: 0\r\n\r\n\r\n\r\n")
        offset, length = self._write(data)
        return self.name, offset, length

    def _write(self, data: bytes) -> tuple[int, int]:
        member = gzip.compress(data, LEVEL, mtime=0)
        self.stream.write(member)
        self.at += len(member)
        return self.at - len(member), len(member)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def new_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared storage."""
    folder = f"{shared_folder(spark)}/headway/{label}-{uuid.uuid4().hex}"
    store, path = _store(folder)
    store.create_dir(path, recursive=True)
    own(folder)
    return folder


def _payload():
    return F.coalesce(F.col("html").cast("string"), F.lit(""))


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, content, refers_to) of the records whose payload an earlier page has, written once."""
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.unhex(F.sha2(_payload(), 256)).alias("content"),
        F.octet_length(_payload()).alias("size"),
    )
    narrow = materialise(narrow.filter(F.col("size") >= least_bytes), "payload-digests")
    groups = narrow.groupBy("content").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    groups = materialise(groups.filter("n > 1 AND refers_to IS NOT NULL"), "payload-groups")
    found = spread_join(narrow, groups, "content", "n").filter("NOT page_id <=> refers_to")
    return materialise(found.select("page_id", "content", "refers_to").distinct(), "revisits")


def write_archives(
    pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> tuple[str, DataFrame]:
    """Write a record per page; the folder of the archives and the captures (CAPTURES columns).

    Of pages with equal payloads of at least ``least_bytes`` bytes the smallest page_id is
    the response (all rows that have it), others are revisits of it. Null html is an empty
    payload; null ids come after all others and are never referred to.
    """
    small_batches(pages)
    folder = new_folder(pages.sparkSession, "archives")
    again = revisits(pages, least_bytes)
    local = small_table(again, KEY_ROWS)
    other = again.hint("shuffle_hash") if local is None else F.broadcast(local)
    rows = pages.select(
        F.col("page_id").cast("long").alias("_id"), F.col("url").cast("string").alias("url"), _payload().alias("html")
    ).withColumn("_content", F.unhex(F.sha2("html", 256)))
    same = rows["_id"].eqNullSafe(other["page_id"]) & (rows["_content"] == other["content"])
    rows = rows.join(other, same, "left").select("_id", "url", "html", "refers_to")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Archive(folder, archive_bytes)
        for batch in batches:
            out: list[tuple] = []
            for page_id, url, html, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = html.encode("utf-8", "surrogatepass")
                data = record(url, page_id, payload, refers, refers is not None)
                out.append((url_key(url), page_id, *archive.put(data)))
            yield _rows(out, _CAPTURES)
        archive.close()

    return folder, materialise(rows.mapInArrow(work, CAPTURES), "captures")


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def build_index(captures: DataFrame, block_lines: int = BLOCK_LINES) -> tuple[str, DataFrame]:
    """Write the sorted captures as compressed blocks; the folder and one row per index file."""
    small_batches(captures)
    folder = new_folder(captures.sparkSession, "capture-index")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        name, held, entries, last, at, total = uuid.uuid4().hex, [], [], "", 0, 0
        stream = None

        def flush() -> None:
            nonlocal held, at
            block = zlib.compress("\n".join(json.dumps(r) for r in held).encode(), LEVEL)
            stream.write(block)
            entries.append((held[0][0], at, len(block)))
            at += len(block)
            held = []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stream is None:
                    stream = store.open_output_stream(f"{path}/{name}.idx", compression=None)
                held.append(row)
                last, total = row[0], total + 1
                if len(held) >= block_lines:
                    flush()
        if stream is None:
            return
        if held:
            flush()
        stream.close()
        with store.open_output_stream(f"{path}/{name}.dir", compression=None) as out:
            out.write(json.dumps(entries).encode())
        columns = [[name], [entries[0][0]], [last], [len(entries)], [total]]
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["file", "first_key", "last_key", "blocks", "rows"],
        )

    order = ["key", "page_id", "archive", "offset"]
    sorted_ = captures.select("key", "page_id", "archive", "offset", "length").repartitionByRange(*order)
    return folder, materialise(sorted_.sortWithinPartitions(*order).mapInArrow(work, DIRECTORY), "index-files")


class IndexFile:
    """An index file: binary search in its directory, range reads of its blocks."""

    def __init__(self, folder: str, name: str):
        store, path = _store(folder)
        with store.open_input_stream(f"{path}/{name}.dir", compression=None) as f:
            entries = json.loads(f.read())
        self.firsts = [e[0] for e in entries]
        self.places = [(e[1], e[2]) for e in entries]
        self.data = store.open_input_file(f"{path}/{name}.idx")
        self.held: tuple[int, list, list] = (-1, [], [])

    def block(self, number: int) -> tuple[list, list]:
        if self.held[0] != number:
            offset, length = self.places[number]
            lines = zlib.decompress(self.data.read_at(length, offset)).decode().split("\n")
            rows = [json.loads(x) for x in lines]
            self.held = (number, [r[0] for r in rows], rows)
        return self.held[1], self.held[2]

    def find(self, key: str) -> Iterator[list]:
        """All captures of a key; they may run over several blocks."""
        number = max(0, bisect_left(self.firsts, key) - 1)
        while number < len(self.firsts) and self.firsts[number] <= key:
            keys, rows = self.block(number)
            yield from rows[bisect_left(keys, key) : bisect_right(keys, key)]
            number += 1


def lookup(wanted: DataFrame, folder: str, files: DataFrame) -> DataFrame:
    """Captures (CAPTURES columns) of the distinct URL keys in ``wanted`` (column key)."""
    small_batches(wanted)
    # One entry per index file, of which there are as many as shuffle partitions.
    ranges = sorted((r["first_key"], r["last_key"], r["file"]) for r in files.collect())
    firsts, lasts = [r[0] for r in ranges], [r[1] for r in ranges]

    @F.arrow_udf("array<string>")
    def files_of(keys: pa.Array) -> pa.Array:
        out = []
        for key in keys.to_pylist():
            out.append([ranges[i][2] for i in range(bisect_left(lasts, key), bisect_right(firsts, key))])
        return pa.array(out, pa.list_(pa.string()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, name = None, None
        for batch in batches:
            out: list[tuple] = []
            for file, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != name:
                    index, name = IndexFile(folder, file), file
                out.extend(map(tuple, index.find(key)))
            yield _rows(out, _CAPTURES)

    asked = wanted.select("key").distinct().select(F.explode(files_of("key")).alias("file"), "key")
    # a part per index file: the size of the keys says nothing about the blocks they read
    parts = asked.repartition(max(1, len(ranges)), "file")
    return parts.sortWithinPartitions("file", "key").mapInArrow(work, CAPTURES)


def read_records(captures: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records at the captures' places (RECORDS columns), by range reads in archive order."""

    small_batches(captures)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        name, data = None, None
        for batch in batches:
            out: list[tuple] = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != name:
                    name, data = archive, store.open_input_file(f"{path}/{archive}")
                found = parse(gzip.decompress(data.read_at(length, offset)))
                if not payload:
                    found["payload"] = None
                out.append(tuple(found[f.name] for f in _RECORDS))
                if payload and sum(len(r[-1] or b"") for r in out) > ARCHIVE_BYTES:
                    yield _rows(out, _RECORDS)
                    out = []
            yield _rows(out, _RECORDS)

    # As many tasks as the bytes to read ask for; each reads whole stretches of archives.
    places = materialise(captures.select("archive", "offset", "length"), "places")
    size = places.agg(F.sum("length")).first()[0] or 0
    stretch = F.floor(F.col("offset") / F.lit(READ_BYTES))
    parts = places.repartition(1 + size // READ_BYTES, "archive", stretch)
    return parts.sortWithinPartitions("archive", "offset").mapInArrow(work, RECORDS)


def url_keys(pages: DataFrame) -> DataFrame:
    """(key): the keys of the pages' URLs."""

    small_batches(pages)

    @F.arrow_udf("string")
    def keys(urls: pa.Array) -> pa.Array:
        return pa.array([url_key(u) for u in urls.to_pylist()], pa.string())

    return pages.select(keys(F.col("url").cast("string")).alias("key"))


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages to archives, index them, look every URL up, and read its records back."""
    folder, captures = write_archives(pages, least_bytes)
    index, files = build_index(captures)
    return read_records(lookup(url_keys(pages), index, files), folder, payload=False)
