"""WARC archives and a two-level capture index over them."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from argent.session import stored, work_dir

#: Payloads of at least so many bytes are written once; later ones refer to it.
LEAST = 100
#: An archive is closed when it has so many bytes; capture lines of one index block.
ARCHIVE_BYTES, BLOCK_LINES = 1 << 30, 3000
#: Records of one stretch of an archive are read by one task; gaps up to NEAR bytes are read over.
#: A task reads about TASK bytes of archives.
STRETCH, NEAR, TASK = 8 << 20, 64 << 10, 256 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = "key string, id string, record_type string, payload_bytes bigint, payload_digest string, archive string, offset bigint, length bigint"


def surt(url: str | None) -> str:
    """Sort key of a url: the host reversed, then port, path and query; the
    scheme, user and fragment go, white space and controls are escaped.

    A null url has the empty key; what is no url is its own key.
    """
    text = url or ""
    try:
        parts = urlsplit(text)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if host:
        port = f":{port}" if port and port not in (80, 443) else ""
        text = f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"
    return _escape(text)


def _escape(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _store(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there, in any task."""
    if root.startswith("file:") or "://" not in root:
        return pafs.LocalFileSystem(), "/" + re.sub(r"^file:", "", root).lstrip("/")
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", root))


def _name(id: str | None) -> str:
    """An id as one word: '-' for null, else '=' and the escaped id."""
    return "-" if id is None else "=" + quote(id, safe="")


def _id(name: str) -> str | None:
    return None if name == "-" else unquote(name[1:])


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as a gzip member of its own."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode()) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with lower-case names, block) of a gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = int(headers["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {headers.get('warc-record-id')} is not as long as it says")
    return headers, rest[:size]


class _Archives:
    """Writes records to archives of a task, each under a name of its own, so
    that a task that runs again never touches what another attempt wrote."""

    def __init__(self, root: str):
        self.fs, base = _store(root)
        self.folder, self.out, self.name, self.at = f"{base}/archives", None, "", 0
        self.fs.create_dir(self.folder, recursive=True)

    def add(self, record: bytes) -> tuple[str, int, int]:
        if self.out is None:
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            info = _record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("WARC-Filename", self.name),
                                        ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            self.out.write(info)
            self.at = len(info)
        place = self.name, self.at, len(record)
        self.out.write(record)
        self.at += len(record)
        if self.at >= ARCHIVE_BYTES:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_archives(pages: DataFrame, root: str, id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """Write one record per row of ``pages`` to archives under ``root``; gives
    the captures (CAPTURE), stored.

    The payload is the html in UTF-8, null as empty. Of the records with equal
    payloads of at least ``least`` bytes the one with the smallest id is the
    response (null ids last; of rows equal in id and payload one, by url) and
    the others are revisits that refer to it; all other records are responses.
    Revisits hold the HTTP head alone. Controls in a url are escaped. Other
    columns of ``pages`` are not read; an empty table writes no archive.

    Groups of copies are found on (id, digest) rows, with minima combined map
    side and a join that Spark can split; the pages themselves are shuffled
    once, by (digest, id), so a group of copies is spread over all tasks. Only
    rows equal in id and payload meet in one task, sorted, not held.
    """
    name = F.col(id).cast("string")
    base = pages.select(name.alias("name"), F.col(id).alias("id"), F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), name)).alias("who"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumns({"digest": F.sha2("payload", 256), "bytes": F.octet_length("payload")})
    big = base.where(F.col("bytes") >= least).select("id", "who", "digest")
    groups = stored(big.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "warc-groups")
    members = stored(big.join(groups, "digest").distinct().select("digest", "who", F.col("first").cast("string").alias("first"),
                                                                 F.col("id").eqNullSafe(F.col("first")).alias("leads")), "warc-members")
    copy = F.row_number().over(Window.partitionBy("digest", "who").orderBy(F.col("url").asc_nulls_last()))
    rows = (base.withColumn("copy", copy).join(members.hint("merge"), ["digest", "who"], "left")
            .select("name", "url", "payload", "digest", "copy", "first", (F.col("leads").isNull() | (F.col("leads") & (F.col("copy") == 1))).alias("whole")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = None
        for batch in batches:
            out = []
            for name, link, payload, digest, copy, first, whole in zip(*(c.to_pylist() for c in batch.columns)):
                archives = archives or _Archives(root)
                kind = "response" if whole else "revisit"
                head = [("WARC-Record-ID", f"<page:{_name(name)}:{digest[:16]}:{copy}>"), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}"),
                        ("Content-Type", "application/http;msgtype=response")]
                if link is not None:
                    head.append(("WARC-Target-URI", _escape(link)))
                if not whole:
                    head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<page:{_name(first)}:{digest[:16]}:1>")]
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                out.append((surt(link), _name(name), kind, len(payload), digest, *archives.add(_record(kind, head, block + payload if whole else block))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[f.split()[0] for f in CAPTURE.split(", ")])
        if archives:
            archives.close()
    return stored(rows.mapInArrow(write, CAPTURE), "warc-captures")


@dataclass
class CaptureIndex:
    """Sorted capture lines in compressed blocks, and a directory of the blocks.

    A line is ``key id type bytes digest archive offset length``. Each part
    holds a range of lines in gzip blocks; beside it lies its directory, the
    first line's key and the place of each block. ``parts`` has (first line,
    file) of each part: as many as the sort had partitions, not more with more
    pages.
    """

    root: str
    parts: list[tuple[bytes, str]]

    def lookup(self, queries: DataFrame, url: str = "url", id: str | None = None) -> DataFrame:
        """(archive, offset, length) of all captures of the urls of ``queries``,
        or of the pairs of url and id; equal queries are asked once.

        Queries are sorted by key, so a task walks through the blocks once: it
        binary-searches the parts, the part's directory and the block's lines.
        A query without captures gives no row.
        """
        root, parts = self.root, self.parts
        cols = [F.col(url).cast("string").alias("url"), F.col(id).cast("string").alias("id") if id else F.lit(None).cast("string").alias("id")]

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [surt(u) + " " + (_name(i) + " " if id else "") for u, i in zip(*(c.to_pylist() for c in batch.columns))]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["q"])

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader = _Blocks(root, parts)
            for batch in batches:
                out = [line.split(b" ")[-3:] for q in batch.column(0).to_pylist() for line in reader.find(q.encode())]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0].decode() for x in out]), pa.array([int(x[1]) for x in out]), pa.array([int(x[2]) for x in out])],
                                                     names=["archive", "offset", "length"])
        asked = stored(queries.select(*cols).distinct().mapInArrow(keys, "q string").distinct(), "warc-queries")
        n = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return asked.repartitionByRange(n, "q").sortWithinPartitions("q").mapInArrow(search, "archive string, offset bigint, length bigint")


class _Blocks:
    """Reads lines of an index through its directory, the last block kept."""

    def __init__(self, root: str, parts: list[tuple[bytes, str]]):
        self.fs, base = _store(root)
        self.folder, self.parts, self.firsts = f"{base}/index", parts, [p[0] for p in parts]
        self.part, self.block = -1, -1

    def _open(self, part: int) -> None:
        if part != self.part:
            name = self.parts[part][1]
            with self.fs.open_input_file(f"{self.folder}/{name}.dir") as f:
                rows = [x.rsplit(b" ", 2) for x in f.read().split(b"\n") if x]
            self.heads, self.places = [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]
            self.file, self.part, self.block = self.fs.open_input_file(f"{self.folder}/{name}"), part, -1

    def _lines(self, block: int) -> list[bytes]:
        if block != self.block:
            offset, size = self.places[block]
            self.lines = zlib.decompress(self.file.read_at(size, offset), 31).split(b"\n")[:-1]
            self.block = block
        return self.lines

    def find(self, start: bytes) -> Iterator[bytes]:
        """The lines that begin with ``start``, which ends with a space."""
        end = start[:-1] + b"!"  # no key has a byte as low as the space that ends it
        for part in range(max(0, bisect_right(self.firsts, start) - 1), len(self.parts)):
            if self.firsts[part] >= end:
                return
            self._open(part)
            for block in range(max(0, bisect_right(self.heads, start) - 1), len(self.heads)):
                if self.heads[block] >= end:
                    break
                lines = self._lines(block)
                for i in range(bisect_left(lines, start), len(lines)):
                    if lines[i] >= end:
                        return
                    yield lines[i]


def build_index(captures: DataFrame, root: str, lines: int = BLOCK_LINES) -> CaptureIndex:
    """Sort ``captures`` by key and id and write them as a :class:`CaptureIndex`
    under ``root``, ``lines`` lines to a block. Each task writes one part."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _store(root)
        name, held, heads, at, out = f"{uuid.uuid4().hex}.cdx.gz", [], [], 0, None

        def flush() -> None:
            nonlocal at, held, out
            if out is None:
                fs.create_dir(f"{base}/index", recursive=True)
                out = fs.open_output_stream(f"{base}/index/{name}", compression=None)
            z = zlib.compressobj(6, zlib.DEFLATED, 31)
            block = z.compress(b"\n".join(held) + b"\n") + z.flush()
            out.write(block)
            heads.append(b" ".join(held[0].split(b" ")[:2]) + b" %d %d" % (at, len(block)))
            at, held = at + len(block), []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(" ".join(map(str, row)).encode())
                if len(held) == lines:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
            with fs.open_output_stream(f"{base}/index/{name}.dir", compression=None) as f:
                f.write(b"\n".join(heads) + b"\n")
            yield pa.RecordBatch.from_arrays([pa.array([heads[0].rsplit(b" ", 2)[0]]), pa.array([name])], names=["first", "name"])
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = captures.repartitionByRange(n, "key", "id").sortWithinPartitions("key", "id", "archive", "offset")
    sorted_.mapInArrow(write, "first binary, name string").write.mode("overwrite").parquet(f"{root}/parts")
    return open_index(captures.sparkSession, root)


def open_index(spark: SparkSession, root: str) -> CaptureIndex:
    """The index under ``root``; the driver gets one short row per part."""
    parts = spark.read.schema("first binary, name string").parquet(f"{root}/parts")
    return CaptureIndex(root, sorted((bytes(r["first"]), r["name"]) for r in parts.collect()))


def read_captures(places: DataFrame, root: str, payload: bool = True) -> DataFrame:
    """The records at ``places`` (archive, offset, length): id, url, record_type,
    refers_to, payload_bytes, payload_digest and, with ``payload``, the html
    (null for a revisit).

    Places are dealt by stretch of an archive, over as many tasks as the bytes
    they name ask for, and read in order, neighbours in one read. Digest and size of a response are taken from its payload, those
    of a revisit from its headers; a payload that differs from the digest in
    its header is an error.
    """
    schema = "id string, url string, record_type string, refers_to string, payload_bytes bigint, payload_digest string" + ", html string" * payload

    def stretches(places: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
        """(archive, start, end, records) of neighbours of together at most STRETCH bytes, or of one record."""
        held: list[tuple[int, int]] = []
        name, start, end = "", 0, 0
        for archive, offset, length in places:
            if held and (archive != name or offset > end + NEAR or offset + length - start > STRETCH):
                yield name, start, end, held
                held = []
            if not held:
                name, start = archive, offset
            held.append((offset, length))
            end = offset + length
        if held:
            yield name, start, end, held

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _store(root)
        for batch in batches:
            places = list(zip(*(c.to_pylist() for c in batch.columns)))
            for name, start, end, found in stretches(places):
                with fs.open_input_file(f"{base}/archives/{name}") as f:
                    data = memoryview(f.read_at(end - start, start))
                out = [_capture(data[o - start:o - start + n], payload) for o, n in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 4 else pa.string()) for i, c in enumerate(zip(*out))],
                                                 names=[f.split()[0] for f in schema.split(", ")])
    # rows of places are short, so the number of tasks follows the bytes they stand for
    n = max(int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(places.agg(F.sum("length")).first()[0] or 0) // TASK))
    dealt = places.select("archive", "offset", "length").repartition(n, "archive", F.floor(F.col("offset") / STRETCH))
    return dealt.sortWithinPartitions("archive", "offset").mapInArrow(read, schema)


def _capture(member: bytes, payload: bool) -> tuple:
    headers, block = parse_record(member)
    head, _, body = block.partition(b"\r\n\r\n")
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response":
        size = len(body)
        if hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"payload of {headers['warc-record-id']} differs from its digest")
    else:
        size = int(re.search(rb"(?mi)^content-length:\s*(\d+)", head)[1])
    named = [_id(x.split(":")[1]) if x else None for x in (headers["warc-record-id"], headers.get("warc-refers-to"))]
    row = named[0], headers.get("warc-target-uri"), kind, named[1], size, digest
    return (*row, body.decode() if kind == "response" else None) if payload else row


def archive_pages(pages: DataFrame, root: str | None = None, id: str = "page_id", url: str = "url", html: str = "html", payload: bool = False) -> DataFrame:
    """Archive ``pages`` under ``root`` (default: the shared work folder), index
    the captures, look every page up by url and id and read it back.

    One row per row of ``pages``: ``id`` in its own type, then the columns of
    :func:`read_captures`. An empty table gives an empty result.
    """
    root = root or work_dir(pages.sparkSession, "warc")
    kind = pages.schema[id].dataType
    index = build_index(write_archives(pages, root, id, url, html), root)
    places = stored(index.lookup(pages, url, id), "warc-places")
    out = read_captures(places, root, payload)
    return out.select(F.col("id").cast(kind).alias(id), "url", "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
                      *[c for c in out.columns if c not in ("id", "url", "record_type", "refers_to")])

