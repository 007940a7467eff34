"""WARC archives with a two-level capture index.

Pages become WARC records in gzip members, one archive file per task, in the shared folder.  Of records
with equal payloads the one with the smallest page_id is the response; the others are revisits that name
it and carry no payload.  The index sorts captures by (reversed-host URL key, page_id) over range
partitions; each partition writes compressed blocks of ``BLOCK_LINES`` lines and a sparse directory with
the first key and place of every block.  A look-up binary-searches the first keys of the partitions, then
the directory of one partition, reads the range of one block, and last the range of one record.

Payload comparison moves (page_id, digest) only.  Records are compressed before they move to the task
that writes them, so pages are shuffled once, in the size of the archive.  A retried task writes its file
under its final name again, by a rename, with the same contents.

Defined cases: a null html is an empty payload; a null url has the empty key; a null page_id orders last,
refers to nothing and gets no revisit; rows that repeat a page_id with the same payload are separate
records, the first of them the response; an empty table gives an empty result and no archives; other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import new_folder, staged

BLOCK_LINES = 500
DATE = "2024-01-01T00:00:00Z"
BATCH_BYTES, FETCH_BYTES, FETCH_ROWS = 8 << 20, 32 << 20, 2000  # payload of a batch; compressed bytes, and at few bytes rows, of a task that reads back


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Reversed-host key: ``com,example)/path?query`` in lower case, without scheme, port and ``www``."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)", (url or "").strip().lower(), re.S)
    host, rest = m.group(1), m.group(2)
    labels = [x for x in re.sub(r"^www\d*\.", "", host).split(".") if x]
    return f"{','.join(reversed(labels))}){rest or '/'}" if labels or rest else ""


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp, so that equal contents are equal bytes."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def record(kind: str, page_id, url: str | None, payload: bytes, digest: str, size: int, refers_to=None) -> bytes:
    """One WARC/1.1 record.  The page's id and the payload's full size are extension fields; the id of a
    record follows from its page."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest}")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url or '')}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Page-ID: {'' if page_id is None else page_id}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (payload if kind == "response" else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


class Store:
    """Files below one shared folder, through the file system its URI names."""

    def __init__(self, root: str):
        self.fs, self.root = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", root) if root.startswith("file:") else root)

    def write(self, name: str, data: Iterator[bytes]) -> None:
        part = f"{self.root}/_{name}.{uuid.uuid4().hex}"
        self.fs.create_dir(self.root, recursive=True)
        with self.fs.open_output_stream(part) as out:
            for x in data:
                out.write(x)
        try:
            self.fs.move(part, f"{self.root}/{name}")
        except OSError:  # some stores don't rename onto a file that an earlier attempt left
            self.fs.delete_file(f"{self.root}/{name}")
            self.fs.move(part, f"{self.root}/{name}")

    def open(self, name: str):
        return self.fs.open_input_file(f"{self.root}/{name}")

    def read(self, name: str, offset: int | None = None, length: int | None = None) -> bytes:
        with self.open(name) as f:
            if offset is None:
                return f.read()
            f.seek(offset)
            return f.read(length)


def typed(pages: DataFrame) -> DataFrame:
    """page_id, url, digest, size, kind, refers_to and the compressed record of every page."""
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))

    def digests(batches):
        for b in batches:
            raw = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([payload_digest(x) for x in raw], pa.string()),
                                              pa.array([len(x) for x in raw], pa.int64())], names=["page_id", "digest", "size"])
    seen = staged(narrow.select("page_id", "payload").mapInArrow(digests, "page_id long, digest string, size long"), "digests")
    first = seen.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    # repeated payloads by page: the smallest id answers, the others revisit it
    named = seen.join(first, "digest").select("page_id", "digest", "first_id").distinct()

    def records(batches):
        for b in batches:
            rows = b.to_pydict()
            out = [(payload_digest(p), len(p), member(record("response", i, u, p, payload_digest(p), len(p))))
                   for i, u, p in zip(rows["page_id"], rows["url"], rows["payload"])]
            d, n, r = map(list, zip(*out)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d, pa.string()), pa.array(n, pa.int64()), pa.array(r, pa.binary())],
                                             names=["page_id", "url", "digest", "size", "member"])
    full = narrow.mapInArrow(records, "page_id long, url string, digest string, size long, member binary")
    full = full.select("*", F.col("page_id").alias("at_id"), F.col("digest").alias("at_digest"))
    named = named.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "first_id")
    joined = full.join(named, (F.col("at_id") == F.col("r_id")) & (F.col("at_digest") == F.col("r_digest")), "left")
    refers = F.when(F.col("first_id") < F.col("page_id"), F.col("first_id"))
    return joined.select("page_id", "url", "digest", "size", refers.alias("refers_to"),
                         F.when(refers.isNull(), F.col("member")).alias("member"),
                         (F.col("first_id") == F.col("page_id")).alias("is_first"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one archive per task below ``folder``; returns the captures: url_key, page_id, file,
    offset, length (staged)."""
    rows = staged(typed(pages), "records")
    # rows that repeat the answering page itself: all but one of them revisit it
    again = rows.where("is_first")
    nth = F.row_number().over(Window.partitionBy("digest").orderBy("url"))
    again = again.withColumn("nth", nth).select("page_id", "url", "digest", "size",
                                                F.when(F.col("nth") > 1, F.col("page_id")).alias("refers_to"),
                                                F.when(F.col("nth") == 1, F.col("member")).alias("member"))
    rows = rows.where("is_first IS NULL OR NOT is_first").drop("is_first").unionByName(again)

    def write(batches):
        from pyspark import TaskContext
        name = f"archive-{TaskContext.get().partitionId():06d}.warc.gz"
        lines = {k: [] for k in ("url_key", "page_id", "file", "offset", "length")}

        def members():
            at = 0
            for b in batches:
                r = b.to_pydict()
                for i, u, d, n, to, m in zip(*(r[c] for c in ("page_id", "url", "digest", "size", "refers_to", "member"))):
                    m = m if m is not None else member(record("revisit", i, u, b"", d, n, to))
                    for k, v in zip(lines, (url_key(u), i, name, at, len(m))):
                        lines[k].append(v)
                    at += len(m)
                    yield m
        out = members()
        start = next(out, None)
        if start is None:
            return
        Store(folder).write(name, _chain(start, out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(lines["url_key"], pa.string()), pa.array(lines["page_id"], pa.int64()), pa.array(lines["file"], pa.string()),
             pa.array(lines["offset"], pa.int64()), pa.array(lines["length"], pa.int64())], names=list(lines))
    return staged(rows.mapInArrow(write, "url_key string, page_id long, file string, offset long, length long"), "captures")


def _chain(start: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield start
    yield from rest


def _order(key: str, page_id) -> list:
    return [key, page_id is None, page_id or 0]


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> None:
    """Write the capture index below ``folder``: sorted compressed blocks, one sparse directory per
    range partition, and the list of the partitions' first keys (a line per partition)."""
    key = [F.col("url_key"), F.col("page_id").asc_nulls_last(), F.col("file"), F.col("offset")]
    ranged = captures.repartitionByRange(*key).sortWithinPartitions(*key)

    def write(batches):
        from pyspark import TaskContext
        name = f"part-{TaskContext.get().partitionId():06d}"
        directory, at, first = [], 0, None

        def blocks():
            nonlocal at, first
            lines = []

            def close():
                nonlocal at
                data = member("\n".join(json.dumps(x) for x in lines).encode())
                directory.append([_order(lines[0][0], lines[0][1]), at, len(data)])
                at += len(data)
                return data
            for b in batches:
                r = b.to_pydict()
                for line in zip(*(r[c] for c in ("url_key", "page_id", "file", "offset", "length"))):
                    first = first or _order(line[0], line[1])
                    lines.append(line)
                    if len(lines) == block_lines:
                        yield close()
                        lines.clear()
            if lines:
                yield close()
        data = blocks()
        start = next(data, None)
        if start is None:
            return
        store = Store(folder)
        store.write(f"{name}.cdx.gz", _chain(start, data))
        store.write(f"{name}.dir.gz", iter([member(json.dumps(directory).encode())]))
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(first)]), pa.array([name])], names=["first", "part"])
    top = ranged.mapInArrow(write, "first string, part string").collect()  # one row per partition
    Store(folder).write("parts.json", iter([json.dumps(sorted([json.loads(r["first"]), r["part"]] for r in top)).encode()]))


class Index:
    """Look-ups in a written index; keeps the last directory and block, which sorted look-ups reuse."""

    def __init__(self, folder: str):
        self.store = Store(folder)
        self.parts = json.loads(self.store.read("parts.json"))
        self.part, self.block, self.directory, self.lines = None, None, [], []

    def _load(self, part: int, block: int) -> None:
        if part != self.part:
            self.directory = json.loads(zlib.decompress(self.store.read(f"{self.parts[part][1]}.dir.gz"), 31))
            self.part, self.block = part, None
        if block != self.block:
            _, at, length = self.directory[block]
            raw = zlib.decompress(self.store.read(f"{self.parts[part][1]}.cdx.gz", at, length), 31)
            self.lines = [json.loads(x) for x in raw.split(b"\n")]
            self.block = block

    def captures(self, key: str, page_id=None, any_page: bool = True) -> Iterator[tuple]:
        """(page_id, file, offset, length) of the captures under ``key``; of one page if ``any_page`` is off."""
        low = [key, False, float("-inf")] if any_page else _order(key, page_id)
        part = max(bisect_right(self.parts, low, key=lambda p: p[0]) - 1, 0)
        if part and self.parts[part][0] == low:  # equal entries may begin in the partition before
            part -= 1
        first = True
        while part < len(self.parts):
            if not first and self.parts[part][0][0] > key:
                return
            self._load(part, 0 if self.part != part else self.block or 0)
            block = 0
            if first:
                block = max(bisect_right(self.directory, low, key=lambda d: d[0]) - 1, 0)
                while block and self.directory[block][0] == low:
                    block -= 1
            while block < len(self.directory):
                if self.directory[block][0][0] > key:
                    return
                self._load(part, block)
                lo = bisect_right(self.lines, low, key=lambda x: _order(x[0], x[1]))
                while lo and _order(*self.lines[lo - 1][:2]) == low:
                    lo -= 1
                for line in self.lines[lo:]:
                    if line[0] != key or not any_page and line[1] != page_id:
                        return
                    yield tuple(line[1:])
                block += 1
            part, first = part + 1, False


def lookup(wanted: DataFrame, index: str, archives: str) -> DataFrame:
    """The captures of the rows (url_key, page_id) of ``wanted``, read by ranges through the index:
    page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload, file, offset.

    The rows are dealt by ranges of the key, so a task reads neighbouring blocks once.  A row that
    occurs several times finds all captures each time; make ``wanted`` distinct."""
    key = [F.col("url_key"), F.col("page_id").asc_nulls_last()]
    found_schema = "page_id long, file string, offset long, length long"

    def find(batches):
        ix = None
        for b in batches:
            ix = ix or Index(index)
            r = b.to_pydict()
            hits = [h for k, p in zip(r["url_key"], r["page_id"]) for h in ix.captures(k, p, any_page=False)]
            cols = list(zip(*hits)) if hits else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                                              pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                                             names=["page_id", "file", "offset", "length"])

    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload", "file", "offset"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64()]

    def fetch(batches):
        store, name, f = Store(archives), None, None
        rows, held = [], 0
        for b in batches:
            r = b.to_pydict()
            for i, file, at, length in zip(r["page_id"], r["file"], r["offset"], r["length"]):
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, store.open(file)
                f.seek(at)
                fields, payload = parse(zlib.decompress(f.read(length), 31))
                kind, full = fields["WARC-Type"], int(fields["X-Payload-Length"])
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if fields["X-Page-ID"] != ("" if i is None else str(i)) or kind == "response" and (payload_digest(payload), len(payload)) != (digest, full):
                    raise ValueError(f"{file} at {at} is not the record of page {i}")
                rows.append((i, fields["WARC-Target-URI"], kind, int(fields["X-Refers-To-Page"]) if kind == "revisit" else None,
                             digest, full, payload, file, at))
                held += len(payload) + 200
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=names)
        if f is not None:
            f.close()

    found = staged(wanted.select("url_key", "page_id").repartitionByRange(*key).sortWithinPartitions(*key).mapInArrow(find, found_schema), "found")
    # the rows are narrow, the records they name are not: tasks are dealt by the bytes to read
    size = found.agg(F.sum("length").alias("bytes"), F.count("*").alias("n")).first()
    tasks = max(1, -(-(size["bytes"] or 0) // FETCH_BYTES), min(int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size["n"] // FETCH_ROWS)))
    spread = found.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return spread.mapInArrow(fetch, "page_id long, url string, record_type string, refers_to long, payload_digest string, "
                                    "payload_bytes long, payload binary, file string, offset long")


def keyed(pages: DataFrame) -> DataFrame:
    """Distinct (url_key, page_id) of a table of pages."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in b.column(0).to_pylist()], pa.string()), b.column(1)],
                                             names=["url_key", "page_id"])
    return (pages.select(F.col("url").cast("string").alias("url"), F.col("page_id").cast("long").alias("page_id"))
            .mapInArrow(run, "url_key string, page_id long").distinct())


def archive_and_read(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write archives and index of all pages, then read every capture back through the index."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    captures = write_archives(pages, f"{folder}/archives")
    write_index(captures, f"{folder}/index")
    return lookup(keyed(pages), f"{folder}/index", f"{folder}/archives")
