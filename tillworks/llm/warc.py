"""WARC archives with a two-level capture index.

Writing: one record per page in gzip members of their own. Of pages with equal payloads of at
least ``REVISIT_BYTES`` bytes the one with the largest page_id is a response and the others are
revisits that refer to it; smaller payloads are all responses.

The index has two levels. The first holds one line per capture, sorted by a key that begins with
the host reversed, in compressed blocks. The second, the block directory, holds the first and last
key and the place of each block and is a few thousandths of the first. The task that sorts a range of
keys writes the directory of its blocks beside them, in sections of ``SECTION_BLOCKS`` lines with a
table of their places; the root has a line for each of these files. A capture is found by a
binary search of the root, one of the file's sections by range reads, one inside a section, one range
read of a block, a binary search inside it, and one range read of the record. The driver sees, and
a task holds, the root and one section, never the directory.

A key ends with the page_id, so a host or an address with very many captures is spread over many
blocks and tasks. Null pages have an empty payload; null addresses an empty key. Rows that share
their page_id are captures of one page: they keep a record each, and those that share the
response's page_id and payload are all responses. Rows without page_id come after the others and
are a response only if no row with one has the payload. Very long payloads are records of their own
size, written whole; an empty table gives no files but an empty root. Extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm.common import NewFile, batch, open_store, read_file, short_batches, stored

REVISIT_BYTES = 1000
#: Captures in one block of the index.
BLOCK_LINES = 500
#: Blocks in one section of the directory.
SECTION_BLOCKS = 256
#: Records that lie this close are fetched with one range read.
GAP_BYTES = 64_000
MOST_RANGE = 4_000_000
NO_PAGE = -1 << 63

CAPTURE = "key string, page_id long, archive string, at long, size long"
CAPTURES = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()), ("at", pa.int64()), ("size", pa.int64())])


def reversed_host_key(url: Column) -> Column:
    """Address with its host turned round, without scheme and fragment: ``com,example,www)/path``."""
    plain = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://|#.*$|[\x00-\x20]", "")
    host = F.lower(F.regexp_extract(plain, r"^([^/?:]*)", 1))
    rest = F.regexp_replace(plain, r"^[^/?:]*(:\d+)?", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def with_roles(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, key, refers_to, record_type) of every page.

    Only digests, sizes and ids are grouped; a popular payload is first reduced where it lies.
    Repeated digests are stored, so Spark sees their size before it plans the join: few go to the
    pages and no payload moves. Where they are many, pages without a partner have a key each.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).select("*", F.sha1("payload").alias("digest"), reversed_host_key(F.col("url")).alias("key"))
    large = F.octet_length("payload") >= REVISIT_BYTES
    shared = stored(
        rows.where(large).groupBy("digest").agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1").select(F.col("digest").alias("_digest"), "_last"), "repeated-payloads")
    alone = F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    joined = rows.join(shared, F.when(large, F.col("digest")).otherwise(alone) == F.col("_digest"), "left")
    revisit = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    return joined.select(
        "page_id", "url", "payload", "digest", "key", F.when(revisit, F.col("_last")).alias("refers_to"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
    )


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit has no payload of its own; its header keeps digest and length."""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Full-Payload-Length: {len(payload)}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"), "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: text/html; charset=utf-8",
    ]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[:int(headers["Content-Length"])]


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    uri, out = f"{folder}/archive-{TaskContext.get().partitionId():06d}.warc.gz", None
    for rows in batches:
        places, pages, keys = [], rows.column(0).to_pylist(), rows.column(6).to_pylist()
        for values in zip(*[c.to_pylist() for c in rows.columns[:6]]):
            out = out or NewFile(uri)
            data = gzip.compress(record(*values), compresslevel=5, mtime=0)
            places.append((out.write(data), len(data)))
        keys = [f"{k} {NO_PAGE if p is None else p:020d}" for k, p in zip(keys, pages)]
        yield batch(CAPTURES, keys, pages, [uri] * len(keys), [p[0] for p in places], [p[1] for p in places])
    if out:
        out.close()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one archive per task; returns where every capture lies."""
    short_batches(pages.sparkSession)
    rows = with_roles(pages).select("page_id", "url", "payload", "digest", "record_type", "refers_to", "key")
    return stored(rows.mapInArrow(partial(_write, folder=folder), CAPTURE), "captures")


ROOT = "first_key string, last_key string, file string, table long, sections long"
ROOTS = pa.schema([("first_key", pa.string()), ("last_key", pa.string()), ("file", pa.string()), ("table", pa.int64()), ("sections", pa.int64())])
PLACE = struct.Struct("<Q")


def _lines(rows: list) -> bytes:
    return "\n".join(["\t".join(map(str, x)) for x in rows]).encode()


def _write_blocks(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """The blocks of one range of keys, and their directory: sections, then the table of the
    sections' beginnings, its last entry their end."""
    number = f"{TaskContext.get().partitionId():06d}"
    uri, directory_uri = f"{folder}/captures-{number}.gz", f"{folder}/directory-{number}"
    out = directory = low = high = None
    lines, section, places = [], [], []

    def close_block() -> None:
        data = gzip.compress(_lines(lines), mtime=0)
        section.append((lines[0][0], lines[-1][0], uri, out.write(data), len(data)))
        lines.clear()
        if len(section) == SECTION_BLOCKS:
            close_section()

    def close_section() -> None:
        places.append(directory.write(_lines(section)))
        section.clear()

    for rows in batches:
        for line in zip(*[c.to_pylist() for c in rows.columns]):
            if out is None:
                out, directory, low = NewFile(uri), NewFile(directory_uri), line[0]
            lines.append(line)
            high = line[0]
            if len(lines) == BLOCK_LINES:
                close_block()
    if out is None:
        return
    if lines:
        close_block()
    if section:
        close_section()
    table = directory.size
    directory.write(b"".join(map(PLACE.pack, [*places, table])))
    out.close()
    directory.close()
    yield batch(ROOTS, [low], [high], [directory_uri], [table], [len(places)])


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sort the captures by key into compressed blocks with their directories; returns a row for each
    task's files."""
    lines = captures.select("key", F.coalesce("page_id", F.lit(NO_PAGE)).alias("page_id"), "archive", "at", "size")
    ordered = lines.repartitionByRange("key").sortWithinPartitions("key", "archive", "at")
    return stored(ordered.mapInArrow(partial(_write_blocks, folder=folder), ROOT), "index-root")


def save_root(files: DataFrame, uri: str) -> None:
    """The root in one file, a line for each task of the sort."""
    out = NewFile(uri)
    out.write(_lines(files.orderBy("first_key").collect()))
    out.close()


def fetch(uri: str, at: int, size: int) -> bytes:
    store, path = open_store(uri)
    with store.open_input_file(path) as f:
        f.seek(at)
        return f.read(size)


class CaptureIndex:
    """Look-up from the root down. The last section and block read are kept."""

    def __init__(self, root: str) -> None:
        rows = [line.split("\t") for line in read_file(root).decode().split("\n") if line]
        self.first, self.last = [r[0] for r in rows], [r[1] for r in rows]
        self.files = [(r[2], int(r[3]), int(r[4])) for r in rows]
        self.section: tuple = (None, [])
        self.block: tuple = (None, [])
        self.reads = 0

    def _fetch(self, *place) -> list[list[str]]:
        self.reads += 1
        data = fetch(*place)
        return [x.split("\t") for x in (gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data).decode().split("\n")]

    def _section(self, file: int, number: int) -> list[list[str]]:
        if self.section[0] != (file, number):
            uri, table, _ = self.files[file]
            low, high = struct.unpack("<2Q", fetch(uri, table + PLACE.size * number, 2 * PLACE.size))
            self.section = (file, number), self._fetch(uri, low, high - low)
        return self.section[1]

    def _first_section(self, file: int, key: str) -> int:
        """The first one that ends at or after the key."""
        at, rows = self.section
        if at and at[0] == file and rows[0][0] < key <= rows[-1][1]:
            return at[1]
        low, high = 0, self.files[file][2] - 1
        while low < high:
            middle = (low + high) // 2
            if self._section(file, middle)[-1][1] < key:
                low = middle + 1
            else:
                high = middle
        return low

    def _blocks(self, low: str, high: str) -> Iterator[list[str]]:
        """Directory lines of the blocks that may hold keys from low to high."""
        file = bisect_left(self.last, low)
        while file < len(self.files) and self.first[file] <= high:
            for number in range(self._first_section(file, low), self.files[file][2]):
                rows = self._section(file, number)
                for row in rows[bisect_left(rows, low, key=lambda r: r[1]):]:
                    if row[0] > high:
                        return
                    yield row
            file += 1

    def between(self, low: str, high: str) -> Iterator[tuple[str, str, int, int]]:
        """(key, archive, at, size) of the captures with ``low <= key <= high``."""
        for _, _, *place in self._blocks(low, high):
            if self.block[0] != place:
                self.block = place, self._fetch(place[0], int(place[1]), int(place[2]))
            lines = self.block[1]
            keys = [x[0] for x in lines]
            for key, _, archive, at, size in lines[bisect_left(keys, low):bisect_right(keys, high)]:
                yield key, archive, int(at), int(size)

    def find(self, key: str) -> list[tuple[str, str, int, int]]:
        """Every capture of an address, or of one page with the page_id at the key's end."""
        return list(self.between(key, key)) if key[-21:-20] == " " else list(self.between(f"{key} ", f"{key} ~"))


def _locate(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    index, before = None, None
    schema = pa.schema([("archive", pa.string()), ("at", pa.int64()), ("size", pa.int64())])
    for rows in batches:
        index = index or CaptureIndex(root)
        found = []
        for key in rows.column(0).to_pylist():  # sorted, so equal keys follow each other
            if key != before:
                found += index.find(key)
            before = key
        yield batch(schema, [x[1] for x in found], [x[2] for x in found], [x[3] for x in found])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records at sorted places; neighbours share a range read."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])
    for rows in batches:
        wanted = list(zip(*[c.to_pylist() for c in rows.columns]))
        out, i = [], 0
        while i < len(wanted):
            archive, low, size = wanted[i]
            high, k = low + size, i + 1
            while k < len(wanted) and wanted[k][0] == archive and wanted[k][1] <= high + GAP_BYTES and high - low < MOST_RANGE:
                high, k = max(high, wanted[k][1] + wanted[k][2]), k + 1
            data = fetch(archive, low, high - low)
            for _, at, size in wanted[i:k]:
                out.append(_row(*parse(zlib.decompress(data[at - low:at - low + size], 31))))
            i = k
        yield batch(schema, *map(list, zip(*out))) if out else batch(schema, *[[]] * 6)


def _row(head: dict[str, str], payload: bytes) -> tuple:
    number = lambda name: (lambda x: int(x) if x else None)(head[name][len("<urn:page:"):-1])
    page, digest = number("WARC-Record-ID"), head["WARC-Payload-Digest"].removeprefix("sha1:")
    if head["WARC-Type"] == "revisit":
        return page, int(head["WARC-Full-Payload-Length"]), digest, "revisit", number("WARC-Refers-To"), head["WARC-Target-URI"]
    found = hashlib.sha1(payload).hexdigest()
    if found != digest:
        raise ValueError(f"page {page}: payload doesn't match its digest")
    return page, len(payload), found, "response", None, head["WARC-Target-URI"]


def look_up(keys: DataFrame, root: str) -> DataFrame:
    """The records of the given keys (column ``key``): page_id, payload_bytes, payload_digest,
    record_type, refers_to, url. Keys are sorted over the cluster, so each task opens a run of
    neighbouring blocks once; places are then sorted by archive for the range reads."""
    ordered = keys.select("key").repartitionByRange("key").sortWithinPartitions("key")
    places = ordered.mapInArrow(partial(_locate, root=root), "archive string, at long, size long")
    near = stored(places, "places").repartitionByRange("archive", "at").sortWithinPartitions("archive", "at")
    return near.mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archive(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Write archives and index under ``folder``; returns the keys of all captures."""
    captures = write_archives(pages, folder)
    save_root(write_index(captures, folder), f"{folder}/directory")
    return captures.select("key")
