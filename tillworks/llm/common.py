"""Helpers the operators share: words, working tables, files in the shared folder."""

from __future__ import annotations

import mmap
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.session import fresh_path

#: A word is a longest run of characters other than these six ASCII white-space characters.
WHITE = "\t\n\x0b\x0c\r "
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_GAP_SQL = r"[\x20\x09-\x0D]+"

SHIPPED = "tillworks-package.zip"
#: Rows and bytes in one Arrow batch. Texts may be long, so batches are kept short.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


#: What str.split() would split at besides: words keep these.
OTHER_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in WHITE]


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    if any(map(text.__contains__, OTHER_WHITE)):
        return WORD.findall(text)
    return text.split()


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Make ready for Python on the executors: this package goes along, and texts are handed over
    a few hundred at a time, fewer if they are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if not any(f.rpartition("/")[2] == SHIPPED for f in context._python_includes):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = os.path.join(tempfile.mkdtemp(prefix="run-"), SHIPPED.removesuffix(".zip"))
        context.addPyFile(shutil.make_archive(archive, "zip", root, "tillworks"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: later steps don't compute it again,
    and a lost executor costs nothing that was written."""
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def numbered(frame: DataFrame, column: str) -> tuple[DataFrame, str, list[str]]:
    """The frame under column names that clash with nothing, the new name of ``column``, and the
    old names in order."""
    names = [f"_{i}" for i in range(len(frame.columns))]
    return frame.toDF(*names), names[frame.columns.index(column)], frame.columns


def word_array(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_GAP_SQL)
    return F.filter(parts, lambda w: w != "")


#: Schemes of Hadoop's own clients and the ones the same stores have here; the rest are equal.
SAME_STORE = {"s3a": "s3", "s3n": "s3"}


def shared_file(spark: SparkSession, name: str) -> str:
    """An unused address in the shared folder for files that tasks write themselves.

    A folder without a scheme lies where Hadoop's configuration says, as it does for Spark's tables.
    One that tasks can't open is refused here, before any work. A folder of a local disk has to be
    mounted on all machines. Credentials of object stores are those of the machines' environment.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(fresh_path(spark, name))
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    open_store(uri)
    return uri


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path in the shared folder, and the path in it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    scheme, _, rest = uri.partition("://")
    try:
        return fs.FileSystem.from_uri(f"{SAME_STORE.get(scheme, scheme)}://{rest}")
    except (pa.ArrowInvalid, OSError) as e:
        raise ValueError(f"tasks can't open files at {uri}: name another folder in spark.checkpoint.dir") from e


class NewFile:
    """A file that appears under its name only when it is whole.

    Each attempt of a task writes to a name of its own, so a lost or doubled attempt leaves
    at most an unfinished file that no reader looks at.
    """

    def __init__(self, uri: str) -> None:
        self.store, self.path = open_store(uri)
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.unfinished = f"{self.path}.{uuid.uuid4().hex}.unfinished"
        self.out = self.store.open_output_stream(self.unfinished)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; returns where the data begin."""
        at = self.size
        self.out.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self.out.close()
        self.store.move(self.unfinished, self.path)


def read_file(uri: str) -> bytes:
    store, path = open_store(uri)
    with store.open_input_stream(path) as f:
        return f.read()


def mapped(uri: str) -> mmap.mmap:
    """A shared file mapped into memory; one from an object store is first fetched to this
    worker's own temporary folder."""
    store, path = open_store(uri)
    if not isinstance(store, fs.LocalFileSystem):
        handle, path = tempfile.mkstemp()
        with os.fdopen(handle, "wb") as f:
            f.write(read_file(uri))
    with open(path, "rb") as f:
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
    )


def texts_of(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each batch with its texts; a null text is an empty one."""
    for rows in batches:
        yield rows, [t or "" for t in rows.column(column).to_pylist()]
