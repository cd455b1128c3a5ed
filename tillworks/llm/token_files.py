"""Token ids in files that give single short documents quickly.

Every document's ids are one zstandard frame, compressed with a dictionary that all files share.
The dictionary is trained on the serialized ids of a bounded sample of documents; it only affects
size. A file keeps the hash of its dictionary, and at its end the ids, offsets and lengths of its
documents, so one document takes one range read.

Layout (little-endian)::

    magic  dictionary sha-256  frame frame ...
    doc ids int64[n]  id present uint8[n]  offsets uint64[n + 1]  token counts uint32[n]
    n uint64  index offset uint64  magic

Documents are encoded once, where they lie; only the compressed ids are sorted by ``doc_id``.
Numbers of equal documents and rows with the same id stand next to each other; rows without an
id come last. Null and empty texts have the end id alone. An empty table gives no files.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm.common import NewFile, batch, open_store, short_batches, stored, texts_of
from tillworks.llm.pretokens import BYTE_PIECES, Memo, common, in_byte_letters

MAGIC = b"TWIDS001"
TAIL = "<QQ8s"

#: The dictionary is trained on so many documents at most, and so many characters of each.
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 2000, 16_000, 65_536
LEVEL = 3
#: Pieces whose ids a worker remembers.
REMEMBERED = 400_000

_coders: dict = {}


class ByteCoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, as the library gives them."""

    def __init__(self, vocabulary: str, end_id: int) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.end = struct.pack("<I", end_id)
        self.model = self.library.model
        self.memo = Memo(self._piece_ids, REMEMBERED)

    def _piece_ids(self, piece: str) -> bytes:
        """A piece that the pattern would not split further: the library's merges alone."""
        return array("I", [t.id for t in self.model.tokenize(in_byte_letters(piece))]).tobytes()

    def _library_ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if common(text):
            return b"".join(map(self.memo.__getitem__, BYTE_PIECES.findall(text))) + self.end
        return self._library_ids(text) + self.end


def coder(vocabulary: str, end_id: int) -> ByteCoder:
    """One for each task."""
    if (vocabulary, end_id) not in _coders:
        _coders[vocabulary, end_id] = ByteCoder(vocabulary, end_id)
    return _coders[vocabulary, end_id]


def train(samples: list[bytes]) -> bytes:
    """A dictionary for the samples; few samples serve as one as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES] or b"no tokens"


def _learn(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encode = coder(vocabulary, end_id).ids
    samples = [encode(t) for _, texts in texts_of(batches) for t in texts]
    yield pa.record_batch({"dictionary": pa.array([train(samples)], pa.binary())})


def shared_dictionary(docs: DataFrame, vocabulary: str, end_id: int) -> bytes:
    """Trained on the different texts whose hash is smallest: any texts, but the same each time."""
    hashed = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    last = hashed.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    if last is None:
        return train([])
    sample = hashed.where(F.col("h") <= last).groupBy("h").agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
    in_one_place = sample.orderBy("h").select("text").coalesce(1)  # SAMPLE_DOCS rows
    rows = in_one_place.mapInArrow(partial(_learn, vocabulary=vocabulary, end_id=end_id), "dictionary binary").collect()
    return bytes(rows[0].dictionary)


def encoded(docs: DataFrame, vocabulary: str, end_id: int, dictionary: bytes) -> DataFrame:
    """(doc_id, n_tokens, frame) of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("frame", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = coder(vocabulary, end_id).ids
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True)
        try:
            for rows, texts in texts_of(batches, 1):
                ids = [to_ids(t) for t in texts]
                yield batch(schema, rows.column(0), [len(x) // 4 for x in ids], [pack.compress(x) for x in ids])
        finally:
            _coders.clear()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, n_tokens long, frame binary")


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Write the files; returns (file, n_docs, first_token, n_tokens) in the order of the files.

    ``first_token`` is the number of ids in all files before.
    """
    spark = docs.sparkSession
    short_batches(spark)
    docs = docs.select("doc_id", "text")
    dictionary = shared_dictionary(docs, vocabulary, end_id)
    digest = hashlib.sha256(dictionary).digest()
    out = NewFile(f"{folder}/dictionary")
    out.write(dictionary)
    out.close()
    schema = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, shard = None, TaskContext.get().partitionId()
        doc_ids, offsets, counts = [], [], []
        for rows in batches:
            if file is None and rows.num_rows:
                file = NewFile(uri := f"{folder}/shard-{shard:06d}.ids")
                file.write(MAGIC + digest)
            for doc_id, n, frame in zip(*(c.to_pylist() for c in rows.columns)):
                doc_ids.append(doc_id)
                counts.append(n)
                offsets.append(file.write(frame))
        if file is None:
            return
        offsets.append(file.size)
        at = file.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
        file.write(np.array([d is not None for d in doc_ids], "u1").tobytes())
        file.write(np.array(offsets, "<u8").tobytes())
        file.write(np.array(counts, "<u4").tobytes())
        file.write(struct.pack(TAIL, len(doc_ids), at, MAGIC))
        file.close()
        yield batch(schema, [shard], [uri], [len(doc_ids)], [sum(counts)])

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("frame")]
    frames = stored(encoded(docs, vocabulary, end_id, dictionary), "frames")
    shards = stored(
        frames.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(save, "shard int, file string, n_docs long, n_tokens long"), "shards",
    )
    before, rows = 0, []
    for r in shards.orderBy("shard").collect():  # one row a file
        rows.append((r.file, r.n_docs, before, r.n_tokens))
        before += r.n_tokens
    return spark.createDataFrame(rows, "file string, n_docs long, first_token long, n_tokens long")


class TokenFile:
    """Random access to the documents of one file."""

    def __init__(self, uri: str, dictionary: bytes) -> None:
        store, path = open_store(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        n, at, magic = struct.unpack(TAIL, self._read(size - struct.calcsize(TAIL), struct.calcsize(TAIL)))
        if magic != MAGIC or self._read(0, 40) != MAGIC + hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} isn't a token file of this dictionary")
        index = self._read(at, 8 * n + n + 8 * (n + 1) + 4 * n)
        self.doc_ids = np.frombuffer(index, "<i8", n)
        self.has_id = np.frombuffer(index, "u1", n, 8 * n)
        self.offsets = np.frombuffer(index, "<u8", n + 1, 9 * n)
        self.counts = np.frombuffer(index, "<u4", n, 9 * n + 8 * (n + 1))
        self.unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document: one range read."""
        at, to = int(self.offsets[i]), int(self.offsets[i + 1])
        return np.frombuffer(self.unpack.decompress(self._read(at, to - at)), "<u4")


def read(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, from the files alone."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(f"{folder}/dictionary")
        with store.open_input_stream(path) as f:
            dictionary = f.read()
        for rows in batches:
            for uri, first in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                file = TokenFile(uri, dictionary)
                for lo in range(0, len(file), 4096):
                    ids = [file.ids(i) for i in range(lo, min(lo + 4096, len(file)))]
                    n = [len(x) for x in ids]
                    starts = first + np.concatenate([[0], np.cumsum(n)]).astype("i8")
                    known = [int(d) if h else None for d, h in zip(file.doc_ids[lo:lo + 4096], file.has_id[lo:lo + 4096])]
                    yield batch(schema, known, starts[:-1], n, [zlib.crc32(x.tobytes()) for x in ids])
                    first = int(starts[-1])

    # One file, one task.
    one_each = files.select("file", "first_token").repartition(max(1, files.count()), "file")
    return one_each.mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long")
