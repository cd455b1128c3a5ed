"""Removal of passages that stand earlier in the corpus, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document; a word is removed if a window over it
has the same words as a window that starts earlier (smaller doc_id, or same document and earlier
start). Windows are judged on the input, not on what is left of it.

The minimiser of a window is the smallest hash of ``MER`` words inside it. Neighbouring windows
mostly share theirs, so they travel together as one string of words to the bucket of the
minimiser, a few words for each word of text instead of twenty. Equal windows have equal
minimisers and meet in one bucket, where sorting brings them together word for word.

Before the strings travel, the minimisers alone are counted: a window whose minimiser stands once
in the corpus is unlike any other and stays home. Counts of two and more are kept as a bit map of
fixed size; where it grows full, more strings travel and nothing else changes.

Popular passages: a task sends a string once however often it meets it, and marks the later ones
itself, so a bucket gets at most one copy of a string from each task. Minimisers that stand more than
``HOT_STRINGS`` times are split further: their windows travel one by one to buckets by the hash of all
their words. They are kept in a second bit map, so however many there are, a bucket of strings stays
bounded; a minimiser that shares a bit with one of them is split too, in every task alike.

Cases: null and empty texts, and texts shorter than a window, lose nothing. Documents without id
come after all others. Rows that share their id count as one document: places with equal id and
start are none the earlier. Repeated rows get equal results. Long texts count whole: all their windows
are judged. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import NewFile, batch, open_store, read_file, shared_file, short_batches, stored, texts_of, words_of

WINDOW, MER = 20, 6
#: Most occurrences of a minimiser whose windows travel as strings.
HOT_STRINGS = 20_000
#: Bits of the maps of repeated and of hot minimisers, as a power of two.
MAP_BITS = 27
#: Strings that a task remembers having sent.
SENT = 500_000
NO_ID = (1 << 63) - 1

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: One odd factor for each word of a mer; the words' hashes are mixed already.
_FACTORS = _mixed(np.arange(1, MER + 1, dtype="u8")) | _U(1)


def super_kmers(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, end) of each run of windows with one minimiser, and the hashes of
    all mers."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.empty(0, "u8"), np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, "u8")
    hashes = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype("u8")
    mers = np.zeros(len(words) - MER + 1, "u8")
    for i in range(MER):
        mers += hashes[i:i + len(mers)] * _FACTORS[i]
    least = mers = _mixed(mers)
    width, span = 1, WINDOW - MER + 1
    while width < span:  # minima over doubled widths, the last step overlapping
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    starts = np.r_[0, np.flatnonzero(least[1:] != least[:-1]) + 1]
    return least[starts], starts, np.r_[starts[1:], n], mers


def minimisers_of(words: list[str]) -> np.ndarray:
    """The minimiser of each run; once more if its words stand elsewhere in the document, so that
    windows repeated inside one run count as repeated."""
    found, _, _, mers = super_kmers(words)
    ordered = np.sort(mers)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    return np.concatenate([found, found[np.isin(found, twice)]]) if len(twice) else found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
    for _, texts in texts_of(batches):
        found = [minimisers_of(words_of(t)) for t in texts]
        buckets, n = np.unique(np.concatenate([np.empty(0, "u8"), *found]).view("i8"), return_counts=True)
        yield batch(schema, pa.array(buckets), pa.array(n.astype("i8")))


SENT_ROWS = pa.schema([("bucket", pa.int64()), ("rid", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("packed", pa.string())])
SENT_DDL = "bucket long, rid long, text_hash long, start long, stop long, packed string"


def _in_map(bits: np.ndarray, minimisers: np.ndarray) -> np.ndarray:
    bit = minimisers & _U((1 << MAP_BITS) - 1)
    return (bits[(bit >> _U(3)).astype("i8")] >> (bit & _U(7)).astype("u1")) & 1


def _send(batches: Iterator[pa.RecordBatch], bits: str, hot_bits: str) -> Iterator[pa.RecordBatch]:
    """Strings for the buckets; and, without a string, the places already known to be repeated.

    ``start`` and ``stop`` are words: a string covers them, a repeated place is removed.
    """
    repeated, hot = _read_map(bits), _read_map(hot_bits)
    sent: dict[bytes, tuple[int, int]] = {}
    for rows, texts in texts_of(batches, 2):
        out: list[tuple] = []

        def offer(bucket: int | None, rid: int, text_hash: int, start: int, stop: int, packed: str) -> None:
            key, here = xxhash.xxh3_128_digest(packed), (rid, start)
            before = sent.get(key)
            if before is not None and here > before:
                # Its bucket is any: the places of a popular passage are dealt out evenly.
                out.append(((text_hash ^ start * 0x9E3779B97F4A7C15 & NO_ID) % (1 << 63), rid, text_hash, start, stop, None))
                return
            if len(sent) >= SENT:
                sent.clear()
            sent[key] = here
            if bucket is None:
                bucket = xxhash.xxh3_64_intdigest(packed) - (1 << 63)
            out.append((bucket, rid, text_hash, start, stop, packed))

        for rid, text_hash, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), texts):
            words = words_of(text)
            minimisers, starts, ends, _ = super_kmers(words)
            if not len(starts):
                continue
            keep = _in_map(repeated, minimisers)
            if not keep.any():
                continue
            split = _in_map(hot, minimisers)
            plain, at = " ".join(words), np.cumsum([0, *[len(w) + 1 for w in words]])
            for i in np.flatnonzero(keep):
                bucket, first, end = int(minimisers[i].astype("i8")), int(starts[i]), int(ends[i])
                if split[i]:
                    for w in range(first, end):
                        offer(None, rid, text_hash, w, w + WINDOW, plain[at[w]:at[w + WINDOW] - 1])
                else:
                    offer(bucket, rid, text_hash, first, end + WINDOW - 1, plain[at[first]:at[end + WINDOW - 1] - 1])
        if out:
            yield batch(SENT_ROWS, *map(list, zip(*out)))


PLACES = pa.schema([("rid", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
PLACES_DDL = "rid long, text_hash long, start long, stop long"


def _runs(starts: list[int]) -> Iterator[tuple[int, int]]:
    """Words under the windows at these ascending starts, as (start, stop)."""
    low = high = None
    for s in starts:
        if high is not None and s <= high:
            high = s + WINDOW
        else:
            if high is not None:
                yield low, high
            low, high = s, s + WINDOW
    if high is not None:
        yield low, high


def resolve(rows: list[tuple[str, int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(rid, text_hash, start, stop) of repeated places among one bucket's (packed, rid, start,
    text_hash)."""
    rows.sort()
    windows = []
    for packed, same in groupby(rows, itemgetter(0)):
        words = packed.split(" ")
        (_, rid, start, text_hash), *later = same
        first = [(rid, start, text_hash)]
        for _, r, s, h in later:
            if (r, s) > (rid, start):
                yield r, h, s, s + len(words)
            else:
                first.append((r, s, h))
        at = np.cumsum([0, *[len(w) + 1 for w in words]]).tolist()
        windows += [(packed[at[i]:at[i + WINDOW] - 1], r, s + i, h) for i in range(len(words) - WINDOW + 1) for r, s, h in first]
    windows.sort()
    repeated: dict[tuple[int, int], list[int]] = {}
    owner = before = None
    for window, rid, start, text_hash in windows:
        if window != before:
            before, owner = window, (rid, start)
        elif (rid, start) > owner:
            repeated.setdefault((rid, text_hash), []).append(start)
    for (rid, text_hash), starts in repeated.items():
        for low, high in _runs(sorted(starts)):
            yield rid, text_hash, low, high


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bucket, held = None, []
    for rows in batches:
        out = []
        for b, rid, text_hash, start, stop, packed in zip(*[c.to_pylist() for c in rows.columns]):
            if packed is None:
                out.append((rid, text_hash, start, stop))
                continue
            if b != bucket:
                out += resolve(held)
                bucket, held = b, []
            held.append((packed, rid, start, text_hash))
        if out:
            yield batch(PLACES, *map(list, zip(*out)))
    if held and (out := list(resolve(held))):
        yield batch(PLACES, *map(list, zip(*out)))


#: The map is kept in so many files of equal length; one without a bit isn't written.
MAP_FILES = 16
FILE_BYTES = (1 << MAP_BITS) // 8 // MAP_FILES


def _write_map(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Rows (file, at, bits) come in the order of the files."""
    now, bits = None, np.zeros(0, "<i8")

    def close() -> None:
        if now is not None:
            out = NewFile(f"{folder}/{now}")
            out.write(bits.tobytes())
            out.close()

    for rows in batches:
        file, at, value = (c.to_numpy() for c in rows.columns)
        for f in np.unique(file):
            if f != now:
                close()
                now, bits = int(f), np.zeros(FILE_BYTES // 8, "<i8")
            bits[at[file == f] % (FILE_BYTES // 8)] = value[file == f]
        yield pa.record_batch({"n": pa.array([rows.num_rows], pa.int64())})
    close()


def _bit_map(counts: DataFrame, folder: str) -> None:
    """Write a map of these minimisers. It has ``2 ** MAP_BITS`` bits at any size of corpus."""
    place = F.col("bucket").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    one = F.expr("shiftleft(1L, cast(bucket & 63 AS int))")
    parts = counts.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(one).alias("bits"))
    filed = parts.select((F.col("at") / (FILE_BYTES // 8)).cast("int").alias("file"), "at", "bits")
    filed.repartition("file").sortWithinPartitions("file").mapInArrow(partial(_write_map, folder=folder), "n long").agg(F.sum("n")).collect()


def _read_map(folder: str) -> np.ndarray:
    store, path = open_store(folder)
    bits = np.zeros(FILE_BYTES * MAP_FILES, "u1")
    for i in range(MAP_FILES):
        if store.get_file_info(f"{path}/{i}").type == fs.FileType.File:
            bits[i * FILE_BYTES:(i + 1) * FILE_BYTES] = np.frombuffer(read_file(f"{folder}/{i}"), "u1")
    return bits


def repeated_places(docs: DataFrame) -> DataFrame:
    """(rid, text_hash, start, stop): words [start, stop) that stand earlier. ``docs`` has rid,
    text_hash and text."""
    spark = docs.sparkSession
    counts = stored(
        docs.select("text").mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where("n > 1"),
        "minimisers")
    bits, hot_bits = shared_file(spark, "minimiser-map"), shared_file(spark, "hot-map")
    _bit_map(counts, bits)
    _bit_map(counts.where(F.col("n") > HOT_STRINGS), hot_bits)
    rows = docs.select("rid", "text_hash", "text").mapInArrow(partial(_send, bits=bits, hot_bits=hot_bits), SENT_DDL)
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_resolve, PLACES_DDL)


KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in texts_of(batches, 1):
        out = []
        for doc_id, text, places in zip(rows.column(0).to_pylist(), texts, rows.column(2).to_pylist()):
            kept = words = words_of(text)
            if places:
                gone = np.zeros(len(words) + 1, "i4")
                for p in places:
                    gone[p["start"]] += 1
                    gone[p["stop"]] -= 1
                kept = [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]
            out.append((doc_id, len(words), len(words) - len(kept), " ".join(kept)))
        if out:
            yield batch(KEPT, *map(list, zip(*out)))


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): what is left of each document, words joined by a space."""
    short_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
    ).select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("rid"), F.xxhash64("text").alias("text_hash"), "text")
    places = stored(repeated_places(rows), "repeats").groupBy("rid", "text_hash").agg(
        F.collect_list(F.struct("start", "stop")).alias("places"))
    joined = rows.join(places, ["rid", "text_hash"], "left")
    return joined.select("doc_id", "text", "places").mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")
