"""How often each word occurs in all documents, or in how many different texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import short_batches, stored, texts_of

SCHEMA = pa.schema([("word", pa.string()), ("n", pa.int64())])
#: Different words a task gathers before it hands their counts on.
GATHERED = 200_000
#: Repeated texts whose hashes are broadcast.
MOST_REPEATED = 1_000_000


def _counts(batches: Iterator[pa.RecordBatch], split, refine) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for _, texts in texts_of(batches):
        for text in texts:
            seen.update(split(text))
            if len(seen) >= GATHERED:
                yield from _rows(_refined(seen, refine))
                seen = Counter()
    yield from _rows(_refined(seen, refine))
    if hasattr(split, "forget"):
        split.forget()


def _refined(seen: Counter, refine) -> Counter:
    if refine is None:
        return seen
    out: Counter = Counter()
    for part, n in seen.items():
        for word in refine(part):
            out[word] += n
    return out


def _rows(seen: Counter) -> Iterator[pa.RecordBatch]:
    words = list(seen)
    for lo in range(0, len(words), 20_000):
        part = words[lo:lo + 20_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([seen[w] for w in part], pa.int64())], schema=SCHEMA)


def different_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(text): every different text once; a null text is an empty one. While few texts are repeated,
    only copies of these are moved."""
    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    again = stored(hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "repeated")
    if again.limit(MOST_REPEATED + 1).count() > MOST_REPEATED:
        return rows.distinct()
    again = F.broadcast(again)
    once = hashed.join(again, "hash", "left_anti").select("text")
    return once.union(hashed.join(again, "hash", "left_semi").select("text").distinct())


def frequent_words(docs: DataFrame, split, most: int, text: str = "text", refine=None) -> list[tuple[str, int]]:
    """The most frequent words with their counts over all documents, in order; ties by word.

    It is as many counts as give no more than ``most`` words; a count whose words don't all fit is
    left out, and so are words that occur once. Only that many rows reach the driver, however
    many partitions the counts are in. ``split`` is a function of a module; so is ``refine``, which gives the
    words of what ``split`` returns and is asked once for what a task has counted many times.
    """
    short_batches(docs.sparkSession)
    counts = docs.select(text).mapInArrow(partial(_counts, split=split, refine=refine), "word string, n long")
    counts = stored(counts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"), "words")
    # Every count has a word, so the highest ``most`` counts are enough to look at.
    heights = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(most)
    taken, least = 0, None
    for r in heights.collect():
        taken += r.words
        if taken > most:
            break
        least = r.n
    if least is None:
        return []
    return sorted(((r.word, r.n) for r in counts.where(F.col("n") >= least).collect()), key=lambda x: (-x[1], x[0]))
