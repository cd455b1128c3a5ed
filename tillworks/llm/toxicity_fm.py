"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms - words, and the beginnings of long words - hashed to ``2 **
BITS`` places. The machine adds a weight for each term and, for each pair of terms, the product
of their factors: an insult next to the mention of a group can weigh more than the two alone,
which no additive weight expresses. Pair sums cost as much as single ones, by
``((sum v)^2 - sum v^2) / 2``. One further term, the ground, stands in every document, so a pair with
it is a learnt weight of the other term alone.

A weight's input is how far its term leans to either kind. A factor's input is that and the term's
presence, divided by the root of the document's number of terms: two terms that lean nowhere alone
still weigh together (one but not both, both or neither). Terms of fewer than ``COMMON`` learnt
documents have no presence, so none is learnt by heart.

Training takes a bounded sample of labelled documents (``MOST_TOXIC`` and ``MOST_CLEAN`` of
smallest id hash), a missed toxic one at ``MISSED`` times the cost of a flagged clean one; the intercept is then moved back to the shares among all labelled rows.
Scoring covers every document. Labels, language, source and id are no inputs of a score.

Cases: long texts count with all their terms; an empty table gives no rows. Null and empty texts have no terms and score the intercept. Rows without an id
are not held out. Of several texts of a labelled id the one of smallest hash is learnt from. An id labelled twice counts as toxic if any label says so. Without labels of
both kinds every score is the (smoothed) share. Extra columns are ignored; equal texts get equal
scores.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import batch, short_batches, texts_of
from tillworks.llm.pretokens import Memo, forgets

BITS, FACTORS = 18, 4
MOST_TOXIC, MOST_CLEAN = 3000, 6000
BATCH, RATE, DECAY, SEED = 128, 0.05, 1e-4, 7
FACTOR_RATE, FACTOR_DECAY = 0.2, 1e-3
#: Passes over the learnt documents; few documents are passed over more often, to take STEPS steps.
EPOCHS, STEPS = 5, 1000
#: A toxic document missed costs as much as so many clean ones flagged.
MISSED = 8
#: Learnt documents with a term before its presence is an input.
COMMON = 40
#: Weight of every term at the start, and documents added to each term's counts.
START, PRIOR_DOCS, NOISE = 0.5, 40, 0.5
#: Deviation of the factors at the start.
SPREAD = 0.1
FOLDS = 5
WORD = re.compile(r"\w+")
#: Words at least so long also give their first letters as a term.
STEM_FROM, STEM = 6, 4
REMEMBERED = 200_000


def _places(word: str) -> tuple[int, ...]:
    at = lambda t: zlib.crc32(t.encode()) % (1 << BITS)
    return (at(word), at(f"{word[:STEM]}-")) if len(word) >= STEM_FROM else (at(word),)


_memo = Memo(_places, REMEMBERED)


def terms(text: str) -> np.ndarray:
    """The places of a document's terms, each once."""
    found = {p for w in set(WORD.findall(text.lower())) for p in _memo[w]}
    return np.fromiter(found, "i4", len(found))


@dataclass
class Machine:
    """``scale`` is how far a term's documents lean to either kind, ``common`` is 1 for terms whose
    presence counts; ``ground`` is the factor vector of the term in every document."""

    bias: float
    scale: np.ndarray
    common: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    ground: np.ndarray

    def factor_inputs(self, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each term of documents with so many terms: lean and presence, with the lean's sign."""
        lean, present = self.scale[places], self.common[places] / np.repeat(np.sqrt(sizes), sizes)
        return np.where(lean < 0, lean - present, lean + present)

    def log_odds(self, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of the documents whose places begin at ``starts``."""
        out = np.full(len(starts), self.bias)
        sizes = np.diff(np.r_[starts, len(places)])
        filled = sizes > 0
        if filled.any():
            at = starts[filled]
            v = self.factors[places] * self.factor_inputs(places, sizes[filled])[:, None]
            sums = np.add.reduceat(v, at) + self.ground
            alone = np.add.reduceat((v ** 2).sum(axis=1), at) + (self.ground ** 2).sum()
            out[filled] += np.add.reduceat(self.weights[places] * self.scale[places], at) + ((sums ** 2).sum(axis=1) - alone) / 2
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _counts(docs: list[np.ndarray]) -> np.ndarray:
    """Documents with each term."""
    return np.bincount(np.concatenate([np.empty(0, "i4"), *docs]), minlength=1 << BITS)


def _lean(docs: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Logarithm of the ratio of a term's share in toxic and in clean documents, less what chance
    may do: PRIOR_DOCS documents of the usual mixture are added, and NOISE is taken off."""
    kinds = [[d for d, t in zip(docs, toxic) if t == kind] for kind in (1, 0)]
    share = [(_counts(of) + PRIOR_DOCS * len(of) / len(docs)) / len(of) for of in kinds]
    ratio = np.log(share[0] / share[1])
    return np.sign(ratio) * np.maximum(np.abs(ratio) - NOISE, 0)


def untrained(docs: list[np.ndarray], toxic: np.ndarray) -> Machine:
    chance = np.random.default_rng(SEED)
    return Machine(
        0.0, _lean(docs, toxic), (_counts(docs) >= COMMON).astype("f8"), np.full(1 << BITS, START),
        chance.normal(0, SPREAD, (1 << BITS, FACTORS)), chance.normal(0, SPREAD, FACTORS),
    )


def train(docs: list[np.ndarray], toxic: np.ndarray) -> Machine:
    """AdaGrad on the logistic loss, a few documents at a time."""
    machine, chance = untrained(docs, toxic), np.random.default_rng(SEED)
    squares_w, squares_v = np.full(1 << BITS, 1e-6), np.full((1 << BITS, FACTORS), 1e-6)
    squares_g, squares_b = np.full(FACTORS, 1e-6), 1e-6
    for _ in range(max(EPOCHS, STEPS * BATCH // len(docs))):
        order = chance.permutation(len(docs))
        for lo in range(0, len(order), BATCH):
            some = [i for i in order[lo:lo + BATCH] if len(docs[i])]
            if not some:
                continue
            places = np.concatenate([docs[i] for i in some])
            sizes = np.array([len(docs[i]) for i in some])
            starts = np.r_[0, np.cumsum(sizes)[:-1]]
            cost = np.where(toxic[some] > 0, MISSED, 1) / len(some)
            error = (sigmoid(machine.log_odds(places, starts)) - toxic[some]) * cost
            each = np.repeat(error, sizes)
            x = machine.factor_inputs(places, sizes)
            v = machine.factors[places] * x[:, None]
            sums = np.add.reduceat(v, starts)
            slope = (each * x)[:, None] * (np.repeat(sums + machine.ground, sizes, axis=0) - v)
            used, back = np.unique(places, return_inverse=True)
            grad_w = np.bincount(back, each * machine.scale[places], len(used)) + DECAY * (machine.weights[used] - START)
            grad_v = np.stack([np.bincount(back, slope[:, f], len(used)) for f in range(FACTORS)], axis=1) + FACTOR_DECAY * machine.factors[used]
            grad_g = error @ sums + FACTOR_DECAY * machine.ground
            squares_w[used] += grad_w ** 2
            squares_v[used] += grad_v ** 2
            squares_g += grad_g ** 2
            squares_b += error.sum() ** 2
            machine.weights[used] -= RATE * grad_w / np.sqrt(squares_w[used])
            machine.factors[used] -= FACTOR_RATE * grad_v / np.sqrt(squares_v[used])
            machine.ground -= FACTOR_RATE * grad_g / np.sqrt(squares_g)
            machine.bias -= RATE * error.sum() / squares_b ** 0.5
    return machine


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@forgets(_memo)
def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("toxic", pa.int32()), ("terms", pa.list_(pa.int32()))])
    for rows, texts in texts_of(batches, 1):
        yield batch(schema, rows.column(0), [np.sort(terms(t)) for t in texts])


def learned(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine fitted to labelled documents outside the held-out fold."""
    label = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    usable = label.where(~held_out(F.col("doc_id")))
    n = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    some = [
        usable.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for kind, most in ((1, MOST_TOXIC), (0, MOST_CLEAN))
    ]
    # At most MOST_TOXIC + MOST_CLEAN ids, so they can go to every task.
    chosen = F.broadcast(some[0].union(some[1]))
    # One text for each id, so no more rows than ids.
    one = docs.join(chosen, "doc_id").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    rows = one.select("toxic", "text").mapInArrow(_terms, "toxic int, terms array<int>").toArrow()
    toxic = np.array(rows.column("toxic").to_pylist(), "f8")
    found = [np.array(t, "i4") for t in rows.column("terms").to_pylist()]
    order = sorted(range(len(found)), key=lambda i: (len(found[i]), found[i].tobytes(), toxic[i]))
    found, toxic = [found[i] for i in order], toxic[order]
    prior = log((n.get(1, 0) + 0.5) / (n.get(0, 0) + 0.5))
    if not 0 < toxic.sum() < len(toxic):
        none = np.zeros(1 << BITS)
        return Machine(prior, none, none, none, np.zeros((1 << BITS, FACTORS)), np.zeros(FACTORS))
    machine = train(found, toxic)
    machine.bias += prior - log(toxic.sum() / (len(toxic) - toxic.sum()))
    return machine


@forgets(_memo)
def _score(batches: Iterator[pa.RecordBatch], machine) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    fm: Machine = machine.value
    for rows, texts in texts_of(batches, 1):
        found = [np.sort(terms(t)) for t in texts]
        starts = np.cumsum([0, *[len(f) for f in found]])[:-1].astype("i8")
        yield batch(schema, rows.column(0), pa.array(sigmoid(fm.log_odds(np.concatenate(found), starts))))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    spark = docs.sparkSession
    short_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    fm = learned(docs, labels.select("doc_id", "toxic"))
    for part in ("scale", "common", "weights", "factors"):
        setattr(fm, part, getattr(fm, part).astype("f4"))
    out = docs.mapInArrow(partial(_score, machine=spark.sparkContext.broadcast(fm)), "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
