"""Secret scan: patterns, and the cost of guessing what stands in a credential's place.

Three patterns find the plain cases. The method adds values that other credential contexts
introduce ("pwd is ...", "Authorization: ...") if they would be hard to guess: the value is cut,
by dynamic programming, into the segments that are cheapest to guess together - known words
(with capitals and digit-for-letter spelling), dates, repeats, keyboard walks and runs, and what
is left by brute force. Cheap values are placeholders or prose; dear ones are secrets.

Words cost the logarithm of their rank. Ranks come from the number of different texts that hold the
word outside of a credential's place, with a short list of favourite passwords before them; the list
sent to the tasks is bounded by ``WORDS``. So a secret doesn't become a known word by being copied,
neither with its text nor from one text to others.

Links and references to variables ("${VAULT_KEY}", "process.env.KEY") are no secrets, whatever they would cost.

In values of more than ``LONG_VALUE`` characters, walks and repeats end near where they can end first or
last (``NEAR_END`` places), so the time grows with the length only; shorter values are cut in every way.

Cases: null and empty texts have no spans; long texts and values are looked at whole. Spans are code points, end exclusive, in the order of
their start, then kind. Equal rows get equal spans; an empty table stays empty. Other columns are carried along; ``spans``
replaces a column of that name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.common import numbered, short_batches, texts_of
from tillworks.llm.pretokens import Memo, forgets
from tillworks.llm.word_counts import different_texts, frequent_words

# The base patterns of the scan.
ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16
KINDS = ["assign", "access", "hex", "guess"]

#: Where a credential is named more loosely, and the value that follows.
#: Names like DB_PASS, dbPass, DBPASS, PGPASSWORD and SECRET_KEY_BASE count; short keywords begin a word or a part of it.
CONTEXT = re.compile(
    r"(?:(?:passw(?:or)?d|passphrase|passcode|secret|token|credentials?)"
    r"|(?:(?<![A-Za-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z0-9])(?=PASS|PWD)))(?:pwd|pass|auth|authorization|bearer|login"
    r"|(?:api|access|private|client|account)[ _-]?(?:key|secret|token)))"
    r"(?:[ _-]?(?:access|key|token|secret|password|pass|pwd|base|value)|_\d{1,3}){0,3}[\"']?"
    r"(?:\s{0,3}(?::=?|=>?)\s{0,3}|\s{1,3}is\s{1,3})(?:(?:basic|bearer)\s{1,3})?[\"'`]?([^\s\"'`<>,;()]{8,})",
    re.IGNORECASE | re.ASCII,
)

#: One of these (in any case) is in every match of CONTEXT and ASSIGN.
KEYWORDS = ["pass", "pwd", "secret", "token", "key", "auth", "bearer", "login", "credential"]
#: What stands for a secret that is kept elsewhere, and links without a password in them.
REFERENCE = re.compile(
    r"[a-z][a-z0-9+.-]*://[^\s@]*|[$%]?\$?\{{0,2}\s*(?:process\.env|os\.environ|import\.meta\.env|env|vars|secrets|config|settings)[.\[][\w.\[\]'\"-]*\}{0,2}"
    r"|\$\{\{?[\w.:/-]+\}?\}|\$[A-Za-z_]\w*|%[A-Za-z_]\w*%|\{\{[\w.:/-]+\}\}", re.IGNORECASE | re.ASCII)

#: Guesses (as a power of ten) from which a value counts as a secret.
DEAR = 10.0
#: Words whose rank is known, and the longest of them.
WORDS, LONGEST_WORD = 20_000, 24
LONG_VALUE, NEAR_END = 256, 8
#: Pieces of text whose words a task remembers.
REMEMBERED = 100_000
#: Each further segment costs the guesser the choice of where to cut.
CUT = log10(2)

# Favourite passwords, commonest first, and the rows of a keyboard.
FAVOURITES = [
    "password", "admin", "welcome", "letmein", "login", "changeme", "secret", "qwerty", "monkey", "dragon", "master",
    "sunshine", "princess", "football", "baseball", "shadow", "superman", "iloveyou", "trustno", "hello", "freedom",
    "whatever", "default", "guest", "root", "test", "user", "example", "placeholder", "your", "token", "key", "api",
]
KEY_ROWS = ["1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz"]
SPELT = str.maketrans({"4": "a", "@": "a", "3": "e", "0": "o", "1": "l", "!": "i", "5": "s", "$": "s", "7": "t"})

YEARS = range(1900, 2051)
DATE = re.compile(r"(\d{1,4})([-/._]?)(\d{1,2})\2(\d{1,4})")
PLAIN_WORD = re.compile(r"[^\W\d_]+")


def _names_credential(text: str) -> bool:
    """Whether CONTEXT or ASSIGN can match at all."""
    lower = text.lower()
    return any(map(lower.__contains__, KEYWORDS))


_memo = Memo(lambda piece: [w for w in PLAIN_WORD.findall(piece.lower()) if 3 <= len(w) <= LONGEST_WORD], REMEMBERED)


def word_pieces(text: str) -> set[str]:
    """The different words of a text, without what stands in a credential's place."""
    if _names_credential(text):
        parts, at = [], 0
        for lo, hi in sorted(m.span(m.re.groups) for pattern in (CONTEXT, ASSIGN) for m in pattern.finditer(text)):
            parts.append(text[at:max(at, lo)])
            at = max(at, hi)
        text = " ".join([*parts, text[at:]])
    # No word goes beyond white space; long pieces aren't worth remembering.
    return {w for piece in set(text.split()) for w in (_memo[piece] if len(piece) <= 64 else _memo.make(piece))}


word_pieces.forget = _memo.forget


class Ranks(dict):
    """Rank by word, and the beginnings that words have."""

    def __init__(self, words) -> None:
        super().__init__((w, i) for i, w in enumerate(words, 1))
        self.beginnings = {w[:3] for w in self}


def ranks(words: list[str]) -> Ranks:
    """Rank by word; favourites first."""
    return Ranks(dict.fromkeys([*FAVOURITES, *words]))


def _next_keys() -> set[str]:
    rows = [*KEY_ROWS, *[r[::-1] for r in KEY_ROWS]]
    columns = [a + b for upper, lower in zip(KEY_ROWS[:4], KEY_ROWS[1:4]) for a, b in zip(upper, lower)]
    return {r[i:i + 2] for r in rows for i in range(len(r) - 1)} | {*columns, *[c[::-1] for c in columns]}


NEXT_KEYS = _next_keys()


def letter_cost(c: str) -> float:
    return log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 1000)


def _word_cost(piece: str, rank: dict[str, int]) -> float | None:
    lower = piece.lower()
    spelt = lower.translate(SPELT)
    found = rank.get(lower) or rank.get(spelt)
    if not found:
        return None
    cost = log10(found)
    if lower != piece:  # first letter or all capitals is the first guess; mixed capitals are many
        upper = sum(c.isupper() for c in piece)
        cost += log10(2) * (1 if upper in (1, len(piece)) else min(upper, len(piece) - upper) + 1)
    if not rank.get(lower):
        cost += log10(2) * sum(a != b for a, b in zip(lower, spelt))
    return cost


def _dates(value: str, i: int) -> Iterator[tuple[int, float]]:
    """(end, cost) of the dates that begin at i."""
    if value[i:i + 4].isdecimal() and len(value[i:i + 4]) == 4 and int(value[i:i + 4]) in YEARS:
        yield i + 4, log10(len(YEARS))
    if m := DATE.match(value, i):
        a, b, c = (int(m[k]) for k in (1, 3, 4))
        parts = [(m[1], a), (m[4], c)]
        year = any((len(t) == 4 and n in YEARS) or len(t) == 2 for t, n in parts)
        if year and (min(a, c) <= 31 or max(a, c) <= 99) and 1 <= b <= 31:
            yield m.end(), log10(365 * len(YEARS)) + (log10(4) if m[2] else 0)


def guess_cost(value: str, rank: dict[str, int]) -> float:
    """Least guesses, as a power of ten, over all ways to cut the value."""
    n = len(value)
    best = [0.0] + [float("inf")] * n
    # How far the keyboard walk and the repeats that begin at a place go.
    lower = value.lower()
    walk = [1] * (n + 1)
    for i in range(n - 2, -1, -1):
        walk[i] = walk[i + 1] + 1 if lower[i:i + 2] in NEXT_KEYS else 1
    again = {unit: [0] * (n + 1) for unit in range(1, 5)}  # characters equal to those a unit further on
    for unit, of in again.items():
        for i in range(n - unit - 1, -1, -1):
            of[i] = of[i + 1] + 1 if value[i] == value[i + unit] else 0

    beginnings = rank.beginnings if isinstance(rank, Ranks) and lower.isascii() else None
    cost_of = {c: letter_cost(c) for c in set(value)}

    for i in range(n):
        start = best[i] + (CUT if i else 0)
        # Brute force goes on without a new cut.
        best[i + 1] = min(best[i + 1], best[i] + cost_of[value[i]])
        first = lower[i:i + 3]
        words = beginnings is None or first in beginnings or first.translate(SPELT) in beginnings
        for end in range(i + 3, min(n, i + LONGEST_WORD) + 1) if words else ():
            if (cost := _word_cost(value[i:end], rank)) is not None:
                best[end] = min(best[end], start + cost)
        for end, cost in _dates(value, i) if value[i].isdecimal() else ():
            best[end] = min(best[end], start + cost)
        for length in _lengths(3, walk[i], 1, n):
            best[i + length] = min(best[i + length], start + log10(40) + log10(2) + log10(length))
        for unit, of in again.items():
            times = of[i] // unit + 1
            if times * unit >= 3 and times > 1:
                letters = sum(map(cost_of.__getitem__, value[i:i + unit]))
                for length in _lengths(max(2, -(-3 // unit)), times, unit, n):
                    best[i + length] = min(best[i + length], start + letters + log10(length // unit))
    return best[n]


def _lengths(least: int, most: int, unit: int, n: int) -> Iterator[int]:
    """Lengths of the runs of ``least`` to ``most`` units; in a long value the first and last of them."""
    if n <= LONG_VALUE or most - least < 2 * NEAR_END:
        yield from range(least * unit, most * unit + 1, unit)
    else:
        yield from range(least * unit, (least + NEAR_END) * unit, unit)
        yield from range((most - NEAR_END + 1) * unit, most * unit + 1, unit)


def find(text: str, rank: dict[str, int]) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, cost) of the secrets in a text; only added spans have a cost."""
    spans = []
    if ("=" in text or ":" in text) and _names_credential(text):
        spans += [("assign", m.start(), m.end(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    spans += [("hex", m.start(), m.end(), None) for m in HEX.finditer(text)]
    base = [(s[1], s[2]) for s in spans]
    for m in CONTEXT.finditer(text) if _names_credential(text) else ():
        lo, hi = m.span(1)
        hi -= len(m[1]) - len(m[1].rstrip(".:!?"))
        if hi - lo >= ASSIGN_LENGTH and not any(a < hi and lo < b for a, b in base) and not REFERENCE.fullmatch(text, lo, hi):
            cost = guess_cost(text[lo:hi], rank)
            if cost >= DEAR:
                spans.append(("guess", lo, hi, cost))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _scan(batches: Iterator[pa.RecordBatch], at: int, words: list[str]) -> Iterator[pa.RecordBatch]:
    rank = ranks(words)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())]))
    names = ["kind", "start", "end", "cost"]
    for rows, texts in texts_of(batches, at):
        spans = pa.array([[dict(zip(names, s)) for s in find(t, rank)] for t in texts], kind)
        yield pa.RecordBatch.from_arrays([*rows.columns, spans], names=[*rows.schema.names, "spans"])


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("cost", T.DoubleType()),
]))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``spans``: kind, start, end and, for added ones, the guess cost."""
    short_batches(docs.sparkSession)
    words = [w for w, _ in frequent_words(different_texts(docs, text), word_pieces, WORDS)]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c == text or c.lower() != "spans"])
    schema = T.StructType([*docs.schema, T.StructField("spans", SPANS)])
    return docs.mapInArrow(partial(_scan, at=docs.columns.index(text), words=words), schema)


MARK = "[SECRET]"


def without_secrets(docs: DataFrame, text: str = "text", mark: str = MARK) -> DataFrame:
    """The rows with every span replaced by a mark; a null text stays null. Spans that overlap
    become one mark."""
    rows, at, names = numbered(docs, text)
    scanned = scan(rows, at)
    # State: the text so far, and where the part not yet copied begins.
    clean = F.aggregate(
        "spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda s, x: F.struct(
            F.when(x["start"] >= s["at"], F.concat(
                s["out"], F.substr(F.col(at), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mark),
            )).otherwise(s["out"]).alias("out"),
            F.greatest(s["at"], x["end"]).alias("at"),
        ),
        lambda s: F.concat(s["out"], F.substr(F.col(at), (s["at"] + 1).cast("int"))),
    )
    return scanned.withColumn(at, F.when(F.size("spans") > 0, clean).otherwise(F.col(at))).drop("spans").toDF(*names)
