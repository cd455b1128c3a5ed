"""BPE ids by a lexicon of frequent words.

The words that make up most of the text are few. They are counted over all documents, and the
most frequent are compiled into a minimal acyclic transducer: words share their beginnings and
their ends, and numbers along the path of a word add up to its place in a table of ids. The
automaton is one file in the shared folder which every worker maps into memory. A word that it
doesn't hold is merged pair by pair with the ranks of the vocabulary, so ids never depend on
which words are frequent.

Texts outside the settled code points of ``pretokens`` are normalised and split by the tokenizers
library; their words are looked up and merged here like any others. Only a text that spells a special
token goes to the library whole.

Words are counted and coded as white space divides them. A worker remembers the ids of these and of their pieces
(``REMEMBERED`` unless told otherwise, twice at most), so the automaton is asked once for most pieces. Words of all documents are counted: the
library splits texts outside the settled code points for that, too.

Cases: null and empty texts have no ids and decode to an empty text. Long words are merged in a heap, in
time that grows as n log n; texts of any length are coded whole. Repeated rows each have their ids.
Other columns are carried along; ``ids`` and ``decoded`` replace columns of those names. An empty table stays empty.
"""

from __future__ import annotations

import gc
import heapq
import json
import struct
from array import array
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.common import NewFile, mapped, short_batches, texts_of
from tillworks.llm.pretokens import UNCOMMON, WORD_PIECES, Memo, from_byte_letters, in_byte_letters
from tillworks.llm.word_counts import frequent_words

#: Words in the lexicon, and pieces or words as white space divides them whose ids are remembered (below
#: two thirds of 2^19, or else the tables of the dictionaries double).
LEXICON_WORDS, REMEMBERED = 200_000, 340_000
WORD_END = "</w>"
MAGIC = b"TWLEX001"
#: Longer words are merged in a heap and not remembered.
LONG_WORD = 64
#: White space for ``str.split`` that isn't for the vocabulary.
OTHER_SPACE = "\x1c\x1d\x1e\x1f"
#: Bytes of a word's beginning whose place in the automaton a worker remembers.
HEAD = 4
_BYTES = [bytes((i,)) for i in range(256)]


def pieces(text: str) -> list[str]:
    """The pre-tokens of a text of settled code points, in lower case."""
    return WORD_PIECES.findall(text.lower())


def settled(text: str) -> bool:
    """Whether the text has settled code points only and no sign of a special token."""
    return "<|" not in text if text.isascii() else UNCOMMON.search(text) is None


def chunks(text: str) -> list[str]:
    """A text of settled code points as white space divides it, in lower case. No piece goes beyond a chunk."""
    return pieces(text) if any(c in text for c in OTHER_SPACE) else text.lower().split()


def counted_chunks(text: str, vocabulary: str) -> list[str]:
    """What is counted of a text: its chunks, or words as the library normalises and splits it."""
    if settled(text):
        return chunks(text)
    found = (from_byte_letters(letters) for letters in library_words(library(vocabulary), text))
    return [word for word in found if word is not None]


def counted_pieces(chunk: str) -> list[str]:
    if chunk.isascii() and chunk.isalpha():
        return [chunk]
    return pieces(chunk) if settled(chunk) else [chunk]


@cache
def library(vocabulary: str):
    """The tokenizers library's reading of a vocabulary, whole texts at a time."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary)
    found.no_truncation()
    found.no_padding()
    return found


def library_words(of, text: str) -> list[str]:
    """The pre-tokens of any text, in byte letters."""
    return [letters for letters, _ in of.pre_tokenizer.pre_tokenize_str(of.normalizer.normalize_str(text))]


class Merges:
    """Pair merging by rank, lowest rank first and leftmost among equals.

    Parts of a word are their ids, so a pair is one number: the left id times ``unknown + 1``, and the right one. A
    letter that the vocabulary doesn't hold is ``unknown``, which no pair has; it gives no id.
    """

    def __init__(self, vocabulary: str) -> None:
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.unknown = max(self.vocab.values()) + 1
        self.ranks = {self._pair(self.vocab[a], self.vocab[b]): i for i, (a, b) in enumerate(merges)}
        self.merged = [self.vocab[a + b] for a, b in merges]
        self.library = library(vocabulary)

    def _pair(self, left: int, right: int) -> int:
        return left * (self.unknown + 1) + right

    def _letters(self, letters: str) -> list[int]:
        of, unknown = self.vocab.get, self.unknown
        parts = [of(x, unknown) for x in letters]
        parts[-1] = of(letters[-1] + WORD_END, unknown)
        return parts

    def ids(self, word: str) -> list[int]:
        return self.of_letters(in_byte_letters(word))

    def of_letters(self, letters: str) -> list[int]:
        """Ids of a word in byte letters."""
        if len(letters) > LONG_WORD:
            return self._of_long(letters)
        parts, n = self._letters(letters), self.unknown + 1
        rank_of, none = self.ranks.get, len(self.merged)
        ranks = [rank_of(a * n + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i] = new = self.merged[best]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(parts[i - 1] * n + new, none)
            if i < len(ranks):
                ranks[i] = rank_of(new * n + parts[i + 1], none)
        return [p for p in parts if p != self.unknown] if self.unknown in parts else parts

    def _of_long(self, letters: str) -> list[int]:
        """The same merges, with the pairs in a heap: a pair is taken if both its parts still stand."""
        parts: list[int | None] = self._letters(letters)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        found = ((self.ranks.get(self._pair(a, b)), i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        heap = [x for x in found if x[0] is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= len(parts) or parts[j] != right:
                continue
            parts[i], parts[j] = self.merged[rank], None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(parts) and (rank := self.ranks.get(self._pair(parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (rank, a, parts[a], parts[b]))
        return [p for p in parts if p is not None and p != self.unknown]


def compile_lexicon(words: dict[str, list[int]]) -> bytes:
    """The minimal acyclic transducer of the words, as one block of bytes.

    Words come in byte order; a state is finished when no later word can pass through it, and a
    finished state equal to an earlier one (same ends, same arcs) is replaced by that.
    """
    entries = sorted((w.encode(), ids) for w, ids in words.items() if w)
    known: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []

    def finish(final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    # The states along the current word: [is final, arcs so far], the arc to the next not yet in.
    path: list[list] = [[False, []]]
    before = b""

    def close_to(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            path[-1][1].append((before[len(path) - 1], finish(final, arcs)))

    for word, _ in entries:
        same = next((i for i, (a, b) in enumerate(zip(word, before)) if a != b), min(len(word), len(before)))
        close_to(same)
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        before = word
    close_to(0)
    root = finish(*path[0])

    # Targets are finished before the states that lead to them, so one pass counts the words below.
    below = np.zeros(len(states), "u4")
    first, final, labels, targets, places = [0], bytearray(), bytearray(), [], []
    for i, (is_final, arcs) in enumerate(states):
        n = int(is_final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            places.append(n)
            n += int(below[target])
        below[i] = n
        final.append(is_final)
        first.append(len(labels))
    ids = [x for _, of in entries for x in of]
    starts = np.cumsum([0, *[len(of) for _, of in entries]])
    numbers = b"".join(np.array(x, "<u4").tobytes() for x in (first, targets, places, starts, ids))
    return struct.pack("<8s5I4x", MAGIC, len(states), len(labels), len(entries), len(ids), root) + numbers + bytes(final) + bytes(labels)


class Lexicon:
    """A compiled lexicon in mapped memory."""

    def __init__(self, data) -> None:
        view = memoryview(data)
        magic, n_states, n_arcs, self.n_words, n_ids, self.root = struct.unpack_from("<8s5I", view)
        if magic != MAGIC:
            raise ValueError("not a lexicon")
        self.n_states, self.n_arcs = n_states, n_arcs
        at = 32

        def numbers(n: int) -> memoryview:
            nonlocal at
            at += 4 * n
            return view[at - 4 * n:at].cast("I")

        self.first, self.targets, self.places = numbers(n_states + 1), numbers(n_arcs), numbers(n_arcs)
        self.starts, self.ids = numbers(self.n_words + 1), numbers(n_ids)
        self.final = view[at:at + n_states]
        self.data, self.labels_at = data, at + n_states
        #: State and place after a beginning of ``HEAD`` bytes; only those of words in the lexicon are kept.
        self.heads: dict[bytes, tuple[int, int]] = {}

    def _walk(self, labels: bytes, state: int, place: int) -> tuple[int, int] | None:
        base, first, find = self.labels_at, self.first, self.data.find
        for label in labels:
            arc = find(_BYTES[label], base + first[state], base + first[state + 1])
            if arc < 0:
                return None
            place += self.places[arc - base]
            state = self.targets[arc - base]
        return state, place

    def packed(self, word: str) -> bytes | None:
        """The ids of a word as 32-bit integers, or None if the lexicon doesn't hold it."""
        labels = word.encode()
        head = labels[:HEAD]
        at = self.heads.get(head)
        if at is None:
            at = self._walk(head, self.root, 0)
            if at is None:
                return None
            self.heads[head] = at
        if len(labels) > HEAD:
            at = self._walk(labels[HEAD:], *at)
        if at is None or not self.final[at[0]]:
            return None
        return self.ids[self.starts[at[1]]:self.starts[at[1] + 1]].tobytes()

    def find(self, word: str) -> list[int] | None:
        """The ids of a word, or None if the lexicon doesn't hold it."""
        found = self.packed(word)
        return None if found is None else memoryview(found).cast("I").tolist()


class WordCoder:
    """Ids and decoded text of whole texts."""

    def __init__(self, vocabulary: str, lexicon: str, remembered: int = REMEMBERED) -> None:
        self.merges = Merges(vocabulary)
        self.lexicon = Lexicon(mapped(lexicon))
        names = [""] * self.merges.unknown
        for name, i in self.merges.vocab.items():
            names[i] = name
        self.names = pa.array(names, pa.string())
        self.of_chunk = Memo(self._chunk, remembered, 2 * LONG_WORD)
        self.special = [t.content for t in self.merges.library.get_added_tokens_decoder().values()]
        #: Pieces looked up, and those that the lexicon knew.
        self.asked = self.known = 0

    def _known(self, word: str | None) -> bytes | None:
        found = None if word is None else self.lexicon.packed(word)
        self.asked += 1
        self.known += found is not None
        return found

    def _piece(self, word: str) -> bytes:
        found = self._known(word)
        return array("i", self.merges.ids(word)).tobytes() if found is None else found

    def _chunk(self, chunk: str) -> bytes:
        """A piece is a chunk of its own, so both are remembered in one place."""
        if chunk.isascii() and chunk.isalpha():
            return self._piece(chunk)
        words = pieces(chunk)
        if words == [chunk]:
            return self._piece(chunk)
        return b"".join([self.of_chunk[w] if len(w) <= LONG_WORD else self._piece(w) for w in words])

    def _split(self, text: str) -> bytes:
        """A text of any characters: the library normalises and splits it."""
        ids = []
        for letters in library_words(self.merges.library, text):
            found = self._known(from_byte_letters(letters))
            ids.append(array("i", self.merges.of_letters(letters)).tobytes() if found is None else found)
        return b"".join(ids)

    def code(self, text: str) -> tuple[bytes, str | None]:
        """Ids as 32-bit integers, and the text that the ids decode to where the library has decoded them; others
        decode to their names (``decoded``)."""
        if settled(text):
            return b"".join(map(self.of_chunk.__getitem__, chunks(text))), None
        if not any(map(text.__contains__, self.special)):
            return self._split(text), None
        return self._of_library(text)

    def decoded(self, ids: pa.Array, offsets: pa.Array) -> pa.Array:
        """The texts of lists of ids: this vocabulary's token names with spaces between."""
        return pc.binary_join(pa.ListArray.from_arrays(offsets, self.names.take(ids)), " ")

    def _of_library(self, text: str) -> tuple[bytes, str]:
        library = self.merges.library
        ids = library.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<i4").tobytes(), library.decode(ids, skip_special_tokens=False)


_coders: dict = {}


def coder(vocabulary: str, lexicon: str, remembered: int = REMEMBERED) -> WordCoder:
    """One for each worker process; a lexicon that is no longer used gives way."""
    key = vocabulary, lexicon, remembered
    if key not in _coders:
        _coders.clear()
        _coders[key] = WordCoder(*key)
    return _coders[key]


def forget_coders() -> None:
    """Give back what the coder of this worker process holds."""
    _coders.clear()
    library.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


def build_lexicon(docs: DataFrame, vocabulary: str, uri: str, most: int = LEXICON_WORDS, text: str = "text") -> None:
    """Count the words of all documents, compile the frequent ones and write the file."""
    merges = Merges(vocabulary)
    counted = frequent_words(docs, partial(counted_chunks, vocabulary=vocabulary), most, text, refine=counted_pieces)
    words = {w: merges.ids(w) for w, _ in counted}
    out = NewFile(uri)
    out.write(compile_lexicon(words))
    out.close()


def _encode(
    batches: Iterator[pa.RecordBatch], vocabulary: str, lexicon: str, at: int, remembered: int, lasting: bool
) -> Iterator[pa.RecordBatch]:
    try:
        yield from _encoded(batches, coder(vocabulary, lexicon, remembered), at)
    finally:
        if not lasting:
            forget_coders()


def _encoded(batches: Iterator[pa.RecordBatch], words: WordCoder, at: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in texts_of(batches, at):
        coded = [words.code(t) for t in texts]
        values = pa.array(np.frombuffer(b"".join([c[0] for c in coded]), "<i4"))
        offsets = pa.array(np.cumsum([0, *[len(c[0]) // 4 for c in coded]]).astype("i4"))
        ids = pa.ListArray.from_arrays(offsets, values)
        # The library's ids of special tokens have no names here; its texts take the place of theirs.
        given = [c[1] for c in coded]
        if any(t is not None for t in given):
            named = pc.if_else(pc.less(values, len(words.names)), values, 0)
            decoded = pc.coalesce(pa.array(given, pa.string()), words.decoded(named, offsets))
        else:
            decoded = words.decoded(values, offsets)
        yield pa.RecordBatch.from_arrays([*rows.columns, ids, decoded], names=[*rows.schema.names, "ids", "decoded"])


def encode(
    docs: DataFrame, vocabulary: str, lexicon: str, text: str = "text", remembered: int = REMEMBERED, lasting: bool = True
) -> DataFrame:
    """The rows with ``ids`` (array of int) and ``decoded`` (what the ids decode to).

    A worker remembers the ids of ``remembered`` pieces. Its coder outlives a task, or, if it isn't ``lasting``, goes
    with it: where workers serve other stages, too, that memory is theirs.
    """
    short_batches(docs.sparkSession)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c == text or c.lower() not in {"ids", "decoded"}])
    schema = T.StructType([*docs.schema, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    return docs.mapInArrow(
        partial(_encode, vocabulary=vocabulary, lexicon=lexicon, at=docs.columns.index(text), remembered=remembered, lasting=lasting),
        schema,
    )
