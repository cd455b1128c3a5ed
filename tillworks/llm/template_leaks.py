"""Benchmark leaks by template.

A benchmark question is often reused with other numbers, names or units. Words are therefore
canonicalised: numbers, units and names become typed placeholders, other words lose case and
outer punctuation. Windows of five canonical words are the templates. Windows of documents and of
items are joined on their hashes; a document leaks an item if it holds at least 0.8 of the item's
templates. What stood in the placeholders must agree too, in one occurrence of the item at least:
each value of the item has to be replaced by one value throughout (its main value, in at least 0.8
of its places), be it the same value or another. Windows of placeholders alone say nothing and are left out.

A word that begins a sentence and is written like a name may be one. It is read as a plain word and,
if it is a name elsewhere in the text or isn't among the ``KNOWN`` commonest lower-case words of the
documents, as a name as well; a window is held if any reading of it is. So nothing is lost where
the two texts don't read it alike.

Every distance between a place of a window in the document and in the item may be where an occurrence
begins. Each window of the item is then looked up where it stands nearest to that, so words put in
or left out do no harm, and other occurrences don't count.

Most documents are far from any item, and that shows in single words. Of each item up to
``GROUPS`` groups of plain words are picked, the longest first, so that the windows with a word of
a group are more than 0.2 of all. A document that lacks a whole group can't hold 0.8 of the
windows; if every item has a group that the document lacks, it isn't cut into windows.

The join is a hash join in Spark. While the items have no more than ``MOST_LISTED`` windows their hashes go
to the tasks, with the items of each. A task hands on a window only for items that the document's words
don't rule out and of which it has met enough windows, so windows and items are joined on both, and
a window that many items share doesn't multiply. With more, every window of the documents is shuffled, and joined on itself.

Cases: null and empty texts leak nothing; long ones are cut into windows whole. Empty tables leak nothing. Items of fewer than five words have one window, all
their words; items without words, or of placeholders alone, are found nowhere. Rows that share
doc_id are judged by text and reported once for each leaking text. Items are judged by item_id and
text, those without item_id as well; of several leaked texts of one item_id that with the largest share is reported.
Extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import batch, short_batches, stored, texts_of, words_of
from tillworks.llm.pretokens import Memo, forgets
from tillworks.llm.word_counts import frequent_words

WINDOW, SHARE = 5, 0.8
MOST_LISTED = 4_000_000
REMEMBERED, GROUPS = 100_000, 3
#: Rows that a task hands on at once.
HANDED = 5_000
#: Lower-case words that are known not to be names alone.
KNOWN = 100_000
#: Slots looked at together.
_BLOCK = 1 << 18

# Words for numbers and units in the languages of the corpus.
NUMBER_WORDS = set(
    "zero one two three four five six seven eight nine ten eleven twelve dozen hundred thousand million billion half "
    "thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety trillion "
    "elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig "
    "achtzig neunzig million millionen onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante mille "
    "doce trece catorce quince dieciséis diecisiete dieciocho diecinueve veinte treinta cuarenta cincuenta sesenta setenta "
    "ochenta noventa ciento "
    "eins zwei drei vier fünf sechs sieben acht neun zehn hundert tausend "
    "deux trois quatre cinq sept huit neuf dix cent mille dos tres cuatro cinco siete ocho nueve diez cien mil".split())
UNIT_WORDS = set(
    "km m cm mm mile miles metre metres meter meters foot feet inch inches yard yards kg g mg lb lbs pound pounds ounce "
    "ounces ton tons litre litres liter liters ml hour hours minute minutes second seconds day days week weeks month "
    "months year years dollar dollars cent cents euro euros percent % $ € £ mph kmh kph degrees degree".split())
#: Tens and ones in one word: 'twenty-five'.
NUMBER_PAIR = re.compile(r"(twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety)-(one|two|three|four|five|six|seven|eight|nine)")
#: A number and its unit in one word: '5km'.
GLUED = re.compile(r"([+-]?[$€£]?\d[\d.,:/]*)-?([^\W\d_]+|%)")
#: Written like a name: one capital at the beginning, or more after an apostrophe, a hyphen or a small letter.
NAMED = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*(?:['’]s)?")
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*\d?(?:st|nd|rd|th)?%?")

_U = np.uint64
#: Kinds of word: plain, and the placeholders.
PLAIN, NUM, UNIT, NAME = 0, 1, 2, 3
#: Where a sentence begins: plain, or a name.
MAYBE = 4
PLACEHOLDERS = np.array([0, *[xxhash.xxh3_64_intdigest(n) for n in ("<number>", "<unit>", "<name>")]], "u8")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_STEPS = _mixed(np.arange(1, WINDOW + 1, dtype="u8"))
_OUTER = "".join(chr(c) for c in range(0x2100) if unicodedata.category(chr(c))[0] in "PS" and chr(c) not in "$€£%")


def _word(word: str) -> bytes:
    """Hash of the plain form, kind where it stands first in a sentence and elsewhere, and whether a
    sentence ends with it; 16 bytes."""
    core = word.strip(_OUTER)
    lower = core.lower()
    if NUMBER.fullmatch(core) or lower in NUMBER_WORDS:
        kinds = (NUM, NUM)
    elif lower in UNIT_WORDS:
        kinds = (UNIT, UNIT)
    elif (glued := GLUED.fullmatch(core)) and glued[2].lower() in UNIT_WORDS or NUMBER_PAIR.fullmatch(lower):
        kinds = (NUM, NUM)
    elif core[:1].isupper() and (core[1:].islower() or NAMED.fullmatch(core) and not core.isupper()):
        kinds = (MAYBE, NAME)  # a name unless a sentence begins
    else:
        kinds = (PLAIN, PLAIN)
    ends = word.rstrip("\"')]»”’")[-1:] in (".", "!", "?", ":")
    return xxhash.xxh3_64_digest(lower)[::-1] + bytes([*kinds, ends, 0, 0, 0, 0, 0])


_memo = Memo(_word, REMEMBERED)
_FIELDS = np.dtype([("plain", "<u8"), ("first", "u1"), ("inner", "u1"), ("ends", "u1"), ("_", "V5")])


LOWER = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def lower_words(text: str) -> list[str]:
    return [w for w in LOWER.findall(text) if w.islower()]


def hashed(words: list[str]) -> np.ndarray:
    """Hashes of plain words, in order."""
    return np.sort(np.array([xxhash.xxh3_64_intdigest(w) for w in words], "u8"))


def _among(hashes: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which hashes are listed; the list is in order."""
    if not len(listed):
        return np.zeros(len(hashes), bool)
    return listed[np.minimum(np.searchsorted(listed, hashes), len(listed) - 1)] == hashes


def canonical(text: str, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(template hash, kind, whether it may be a name besides) of each word, and the words.
    ``known`` are the hashes of words that are no names alone."""
    words = words_of(text)
    w = np.frombuffer(b"".join(map(_memo.__getitem__, words)), _FIELDS)
    begins = np.r_[np.ones(min(1, len(w)), "u1"), w["ends"][:-1]] > 0
    # A line begins a sentence as well; words alone don't show line ends, so look at the lines.
    if "\n" in text:
        at = np.cumsum([len(words_of(line)) for line in text.split("\n")])
        begins[at[at < len(w)]] = True
    kind = np.where(begins, w["first"], w["inner"])
    maybe = kind == MAYBE
    if maybe.any():
        maybe &= ~_among(w["plain"], known) | _among(w["plain"], np.unique(w["plain"][kind == NAME]))
        kind = np.where(kind == MAYBE, PLAIN, kind)
    return np.where(kind == PLAIN, w["plain"], PLACEHOLDERS[kind]), kind, maybe, words


def windows(template: np.ndarray, kind: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, hash of the plain reading, bits of the words read as names) of each reading of
    the windows that holds a plain word."""
    if not len(template):
        return np.empty(0, "i8"), np.empty(0, "u8"), np.empty(0, "u8"), np.empty(0, "i8")
    n, width = max(1, len(template) - WINDOW + 1), min(WINDOW, len(template))
    sums, plain = np.zeros(n, "u8"), np.zeros(n, bool)
    for i in range(width):
        sums += _mixed(template[i:i + n] ^ _STEPS[i])
        plain |= kind[i:i + n] == PLAIN
    at, bases = np.flatnonzero(plain), _mixed(sums)
    found = [(at, bases[at], bases[at], np.zeros(len(at), "i8"))]
    if maybe.any():
        bits = sum(maybe[i:i + n].astype("i8") << i for i in range(width))
        for names in range(1, 1 << width):
            at = np.flatnonzero(bits & names == names)
            if not len(at):
                continue
            sums, plain = np.zeros(len(at), "u8"), np.zeros(len(at), bool)
            for i in range(width):
                named = names >> i & 1
                sums += _mixed((PLACEHOLDERS[NAME:NAME + 1] if named else template[at + i]) ^ _STEPS[i])
                plain |= not named and kind[at + i] == PLAIN
            at = at[plain]
            found.append((at, _mixed(sums[plain]), bases[at], np.full(len(at), names)))
    return tuple(map(np.concatenate, zip(*found)))


TOKEN = re.compile(r"[^\W_]+")  # windows strip "_" as well


def anchors(text: str, known: np.ndarray) -> list[list[str]]:
    """Groups of pieces of words; a text that holds ``SHARE`` of this text's windows has a word of
    each. Words are lower case and as ``TOKEN`` finds them."""
    template, kind, maybe, words = canonical(text, known)
    at, hashes, _, _ = windows(template, kind, np.zeros_like(maybe))
    # By word: the different windows that it stands in, whatever their reading.
    inside: dict[str, set[int]] = {}
    for place, h in zip(at.tolist(), hashes.tolist()):
        for k in range(place, min(place + WINDOW, len(words))):
            if kind[k] == PLAIN and not maybe[k]:
                inside.setdefault(words[k].strip(_OUTER).lower(), set()).add(h)
    groups, enough = [], len(set(hashes.tolist())) * (1 - SHARE) + 1e-9
    picked, covered = [], set()
    # A word without a letter or digit can't be looked up.
    for word in sorted((w for w in inside if TOKEN.search(w)), key=lambda w: (-len(w), w)):
        picked.append(max(TOKEN.findall(word), key=len))
        covered |= inside[word]
        if len(covered) > enough:
            groups.append(picked)
            picked, covered = [], set()
            if len(groups) == GROUPS:
                break
    return groups


class Anchors:
    """Tells of which items a text may hold enough."""

    def __init__(self, groups: list[list[list[str]]]) -> None:
        #: Items without a group can't be ruled out by words.
        self.always = {item for item, g in enumerate(groups) if not g}
        self.full = [(1 << len(g)) - 1 for g in groups]
        self.of: dict[str, list[tuple[int, int]]] = {}
        for item, of in enumerate(groups):
            for bit, group in enumerate(of):
                for word in set(group):
                    self.of.setdefault(word, []).append((item, 1 << bit))
        self.words = frozenset(self.of)

    def near(self, text: str) -> set[int]:
        """Numbers of the items."""
        has: dict[int, int] = {}
        for word in self.words & set(TOKEN.findall(text.lower())):
            for item, bit in self.of[word]:
                has[item] = has.get(item, 0) | bit
        return self.always | {item for item, bits in has.items() if bits == self.full[item]}


class Listed:
    """The windows of all items (``windows``, in order), the items of each and how many different windows
    each item has; ``anchors`` numbers items alike."""

    def __init__(self, windows: np.ndarray, items: np.ndarray, sizes: np.ndarray, anchors: Anchors) -> None:
        order = np.lexsort((items, windows))
        self.windows, first = np.unique(windows[order], return_index=True)
        self.items, self.first = items[order], np.r_[first, len(order)]
        self.sizes, self.anchors = sizes, anchors

    def of(self, hashes: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which hash, item) of the windows that stand in one of the items ``near``, of which the
        hashes hold enough: every plain reading is one of the windows met at least."""
        met = np.flatnonzero(_among(hashes, self.windows))
        at = np.searchsorted(self.windows, hashes[met])
        n = self.first[at + 1] - self.first[at]
        which = np.repeat(met, n)
        item = self.items[np.repeat(self.first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        if not len(item):
            return which, item
        pairs = np.unique(np.stack([item, np.searchsorted(self.windows, hashes[which])]), axis=1)
        enough = np.zeros(len(self.sizes), bool)
        enough[near] = True
        enough &= np.bincount(pairs[0], minlength=len(self.sizes)) >= SHARE * self.sizes - 1e-9
        take = enough[item]
        return which[take], item[take]


def _anchors(batches: Iterator[pa.RecordBatch], known) -> Iterator[pa.RecordBatch]:
    """(id, text_hash, groups) of the items that have windows."""
    for rows, texts in texts_of(batches, 2):
        has = [i for i, t in enumerate(texts) if len(windows(*canonical(t, known.value)[:3])[0])]
        groups = pa.array([anchors(texts[i], known.value) for i in has], pa.list_(pa.list_(pa.string())))
        at = pa.array(has, pa.int64())
        yield pa.RecordBatch.from_arrays([rows.column(0).take(at), rows.column(1).take(at), groups], names=["id", "text_hash", "groups"])


FOUND = pa.schema([
    ("id", pa.int64()), ("text_hash", pa.int64()), ("window", pa.int64()), ("at", pa.list_(pa.int32())),
    ("slots", pa.list_(pa.list_(pa.string()))), ("bases", pa.list_(pa.int64())), ("n", pa.int32()), ("items", pa.list_(pa.int32()))])
FOUND_DDL = "id long, text_hash long, window long, at array<int>, slots array<array<string>>, bases array<long>, n int, items array<int>"


@forgets(_memo)
def _windows(batches: Iterator[pa.RecordBatch], known, listed) -> Iterator[pa.RecordBatch]:
    """Every different window of each text with its places, the slot values and the plain reading
    there and the number of the text's windows; of documents only windows of items that the
    document may hold enough of, with the numbers of these items."""
    of_items: Listed | None = None if listed is None else listed.value
    out: list[tuple] = []
    for rows, texts in texts_of(batches, 2):
        for i, text_hash, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), texts):
            if of_items is not None and not (near := of_items.anchors.near(text)):
                continue
            template, kind, maybe, words = canonical(text, known.value)
            at, hashes, bases, names = windows(template, kind, maybe)
            n, items = len(np.unique(bases)), {}
            if of_items is not None:
                which, item = of_items.of(hashes, np.fromiter(near, "i8"))
                for h, k in zip(hashes[which].view("i8").tolist(), item.tolist()):
                    items.setdefault(h, set()).add(k)
                hit = np.unique(which)
                at, hashes, bases, names = at[hit], hashes[hit], bases[hit], names[hit]
            found: dict[int, tuple[list[int], list[list[str]], list[int]]] = {}
            for place, h, base, named in zip(at.tolist(), hashes.view("i8").tolist(), bases.view("i8").tolist(), names.tolist()):
                end = min(place + WINDOW, len(words))
                of = found.setdefault(h, ([], [], []))
                of[0].append(place)
                of[1].append([words[k].strip(_OUTER).lower() for k in range(place, end) if kind[k] != PLAIN or named >> k - place & 1])
                of[2].append(base)
            out += [(i, text_hash, h, *of, n, sorted(items.get(h, ()))) for h, of in found.items()]
            while len(out) >= HANDED:
                yield batch(FOUND, *map(list, zip(*out[:HANDED])))
                out = out[HANDED:]
    if out:
        yield batch(FOUND, *map(list, zip(*out)))


def _nearest(places: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of the place nearest to each wanted one; places ascend."""
    k = np.minimum(np.searchsorted(places, wanted), len(places) - 1)
    before = np.maximum(k - 1, 0)
    return np.where(np.abs(places[before] - wanted) <= np.abs(places[k] - wanted), before, k)


def agreement(met: list[dict], n: int) -> float:
    """Share of the slots that agree in the occurrence where most do; 1 without slots. ``met`` has the
    windows that the document and the item, of ``n`` windows, have in common."""
    codes: dict[str, int] = {}
    windows_of: dict[int, int] = {}
    # By place of the item: which window it is, where the document has it, and codes of the slots of both; for each reading.
    places: dict[int, list[tuple]] = {}
    for m in met:
        at, by = np.array(m["at"], "i8"), [[codes.setdefault(s, len(codes)) for s in slots] for slots in m["slots"]]
        by = np.array(by, "i8").reshape(len(at), -1)
        for q, slots, base in zip(m["item_at"], m["item_slots"], m["bases"]):
            window = windows_of.setdefault(base, len(windows_of))
            places.setdefault(q, []).append((window, at, [codes.setdefault(s, len(codes)) for s in slots], by))
    readings = [(q, r) for q, of in places.items() for r in of]
    if not any(r[2] for _, r in readings):
        return 1.0
    reach = max(places) // 2 + 1
    offsets, support = np.unique(np.concatenate([r[1] - q for q, r in readings]), return_counts=True)
    offsets = offsets[np.lexsort((offsets, -support))]
    best, size = 0.0, _BLOCK // sum(1 + len(r[2]) for _, r in readings) + 1
    for lo in range(0, len(offsets), size):
        begins = offsets[lo:lo + size]
        rows = np.arange(len(begins)) * len(codes)
        holds = np.zeros((len(windows_of), len(begins)), bool)
        keys, near, counted = [], [], []
        for q, of in places.items():
            # The reading that stands nearest; of equally near ones that with most slots.
            of.sort(key=lambda r: -len(r[2]))
            ks = [_nearest(at, begins + q) for _, at, _, _ in of]
            far = np.array([np.abs(r[1][k] - q - begins) for r, k in zip(of, ks)])
            pick = far.argmin(axis=0)
            close = far.min(axis=0) <= reach
            holds[of[0][0]] |= close
            for number, ((_, _, values, by), k) in enumerate(zip(of, ks)):
                for slot, value in enumerate(values):
                    keys.append((rows + value) * len(codes) + by[k, slot])
                    counted.append(pick == number)
                    near.append(close & counted[-1])
        # An occurrence may be whole without what stands far away; else all of the document counts.
        whole = holds.sum(axis=0) >= SHARE * n - 1e-9
        for chosen in (np.array(near) & whole, np.array(counted)):
            pairs, times = np.unique(np.array(keys)[chosen], return_counts=True)
            if not len(pairs):
                continue
            value = pairs // len(codes)
            first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
            agree = np.bincount(value[first] // len(codes), np.maximum.reduceat(times, first), len(begins))
            best = max(best, float((agree / np.maximum(chosen.sum(axis=0), 1)).max()))
        if best == 1.0:
            break
    return best


LEAKS = pa.schema([
    ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("share", pa.float64()), ("slot_share", pa.float64())])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        out = []
        for r in rows.to_pylist():
            share = len({b for m in r["met"] for b in m["bases"]}) / r["n"]
            if share >= SHARE and (slots := agreement(r["met"], r["n"])) >= SHARE:
                out.append((r["id"], r["text_hash"], r["item_id"], share, slots))
        if out:
            yield batch(LEAKS, *map(list, zip(*out)))


def _rows(frame: DataFrame, id_column: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return frame.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, share, slot_share) of each leak: the share of the item's
    windows in the document, and of the slots that agree (1 if it has none)."""
    spark = docs.sparkSession
    short_batches(spark)
    known = spark.sparkContext.broadcast(hashed([w for w, _ in frequent_words(docs, str.split, KNOWN, refine=lower_words)]))
    item_rows = _rows(items, "item_id").dropDuplicates(["id", "text_hash"])
    item_windows = stored(item_rows.mapInArrow(partial(_windows, known=known, listed=None), FOUND_DDL).select(
        F.col("id").alias("item_id"), F.col("text_hash").alias("item_hash"), "window", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), "bases", "n"), "item-windows")
    first = item_windows.select("item_id", "item_hash", "window", "n").limit(MOST_LISTED + 1).toArrow()
    on = ["window"]
    listed = None
    if len(first) <= MOST_LISTED:
        # An item has no more anchors than windows.
        rows = item_rows.mapInArrow(partial(_anchors, known=known), "id long, text_hash long, groups array<array<string>>").collect()
        number = {(r.id, r.text_hash): k for k, r in enumerate(sorted(rows, key=lambda r: (r.id is None, r.id or 0, r.text_hash)))}
        groups = {(r.id, r.text_hash): r.groups for r in rows}
        item, sizes = np.empty(len(first), "i4"), np.zeros(len(number))
        for i, (i_id, i_hash, n) in enumerate(zip(*(first.column(c).to_pylist() for c in ("item_id", "item_hash", "n")))):
            item[i] = number[i_id, i_hash]
            sizes[item[i]] = n
        hashes = first.column("window").to_numpy().astype("i8").view("u8")
        listed = spark.sparkContext.broadcast(Listed(hashes, item, sizes, Anchors([groups[k] for k in number])))
        numbers = spark.createDataFrame([(k, *of) for of, k in number.items()], "item int, _id long, _hash long")
        item_windows = item_windows.join(F.broadcast(numbers), F.col("item_id").eqNullSafe(F.col("_id")) & (F.col("item_hash") == F.col("_hash"))).drop("_id", "_hash")
        on = ["window", "item"]
    found = _rows(docs, "doc_id").mapInArrow(partial(_windows, known=known, listed=listed), FOUND_DDL).drop("bases", "n")
    if listed is not None:
        found = found.withColumn("item", F.explode("items"))
    # A set, as rows may share doc_id and text; one entry per reading of a window.
    met = found.drop("items").join(item_windows, on).groupBy("id", "text_hash", "item_id", "item_hash").agg(
        F.max("n").alias("n"), F.collect_set(F.struct("window", "at", "slots", "item_at", "item_slots", "bases")).alias("met"))
    judged = met.where(F.size(F.array_distinct(F.flatten("met.bases"))) >= SHARE * F.col("n") - 1e-9).mapInArrow(
        _judged, "doc_id long, text_hash long, item_id long, share double, slot_share double")
    key = ["doc_id", "text_hash", "item_id"]
    return judged.groupBy(*key).agg(F.max(F.struct("share", "slot_share")).alias("most")).select(*key, "most.*")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows whose text leaks no item; columns stay as they are."""
    bad = leaks(docs, items).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    hashed = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (hashed == bad["_hash"]), "left_anti")
