"""Quality rules that vote, weighed by expectation-maximisation.

Every rule looks at one measure of a document and votes good (1), bad (-1) or abstains (0). Rules
are noisy and differ in worth, so no single one decides. A two-class mixture over the votes is
fitted without labels: each rule has, for good and for bad documents, a probability of every
vote. Expectation-maximisation finds these accuracies and the share of good documents; the
posterior probability of "good" replaces all-must-pass filtering.

The fit needs only how often each combination of votes occurs. There are at most ``3 ** rules``
combinations however many documents there are, so the iterations run on that small table while
measuring and scoring stay in one pass over the documents. All of it is DataFrame code.

Cases: a null or empty text has no words and fails the base rules. Equal rows get equal verdicts.
An empty table gives an empty result. Other columns are carried along; names that the operator
adds replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import numbered, stored, word_array

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

GOOD, ABSTAIN, BAD = 1, 0, -1


@dataclass(frozen=True)
class Rule:
    """Votes good or bad by a share; between the two limits it abstains."""

    name: str
    good_from: float = float("-inf")
    good_to: float = float("inf")
    bad_below: float = float("-inf")
    bad_above: float = float("inf")

    def vote(self, share: Column) -> Column:
        bad = (share < F.lit(self.bad_below)) | (share > F.lit(self.bad_above))
        good = share.between(F.lit(self.good_from), F.lit(self.good_to))
        return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


#: The share that each rule looks at is in ``_shares`` under the same name.
RULES = (
    Rule("symbols", good_to=0.02, bad_above=0.1),
    Rule("exclamations", good_to=0.05, bad_above=0.3),
    Rule("capitals", good_to=0.15, bad_above=0.4),
    Rule("repeats", good_to=0.15, bad_above=0.4),
    Rule("same_lines", good_to=0.1, bad_above=0.3),
    Rule("word_length", good_from=3, good_to=10, bad_below=2, bad_above=15),
    Rule("variety", good_from=0.3, bad_below=0.1),
    Rule("sentences", good_from=0.01, good_to=0.4, bad_above=0.7),
)

MIN_WORDS = 50
KEEP_FROM = 0.5
#: The fit ends after so many rounds, or once the share of good documents moves less than this.
ITERATIONS, SETTLED = 25, 1e-6


def bound(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, also where that looks at it many times."""
    return F.transform(F.array(value), use)[0]


#: Low bits of a sort key that hold the window's position; the rest is a hash of its words.
PLACE_BITS = 24
PLACE = (1 << PLACE_BITS) - 1


def _covered(starts: Column) -> Column:
    """Words covered by three-word windows at these positions, in ascending order."""
    return bound(starts, lambda s: F.aggregate(
        F.transform(s, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - at, F.lit(3)))),
        F.lit(0), lambda total, more: total + more,
    ))


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    The sort key of a window is a hash of its words above its position, so equal windows become
    neighbours in a plain sort of numbers. Neighbours with one hash are compared word by word; in
    the rare text where hashes agree and words don't, and in texts longer than the position
    holds, the keys are the words themselves.
    """

    def at(w: Column) -> Column:
        return F.sequence(F.lit(0), F.size(w) - 3)

    def same_hash(a: Column, b: Column) -> Column:
        return F.coalesce(a.bitwiseXOR(b).between(0, PLACE), F.lit(False))

    def place(key: Column) -> Column:
        return key.bitwiseAND(F.lit(PLACE)).cast("int")

    def by_hash(w: Column) -> Column:
        def numbers(keys: Column) -> Column:
            hits = F.filter(keys, lambda k, i: same_hash(k, F.get(keys, i - 1)) | same_hash(k, F.get(keys, i + 1)))

            def compared(h: Column) -> Column:
                def differs(k: Column, i: Column) -> Column:
                    a, b = place(k), place(F.get(h, i - 1))
                    other = F.lit(False)
                    for step in range(3):
                        other = other | (F.get(w, a + step) != F.get(w, b + step))
                    return same_hash(k, F.get(h, i - 1)) & other

                mixed = F.size(F.filter(h, differs)) > 0
                return F.when(mixed, by_words(w)).otherwise(_covered(F.sort_array(F.transform(h, place))))

            return F.when(F.size(hits) == 0, F.lit(0)).otherwise(bound(hits, compared))

        keys = F.transform(at(w), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
                           .bitwiseAND(F.lit(~PLACE)).bitwiseOR(i.cast("long")))
        return bound(F.sort_array(keys), numbers)

    def by_words(w: Column) -> Column:
        def strings(keys: Column) -> Column:
            def window(key: Column) -> Column:
                return F.substring_index(key, " ", 3)

            hits = F.filter(keys, lambda k, i: F.coalesce(window(F.get(keys, i - 1)) == window(k), F.lit(False))
                            | F.coalesce(window(F.get(keys, i + 1)) == window(k), F.lit(False)))
            return _covered(F.sort_array(F.transform(hits, lambda k: F.substring_index(k, " ", -1).cast("int"))))

        keys = F.transform(at(w), lambda i: F.concat_ws(
            " ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2), F.lpad(i.cast("string"), 10, "0")))
        return bound(F.sort_array(keys), strings)

    return F.when(F.size(words) < 3, F.lit(0)).when(F.size(words) > PLACE, by_words(words)).otherwise(by_hash(words))


def _measures(text: Column) -> Column:
    """One struct with every count; the words are split once."""
    plain = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(plain, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # What the counts of single characters need is a small part of the text; cut it out once.
    marks = F.regexp_replace(plain, r"[^#*$%&|<>!.?\p{Lu}]+", "")

    def left(marks: Column, pattern: str) -> Column:
        return F.length(F.regexp_replace(marks, pattern, "")).cast("long")

    def counts(w: Column) -> Column:
        return bound(marks, lambda k: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            left(k, r"[^#*$%&|<>]+").alias("n_symbols"),
            bound(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("_lines"),
            F.size(F.array_distinct(w)).cast("long").alias("_distinct"),
            left(k, r"[^!]+").alias("_exclaims"),
            left(k, r"\P{Lu}+").alias("_capitals"),
            left(k, r"[^.?]+").alias("_ends"),
        ))

    return bound(word_array(text), counts)


def _shares(m) -> dict[str, Column]:
    words = F.greatest(m("n_words"), F.lit(1))
    return {
        "symbols": m("n_symbols") / words,
        "exclamations": m("_exclaims") / words,
        "capitals": m("_capitals") / F.greatest(m("word_chars"), F.lit(1)),
        "repeats": m("n_repeat_words") / words,
        "same_lines": m("n_dup_lines") / F.greatest(m("_lines"), F.lit(1)),
        "word_length": m("word_chars") / words,
        # A long text repeats its common words; the root keeps the share comparable.
        "variety": m("_distinct") / F.pow(words, F.lit(0.75)),
        "sentences": m("_ends") / words,
    }


def measured(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The rows with their counts, the base verdict and every rule's vote in ``votes``."""
    names = {n.lower() for n in [*MEASURES, "base_failed", "votes", "_m"]}
    carried = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in names and (keep_text or c != text)]
    m = lambda name: F.col("_m")[name]
    shares = _shares(m)
    failed = (m("n_words") < MIN_WORDS) | (100 * m("n_repeat_words") > 50 * m("n_words"))
    return docs.select(*carried, _measures(F.col(f"`{text}`")).alias("_m")).select(
        *carried, *[m(n).alias(n) for n in MEASURES], failed.alias("base_failed"),
        F.array(*[rule.vote(shares[rule.name]) for rule in RULES]).alias("votes"),
    )


def _posterior(votes: Column, prior: float, chance: list[dict[int, tuple[float, float]]]) -> Column:
    """P(good | votes), the rules taken as independent.

    The numbers are one array, so the code that Spark generates is the same in every iteration and
    compiled once.
    """
    weights = [log(of[v][0]) - log(of[v][1]) for of in chance for v in (BAD, ABSTAIN, GOOD)]
    numbers = F.array(*map(F.lit, [*weights, log(prior) - log(1 - prior)]))
    parts = F.transform(votes, lambda v, j: F.get(numbers, j * 3 + v + 1))
    return 1 / (1 + F.exp(-F.aggregate(parts, F.get(numbers, F.lit(len(weights))), lambda total, x: total + x)))


@dataclass(frozen=True)
class Fit:
    """Share of good documents, and by rule and vote its chance in good and in bad documents."""

    prior: float
    chance: list[dict[int, tuple[float, float]]]

    def accuracy(self, j: int) -> float:
        """Chance that rule j is right when it votes, at the fitted share of good documents."""
        of = self.chance[j]
        right = self.prior * of[GOOD][0] + (1 - self.prior) * of[BAD][1]
        wrong = self.prior * of[BAD][0] + (1 - self.prior) * of[GOOD][1]
        return right / (right + wrong)


#: A rule calls at most this share of good documents bad. Without it two kinds of bad document
#: can drift apart, one of them passing for the good class.
FALSE_ALARM = 0.001


#: Where the fit begins, and the result for an empty table: good documents are the rule, a rule
#: seldom calls a good document bad, and a bad document has some of the faults, not all.
START = Fit(0.8, [{GOOD: (0.85, 0.60), ABSTAIN: (0.149, 0.15), BAD: (0.001, 0.25)} for _ in RULES])


def fit(patterns: DataFrame, iterations: int = ITERATIONS) -> Fit:
    """EM over the table of vote combinations (``votes``, ``n``)."""
    now = START
    one_task = patterns.coalesce(1)  # at most 3 ** rules rows
    for _ in range(iterations):
        good = _posterior(F.col("votes"), now.prior, now.chance)
        each = one_task.select("n", good.alias("p"), F.posexplode("votes").alias("j", "v"))
        sums = each.groupBy("j", "v").agg(F.sum(F.col("n") * F.col("p")).alias("g"), F.sum(F.col("n") * (1 - F.col("p"))).alias("b"))
        found = {(r.j, r.v): (r.g, r.b) for r in sums.collect()}  # a row for each rule and vote
        if not found:
            return now
        total = [sum(found.get((0, v), (0, 0))[k] for v in (GOOD, ABSTAIN, BAD)) for k in (0, 1)]

        def share(k: int, j: int, v: int) -> float:
            # One pseudo-count for the start keeps every chance above nought.
            chance = (found.get((j, v), (0, 0))[k] + START.chance[j][v][k]) / (total[k] + 1)
            return min(chance, FALSE_ALARM) if (k, v) == (0, BAD) else chance

        after = Fit(
            (total[0] + START.prior) / (sum(total) + 1),
            [{v: (share(0, j, v), share(1, j, v)) for v in (GOOD, ABSTAIN, BAD)} for j in range(len(RULES))],
        )
        settled = abs(after.prior - now.prior) < SETTLED
        now = after
        if settled:
            break
    return now


def judged(docs: DataFrame, text: str = "text", iterations: int = ITERATIONS, keep_text: bool = True) -> DataFrame:
    """The rows with counts, ``base_failed``, ``quality`` (posterior, 0 to 1) and ``kept``.

    What ``docs`` carries is written once to the shared folder, so hand in the columns you need;
    without ``keep_text`` the text itself is left out.
    """
    rated = stored(measured(docs, text, keep_text), "quality")
    patterns = stored(rated.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).coalesce(1), "quality-votes")
    found = fit(patterns, iterations)
    quality = _posterior(F.col("votes"), found.prior, found.chance)
    carried = [F.col(f"`{c}`") for c in rated.columns if c.lower() not in {"votes", "quality", "kept"}]
    return rated.select(*carried, quality.alias("quality"), (~F.col("base_failed") & (quality >= KEEP_FROM)).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows judged good, with the columns of ``docs`` unchanged."""
    rows, at, names = numbered(docs, text)
    return judged(rows, at).where("kept").select(rows.columns).toDF(*names)
