"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a test over a few measures of the text. Cost and share of rejected texts of each rule
are estimated on a sample by hash; the cascade then asks the rules in the order of rejections
per second. The measures of a rule are computed when it is asked, so a text that fails one rule
costs nothing more. The verdict is that of all rules, whatever the order.

Null and empty texts have no words and fail. Repeated rows are judged one by one. A very long text
is one row like any other, judged whole. An empty table gives no rows. Other columns do not matter,
whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import SPACES, WORD, let, saved

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"
LETTER = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"
CUT = r"(\.\.\.|…)[\x20\x09-\x0D]*\z"
BULLET = r"\A[\x20\x09-\x0D]*[-*•]"
# Rows of the sample on which cost and selectivity are estimated, on average, and how often each is timed.
SAMPLE_ROWS, TIMES = 512, 2


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES)
    )


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")


def lines(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def n_such(all_: Column, pattern: str) -> Column:
    """How many of the words or lines have the pattern."""
    return F.size(F.filter(all_, lambda one: one.rlike(pattern))).cast("long")


def n_dup_lines(text: Column) -> Column:
    return let(lines(text), lambda all_: F.size(all_) - F.size(F.array_distinct(all_))).cast("long")


def _covered(windows: Column, width: int) -> Column:
    """Words within windows whose hash occurs twice or more; ``windows`` are hashes by place.

    Sorted by hash and place, repeated windows are neighbours; their places, sorted
    again, each add the words up to the next one, at most ``width``.
    """

    def places(ranked: Column) -> Column:
        def repeated(place: Column, i: Column) -> Column:
            here = F.get(ranked, i)["h"]
            return F.coalesce(here == F.get(ranked, i - 1)["h"], F.lit(False)) | F.coalesce(
                here == F.get(ranked, i + 1)["h"], F.lit(False)
            )

        return F.sort_array(F.transform(F.filter(ranked, repeated), lambda x: x["i"]))

    def total(at: Column) -> Column:
        gaps = F.transform(
            at, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(at, i + 1) - p, F.lit(width)))
        )
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    ranked = F.sort_array(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    return let(let(ranked, places), total)


def n_repeat_words(words: Column, width: int = 5) -> Column:
    """Words in windows of ``width`` words that the text has twice or more, first ones included."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - width)
        return F.when(
            F.size(h) >= width,
            F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)])),
        ).otherwise(F.array().cast("array<bigint>"))

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_covered(w, width))

    return let(let(hashes, windows), count).cast("long")


# Each from the text and its words.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, words: F.size(words).cast("long"),
    "word_chars": lambda text, words: F.length(F.array_join(words, "")).cast("long"),
    "n_symbols": lambda text, words: n_symbols(text),
    "n_dup_lines": lambda text, words: n_dup_lines(text),
    "n_repeat_words": lambda text, words: n_repeat_words(words),
    "n_lines": lambda text, words: F.size(lines(text)).cast("long"),
    "n_letter_words": lambda text, words: n_such(words, LETTER),
    "n_cut_lines": lambda text, words: n_such(lines(text), CUT),
    "n_bullet_lines": lambda text, words: n_such(lines(text), BULLET),
}
# Measures that ``judge`` returns, so that they are computed for every row.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A text is rejected where ``rejects`` of its measures holds."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]

    def on(self, text: Column, words: Column) -> Column:
        """The rule on a text, computing what it needs only."""
        return self.rejects(lambda measure: MEASURES[measure](text, words))

    def needs(self) -> set[str]:
        """Names of its measures."""
        asked: set[str] = set()
        self.rejects(lambda measure: asked.add(measure) or F.lit(0))
        return asked


RULES = (
    Rule("few words", lambda m: m("n_words") < 10),
    Rule("repeated words", lambda m: 100 * m("n_repeat_words") > 20 * m("n_words")),
    Rule("symbols", lambda m: 10 * m("n_symbols") > 3 * m("n_words")),
    Rule("repeated lines", lambda m: 10 * m("n_dup_lines") > 7 * m("n_lines")),
    Rule(
        "word length",
        lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 20 * m("n_words")),
    ),
    Rule("few letters", lambda m: 2 * m("n_letter_words") < m("n_words")),
    Rule(
        "cut lines",
        lambda m: (m("n_cut_lines") > 1) & (10 * m("n_cut_lines") > 3 * m("n_lines")),
    ),
    Rule(
        "bullet lines",
        lambda m: (m("n_bullet_lines") > 1) & (10 * m("n_bullet_lines") > 9 * m("n_lines")),
    ),
)
BASE = ("few words", "repeated words")


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def sample(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` texts by the hash of id and text, so from anywhere in the table."""
    many = max(docs.count(), 1)
    bound = -(2**63) + min(2**64 * rows // many, 2**64 - 1)
    taken = docs.filter(F.xxhash64("doc_id", "text") <= F.lit(bound))
    # Equal rows have equal hashes; the limit only bounds what they add.
    return saved(taken.select(whole(F.col("text")).alias("text")).limit(4 * rows))


def estimate(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS
) -> list[tuple[Rule, float, float]]:
    """Each rule with its seconds a row and its share of rejected rows on a sample.

    All rules are asked once before any is timed, and a job without a rule is taken off. The
    sample only ranks the rules, so it cannot change a verdict.
    """
    texts, text = sample(docs, rows), F.col("text")
    asked = [let(words(text), partial(rule.on, text)) for rule in rules]
    counts = texts.agg(F.count("*"), *[F.count_if(rejects) for rejects in asked]).first()
    size = max(counts[0], 1)

    def seconds(test: Column) -> float:
        found = []
        for _ in range(TIMES):
            start = time.perf_counter()
            texts.filter(test).count()
            found.append(time.perf_counter() - start)
        return min(found)

    start_up = seconds(F.length(text) < 0)
    return [
        (rule, max(seconds(rejects) - start_up, 0.0) / size, rejected / size)
        for rule, rejects, rejected in zip(rules, asked, counts[1:])
    ]


def ordered(estimates: list[tuple[Rule, float, float]]) -> list[Rule]:
    """Most rejections per second first; rules that reject nothing by time."""
    ranked = sorted(estimates, key=lambda e: (-e[2] / max(e[1], 1e-9), e[1]))
    return [rule for rule, _, _ in ranked]


def cascade(rules: list[Rule], test: Callable[[Rule], Column]) -> Column:
    """Name of the first rule in order that rejects; null for a text that passes all."""
    first, *rest = rules
    found = F.when(test(first), first.name)
    for rule in rest:
        found = found.when(test(rule), rule.name)
    return found


def filter_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text no rule rejects, all columns as they are."""
    text = whole(docs["text"])
    order = ordered(estimate(docs, rules))
    verdict = let(words(text), lambda w: cascade(order, lambda rule: rule.on(text, w)))
    return docs.filter(verdict.isNull())


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures and verdict of every row: doc_id, measures, base_failed, kept, rejected_by.

    Base rules come first, then those over reported measures, which are there anyway; the others
    are asked in the order of the estimates, and only for texts that have passed so far.
    ``rejected_by`` names the first rule that rejects; the order may differ between runs.
    """
    base = [rule for rule in rules if rule.name in BASE]
    ready = [rule for rule in rules if rule not in base and rule.needs() <= set(REPORTED)]
    late = tuple(rule for rule in rules if rule not in base and rule not in ready)
    order = [*base, *ready, *ordered(estimate(docs, late))]
    text = whole(F.col("text"))

    def judged(words: Column) -> Column:
        def verdict(found: Column) -> Column:
            def measure(name: str) -> Column:
                return found[name] if name in REPORTED else MEASURES[name](text, words)

            return F.struct(
                *[found[name].alias(name) for name in REPORTED],
                cascade(order, lambda rule: rule.rejects(measure)).alias("rejected_by"),
            )

        return let(F.struct(*[MEASURES[name](text, words).alias(name) for name in REPORTED]), verdict)

    found = docs.select("doc_id", F.inline(F.array(let(words(text), judged))))
    rejected = F.col("rejected_by")
    return found.select(
        "doc_id",
        *REPORTED,
        F.coalesce(rejected.isin([rule.name for rule in base]), F.lit(False)).alias("base_failed"),
        rejected.isNull().alias("kept"),
        "rejected_by",
    )
