"""Quality rules under weak supervision: rules vote or abstain, and how far each can be trusted is estimated from the votes.

Every rule says good, bad or nothing about a document. Only vote patterns and their counts, at most three to the power of
the number of rules, enter the estimation. Expectation-maximisation alternates between the probability that a pattern is
that of a good document, or of one with a certain fault, and each rule's accuracy on sound and on faulty documents. The
probability of a document's own pattern replaces the demand that all rules pass. All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdshort.session import freeze

SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 3


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, "")).cast("long")


def _count(text: Column, chars: str) -> Column:
    return F.length(text).cast("long") - _without(text, chars)


def _windows(words: Column) -> Column:
    """A hash of every three words in a row."""
    n = F.size(words)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))


def _covered(windows: Column) -> Column:
    """Number of words in windows that occur twice or more; `windows` is sorted by hash, then position."""
    def repeated(x: Column, k: Column) -> Column:
        same = lambda other: F.coalesce(F.get(windows, other)["h"] == x["h"], F.lit(False))
        return same(k - 1) | same(k + 1)

    at = F.array_sort(F.transform(F.filter(windows, repeated), lambda x: x["i"]))
    gaps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))),
                      lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    return F.aggregate(gaps, F.lit(0), lambda total, x: total + x).cast("long")


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals, n_marks of each whole text.

    A null text has no words. Lines count if they have a word; a line is a duplicate if it equals an earlier one.
    """
    plain = F.col("_text")
    df = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = df.select(
        "key", F.filter(F.split(plain, SPACES), lambda w: w != "").alias("_words"),
        F.filter(F.split(plain, "\n"), lambda x: _without(x, SPACE) > 0).alias("_lines"),
        _without(plain, SPACE).alias("word_chars"), _count(plain, SYMBOLS).alias("n_symbols"),
        _count(plain, CAPITALS).alias("n_capitals"), _count(plain, "!").alias("n_marks"))
    df = df.withColumn("_windows", _windows(F.col("_words")))
    # most texts repeat nothing: only the others are sorted
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    paired = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(
        "key", F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_capitals", "n_marks", F.when(some, paired).alias("_sorted"))
    return df.select(*[c for c in df.columns if c != "_sorted"],
                     F.when(F.col("_sorted").isNull(), F.lit(0).cast("long")).otherwise(_covered(F.col("_sorted")))
                     .alias("n_repeat_words"))


@dataclass(frozen=True)
class Rule:
    """Bad beyond one limit of a measure's share, good within the other, silent between."""

    name: str
    measure: str
    per: str
    good_to: float
    bad_from: float

    def vote(self) -> Column:
        share = F.col(self.measure) / F.greatest(F.col(self.per), F.lit(1))
        if self.good_to > self.bad_from:
            return F.when(share >= self.good_to, 1).when(share < self.bad_from, -1).otherwise(0)
        return F.when(share <= self.good_to, 1).when(share > self.bad_from, -1).otherwise(0)


RULES = (
    Rule("length", "n_words", "one", 80, 50),
    Rule("symbols", "n_symbols", "n_words", 0.02, 0.1),
    Rule("lines", "n_dup_lines", "n_lines", 0.1, 0.5),
    Rule("repeats", "n_repeat_words", "n_words", 0.2, 0.5),
    Rule("long words", "word_chars", "n_words", 9.0, 12.0),
    Rule("short words", "word_chars", "n_words", 3.5, 2.5),
    Rule("capitals", "n_capitals", "word_chars", 0.15, 0.4),
    Rule("marks", "n_marks", "n_words", 0.03, 0.2),
)


def estimate(patterns: DataFrame, votes: list[str], rounds: int = 40, trust: tuple[float, float] = (0.995, 0.9),
             held: float = 0.02) -> Column:
    """The probability that a vote pattern is that of a good document, as an expression over the vote columns.

    `patterns` has the votes and their number `n`. A document is good or has the fault that one of the rules looks for;
    there the rule is right with its accuracy on faults, and what the others say is left open. Silence tells nothing. Accuracies on good and on faulty documents start at `trust` and are smoothed towards it with the weight of
    `held` of all documents. Without documents the start is the result.
    """
    good, bad = ({v: t for v in votes} for t in trust)
    share = {v: 0.2 / len(votes) for v in votes}

    def odds(v: str) -> Column:
        """Of the fault of this rule against no fault."""
        start = share[v] / max(1e-9, 1 - sum(share.values()))
        return F.when(F.col(v) == -1, start * bad[v] / (1 - good[v])).when(
            F.col(v) == 1, start * (1 - bad[v]) / good[v]).otherwise(start)

    def chance() -> Column:
        return F.lit(1.0) / sum((odds(v) for v in votes), F.lit(1.0))

    for _ in range(rounds):
        faults = patterns.withColumn("_good", chance()).select(
            *votes, "n", (F.col("_good") * F.col("n")).alias("_sound"), *[(odds(v) * F.col("_good") * F.col("n")).alias(f"_{v}") for v in votes])
        sums = faults.agg(F.sum("n").alias("n"), *[F.sum(x).alias(f"{v}_{name}") for v in votes for name, x in (
            ("fault", F.col(f"_{v}")),
            ("found", F.when(F.col(v) == -1, F.col(f"_{v}"))), ("judged", F.when(F.col(v) != 0, F.col(f"_{v}"))),
            ("passed", F.when(F.col(v) == 1, F.col("_sound"))), ("sound", F.when(F.col(v) != 0, F.col("_sound"))),
        )]).first()
        if not sums["n"]:
            break
        extra, before = held * sums["n"], [*share.values(), *good.values(), *bad.values()]
        for v in votes:
            fault, found, judged, passed, sound = (
                sums[f"{v}_{x}"] or 0.0 for x in ("fault", "found", "judged", "passed", "sound"))
            share[v] = fault / sums["n"]
            good[v] = min(0.9999, (passed + trust[0] * extra) / (sound + extra))
            bad[v] = min(0.9999, (found + trust[1] * extra) / (judged + extra))
        if max(abs(a - b) for a, b in zip(before, [*share.values(), *good.values(), *bad.values()])) < 1e-6:
            break
    return chance()


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures, one vote column per rule (1 good, -1 bad, 0 silent) and `quality`, the posterior probability.

    One row per document; repeated rows and null keys stay. Other columns are left out. Measures are frozen once, since
    counting patterns and judging both read them.
    """
    names = [f"vote_{r.name.replace(' ', '_')}" for r in rules]
    base = measures(docs, key, text).withColumn("one", F.lit(1))
    voted = freeze(base.withColumns({n: r.vote() for n, r in zip(names, rules)}).drop("one"))
    patterns = freeze(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")))
    return voted.withColumn("quality", estimate(patterns, names)).withColumnRenamed("key", key)
