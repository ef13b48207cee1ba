"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation finds out how far to trust each.

All of it is DataFrame expressions. The features of a text are array expressions over its own words and lines, so
documents are never shuffled. The model needs no document again either: how often each combination of votes occurs
says all, and there are at most ``3 ** len(RULES)`` combinations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import settled

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: A rule is a value with bounds: a vote for good, a vote for bad, or an abstention in between.
RULES: dict[str, tuple[str, str, str]] = {
    "length": ("n_words", "v >= 30", "v < 10"),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", "v <= 0.05", "v > 0.2"),
    "symbols": ("n_symbols / greatest(n_words, 1)", "v <= 0.02", "v > 0.1"),
    "lines": ("n_dup_lines / greatest(n_lines, 1)", "v <= 0.1", "v > 0.3"),
    "word_length": ("word_chars / greatest(n_words, 1)", "v between 3.5 and 9", "v < 2.5 or v > 12"),
    "capitals": ("n_capitals / greatest(n_letters, 1)", "v <= 0.15", "v > 0.4"),
    "marks": ("n_marks / greatest(n_words, 1)", "v <= 0.05", "v > 0.25"),
}
GOOD, BAD, ABSTAIN = 1, 2, 0
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and what the rules look at, for every row; a null text counts as empty.

    Repeated windows of a text are found by sorting: each window's hash gives its upper bits to a number whose lower
    bits are its position, and equal windows then lie side by side. The whole 64 bits are compared before two count as
    equal.
    """
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    step = text.select(
        "doc_id",
        F.array_remove(F.split("t", r"[\x20\x09-\x0D]+"), "").alias("w"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("t", F.lit(r"\p{L}")).cast("long").alias("n_letters"),
        F.regexp_count("t", F.lit("[!?]")).cast("long").alias("n_marks"),
        lines.alias("l"),
    )
    kept = ["doc_id", "word_chars", "n_symbols", "n_capitals", "n_letters", "n_marks"]
    step = step.select(
        *kept,
        F.size("w").cast("long").alias("n_words"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    kept += ["n_words", "n_lines", "n_dup_lines"]
    window = ", ".join(f"h[i + {k}]" for k in range(WINDOW))
    step = step.select(*kept, F.expr(f"if(n_words < {WINDOW}, array(), transform(sequence(0, cast(n_words as int) - {WINDOW}), i -> xxhash64({window})))").alias("g"))
    step = step.select(*kept, "g", F.expr("length(bin(size(g)))").alias("b"), F.expr("shiftleft(1L, length(bin(size(g)))) - 1").alias("m"))
    # Upper bits of the hash over the position, in b bits.
    step = step.select(*kept, "g", "m", F.expr("sort_array(transform(g, (x, i) -> shiftleft(shiftright(x, b), b) | cast(i as bigint)))").alias("s"))
    equal = "g[cast(s[{}] & m as int)] = g[cast(s[k] & m as int)]"
    several = f"(k > 0 and {equal.format('k - 1')}) or (k < size(s) - 1 and {equal.format('k + 1')})"
    step = step.select(*kept, "s", "m", F.expr(f"if(size(s) < 2, array(), filter(sequence(0, size(s) - 1), k -> {several}))").alias("at"))
    step = step.select(*kept, F.expr("sort_array(transform(at, k -> s[k] & m))").alias("at"))
    covered = F.expr(
        "aggregate(at, named_struct('n', 0L, 'to', 0L), "
        f"(a, p) -> named_struct('n', a.n + p + {WINDOW} - greatest(p, a.to), 'to', p + {WINDOW}), a -> a.n)"
    )
    return step.select(*kept, covered.alias("n_repeat_words"))


def votes() -> list[Column]:
    """One column per rule: good, bad or abstain."""
    out = []
    for name, (value, good, bad) in RULES.items():
        good, bad = (F.expr(x.replace("v ", f"({value}) ")) for x in (good, bad))
        out.append(F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN).alias(f"vote_{name}"))
    return out


Model = tuple[list[float], list[list[float]]]
#: A good text sets a rule off at most so often; a text that is bad in a rule's way at least so often.
FALSE_ALARM, SEEN = 0.01, 0.5


def fit(patterns: list[tuple[list[int], int]], rounds: int = 100) -> Model:
    """Shares of the kinds of text, and how often each kind sets off each rule.

    Texts are bad in different ways, and rules that see one way say nothing of the others. So there is one kind of
    good text and, for each rule, one kind of bad text that mainly this rule sees; which other rules see it too is
    estimated. ``patterns`` are combinations of votes with the number of documents that have them. Abstentions are
    left out of every count.
    """
    rules = range(len(RULES))
    shares = [0.8] + [0.2 / len(RULES)] * len(RULES)
    alarms = [[0.01 for _ in rules]] + [[0.9 if r == kind else 0.1 for r in rules] for kind in rules]
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        mass = [1e-6 for _ in shares]
        fired, voted = ([[1e-6 for _ in rules] for _ in shares] for _ in range(2))
        for vote, n in patterns:
            for kind, p in enumerate(kinds_of(vote, (shares, alarms))):
                mass[kind] += n * p
                for r, v in enumerate(vote):
                    if v != ABSTAIN:
                        voted[kind][r] += n * p
                        fired[kind][r] += n * p * (v == BAD)
        shares = [m / sum(mass) for m in mass]
        for kind, row in enumerate(alarms):
            for r in rules:
                low, high = (1e-4, FALSE_ALARM) if kind == 0 else (SEEN if r == kind - 1 else 1e-3, 0.999)
                row[r] = min(high, max(low, fired[kind][r] / voted[kind][r]))
    return shares, alarms


def kinds_of(vote: list[int], model: Model) -> list[float]:
    """Posterior probability of each kind of text, good first."""
    shares, alarms = model
    chances = [s * math.prod(1 if v == ABSTAIN else a if v == BAD else 1 - a for v, a in zip(vote, row, strict=True)) for s, row in zip(shares, alarms, strict=True)]
    return [c / sum(chances) for c in chances]


def quality(model: Model) -> Column:
    """Posterior probability of good, of the votes of a row."""
    chances = []
    for share, row in zip(*model, strict=True):
        terms = [F.element_at(F.array(F.lit(1.0), F.lit(1 - a), F.lit(a)), vote + 1) for vote, a in zip(votes(), row, strict=True)]
        chances.append(math.prod(terms, start=F.lit(share)))
    return chances[0] / sum(chances[1:], chances[0])


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The features of every row, ``base_failed``, ``quality`` (posterior probability of good) and ``kept``.

    ``base_failed``: fewer than 10 words, or more than 20 % of the words in repeated windows; such rows are not kept.
    All others are kept if their quality is at least ``threshold``. The model is fitted on the votes of all rows.

    Null, empty and blank texts have no words and fail. Each row is judged by itself, so repeated rows and ids, or
    null ids, give a row each. An empty table gives no rows. Other columns are ignored. Texts are read whole; a text
    is one row of arrays in memory.
    """
    held = settled(features(docs), "features")
    counted = held.groupBy(*votes()).count().collect()  # 3 ** len(RULES) rows at most
    model = fit(sorted((list(row[:-1]), row[-1]) for row in counted))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = held.withColumn("base_failed", failed).withColumn("quality", quality(model))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
