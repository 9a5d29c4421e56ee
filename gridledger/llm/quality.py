"""Quality rules under weak supervision.

Each rule votes good (1), bad (0) or abstains (NULL). How far a rule can be trusted on good and on bad
documents is estimated from all votes together by expectation-maximisation: given these accuracies, a
document's probability of being good follows; given the probabilities, so do the accuracies. Kinds of
junk exclude one another, so a rule that says nothing against a document proves little, while an
objection that good documents hardly ever meet proves much: hence two accuracies per rule. Documents with equal votes are one row with
a count, at most 3 ** rules rows, so an iteration costs the same whatever the corpus, and the votes of
all documents count. The posterior replaces a filter that a document must pass in every rule.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import SPACES, WORD, let, without, words
from gridledger.operators.session import durable

SYMBOLS = "#*$%&|<>"
WINDOW = 8
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ROUNDS = 30
TOLERANCE = 1e-6
#: Share of its votes in which a rule objects to a bad document (hit) and to a good one (alarm): start and range.
#: A rule is taken to object to bad documents more often, and never to be infallible.
HIT, ALARM = (0.4, 0.05, 0.99), (0.05, 0.001, 0.05)
PRIOR_START, PRIOR_LEAST, PRIOR_MOST = 0.8, 0.05, 0.95


def repeat_words(ws: Column) -> Column:
    """Words that lie in a window of WINDOW words found twice or more in the text, the first included.

    Windows are compared by 64-bit hashes. Only a text with a repeated window is sorted.
    """
    n = F.size(ws)
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    windows = F.when(
        n > WINDOW, let(ws, lambda w: F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW))))
    ).otherwise(F.array().cast("array<long>"))

    def covered(found: Column) -> Column:
        numbered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            last = F.size(s) - 1
            kept = F.filter(s, lambda x, i: (
                ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"]))
                | ((i < last) & (F.get(s, F.least(i + 1, last))["h"] == x["h"]))
            ))
            return F.array_sort(F.transform(kept, lambda x: x["i"]))

        def length(at: Column) -> Column:
            last = F.size(at) - 1
            steps = F.transform(at, lambda p, i: F.when(i == last, F.lit(WINDOW)).otherwise(
                F.least(F.lit(WINDOW), F.get(at, F.least(i + 1, last)) - p)))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(let(numbered, repeated), length)

    return let(windows, lambda found: F.when(
        F.size(F.array_distinct(found)) < F.size(found), covered(found)).otherwise(F.lit(0))).cast("long")


def with_features(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows with FEATURES (long); columns of these names are replaced. A NULL text counts as empty."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kept = without(documents, FEATURES)
    lines = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(WORD))
    return (
        kept.withColumn("_text", whole)
        .withColumn("_words", words(F.col("_text")))
        .select(
            *[F.col(f"`{c}`") for c in kept.columns],
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
            (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(F.col("_words")).alias("n_repeat_words"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(0)).when(good, F.lit(1))


def rules() -> dict[str, Column]:
    """Rules over FEATURES. Between its two bounds a rule abstains."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    mean, marks = F.col("word_chars") / n, F.col("n_symbols") / n
    dense = F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))
    again, lines = F.col("n_repeat_words") / n, F.col("n_dup_lines")
    return {
        "long_enough": vote(F.col("n_words") < 20, F.col("n_words") >= 40),
        "few_symbols": vote(marks > 0.10, marks < 0.02),
        "few_symbols_per_letter": vote(dense > 0.05, dense < 0.01),
        "word_length": vote((mean < 2.5) | (mean > 12), (mean >= 3) & (mean <= 10)),
        "little_repetition": vote(again > 0.20, again < 0.05),
        "own_lines": vote(lines >= 3, lines == 0),
    }


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents; per rule how often it objects, when it votes, to bad and to good ones."""

    prior: float
    hit: dict[str, float]
    alarm: dict[str, float]

    def posterior(self) -> Column:
        """Probability that a document with these votes is good; a document without votes has the prior."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, hit in self.hit.items():
            alarm = self.alarm[rule]
            for_good, against = math.log((1 - alarm) / (1 - hit)), math.log(alarm / hit)
            odds = odds + F.when(F.col(rule) == 1, for_good).when(F.col(rule) == 0, against).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit(votes: DataFrame, names: list[str], rounds: int = ROUNDS) -> LabelModel:
    """Estimate the label model from all votes; one row of sums per round reaches the driver.

    An empty table leaves the starting values.
    """
    patterns = durable(votes.groupBy(*names).agg(F.count(F.lit(1)).alias("_count")).coalesce(1))
    model = LabelModel(PRIOR_START, dict.fromkeys(names, HIT[0]), dict.fromkeys(names, ALARM[0]))
    kinds = {"good": F.col("_count") * F.col("_p"), "bad": F.col("_count") * (1 - F.col("_p"))}
    for _ in range(rounds):
        sums = patterns.withColumn("_p", model.posterior()).agg(
            *[F.sum(w).alias(kind) for kind, w in kinds.items()],
            *[F.sum(F.when(F.col(r).isNotNull(), w)).alias(f"{r}_{kind}") for r in names for kind, w in kinds.items()],
            *[F.sum(F.when(F.col(r) == 0, w)).alias(f"{r}_{kind}_against") for r in names for kind, w in kinds.items()],
        ).first()
        if not sums["good"]:
            return model

        def share(rule: str, kind: str, limits: tuple[float, float, float]) -> float:
            of, against = sums[f"{rule}_{kind}"], sums[f"{rule}_{kind}_against"] or 0.0
            return min(max(against / of, limits[1]), limits[2]) if of else limits[0]

        after = LabelModel(
            min(max(sums["good"] / (sums["good"] + sums["bad"]), PRIOR_LEAST), PRIOR_MOST),
            {r: share(r, "bad", HIT) for r in names}, {r: share(r, "good", ALARM) for r in names},
        )
        moved = max(
            abs(after.prior - model.prior),
            *(abs(after.hit[r] - model.hit[r]) + abs(after.alarm[r] - model.alarm[r]) for r in names),
        )
        model = after
        if moved < TOLERANCE:
            break
    return model


def judge(documents: DataFrame, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows without their text, with FEATURES, base_failed, one vote per rule, p_good and kept.

    Kept is a document that does not fail the base rules and is good with `threshold` or more. NULL and
    empty texts have no words and fail. Repeated rows are judged alike, rows with NULL in other columns
    like any other. Columns named like the operator's own are replaced. An empty table stays empty.
    """
    ballots = rules()
    names = list(ballots)
    features = durable(with_features(documents, text).drop(text, *names, "base_failed", "p_good", "kept"))
    voted = features.withColumn("base_failed", base_failed()).withColumns(ballots)
    model = fit(voted.select(*names), names)
    return voted.withColumn("p_good", model.posterior()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)
    )
