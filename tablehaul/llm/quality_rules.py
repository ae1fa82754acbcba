"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Each rule looks at a few counts of a text and votes good (1), bad (-1) or abstains (0). How
often a rule votes rightly is not known; it is estimated together with the share of good texts by
expectation-maximisation over the vote patterns of all texts with words. The posterior probability of being good
then decides, instead of asking that all rules pass: a single bad vote of a rule that errs on
good texts is outweighed, and several that each would not do drop a text together.

Rules that see the same fault agree more often than chance, which a model with one kind of bad text takes for many
independent witnesses. Bad texts are therefore a mixture of KINDS, each with rates of its own, in
which the rules of a fault fire together. Rules start from a belief, of a fixed number of votes, about
which of them tell a kind.

There are at most 3^rules patterns however many texts there are, so their counts are what the
driver sees; the posterior is a plain column expression over the votes.

Defined results: a null or wordless text has no words, fails the base rule, has no part in the estimate and is not kept.
Texts on which every rule abstains get the estimated share of good texts as posterior. A posterior equal to ``least``
keeps the text. Texts of any length are counted whole. An empty table gives no rows. Repeated rows count as often as they
occur; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.common import durable
from tablehaul.llm.text_stats import with_stats


def _share(of: str | Column, by: str) -> Column:
    return (F.col(of) if isinstance(of, str) else of) / F.greatest(F.col(by), F.lit(1))


@dataclass(frozen=True)
class Rule:
    name: str
    bad: Callable[[], Column]
    good: Callable[[], Column]
    least_words: int = 1

    def vote(self) -> Column:
        return F.when(F.col("n_words") < self.least_words, 0).when(self.bad(), -1).when(self.good(), 1).otherwise(0)


def _high(name: str, of: str, by: str, bad: float, good: float) -> Rule:
    """A rule against a high share."""
    return Rule(name, lambda: _share(of, by) > bad, lambda: _share(of, by) < good)


def _within(name: str, share: Callable[[], Column], bad: tuple, good: tuple, least_words: int = 1) -> Rule:
    """A rule against a share outside ``bad``, for one within ``good``."""
    return Rule(name, lambda: ~share().between(*bad), lambda: share().between(*good), least_words)


def _alphanumeric() -> Column:
    return _share(F.col("word_chars") - F.col("n_symbols") - F.col("n_marks") - F.col("n_exclaim"), "word_chars")


def _variety() -> Column:
    return F.log("n_distinct") / F.log(F.greatest("n_words", F.lit(2)))


RULES = (
    _high("symbols", "n_symbols", "n_words", 0.1, 0.02),
    _high("dup_lines", "n_dup_lines", "n_lines", 0.3, 0.1),
    _high("repeats", "n_repeat_words", "n_words", 0.25, 0.1),
    _high("upper", "n_upper", "word_chars", 0.2, 0.08),
    _high("exclaim", "n_exclaim", "n_words", 0.1, 0.03),
    _high("adjacent", "n_adjacent", "n_words", 0.06, 0.03),
    _high("digits", "n_digits", "word_chars", 0.1, 0.03),
    _within("word_length", lambda: _share("word_chars", "n_words"), (3.5, 7), (4, 6.5)),
    _within("marks", lambda: _share("n_marks", "n_words"), (0.05, 0.35), (0.07, 0.25)),
    _within("alphanumeric", _alphanumeric, (0.91, 1), (0.93, 1)),
    _within("variety", _variety, (0.8, 1), (0.9, 1), 20),
    _within("line_length", lambda: _share("n_words", "n_lines"), (5, 300), (8, 150), 20),
)
#: Kinds of bad texts, and the rules that are believed to tell each.
KINDS = {
    "noise": ("symbols", "alphanumeric", "word_length", "digits", "marks"),
    "shouting": ("upper", "exclaim", "marks"),
    "repetition": ("dup_lines", "repeats", "adjacent", "variety", "line_length"),
}
#: The belief estimates start from and are drawn to: the share of good texts, and how often a rule votes bad on good
#: texts, on texts of a kind it tells, and on others; and how many votes, of each rule, it weighs.
GOOD, BAD_ON_GOOD, BAD_ON_KIND, BAD_ON_OTHER = 0.8, 0.02, 0.6, 0.1
VOTES_ON_GOOD, VOTES_ON_KIND = 200.0, 20.0


@dataclass(frozen=True)
class Weights:
    """Shares of good texts and of each kind of bad ones, and on each how often a rule's vote is bad."""

    shares: np.ndarray
    bad: np.ndarray

    @property
    def good(self) -> float:
        return float(self.shares[0])

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """Of each kind of bad texts against good ones, one row per row of votes."""
        votes = np.atleast_2d(votes)
        logs = np.log(self.shares) + (votes < 0) @ np.log(self.bad).T + (votes > 0) @ np.log(1 - self.bad).T
        return logs[:, 1:] - logs[:, :1]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of being good."""
        return 1 / (1 + np.exp(np.clip(self.log_odds(votes), -500, 500)).sum(axis=1))


def belief() -> Weights:
    """What is believed before any text is seen."""
    bad = np.full((1 + len(KINDS), len(RULES)), BAD_ON_OTHER)
    bad[0] = BAD_ON_GOOD
    for k, rules in enumerate(KINDS.values()):
        bad[k + 1, [r.name in rules for r in RULES]] = BAD_ON_KIND
    return Weights(np.array([GOOD] + [(1 - GOOD) / len(KINDS)] * len(KINDS)), bad)


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 500) -> Weights:
    """Expectation-maximisation over (votes, number of texts)."""
    prior = w = belief()
    if not patterns:
        return w
    votes = np.array([v for v, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    firm = np.array([VOTES_ON_GOOD] + [VOTES_ON_KIND] * len(KINDS))
    for _ in range(rounds):
        odds = np.exp(np.clip(w.log_odds(votes), -500, 500))
        member = np.concatenate([np.ones((len(n), 1)), odds], axis=1)
        member *= (n / member.sum(axis=1))[:, None]
        bad, cast = member.T @ (votes < 0), member.T @ (votes != 0)
        new = Weights(
            (member.sum(axis=0) + VOTES_ON_KIND * prior.shares) / (n.sum() + VOTES_ON_KIND),
            (bad + firm[:, None] * prior.bad) / (cast + firm[:, None]),
        )
        moved = max(np.abs(new.shares - w.shares).max(), np.abs(new.bad - w.bad).max())
        w = new
        if moved < 1e-9:
            break
    return w


def vote_patterns(voted: DataFrame) -> list[tuple[tuple[int, ...], int]]:
    """How often each pattern of votes occurs: at most 3^rules rows."""
    names = [f"vote_{r.name}" for r in RULES]
    rows = voted.groupBy(*names).count().collect()
    return sorted((tuple(r[:-1]), r["count"]) for r in rows)


def posterior(w: Weights) -> Column:
    """Probability that a text is good, from its vote columns."""
    total = F.lit(1.0)
    for share, bad in zip(w.shares[1:], w.bad[1:], strict=True):
        odds = F.lit(float(np.log(share / w.shares[0])))
        for rule, b, g in zip(RULES, bad.tolist(), w.bad[0].tolist(), strict=True):
            vote = F.col(f"vote_{rule.name}")
            odds += F.when(vote < 0, float(np.log(b / g))).when(vote > 0, float(np.log((1 - b) / (1 - g)))).otherwise(0.0)
        total += F.exp(F.least(odds, F.lit(500.0)))
    return F.lit(1.0) / total


def judged(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Per row: id, the counts, base_failed, a vote per rule, p_good and kept.

    A text is kept if it passes the base rule and is good with probability ``least`` or more.
    """
    voted = with_stats(df, id_col, text_col).select(
        "*", *[r.vote().alias(f"vote_{r.name}") for r in RULES]
    )
    voted = durable(voted, "quality-votes")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        voted.withColumn("base_failed", failed)
        .withColumn("p_good", posterior(estimate(vote_patterns(voted.where("n_words > 0")))))
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least))
    )
