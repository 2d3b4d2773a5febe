"""Operator 13: quality rules as weak supervision.

Each rule looks at one count of a text and votes that it is good, that it is bad, or abstains
(``RULES``: published heuristics, two thresholds each, with a gap between them in which the rule
has no opinion). No rule decides alone. Expectation-maximisation over the counts of all vote
patterns of the corpus estimates how each rule votes on good and on bad texts, which gives its
accuracy, and the share of good texts; a text is kept if its posterior probability of being
good is at least ``KEEP``. The base rules (too short, mostly repetition) come
first and need no estimate.

Texts are read once: counts are written as a narrow table. Votes are column expressions on it, the
patterns (at most 3 ** rules of them, whatever the corpus) are counted by a map-side combined
aggregate, and the verdict is again a column expression: the log odds of a document are the sum
of what each of its votes adds. Pseudo-counts are shares of the corpus, so equal shares of
patterns give equal verdicts at every size.

Defined results: a NULL text has no words; texts that fail the base rules take no part in the
estimate and are not kept; where no text passes them the prior belief stands; repeated rows are judged alike and each counts; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from candlegap.llm.common import read_table, sliced, written

MIN_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
CLOSERS = tuple(".!?\"'”»…:;)")
KEEP = 0.5

#: Prior belief: how a rule votes (good, abstain, bad) on good and on bad texts, most of which it
#: finds nothing wrong with, and the share of good texts. It weighs as much as this share of the
#: corpus.
PRIOR_VOTES = ((0.89, 0.10, 0.01), (0.60, 0.15, 0.25))
PRIOR_GOOD = 0.9
PRIOR_SHARE = 0.005
ROUNDS = 200

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_closed_lines", "n_letters", "n_capitals", "n_marks", "n_plain_words", "n_distinct_words")


@dataclass(frozen=True)
class Rule:
    """Votes on ``part / whole``: good up to ``good``, bad from ``bad`` on (or the other way
    round where ``bad`` is less), abstains in between and where ``whole`` is 0."""

    name: str
    part: str
    whole: str
    good: float
    bad: float

    def vote(self) -> Column:
        """1, -1 or 0."""
        x = F.try_divide(F.col(self.part).cast("double"), F.col(self.whole).cast("double"))
        if self.good < self.bad:
            return F.when(x <= self.good, 1).when(x >= self.bad, -1).otherwise(0)
        return F.when(x >= self.good, 1).when(x <= self.bad, -1).otherwise(0)


#: Thresholds of published web-text heuristics, loosened on one side to leave a gap.
RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.02, 0.1),
    Rule("marks", "n_marks", "word_chars", 0.1, 0.25),
    Rule("letters", "n_plain_words", "n_words", 0.9, 0.8),
    Rule("short_words", "word_chars", "n_words", 3, 2),
    Rule("long_words", "word_chars", "n_words", 10, 14),
    Rule("capitals", "n_capitals", "n_letters", 0.2, 0.4),
    Rule("copied_lines", "n_dup_lines", "n_lines", 0.1, 0.3),
    Rule("repetition", "n_repeat_words", "n_words", 0.1, 0.3),
    Rule("sentences", "n_closed_lines", "n_lines", 0.5, 0.1),
    Rule("variety", "n_distinct_words", "n_words", 0.2, 0.05),
)

_SPACE, _LETTER, _CAPITAL, _MARK = 1, 2, 4, 8


@functools.cache
def _kinds() -> np.ndarray:
    """Flags of each code point: white space, letter, capital, mark (neither letter, digit,
    accent nor white space)."""
    kind = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        name = unicodedata.category(chr(c))
        if name[0] == "L":
            kind[c] = _LETTER | (_CAPITAL if name == "Lu" else 0)
        elif name[0] in "PS":
            kind[c] = _MARK
    kind[[32, 9, 10, 11, 12, 13]] = _SPACE
    return kind


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """(words in windows of ``WINDOW`` words that occur twice or more, distinct words)."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0, len(numbers)
    key = ids[:n]
    for k in range(1, WINDOW):  # windows are numbered anew each time, so the product stays small
        key = np.unique(key * len(numbers) + ids[k:n + k], return_inverse=True)[1]
    again = np.bincount(key)[key] > 1
    inside = np.zeros(len(words), bool)
    for k in range(WINDOW):
        inside[k:n + k] |= again
    return int(inside.sum()), len(numbers)


def counts(text: str) -> tuple[int, ...]:
    """``COUNTS`` of one text."""
    words = text.encode("utf-8", "surrogatepass").split()  # on the six ASCII blanks
    lines, seen, copied, closed = 0, set(), 0, 0
    for line in text.split("\n"):
        bare = line.strip(BLANKS)
        if bare:
            lines += 1
            copied += line in seen
            seen.add(line)
            closed += bare.endswith(CLOSERS)
    kind = _kinds()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    letter, solid = kind & _LETTER != 0, kind != _SPACE
    starts = np.flatnonzero(solid & np.concatenate(([True], ~solid[:-1])))
    plain = int(np.count_nonzero(np.add.reduceat(letter, starts, dtype=np.int64))) if len(starts) else 0
    repeats, distinct = repeated_words(words)
    return (len(words), int(np.count_nonzero(solid)), sum(text.count(s) for s in SYMBOLS), copied, repeats,
            lines, closed, int(np.count_nonzero(letter)), int(np.count_nonzero(kind & _CAPITAL)),
            int(np.count_nonzero(kind & _MARK)), plain, distinct)


def count_documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``COUNTS`` of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in sliced(batches):
            rows = zip(*[counts(t or "") for t in cols["text"]], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), *[pa.array(c, pa.int64()) for c in rows]],
                                             names=["doc_id", *COUNTS])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class VoteModel:
    """How rules vote: ``votes[y, r, v]`` is P(rule r votes v | text is y), y being good or bad, v
    good, abstain or bad; ``share`` is that of good texts."""

    share: float
    votes: np.ndarray

    @staticmethod
    def fit(patterns: np.ndarray, met: np.ndarray) -> VoteModel:
        """From vote patterns (patterns x rules, of 1, 0, -1) and how often each was met."""
        belief = np.array(PRIOR_VOTES)[:, None, :].repeat(patterns.shape[1], axis=1)
        model = VoteModel(PRIOR_GOOD, belief)
        if not len(patterns):
            return model
        weight = met / met.sum()
        cast = np.stack([patterns == v for v in (1, 0, -1)], axis=2).astype(float)
        for _ in range(ROUNDS):
            p = model.posterior(patterns)
            mass = np.stack((weight * p, weight * (1 - p)))
            votes = np.einsum("yp,prv->yrv", mass, cast) + PRIOR_SHARE * belief
            model = VoteModel((mass[0].sum() + PRIOR_SHARE * PRIOR_GOOD) / (1 + PRIOR_SHARE),
                              votes / votes.sum(axis=2, keepdims=True))
        return model

    def accuracy(self) -> np.ndarray:
        """P(a rule's vote is right | it voted), for each rule."""
        right = self.share * self.votes[0, :, 0] + (1 - self.share) * self.votes[1, :, 2]
        wrong = self.share * self.votes[0, :, 2] + (1 - self.share) * self.votes[1, :, 0]
        return right / (right + wrong)

    def log_odds(self) -> tuple[float, np.ndarray]:
        """Log odds of good before any vote, and what each rule's vote (good, abstain, bad) adds."""
        return float(np.log(self.share / (1 - self.share))), np.log(self.votes[0] / self.votes[1])

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        start, added = self.log_odds()
        return 1 / (1 + np.exp(-(start + sum(added[r][1 - patterns[:, r]] for r in range(patterns.shape[1])))))


def _votes() -> list[Column]:
    return [rule.vote().alias(f"v{k}") for k, rule in enumerate(RULES)]


def learn(counted: DataFrame) -> VoteModel:
    """The model of all counted documents that pass the base rules."""
    votes = [f"v{k}" for k in range(len(RULES))]
    met = (counted.where(~base_failed()).select(*_votes()).groupBy(*votes).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(*votes).toPandas())  # at most 3 ** rules rows
    return VoteModel.fit(met[votes].to_numpy(np.int64).reshape(-1, len(RULES)), met["n"].to_numpy(np.float64))


def posterior(model: VoteModel) -> Column:
    """P(good) of a counted document."""
    start, added = model.log_odds()
    odds = F.lit(start)
    for k, rule in enumerate(RULES):
        good, none, bad = added[k].tolist()
        vote = rule.vote()
        odds = odds + F.when(vote == 1, good).when(vote == -1, bad).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def judged(docs: DataFrame, keep: float = KEEP) -> DataFrame:
    """Every document's counts, base rules, posterior and verdict."""
    counted = written(count_documents(docs), "quality-counts")
    failed = base_failed()
    good = posterior(learn(counted))
    return counted.select("*", failed.alias("base_failed"), good.alias("posterior"), (~failed & (good >= keep)).alias("kept"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("doc_id", *COUNTS[:5], "base_failed", "kept", "posterior")
