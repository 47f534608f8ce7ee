"""A quality classifier from weak labels.

Overlapping heuristic labellers vote on each document or abstain. Expectation-maximisation
estimates how often each labeller is right from how they agree, without any true label, and
gives each pattern of votes the chance that its documents are good. These chances train a
linear scorer over hashed word shapes, which then scores every document, also those on which
no labeller votes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.quality_rules import BLANKS, statistics
from lakemart.llm.tables import computed_once, staged

# Votes: 1 good, 0 bad, null no opinion. At most three to the power of their number patterns.
# Each fault has two labellers on different statistics, so that they can agree.
_CALM = "repeat_share < 0.1 AND capital_share < 0.2"
LABELLERS = {
    "symbols": ("symbol_share > 0.08", 0),
    "marked words": ("marked_share > 0.25", 0),
    "shouting": ("shout_share > 0.08", 0),
    "capitals": ("capital_share > 0.3", 0),
    "repeats": ("repeat_share > 0.2", 0),
    "few words": ("distinct_share < 0.2 AND n_words >= 20", 0),
    "plain": (f"symbol_share < 0.02 AND shout_share < 0.02 AND {_CALM}", 1),
    "prose": (f"marked_share < 0.05 AND distinct_share > 0.25 AND {_CALM}", 1),
}

ROUNDS = 100
HASHED = 1 << 12
SAMPLE_ROWS = 20_000  # documents that the linear scorer is fitted on; all else covers all data
KEEP_FROM = 0.5


@dataclass(frozen=True)
class Accuracies:
    """Share of good documents, and how often each labeller's votes are right."""

    good: float
    right: dict[str, float]

    def posterior(self) -> Column:
        """Chance that a document is good, from its votes."""
        logs = F.lit(math.log(self.good / (1 - self.good)))
        for name, right in self.right.items():
            gain = math.log(right / (1 - right))
            vote = F.col(f"vote_{name}")
            logs = logs + F.when(vote == 1, gain).when(vote == 0, -gain).otherwise(0.0)
        return 1 / (1 + F.exp(-logs))


def voted(documents: DataFrame, whole: bool = False) -> DataFrame:
    """Statistics of every row and ``vote_<labeller>`` columns."""
    counted = statistics(documents, whole)
    marked = F.col("n_marked") / F.greatest("n_words", F.lit(1))
    return counted.withColumn("marked_share", marked).withColumns(
        {f"vote_{n}": F.when(F.expr(when), vote) for n, (when, vote) in LABELLERS.items()}
    )


def estimate(votes: DataFrame, rounds: int = ROUNDS) -> Accuracies:
    """Expectation-maximisation over the counts of vote patterns of all documents.

    A labeller is right with the same chance whichever class a document has, and abstains
    without regard to it. The patterns are bounded by the labellers, whatever the number of
    documents. The start holds each labeller right nine times in ten; ten imagined votes of
    that kind smooth every estimate. No labeller counts as worse than a coin.
    """
    names = list(LABELLERS)
    patterns = (
        votes.groupBy(*(f"vote_{n}" for n in names)).agg(F.count("*").alias("n")).collect()
    )
    n = np.array([row["n"] for row in patterns], float)
    said = np.zeros((len(patterns), len(names), 2))  # 1 where the vote is for the class
    for place, row in enumerate(patterns):
        for k, name in enumerate(names):
            if row[f"vote_{name}"] is not None:
                said[place, k, row[f"vote_{name}"]] = 1
    cast = said.sum(2)  # 1 where there is a vote
    right = np.full(len(names), 0.9)
    good = 0.8
    for _ in range(rounds):
        hit, miss = np.log(right), np.log(1 - right)
        logs = np.log([1 - good, good]) + np.einsum(
            "pkc,k->pc", said, hit
        ) + np.einsum("pkc,k->pc", cast[:, :, None] - said, miss)
        logs -= logs.max(1, keepdims=True, initial=-np.inf)
        share = np.exp(logs)
        share /= share.sum(1, keepdims=True)
        weight = share * n[:, None]
        good = float((weight[:, 1].sum() + 8) / (n.sum() + 10))
        agreed = np.einsum("pkc,pc->k", said, weight)
        right = np.clip((agreed + 9) / (n @ cast + 10), 0.5, 0.999)
    return Accuracies(good, dict(zip(names, right.tolist())))


def shapes(rows: DataFrame) -> DataFrame:
    """Replace ``text`` by ``shapes``: each word with letters as ``a`` or ``A``, digits as ``0``.

    Runs count as one, so ordinary words have few shapes. A text's share of distinct words
    is one more. A null text counts as empty.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.split(F.btrim(text, F.lit(BLANKS)), "[\\x20\\x09-\\x0D]+")
    folded = text
    for pattern, letter in ((r"\p{Ll}+", "a"), (r"\p{Lu}+", "A"), (r"\p{Nd}+", "0")):
        folded = F.regexp_replace(folded, pattern, letter)
    forms = F.split(F.btrim(folded, F.lit(BLANKS)), "[\\x20\\x09-\\x0D]+")
    split = rows.withColumn("q_words", words).withColumn("q_forms", forms).drop("text")
    split = computed_once(split, ["q_words", "q_forms"])
    variety = F.floor(10 * F.size(F.array_distinct("q_words")) / F.size("q_words"))
    variety = F.concat(F.lit("variety "), variety.cast("string"))
    return split.withColumn("shapes", F.concat("q_forms", F.array(variety))).drop(
        "q_words", "q_forms"
    )


def hashed(rows: DataFrame, size: int = HASHED) -> DataFrame:
    """Replace ``text`` by ``features``: which hashed shapes it has, apart from how often."""
    counts = HashingTF(inputCol="shapes", outputCol="features", numFeatures=size, binary=True)
    return counts.transform(shapes(rows)).drop("shapes")


def fit(judged: DataFrame, rows: int = SAMPLE_ROWS) -> LogisticRegressionModel | None:
    """The linear scorer, from ``features`` and soft labels of at most ``rows`` documents.

    They are chosen by a hash of the id. A document counts once for each class, weighted by
    its chance. No documents give no scorer.
    """
    chosen = judged.filter("doc_id IS NOT NULL").select("doc_id", "features", "posterior")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "posterior").limit(rows)
    sides = F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("posterior").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("posterior")).alias("weight")),
    )
    soft = staged(chosen.select("features", F.inline(sides)), "soft-labels")
    if soft.isEmpty():
        return None
    return LogisticRegression(weightCol="weight", maxIter=30, regParam=1e-4).fit(soft)


def classify(documents: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """Judge every document: ``doc_id, posterior, score, kept``; one row per input row.

    ``posterior`` is the chance of being good from the votes, ``score`` that of the linear
    scorer; a document is kept if its score is at least ``keep_from``. Where there is no
    scorer, the posterior stands for the score. A null or empty text has the shape of an empty
    word. Repeated rows get the same result each. Rows without an id are scored but never
    fitted on. An empty table gives no rows.
    """
    names = [f"vote_{name}" for name in LABELLERS]
    whole = voted(documents, whole=True)
    rows = whole.select("doc_id", F.col("q_row.text").alias("text"), *names)
    votes = staged(hashed(rows), "votes")  # the only pass over the texts
    known = estimate(votes)
    judged = votes.withColumn("posterior", known.posterior())
    model = fit(judged)
    if model is None:
        scored = judged.withColumn("score", F.col("posterior"))
    else:
        scored = model.transform(judged).withColumn(
            "score", vector_to_array("probability")[1]
        )
    return scored.select(
        "doc_id", "posterior", "score", (F.col("score") >= keep_from).alias("kept")
    )
