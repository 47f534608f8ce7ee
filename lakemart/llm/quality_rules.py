"""Quality rules: base limits, and a decision list learned from labelled statistics.

Statistics of a text are Spark columns. Sequential covering grows one conjunction of
thresholds after another on two thirds of a labelled sample, prunes it on the rest, and takes
the rows that it covers away. The list is emitted as an ordered conditional expression.
Everything runs as DataFrame and SQL functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.tables import computed_once, staged

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"
DIGITS = "0123456789"

WINDOW = 5

# A bounded sample of labelled rows; all else covers all data.
SAMPLE_ROWS = 20_000
BINS = 16
MOST_RULES = 8
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.9
LEAST_COVER = 3

FEATURES = [
    "symbol_share",
    "shout_share",
    "capital_share",
    "digit_share",
    "mean_word_chars",
    "distinct_share",
    "repeat_share",
    "duplicate_line_share",
    "words_per_line",
]


def _chars_of(column: str, chars: str) -> Column:
    """How many characters of a text are among ``chars``."""
    removed = F.translate(F.col(column), chars, "")
    return (F.length(column) - F.length(removed)).cast("bigint")


def _repeated_words(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words in windows of five that occur twice or more in the text.

    Windows are compared by 64-bit hashes. Only texts with an equal pair sort them by hash and
    place; the union of the found windows is the sum of the gaps between their starts, at most
    five each.
    """
    word = ", ".join(f"get(q_words, i + {k})" for k in range(WINDOW))
    hashes = f"transform(sequence(0, n_words - {WINDOW}), i -> xxhash64({word}))"
    twice = "size(q_hashes) > size(array_distinct(q_hashes))"
    sorted_places = "sort_array(transform(q_hashes, (h, i) -> struct(h AS h, i AS i)))"
    found = (
        "sort_array(transform(filter(q_sorted, (p, j) -> "
        "p.h <=> get(q_sorted, j - 1).h OR p.h <=> get(q_sorted, j + 1).h), p -> p.i))"
    )
    gaps = (
        f"aggregate(transform(q_found, (x, j) -> "
        f"least({WINDOW}, coalesce(x - get(q_found, j - 1), {WINDOW}))), 0L, (s, x) -> s + x)"
    )
    return (
        df.withColumn("q_hashes", F.expr(f"CASE WHEN n_words > {WINDOW} THEN {hashes} END"))
        .withColumn("q_sorted", F.expr(f"CASE WHEN {twice} THEN {sorted_places} END"))
        .withColumn("q_found", F.expr(f"CASE WHEN q_sorted IS NOT NULL THEN {found} END"))
        .withColumn("n_repeat_words", F.expr(f"coalesce({gaps}, 0L)"))
        .drop("q_hashes", "q_sorted", "q_found")
    )


def statistics(documents: DataFrame, whole: bool = False) -> DataFrame:
    """``doc_id``, and counts and shares of each row's whole text.

    ``whole`` adds the row itself as a struct ``q_row``, so that no column of it can clash.
    A null text counts as empty; all its counts and shares are 0.
    """
    row = [F.struct(*documents.columns).alias("q_row")] if whole else []
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("q_text"), *row)
    words = F.split(F.btrim("q_text", F.lit(BLANKS)), "[\\x20\\x09-\\x0D]+")
    lines = F.filter(
        F.split("q_text", "\n"), lambda line: F.translate(line, BLANKS, "") != F.lit("")
    )
    split = rows.withColumn("q_words", words).withColumn("q_lines", lines)
    counted = split.select(
        "doc_id",
        *(["q_row"] if whole else []),
        "q_words",
        F.length(F.translate("q_text", BLANKS, "")).cast("bigint").alias("word_chars"),
        _chars_of("q_text", SYMBOLS).alias("n_symbols"),
        F.size("q_lines").cast("bigint").alias("n_lines"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("bigint").alias(
            "n_dup_lines"
        ),
        _chars_of("q_text", "!").alias("n_shouts"),
        _chars_of("q_text", CAPITALS).alias("n_capitals"),
        _chars_of("q_text", DIGITS).alias("n_digits"),
        F.size(F.regexp_extract_all("q_text", F.lit(f"[{SYMBOLS}]+"), F.lit(0))).alias("n_marked"),
    ).withColumn("n_words", F.when(F.col("word_chars") > 0, F.size("q_words")).otherwise(0))
    counted = counted.withColumn("n_distinct", F.size(F.array_distinct("q_words")))
    repeated = _repeated_words(counted).drop("q_words")

    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.greatest(F.col(whole), F.lit(1))

    shares = repeated.withColumn("n_words", F.col("n_words").cast("bigint")).withColumns(
        {
            "symbol_share": share("n_symbols", "word_chars"),
            "shout_share": share("n_shouts", "word_chars"),
            "capital_share": share("n_capitals", "word_chars"),
            "digit_share": share("n_digits", "word_chars"),
            "mean_word_chars": share("word_chars", "n_words"),
            "distinct_share": share("n_distinct", "n_words"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "duplicate_line_share": share("n_dup_lines", "n_lines"),
            "words_per_line": share("n_words", "n_lines"),
        }
    )
    return computed_once(shares, [c for c in shares.columns if c not in ("doc_id", "q_row")])


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    threshold: float
    above: bool

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in rule), F.lit(True))


def decision(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; null if none does."""
    if not rules:
        return F.lit(None).cast("int")
    first, *rest = enumerate(rules, 1)
    chain = F.when(holds(first[1]), F.lit(first[0]))
    for number, rule in rest:
        chain = chain.when(holds(rule), F.lit(number))
    return chain


def _cuts(sample: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """Thresholds of each feature: quantiles of all rows and of the bad ones."""
    shares = F.array(*(F.lit(i / bins) for i in range(1, bins)))
    found: dict[str, set[float]] = {f: set() for f in features}
    for rows in (sample, sample.filter("bad = 1")):
        row = rows.agg(
            *(F.percentile_approx(f, shares, F.lit(10_000)).alias(f) for f in features)
        ).first()
        for f in features:
            found[f].update(row[f] or [])
    return {f: sorted(values) for f, values in found.items()}


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many of the thresholds a value reaches."""
    reached = (F.when(F.col(feature) >= c, 1).otherwise(0) for c in cuts)
    return reduce(lambda a, b: a + b, reached, F.lit(0))


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[Condition, tuple[int, int]]:
    """Bad and good rows under each condition, from one histogram of all features."""
    pairs = F.explode(
        F.array(
            *(
                F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin"))
                for f in cuts
            )
        )
    )
    found = (
        rows.select("bad", pairs.alias("p"))
        .groupBy("p.feature", "p.bin")
        .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
        .collect()  # features times bins
    )
    out = {}
    for feature, thresholds in cuts.items():
        own = [r for r in found if r.feature == feature]
        for place, threshold in enumerate(thresholds):
            for above in (True, False):
                side = [r for r in own if (r.bin > place) == above]
                condition = Condition(feature, threshold, above)
                out[condition] = sum(r.bad for r in side), sum(r.good for r in side)
    return out


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """FOIL's information gain of a further condition."""
    if not after[0]:
        return -math.inf
    return after[0] * (math.log2(after[0] / sum(after)) - math.log2(before[0] / sum(before)))


def _grow(rows: DataFrame, cuts: dict[str, list[float]], most: int) -> Rule:
    rule: Rule = ()
    while len(rule) < most:
        counts = _counts(rows.filter(holds(rule)), cuts)
        if not counts:
            break
        sides = next(iter(cuts))
        whole = [n for c, n in counts.items() if c.feature == sides][:2]
        before = tuple(sum(x) for x in zip(*whole))
        if len(before) < 2 or not before[0] or not before[1]:
            break
        best = max(counts, key=lambda c: (_gain(before, counts[c]), c.feature, c.threshold))
        if _gain(before, counts[best]) <= 0:
            break
        rule = (*rule, best)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The prefix that tells best on rows it was not grown on, and what that covers."""
    columns = []
    for n in range(1, len(rule) + 1):
        inside = holds(rule[:n])
        columns.append(F.sum(F.when(inside, F.col("bad")).otherwise(0)).alias(f"bad{n}"))
        columns.append(F.sum(F.when(inside, 1 - F.col("bad")).otherwise(0)).alias(f"good{n}"))
    row = rows.agg(*columns).first()
    scored = []
    for n in range(1, len(rule) + 1):
        bad, good = row[f"bad{n}"] or 0, row[f"good{n}"] or 0
        scored.append(((bad - good) / (bad + good) if bad + good else -1.0, bad, -n, good))
    _, bad, short, good = max(scored)
    return rule[:-short], bad, good


def learn(
    labelled: DataFrame,
    features: list[str] = FEATURES,
    most_rules: int = MOST_RULES,
    most_conditions: int = MOST_CONDITIONS,
    least_precision: float = LEAST_PRECISION,
    least_cover: int = LEAST_COVER,
    bins: int = BINS,
) -> list[Rule]:
    """An ordered list of rules for bad rows, from ``doc_id, bad`` (0 or 1) and features.

    Stops when a rule, pruned, covers too few bad rows or too many good ones among those it
    was not grown on. No rows, or one class only, give no rules. The sample is bounded, so its
    rows are read again for each step.
    """
    labelled = staged(labelled, "labelled")
    cuts = _cuts(labelled, features, bins)
    cuts = {f: c for f, c in cuts.items() if c}
    if not cuts:
        return []
    binned = labelled.withColumns({f"bin_{f}": _bin(f, c) for f, c in cuts.items()})
    part = F.pmod(F.xxhash64("doc_id", F.lit("grow")), F.lit(3))
    binned = staged(binned.withColumn("held_out", part == 0), "labelled").persist()
    rules: list[Rule] = []
    try:
        while len(rules) < most_rules:
            left = binned.filter(decision(rules).isNull())
            rule = _grow(left.filter("NOT held_out"), cuts, most_conditions)
            if not rule:
                break
            rule, bad, good = _prune(left.filter("held_out"), rule)
            if bad < least_cover or bad < least_precision * (bad + good):
                break
            rules.append(rule)
    finally:
        binned.unpersist()
    return rules


def labelled_statistics(
    documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Statistics and ``bad`` of at most ``rows`` labelled documents that pass the base limits.

    The sample is chosen by a hash of the id. It is bounded, so it is broadcast. Labels that
    are null, or that contradict each other for one document, are left out.
    """
    sure = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .filter("low = high")
    )
    chosen = (
        sure.select("doc_id", (F.col("low") == 0).cast("int").alias("bad"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")
    return statistics(texts).filter(~base_failed()).join(F.broadcast(chosen), "doc_id")


def judge(documents: DataFrame, rules: list[Rule], whole: bool = False) -> DataFrame:
    """Statistics of every document, ``base_failed``, the ``rule`` that rejects it, ``kept``."""
    return (
        statistics(documents, whole)
        .withColumn("base_failed", base_failed())
        .withColumn("rule", decision(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Judge all documents by the base limits and by rules learned from their labels.

    One row per input row. A null or empty text has no words and fails the base. Without
    labels only the base decides. An empty table gives no rows.
    """
    return judge(documents, learn(labelled_statistics(documents, labels)))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are kept, with all their columns."""
    rules = learn(labelled_statistics(documents, labels))
    return judge(documents, rules, whole=True).filter("kept").select("q_row.*")
