"""Personal data: validated formats, and candidates that boosted trees choose from.

Four kinds are found by format and checked by rule. High-recall generators propose further
spans, which may overlap; gradient-boosted trees score them by format and context, and a
threshold per kind, calibrated on held-out candidates, selects. All of it is DataFrame and SQL
functions; the trees are compiled to conditional expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from math import isqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.tables import computed_once, staged

# The formats, with possessive quantifiers and look-behind where these change no match but keep
# the search linear: an email can only start where its run of characters does, or right after
# another match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRETS = "token|secret|passw|pwd|key|auth|credential|login"
_NAME = r"""[A-Za-z0-9_]++["']?[\x20\t]*+(?:=>|:=|[=:])[\x20\t]*+"""


def _value(least: int) -> str:
    """A quoted or unquoted value of at least so many characters."""
    return (
        rf"""(?:"[^"\n]{{{least},}}+"|'[^'\n]{{{least},}}+'|[^\s"'<>]{{{least},}}+)"""
    )


GENERATORS = {
    # any value of a name that tells of a secret, longer ones of any name
    "secret": (
        rf"(?<![A-Za-z0-9_])(?:(?=[A-Za-z0-9_]*(?i:{SECRETS})){_NAME}{_value(1)}"
        rf"|{_NAME}{_value(8)})"
    ),
    "hex": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])",
    "number": r"(?<![0-9A-Za-z.+-])[0-9](?:[ ()./-]{0,2}+[0-9]){6,}+(?![0-9A-Za-z])",
    "masked": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9.-]++",
}
# What a text must hold before a pattern is tried.
NEEDED = {
    "email": "instr(q_text, '@') > 0",
    "phone": "instr(q_text, '+') > 0",
    "secret": "q_text RLIKE '[=:]'",
    "hex": "q_text RLIKE '[0-9A-Fa-f]{32}'",
    "masked": "instr(q_text, 'at') > 0 AND q_text RLIKE '[(\\\\[]at[)\\\\]]'",
}
DIGITS_NEEDED = "q_text RLIKE '[0-9]'"

WORDS = f"{SECRETS}|ssn|iban|account|card|phone|tel|mobile|mail"
NUMBER_WORDS = "ssn|iban|account|card|phone|tel|mobile|fax|call"
DIGESTS = "checksum|digest|md5|sha[0-9_-]|commit|hash|uuid|guid|etag|revision"
CONTEXT = 24

TREES = 10
DEPTH = 3
PRECISION = 0.95
LEVELS = 20
BINS = 512  # more than any feature has values

KINDS = [*BASE, *GENERATORS]
_BLOCK = 64  # matches whose lengths are added up at once

_DIGITS = "translate(c.value, translate(c.value, '0123456789', ''), '')"
_VALID = {
    "email": "true",
    "ip": (
        "forall(split(c.value, '\\\\.'), part -> "
        "part RLIKE '^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})$')"
    ),
    "card": f"length({_DIGITS}) BETWEEN 16 AND 19 AND luhn_check({_DIGITS})",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
}


def _steps(count: str) -> str:
    """A count in steps of 4 %, from 22 on: at most 496 values, so that many rows are equal."""
    return f"floor(16 * log2(1 + {count}))"


FEATURES = [
    _steps("length(c.value)"),
    f"floor(32 * length({_DIGITS}) / length(c.value))",
    _steps("size(array_distinct(split(c.value, '')))"),
    _steps("length(c.value) - length(translate(c.value, ' ().-/', ''))"),
    f"if(lower(c.before) RLIKE '{WORDS}', 1, 0)",
    f"if(lower(c.value) RLIKE '{WORDS}', 1, 0)",
    "if(substring(c.before, -1) IN ('\"', '''') OR instr(c.value, '\"') > 0, 1, 0)",
    f"if(length({_DIGITS}) BETWEEN 12 AND 19 AND luhn_check({_DIGITS}), 1, 0)",
    _steps(f"length({_DIGITS})"),
    _steps("length(regexp_extract(c.value, '[0-9A-Fa-f]{16,}', 0))"),
    *(f"if(c.kind = '{kind}', 1, 0)" for kind in GENERATORS),
]


def _sql(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# What the weak labels go by: name, inner value and context of a proposal, in any case.
_KEY = "lower(regexp_extract(c.value, '^[A-Za-z0-9_]+', 0))"
_INNER = f"regexp_replace(regexp_replace(c.value, {_sql('^' + _NAME)}, ''), {_sql(r"""^["']|["']$""")}, '')"
_NEAR = "concat(lower(c.before), ' ', lower(c.value))"
_MIXED = f"({_INNER} RLIKE '[0-9]' AND {_INNER} RLIKE '[A-Za-z]')"
_SHAPED = (
    f"(({_MIXED} AND length({_INNER}) >= 6 OR length({_INNER}) >= 24) "
    f"AND {_INNER} RLIKE {_sql(r'^[!-~]+$')} AND NOT {_INNER} RLIKE {_sql(r'[(){}\[\]]|^//|@')})"
)
_NAMED = f"{_KEY} RLIKE '{SECRETS}'"
_QUOTED = f"c.value RLIKE {_sql(r"""["']$""")}"
_DATE = _sql(r"^(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}|^[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)[0-9]{2}")
SURE = {
    "secret": (
        f"({_NAMED} AND {_SHAPED} OR {_KEY} RLIKE 'passw|pwd|secret' AND {_QUOTED} "
        f"AND NOT {_INNER} RLIKE {_sql(r'[\s(){}\[\]]')})"
    ),
    "hex": f"lower(c.before) RLIKE '{SECRETS}'",
    "number": f"lower(c.before) RLIKE '{NUMBER_WORDS}' AND length({_DIGITS}) BETWEEN 7 AND 19",
    "masked": "true",
}
SURELY_NOT = {
    "secret": f"NOT {_NEAR} RLIKE '{WORDS}' AND NOT {_SHAPED}",
    "hex": f"lower(c.before) RLIKE '{DIGESTS}'",
    "number": (
        f"NOT lower(c.before) RLIKE '{WORDS}|fax|call' AND (c.value RLIKE {_DATE} "
        f"OR c.value RLIKE {_sql(r'^[0-9]+[.][0-9]+$')} OR length({_DIGITS}) > 15 "
        f"AND NOT (length({_DIGITS}) <= 19 AND luhn_check({_DIGITS})))"
    ),
    "masked": "false",
}
_ANY_SURE = " OR ".join(f"c.kind = '{kind}' AND ({rule})" for kind, rule in SURE.items())
_ANY_NOT = " OR ".join(f"c.kind = '{kind}' AND ({rule})" for kind, rule in SURELY_NOT.items())
FEATURES += [
    f"if({_KEY} RLIKE '{SECRETS}', 1, 0)",
    f"if(lower(c.before) RLIKE '{DIGESTS}', 1, 0)",
    f"if({_SHAPED}, 1, 0)",
    f"if({_INNER} RLIKE {_sql(r'[\s(){}\[\]]')}, 1, 0)",
]


def candidates(documents: DataFrame, column: str = "text") -> DataFrame:
    """Add ``candidates``: spans of all kinds with format, context and features.

    Matches are leftmost and don't overlap within a kind. A span's place is the length of what
    stands between the matches before it and of these matches; lengths are added up in blocks,
    so that a text with very many matches stays cheap. Places count code points.
    """
    rows = documents.withColumn("q_text", F.coalesce(F.col(column), F.lit("")))
    patterns = BASE | GENERATORS
    made = {}
    for kind, pattern in patterns.items():
        needed = NEEDED.get(kind, DIGITS_NEEDED)
        for name, call in (
            ("between", f"split(q_text, {_sql(pattern)}, -1)"),
            ("found", f"regexp_extract_all(q_text, {_sql(pattern)}, 0)"),
        ):
            made[f"q_{name}_{kind}"] = F.expr(f"CASE WHEN {needed} THEN {call} END")
    rows = computed_once(rows.withColumns(made), list(made)).drop("q_text")
    made = {
        f"q_size_{kind}": F.expr(
            f"CASE WHEN size(q_found_{kind}) > 0 THEN transform(q_found_{kind}, (m, i) -> "
            f"cast(length(m) + length(get(q_between_{kind}, i)) AS bigint)) END"
        )
        for kind in patterns
    }
    rows = computed_once(rows.withColumns(made), list(made))
    made = {
        f"q_sums_{kind}": F.expr(
            f"aggregate(transform(sequence(0, (size(q_size_{kind}) - 1) div {_BLOCK}), b -> "
            f"aggregate(slice(q_size_{kind}, cast(b * {_BLOCK} + 1 AS int), {_BLOCK}), 0L, "
            f"(s, x) -> s + x)), array(0L), "
            f"(sums, x) -> concat(sums, array(element_at(sums, -1) + x)))"
        )
        for kind in patterns
    }
    rows = computed_once(rows.withColumns(made), list(made))
    parts = []
    for kind in patterns:
        place = (
            f"get(q_sums_{kind}, cast(i div {_BLOCK} AS int)) + "
            f"aggregate(slice(q_size_{kind}, cast(i div {_BLOCK} * {_BLOCK} + 1 AS int), "
            f"i % {_BLOCK}), 0L, (s, x) -> s + x) + length(get(q_between_{kind}, i))"
        )
        parts.append(
            f"coalesce(transform(q_found_{kind}, (m, i) -> struct('{kind}' AS kind, "
            f"{place} AS start, m AS value, "
            f"right(get(q_between_{kind}, i), {CONTEXT}) AS before)), array())"
        )
    empty = "CAST(array() AS array<struct<kind: string, start: bigint, value: string, before: string>>)"
    rows = computed_once(
        rows.withColumn("candidates", F.expr(f"concat({empty}, {', '.join(parts)})")),
        ["candidates"],
    ).drop(*(f"q_{x}_{k}" for k in patterns for x in ("between", "found", "size", "sums")))
    valid = " ".join(f"WHEN '{kind}' THEN {rule}" for kind, rule in _VALID.items())
    features = ", ".join(f"CAST({f} AS double)" for f in FEATURES)
    described = F.expr(
        "transform(candidates, c -> struct(c.kind AS kind, c.start AS start, "
        "c.start + length(c.value) AS end, c.value AS value, c.before AS before, "
        f"CASE c.kind {valid} ELSE false END AS base, "
        f"CASE WHEN c.kind IN ({', '.join(_sql(k) for k in GENERATORS)}) "
        f"THEN array({features}) END AS f))"
    )
    rows = computed_once(rows.withColumn("candidates", described), ["candidates"])
    # formats that fail their check go; generators propose the like on their own
    kept = F.expr(
        f"filter(candidates, c -> c.base OR c.kind IN ({', '.join(_sql(k) for k in GENERATORS)}))"
    )
    return computed_once(rows.withColumn("candidates", kept), ["candidates"])


@dataclass(frozen=True)
class Model:
    """Compiled trees, and the least score of each kind; kinds without one select nothing."""

    score: str = "0D"
    thresholds: dict[str, float] = field(default_factory=dict)

    def chosen(self) -> str:
        """SQL condition on a candidate ``c``."""
        sides = [f"c.kind = '{k}' AND {self.score} >= {t!r}D" for k, t in self.thresholds.items()]
        return " OR ".join(["c.base", *(f"({side})" for side in sides)])


_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


def compile_tree(lines: list[str]) -> str:
    """Conditional expression of a tree from its description; consumes the lines it reads."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return f"{float(line.split(':')[1])!r}D"
    number, threshold = _SPLIT.fullmatch(line).groups()
    low = compile_tree(lines)
    lines.pop(0)  # Else
    high = compile_tree(lines)
    return f"if(c.f[{number}] <= {float(threshold)!r}D, {low}, {high})"


def labelled(found: DataFrame) -> DataFrame:
    """All proposed candidates that have a weak label.

    A proposal is personal data if it overlaps a validated span or meets the ``SURE`` rule of
    its kind: name and shape of a secret, a number beside a word for one, a masked address. It
    is none if it meets ``SURELY_NOT``. Any other is uncertain and left out, so that the trees
    are not taught to leave it.
    """
    rule = F.expr(f"CASE WHEN {_ANY_SURE} THEN 1D WHEN {_ANY_NOT} THEN 0D END")
    spans = found.select(
        "doc_id", F.xxhash64("candidates").alias("row"), F.explode("candidates").alias("c")
    ).select("doc_id", "row", "c.kind", "c.start", "c.end", "c.base", "c.f", rule.alias("rule"))
    # A proposal overlaps a validated span if, of those that start before its end, the one that
    # reaches farthest reaches beyond its start.
    before = (
        Window.partitionBy("doc_id", "row")
        .orderBy(F.expr("if(base, start, end)"), "base")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    reach = F.max(F.expr("if(base, end, NULL)")).over(before)
    label = F.when(F.col("reach") > F.col("start"), F.lit(1.0)).otherwise(F.col("rule"))
    held_out = F.pmod(F.xxhash64("doc_id", "kind", "start"), F.lit(3)) == 0
    kinds = ", ".join(_sql(k) for k in GENERATORS)
    return (
        spans.withColumn("reach", reach)
        .filter(f"kind IN ({kinds})")
        .select("kind", "f", label.alias("label"), held_out.alias("held_out"))
        .filter("label IS NOT NULL")
    )


def train(found: DataFrame, precision: float = PRECISION) -> Model:
    """Boosted trees on two thirds of the labelled proposals, thresholds on the rest.

    Proposals of equal features and label are counted, and their number is their weight. There
    are as many bins as the trees need to look at each row when they choose where to split.

    A kind gets the lowest of ``LEVELS`` scores from which on at least ``precision`` of its
    held-out proposals are personal data; if there is none, it selects nothing. With one class
    only there is nothing to learn: what is surely personal data is selected.
    """
    alike = labelled(found).groupBy("kind", "f", "label", "held_out")
    sample = staged(alike.agg(F.count("*").alias("n")), "proposals")
    classes = {
        (r.kind, r.label, r.held_out): r["rows"]
        for r in sample.groupBy("kind", "label", "held_out")
        .agg(F.count("*").alias("rows"))
        .collect()
    }
    kinds = {kind for kind, _, _ in classes}
    rows = sum(n for (_, _, held_out), n in classes.items() if not held_out)
    if len({label for _, label, _ in classes}) < 2 or not rows:
        sure = {kind: 0.5 for kind, label, _ in sorted(classes) if label == 1.0}
        return Model(f"if({_ANY_SURE}, 1D, 0D)", sure)
    vectors = sample.withColumn("features", array_to_vector("f"))
    # the trainer draws max(10,000, bins * bins) rows to find splits, or takes all if fewer
    trainer = GBTClassifier(
        maxIter=TREES,
        maxDepth=DEPTH,
        maxBins=max(BINS, isqrt(rows) + 1),
        seed=7,
        stepSize=0.3,
        weightCol="n",
    )
    fitted = trainer.fit(vectors.filter("NOT held_out"))
    sides = []
    for tree, weight in zip(fitted.trees, fitted.treeWeights):
        sides.append(f"{weight!r}D * {compile_tree(tree.toDebugString.splitlines()[1:])}")
    score = f"(1 / (1 + exp(-2 * ({' + '.join(sides)}))))"
    level = F.floor(F.expr(score) * LEVELS)
    counts = (
        sample.filter("held_out")
        .select("kind", "label", "n", F.struct("f").alias("c"))
        .groupBy("kind", level.alias("level"))
        .agg(F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n"))
        .collect()
    )
    thresholds = {}
    for kind in sorted(kinds):
        own = sorted((r for r in counts if r.kind == kind), key=lambda r: -r.level)
        good = n = 0
        for row in own:
            good, n = good + row.good, n + row["n"]
            if good >= precision * n and good:
                thresholds[kind] = row.level / LEVELS
    return Model(score, thresholds)


def select_spans(found: DataFrame, model: Model) -> DataFrame:
    """Replace ``candidates`` by ``spans``: the base ones and the proposals the model selects.

    ``spans`` is an array of (place of the kind, start, end, kind, base), in that order.
    """
    order = " ".join(f"WHEN '{kind}' THEN {n}" for n, kind in enumerate(KINDS))
    spans = (
        f"array_sort(transform(filter(candidates, c -> {model.chosen()}), c -> struct("
        f"CASE c.kind {order} END AS kind_order, c.start AS start, c.end AS end, "
        "c.kind AS kind, c.base AS base)))"
    )
    selected = found.withColumn("spans", F.expr(spans)).drop("candidates")
    return computed_once(selected, ["spans"])


def find(documents: DataFrame) -> DataFrame:
    """``doc_id, spans`` of every row; see :func:`select_spans`.

    A null or empty text has no spans. Repeated rows get the same spans each. An empty table
    gives no rows.
    """
    found = staged(candidates(documents.select("doc_id", "text")).drop("text"), "candidates")
    return select_spans(found, train(found))


def redact(documents: DataFrame) -> DataFrame:
    """All columns of ``documents``, each span of the text replaced by its kind in brackets.

    One replacement covers all spans that overlap; a validated one names it, else the first by
    start, then the longest. Null texts stay null.
    """
    found = staged(candidates(documents.select("doc_id", "text")).drop("text"), "candidates")
    model = train(found)
    names = documents.columns
    if {"candidates", "spans"} & {n.lower() for n in names}:
        raise ValueError("the input already has a column of the redaction")
    selected = select_spans(candidates(documents), model)
    spans = "a: bigint, b: bigint, k: string, base: boolean"
    ordered = (
        "array_sort(transform(spans, s -> struct(s.start AS a, -s.end AS b, s.kind AS k, "
        "s.base AS base)))"
    )
    joined = (
        f"aggregate({ordered}, CAST(array() AS array<struct<{spans}>>), (all, s) -> "
        "if(size(all) > 0 AND element_at(all, -1).b > s.a, "
        "concat(slice(all, 1, size(all) - 1), array(struct(element_at(all, -1).a AS a, "
        "greatest(element_at(all, -1).b, -s.b) AS b, "
        "if(s.base AND NOT element_at(all, -1).base, s.k, element_at(all, -1).k) AS k, "
        "(element_at(all, -1).base OR s.base) AS base))), "
        "concat(all, array(struct(s.a AS a, -s.b AS b, s.k AS k, s.base AS base)))))"
    )
    merged = computed_once(
        selected.withColumn("spans", F.expr(f"CASE WHEN size(spans) > 0 THEN {joined} END")),
        ["spans"],
    )
    pieces = (
        "concat(flatten(transform(spans, (s, i) -> array("
        "substring(text, cast(coalesce(get(spans, i - 1).b, 0) + 1 AS int), "
        "cast(s.a - coalesce(get(spans, i - 1).b, 0) AS int)), "
        "concat('[', upper(s.k), ']')))), "
        "array(substring(text, cast(element_at(spans, -1).b + 1 AS int))))"
    )
    text = F.expr(f"CASE WHEN spans IS NULL THEN text ELSE array_join({pieces}, '') END")
    return merged.select(*(text.alias("text") if n == "text" else F.col(n) for n in names))
