"""Text expressions over query logs and other text columns.

All of them are built-in string functions, so they stay inside generated code and need
neither a shuffle nor Python workers.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks of an aggregated SQL text.
AGGREGATE_MARKS = ["group by", "sum(", "count(", "avg(", "max(", "min(", "having"]

# Word stems of a ranking question.
RANKING_STEMS = [
    "топ",
    "top",
    "лучш",
    "наиболее",
    "самы",
    "больше всего",
    "максимальн",
    "наибольш",
]

# Word stems of a distribution question.
DISTRIBUTION_STEMS = ["распределени", "доля", "процент", "соотношени", "структура", "состав"]

# The shipped synonyms of the canonical terms.
SYNONYMS = {
    "count": ["количество", "число", "сколько"],
    "total": ["общий", "всего", "суммарный"],
    "average": ["средний", "среднее", "в среднем"],
}

# Message prefix per kind of query error.
QUERY_ERROR_PREFIX = {
    "syntax": "SQL syntax error: ",
    "operational": "Database operational error: ",
    "database": "Database error: ",
    "unexpected": "Unexpected error during query execution: ",
}

# The text around the query and the error in a repair request.
REPAIR_PARTS = [
    "SQL Query Error:\n\nQuery:\n",
    "\n\nError:\n",
    "\n\nPlease fix the SQL query to resolve this error.",
]


def contains_any(text: Column, phrases: Iterable[str]) -> Column:
    """Case-insensitive test for any of the phrases; null text contains nothing."""
    lowered = F.lower(text)
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(lowered, F.lit(phrase))
    return F.coalesce(found, F.lit(False))


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends (SQL ``trim`` removes blanks only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_aggregated(sql: Column, marks: Iterable[str] = AGGREGATE_MARKS) -> Column:
    return contains_any(sql, marks)


def is_top_n(
    question: Column,
    sql: Column,
    stems: Iterable[str] = RANKING_STEMS,
    limits: Iterable[str] = ("limit",),
    orders: Iterable[str] = ("order by",),
) -> Column:
    return (contains_any(question, stems) | contains_any(sql, limits)) & contains_any(sql, orders)


def is_distribution(question: Column, stems: Iterable[str] = DISTRIBUTION_STEMS) -> Column:
    return contains_any(question, stems)


def synonym_tags(text: Column, synonyms: Mapping[str, list[str]] | None = None) -> Column:
    """Sorted canonical terms whose phrases occur in the text.

    The map is a small catalogue, so it becomes an expression per row: no join and no
    regrouping of the texts. Dropping the nulls with ``array_except`` rather than a
    lambda keeps it in generated code, where the text is lowered once for all phrases.
    """
    terms = synonyms or SYNONYMS
    hits = [F.when(contains_any(text, terms[term]), F.lit(term)) for term in sorted(terms)]
    return F.array_except(F.array(*hits), F.array(F.lit(None).cast("string")))


def fenced_sql(response: Column, fence: str = "```", tag: str = "sql") -> Column:
    """The SQL inside a model answer.

    In an answer with code fences the first part that starts with the tag counts, without
    as many characters as it has; failing that the part after the first fence. Any other
    answer is returned whole.
    """
    whole = strip(response)
    parts = F.split(whole, fence, -1)
    tagged = F.get(
        F.filter(parts, lambda part: F.startswith(F.lower(strip(part)), F.lit(tag))), F.lit(0)
    )
    return F.when(
        F.contains(whole, F.lit(fence)),
        F.coalesce(strip(F.substr(tagged, F.lit(len(tag) + 1))), strip(F.get(parts, F.lit(1)))),
    ).otherwise(whole)


def step_query(tool_input: Column, path: str = "$.query") -> Column:
    """The query of a tool call given as ``{"query": ...}`` or as plain text."""
    as_object = F.coalesce(F.get_json_object(tool_input, path), F.lit(""))
    return F.when(F.startswith(tool_input, F.lit("{")), as_object).otherwise(tool_input)


def before_hint(message: Column, mark: str = "HINT:") -> Column:
    return F.substring_index(message, mark, 1)


def repair_request(query: Column, message: Column, mark: str = "HINT:") -> Column:
    """The text sent back with a failed query, without the hint part of the error."""
    head, middle, tail = (F.lit(part) for part in REPAIR_PARTS)
    return strip(F.concat(head, query, middle, before_hint(message, mark), tail))


def query_error(kind: Column, message: Column) -> Column:
    """The error text reported for a kind of failure; unknown kinds are unexpected ones."""
    prefix = F.lit(QUERY_ERROR_PREFIX["unexpected"])
    for name in ("database", "operational", "syntax"):
        prefix = F.when(kind == name, F.lit(QUERY_ERROR_PREFIX[name])).otherwise(prefix)
    return F.concat(prefix, message)


def error_kind(
    message: Column,
    limits: Iterable[str] = ("rate limit",),
    prefixes: Mapping[str, str] = QUERY_ERROR_PREFIX,
) -> Column:
    """``rate_limit``, one of the query error kinds, or ``general``."""
    kind = F.when(contains_any(message, limits), F.lit("rate_limit"))
    for name, prefix in prefixes.items():
        kind = kind.when(F.startswith(message, F.lit(prefix)), F.lit(name))
    return kind.otherwise(F.lit("general"))


def matches_expected(answer: Column, expected: Column) -> Column:
    return F.coalesce(F.contains(F.lower(answer), F.lower(expected)), F.lit(False))


def title(question: Column, default: str | Column) -> Column:
    """A short question as a sentence, a long one cut to 77 characters, else the default."""
    fallback = F.lit(default) if isinstance(default, str) else default
    length = F.length(question)
    sentence = F.concat(
        F.upper(F.substring(question, 1, 1)), F.lower(F.substr(question, F.lit(2)))
    )
    return (
        F.when(length.between(1, 79), sentence)
        .when(length >= 80, F.concat(F.substring(question, 1, 77), F.lit("...")))
        .otherwise(fallback)
    )
