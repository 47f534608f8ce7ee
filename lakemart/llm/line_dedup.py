"""Line dedup by winnowing over line hashes.

Lines with a word are hashed. Of the lines of every least run (``RUN`` consecutive ones, or
fewer that hold ``least_chars`` characters) the smallest hash is a fingerprint, so two such runs
cannot agree without sharing one. Neighbouring runs mostly share their smallest line, and only
the distinct ones are posted, with their position and the hashes around it: about half of the
lines for runs of three. Positions that meet are extended both ways to the least runs around
them, whose hashes must all agree; overlapping ones make up longer matches. Everything is
DataFrame and SQL functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.quality_rules import BLANKS
from lakemart.llm.tables import Scratch, computed_once

RUN = 3
SALTS = 16  # parts of the rows of one fingerprint
LEAST_CHARS = 20  # characters other than blanks from which on fewer lines are a run


def _place(*more: str) -> Column:
    """Order of places: by id, a null id last, then by text and line."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", *more)


def line_hashes(documents: DataFrame) -> DataFrame:
    """``doc_id, text_hash, hashes, chars`` (of lines with a word) of each distinct row.

    ``chars`` counts the characters of a line other than blanks.
    """
    sized = F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n"),
        lambda line: F.struct(
            F.xxhash64(line).alias("hash"),
            F.length(F.translate(line, BLANKS, "")).alias("chars"),
        ),
    )
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.filter(sized, lambda line: line["chars"] > 0).alias("lines"),
    )
    return (
        computed_once(rows, ["lines"])
        .select(
            "doc_id",
            "text_hash",
            F.col("lines.hash").alias("hashes"),
            F.col("lines.chars").alias("chars"),
        )
        .dropDuplicates(["doc_id", "text_hash"])
    )


def _least_runs(lines: int, run: int, least_chars: int | None) -> str:
    """First lines of the least runs of ``lines`` lines, in order, as an array.

    A run is a least one if it loses its first or its last line and is then none any more. Each
    line of a repeated run is in a least run within it, which begins or ends there or covers it
    from the run's begin.
    """
    places = f"sequence(0, size(hashes) - {lines})"
    if least_chars is not None:

        def chars(low: int, high: int) -> str:
            return " + ".join(f"get(chars, i + {k})" for k in range(low, high)) or "0"

        tests = []
        if lines < run:
            tests.append(f"{chars(0, lines)} >= {least_chars}")
        if lines > 1:
            shorter = f"least({chars(0, lines - 1)}, {chars(1, lines)})"
            tests.append(f"{shorter} < {least_chars}")
        if tests:
            places = f"filter({places}, i -> {' AND '.join(tests)})"
    none = "CAST(array() AS array<int>)"
    return f"CASE WHEN size(hashes) >= {lines} THEN {places} ELSE {none} END"


def _posted(hashed: DataFrame, lines: int, run: int, least_chars: int | None) -> DataFrame:
    """Distinct fingerprints of the least runs of ``lines`` lines, with the runs they stand for.

    Output: ``doc_id, text_hash, lines, mark``, ``starts`` (first lines of the runs), ``low``
    and ``around`` (hashes of all their lines from line ``low`` on).
    """
    own = [f"get(hashes, i + {k})" for k in range(lines)]
    least = f"least({', '.join(own)})" if lines > 1 else own[0]
    # the first of the smallest lines of a run; it never moves back from one run to the next
    at = "CASE " + " ".join(f"WHEN {h} = {least} THEN i + {k}" for k, h in enumerate(own)) + " END"
    rows = hashed.filter(F.size("hashes") >= lines)
    rows = rows.withColumn("runs", F.expr(_least_runs(lines, run, least_chars)))
    rows = computed_once(rows, ["runs"]).filter(F.size("runs") > 0)
    rows = rows.withColumn("at", F.expr(f"transform(runs, i -> CAST({at} AS int))"))
    # numbers of the runs that begin a fingerprint of their own
    fresh = F.expr(
        "filter(sequence(0, size(at) - 1), j -> j = 0 OR get(at, j) <> get(at, j - 1))"
    )
    rows = computed_once(rows, ["runs", "at"]).withColumn("fresh", fresh)
    made = (
        "transform(fresh, (j, n) -> struct(get(hashes, get(at, j)) AS mark, "
        "slice(runs, j + 1, coalesce(get(fresh, n + 1), size(at)) - j) AS starts))"
    )
    posted = computed_once(rows, ["runs", "at", "fresh"]).select(
        "doc_id", "text_hash", "hashes", F.inline(F.expr(made))
    )
    last = F.element_at("starts", -1) + lines
    return posted.select(
        "doc_id",
        "text_hash",
        F.lit(lines).alias("lines"),
        "mark",
        "starts",
        F.get("starts", F.lit(0)).alias("low"),
        F.slice("hashes", F.get("starts", F.lit(0)) + 1, last - F.get("starts", F.lit(0))).alias(
            "around"
        ),
    )


def _extended(met: DataFrame, sizes: list[int]) -> DataFrame:
    """Least runs around positions that met, with two hashes of the lines of each."""
    first_key = second_key = F.lit(None).cast("bigint")
    for lines in sizes:
        own = [f"get(around, line - low + {k})" for k in range(lines)]
        is_own = F.col("lines") == lines
        first = F.expr(f"xxhash64({', '.join(own)})")
        second = F.expr(f"xxhash64('run', {', '.join(reversed(own))})")
        first_key = F.when(is_own, first).otherwise(first_key)
        second_key = F.when(is_own, second).otherwise(second_key)
    runs = met.select(
        "doc_id", "text_hash", "lines", "low", "around", F.explode("starts").alias("line")
    )
    return runs.select(
        "doc_id",
        "text_hash",
        "line",
        "lines",
        first_key.alias("first_key"),
        second_key.alias("second_key"),
    )


def candidate_runs(
    hashed: DataFrame, run: int = RUN, least_chars: int | None = None
) -> DataFrame:
    """Least runs whose fingerprint is posted twice: their place, lines and two hashes.

    Fingerprints are counted in each task before they are shuffled; a frequent one is dealt to
    ``SALTS`` tasks where its positions meet.
    """
    sizes = [run] if least_chars is None else [*range(1, run + 1)]
    posted = reduce(DataFrame.unionAll, (_posted(hashed, n, run, least_chars) for n in sizes))
    often = posted.groupBy("lines", "mark").agg(F.count("*").alias("n")).filter("n > 1")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = often.select("lines", "mark", salts.alias("salt"))
    salt = F.pmod(F.xxhash64("doc_id", "text_hash", "low"), F.lit(SALTS)).cast("int")
    met = posted.withColumn("salt", salt).join(dealt, ["lines", "mark", "salt"], "left_semi")
    return _extended(met, sizes)


def later_runs(runs: DataFrame) -> DataFrame:
    """Maximal repeated runs after their first place, from least runs.

    Output: ``doc_id, text_hash, line, lines`` (lines with a word, from 0) and the first place
    ``source_id, source_line`` that they repeat.
    """
    keys = ["lines", "first_key", "second_key"]
    first = (
        runs.groupBy(*keys)
        .agg(F.min(_place("line")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    later = runs.join(first, keys).filter(_place("line") > F.col("first"))
    # windows of one extended match touch or overlap here and there
    shift = F.col("line") - F.col("first.line")
    source = ["first.no_id", "first.doc_id", "first.text_hash"]
    match = Window.partitionBy("doc_id", "text_hash", *source, shift).orderBy("line", "lines")
    before = match.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(F.col("line") + F.col("lines")).over(before)
    opens = F.when(F.col("line") <= reached, 0).otherwise(1)
    islands = later.withColumn("opens", opens).withColumn(
        "island", F.sum("opens").over(match.rowsBetween(Window.unboundedPreceding, 0))
    )
    return islands.groupBy(
        "doc_id",
        "text_hash",
        F.col("first.no_id").alias("no_id"),
        F.col("first.doc_id").alias("source_id"),
        F.col("first.text_hash").alias("source_hash"),
        shift.alias("shift"),
        "island",
    ).agg(
        F.min("line").cast("bigint").alias("line"),
        (F.max(F.col("line") + F.col("lines")) - F.min("line")).cast("bigint").alias("lines"),
        F.min("first.line").cast("bigint").alias("source_line"),
    ).select("doc_id", "text_hash", "line", "lines", "source_id", "source_line")


def remove_lines(documents: DataFrame, runs: DataFrame) -> DataFrame:
    """All columns of ``documents`` with runs of lines taken out of the text.

    Adds ``n_lines`` (lines with a word) and ``n_removed``. Lines without a word stay.
    """
    gone = runs.groupBy("doc_id", "text_hash").agg(
        F.array_distinct(
            F.flatten(
                F.collect_list(F.sequence(F.col("line"), F.col("line") + F.col("lines") - 1))
            )
        ).alias("gone")
    )
    rows = documents.withColumn("text_hash", F.xxhash64("text"))
    same = rows["doc_id"].cast("bigint").eqNullSafe(gone["doc_id"]) & (
        rows["text_hash"] == gone["text_hash"]
    )
    # merged at every size: a broadcast below some size would only hide what the join costs
    kept = rows.join(gone.hint("merge"), same, "left").select(
        *(rows[c] for c in documents.columns), F.sort_array("gone").alias("gone")
    )
    all_lines = F.split(F.coalesce("text", F.lit("")), "\n")
    has_word = F.transform(
        all_lines, lambda line: (F.translate(line, BLANKS, "") != F.lit("")).cast("int")
    )
    kept = computed_once(
        kept.withColumn("all_lines", all_lines).withColumn("has_word", has_word),
        ["all_lines", "has_word"],
    )
    # marks of lines with a word: 1 where removed; they are put back in order with blank lines
    numbered = F.expr(
        "filter(transform(has_word, (w, i) -> if(w = 1, i, -1)), i -> i >= 0)"
    )
    kept = computed_once(
        kept.withColumn("numbered", numbered), ["all_lines", "gone", "numbered"]
    )
    removed = F.expr("transform(gone, g -> cast(get(numbered, cast(g AS int)) AS int))")
    kept = computed_once(kept.withColumn("removed", removed), ["all_lines", "numbered", "removed"])
    # a removed line is cut out by keeping what lies between two removed ones
    between = F.expr(
        "flatten(transform(sequence(0, size(removed)), k -> slice(all_lines, "
        "coalesce(get(removed, k - 1), -1) + 2, "
        "greatest(coalesce(get(removed, k), size(all_lines)) "
        "- coalesce(get(removed, k - 1), -1) - 1, 0))))"
    )
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(
        F.array_join(between, "\n")
    )
    return kept.select(
        *(text.alias("text") if c == "text" else F.col(c) for c in documents.columns),
        F.size("numbered").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
    )


def remove_repeated_lines(
    documents: DataFrame, run: int = RUN, least_chars: int | None = None
) -> DataFrame:
    """Delete runs of ``run`` or more lines that stand at an earlier place as well.

    With ``least_chars``, fewer lines are a run too if together they hold as many characters
    other than blanks: one long line is, and only very short ones need neighbours.

    Places are ordered by ``doc_id`` (null last), then by line; a document can repeat itself.
    Lines are compared whole; lines without a word don't count and stay. All runs are judged
    on the input: a run repeats the first place it has anywhere. Output: one row per input row
    with all its columns, the text without the deleted lines, ``n_lines`` (with a word) and
    ``n_removed``.

    A null text stays null and has no lines. Repeated rows (same id and text) are one place, so
    they don't delete each other. A document can lose all its lines and then has an empty
    text. Columns named ``n_lines, n_removed`` or like working columns raise ValueError. An
    empty table gives no rows.
    """
    working = {"n_lines", "n_removed", "text_hash", "gone", "all_lines", "has_word"}
    working |= {"numbered", "removed"}
    clash = working & {c.lower() for c in documents.columns}
    if clash:
        raise ValueError(f"the input already has columns {sorted(clash)}")
    scratch = Scratch(documents.sparkSession, "lines")
    hashed = scratch.staged(line_hashes(documents), "hashes")
    runs = scratch.kept(later_runs(candidate_runs(hashed, run, least_chars)), "runs")
    scratch.close()
    return remove_lines(documents, runs)
