"""Benchmark passages in training texts, found through a positional inverted index.

The index holds one posting for each word of each document: a hash of the word, a key of the
document and the position, written in files that are each ordered by word. Phrases are looked
up by their rarest words first: the postings of a word, less its offset in the phrase, are the
places where the phrase may begin, and a place must be in the lists of the two rarest words of
some window. Only documents that still have such places give the postings of all their words,
which settle every window exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.tables import Scratch

SIZE = 10
LISTS = 2  # lists intersected before all words of a document are looked at

_BREAKS = "".join(
    chr(c) for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122)
)
_UPPER = "".join(map(chr, range(65, 91)))


def word_list(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; none for null."""
    plain = F.translate(
        F.coalesce(text, F.lit("")), _UPPER + _BREAKS, _UPPER.lower() + " " * len(_BREAKS)
    )
    return F.array_remove(F.split(plain, " "), "")


def build_index(documents: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Postings of whole texts: ``term, doc, pos, doc_id``, by term within each partition.

    ``doc`` is a hash of id and text, so rows that share an id are told apart and equal rows
    share their postings. One more posting for each row has no term: its ``pos`` is the number
    of words, and it alone holds ``doc_id``, which may be null.
    """
    words = F.concat(word_list(F.col("text")), F.array(F.lit(None).cast("string")))
    id_ = F.col(id_column).cast("bigint")
    rows = documents.select(
        id_.alias("id"), F.xxhash64(id_, F.col("text")).alias("doc"), words.alias("words")
    )
    posted = rows.select("id", "doc", F.posexplode("words").alias("pos", "word"))
    return posted.select(
        F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"),
        "doc",
        "pos",
        F.when(F.col("word").isNull(), F.col("id")).alias("doc_id"),
    ).sortWithinPartitions("term")


def _phrases(items: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Distinct word sequences as ``seq, p, term, m``, and ``item_id, seq`` of the items."""
    listed = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        word_list(F.col("text")).alias("words"),
    ).filter(F.size("words") > 0)
    distinct = listed.select("words").distinct()
    numbered = distinct.withColumn("seq", F.monotonically_increasing_id())
    numbered = scratch.staged(numbered, "sequences")  # fixes the numbers
    placed = numbered.select("seq", F.size("words").alias("m"), F.posexplode("words"))
    terms = placed.select("seq", F.col("pos").alias("p"), F.xxhash64("col").alias("term"), "m")
    held = listed.join(numbered, "words").select("item_id", "seq").distinct()
    return scratch.staged(terms, "terms"), scratch.kept(held, "items")


def term_counts(index: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n``: postings of each of ``terms`` that occurs."""
    wanted = terms.select("term").distinct()
    return index.select("term").join(wanted, "term").groupBy("term").agg(F.count("*").alias("n"))


def _rarest(terms: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """The ``LISTS`` rarest words of each window that has no word without postings.

    Output: ``seq, chosen`` (structs ``n, p, term``, rarest first), one row for each window of
    ``size`` words, or for the whole of a shorter sequence.
    """
    counted = terms.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ahead = Window.partitionBy("seq").orderBy("p").rowsBetween(0, size - 1)
    held = F.array_sort(F.collect_list(F.struct("n", "p", "term")).over(ahead))
    return (
        counted.withColumn("held", held)
        .filter(F.col("p") <= F.greatest(F.col("m") - size, F.lit(0)))
        .filter(F.get("held", F.lit(0))["n"] > 0)
        .select("seq", F.slice("held", 1, LISTS).alias("chosen"))
    )


def candidates(index: DataFrame, windows: DataFrame, scratch: Scratch) -> DataFrame:
    """Places ``seq, doc, start`` at which the chosen words of some window all occur.

    ``start`` is where the sequence would begin, which may lie before the text.
    """
    chosen = windows.select("seq", F.explode("chosen").alias("c"))
    lists = scratch.staged(chosen.select("seq", "c.p", "c.term").distinct(), "lists")
    sets = windows.select("seq", F.col("chosen.p").alias("ps"))
    sets = scratch.staged(sets.groupBy("seq").agg(F.collect_set("ps").alias("sets")), "sets")
    adjusted = (
        index.select("term", "doc", "pos")
        .join(lists, "term")
        .select("seq", "doc", (F.col("pos") - F.col("p")).alias("start"), "p")
    )
    # each word of a sequence adds at most one row to a place
    met = adjusted.groupBy("seq", "doc", "start").agg(F.collect_set("p").alias("ps"))
    both = F.exists("sets", lambda s: F.size(F.array_except(s, F.col("ps"))) == 0)
    return met.join(sets, "seq").filter(both).select("seq", "doc", "start")


def exact_matches(
    index: DataFrame, terms: DataFrame, scratch: Scratch, size: int = SIZE
) -> DataFrame:
    """Stretches ``doc, seq, begin, end`` of words that equal at least one whole window.

    ``terms``: ``seq, p, term, m``. Stretches of one sequence at one place are as long as
    possible; those of other places and sequences may overlap them.
    """
    counts = scratch.staged(term_counts(index, terms), "counts")
    windows = scratch.staged(_rarest(terms, counts, size), "windows")
    places = scratch.staged(candidates(index, windows, scratch), "places")
    documents = scratch.staged(places.select("doc").distinct(), "documents")
    held = index.filter("term IS NOT NULL").select("doc", "pos", "term")
    held = held.join(documents, "doc", "left_semi").distinct()
    wanted = places.join(terms, "seq").select(
        "seq", "doc", "start", "p", "term", "m", (F.col("start") + F.col("p")).alias("pos")
    )
    equal = held.join(wanted, ["doc", "pos", "term"])
    order = Window.partitionBy("doc", "seq", "start").orderBy("p")
    island = F.col("p") - F.row_number().over(order)
    return (
        equal.withColumn("island", island)
        .groupBy("doc", "seq", "start", "island")
        .agg(F.min("pos").alias("begin"), F.count("*").alias("n"), F.first("m").alias("m"))
        .filter(F.col("n") >= F.least("m", F.lit(size)))
        .select("doc", "seq", "begin", (F.col("begin") + F.col("n")).alias("end"))
    )


def proximity_matches(
    index: DataFrame, terms: DataFrame, scratch: Scratch, within: int
) -> DataFrame:
    """Places ``doc, seq, pos`` of a sequence's rarest word that has all others at hand.

    Each distinct word of the sequence occurs at most ``within`` words before or after ``pos``,
    in any order. Documents without the rarest word give no other postings.
    """
    counts = scratch.staged(term_counts(index, terms), "counts")
    distinct = terms.groupBy("seq", "term").agg(F.min("p").alias("p"))
    ranked = distinct.join(counts, "term", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = ranked.groupBy("seq").agg(
        F.min(F.struct("n", "p", "term")).alias("rare"), F.count("*").alias("words")
    )
    rarest = rarest.filter("rare.n > 0").select("seq", F.col("rare.term").alias("term"), "words")
    rarest = scratch.staged(rarest, "rarest")
    posted = index.filter("term IS NOT NULL").select("term", "doc", "pos").distinct()
    anchors = scratch.staged(posted.join(rarest, "term"), "anchors")
    others = distinct.join(rarest.select("seq", F.col("term").alias("rare")), "seq")
    others = scratch.staged(others.filter("term <> rare").select("seq", "term"), "others")
    cell = within + 1
    documents = scratch.staged(anchors.select("doc").distinct(), "documents")
    beside = posted.join(documents, "doc", "left_semi").join(others, "term")
    beside = beside.select(
        "seq", "doc", F.col("pos").alias("other_pos"), "term", F.expr(f"pos div {cell}").alias("cell")
    )
    around = F.explode(F.sequence(F.expr(f"pos div {cell} - 1"), F.expr(f"pos div {cell} + 1")))
    asked = anchors.select("seq", "doc", "pos", "words", around.alias("cell"))
    near = F.abs(F.col("pos") - F.col("other_pos")) <= within
    met = asked.join(beside, ["seq", "doc", "cell"]).filter(near)
    full = (
        met.select("seq", "doc", "pos", "words", "term")
        .distinct()
        .groupBy("seq", "doc", "pos", "words")
        .count()
        .filter("count = words - 1")
    )
    alone = anchors.filter("words = 1")
    return full.select("doc", "seq", "pos").unionByName(alone.select("doc", "seq", "pos"))


def _covered(matches: DataFrame) -> DataFrame:
    """``doc, n_hit``: words that lie in any of the stretches."""
    order = Window.partitionBy("doc").orderBy("begin", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(
        F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(reached, F.col("begin")))
    )
    stretches = matches.select("doc", "begin", "end").distinct()
    counted = stretches.withColumn("fresh", fresh)
    return counted.groupBy("doc").agg(F.sum("fresh").cast("bigint").alias("n_hit"))


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """Words of each document that lie in a window of ``size`` words of a benchmark item.

    Input: ``doc_id, text`` and ``item_id, text``; other columns are dropped. An item with
    fewer words is one window, an item without any has none. Output for each row of
    ``documents``: ``doc_id, n_words, n_hit, n_items`` (distinct ids of items with a window
    that occurs), ``items_sha256`` (of these ids, sorted as strings, comma-joined),
    ``contaminated``. Null and empty texts have no words; a null item id counts as an empty
    one. Repeated rows are repeated, rows that share an id are judged by their own text.
    """
    scratch = Scratch(documents.sparkSession, "phrases")
    index = scratch.kept(build_index(documents), "index")
    terms, items = _phrases(benchmark, scratch)
    matches = scratch.kept(exact_matches(index, terms, scratch, size), "matches")
    scratch.close()
    found = matches.select("doc", "seq").distinct().join(items, "seq")
    named = found.groupBy("doc").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    named = named.select(
        "doc",
        F.size("items").cast("bigint").alias("n_items"),
        F.array_join("items", ",").alias("items"),
    )
    rows = index.filter("term IS NULL").select("doc_id", "doc", F.col("pos").cast("bigint"))
    joined = rows.join(_covered(matches).join(named, "doc"), "doc", "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return joined.select(
        "doc_id",
        F.col("pos").alias("n_words"),
        hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
