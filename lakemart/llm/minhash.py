"""Near duplicates by MinHash: an inverted join over signature coordinates.

1. Each document's set of word shingles gives a signature of ``COORDINATES`` minima. Equal sets
   form a class, and one document stands for it.
2. Each class is posted under each coordinate and its value. Values of one class alone match
   nothing and go; a class with fewer than ``MATCHES`` shared values goes with them.
3. Two signatures with ``MATCHES`` equal coordinates have one in common among the rarest
   ``n - MATCHES + 1`` values of either, so only this prefix is merged.
4. Merging skips what is known: each class is first linked to the best of its lists' smallest
   members. After these links are confirmed and joined to components, only members of unlike
   components still meet, block by block, until a link joins them. All links are confirmed on
   the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.components import components
from lakemart.llm.tables import Scratch
from lakemart.llm.words import Words, mix, phrase_hashes, slices, text_array

SHINGLE_WORDS = 5
COORDINATES = 48
# With a similarity of 0.75 a coordinate matches with that chance: fewer than 22 of 48 match
# for three links in a million.
MATCHES = 22
SIMILARITY = 75  # percent
# Shingles of the members that meet in one group, from inside and outside its main component.
INNER_SHINGLES = 1 << 21
OUTER_SHINGLES = 1 << 20
# Classes that cannot be called by their id get numbers from the largest one down.
LARGEST = (1 << 63) - 1
MOST_CLASSES = 1 << 62

_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(texts: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z count as lower case.

    A text of fewer than ``size`` words has one shingle, all its words; one without words none.
    """
    for start, end in slices(texts):
        words = Words(texts.slice(start, end - start), lower=True)
        hashes = words.hashes()
        counts, at = words.windows(size)
        shingles = phrase_hashes(hashes, size, at)
        cuts = np.concatenate(([0], np.cumsum(counts)))
        for row, n in enumerate(words.counts.tolist()):
            if n >= size:
                yield np.unique(shingles[cuts[row] : cuts[row + 1]])
            elif n:
                # another number of words gives another hash
                whole = phrase_hashes(hashes, n, words.first[row : row + 1])
                yield mix(whole + np.uint64(n))
            else:
                yield np.empty(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each of ``COORDINATES`` hash functions over a set, as 32 bits."""
    out = np.empty(COORDINATES, np.uint32)
    for k in range(COORDINATES):
        scaled = shingles * (_SEEDS[2 * k] | np.uint64(1)) + _SEEDS[2 * k + 1]
        out[k] = scaled.min() >> np.uint64(32)
    return out


def signatures(documents: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_hash, n_shingles, digest`` (of the set; null if empty) ``, signature`` of
    each row."""
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            counts, digests, signs = [], [], []
            for shingles in shingle_sets(text_array(batch.column(1)), size):
                counts.append(len(shingles))
                full = len(shingles) > 0
                raw = hashlib.blake2b(shingles.tobytes(), digest_size=16) if full else None
                digests.append(raw.digest() if raw else None)
                signs.append(signature(shingles).view(np.int32).tolist() if full else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(signs, pa.list_(pa.int32())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "digest", "signature"],
            )

    schema = "doc_id bigint, text_hash bigint, n_shingles bigint, digest binary, signature array<int>"
    return rows.mapInArrow(run, schema)


def full_sets(documents: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, shingles`` (sorted array of hashes) per document."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                found = list(shingle_sets(text_array(part.column(1)), size))
                cuts = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                values = np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(values))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists], names=["doc_id", "shingles"]
                )

    return rows.mapInArrow(run, "doc_id bigint, shingles array<bigint>")


def equal_coordinates(a: str, b: str) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
    )


def numbered(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """Add ``node``: the id of the class, or a number above all ids where that is taken or null.

    One class of each id keeps it; others are numbered from the largest number down. Most ids
    have one class, so the table of the others is small.
    """
    counted = classes.groupBy("id").agg(F.count("*").alias("n"), F.min("number").alias("first"))
    taken = scratch.staged(counted.filter("n > 1 OR id IS NULL"), "taken")
    several = taken.select(F.col("id").alias("taken_id"), "first")
    same = F.col("id").eqNullSafe(F.col("taken_id"))
    other = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("number") != F.col("first")))
    node = F.when(other, F.lit(LARGEST) - F.col("number")).otherwise(F.col("id"))
    return classes.join(several, same, "left").withColumn("doc_id", node).drop("taken_id", "first")


def sets_of(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Full sets of the texts of wanted classes (``doc_id``, and ``id, text_hash`` of a row).

    The texts are merged with the classes at every size; a broadcast below some size would only
    hide what the join costs.
    """
    texts = documents.select(
        F.col("doc_id").cast("bigint").alias("of_id"), "text", F.xxhash64("text").alias("of_hash")
    )
    same = F.col("of_id").eqNullSafe(F.col("id")) & (F.col("of_hash") == F.col("text_hash"))
    met = texts.join(wanted.hint("merge"), same)
    # dealt by these already: no shuffle; repeated rows are one
    once = met.groupBy("id", "text_hash", "doc_id").agg(F.min("text").alias("text"))
    return full_sets(once)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough; one row per pair."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = sets.join(wanted, "doc_id", "left_semi")
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b")).cast("bigint")
    union = F.size("of_a") + F.size("of_b") - both
    return (
        pairs.join(right, "b").join(left, "a").filter(both * 100 >= union * percent).select("a", "b")
    )


def shared_values(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """Prefix postings ``value, doc_id, leader``: the rarest shared values of each class.

    ``value`` is a hash of a coordinate and its value, ``leader`` the smallest class there.
    """
    posted = classes.select(
        "doc_id", F.posexplode("signature").alias("coordinate", "minimum")
    ).select("doc_id", F.xxhash64("coordinate", "minimum").alias("value"))
    lists = posted.groupBy("value").agg(F.count("*").alias("n"), F.min("doc_id").alias("leader"))
    shared = posted.join(lists.filter("n > 1"), "value")
    held = shared.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("n", "value", "leader"))).alias("held")
    )
    prefix = F.slice("held", F.lit(1), F.size("held") - (matches - 1))
    return held.filter(F.size("held") >= matches).select(
        "doc_id", F.explode(prefix).alias("p")
    ).select("doc_id", "p.value", "p.leader", "p.n")


def leader_links(posted: DataFrame, signed: DataFrame, matches: int = MATCHES) -> DataFrame:
    """Each class with that leader of its lists which most coordinates match, if enough do."""
    pairs = posted.filter("doc_id <> leader").select("doc_id", "leader").distinct()
    mine = signed.select("doc_id", "signature", "n_shingles")
    theirs = signed.select(
        F.col("doc_id").alias("leader"),
        F.col("signature").alias("leader_signature"),
        F.col("n_shingles").alias("leader_shingles"),
    )
    return (
        pairs.join(mine, "doc_id")
        .join(theirs, "leader")
        .withColumn("equal", equal_coordinates("signature", "leader_signature"))
        .filter((F.col("equal") >= matches) & _sizes_allow("n_shingles", "leader_shingles"))
        .groupBy("doc_id")
        .agg(F.max(F.struct("equal", (-F.col("leader")).alias("leader"))).alias("best"))
        .select((-F.col("best.leader")).alias("a"), F.col("doc_id").alias("b"))
    )


def _sizes_allow(a: str, b: str, percent: int = SIMILARITY) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


class Unit:
    """Members of one group that meet: their signatures, and their sets as dense numbers."""

    def __init__(self, part: pa.Table):
        self.ids = part.column("doc_id").to_numpy()
        self.label = part.column("label").to_numpy().copy()
        self.outer = part.column("outer").to_numpy()
        signs = _lists(part.column("signature"))
        self.signs = signs.flatten().to_numpy().reshape(len(self.ids), -1)
        sets = _lists(part.column("shingles"))
        ends = sets.offsets.to_numpy().astype(np.int64)
        self.starts = ends[:-1] - ends[0]
        self.sizes = np.diff(ends)
        distinct, self.shingles = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        self.held = np.zeros(len(distinct), bool)

    def common(self, row: int, others: np.ndarray) -> np.ndarray:
        """Size of the intersection of one set with each of some others."""
        own = self.shingles[self.starts[row] : self.starts[row] + self.sizes[row]]
        self.held[own] = True
        sizes = self.sizes[others]
        at = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) + np.repeat(self.starts[others] - at, sizes)
        found = np.add.reduceat(self.held[self.shingles[place]].astype(np.int64), at)
        self.held[own] = False
        return found

    def links(self, matches: int, percent: int) -> Iterator[tuple[int, int]]:
        """Links that join unlike labels; labels are joined as links are found."""
        for row in np.flatnonzero(self.outer):
            size = self.sizes[row]
            fits = np.minimum(self.sizes, size) * 100 >= np.maximum(self.sizes, size) * percent
            others = np.flatnonzero(fits & (self.label != self.label[row]))
            if len(others):
                equal = (self.signs[others] == self.signs[row]).sum(1)
                others = others[equal >= matches]
            if not len(others):
                continue
            both = self.common(row, others)
            near = others[both * 100 >= (self.sizes[others] + size - both) * percent]
            for other in near:
                if self.label[other] != self.label[row]:
                    self.label[self.label == self.label[other]] = self.label[row]
                    yield int(self.ids[row]), int(self.ids[other])


def _lists(column: pa.ChunkedArray) -> pa.ListArray:
    joined = column.combine_chunks()
    return joined.chunk(0) if isinstance(joined, pa.ChunkedArray) else joined


def _meet(matches: int, percent: int):
    def run(part: pa.Table) -> pa.Table:
        pairs = list(Unit(part).links(matches, percent))
        return pa.table(
            {"a": pa.array([a for a, _ in pairs], pa.int64()),
             "b": pa.array([b for _, b in pairs], pa.int64())}
        )

    return run


def remaining_links(
    posted: DataFrame,
    signed: DataFrame,
    labels: DataFrame,
    sets: DataFrame,
    scratch: Scratch,
    matches: int = MATCHES,
    percent: int = SIMILARITY,
) -> DataFrame:
    """Confirmed links between unlike components whose members share a list.

    Two classes that share a list share its leader, so the members of all lists of one leader
    meet once. Members in the leader's component meet only the others: these are dealt into
    blocks of about ``OUTER_SHINGLES``, and each block meets the blocks of ``INNER_SHINGLES``
    of the inner members and each other outer block, in a group of its own. Very many near
    copies, all but a few in one component, are so passed over once. In a group only pairs
    that still lie apart and match in enough coordinates are compared, on their full sets; a
    group yields no more links than it has members.
    """
    own = labels.select(F.col("node").alias("doc_id"), F.col("component").alias("own"))
    leading = labels.select(F.col("node").alias("leader"), F.col("component").alias("leading"))
    members = (
        posted.select("leader", "doc_id")
        .distinct()
        .join(own, "doc_id", "left")
        .join(leading, "leader", "left")
        .withColumn("label", F.coalesce("own", "doc_id"))
        .withColumn("outer", F.col("label") != F.coalesce("leading", "leader"))
        .join(signed.select("doc_id", "n_shingles"), "doc_id")
        .select("leader", "doc_id", "label", "outer", "n_shingles")
    )
    members = scratch.staged(members, "members")
    sizes = (
        members.groupBy("leader")
        .agg(
            F.sum(F.when(F.col("outer"), F.col("n_shingles"))).alias("outer"),
            F.sum(F.when(~F.col("outer"), F.col("n_shingles"))).alias("inner"),
        )
        .filter("outer IS NOT NULL")
        .select(
            "leader",
            F.ceil(F.col("outer") / OUTER_SHINGLES).alias("outers"),
            F.ceil(F.coalesce("inner", F.lit(1)) / INNER_SHINGLES).alias("inners"),
        )
    )
    units = F.expr(
        """CASE WHEN outer THEN concat(
             transform(sequence(0L, inners - 1),
               i -> struct('inner' AS kind, pmod(h, outers) AS first, i AS second)),
             transform(filter(sequence(0L, outers - 1), o -> o <> pmod(h, outers)),
               o -> struct('outer' AS kind, least(o, pmod(h, outers)) AS first,
                 greatest(o, pmod(h, outers)) AS second)))
           ELSE transform(sequence(0L, outers - 1),
               o -> struct('inner' AS kind, o AS first, pmod(h, inners) AS second)) END"""
    )
    dealt = (
        members.join(sizes, "leader")
        .withColumn("h", F.xxhash64("doc_id"))
        .select("leader", "doc_id", "label", "outer", F.inline(units))
    )
    dealt = scratch.staged(dealt, "units")
    held = signed.select("doc_id", "signature")
    return (
        dealt.join(held, "doc_id")
        .join(sets, "doc_id")
        .groupBy("leader", "kind", "first", "second")
        .applyInArrow(_meet(matches, percent), "a bigint, b bigint")
    )


def _judged(documents: DataFrame, percent: int) -> DataFrame:
    """Rows of :func:`near_duplicates` with the hash of their text."""
    scratch = Scratch(documents.sparkSession, "minhash")
    signed = scratch.kept(signatures(documents), "signatures")
    members = signed.filter("digest IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash"))
    grouped = members.groupBy("digest").agg(
        first.alias("row"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
    )
    classes = scratch.staged(
        grouped.select(
            "digest",
            F.col("row.doc_id").alias("id"),
            F.col("row.text_hash").alias("text_hash"),
            "n_shingles",
            "signature",
            F.monotonically_increasing_id().alias("number"),
        ),
        "classes",
    )
    usable = numbered(classes, scratch)
    posted = scratch.staged(shared_values(usable), "postings")
    wanted = usable.select("doc_id", "id", "text_hash").join(
        posted.select("doc_id").distinct(), "doc_id", "left_semi"
    )
    sets = scratch.staged(sets_of(documents, wanted), "shingles")
    links = scratch.staged(confirmed(leader_links(posted, usable), sets, percent), "links")
    labels = scratch.staged(components(links), "labels")
    more = remaining_links(posted, usable, labels, sets, scratch, percent=percent)
    more = scratch.staged(more, "links")
    labels = scratch.staged(components(links.unionByName(more)), "components")
    # ids of classes numbered apart; where they are linked, the component may have a smaller one
    apart = usable.filter(F.col("doc_id") > LARGEST - MOST_CLASSES).select("doc_id", "id")
    apart = apart.join(labels, F.col("doc_id") == F.col("node"))
    smallest = apart.groupBy("component").agg(F.min("id").alias("apart_id"))
    smallest = scratch.staged(smallest.withColumnRenamed("component", "of"), "apart")
    plain = F.when(F.col("component") <= LARGEST - MOST_CLASSES, F.col("component"))
    named = labels.join(smallest, F.col("component") == F.col("of"), "left").select(
        "node", F.least(plain, F.col("apart_id")).alias("component_id")
    )
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    by_class = scratch.kept(
        usable.select("digest", "doc_id", "id")
        .join(named, F.col("doc_id") == F.col("node"), "left")
        .select("digest", own.alias("component_id")),
        "labels",
    )
    scratch.close()
    found = signed.select("doc_id", "text_hash", "n_shingles", "digest")
    found = found.join(by_class, "digest", "left")
    component_id = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(
        F.col("component_id")
    )
    return found.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component_id.alias("component_id"),
        F.col("doc_id").eqNullSafe(component_id).alias("kept"),
    )


def near_duplicates(documents: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """Components of near duplicates; one row per input row.

    Input: ``doc_id, text``; other columns are dropped. Output: ``doc_id, n_shingles,
    component_id`` (smallest id reachable), ``kept`` (``doc_id = component_id``). A null, empty
    or blank text has no shingles and is linked with nothing. Equal texts are linked, also
    under one id; such repeated rows are all kept. Unlike texts under one id, and rows without
    an id, are linked each for itself; a component without any id has component null, and its
    rows are all kept. An empty table gives no rows.

    Links are exact on 64-bit shingle hashes; a pair is missed only if fewer than ``MATCHES``
    coordinates agree (see above).
    """
    return _judged(documents, percent).drop("text_hash")


def drop_duplicates(documents: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """The rows of ``documents`` that :func:`near_duplicates` keeps, with all their columns.

    Only rows that go are looked up, by id and text: another text under the same id stays.
    Rows with a null id stay.
    """
    judged = _judged(documents, percent).filter("NOT kept AND doc_id IS NOT NULL")
    gone = judged.select("doc_id", "text_hash").distinct()
    rows = documents.select("*", F.xxhash64("text").alias("q_text_hash"))
    same = (rows["doc_id"].cast("bigint") == gone["doc_id"]) & (
        rows["q_text_hash"] == gone["text_hash"]
    )
    return rows.join(gone, same, "left_anti").select(*(rows[c] for c in documents.columns))
