"""Spelling variants: words one edit apart, each pointing to a far more frequent form.

Words of one length are points: how often each letter occurs. One replaced letter moves a point
by one up and one down, one inserted letter by one up to the next length, so the L1 distance is
two at most. A k-d tree over the points of a length is searched with the words of this length
and of the one before; a node is visited only if its box can be reached by such a move. Words
that pass are compared letter by letter.

Above a bound of words a length is dealt to many tasks by the upper part of a tree, fitted on a
bounded sample; any cut is right, a sample only makes the parts even. A word is a point of one
part and a query of each part that its moves reach.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.crc import joined, sums_of
from lakemart.llm.tables import Scratch
from lakemart.llm.words import Words, latin_letters, slices, text_array

LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5
EVERY = 199

DIMENSIONS = 160  # a-z and U+00C0 to U+00FF keep counters of their own
PART_WORDS = 8192
PART_LETTERS = 1 << 22
SAMPLE_WORDS = 4096  # of each length that is dealt to many parts
LEAF_WORDS = 64
_PAIRS = 1 << 20

_SLICE_BYTES = 16 << 20


def word_counts(documents: DataFrame, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """``word, n`` over whole texts (``doc_id, text``), of at least ``least_letters``.

    A word is a run of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased. Where ``EVERY`` divides the
    CRC-32 of ``<doc_id>:<run>`` (a null id is empty), the letter at that sum modulo the length
    is left out. A null text has no words.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(1))
            for begin, end in slices(texts, _SLICE_BYTES):
                words = Words(texts.slice(begin, end - begin), True, latin_letters)
                if not len(words.starts):
                    continue
                distinct, at = words.coded()
                sums, sizes = sums_of(distinct), np.array([len(w) for w in distinct], np.int64)
                ids = batch.column(0).slice(begin, end - begin).to_pylist()
                named = sums_of([b":" if i is None else b"%d:" % i for i in ids])
                h = joined(named[words.rows()], sums[at], sizes[at])
                hit = np.flatnonzero(h % np.uint32(EVERY) == 0)
                changed: Counter[str] = Counter()
                for k in hit.tolist():
                    letters = distinct[at[k]].decode()
                    gone = int(h[k]) % len(letters)
                    changed[letters[:gone] + letters[gone + 1 :]] += 1
                number = np.bincount(at, minlength=len(distinct))
                number -= np.bincount(at[hit], minlength=len(distinct))
                plain = pa.array(distinct, pa.binary()).cast(pa.string())
                held = pa.concat_arrays([plain, pa.array(list(changed), pa.string())])
                number = np.concatenate((number, np.fromiter(changed.values(), np.int64)))
                long = pc.greater_equal(pc.utf8_length(held), least_letters)
                wanted = np.flatnonzero(long.to_numpy(False) & (number > 0))
                yield pa.RecordBatch.from_arrays(
                    [held.take(pa.array(wanted)), pa.array(number[wanted].astype(np.int64))],
                    names=["word", "n"],
                )

    counted = rows.mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def letters_of(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length."""
    if length == 0:
        return np.zeros((len(words), 0), np.uint32)
    return np.array(words, f"<U{length}").view("<u4").reshape(len(words), length)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """Points of words; letters that share a counter only make distances smaller."""
    rows = np.repeat(np.arange(len(letters)), letters.shape[1]) * DIMENSIONS
    flat = rows + (letters.ravel() % DIMENSIONS).astype(np.int64)
    counts = np.bincount(flat, minlength=len(letters) * DIMENSIONS)
    return counts.reshape(-1, DIMENSIONS).astype(np.int32)


class KdTree:
    """A k-d tree over whole-number points; leaves are numbered from 0."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.dims: list[int] = []  # -1 at a leaf
        self.cuts: list[int] = []  # a leaf's number
        self.right: list[int] = []
        self.leaves: list[np.ndarray] = []
        waiting = [(np.arange(len(points)), -1)]
        while waiting:
            rows, parent = waiting.pop()
            node = len(self.dims)
            if parent >= 0:
                self.right[parent] = node
            split = self._split(points[rows]) if len(rows) > leaf else None
            if split is None:
                self.dims.append(-1)
                self.cuts.append(len(self.leaves))
                self.right.append(-1)
                self.leaves.append(rows)
                continue
            dim, cut = split
            self.dims.append(dim)
            self.cuts.append(cut)
            self.right.append(-1)
            low = points[rows, dim] <= cut
            waiting.append((rows[~low], node))
            waiting.append((rows[low], -1))  # the next node

    @staticmethod
    def _split(points: np.ndarray) -> tuple[int, int] | None:
        """Dimension and cut that halve the points best; None if all are equal."""
        best, found = len(points), None
        dims = np.flatnonzero(points.max(axis=0) > points.min(axis=0))
        for dim in dims.tolist():
            below = np.cumsum(np.bincount(points[:, dim]))[:-1]
            uneven = np.abs(2 * below - len(points))
            uneven[(below == 0) | (below == len(points))] = len(points) + 1
            cut = int(uneven.argmin())
            if uneven[cut] < best:
                best, found = int(uneven[cut]), (dim, cut)
        return found

    def reach(
        self, queries: np.ndarray, up: int, down: int
    ) -> Iterator[tuple[int, np.ndarray]]:
        """Leaf numbers, each with the queries that can reach its box by moving at most ``up``
        units up and ``down`` units down."""
        none = np.zeros(len(queries), np.int32)
        waiting = [(0, np.arange(len(queries)), none, none, {}, {})]
        while waiting:
            node, rows, used_up, used_down, least, most = waiting.pop()
            if not len(rows):
                continue
            dim, cut = self.dims[node], self.cuts[node]
            if dim < 0:
                yield cut, rows
                continue
            at = queries[rows, dim]
            before = np.maximum(at - most[dim], 0) if dim in most else 0
            needs = used_down - before + np.maximum(at - cut, 0)
            ok = needs <= down
            below = (node + 1, rows[ok], used_up[ok], needs[ok], least, {**most, dim: cut})
            before = np.maximum(least[dim] - at, 0) if dim in least else 0
            needs = used_up - before + np.maximum(cut + 1 - at, 0)
            ok = needs <= up
            above = {**least, dim: cut + 1}
            waiting.append((self.right[node], rows[ok], needs[ok], used_down[ok], above, most))
            waiting.append(below)


def _marks(letters: np.ndarray) -> np.ndarray:
    """One bit for each letter that occurs, letters 64 apart sharing one."""
    bits = np.uint64(1) << (letters % 64).astype(np.uint64)
    return np.bitwise_or.reduce(bits, axis=1)


def one_edit(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Which rows differ by one replaced letter, or one letter that only ``longer`` has."""
    length = shorter.shape[1]
    if length == 0:
        return np.full(len(shorter), longer.shape[1] == 1)
    differ = shorter != longer[:, :length]
    if longer.shape[1] == length:
        return differ.sum(axis=1) == 1
    # equal up to some place, and from there on equal to the letters after it
    moved = shorter != longer[:, 1:]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    last = np.where(moved.any(axis=1), length - 1 - moved[:, ::-1].argmax(axis=1), -1)
    return last < first


def search(
    tree: KdTree, points: np.ndarray, queries: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) one edit apart; both are code points of words of one length each,
    the queries' being that of the points or one less."""
    if not len(points) or not len(queries):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    down = 1 if queries.shape[1] == points.shape[1] else 0
    own, theirs = _marks(queries), _marks(points)
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for leaf, rows in tree.reach(letter_counts(queries), 1, down):
        inside = tree.leaves[leaf]
        step = max(1, _PAIRS // (len(inside) * max(1, points.shape[1])))
        for start in range(0, len(rows), step):
            part = rows[start : start + step]
            near = np.bitwise_count(own[part][:, None] ^ theirs[inside][None, :]) <= 2
            a, b = np.nonzero(near)
            a, b = part[a], inside[b]
            good = one_edit(queries[a], points[b])
            found_a.append(a[good])
            found_b.append(b[good])
    return np.concatenate(found_a), np.concatenate(found_b)


def part_words(length: int) -> int:
    """Words of a length that one task holds as points."""
    return max(LEAF_WORDS, min(PART_WORDS, PART_LETTERS // max(length, 1)))


def upper_trees(words: DataFrame) -> dict[int, KdTree]:
    """Upper part of the tree of each length that has more words than one part holds."""
    sizes = {
        r.length: r.words
        for r in words.groupBy("length").agg(F.count("*").alias("words")).collect()
        if r.words > part_words(r.length)
    }
    if not sizes:
        return {}
    spread = Window.partitionBy("length").orderBy(F.xxhash64("word"), "word")
    sample = (
        words.filter(F.col("length").isin(list(sizes)))
        .withColumn("place", F.row_number().over(spread))
        .filter(F.col("place") <= SAMPLE_WORDS)
        .select("length", "word")
        .collect()
    )
    trees = {}
    for length, size in sizes.items():
        held = [r.word for r in sample if r.length == length]
        leaf = max(1, len(held) * part_words(length) // (2 * size))
        trees[length] = KdTree(letter_counts(letters_of(held, length)), leaf)
        trees[length].leaves = []  # only the boxes are wanted
    return trees


POINT, SAME, SHORTER = 0, 1, 2


def _dealt(words: DataFrame, trees: dict[int, KdTree]) -> DataFrame:
    """Each word as a point of one part, and as a query of each part that it can reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).to_numpy()
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                at, parts, roles, tree_of = [], [], [], []

                def add(who, part, role, to):
                    at.append(rows[who])
                    parts.append(np.full(len(who), part, np.int64))
                    roles.append(np.full(len(who), role, np.int64))
                    tree_of.append(np.full(len(who), to, np.int64))

                points, home = None, np.zeros(len(rows), np.int64)
                if length in trees or length + 1 in trees:
                    held = batch.column(0).take(pa.array(rows)).to_pylist()
                    points = letter_counts(letters_of(held, length))
                if length in trees:
                    for leaf, who in trees[length].reach(points, 0, 0):
                        add(who, leaf, POINT, length)
                        home[who] = leaf
                    for leaf, who in trees[length].reach(points, 1, 1):
                        add(who[home[who] != leaf], leaf, SAME, length)
                else:
                    add(np.arange(len(rows)), 0, POINT, length)
                if length + 1 in trees:
                    for leaf, who in trees[length + 1].reach(points, 1, 0):
                        add(who, leaf, SHORTER, length + 1)
                else:
                    add(np.arange(len(rows)), 0, SHORTER, length + 1)
                taken = batch.select(["word", "n"]).take(pa.array(np.concatenate(at)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *taken.columns,
                        pa.array(np.concatenate(tree_of)),
                        pa.array(np.concatenate(parts)),
                        pa.array(np.concatenate(roles)),
                    ],
                    names=["word", "n", "length", "part", "role"],
                )

    schema = "word string, n bigint, length bigint, part bigint, role bigint"
    return words.select("word", "n", "length").mapInArrow(run, schema)


def _best(
    words: np.ndarray, n: np.ndarray, of: np.ndarray, near: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that have near words, the number of these, and the best one of each."""
    place = np.empty(len(words), np.int64)
    place[np.argsort(words, kind="stable")] = np.arange(len(words))
    order = np.lexsort((place[near], -n[near], of))
    of, near = of[order], near[order]
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else order
    counts = np.diff(np.append(first, len(of)))
    return of[first], counts, near[first]


def _solve(part: pa.Table) -> pa.Table:
    """Near words within one part: number, best and its count for each word that has any."""
    length = part.column("length")[0].as_py()
    words = np.array(part.column("word").to_pylist(), object)
    n, role = part.column("n").to_numpy(), part.column("role").to_numpy()
    points = np.flatnonzero(role == POINT)
    same = np.concatenate((points, np.flatnonzero(role == SAME)))
    shorter = np.flatnonzero(role == SHORTER)
    of, near = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if len(points):
        letters = letters_of(words[same].tolist(), length)
        tree = KdTree(letter_counts(letters[: len(points)]), LEAF_WORDS)
        a, b = search(tree, letters[: len(points)], letters)
        of.append(same[a])
        near.append(points[b])
        if len(shorter):
            less = letters_of(words[shorter].tolist(), length - 1)
            a, b = search(tree, letters[: len(points)], less)
            of += [shorter[a], points[b]]
            near += [points[b], shorter[a]]
    row, counts, best = _best(words, n, np.concatenate(of), np.concatenate(near))
    return pa.table(
        {
            "word": pa.array(words[row], pa.string()),
            "n_near": pa.array(counts.astype(np.int64)),
            "near": pa.array(words[best], pa.string()),
            "near_n": pa.array(n[best].astype(np.int64)),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, near, near_n`` of each word of ``word, n, length`` that has a near one.

    ``near`` is the near word of largest ``n``, ties the smallest in code-point order. Words
    are distinct.
    """
    dealt = _dealt(words, upper_trees(words))
    found = dealt.groupBy("length", "part").applyInArrow(
        _solve, "word string, n_near bigint, near string, near_n bigint"
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select(
            "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")
        )
    )


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``form, root`` of each form that some word has, from ``word, form``.

    Each round doubles the steps followed; counts grow at each step, so rounds are few.
    """
    targets = forms.select("form").distinct()
    after = forms.select(F.col("word").alias("form"), F.col("form").alias("next"))
    hops = targets.join(after, "form", "left").select(
        "form", F.coalesce("next", "form").alias("root")
    )
    hops = scratch.staged(hops, "hops")
    while True:
        beyond = hops.select(F.col("form").alias("root"), F.col("root").alias("beyond"))
        joined_hops = hops.join(beyond, "root").select("form", "root", "beyond")
        moved = scratch.staged(joined_hops, "hops")
        hops = moved.select("form", F.col("beyond").alias("root"))
        if moved.filter("root <> beyond").isEmpty():
            return scratch.kept(hops, "roots")


def group_variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """Forms of words (``word, n``): the near word of largest ``n``, if ``times`` as frequent.

    Output: ``word, form, root, n, n_near, form_n``. ``root`` is reached by following forms;
    it is the word itself if it has no form. Ties go to the smallest word. Two words are near
    if one inserted, deleted or replaced letter tells them apart. Repeated words are added up;
    null words, and those without a count, take no part; the empty word is near those of one
    letter. No words give no rows.
    """
    if times < 2:
        raise ValueError("a form is at least twice as frequent")
    scratch = Scratch(words.sparkSession, "spelling")
    held = (
        words.filter("word IS NOT NULL AND n IS NOT NULL")
        .groupBy("word")
        .agg(F.sum("n").cast("bigint").alias("n"))
        .withColumn("length", F.length("word").cast("bigint"))
    )
    held = scratch.kept(held, "words")
    frequent = F.col("near_n") >= times * F.col("n")
    formed = held.join(near_words(held), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(frequent, F.col("near")).alias("form"),
        F.when(frequent, F.col("near_n")).alias("form_n"),
    )
    formed = scratch.kept(formed, "forms")
    roots = _roots(formed.filter("form IS NOT NULL").select("word", "form"), scratch)
    scratch.close()
    return formed.join(roots, "form", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    documents: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
) -> DataFrame:
    """:func:`group_variants` over the words of whole texts (``doc_id, text``).

    Words of fewer than ``least_letters`` or ``least_count`` occurrences in all documents are
    left out; repeated rows count each time. Other columns are dropped.
    """
    counted = word_counts(documents, least_letters).filter(F.col("n") >= least_count)
    return group_variants(counted, times)
