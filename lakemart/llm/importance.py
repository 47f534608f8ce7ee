"""Documents drawn so that their words are spread as those of a target collection.

Features are single words and pairs of neighbours, hashed into ``BUCKETS``. A document's counts
become bit planes: plane j holds bit j of every bucket's count. The gains of the buckets, logs
of target share over corpus share, become planes as well, one set for positive and one for
negative gains. The sum of count times gain is then exact in whole numbers: the set bits that
two planes have in common, times a power of two. The same planes give the corpus counts, by
adding whole columns with carries. Gumbel noise from a hash of the id makes the highest scores
a sample without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.crc import joined, sums_of
from lakemart.llm.tables import Scratch
from lakemart.llm.words import Words, letters_and_digits, slices, text_array

BUCKETS = 10_000
PLANE_BYTES = 8 * -(-BUCKETS // 64)
SCALE = 1000
SEED = 7
LEAST_WORDS = 20
PERCENT = 25

_DENSE_ROWS = 256  # rows counted at a time, one counter for each bucket
_PLANE_ROWS = 1024  # rows weighed at a time


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each feature: words, then pairs of neighbours of one text."""
    distinct, at = words.coded()
    sums, sizes = sums_of(distinct), np.array([len(w) for w in distinct], np.int64)
    blank = np.full(len(sums), sums_of([b" "])[0], np.uint32)
    spaced = joined(sums, blank, np.ones(len(sums), np.int64))
    row = words.rows()
    first = np.flatnonzero(row[1:] == row[:-1])
    second = at[first + 1]
    pairs = joined(spaced[at[first]], sums[second], sizes[second])
    bucket = np.concatenate((sums[at], pairs)) % np.uint32(BUCKETS)
    return np.concatenate((row, row[first])), bucket.astype(np.int64)


def _packed(row: np.ndarray, bucket: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Planes of each row, one after another, and the number of each row's planes."""
    counts = np.bincount(row * BUCKETS + bucket, minlength=rows * BUCKETS).reshape(rows, BUCKETS)
    most = counts.max(axis=1)
    planes = np.ceil(np.log2(most + 1)).astype(np.int64)
    out = np.zeros((rows, int(planes.max(initial=0)), PLANE_BYTES), np.uint8)
    for j in range(out.shape[1]):
        bits = np.packbits((counts >> j) & 1, axis=1, bitorder="little")
        out[:, j, : bits.shape[1]] = bits
    used = np.arange(out.shape[1])[None, :] < planes[:, None]
    return out[used], planes


def bit_planes(documents: DataFrame) -> DataFrame:
    """Counts of the features of whole texts as bit planes.

    Input: ``doc_id, text``; other columns are dropped. Output: ``doc_id, n_words,
    n_features``, ``planes`` (binary: the planes from bit 0 on, of ``PLANE_BYTES`` each, up to
    the highest bit that occurs). A null text has no words, and no planes. Repeated rows are
    repeated.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_array(batch.column(1))
            for begin, end in slices(texts):
                words = Words(texts.slice(begin, end - begin), True, letters_and_digits)
                row, bucket = features(words)
                order = np.argsort(row, kind="stable")
                row, bucket = row[order], bucket[order]
                sizes = np.bincount(row, minlength=end - begin)
                for low in range(0, end - begin, _DENSE_ROWS):
                    high = min(low + _DENSE_ROWS, end - begin)
                    a, b = np.searchsorted(row, (low, high))
                    planes, number = _packed(row[a:b] - low, bucket[a:b], high - low)
                    cuts = np.concatenate(([0], np.cumsum(number * PLANE_BYTES))).astype(np.int32)
                    held = pa.Array.from_buffers(
                        pa.binary(),
                        high - low,
                        [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(planes.tobytes())],
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(begin + low, high - low),
                            pa.array(words.counts[low:high].astype(np.int64)),
                            pa.array(sizes[low:high].astype(np.int64)),
                            held,
                        ],
                        names=["doc_id", "n_words", "n_features", "planes"],
                    )

    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, planes binary")


def _levels(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Plane number, rows that have it, and their planes as 64-bit words."""
    held = column.cast(pa.large_binary())
    offsets = np.frombuffer(held.buffers()[1], np.int64, len(held) + 1, held.offset * 8)
    low, high = int(offsets[0]), int(offsets[-1])
    if high == low:
        return
    words = np.frombuffer(held.buffers()[2], np.uint8, high - low, low)
    planes = np.ascontiguousarray(words).view("<u8").reshape(-1, PLANE_BYTES // 8)
    first = (offsets - low) // PLANE_BYTES
    number = np.diff(first)
    for j in range(int(number.max())):
        rows = np.flatnonzero(number > j)
        yield j, rows, planes[first[rows] + j]


def column_sums(levels: dict[int, list[np.ndarray]]) -> np.ndarray:
    """Sum of the counts of each bucket over all rows, from planes by bit.

    Three planes of a bit become one of that bit and one, the carries, of the next; the last
    two are counted.
    """
    total = np.zeros(PLANE_BYTES * 8, np.int64)
    level = 0
    while any(levels.values()):
        held = levels.pop(level, [])
        planes = np.concatenate(held) if held else np.zeros((0, PLANE_BYTES // 8), np.uint64)
        carried = levels.setdefault(level + 1, [])
        while len(planes) > 2:
            third = len(planes) // 3
            x, y, z = planes[:third], planes[third : 2 * third], planes[2 * third : 3 * third]
            odd = x ^ y
            carried.append((x & y) | (odd & z))
            planes = np.concatenate((odd ^ z, planes[3 * third :]))
        if len(planes):
            bits = np.unpackbits(planes.view(np.uint8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64) << level
        level += 1
    return total[:BUCKETS]


def bucket_counts(planes: DataFrame, name: str) -> DataFrame:
    """``bucket`` and ``name``, the features of all rows in it; buckets without any are left out.

    A task leaves at most one row for each bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, _PLANE_ROWS):
                part = batch.column(0).slice(start, _PLANE_ROWS)
                total += column_sums({j: [held] for j, _, held in _levels(part)})
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(total[seen])], names=["bucket", "n"]
        )

    counted = planes.select("planes").mapInArrow(run, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias(name))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """Whole gain of each bucket from ``bucket, s`` and ``bucket, t``: at most BUCKETS rows.

    Both counts are smoothed by one in each bucket.
    """
    spark = corpus.sparkSession
    both = (
        spark.range(BUCKETS)
        .withColumnRenamed("id", "bucket")
        .join(corpus, "bucket", "left")
        .join(target, "bucket", "left")
        .select("bucket", *(F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st"))
    )
    out = np.zeros(BUCKETS, np.int64)
    rows = both.collect()
    all_s, all_t = (sum(r[c] for r in rows) + BUCKETS for c in "st")
    for row in rows:
        share = (row.t + 1.0) * all_s / ((row.s + 1.0) * all_t)
        out[row.bucket] = math.floor(SCALE * math.log(share))
    return out


def gain_planes(gain: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """Sign, bit and plane of the gains that have this sign and bit."""
    out = []
    for sign in (1, -1):
        size = np.maximum(sign * gain, 0)
        for k in range(int(size.max(initial=0)).bit_length()):
            bits = np.zeros(PLANE_BYTES * 8, np.uint8)
            bits[:BUCKETS] = (size >> k) & 1
            out.append((sign, k, np.packbits(bits, bitorder="little").view("<u8")))
    return out


def weigh(planes: DataFrame, gain: np.ndarray) -> DataFrame:
    """Floored mean gain of each row's features (``weight``; 0 without features).

    Input: the columns of :func:`bit_planes`. Output: ``doc_id, n_words, n_features, weight``.
    """
    signed = gain_planes(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _PLANE_ROWS):
                part = batch.slice(start, _PLANE_ROWS)
                total = np.zeros(part.num_rows, np.int64)
                for j, rows, held in _levels(part.column(3)):
                    sums = np.zeros(len(rows), np.int64)
                    for sign, k, plane in signed:
                        common = np.bitwise_count(held & plane).sum(axis=1, dtype=np.int64)
                        sums += sign * (common << (j + k))
                    total[rows] += sums
                size = part.column(2).to_numpy()
                weight = np.where(size > 0, total // np.maximum(size, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    schema = "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    return planes.select("doc_id", "n_words", "n_features", "planes").mapInArrow(run, schema)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Whole Gumbel noise of an id, the same wherever it is computed; a null id counts as ''."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-float(SCALE) * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("bigint")


def _numbered(groups: DataFrame, scratch: Scratch) -> DataFrame:
    """``groups`` (``doc_id, n_features, weight, score, copies``) with ``before``: the rows of
    all groups ahead, highest score first, ties to the smaller id.

    Ranges of the order are dealt to tasks, which number their own rows; sums of the ranges
    before, one row for each task, do the rest.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranged = groups.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            copies = batch.column(4).to_numpy()
            ends = seen + np.cumsum(copies)
            columns = [*batch.columns, pa.array(ends - copies), pa.array(np.full(len(ends), task))]
            if len(ends):
                seen = int(ends[-1])
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "ahead", "task"])

    names = groups.columns
    schema = ", ".join(f"{n} bigint" for n in [*names, "ahead", "task"])
    placed = scratch.kept(ranged.mapInArrow(run, schema), "ranges")
    tasks = placed.groupBy("task").agg(F.sum("copies").alias("n"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    return placed.join(tasks, "task").select(
        *names, (F.col("ahead") + F.col("earlier")).alias("before")
    )


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Weights of all documents, and ``percent`` of those with ``least_words`` drawn by score.

    Input: ``doc_id, text`` of ``documents`` and ``text`` of ``target``; other columns are
    dropped. Output: ``doc_id, n_features, weight, score, rank`` (from 1; null where not
    drawn). A null or empty text has no features, weight 0 and is never drawn if
    ``least_words`` is above 0. Repeated rows are documents each, with the same noise. An
    empty corpus gives no rows; without a target, rare words weigh most. Ties go to the
    smaller id, a null id last.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "resample")
    planes = scratch.staged(bit_planes(documents), "planes", "zstd")
    named = target.select(F.lit(None).cast("bigint").alias("doc_id"), "text")
    gain = gains(bucket_counts(planes, "s"), bucket_counts(bit_planes(named), "t"))
    weighed = scratch.kept(weigh(planes, gain), "weights")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    columns = ["doc_id", "n_features", "weight", "score"]
    wanted = F.col("n_words") >= least_words
    drawn = weighed.filter(wanted).count() * percent // 100
    # equal rows are one group: a repeated row is sorted once, however often it occurs
    groups = scored.filter(wanted).groupBy(columns).agg(F.count("*").alias("copies"))
    numbered = _numbered(groups, scratch)
    scratch.close()
    place = F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("copies")))
    ranked = numbered.select(*columns, place.alias("rank"))
    others = scored.filter(~wanted).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    within = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    return ranked.select(*columns, within).unionByName(others)
