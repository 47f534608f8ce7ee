"""Repeated passages: found by counting, confirmed, then located by Aho-Corasick automata.

1. Documents are dealt into shards by a hash of their id. Every window of ``size`` words holds
   the minimum of its phrase hashes; such minima (about a fifth of all words) are posted per
   shard, and those that occur in two documents come back to their shards.
2. Shards post their windows around recurring minima; windows of two documents are confirmed,
   and return with the smallest document that holds them.
3. Each shard joins its confirmed windows to passages, compiles automata of phrases that every
   window of a passage contains, and streams all its documents through them. A hit grows both
   ways as far as the words agree, which gives every occurrence.

What is posted goes as packed arrays, one row per shard and bucket of hashes, each hash once
per shard: a passage in a third of all documents is one entry per shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.words import Words, phrase_hashes, text_array

WINDOW_WORDS = 13
PHRASE_WORDS = 6
SEED_WORDS = 7  # at every seventh word of a passage: each window of 13 words holds one whole
SEEDS = 200_000  # of one automaton
BUCKET_BYTES = 8 << 20
SHARD_BYTES = 1 << 20

LAST = np.iinfo(np.int64).max  # a null id sorts after all others


def shard_count(text_bytes: int) -> int:
    """Shards grow with the square root of the text, so that shards and buckets stay balanced."""
    return max(1, math.ceil(text_bytes / max(SHARD_BYTES, 25 * math.sqrt(text_bytes))))


def minima(phrases: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest phrase hash (the first, if equal) of each window."""
    low, place = phrases[at], at.copy()
    for step in range(1, width):
        there = phrases[at + step]
        less = there < low
        low = np.where(less, there, low)
        place[less] = at[less] + step
    return place


class Shard:
    """Words, windows and their minima of the documents of one shard, in order of id."""

    def __init__(self, part: pa.Table, size: int):
        known = part.column("doc_id").fill_null(int(LAST)).to_numpy()
        order = np.argsort(known, kind="stable")
        self.ids = known[order]
        self.texts = text_array(_one(part.column("text"))).take(pa.array(order))
        self.words = Words(self.texts)
        self.hashes = self.words.hashes()
        counts, self.at = self.words.windows(size)
        self.owner = np.repeat(self.ids, counts)  # of each window
        self.size = size

    def minima(self) -> tuple[np.ndarray, np.ndarray]:
        """Phrase hash by position, and the position of each window's minimum."""
        length = min(PHRASE_WORDS, self.size)
        phrases = np.zeros(len(self.hashes), np.uint64)
        _, at = self.words.windows(length)
        phrases[at] = phrase_hashes(self.hashes, length, at)
        return phrases, minima(phrases, self.at, self.size - length + 1)

    def windows(self, chosen: np.ndarray | slice = slice(None)) -> np.ndarray:
        return phrase_hashes(self.hashes, self.size, self.at[chosen])


def _one(column: pa.ChunkedArray) -> pa.Array:
    joined = column.combine_chunks()
    return joined.chunk(0) if isinstance(joined, pa.ChunkedArray) else joined


def _firsts(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, the smallest owner of each, and whether there are others."""
    order = np.lexsort((owners, hashes))
    hashes, owners = hashes[order], owners[order]
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(hashes)) - 1 if len(at) else at
    return hashes[at], owners[at], owners[last] > owners[at]


def _bucket_cuts(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where the buckets, equal ranges of hashes, begin and end in sorted hashes."""
    step = (1 << 64) // buckets
    borders = np.array([step * b for b in range(1, buckets)], np.uint64)
    return np.concatenate(([0], np.searchsorted(hashes, borders), [len(hashes)]))


def _table(names: str, rows: list[tuple]) -> pa.Table:
    kinds = {"bucket": pa.int64(), "shard": pa.int64(), "plural": pa.int64()}
    columns = list(zip(*rows)) if rows else [[] for _ in names.split()]
    return pa.table(
        {n: pa.array(list(c), kinds.get(n, pa.binary())) for n, c in zip(names.split(), columns)}
    )


def _unpack(column: pa.ChunkedArray, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(value, kind) for value in column.to_pylist()]


def _is_in(values: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``chosen``."""
    if not len(chosen):
        return np.zeros(len(values), bool)
    at = np.searchsorted(chosen, values)
    at[at == len(chosen)] = 0
    return chosen[at] == values


def _post_minima(buckets: int, size: int):
    def run(part: pa.Table) -> pa.Table:
        shard = part.column("shard")[0].as_py()
        docs = Shard(part, size)
        phrases, place = docs.minima()
        chosen, index = np.unique(place, return_index=True)
        hashes, _, plural = _firsts(phrases[chosen], docs.owner[index])
        cuts = _bucket_cuts(hashes, buckets)
        rows = []
        for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                many = plural[a:b]
                packed = np.concatenate((hashes[a:b][many], hashes[a:b][~many]))
                rows.append((bucket, shard, packed.tobytes(), int(many.sum())))
        return _table("bucket shard hashes plural", rows)

    return run


def _recurring(part: pa.Table) -> pa.Table:
    """Of each shard, the hashes that another shard or another of its documents has as well."""
    posted = _unpack(part.column("hashes"), "<u8")
    plural = part.column("plural").to_pylist()
    everything = np.sort(np.concatenate(posted))
    twice = everything[1:][everything[1:] == everything[:-1]]
    chosen = np.unique(np.concatenate([twice, *(p[:n] for p, n in zip(posted, plural))]))
    rows = []
    for shard, hashes in zip(part.column("shard").to_pylist(), posted):
        kept = hashes[_is_in(hashes, chosen)]
        if len(kept):
            rows.append((shard, kept.tobytes()))
    return _table("shard hashes", rows)


def _gathered(part: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *_unpack(part.column(name), kind)])


def _post_windows(buckets: int, size: int):
    def run(part: pa.Table, recurring: pa.Table) -> pa.Table:
        names = "bucket shard hashes owners places"
        if not part.num_rows or not recurring.num_rows:
            return _table(names, [])
        shard = part.column("shard")[0].as_py()
        docs = Shard(part, size)
        phrases, place = docs.minima()
        wanted = np.sort(_gathered(recurring, "hashes", "<u8"))
        chosen = np.flatnonzero(_is_in(phrases, wanted)[place])
        hashes, owners, plural = _firsts(docs.windows(chosen), docs.owner[chosen])
        cuts = _bucket_cuts(hashes, buckets)
        rows = []
        for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                some, index = np.unique(owners[a:b], return_inverse=True)
                places = (index.astype("<u4") << 1) | plural[a:b]
                data = hashes[a:b].tobytes(), some.tobytes(), places.astype("<u4").tobytes()
                rows.append((bucket, shard, *data))
        return _table(names, rows)

    return run


def _confirmed(part: pa.Table) -> pa.Table:
    """Of each shard, the windows that another document has as well, with their first document.

    A window that only its first document holds there has nothing to remove and stays away.
    """
    posted = _unpack(part.column("hashes"), "<u8")
    some = _unpack(part.column("owners"), "<i8")
    places = _unpack(part.column("places"), "<u4")
    owners = [o[p >> 1] for o, p in zip(some, places)]
    hashes, first, _ = _firsts(np.concatenate(posted), np.concatenate(owners))
    rows = []
    for shard, own, owner, place in zip(part.column("shard").to_pylist(), posted, owners, places):
        earliest = first[np.searchsorted(hashes, own)]
        kept = (earliest < owner) | (place & 1).astype(bool)
        if kept.any():
            table, index = np.unique(earliest[kept], return_inverse=True)
            data = own[kept].tobytes(), table.tobytes(), index.astype("<u4").tobytes()
            rows.append((shard, *data))
    return _table("shard hashes owners places", rows)


class Passages:
    """Passages of one shard, as ranges of its words, and the automata that find them."""

    def __init__(self, docs: Shard, hashes: np.ndarray, first: np.ndarray):
        order = np.argsort(hashes)
        hashes, first = hashes[order], first[order]
        windows = docs.windows()
        found = np.flatnonzero(_is_in(windows, hashes))
        _, index = np.unique(windows[found], return_index=True)
        fresh = found[np.sort(index)]  # each confirmed window where it comes first
        starts = docs.at[fresh]
        self.first = np.full(len(docs.hashes), LAST)
        self.first[starts] = first[np.searchsorted(hashes, windows[fresh])]
        document = np.searchsorted(docs.words.first, starts, "right")
        cut = np.ones(len(starts), bool)
        cut[1:] = (starts[1:] != starts[:-1] + 1) | (document[1:] != document[:-1])
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(starts)) - 1 if len(begin) else begin
        self.ranges = list(
            zip(starts[begin].tolist(), (starts[end] + docs.size).tolist() if len(begin) else [])
        )

    def automata(self, letters: str, size: int) -> Iterator[ahocorasick.Automaton]:
        """Automata over words as letters; each phrase gives the places it has in passages."""
        seed = min(SEED_WORDS, (size + 1) // 2)
        built: dict[str, list[tuple[int, int, int]]] = {}
        for start, end in self.ranges:
            for place in range(start, end - seed + 1, seed):
                built.setdefault(letters[place : place + seed], []).append((place, start, end))
            if len(built) >= SEEDS:
                yield self._compiled(built)
                built = {}
        if built:
            yield self._compiled(built)

    @staticmethod
    def _compiled(seeds: dict[str, list[tuple[int, int, int]]]) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        for phrase, places in seeds.items():
            automaton.add_word(phrase, (len(phrase), places))
        automaton.make_automaton()
        return automaton


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many words agree from the start."""
    length = min(len(a), len(b))
    done, step = 0, 16
    while done < length:
        same = a[done : min(done + step, length)] == b[done : min(done + step, length)]
        if not same.all():
            return done + int(same.argmin())
        done, step = done + step, step * 4
    return length


def _occurrences(
    automaton: ahocorasick.Automaton, letters: str, hashes: np.ndarray, begin: int, end: int
) -> Iterator[tuple[int, int, int]]:
    """Runs of the words ``begin..end`` that agree with a passage: start, place in it, length."""
    reached: dict[int, int] = {}  # end of the last run, by passage and shift
    for at, (seed, places) in automaton.iter(letters[begin:end]):
        word = begin + at - seed + 1
        for place, start, stop in places:
            key = (word - place, start)
            if reached.get(key, 0) > word:
                continue
            back = min(place - start, word - begin)
            left = _agree(hashes[word - back : word][::-1], hashes[place - back : place][::-1])
            room = min(stop - place, end - word)
            right = _agree(hashes[word : word + room], hashes[place : place + room])
            reached[key] = word + right
            if right >= seed:
                yield word - left, place - left, left + right


def _remove(size: int):
    names = ["doc_id", "n_words", "n_removed", "removed", "kept"]

    def run(part: pa.Table, confirmed: pa.Table) -> pa.Table:
        docs = Shard(part, size)
        words = docs.words
        gone = np.zeros(len(docs.hashes) + 1, np.int64)  # +1 where a removed window starts ...
        if confirmed.num_rows:
            hashes = _gathered(confirmed, "hashes", "<u8")
            owners = _unpack(confirmed.column("owners"), "<i8")
            places = _unpack(confirmed.column("places"), "<u4")
            first = np.concatenate([o[p] for o, p in zip(owners, places)])
            passages = Passages(docs, hashes, first)
            # a letter per word; equal letters of unequal words are told apart by the hashes
            codes = ((docs.hashes & np.uint64(0xFFFFF)) + np.uint64(0x10000)).astype("<u4")
            letters = codes.tobytes().decode("utf-32-le")
            later = np.zeros(len(docs.hashes), bool)
            bounds = words.first.tolist()
            for automaton in passages.automata(letters, size):
                for document, begin, end in zip(docs.ids, bounds, bounds[1:]):
                    if end - begin < size:
                        continue
                    runs = _occurrences(automaton, letters, docs.hashes, begin, end)
                    for word, place, length in runs:
                        windows = length - size + 1
                        if windows > 0:
                            older = passages.first[place : place + windows] < document
                            later[word : word + windows] |= older
            starts = np.flatnonzero(later)
            gone[starts] += 1
            np.subtract.at(gone, starts + size, 1)
        covered = np.cumsum(gone)[:-1] > 0
        return _results(docs, covered)

    def _results(docs: Shard, covered: np.ndarray) -> pa.Table:
        words = docs.words
        texts = docs.texts.cast(pa.large_binary()).to_pylist()
        kept, spans, removed = [], [], []
        for row, text in enumerate(texts):
            a, b = words.first[row], words.first[row + 1]
            mask = covered[a:b]
            pieces = text.split()
            n = int(mask.sum())
            if n:
                edges = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
                starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                spans.append([{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())])
                pieces = [pieces[i] for i in np.flatnonzero(~mask)]
            else:
                spans.append([])
            removed.append(n)
            kept.append(b" ".join(pieces))
        ids = pa.array(docs.ids, mask=docs.ids == LAST)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = [ids, pa.array(words.counts.astype(np.int64)), pa.array(removed, pa.int64())]
        columns += [pa.array(spans, kind), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.table(columns, names=names)

    return run


def remove_repeats(documents: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """Remove passages that a document with a smaller id holds as well.

    Input: ``doc_id, text``; other columns are dropped. A passage is ``size`` or more
    consecutive words, split at space and 0x09-0x0D and compared unchanged; all windows are
    judged on the input. Output, one row per input row: ``doc_id, n_words, n_removed, removed``
    (word ranges, end exclusive), ``kept`` (remaining words joined by one space).

    A null text has no words. Repeated rows of one id don't remove each other's words. A null
    id counts as larger than any other, and equal to another null. An empty table gives none.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    text_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = shard_count(text_bytes)
    buckets = max(64, math.ceil(text_bytes / BUCKET_BYTES))
    shard: Column = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("bigint")
    dealt = rows.withColumn("shard", shard).repartition("shard")  # one shuffle, read three times
    posted = "bucket bigint, shard bigint, hashes binary"
    minima_rows = dealt.groupBy("shard").applyInArrow(
        _post_minima(buckets, size), f"{posted}, plural bigint"
    )
    recurring = minima_rows.groupBy("bucket").applyInArrow(
        _recurring, "shard bigint, hashes binary"
    )
    windows = (
        dealt.groupBy("shard")
        .cogroup(recurring.groupBy("shard"))
        .applyInArrow(_post_windows(buckets, size), f"{posted}, owners binary, places binary")
    )
    confirmed = windows.groupBy("bucket").applyInArrow(
        _confirmed, "shard bigint, hashes binary, owners binary, places binary"
    )
    schema = (
        "doc_id bigint, n_words bigint, n_removed bigint, "
        "removed array<struct<start: bigint, end: bigint>>, kept string"
    )
    return (
        dealt.groupBy("shard")
        .cogroup(confirmed.groupBy("shard"))
        .applyInArrow(_remove(size), schema)
    )
