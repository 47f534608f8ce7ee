"""Packing of tokenized documents into sequences of a fixed length.

Documents are encoded with the ``tokenizers`` library, cut into full windows and a rest, and
the rests are placed by best-fit decreasing: the longest first, each into the open window with
the tightest room, which a segment tree over remaining capacities finds.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.words import Words, slices, text_array

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
WINDOW = 4096
GROUP_DOCUMENTS = 4096

_CACHED = 800_000
_JOINED = 1000
_SLICE_BYTES = 8 << 20

# Letters, marks, digits, case, blanks and special tokens: what may tell a text from its words.
_PROBE = (
    "The the  tHe\tÉtude Łódź don't it's e.g. (x)--y!? 3,14 1999 a1b2 <|endoftext|> naïve\n"
    "co-op §7 日本語 привет мир ... end.\u00a0x #tag @me"
)


def _byte_classes() -> np.ndarray:
    """0 blank, 1 letter, 2 punctuation but the apostrophe, 3 any other byte."""
    out = np.full(256, 3, np.uint8)
    for byte in range(33, 127):
        if not chr(byte).isdigit() and byte != ord("'"):
            out[byte] = 1 if chr(byte).isalpha() else 2
    out[[9, 10, 11, 12, 13, 32]] = 0
    return out


_CLASSES = _byte_classes()
_LEAD, _TIMES, _DIVIDED = 0xC3, 0x97, 0xB7  # lead byte of U+00C0 to U+00FF; two are no letters


class Units:
    """Parts of texts that are encoded on their own, lower-cased where they are Latin letters.

    A word of Latin letters and then punctuation is two parts, any other word is one.
    ``distinct`` holds the parts, ``letters`` tells which are letters only, ``at`` their order in
    all texts, ``first`` the first part of each text.
    """

    def __init__(self, texts: pa.Array):
        words = Words(texts)
        data, starts = words.data, words.starts
        kind = _CLASSES[data]
        lead = np.flatnonzero(data[:-1] == _LEAD) if len(data) else np.empty(0, np.int64)
        follow = data[lead + 1]
        latin = lead[(follow != _TIMES) & (follow != _DIVIDED)]
        kind[latin] = kind[latin + 1] = 1
        low = np.where((data >= 65) & (data <= 90), data | 32, data)
        large = lead[(follow >= 0x80) & (follow <= 0x9E) & (follow != _TIMES)]
        low[large + 1] += 0x20

        inner = np.ones(len(data), bool)
        inner[starts] = False
        before = np.concatenate((np.zeros(1, np.uint8), kind[:-1])) if len(data) else kind
        spoilt = (kind == 3) | (inner & (before == 2) & (kind == 1))
        seen = np.concatenate(([0], np.cumsum(spoilt, dtype=np.int32)))
        plain = (seen[words.ends] == seen[starts]) & (kind[starts] == 1)
        cuts = np.flatnonzero(inner & (before == 1) & (kind == 2))
        cuts = cuts[plain[np.searchsorted(starts, cuts, "right") - 1]] if len(cuts) else cuts
        begins = np.sort(np.concatenate((starts, cuts)))
        own = plain[np.searchsorted(starts, begins, "right") - 1] if len(starts) else plain
        is_letters = own & (kind[begins] == 1)

        filled = kind != 0
        place = np.concatenate(([0], np.cumsum(filled, dtype=np.int32)))
        offsets = np.append(place[begins], place[-1]).astype(np.int64)
        coded = pa.Array.from_buffers(
            pa.large_string(),
            len(begins),
            [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(low[filled].tobytes())],
        ).dictionary_encode()
        self.distinct: list[str] = coded.dictionary.to_pylist()
        self.at = coded.indices.to_numpy(False)
        self.letters = np.zeros(len(self.distinct), bool)
        self.letters[self.at] = is_letters
        bounds = np.append(starts, len(data))[words.first]
        self.first = np.searchsorted(begins, bounds)


class WordEncoder:
    """Encodes words, each distinct one once as long as it is remembered.

    The given tokenizer drops white space before it merges, so the ids of a text are those of
    its words, and a word of Latin letters followed by punctuation other than an apostrophe has
    the ids of the letters, then those of the punctuation. A tokenizer that does not give a
    probe text the same ids this way encodes texts whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(size, bool)  # tokens that end a run of letters
        for token, number in self.tokenizer.get_vocab().items():
            if number < size:
                self.ends[number] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}
        self.by_words = True
        probe = [_PROBE, _PROBE.upper(), " " + _PROBE, "word", ""]
        ids, counts = self.texts(pa.array(probe, pa.large_string()))
        plain = self._encode(probe)
        self.by_words = counts.tolist() == [len(p) for p in plain] and bool(
            np.array_equal(ids, np.concatenate(plain))
        )

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _learn(self, letters: set[str], others: set[str]) -> None:
        words = sorted(letters)
        for start in range(0, len(words), _JOINED):
            part = words[start : start + _JOINED]
            (ids,) = self._encode([" ".join(part)])
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                others = others | set(part)
                continue
            cuts = [0, *(stops * 4).tolist()]
            packed = ids.tobytes()
            self.known.update(zip(part, (packed[a:b] for a, b in zip(cuts, cuts[1:]))))
        rest = sorted(others)
        self.known.update(zip(rest, (ids.tobytes() for ids in self._encode(rest))))

    def parts(self, distinct: list[str], letters: np.ndarray) -> list[bytes]:
        """Packed ids of each part; those of letters only are encoded many at once."""
        known = self.known
        unseen = [k for k, part in enumerate(distinct) if part not in known]
        if len(known) + len(unseen) > _CACHED:
            known.clear()
            unseen = [*range(len(distinct))]
        if unseen:
            fresh = {distinct[k] for k in unseen if letters[k]}
            self._learn(fresh, {distinct[k] for k in unseen if not letters[k]})
        return [known[part] for part in distinct]

    def texts(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, each followed by ``end``, and the number of ids of each."""
        last = b"" if end is None else end.to_bytes(4, "little")
        if not self.by_words:
            found = [ids.tobytes() + last for ids in self._encode(texts.to_pylist())]
            counts = np.array([len(f) // 4 for f in found], np.int64)
            return np.frombuffer(b"".join(found), "<u4"), counts
        units = Units(texts)
        packed = self.parts(units.distinct, units.letters)
        packed.append(last)
        sizes = np.array([len(p) // 4 for p in packed], np.int64)
        ids = np.frombuffer(b"".join(packed), "<u4")
        begins = np.cumsum(sizes) - sizes
        parts = np.insert(units.at, units.first[1:], len(packed) - 1)
        lengths = sizes[parts]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(begins[parts] - (ends - lengths), lengths)
        at += np.arange(total)
        held = np.concatenate(([0], ends))[units.first + np.arange(len(units.first))]
        return ids[at], np.diff(held)


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def tokenize(
    documents: DataFrame,
    tokenizer_path: str = TOKENIZER,
    end_id: int = END_ID,
    window: int = WINDOW,
) -> DataFrame:
    """Token ids of whole documents, cut into pieces of at most ``window`` ids.

    Input: ``doc_id, text``; other columns are dropped. Output: ``doc_id, start`` (ids of the
    document before the piece), ``length, ids`` (packed little-endian unsigned 32-bit),
    ``doc_tokens``. Each document ends with ``end_id``, so a null or empty text is one piece of
    one id. Every piece but the last is a full window. Repeated rows are repeated.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        for batch in batches:
            texts = text_array(batch.column(1))
            for first, last in slices(texts, _SLICE_BYTES):
                ids, counts = words.texts(texts.slice(first, last - first), end_id)
                pieces = -(-counts // window)
                row = np.repeat(np.arange(len(counts)), pieces)
                begin = np.repeat(np.cumsum(counts) - counts, pieces)
                order = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = order * window
                length = np.minimum(counts[row] - start, window)
                data = pa.py_buffer(ids.tobytes())
                cuts = np.append((begin + start) * 4, len(ids) * 4).astype(np.int64)
                packed = pa.Array.from_buffers(
                    pa.large_binary(), len(row), [None, pa.py_buffer(cuts.tobytes()), data]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first).take(pa.array(row)),
                        pa.array(start),
                        pa.array(length),
                        packed.cast(pa.binary()),
                        pa.array(counts[row]),
                    ],
                    names=["doc_id", "start", "length", "ids", "doc_tokens"],
                )

    schema = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint"
    return rows.mapInArrow(run, schema)


class OpenWindows:
    """Open windows by remaining capacity, and a segment tree that counts them."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.stacks: dict[int, list[int]] = {}

    def _count(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.tree[node] += change
            node >>= 1

    def put(self, room: int, number: int) -> None:
        self.stacks.setdefault(room, []).append(number)
        self._count(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """Room and number of the tightest window with at least ``length`` left."""
        tree, node = self.tree, length + self.leaves
        if not tree[node]:
            # up to the first right neighbour that counts a window, then down its left side
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._count(room, -1)
        return room, self.stacks[room].pop()


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each piece, longest first, and the number of windows."""
    place = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    open_windows, used = OpenWindows(window), 0
    for row in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[row])
        found = open_windows.take(length)
        if found is None:
            found, used = (window, used), used + 1
        room, number = found
        place[row], offset[row] = number, window - room
        if room > length:
            open_windows.put(room - length, number)
    return place, offset, used


def pack(pieces: DataFrame, documents: int, window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id, offset`` to pieces (``doc_id, start, length`` and others).

    Pieces are dealt by a hash into groups of about ``GROUP_DOCUMENTS`` documents, each packed
    on its own, so that no task sees a group that grows with the data; a group leaves a few
    windows open at its end, which is less than 1 % of it. ``documents`` is their number and
    only sets that of groups. Sequence ids are unique but have gaps; offsets in a sequence
    start at 0 without gaps. Equal pieces are ordered by document and start.
    """
    groups = max(1, -(-documents // GROUP_DOCUMENTS))
    names = pieces.columns
    if {"sequence_id", "offset", "pack_group"} & {n.lower() for n in names}:
        raise ValueError("the input already has a column of the packing")
    salted = pieces.withColumn(
        "pack_group", F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)).cast("bigint")
    )

    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by([("doc_id", "ascending"), ("start", "ascending")])
        lengths = part.column("length").to_numpy()
        if len(lengths) and int(lengths.max()) > window:
            raise ValueError("a piece is longer than the window")
        place, offset, _ = best_fit(lengths, window)
        group = part.column("pack_group")[0].as_py()
        return (
            part.drop_columns(["pack_group"])
            .append_column("sequence_id", pa.array(place + (group << 32)))
            .append_column("offset", pa.array(offset))
        )

    schema = T.StructType([*pieces.schema.fields])
    schema = schema.add("sequence_id", "long").add("offset", "long")
    return salted.groupBy("pack_group").applyInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences from packed pieces that still hold their ``ids``.

    Output: ``sequence_id, length, ids`` (pieces in order of offset), ``doc_ids``.
    """
    by_offset = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return (
        packed.groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), by_offset.alias("pieces"))
        .select(
            "sequence_id",
            "length",
            F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
            F.col("pieces.doc_id").alias("doc_ids"),
        )
    )
