"""Texts that contain any of very many phrases.

An expression with one test for each phrase grows with the catalogue. Here phrases are rows: a
text can only contain a phrase if it has any run of bytes of it, so the run that fewest phrases
share is joined first, and only what meets there is tested. The plan is the same for any number
of phrases. Texts are scanned for the runs asked for, whole batches at once; nearly all other
runs stay where they are. A phrase that is one run needs no further test.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDEST = 8  # bytes of a run, unless the phrase is shorter
FIRST = 4  # bytes that are looked at before the rest of a run
PLACES = 1_048_573  # a bound on what the scan knows of the catalogue, whatever its size
_CHUNK = 1 << 20


def _place(run: str) -> Column:
    """The place of a run: what ``_places`` gives for its last ``FIRST`` bytes and the others."""
    high = f"coalesce(conv(left(hex({run}), length(hex({run})) - {2 * FIRST}), 16, 10), '0')"
    low = f"conv(right(hex({run}), {2 * FIRST}), 16, 10)"
    return F.expr(
        f"CAST((CAST({high} AS bigint) * 31 + CAST({low} AS bigint)) % {PLACES} AS int)"
    )


def _places(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return (high * np.uint64(31) + low) % np.uint64(PLACES)


def _scanner(
    asked: dict[int, np.ndarray], names: list[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, text as bytes) to rows (key, run) of the runs that have a known place.

    ``asked``: the places of each width, and as width 0 those of the first bytes of long runs.
    """

    def found(piece: np.ndarray, known: dict[int, np.ndarray]) -> Iterator[tuple]:
        """Width, positions and numbers of runs; ``WIDEST`` bytes at the end are only padding."""
        pairs = (piece[:-1].astype(np.uint16) << np.uint16(8)) | piece[1:]
        fours = (pairs[:-2].astype(np.uint32) << np.uint32(16)) | pairs[2:]
        own = fours[: len(piece) - WIDEST]
        long = None
        for width in sorted(known.keys() - {0}):
            if width < FIRST:
                low = own >> np.uint32(8 * (FIRST - width))
                at = np.flatnonzero(known[width][low - low // PLACES * np.uint32(PLACES)])
                yield width, at, low[at].astype(np.uint64)
                continue
            if long is None:
                first = own - own // np.uint32(PLACES) * np.uint32(PLACES)
                long = np.flatnonzero(known[0][first])
            low = fours[long + (width - FIRST)].astype(np.uint64)
            high = own[long].astype(np.uint64) >> np.uint64(8 * (2 * FIRST - width))
            hit = known[width][_places(high, low)]
            yield width, long[hit], ((high << np.uint64(32)) | low)[hit]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {width: np.zeros(PLACES, bool) for width in asked}
        for width, places in asked.items():
            known[width][places] = True
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
            _, offsets, data = texts.buffers()
            ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(data or b"", np.uint8)[: int(ends[-1])]
            for start in range(int(ends[0]), len(data), _CHUNK):
                size = min(_CHUNK, len(data) - start)
                piece = np.zeros(size + WIDEST, np.uint8)
                held = data[start : start + size + WIDEST]
                piece[: len(held)] = held
                for width, at, runs in found(piece, known):
                    at = at + start
                    rows = np.searchsorted(ends, at, "right") - 1
                    within = at + width <= ends[rows + 1]
                    rows, runs = rows[within], runs[within]
                    if not len(rows):
                        continue
                    order = np.lexsort((runs, rows))
                    rows, runs = rows[order], runs[order]
                    new = np.append(True, (rows[1:] != rows[:-1]) | (runs[1:] != runs[:-1]))
                    rows, runs = rows[new], runs[new]
                    spelled = runs.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]
                    spelled = pa.FixedSizeBinaryArray.from_buffers(
                        pa.binary(width), len(rows), [None, pa.py_buffer(spelled.tobytes())]
                    )
                    columns = [keys.take(pa.array(rows)), spelled.cast(pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return scan


def phrase_hits(
    texts: DataFrame, key: str, text: str, phrases: DataFrame, term: str = "term"
) -> DataFrame:
    """``key`` and the distinct ``terms`` (sorted array) of the texts that contain a phrase.

    ``texts``: one row for each ``key``. ``phrases``: ``term`` and ``phrase``; a text has the
    term if its lower-cased form contains the phrase as it is written. Empty phrases, which say
    nothing, and null ones are left out; null texts contain none.
    """
    catalogue = phrases.select(F.col(term).alias("term"), "phrase").dropna().distinct()
    spelled = catalogue.where("phrase <> ''").withColumn("bytes", F.col("phrase").cast("binary"))
    width = f"least(length(bytes), {WIDEST})"
    runs = (
        f"transform(sequence(1, length(bytes) - {width} + 1), i -> substring(bytes, i, {width}))"
    )
    asked = spelled.select(
        "term", "phrase", F.explode(F.array_distinct(F.expr(runs))).alias("run")
    )
    counts = asked.groupBy("run").agg(F.count("*").alias("n"))
    rarest = asked.join(counts, "run").groupBy("term", "phrase").agg(
        F.min(F.struct("n", "run")).alias("rare")
    )
    anchors = rarest.select("term", "phrase", F.col("rare.run").alias("run"))
    first = anchors.where(F.length("run") >= FIRST).select(
        F.lit(0).alias("width"), _place(f"substring(run, 1, {FIRST})").alias("place")
    )
    # at most PLACES of each width
    places = anchors.select(F.length("run").alias("width"), _place("run").alias("place"))
    known = places.union(first).distinct().toArrow()
    widths, at = known["width"].to_numpy(), known["place"].to_numpy()
    known = {int(w): at[widths == w] for w in np.unique(widths)}
    lowered = texts.select(key, F.lower(text).alias("lowered")).dropna(subset=["lowered"])
    scanned = lowered.select(key, F.col("lowered").cast("binary").alias("bytes"))
    schema = lowered.select(key, F.lit(b"").alias("run")).schema
    met = scanned.mapInArrow(_scanner(known, schema.names), schema).join(anchors, "run")
    whole = F.octet_length("phrase") == F.length("run")
    maybe = met.groupBy(key).agg(
        F.collect_set(F.when(whole, F.col("term"))).alias("sure"),
        F.collect_set(F.when(~whole, F.struct("term", "phrase"))).alias("maybe"),
    )
    contained = F.filter("maybe", lambda m: F.contains("lowered", m["phrase"]))
    tested = maybe.join(lowered, key).select(
        key, F.concat("sure", contained["term"]).alias("hits")
    )
    named = tested.select(key, F.explode("hits").alias("term"))
    return named.groupBy(key).agg(F.array_sort(F.collect_set("term")).alias("terms"))


def with_terms(
    texts: DataFrame, key: str, text: str, phrases: DataFrame, term: str = "term"
) -> DataFrame:
    """All texts with their ``terms``, empty where no phrase is contained."""
    hits = phrase_hits(texts, key, text, phrases, term)
    return texts.join(hits, key, "left").withColumn(
        "terms", F.coalesce("terms", F.array().cast("array<string>"))
    )
