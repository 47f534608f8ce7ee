"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Texts are encoded whole. A long text is first cut at boundaries that no match of the splitting
pattern can cross, so that the regular expression engine never sees a very long text; the ids
are those of the uncut text. Ids travel as packed little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakemart.llm.words import slices, text_array

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LONG_TEXT = 1 << 16

# Before white space that follows anything else, in any script, and between a Chinese, Japanese
# or Korean letter and a full stop or comma. The given pattern's matches take white space only
# at their start or together with more of it, and letters only with letters, so one always ends
# there. Other patterns are not known to, and their texts are not cut.
_SAFE_CUT = re.compile(
    r"(?<=\S)(?=[ \t\r\n])"
    "|(?<=[\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3])(?=[\u3001\u3002\uff0c\uff01\uff1f.,!?])"
)


@cache
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, loaded once in a Python worker."""
    with open(ranks_path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """Cut a text after about ``size`` characters, at safe boundaries only."""
    start = 0
    while len(text) - start > size:
        found = _SAFE_CUT.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def encode_text(bpe: tiktoken.Encoding, text: str, cut: bool = True) -> bytes:
    """Ids of a text, packed; no string counts as a special token."""
    pieces = (
        bpe.encode_to_numpy(piece, disallowed_special=()).astype("<u4").tobytes()
        for piece in (safe_pieces(text) if cut else [text])
    )
    return b"".join(pieces)


def _append(batch: pa.RecordBatch, names: list[str], columns: list[pa.Array]) -> pa.RecordBatch:
    schema = batch.schema
    for name, column in zip(names, columns):
        schema = schema.append(pa.field(name, column.type))
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], schema=schema)


def with_fields(df: DataFrame, **fields: str) -> T.StructType:
    """Schema of ``df`` with more columns; a clash of names is an error."""
    taken = {name.lower() for name in df.columns}
    schema = T.StructType(list(df.schema.fields))
    for name, kind in fields.items():
        if name.lower() in taken:
            raise ValueError(f"the input already has a column {name!r}")
        schema = schema.add(name, kind)
    return schema


def encode(
    df: DataFrame,
    column: str = "text",
    ids: str = "ids",
    n_tokens: str = "n_tokens",
    ranks_path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Add the packed ids and the number of tokens of a text column.

    A null or empty text has no tokens. Other columns and the order of rows stay; repeated
    rows are encoded each. Raises ValueError if ``ids`` or ``n_tokens`` is already a column.
    """
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cut = encoding(ranks_path, pattern), pattern == public_tokenizers.PATTERN
        for batch in batches:
            for start, end in slices(text_array(batch.column(at))):
                part = batch.slice(start, end - start)
                texts = part.column(at).to_pylist()
                packed = [encode_text(bpe, text, cut) if text else b"" for text in texts]
                counts = np.array([len(p) // 4 for p in packed], np.int64)
                yield _append(
                    part, [ids, n_tokens], [pa.array(packed, pa.binary()), pa.array(counts)]
                )

    return df.mapInArrow(run, with_fields(df, **{ids: "binary", n_tokens: "long"}))


def decode(
    df: DataFrame,
    ids: str = "ids",
    decoded: str = "decoded",
    ranks_path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Add the bytes that packed ids stand for; null ids give null.

    The bytes of a whole text are valid UTF-8; those of a part of its ids need not be, so
    they are not turned into a string. An id outside the rank file raises KeyError.
    """
    at = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoding(ranks_path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                packed = part.column(at).to_pylist()
                raw = [
                    None if p is None else bpe.decode_bytes(np.frombuffer(p, "<u4").tolist())
                    for p in packed
                ]
                yield _append(part, [decoded], [pa.array(raw, pa.binary())])

    return df.mapInArrow(run, with_fields(df, **{decoded: "binary"}))
