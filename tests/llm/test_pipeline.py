"""The pipeline against a plain chain of its stages; learned rules and chosen spans are given."""

import zlib

import numpy as np
import pytest
from tests.conftest import SMALL
from tests.llm import cases
from tokenizers import Tokenizer

import corpus_pipeline
from lakemart.llm import packing, pii, quality_rules
from lakemart.llm.tables import staged, table


def as_rows(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def plain_quality(spark, docs, labels):
    """Rows that the plain base limits keep, less those a learned rule rejects."""
    judged = quality_rules.quality(docs, labels).select("doc_id", "n_words", "base_failed", "rule")
    rejected = {r.doc_id for r in judged.collect() if r.rule is not None and not r.base_failed}
    out = []
    for id_, text in as_rows(docs):
        n_words, *_, repeated = cases.base_statistics(text)
        if n_words >= 10 and 100 * repeated <= 20 * n_words and id_ not in rejected:
            out.append((id_, text))
    return out


def plain_lines(rows):
    return [(id_, text) for id_, text, _, _ in cases.without_lines_by_length(rows)]


def plain_near(rows):
    return [row for row, judged in zip(rows, cases.near_groups(rows)) if judged[3] or row[0] is None]


def plain_redaction(spark, rows):
    found = pii.find(cases.documents(spark, rows)).collect()
    spans = {r.doc_id: r.spans for r in found}
    out = []
    for id_, text in rows:
        base = [(s.kind, s.start, s.end) for s in spans[id_] if s.base]
        assert sorted(base) == sorted(cases.base_spans(text))
        merged = []
        for s in sorted(spans[id_], key=lambda s: (s.start, -s.end, s.kind)):
            if merged and merged[-1][1] > s.start:
                last = merged[-1]
                last[1] = max(last[1], s.end)
                if s.base and not last[3]:
                    last[2:] = [s.kind, True]
            else:
                merged.append([s.start, s.end, s.kind, s.base])
        parts, at = [], 0
        for start, end, kind, _ in merged:
            parts += [text[at:start], f"[{kind.upper()}]"]
            at = end
        out.append((id_, None if text is None else "".join([*parts, text[at:]])))
    return out


def plain_pieces(rows, window=packing.WINDOW):
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    tokenizer.encode_special_tokens = True
    out = []
    for id_, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        for start in range(0, len(ids), window):
            part = np.array(ids[start : start + window], "<u4")
            out.append((id_, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
    return sorted(out)


def check_places(packed, window=packing.WINDOW):
    """Pieces of a sequence follow each other without gaps, and few sequences are not full."""
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= window
    total = sum(r.length for r in packed)
    assert len(by_sequence) <= -(-total // window) * 1.05 + 1


@pytest.mark.parametrize("extra", [False, True])
def test_run_equals_a_plain_chain(spark, extra):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    if extra:  # planted among the given ones: copies, near copies, shared lines, personal data
        base = [cases.prose(s, 60) for s in range(70, 78)]
        line = cases.prose(79, 14)
        rows = [(10_000 + i, f"{t}\n{line}\n{cases.prose(80 + i, 20)}") for i, t in enumerate(base)]
        rows += [(11_000 + i, t.replace("w1", "v1", 1)) for i, t in enumerate(base)]
        rows += [(12_000, f"{cases.prose(90, 30)} write to ann.lee+x@mail.example.org or 10.0.0.7")]
        rows += [(12_001, f"{cases.prose(91, 30)} password = \"hunter2-Zx81\" {cases.prose(92, 20)}")]
        docs = docs.unionByName(cases.documents(spark, rows))
    chain = plain_quality(spark, docs, labels)
    steps = [chain, plain_lines(chain)]
    steps.append(plain_near(steps[-1]))
    steps.append(plain_redaction(spark, steps[-1]))
    for (name, stage), wanted in zip(corpus_pipeline.STAGES[:-1], steps):
        after = staged(stage(spark, docs, SMALL), "test-stage")
        assert after.columns == docs.columns
        assert as_rows(after) == sorted(wanted, key=repr), name
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(tuple(r[c] for c in columns) for r in packed) == plain_pieces(steps[-1])
    check_places(packed)
    if not extra:
        whole = corpus_pipeline.run(spark, SMALL).collect()
        assert sorted(tuple(r[c] for c in columns) for r in whole) == plain_pieces(steps[-1])
        check_places(whole)
