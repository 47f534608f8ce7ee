"""Operators on texts against plain versions, on awkward documents."""

import base64
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lakemart.llm import byte_bpe, line_dedup, minhash, packing, pii, quality_rules, substrings
from tests.llm import cases

CLASHING = "ids shard value kept label q_text Hashes"


@pytest.fixture(scope="module")
def awkward(spark):
    return cases.documents(spark, cases.awkward(), CLASHING).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return cases.documents(spark, [])


def bpe():
    lines = open(byte_bpe.RANKS, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_byte_bpe(spark):
    rows = [(i, t) for i, t in cases.awkward() if len(t or "") < 200_000]
    rows += [(20, "x y " * 40_000), (21, "<|endoftext|> it's \r\n  \n 12")]
    encoded = byte_bpe.encode(cases.documents(spark, rows, "label"))
    got = byte_bpe.decode(encoded).select("doc_id", "text", "ids", "n_tokens", "decoded", "label")
    plain = bpe()
    found = got.collect()
    assert len(found) == len(rows)
    for row in found:
        ids = plain.encode_ordinary(row.text or "")
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        assert (row.n_tokens, bytes(row.decoded).decode()) == (len(ids), row.text or "")
        assert row.label == "x"


def test_safe_pieces():
    plain = bpe()
    text = "word, it's 3.14\n\n  and more " * 400 + "tail"
    pieces = list(byte_bpe.safe_pieces(text, 100))
    assert len(pieces) > 50 and "".join(pieces) == text
    assert [i for p in pieces for i in plain.encode_ordinary(p)] == plain.encode_ordinary(text)
    assert list(byte_bpe.safe_pieces("", 10)) == [""]
    for sample in (
        "привет, мир\t 12 раз\u00a0и\x1c ещё \r\n 's it's x ' s ",
        "日本語の文章、です。한국어, 中文。２３ ",
        "a\u2003b 1 2, ~~ 3 ... ' ' \x1f x",
    ):
        text = sample * 60
        for size in (7, 50):
            pieces = list(byte_bpe.safe_pieces(text, size))
            assert len(pieces) > 20 and "".join(pieces) == text
            assert [i for p in pieces for i in plain.encode_ordinary(p)] == plain.encode_ordinary(text)


def test_texts_of_other_patterns_are_not_cut(spark):
    text = "one two " * 20_000
    rows = cases.documents(spark, [(1, text)])
    (row,) = byte_bpe.encode(rows, pattern=r"[\s\S]{1,3}").collect()
    lines = open(byte_bpe.RANKS, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding(
        "other", pat_str=r"[\s\S]{1,3}", mergeable_ranks=ranks, special_tokens={}
    )
    assert np.frombuffer(row.ids, "<u4").tolist() == plain.encode_ordinary(text)
    assert list(byte_bpe.safe_pieces("x" * 50, 10)) == ["x" * 50]


def test_byte_bpe_refuses_a_taken_name(spark, empty):
    with pytest.raises(ValueError):
        byte_bpe.encode(cases.documents(spark, [(1, "a")], "ids"))
    assert byte_bpe.decode(byte_bpe.encode(empty)).count() == 0


def test_passages(awkward):
    want = sorted(cases.without_repeats(cases.awkward()), key=repr)
    got = substrings.remove_repeats(awkward)
    assert cases.as_tuples(got, ["doc_id", "n_words", "n_removed", "kept"]) == want
    for row in got.collect():
        assert sum(s.end - s.start for s in row.removed) == row.n_removed


@pytest.mark.parametrize("size", [1, 2, 12, 13])
def test_passages_of_other_sizes(spark, size):
    rows = [(i, cases.prose(i % 7, 25 + i) + " a b c d e f") for i in range(30)]
    want = sorted(cases.without_repeats(rows, size), key=repr)
    got = substrings.remove_repeats(cases.documents(spark, rows), size)
    assert cases.as_tuples(got, ["doc_id", "n_words", "n_removed", "kept"]) == want


def test_passages_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(substrings, "shard_count", lambda _: 13)
    monkeypatch.setattr(substrings, "SEEDS", 20)
    passage = cases.prose(99, 40)
    rows = [(i, f"{cases.prose(100 + i, 20)} {passage} {cases.prose(i % 5, 30)}") for i in range(60)]
    want = sorted(cases.without_repeats(rows), key=repr)
    got = substrings.remove_repeats(cases.documents(spark, rows))
    assert cases.as_tuples(got, ["doc_id", "n_words", "n_removed", "kept"]) == want


def test_near_duplicates(awkward):
    want = sorted(cases.near_groups(cases.awkward()), key=repr)
    got = minhash.near_duplicates(awkward)
    assert cases.as_tuples(got, ["doc_id", "n_shingles", "component_id", "kept"]) == want


def test_near_duplicates_in_chains(spark):
    """Each text is near the next one only, so a group's leader is near few of its members."""
    rows = []
    for chain in range(4):
        text = cases.prose(chain, 60).split()
        for step in range(25):
            text = [*text[2:], f"new{chain}x{step}", f"more{chain}x{step}"]
            rows.append(((step * 37 + chain) % 101 + 200 * chain, " ".join(text)))
    want = sorted(cases.near_groups(rows), key=repr)
    got = minhash.near_duplicates(cases.documents(spark, rows))
    assert cases.as_tuples(got, ["doc_id", "n_shingles", "component_id", "kept"]) == want
    assert len({w[2] for w in want}) == 4


def test_blocks_of_long_lists(spark, monkeypatch):
    monkeypatch.setattr(minhash, "INNER_SHINGLES", 400)
    monkeypatch.setattr(minhash, "OUTER_SHINGLES", 200)
    base = cases.prose(3, 70).split()
    rows = []
    for i in range(40):
        text = [*base]
        for k in range(i % 4):
            text[(i * 7 + k * 19) % 70] = f"other{i}x{k}"
        rows.append((i, " ".join(text)))
    want = sorted(cases.near_groups(rows), key=repr)
    got = minhash.near_duplicates(cases.documents(spark, rows))
    assert cases.as_tuples(got, ["doc_id", "n_shingles", "component_id", "kept"]) == want


def test_unlike_texts_under_one_id_keep_their_links(spark):
    a, b, c = (cases.prose(s, 60).split() for s in (31, 32, 33))

    def near(words, at):
        return " ".join([*words[:at], "other", *words[at + 1 :]])

    rows = [(1, " ".join(a)), (2, near(a, 20)), (2, " ".join(b))]
    rows += [(3, near(b, 9)), (1, near(c, 5)), (4, " ".join(c)), (4, near(c, 50))]
    rows += [(None, near(a, 40)), (None, "no id, and like no other text at all"), (None, "same " * 9)]
    rows += [(9, "x y z"), (9, "x y z"), (9, "p q r"), (8, near(b, 55)), (5, "same " * 9)]
    want = cases.near_groups(rows)
    documents = cases.documents(spark, rows, "text_hash q_text id node").repartition(4)
    got = minhash.near_duplicates(documents)
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    assert cases.as_tuples(got, columns) == sorted(want, key=repr)
    assert [w[2] for w in want[:7]] == [1, 1, 2, 2, 1, 1, 1]
    left = [(r.doc_id, r.text) for r in minhash.drop_duplicates(documents).collect()]
    stay = [row for row, w in zip(rows, want) if w[3] or row[0] is None]
    assert sorted(left, key=repr) == sorted(stay, key=repr)
    assert (2, " ".join(b)) in left and (2, near(a, 20)) not in left


def test_near_duplicates_dropped(spark, awkward, empty):
    left = minhash.drop_duplicates(awkward)
    assert left.columns == awkward.columns
    want = [i for i, _, _, kept in cases.near_groups(cases.awkward()) if kept or i is None]
    assert sorted(r.doc_id or 0 for r in left.collect()) == sorted(i or 0 for i in want)
    assert minhash.near_duplicates(empty).count() == 0


def test_statistics(awkward):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = cases.as_tuples(quality_rules.statistics(awkward), ["doc_id", *names])
    want = [(i, *cases.base_statistics(t)) for i, t in cases.awkward()]
    assert got == sorted(want, key=repr)


def test_lines(awkward, spark, empty):
    with pytest.raises(ValueError):
        line_dedup.remove_repeated_lines(cases.documents(spark, [(1, "a")], "N_LINES"))
    got = line_dedup.remove_repeated_lines(awkward)
    assert got.columns == [*awkward.columns, "n_lines", "n_removed"]
    want = sorted(cases.without_lines(cases.awkward()), key=repr)
    assert cases.as_tuples(got, ["doc_id", "text", "n_lines", "n_removed"]) == want
    assert sum(w[3] for w in want) > 10
    assert line_dedup.remove_repeated_lines(empty).count() == 0


def single_lines():
    """Long and short lines alone, in pairs, in longer runs and repeated in one text."""
    long = [cases.prose(s, 12) for s in range(20, 26)]
    return [
        (1, f"{long[0]}\nab\n{long[1]}\nx1\ny1\nz1"),
        (2, f"first\n{long[0]}\nab\nsecond"),
        (3, f"ab\nthird\n\n{long[1]}\nx1\ny1"),
        (4, f"fourth\nx1\n \ny1\nz1\n{long[2]}\n{long[2]}"),
        (5, "seven77 eight\nnine nine9\nother line"),
        (6, "sixth\nseven77 eight\nnine nine9"),
        (7, "nine nine9\nseven77 eight"),
        (8, "\n".join(["}", "}", "}", "}", long[3], "}"])),
        (9, f"}}\n{long[3]}\n}}\nab\n{long[0]}"),
        (None, long[3]),
        (9, long[4]),
        (9, long[4]),
        (10, f"five5 six66\nseven7\neight8 nine\n{long[4]}"),
        (11, f"tenth\nfive5 six66\nseven7\neight8 nine\nab\n{long[5]}"),
    ]


def test_short_runs_of_long_lines(spark, empty):
    rows = [*single_lines(), *((100 + (i or 0), t) for i, t in cases.awkward())]
    want = cases.without_lines_by_length(rows, least_chars=20)
    docs = cases.documents(spark, rows).repartition(3)
    got = line_dedup.remove_repeated_lines(docs, least_chars=20)
    columns = ["doc_id", "text", "n_lines", "n_removed"]
    assert cases.as_tuples(got, columns) == sorted(want, key=repr)
    by_id = {i: text for i, text, _, _ in want}
    assert by_id[2] == "first\nsecond" and by_id[3] == "ab\nthird\n"
    assert by_id[6] == "sixth" and by_id[7] == rows[6][1]
    assert line_dedup.remove_repeated_lines(empty, least_chars=20).count() == 0


def test_the_pipeline_removes_a_repeated_line(spark):
    line = cases.prose(30, 60)
    rows = [(1, f"{line}\nfirst one"), (2, f"second one\n{line}\nsecond two")]
    left = corpus_pipeline.remove_lines(spark, cases.documents(spark, rows), "")
    assert {r.doc_id: r.text for r in left.collect()} == {
        1: rows[0][1],
        2: "second one\nsecond two",
    }


def private():
    many = " ".join(f"10.0.{i % 256}.{i % 251}" for i in range(300))
    return [
        (1, None),
        (2, ""),
        (3, "mail a.b@c.de.x@y.z now _@q.rs é 1.2.3.4 and 1.2.3.256 or 0001.1.1.1.1"),
        (4, "4111 1111 1111 1111, 4111-1111-1111-1112 +1 (555) 010-9999 +12 +1 2 3"),
        (4, "4111 1111 1111 1111, 4111-1111-1111-1112 +1 (555) 010-9999 +12 +1 2 3"),
        (5, many),
        (None, 'token = "' + "0a1b" * 10 + '" x@y.z'),
        (6, "a" * 200_000 + "@b.c " + "1" * 50_000),
        (7, "user [at] example.org 😀 u@v.wx"),
    ]


def test_personal_data(spark, empty):
    found = pii.find(cases.documents(spark, private(), "spans candidates"))
    got = sorted(
        (
            (r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if s.base])
            for r in found.collect()
        ),
        key=repr,
    )
    assert got == sorted(((i, cases.base_spans(t)) for i, t in private()), key=repr)
    assert pii.find(empty).count() == 0


def secrets():
    """Texts with a secret each, the secret, and texts that hold none."""
    upper = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
    found = [
        (f'TOKEN = "{upper}"!!', upper),
        ("password = 'hunter2hunter'", "hunter2hunter"),
        ("export API_KEY=sk_Live4eC39HqLyjWDarjtT1zdp7dc", "sk_Live4eC39HqLyjWDarjtT1zdp7dc"),
        ('{"auth_token": "QWxhZGRpbjpvcGVuIHNlc2FtZQ09+/x"}', "QWxhZGRpbjpvcGVuIHNlc2FtZQ09+/x"),
        (f'secret: "{"aB3/" * 100}"', "aB3/" * 100),
        (f'{"x" * 70}_key = "{"Zz9" * 9}"', "Zz9" * 9),
        ("call my phone 555 010 9999 now", "555 010 9999"),
    ]
    none = ["title: something", "ratio: 3.14159265 on 2019-10-11", 'name = "some plain words"']
    return found, none


def test_secrets_of_any_form_are_redacted(spark):
    found, none = secrets()
    texts = [t for t, _ in found] * 25 + none * 60
    left = pii.redact(cases.documents(spark, [*enumerate(texts)])).collect()
    by_id = {r.doc_id: r.text for r in left}
    for i, (text, secret) in enumerate(found * 25):
        assert secret not in by_id[i], text
    for i in range(len(found) * 25, len(texts)):
        assert by_id[i] == texts[i]


def test_uncertain_proposals_are_not_labelled(spark):
    found, none = secrets()
    unsure = ["git 9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "at 555 010 9999", "key = value"]
    texts = [*(t for t, _ in found), *none, *unsure]
    docs = cases.documents(spark, [*enumerate(texts)])
    proposed = pii.candidates(docs).cache()
    labels = [r.label for r in pii.labelled(proposed).collect()]
    assert labels.count(1.0) >= len(found) and labels.count(0.0) >= len(none)
    assert proposed.filter(F.col("doc_id") >= 10).filter("size(candidates) > 0").count() == 3
    assert pii.labelled(proposed.filter("doc_id >= 10")).count() == 0


def test_every_proposal_is_labelled(spark):
    numbers = "phone 555 010 9999, " * 70
    dates = "version 2019-10-11 " * 70
    rows = [(i, numbers) for i in range(300)] + [(i, dates) for i in range(300, 330)]
    # alike ids: only the row with a card in it has a number that overlaps one
    rows += [(7, "see 4111 1111 1111 1111"), (7, "see 4111 1111 1111 1112 at 1.2.3.4")]
    proposed = pii.candidates(cases.documents(spark, rows)).cache()
    counts = pii.labelled(proposed).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in counts} == {1.0: 21_001, 0.0: 2_101}
    model = pii.train(proposed)
    spans = pii.select_spans(proposed, model).filter("doc_id <> 7")
    chosen = spans.groupBy(F.col("doc_id") < 300).agg(F.sum(F.size("spans"))).collect()
    assert sorted(map(tuple, chosen)) == [(False, 0), (True, 20_930)]


def test_redaction(spark):
    rows = pii.redact(cases.documents(spark, private(), "label")).collect()
    by_id = {r.doc_id: r for r in rows if r.doc_id != 4}
    assert len(rows) == len(private()) and by_id[1].text is None and by_id[2].text == ""
    assert by_id[3].text.startswith("mail [EMAIL]") and "1.2.3.4 " not in by_id[3].text
    assert "1.2.3.256" in by_id[3].text and by_id[3].label == "x"
    assert by_id[5].text.startswith("[IP]") and not re.search("[0-9]", by_id[5].text)
    assert by_id[7].text.endswith("😀 [EMAIL]")
    for row in rows:
        for id_, text in private():
            if id_ == row.doc_id:
                for kind, a, b in cases.base_spans(text):
                    assert text[a:b] not in row.text


def test_packing(spark, empty):
    rows = [(i, t) for i, t in cases.awkward() if len(t or "") < 250_000]
    documents = cases.documents(spark, rows, "length")
    packed = packing.pack(packing.tokenize(documents, window=64), len(rows), window=64)
    check_packed(rows, packed.collect(), 64)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    assert all(len(r.ids) == 4 * r.length <= 256 for r in whole.values())
    assert packing.pack(packing.tokenize(empty), 0).count() == 0


ODD_WORDS = (
    "A!b x!!y É!È ×a÷ a× don't! O'Neil's …a a… Ünï!code? Å! ÅNGSTRÖM!! İstanbul! ſ! ΣΑΣ! a\x00b "
    "a\u00a0b! <|endoftext|> !!!a a-b-c A1! 1a! a!1 ß! ẞ! \u200ba! 日本! ça!va? Ç 'a a' ÿ!ÿ word.. "
    "(word) word) e\u0301! 😀! a😀!"
).split(" ")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library(name):
    """Also of a tokenizer whose words cannot be encoded apart."""
    path = public_tokenizers.path(name)
    encoder = packing.WordEncoder(path)
    assert encoder.by_words == (name == "word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    texts = [t or "" for _, t in cases.awkward() if len(t or "") < 200_000] + ODD_WORDS
    texts += [" ".join(ODD_WORDS), "".join(ODD_WORDS), "\n\t".join(ODD_WORDS * 3), "", " "]
    for _ in range(2):  # the second time from memory
        ids, counts = encoder.texts(pa.array(texts, pa.large_string()), 7)
        ends = np.cumsum(counts)
        for k, text in enumerate(texts):
            wanted = plain.encode(text, add_special_tokens=False).ids + [7]
            assert ids[ends[k] - counts[k] : ends[k]].tolist() == wanted, text[:50]


def check_packed(rows, pieces, window):
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    tokenizer.encode_special_tokens = True
    sequences: dict[int, list] = {}
    by_doc: dict[object, list] = {}
    for piece in pieces:
        sequences.setdefault(piece.sequence_id, []).append(piece)
        by_doc.setdefault(piece.doc_id, []).append(piece)
    for id_ in {i for i, _ in rows}:
        texts = [t or "" for i, t in rows if i == id_]
        want = []
        for text in texts:
            ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
            for start in range(0, len(ids), window):
                part = np.array(ids[start : start + window], "<u4").tobytes()
                want.append((start, len(part) // 4, zlib.crc32(part), len(ids)))
        got = [(p.start, p.length, zlib.crc32(p.ids), p.doc_tokens) for p in by_doc[id_]]
        assert sorted(got) == sorted(want)
    for own in sequences.values():
        at = 0
        for piece in sorted(own, key=lambda p: p.offset):
            assert piece.offset == at
            at += piece.length
        assert at <= window


def test_best_fit_matches_a_search():
    made = np.random.default_rng(5)
    lengths = made.integers(1, 65, 500)
    place, offset, used = packing.best_fit(lengths, 64)
    room: list[int] = []
    for length in sorted(lengths.tolist(), reverse=True):
        fitting = [r for r in room if r >= length]
        if fitting:
            room.remove(min(fitting))
            room.append(min(fitting) - length)
        else:
            room.append(64 - length)
    assert used == len(room)
    filled = np.bincount(place, lengths, used)
    assert sorted((64 - filled).astype(int).tolist()) == sorted(room)
    assert packing.best_fit(np.empty(0, int), 64)[2] == 0
