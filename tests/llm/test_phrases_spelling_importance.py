"""Phrase index, spelling variants and importance resampling against plain versions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm import cases

from lakemart.llm import crc, importance, phrase_index, spelling
from lakemart.llm.tables import Scratch

ITEM = "item_id bigint, text string, doc_id string"


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "clash") for i, t in items], ITEM)


def leaks():
    """Items of all lengths and documents that hold them whole, in part, twice or not at all."""
    long = cases.prose(50, 40)
    words = long.split()
    items = [(1, long), (2, long), (3, "One, two; three"), (4, ""), (5, None), (6, "same " * 14)]
    items += [(7, " ".join(words[20:])), (7, cases.prose(51, 12)), (None, cases.prose(52, 11))]
    items += [(10, " ".join([*words[:12], "other", *words[13:25]])), (11, "...")]
    rows = cases.awkward() + [
        (20, cases.prose(53, 30) + " " + long.upper() + "\n" + cases.prose(54, 9)),
        (20, "one-two-three one two three"),
        (21, " ".join(words[5:15]) + " x " + " ".join(words[15:24])),
        (22, " ".join(words[31:]) + " " + " ".join(words[:9])),
        (23, (long + " ") * 30),
        (23, (long + " ") * 30),
        (24, " ".join(words[:11]) + " other " + " ".join(words[13:25])),
        (None, cases.prose(52, 11)),
    ]
    return rows, items


def test_contamination(spark):
    rows, items = leaks()
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    documents = cases.documents(spark, rows, "term pos doc seq").repartition(5)
    got = phrase_index.contamination(documents, benchmark(spark, items))
    assert got.columns == columns
    assert cases.as_tuples(got, columns) == sorted(cases.contaminated(rows, items), key=repr)


def test_contamination_of_frequent_words(spark):
    made = random.Random(3)
    rows = [(i, " ".join(made.choice("abc") for _ in range(400))) for i in range(40)]
    items = [(i, " ".join(made.choice("abc") for _ in range(made.randrange(6, 16)))) for i in range(9)]
    got = phrase_index.contamination(cases.documents(spark, rows), benchmark(spark, items))
    assert cases.as_tuples(got, got.columns) == sorted(cases.contaminated(rows, items), key=repr)


def test_contamination_of_empty_tables(spark):
    some = [(1, "a b c"), (2, None)]
    none = phrase_index.contamination(cases.documents(spark, some), benchmark(spark, []))
    empty = cases.sha("")
    assert cases.as_tuples(none, none.columns) == [(1, 3, 0, 0, empty, False), (2, 0, 0, 0, empty, False)]
    nothing = phrase_index.contamination(cases.documents(spark, []), benchmark(spark, [(1, "a")]))
    assert nothing.count() == 0


def test_proximity(spark):
    made = random.Random(4)
    rows = [(i, " ".join(made.choice("abcdefgh") for _ in range(80))) for i in range(20)]
    items = [(1, "a b c"), (2, "d d e"), (3, "f"), (4, "a zebra")]
    scratch = Scratch(spark, "test")
    index = scratch.staged(phrase_index.build_index(cases.documents(spark, rows)), "index")
    terms, named = phrase_index._phrases(benchmark(spark, items), scratch)
    ids = index.filter("term IS NULL").select("doc", "doc_id")
    for within in (1, 3, 7):
        found = phrase_index.proximity_matches(index, terms, scratch, within)
        got = found.join(ids, "doc").join(named, "seq").select("doc_id", "item_id", "pos")
        got = {tuple(r) for r in got.collect()}
        plain = cases.near_places(rows, items, within)
        anchor = {}
        for _, item, word, _ in plain:
            held = {x for _, i, x, _ in plain if i == item}
            count = {x: sum(t.split().count(x) for _, t in rows) for x in held}
            places = {x: dict(items)[item].split().index(x) for x in held}
            anchor[item] = min(held, key=lambda x: (count[x], places[x]))
        assert got == {(d, str(i), p) for d, i, x, p in plain if x == anchor[i]}


def typos():
    """Words with planted edits, in documents enough to pass every limit."""
    made = random.Random(5)
    letters = "abcdeéàz"
    base = ["".join(made.choice(letters) for _ in range(made.randrange(5, 11))) for _ in range(60)]
    rows = []
    for i in range(300):
        said = []
        for word in made.choices(base, [2 ** (k % 9) for k in range(60)], k=40):
            if made.random() < 0.2:
                at = made.randrange(len(word))
                change = made.choice(["", made.choice(letters), word[at] * 2])
                word = word[:at] + change + word[at + 1 :]
            said.append(made.choice([word, word.upper(), word.title()]))
        rows.append((i if i % 40 else None, made.choice([" ", "-", "’", "×\n"]).join(said)))
    return rows


def test_word_counts(spark):
    rows = typos() + cases.awkward()
    documents = cases.documents(spark, rows, "word n").repartition(5)
    got = {r.word: r.n for r in spelling.word_counts(documents, 0).collect()}
    assert got == dict(cases.spelled(rows))
    plain = set()
    for _, text in rows:
        plain |= {cases.lowered(run) for run in cases.RUN.findall(text or "")}
    assert set(got) - plain  # some letters were left out


def test_spelling_variants(spark):
    rows = typos() + cases.awkward()
    got = spelling.spelling_variants(cases.documents(spark, rows, "word n root"))
    counts = {w: n for w, n in cases.spelled(rows).items() if len(w) >= 6 and n >= 5}
    expected = cases.variants(counts)
    assert cases.as_tuples(got, ["word", "form", "root", "n", "n_near", "form_n"]) == sorted(
        expected, key=repr
    )
    assert any(r[1] is not None for r in expected)
    assert spelling.spelling_variants(cases.documents(spark, [])).count() == 0
    assert spelling.spelling_variants(cases.documents(spark, [(1, None), (2, "")])).count() == 0


def test_variants_in_many_parts(spark, monkeypatch):
    """Lengths dealt to many tasks by the upper trees, and given words of any alphabet."""
    made = random.Random(6)
    words = {"".join(made.choice("abcde") for _ in range(made.randrange(1, 7))) for _ in range(900)}
    words |= {"", "жук", "жуки", "жак", "a" * 400, "a" * 401, "a" * 399 + "b", "abc" * 30}
    counts = {w: made.randrange(1, 2000) for w in words}
    counts["ties"] = counts["tied"] = counts["tier"] = 50
    counts["tie"] = 3
    counts |= {"zzzzzz": 3, "zzzzzy": 40, "zzzzyy": 900}  # followed twice
    monkeypatch.setattr(spelling, "PART_WORDS", 64)
    table = spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n bigint, form int")
    got = spelling.group_variants(table.unionByName(spark.createDataFrame([(None, 5, 1), ("x", None, 1)], table.schema)))
    held = words_by_length(counts)
    trees = spelling.upper_trees(held(spark))
    assert len(trees) >= 3 and max(t.cuts[-1] for t in trees.values()) > 3
    expected = cases.variants(counts)
    assert ("zzzzzz", "zzzzzy", "zzzzyy", 3, 1, 40) in expected
    assert cases.as_tuples(got, ["word", "form", "root", "n", "n_near", "form_n"]) == sorted(
        expected, key=repr
    )


def words_by_length(counts):
    rows = [(w, n, len(w)) for w, n in counts.items()]
    return lambda spark: spark.createDataFrame(rows, "word string, n bigint, length bigint")


def test_one_edit():
    made = random.Random(7)
    for _ in range(3000):
        n = made.randrange(0, 6)
        a = "".join(made.choice("ab") for _ in range(n))
        b = "".join(made.choice("ab") for _ in range(n + made.randrange(2)))
        if not b:
            continue
        x = spelling.letters_of([a], n)
        assert spelling.one_edit(x, spelling.letters_of([b], len(b)))[0] == cases.near(a, b)


def test_crc_of_joined_bytes():
    made = random.Random(8)
    left = [made.randbytes(made.randrange(0, 90)) for _ in range(500)]
    right = [made.randbytes(made.randrange(0, 400)) for _ in range(498)] + [b"", b"x" * 70_000]
    sizes = np.array([len(x) for x in right])
    got = crc.joined(crc.sums_of(left), crc.sums_of(right), sizes)
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right)]


def test_column_sums():
    made = np.random.default_rng(9)
    counts = made.integers(0, 40, (57, importance.BUCKETS))
    counts[3, 7] = 1000
    levels = {}
    for j in range(10):
        bits = np.zeros((57, importance.PLANE_BYTES * 8), np.uint8)
        bits[:, : importance.BUCKETS] = (counts >> j) & 1
        levels[j] = [np.packbits(bits, axis=1, bitorder="little").view("<u8")]
    assert importance.column_sums(levels).tolist() == counts.sum(axis=0).tolist()


@pytest.mark.parametrize("percent, least", [(25, 20), (100, 0), (0, 5)])
def test_resample(spark, percent, least):
    rows, items = leaks()
    rows = rows + [(100 + i, cases.prose(200 + i % 30, 25 + i % 7)) for i in range(200)]
    rows += [(None, "the " * 25)] * 7 + [(300, "the " * 25)] * 5
    documents = cases.documents(spark, rows, "rank score weight").repartition(7)
    got = importance.resample(documents, benchmark(spark, items), percent, least)
    expected = cases.importance(rows, [t for _, t in items], percent, least)
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    assert cases.as_tuples(got, columns) == sorted(expected, key=repr)


def test_resample_of_empty_tables(spark):
    rows = [(i, cases.prose(i, 30)) for i in range(8)]
    got = importance.resample(cases.documents(spark, rows), benchmark(spark, []))
    expected = cases.importance(rows, [])
    assert cases.as_tuples(got, got.columns) == sorted(expected, key=repr)
    assert importance.resample(cases.documents(spark, []), benchmark(spark, [(1, "a b")])).count() == 0
    nulls = importance.resample(cases.documents(spark, [(1, None), (2, "")]), benchmark(spark, []))
    assert [r["weight"] for r in nulls.select(F.col("weight")).collect()] == [0, 0]
