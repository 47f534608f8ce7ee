"""Chat formatting, top-k search, classifiers, components and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import MEDIUM, SMALL
from tests.llm import cases

import corpus_pipeline
from lakemart.llm import chat, knn, pii, quality_rules, weak_labels
from lakemart.llm.components import components
from lakemart.llm.tables import staged, table

TURN = "conv_id bigint, turn bigint, role string, text string, span string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], TURN)


def test_chat_round_trip(spark):
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", f"t{n} </turn> # \\") for n in range(70)]
    rows += [(2, None, None, None), (2, 0, "assistant", ""), (2, 0, "assistant", "")]
    rows += [(None, 1, "a: b", "x\n### user: y"), (3, 0, "assistant", "a" * 100_000)]
    formatted = chat.format_turns(turns(spark, rows)).cache()
    assert formatted.filter("rewritten").count() == 0
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for conv in (1, 2, 3, None):
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        said = [(r[2] or "", r[3] or "") for r in own]
        answers = "".join(t for role, t in said if role == "assistant")
        assert got[conv].turns_sha256 == cases.sha("".join(f"{a}\n{t}\n" for a, t in said))
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(answers), cases.sha(answers))
        assert got[conv].formatted_chars == len(chat.marked_turns(said))
    assert chat.format_turns(turns(spark, [])).count() == 0


def rewriting(said, opening=None):
    """Drops what was said before the last question."""
    asked = [i for i, (role, _) in enumerate(said) if role == "user"]
    kept = said[asked[-1] :] if asked else said
    return "<s>" + chat.marked_turns(kept, opening)


def prefixed(said, opening=None):
    return "<s>" + chat.marked_turns(said, opening)


def test_rewritten_history_is_found(spark):
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", f"t{n}") for n in range(4)]
    rows += [(2, 0, "user", "only")]
    found = chat.format_turns(turns(spark, rows), rewriting).collect()
    flags = {(r.conv_id, r.turn): (r.rewritten, r.span is None) for r in found}
    assert flags[1, 1] == (False, False) and flags[1, 2] == flags[1, 3] == (True, True)
    assert flags[2, 0] == (False, False)
    start = {r.span_start for r in chat.format_turns(turns(spark, rows), prefixed).collect()}
    assert min(start) == len("<s>")


def last_twenty(said, opening=None):
    return chat.marked_turns(said[-20:], opening)


def numbered(said, opening=None):
    """Numbers the turns, and names the first speaker in each."""
    first = said[0][0] if said else ""
    lines = [f"{n} of {first} {role}: {text}\n" for n, (role, text) in enumerate(said)]
    if opening is not None:
        lines.append(f"{len(said)} of {said[0][0] if said else opening} {opening}: ")
    return "".join(lines)


@chat.context_free
def wrongly_declared(said, opening=None):
    return last_twenty(said, opening)


def test_a_wrong_declaration_is_reported(spark, monkeypatch):
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", f"t{n}") for n in range(70)]
    found = chat.format_turns(turns(spark, rows), wrongly_declared).collect()
    broken = sorted(r.turn for r in found if r.rewritten)
    assert broken == [*range(31, 70)]  # seen when 32 turns are rendered
    assert not any(r.rewritten for r in chat.format_turns(turns(spark, rows)).collect())


def test_long_conversations_are_rendered_whole(spark):
    rows = [(1, n, "user" if n % 2 == 0 else "assistant", f"t{n}") for n in range(40)]
    said = [(role, text) for _, _, role, text in rows]
    found = chat.format_turns(turns(spark, rows), last_twenty).collect()
    assert [r.turn for r in sorted(found, key=lambda r: r.turn) if r.rewritten] == [*range(20, 40)]
    assert all((r.span is None) == r.rewritten for r in found)
    found = sorted(chat.format_turns(turns(spark, rows), numbered).collect(), key=lambda r: r.turn)
    assert not any(r.rewritten for r in found)
    assert "".join(r.span for r in found) == numbered(said)
    for r in found:
        masked = r.span[r.loss_start : r.loss_start + r.loss_length]
        assert masked == (f"t{r.turn}" if r.role == "assistant" else "")


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, cell string")


def plain_top(rows, k):
    usable = []
    for id_, vector, _ in rows:
        if id_ is not None and vector is not None and None not in vector:
            x = np.array(vector, np.float32).astype(float)
            if np.isfinite(x).all():
                usable.append((id_, np.pad(np.floor(64 * x), (0, 8 - len(x)))))
    out = []
    for id_, x in usable:
        if id_ % 20 == 0:
            scored = sorted((-int(x @ y), other) for other, y in usable if other != id_)
            out += [(id_, n, o, -s) for n, (s, o) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("k,pivots", [(5, 4), (400, 4), (3, 64), (1, 1)])
def test_top_k(spark, k, pivots, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(knn, "QUERY_ROWS", 3)
    made = random.Random(k)
    centres = [[made.gauss(0, 3) for _ in range(8)] for _ in range(5)]
    rows = []
    for i in range(200):
        centre = centres[i % 5]
        rows.append((i, [c + made.gauss(0, 0.2) for c in centre], "x"))
    rows += [(300 + i, [1.0] * 8, "x") for i in range(60)]
    rows += [(400, None, "x"), (401, [None] * 8, "x"), (402, [float("nan")] * 8, "x")]
    rows += [(None, [1.0] * 8, "x"), (420, [], "x"), (440, [0.5], "x")]
    rows += [(460, [float("inf")] * 8, "x")]
    found = knn.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, k, pivots=pivots)
    assert sorted(tuple(r) for r in found.collect()) == plain_top(rows, k)


def test_rows_that_share_an_id_have_lists_of_their_own(spark):
    made = random.Random(9)
    rows = [(i, [made.gauss(0, 1) for _ in range(4)], "x") for i in range(1, 40)]
    rows += [(20, [5.0, 0.0, 0.0, 0.0], "x"), (20, [0.0, -5.0, 0.0, 0.0], "x")]
    rows += [(40, rows[3][1], "x")] * 2 + [(40, rows[5][1], "x")]
    found = knn.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, 5, pivots=3)
    assert sorted(tuple(r) for r in found.collect()) == plain_top(rows, 5)
    assert found.filter("query_id = 20").count() == found.filter("query_id = 40").count() == 15


def test_top_k_of_nothing(spark):
    assert knn.top_k(vectors(spark, []), F.lit(True)).count() == 0
    assert knn.top_k(vectors(spark, [(20, None, "x")]), F.lit(True)).count() == 0
    assert knn.top_k(vectors(spark, [(20, [1.0], "x")]), F.lit(True)).count() == 0


def test_cells_are_left_out(spark):
    pivots = np.array([[100, 0], [-100, 0], [0, 100]])
    data = [(0, 50, 1.0), (1, 50, 1.0), (2, 50, 1.0)]
    assert [(a, b) for a, b, _ in knn.needed_cells(pivots, data, [(0, 5, 1.0)], 20)] == [(0, 0)]


def test_components(spark):
    made = random.Random(3)
    edges = [(made.randrange(300), made.randrange(300)) for _ in range(170)]
    edges += [(1000 + i, 1001 + i) for i in range(64)] + [(5, 5)]
    label = {n: n for e in edges for n in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    want = {n: c for n, c in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in found} == want and len(found) == len(want)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rules_are_learned(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    judged = quality_rules.quality(docs, labels).join(labels, "doc_id")
    bad, good = judged.filter("quality = 0"), judged.filter("quality = 1")
    assert bad.filter("kept").count() <= 0.1 * bad.count()
    passed = good.filter("NOT base_failed")
    assert passed.filter("kept").count() >= 0.99 * passed.count()
    assert judged.filter("rule IS NOT NULL AND NOT base_failed").count() > 0


def test_rules_without_labels(spark):
    docs = cases.documents(spark, cases.awkward())
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    judged = quality_rules.quality(docs, none)
    assert judged.filter("rule IS NOT NULL").count() == 0
    assert judged.count() == len(cases.awkward())
    one = spark.createDataFrame([(4, 1, 0), (6, None, 0), (None, 0, 0)], none.schema)
    assert quality_rules.learn(quality_rules.labelled_statistics(docs, one)) == []
    clash = cases.documents(spark, cases.awkward(), "n_words kept bad")
    assert quality_rules.keep_good(clash, none).columns == clash.columns


def test_weak_labels(spark):
    docs, labels = table(spark, MEDIUM, "documents"), table(spark, MEDIUM, "labels")
    judged = weak_labels.classify(docs).join(labels, "doc_id").collect()
    right = sum((r.quality == 1) == r.kept for r in judged)
    assert right >= 0.97 * len(judged)
    assert all(r.kept for r in judged if r.quality == 1 and r.posterior > 0.99)


def test_weak_labels_of_awkward_documents(spark):
    rows = weak_labels.classify(cases.documents(spark, cases.awkward(), "label features")).collect()
    assert len(rows) == len(cases.awkward())
    assert all(0 <= r.score <= 1 and 0 < r.posterior < 1 for r in rows)
    assert weak_labels.classify(cases.documents(spark, [])).count() == 0


def test_accuracies_are_recovered(spark):
    made = random.Random(1)
    chance = dict(zip(weak_labels.LABELLERS, [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.95, 0.9]))
    rows = []
    for _ in range(8000):
        true = int(made.random() < 0.7)
        votes = (true if made.random() < c else 1 - true for c in chance.values())
        rows.append(tuple(v if made.random() < 0.7 else None for v in votes))
    schema = ", ".join(f"`vote_{n}` int" for n in chance)
    found = weak_labels.estimate(spark.createDataFrame(rows, schema))
    assert abs(found.good - 0.7) < 0.05
    assert all(abs(found.right[n] - c) < 0.05 for n, c in chance.items())


def plain_accuracies(votes, rounds=weak_labels.ROUNDS):
    """Expectation-maximisation document by document; None is no vote."""
    names = len(votes[0])
    good, right = 0.8, [0.9] * names

    def chance(row):
        sides = []
        for truth in (0, 1):
            p = good if truth else 1 - good
            for k, vote in enumerate(row):
                if vote is not None:
                    p *= right[k] if vote == truth else 1 - right[k]
            sides.append(p)
        return sides[1] / sum(sides)

    for _ in range(rounds):
        share = [chance(row) for row in votes]
        good = (sum(share) + 8) / (len(votes) + 10)
        fresh = []
        for k in range(names):
            cast = [(row[k], p) for row, p in zip(votes, share) if row[k] is not None]
            agreed = sum(p if vote else 1 - p for vote, p in cast)
            fresh.append(min(max((agreed + 9) / (len(cast) + 10), 0.5), 0.999))
        right = fresh
    return good, right, [chance(row) for row in votes]


def plain_scorer(features, posterior, rounds=400):
    """Logistic regression by gradient descent on soft labels; its scores."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 4 * (x.T @ (p - posterior)) / len(x)
    return 1 / (1 + np.exp(-x @ w))


def test_weak_labels_equal_a_plain_fit(spark):
    docs = table(spark, SMALL, "documents")
    names = [f"vote_{n}" for n in weak_labels.LABELLERS]
    votes = weak_labels.voted(docs).select("doc_id", *names).collect()
    good, right, chances = plain_accuracies([tuple(r)[1:] for r in votes])
    found = weak_labels.estimate(weak_labels.voted(docs))
    assert found.good == pytest.approx(good, rel=1e-6)
    assert [*found.right.values()] == pytest.approx(right, rel=1e-6)
    judged = {r.doc_id: r for r in weak_labels.classify(docs).collect()}
    for row, chance in zip(votes, chances):
        assert judged[row.doc_id].posterior == pytest.approx(chance, rel=1e-5)
    hashed = weak_labels.hashed(docs.select("doc_id", "text")).collect()
    features = np.array([r.features.toArray() for r in hashed])
    posterior = np.array([judged[r.doc_id].posterior for r in hashed])
    plain = plain_scorer(features, posterior) >= 0.5
    agree = sum(judged[r.doc_id].kept == k for r, k in zip(hashed, plain))
    assert agree >= 0.98 * len(hashed)


def test_trees_are_compiled(spark):
    tree = ["If (feature 0 <= 1.5)", " Predict: -1.0", "Else (feature 0 > 1.5)"]
    tree += [" If (feature 1 <= 0.0)", "  Predict: 0.25", " Else (feature 1 > 0.0)", "  Predict: 2"]
    sql = pii.compile_tree(list(tree))
    rows = spark.createDataFrame([([1.0, 0.0],), ([2.0, 0.0],), ([2.0, 1.0],)], "f array<double>")
    got = [r[0] for r in rows.select(F.struct("f").alias("c")).select(F.expr(sql)).collect()]
    assert got == [-1.0, 0.25, 2.0]


def test_pipeline(spark):
    docs = table(spark, SMALL, "documents")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules"
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SMALL), "test-stage")
        assert docs.columns == names
        assert docs.filter("n_chars <> length(text)").count() == 0
        now = docs.count()
        assert now <= before and (now == before or name in ("quality rules", "near duplicates"))
        before = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == before
    assert packed.agg(F.sum("length")).first()[0] == (
        packed.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
    )


def test_pipeline_of_awkward_documents(spark):
    docs = cases.documents(spark, cases.awkward(), "kept spans2 label")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = staged(stage(spark, docs, SMALL), "test-stage")
        assert after.columns == docs.columns
        docs = after
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()
    docs = cases.documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
