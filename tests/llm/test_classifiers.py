import random

import numpy as np
import pytest
from corpus import documents, table

from evenkeel.llm import quality, toxicity
from evenkeel.llm.labelled import in_fold, labelled_sample


def labelled(spark, n=400):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        text = " ".join(rng.choice(["river", "stone", "green", "walks", "under", "bridge", "evening"]) for _ in range(40))
        toxic, bad = i % 5 == 0, i % 4 == 0
        if toxic:
            text += " you idiot" if i % 2 else " such a moron"
        if bad:
            text = text.upper().replace(" ", "!!! ") if i % 3 else "### ".join(text.split())
        docs.append((i, text))
        labels.append((i, 1 - bad, int(toxic)))
    labels += [(None, 1, 1), (5, 1, 1), (9999, 0, 0), (7, None, None)]
    return table(spark, docs + documents(0)[:0]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: (q, t) for i, q, t in labels[:n]}


@pytest.mark.parametrize("name, column, folds, fold, threshold", [("toxicity", "toxic", 5, 0, 0.5), ("quality", "quality", 4, 2, 0.7)])
def test_held_out_accuracy(spark, name, column, folds, fold, threshold):
    docs, labels, truth = labelled(spark)
    held = in_fold("doc_id", folds, fold)
    sample = labelled_sample(docs, labels, column, ~held, 1000, "doc_id", "text")
    score = {"toxicity": toxicity.toxicity, "quality": quality.quality}[name]
    rows = score(docs, sample).select("doc_id", "score", held.alias("held")).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    test = [r for r in rows if r["held"]]
    right = sum((r["score"] >= threshold) == bool(truth[r["doc_id"]][column == "toxic"]) for r in test)
    assert right / len(test) > 0.95


@pytest.mark.parametrize("score, fit", [(toxicity.toxicity, "toxic"), (quality.quality, "quality")])
def test_odd_rows(spark, score, fit):
    docs, labels, _ = labelled(spark, 60)
    sample = labelled_sample(docs, labels, fit, ~in_fold("doc_id", 5, 0), 1000, "doc_id", "text")
    odd = table(spark, [(None, "x"), (1, None), (2, ""), (3, "a" * 100_000), (3, "a" * 100_000)])
    rows = score(odd, sample).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert score(odd.limit(0), sample).isEmpty()
    assert len({r["score"] for r in rows if r["doc_id"] == 3}) == 1
    none = labelled_sample(docs, labels.limit(0), fit, ~in_fold("doc_id", 5, 0), 1000, "doc_id", "text")
    assert all(r["score"] == pytest.approx(0, abs=1e-6) for r in score(odd, none).collect())


def test_the_sample_is_bounded_and_stable(spark):
    docs, labels, _ = labelled(spark)
    one = [r["__id"] for r in labelled_sample(docs, labels, "toxic", ~in_fold("doc_id", 5, 0), 50, "doc_id", "text").collect()]
    two = [r["__id"] for r in labelled_sample(docs.repartition(5), labels.repartition(5), "toxic", ~in_fold("doc_id", 5, 0), 50, "doc_id", "text").collect()]
    assert len(one) <= 50 and sorted(one) == sorted(two)


def test_toxic_documents_go_with_all_columns(spark):
    docs, labels, truth = labelled(spark)
    sample = labelled_sample(docs, labels, "toxic", ~in_fold("doc_id", 5, 0), 1000, "doc_id", "text")
    left = toxicity.without_toxic(docs, sample)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i, (_, t) in truth.items() if not t}


def test_votes_are_those_of_all_cosines(spark):
    docs, labels, _ = labelled(spark)
    sample = labelled_sample(docs, labels, "quality", ~in_fold("doc_id", 4, 2), 300, "doc_id", "text")
    model = quality.fit(sample)
    rows = quality.quality(docs, sample).orderBy("doc_id").limit(60).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        raw = np.frombuffer(texts[r["doc_id"]].encode(), np.uint8)
        v = model.project(quality.term_counts(raw, np.array([0, len(raw)])))[0]
        near = sorted(((float(v @ w), -i) for i, w in enumerate(model.vectors)), reverse=True)[: quality.NEIGHBOURS]
        weights = [max(s, 0) for s, _ in near]
        vote = sum(w * model.labels[-i] for w, (_, i) in zip(weights, near, strict=True)) / sum(weights)
        assert r["score"] == pytest.approx(vote, abs=1e-3), r["doc_id"]


def bins_by_hand(text):
    low = [32 if c.isspace() else ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in text]
    out = set()
    for n in toxicity.ORDERS:
        for at in range(len(low) - n + 1):
            h = 0
            for c in low[at : at + n]:
                h = (h * 0x100000001B3 + c + 1) % 2**64
            out.add((h + n) * 0x9E3779B97F4A7C15 % 2**64 >> (64 - toxicity.BITS))
    return out


def test_features_are_all_character_grams():
    texts = ["Straße ÄÖ\tu", "", "abc", "aaaaaaaa", "\U0001F600 grin \U0001F600 grin", "ab\ncd ef"]
    raw = b"".join(t.encode() for t in texts)
    offs = np.cumsum([0, *(len(t.encode()) for t in texts)])
    row, bins = toxicity.present(np.frombuffer(raw, np.uint8), offs)
    for i, t in enumerate(texts):
        assert set(bins[row == i]) == bins_by_hand(t) and (row == i).sum() == len(bins_by_hand(t)), t
    broken = np.frombuffer(b"ok\xff\xfeok and more", np.uint8)
    assert len(toxicity.present(broken, np.array([0, len(broken)]))[0]) > 0


def test_the_fit_is_the_least_of_its_loss():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(200, 12)), rng.integers(0, 2, 200)

    def value(w):
        z = x @ w
        p = 1 / (1 + np.exp(-z))
        return float((np.logaddexp(0, z) - y * z).sum() + 0.5 * w @ w), x.T @ (p - y) + w

    w = toxicity.minimise(value, np.zeros(12), 50)
    assert value(w)[0] <= min(value(w + d)[0] for d in rng.normal(0, 0.05, (200, 12))) + 1e-2


def test_the_sample_has_one_row_for_each_id(spark):
    docs = table(spark, [(1, f"text {i}") for i in range(500)] + [(2, "b"), (2, "b"), (3, None)])
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (2, 1, 1), (3, 1, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    rows = labelled_sample(docs, labels, "quality", ~in_fold("doc_id", 1000, 999), 10, "doc_id", "text").collect()
    assert sorted((r["__id"], r["label"]) for r in rows) == [(1, 1), (2, 0), (3, 1)]


def test_the_fit_is_bounded_by_bytes(spark):
    """Very long texts do not fill the task: they are passed over, and the rest is fitted as before."""
    docs, labels, _ = labelled(spark)
    sample = labelled_sample(docs, labels, "toxic", ~in_fold("doc_id", 5, 0), 1000, "doc_id", "text")
    plain = toxicity.fit(sample)
    more = sample.unionByName(spark.createDataFrame([(-1, "z" * 3_000_000, 1)], "__id long, text string, label int"))
    bounded = toxicity.fit(more, most_bytes=1 << 20)
    assert np.allclose(plain.weights, bounded.weights, atol=1e-5) and plain.base == pytest.approx(bounded.base)
    assert not np.allclose(plain.weights, toxicity.fit(sample, most_bytes=1 << 14).weights, atol=1e-5)


def test_words_are_weighed_by_the_labels(spark):
    """A word that only one label has sets texts apart; one that both have does not."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(30)) + (" telling" if i % 2 else " silence"), i % 2) for i in range(200)]
    raw = b"".join(t.encode() for _, t, _ in rows)
    offs = np.cumsum([0, *(len(t.encode()) for _, t, _ in rows)])
    x = quality._hellinger(quality.term_counts(np.frombuffer(raw, np.uint8), offs))
    labels = np.array([y for *_, y in rows])
    weights = quality.term_weights(x, labels)
    slot = lambda w: int(np.flatnonzero(quality.term_counts(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0, quality.TERMS :])[0])
    word = weights[quality.TERMS :]
    assert min(word[slot("telling")], word[slot("silence")]) > 5 * max(word[slot(w)] for w in ("alpha", "beta", "gamma"))
    assert not quality.term_weights(x, np.ones(len(x)))[quality.TERMS :].any()
    model = quality.fit(spark.createDataFrame(rows, "__id long, text string, label int"))
    test = np.frombuffer(b"alpha beta gamma alpha tellingalpha beta gamma alpha silence", np.uint8)
    good, bad = model.score(test, np.array([0, 30, 60]))
    assert good > 0.9 and bad < 0.1


def test_the_space_is_that_of_the_leading_directions(spark):
    """The fitted directions and vectors are those of a singular value decomposition of the weighted terms."""
    docs, labels, _ = labelled(spark, 120)
    rows = labelled_sample(docs, labels, "quality", ~in_fold("doc_id", 4, 2), 300, "doc_id", "text").orderBy("__id").collect()
    model = quality.fit(spark.createDataFrame(rows, "__id long, text string, label int"))
    raw = b"".join(r["text"].encode() for r in rows)
    offs = np.cumsum([0, *(len(r["text"].encode()) for r in rows)])
    x = quality._hellinger(quality.term_counts(np.frombuffer(raw, np.uint8), offs))
    own = np.array([r["label"] for r in rows])
    u, s, v = np.linalg.svd(x * quality.term_weights(x, own), full_matrices=False)
    k = 8  # the leading ones are well apart
    assert np.allclose(np.abs((model.directions[:, :k] * v[:k].T).sum(axis=0)), 1, atol=0.05)
    projected = (u * s)[:, : quality.DIMENSIONS]
    projected /= np.linalg.norm(projected, axis=1, keepdims=True)
    assert np.allclose(projected @ projected.T, model.vectors @ model.vectors.T, atol=0.05)
