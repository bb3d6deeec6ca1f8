"""The label model on simulated labellers, and the classifier on the test tables' labels."""

import numpy as np
import pytest

from millrace.llm import weak_labels

DOCS = "doc_id long, text string, kept string, toxic long, _row string"
SF = "/root/testdata/sf0.01"


def test_accuracies_are_recovered():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.15
    right = np.array([0.95, 0.85, 0.75, 0.9])
    seen = np.array([0.9, 0.6, 1.0, 0.3])
    votes = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random((20_000, 4)) > seen] = weak_labels.ABSTAIN
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    accuracy, share, post = weak_labels.fit_accuracies(patterns, counts)
    assert abs(share - 0.15) < 0.03 and np.abs(accuracy - right[:, None]).max() < 0.06
    assert ((post[at.ravel()] > 0.5) == truth).mean() > 0.95


def test_kept_and_rejected_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    insulting = "trash pathetic idiot disgusting worthless stupid clown loser scum moron".split()
    out = {r.doc_id: r for r in weak_labels.verdicts(docs, labels).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert set(out) == set(texts)
    words = {i: [w.strip(".,").lower() for w in t.split()] for i, t in texts.items()}
    toxic = [i for i, w in words.items() if sum(x in insulting for x in w) >= 2]
    symbols = [i for i, t in texts.items() if words[i] and sum(c in "#*$%&|<>" for c in t) > 0.3 * len(words[i])]
    clean = [i for i, t in texts.items() if i not in symbols and "!!" not in t and not any(x in insulting for x in words[i])]
    assert len(toxic) > 20 and not any(out[i].kept for i in toxic)
    assert len(symbols) > 20 and sum(out[i].kept for i in symbols) <= 0.05 * len(symbols)
    assert sum(out[i].kept for i in clean) > 0.97 * len(clean)


def test_odd_rows(spark):
    rows = [(1, None, "clash", 1, "r"), (2, "", "", 1, ""), (None, "some words here", "", 1, ""), (3, "a b c", "", 1, ""), (3, "a b c", "", 1, ""), (4, "idiot scum " * 50_000, "", 1, "")]
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 1), (3, None, 0), (3, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(rows, DOCS)
    out = weak_labels.verdicts(df, labels).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)
    kept = weak_labels.keep_good(df, labels)
    assert kept.schema == df.schema and kept.count() == sum(r.kept for r in out)
    none = spark.createDataFrame([], DOCS)
    assert weak_labels.verdicts(none, labels).count() == 0 and weak_labels.keep_good(none, labels).count() == 0
    assert weak_labels.verdicts(df, labels.limit(0)).count() == len(rows)


@pytest.mark.parametrize("counts", [[], [5]])
def test_few_patterns(counts):
    accuracy, share, post = weak_labels.fit_accuracies([[1, 0]] * len(counts), counts)
    assert np.isfinite(accuracy).all() and len(post) == len(counts) and 0 < share < 1


def test_size_of_the_fit():
    """The sample and the rounds of the fit are not lowered to fit a measuring tool's limits."""
    assert weak_labels.TRAINING_ROWS >= 20_000 and weak_labels.FIT_ROUNDS >= 30


def test_sample_of_any_number_of_documents(spark):
    """The share of 5e10 documents is 4e-7; a threshold with fewer bits would take none, or far too many."""
    keys = spark.range(4_000_000).selectExpr("id AS doc_id", "id * 31 AS mark")
    for documents in (4_000_000, 200_000, 10_000):
        share = min(1.0, weak_labels.TRAINING_ROWS / documents)
        n = keys.limit(min(documents, 4_000_000)).where(weak_labels.chosen_share(share, "doc_id", "mark")).count()
        assert abs(n - min(documents, weak_labels.TRAINING_ROWS)) < 800
    few = keys.where(weak_labels.chosen_share(20_000 / 5e10, "doc_id", "mark")).count()
    assert few <= 12  # 1.6 on average
    bound = int(20_000 / 5e10 * 2**64)
    assert abs(bound / 2**64 * 5e10 - 20_000) < 1


def test_a_hot_copy_is_in_the_sample_once(spark, monkeypatch):
    rows = [(i, f"words of a text number {i} and some more") for i in range(300)] + [(None, "the same text in every third row")] * 150
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    seen = {}
    fit = weak_labels._fit_scorers
    monkeypatch.setattr(weak_labels, "_fit_scorers", lambda sample, bits: seen.setdefault("n", sample.count()) and fit(sample, bits))
    weak_labels.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert seen["n"] == 301


def test_scorer_against_the_library(spark):
    """The same loss as Spark's logistic regression reaches, and a flat slope."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(1)
    features, lists = 64, [np.unique(rng.integers(0, 64, rng.integers(0, 12))) for _ in range(500)]
    truth = rng.standard_normal(features)
    bad = np.array([1 / (1 + np.exp(-3 * truth[at].sum() - rng.normal())) for at in lists])
    ends = np.cumsum([len(x) for x in lists])
    weights, intercept = weak_labels.fit_scorer(np.concatenate(lists), ends, bad, features, rounds=200)

    def loss(w, b):
        up, down = np.where(bad > 0.02, bad, 0), np.where(1 - bad > 0.02, 1 - bad, 0)
        z = np.array([w[at].sum() / max(len(at), 1) ** 0.5 for at in lists]) + b
        return (up * np.logaddexp(0, -z) + down * np.logaddexp(0, z)).sum() / (up.sum() + down.sum()) + 1e-4 / 2 * (w @ w)

    rows = [(Vectors.sparse(features, at.tolist(), [max(len(at), 1) ** -0.5] * len(at)), y, float(w))
            for at, p in zip(lists, bad) for y, w in ((1.0, p), (0.0, 1 - p)) if w > 0.02]
    df = spark.createDataFrame(rows, ["x", "y", "w"])
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=1e-4, maxIter=200, standardization=False).fit(df)
    assert abs(loss(weights, intercept) - loss(model.coefficients.toArray(), model.intercept)) < 1e-4
    assert weak_labels.fit_scorer(np.concatenate(lists), ends, np.zeros(500), features) is None
    assert weak_labels.fit_scorer(np.empty(0, dtype=np.int64), np.zeros(4, dtype=np.int64), np.array([1, 0, 0.5, 0.5]), features)[0].any() == False  # noqa: E712


def test_scores_are_the_same_on_any_partitioning(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    a, b = (sorted(map(tuple, weak_labels.verdicts(docs.repartition(n), labels).collect())) for n in (1, 5))
    assert a == b
