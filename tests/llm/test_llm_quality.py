"""The conditional random field over lines: against sums over all labelings, and on documents of mixed lines."""

from itertools import product

import numpy as np
import pytest

from netpulse.llm import quality


def by_enumeration(emission, transitions, pull):
    """(P(document good), P(good) per line): every labeling of the lines under either label of the document."""
    total, good, lines = 0.0, 0.0, np.zeros(len(emission))
    for label in (1, -1):
        for y in product((0, 1), repeat=len(emission)):
            y = np.array(y)
            score = emission @ y + sum(transitions[a, b] for a, b in zip(y, y[1:])) + label * (pull * (2 * y - 1)).sum() / 2
            total += np.exp(score)
            good += np.exp(score) * (label == 1)
            lines += np.exp(score) * y
    return good / total, lines / total


@pytest.mark.parametrize("n", [1, 2, 3, 7])
def test_marginals(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        emission, transitions, weight = rng.normal(0, 2, n), rng.normal(0, 1, (2, 2)), rng.integers(1, 90, n).astype(float)
        _, expected = by_enumeration(emission, transitions, 2 * quality.PULL * weight / weight.sum())
        assert np.allclose(quality.marginals(emission, transitions, weight), expected, rtol=1e-9)


def test_likelihood_and_gradient():
    rng = np.random.default_rng(8)
    lengths, good = np.array([6, 4, 4, 1]), np.array([1, 0, 1, 0])
    share = np.array([0.3, 0.1, 0.4, 0.2])
    x, theta = rng.normal(0, 1, (15, 3)), rng.normal(0, 1, 7)
    weight = rng.integers(1, 90, 15).astype(float)
    cuts = np.cumsum(lengths)[:-1]
    pull = np.concatenate([2 * quality.PULL * w / w.sum() for w in np.split(weight, cuts)])
    value, gradient = quality.likelihood(theta, x, pull, lengths, good, share)
    expected = 0.0
    for rows, y, s in zip(np.split(np.arange(15), cuts), good, share):
        p, _ = by_enumeration(x[rows] @ theta[:3], theta[3:].reshape(2, 2), pull[rows])
        expected += s * np.log(p if y else 1 - p)
    assert np.isclose(value, expected, rtol=1e-9)
    for k in range(7):
        step = np.eye(7)[k] * 1e-5
        up, down = (quality.likelihood(theta + d, x, pull, lengths, good, share)[0] for d in (step, -step))
        assert np.isclose((up - down) / 2e-5, gradient[k], rtol=1e-5, atol=1e-9)


GOOD = "The committee met on the second floor and agreed that the old bridge should be repaired before winter."
BAD = "click click $$$ 9999 !!! buy | buy | buy 12345 >>>"


@pytest.fixture(scope="module")
def field(spark):
    """Fitted on documents of which most have lines of both kinds; only the documents are labelled."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(240):
        y = i % 2
        share = rng.uniform(0.65, 1.0) if y else rng.uniform(0, 0.35)
        lines = [GOOD[rng.integers(0, 9) :] if rng.random() < share else BAD[rng.integers(0, 9) :] * 2 for _ in range(rng.integers(6, 14))]
        rows.append((i, "\n".join(lines)))
        labels.append((i, y))
    return quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))


def test_lines_of_mixed_documents(spark, field):
    """Lines are told apart though no line had a label, and the document goes by the greater part of its bytes."""
    mixed = [GOOD] * 4 + [BAD * 2] * 2
    docs = spark.createDataFrame([(1, "\n".join(mixed)), (2, "\n".join([BAD * 2] * 4 + [GOOD] * 2))], "doc_id long, text string")
    lines = {(r.doc_id, r.line): r.good for r in quality.line_labels(docs, field).collect()}
    # a line between two kinds of neighbours may go either way
    assert all(lines[1, i] for i in range(3)) and not any(lines[2, i] for i in range(3))
    assert not lines[1, 5] and lines[2, 5]
    assert {r.doc_id: r.predicted for r in quality.score(docs, field).collect()} == {1: 1, 2: 0}


def test_odd_rows(spark, field):
    """Null, empty and blank texts are one empty line; a very long text and repeated rows score like any other."""
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, "\n".join([GOOD] * 20_000)), (5, GOOD), (5, GOOD), (None, GOOD)]
    scored = quality.score(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()
    empty = {r.score for r in scored if r.doc_id in (1, 2, 3)}
    assert len(scored) == len(rows) and len(empty) == 1 and all(0 <= r.score <= 1 for r in scored)
    assert len({r.score for r in scored if r.doc_id in (5, None)}) == 1
    assert next(r.predicted for r in scored if r.doc_id == 4) == 1


def test_fit_is_bounded(spark, monkeypatch):
    """Repeated ids, documents of too many lines and lines beyond the bound are left out; nothing left scores 0.5."""
    monkeypatch.setattr(quality, "LONGEST", 3)
    rows = [(1, GOOD), (1, BAD), (2, "\n".join([BAD] * 4)), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    only_long = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert not quality.fit(docs, only_long).weights.any()
    assert quality.fit(docs, spark.createDataFrame([(1, 1), (3, 0), (3, 1), (None, 1)], "doc_id long, quality int")).weights.any()
    monkeypatch.setattr(quality, "FIT_LINES", 0)
    empty = quality.fit(docs, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int"))
    assert [r.score for r in quality.score(docs, empty).collect()] == [0.5] * 4
