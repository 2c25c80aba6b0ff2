"""Maximum-scoring segments against their definition, linear time, and held-out precision and recall."""

import random
import time

import duckdb

from netpulse.llm import toxicity
from netpulse.llm.catalog import QUERIES


def defined(values, start=0):
    """The best segment, then the same left and right of it, while scores are positive."""
    best = max(((sum(values[i : j + 1]), i, j) for i in range(len(values)) for j in range(i, len(values))), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    score, i, j = best
    return [*defined(values[:i], start), (start + i, start + j, score), *defined(values[j + 1 :], start + j + 1)]


def test_segments_equal_their_definition():
    rng = random.Random(3)
    for _ in range(400):
        background = -rng.choice([0.01, 0.3, 1.0])
        values = [rng.uniform(0.1, 2) if rng.random() < 0.4 else background for _ in range(rng.randint(1, 30))]
        places = [i for i, v in enumerate(values) if v > 0]
        found = toxicity.segments(places, [values[i] for i in places], background)
        expected = defined(values)
        assert [f[:2] for f in found] == [e[:2] for e in expected]
        assert all(abs(f[2] - e[2]) < 1e-9 for f, e in zip(found, expected))


def test_segments_of_negative_weights_too():
    """Weights of either sign, as words with evidence for a clean text would have."""
    rng = random.Random(4)
    for _ in range(200):
        values = [rng.uniform(-1, 1) for _ in range(25)]
        places = [i for i, v in enumerate(values) if v > 0]
        expected = [e for e in defined([v if v > 0 else -0.4 for v in values])]
        found = toxicity.segments(places, [values[i] for i in places], -0.4)
        assert [f[:2] for f in found] == [e[:2] for e in expected]


def seconds(n, falling):
    """Isolated words that never join; with ``falling`` totals every earlier segment begins higher."""
    places = [i * (40 if falling else 3) for i in range(n)]
    began = time.perf_counter()
    assert len(toxicity.segments(places, [1.0] * n, -0.05 if falling else -5.0)) >= 1
    return time.perf_counter() - began


def test_segments_take_linear_time():
    for falling in (True, False):
        small, large = min(seconds(20_000, falling) for _ in range(3)), min(seconds(160_000, falling) for _ in range(3))
        assert large < 24 * small + 0.2


def test_held_out_precision_and_recall(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    marked = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf_dir}/labels.parquet'").fetchall())
    judged = [(marked[r.doc_id], r.predicted) for r in QUERIES["op6_toxicity"](spark, sf_dir).collect() if r.held_out and r.doc_id in marked]
    caught, all_toxic, flagged = sum(a * b for a, b in judged), sum(a for a, _ in judged), sum(b for _, b in judged)
    assert all_toxic >= 10 and caught >= 0.9 * all_toxic and caught >= 0.7 * flagged


def test_words_are_cut_alike_in_fit_and_score(spark):
    """White space of other scripts belongs to words on both sides; repeated contexts count once."""
    texts = [(0, 1, "Bad\u00a0word, bad\u00a0word bad\u00a0word!"), (1, 0, "")]
    contexts = toxicity._contexts(spark.createDataFrame(texts, "half int, toxic int, text string")).collect()
    assert sorted(r.c for r in contexts if r.half == 0) == [" bad\u00a0word", "bad\u00a0word bad\u00a0word"]
    assert toxicity.words_of(texts[0][2]) == ["bad\u00a0word"] * 3
