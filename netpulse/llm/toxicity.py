"""Toxicity by maximum-scoring segments.

Words of labelled texts get log-odds between toxic and clean texts with an
informative Dirichlet prior; words never seen fall back on their first letters.
A linear scan finds every maximal segment of positive total score, and the
extreme-value law of such maxima turns the segments of a text into one figure,
which a logistic curve fitted on labelled texts maps to a probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import SPACES, WORD, documents_of, ship_package, stage

# Labelled texts used to fit, at most; the curve is fitted on each half with the other half's words.
FIT_DOCUMENTS = 24_000
# Prior: pseudo-counts as a share of all counts; least log-odds and z of a word with weight; cost of a word without.
PRIOR_SHARE = 0.05
LEAST_LOG_ODDS = 1.5
LEAST_Z = 2.5
BACKGROUND = -0.05
HEAD_LETTERS = 4
THRESHOLD = 0.3
_WORDS = re.compile(WORD)
_PUNCTUATION = ".,;:!?\"'()[]{}<>*#%&$|/"


def words_of(text: str) -> list[str]:
    """Lower-case words, cut at white space and punctuation."""
    text = text.lower()
    for c in _PUNCTUATION:
        if c in text:
            text = text.replace(c, " ")
    return _WORDS.findall(text)


@dataclass
class Model:
    """Weights of words and of word beginnings, segment statistics and the curve."""

    words: dict[str, float] = field(default_factory=dict)
    heads: dict[str, float] = field(default_factory=dict)
    known: frozenset[str] = frozenset()
    decay: float = 1.0  # of the maximum's tail per score unit
    scale: float = 0.1  # expected high segments per word
    curve: tuple[float, float] = (-4.0, 1.0)


def segments(places: list[int], weights: list[float], background: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first place, last place, score), in linear time.

    ``places`` are the positions of words with positive weight; all words between
    them cost ``background`` each.  A candidate is joined with the last earlier one that
    begins at a smaller total, as long as that one's right total is smaller too.  Every
    segment remembers the last one before it that begins lower, so the search skips what
    can never be joined, and each segment is passed over once.
    """
    kept: list[tuple[int, int, float, float]] = []  # first, last, total before, total after
    lower: list[int] = []  # for each kept one: the last before it with a smaller total before
    total, before = 0.0, -1
    for place, weight in zip(places, weights):
        total += background * (place - before - 1)
        before = place
        left, right, first = total, total + weight, place
        total = right
        j = len(kept) - 1
        while j >= 0 and kept[j][2] >= left:
            j = lower[j]
        while j >= 0 and kept[j][3] < right:
            first, left, next_lower = kept[j][0], kept[j][2], lower[j]
            del kept[j:], lower[j:]
            j = next_lower
        kept.append((first, place, left, right))
        lower.append(j)
    return [(a, b, r - l) for a, b, l, r in kept]


def passages(text: str, model: Model) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of words, and the maximal scoring segments of a text by word position."""
    words = words_of(text)
    if not words:
        return 0, []
    weight, heads, known, n = model.words, model.heads, model.known, HEAD_LETTERS
    places, weights = [], []
    for i, w in enumerate(words):
        s = weight.get(w)
        if s is None and w[:n] in heads and w not in known:
            s = heads[w[:n]]
        if s is not None:
            places.append(i)
            weights.append(s)
    return len(words), segments(places, weights, BACKGROUND) if places else []


def evidence(n_words: int, found: list[tuple[int, int, float]], model: Model) -> float:
    """Sum over the significant segments of how far each exceeds chance (in nats)."""
    if not found:
        return 0.0
    chance = np.log(max(model.scale * n_words, 1e-9))
    return float(sum(max(0.0, model.decay * s - chance) for _, _, s in found))


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on log(1 + x), lightly penalised, by Newton steps."""
    z = np.stack([np.ones(len(x)), np.log1p(x)], 1)
    beta = np.array([-2.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -40, 40)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, z.T @ (y - p) - 1e-2 * (beta - np.array([-2.0, 1.0])))
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(beta[1], 1e-6))


def _decay(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(decay * score)) = 1: the tail rate of chance segments."""
    if not len(scores) or (scores * shares).sum() >= 0 or scores.max() <= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (shares * np.exp(high * scores)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (shares * np.exp(mid * scores)).sum() < 1 else (low, mid)
    return max(high, 1e-3)


def _log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds and z of each word under a Dirichlet prior proportional to its overall count."""
    prior, in_all = PRIOR_SHARE * (toxic + clean), PRIOR_SHARE * (n_toxic + n_clean) + 1
    a, b = toxic + prior, clean + prior
    odds = np.log(a / (n_toxic + in_all - a)) - np.log(b / (n_clean + in_all - b))
    return odds, odds / np.sqrt(1 / a + 1 / b)


def _contexts(texts: DataFrame) -> DataFrame:
    """(half, c, low, high): every pair of a word and the one before it, and the least and greatest label it stands under.

    A word counts once for each word that stands before it, not once per
    occurrence: copies repeat whole contexts, so a group of copies of any size
    weighs like one text.
    """
    lowered = F.translate(F.lower("text"), _PUNCTUATION, " " * len(_PUNCTUATION))
    listed = F.split(F.trim(F.regexp_replace(lowered, SPACES, " ")), " ")
    pairs = F.array_distinct(F.zip_with(listed, F.concat(F.array(F.lit("")), listed), lambda w, p: F.concat(p, F.lit(" "), w)))
    rows = texts.select("half", "toxic", F.explode(pairs).alias("c")).where("c IS NOT NULL")
    return rows.groupBy("half", "c").agg(F.min("toxic").alias("low"), F.max("toxic").alias("high"))


def _word_weights(contexts: DataFrame) -> Model:
    """Weights from ``_contexts`` of one half or of both."""
    rows = (
        contexts.groupBy("c").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .select(F.substring_index("c", " ", -1).alias("w"), F.col("high").alias("toxic"), (F.lit(1) - F.col("low")).alias("clean"))
        .where("w <> ''")
    )
    per_word = rows.groupBy("w").agg(F.sum("toxic").cast("double").alias("toxic"), F.sum("clean").cast("double").alias("clean"))

    def weights(counts: DataFrame, name: str) -> tuple[pd.DataFrame, float, float]:
        """The words that can pass the limits (rare or even words never do), and both totals."""
        totals = counts.agg(F.sum("toxic"), F.sum("clean")).first()
        n_toxic, n_clean = float(totals[0] or 0), float(totals[1] or 0)
        likely = counts.where((F.col("toxic") >= 2) & (F.col("toxic") * (n_clean + 1) > F.col("clean") * (n_toxic + 1)))
        frame = likely.select(name, "toxic", "clean").toPandas()
        odds, z = _log_odds(frame["toxic"].to_numpy(float), frame["clean"].to_numpy(float), n_toxic, n_clean)
        chosen = (odds >= LEAST_LOG_ODDS) & (z >= LEAST_Z)
        return frame.assign(odds=odds)[chosen], n_toxic, n_clean

    per_word = stage(per_word, "words")
    found, n_toxic, n_clean = weights(per_word, "w")
    by_head = (
        per_word.where(F.length("w") > HEAD_LETTERS).withColumn("h", F.substring("w", 1, HEAD_LETTERS))
        .groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    heads, _, _ = weights(by_head, "h")
    model = Model(dict(zip(found["w"], found["odds"])), dict(zip(heads["h"], heads["odds"])))
    # Words with these beginnings that are known and did not pass keep no weight.
    common = per_word.where((F.col("clean") >= 2) & (F.col("clean") > F.col("toxic"))).withColumn("h", F.substring("w", 1, HEAD_LETTERS))
    if model.heads:
        model.known = frozenset(r[0] for r in common.where(F.col("h").isin(*model.heads)).select("w").collect()) - model.words.keys()
    # Chance rate of each weight among clean words, for the extreme-value law.
    scores = np.array([BACKGROUND, *found["odds"]])
    shares = np.array([0.0, *((found["clean"] + 0.5) / max(n_clean, 1))])
    shares[0] = max(0.0, 1 - shares.sum())
    model.decay = _decay(scores, shares)
    model.scale = float(np.clip(shares[1:].sum(), 1e-6, 1))
    return model


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, bound: int = FIT_DOCUMENTS) -> Model:
    """Fit on at most ``bound`` labelled documents, chosen by a hash of their ids.

    ``labels`` holds doc_id and toxic (0/1); ``usable`` may restrict its rows.
    Without both kinds of labels the model finds nothing toxic.
    """
    ship_package(docs.sparkSession)
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    rows = rows.where(usable) if usable is not None else rows
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = rows.withColumn("h", F.xxhash64("doc_id", F.lit(11))).orderBy("h", "doc_id").limit(bound)
    texts = documents_of(docs).join(F.broadcast(chosen), "doc_id")
    texts = stage(texts.select("doc_id", "text", "toxic", F.pmod("h", F.lit(2)).alias("half")), "labelled")
    contexts = stage(_contexts(texts), "contexts")
    seen = []
    for half in (0, 1):
        other = _word_weights(contexts.where(F.col("half") != half))
        seen.append(_scan(texts.where(F.col("half") == half), other).select("toxic", "evidence").toPandas())
    model = _word_weights(contexts)
    y, x = (pd.concat(seen)[c].to_numpy(float) for c in ("toxic", "evidence"))
    if 0 < y.sum() < len(y):
        model.curve = _fit_curve(x, y)
    return model


def _scan(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (doc_id, text, toxic) without text, with evidence and n_passages, in Arrow batches."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for frame in frames:
            found = [passages(t, own) for t in frame["text"]]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].astype("Int64"), "toxic": frame["toxic"].astype("Int32"),
                "evidence": np.array([evidence(n, s, own) for n, s in found], float),
                "n_passages": np.array([len(s) for _, s in found], np.int64),
            })

    return rows.mapInPandas(work, "doc_id long, toxic int, evidence double, n_passages long")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, evidence and n_passages for every row of ``docs``.

    Null and empty texts have no words, hence no evidence and the lowest score;
    repeated rows and rows without id are scored like any other.
    """
    ship_package(docs.sparkSession)
    scanned = _scan(documents_of(docs).withColumn("toxic", F.lit(None).cast("int")), model)
    a, b = model.curve
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) + F.lit(b) * F.log1p("evidence"))))
    return scanned.select("doc_id", p.alias("score"), (p >= THRESHOLD).cast("int").alias("predicted"), "evidence", "n_passages")


def toxic_passages(docs: DataFrame, model: Model) -> DataFrame:
    """One row per maximal scoring segment: doc_id, first_word, last_word, score, significant."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for frame in frames:
            out = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                n, found = passages(text, own)
                out += [(doc_id, a, b, s, evidence(n, [(a, b, s)], own) > 0) for a, b, s in found]
            result = pd.DataFrame(out, columns=["doc_id", "first_word", "last_word", "score", "significant"])
            result["doc_id"] = result["doc_id"].astype("Int64")
            yield result

    return documents_of(docs).mapInPandas(work, "doc_id long, first_word long, last_word long, score double, significant boolean")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, all columns as they were."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def found(texts: pd.Series) -> pd.Series:
        own = sent.value
        return pd.Series([evidence(*passages(t or "", own), own) for t in texts], dtype=float)

    least = (np.log(THRESHOLD / (1 - THRESHOLD)) - model.curve[0]) / model.curve[1]
    return docs.where(F.log1p(found(F.col("text"))) < F.lit(float(least)))
