"""Document quality from a linear-chain conditional random field over lines.

Every non-blank line is a position with the states bad and good.  Its features
describe the line itself and its two neighbours; transitions tie neighbouring
lines together.  Lines have no labels of their own: they are latent, and a
document's label pulls its lines towards it by their share of the document's
bytes.  The field is fitted to the document labels, summed over all labelings of
the lines.  Forward-backward under either label gives each line's marginal
probability of good; both are weighted with the probability of the label, and a
document's quality is the mean over its lines, weighted by line length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import documents_of, ship_package, stage

# Labelled documents used to fit, at most, their lines in all, and lines of one; whole documents
# are taken, those beyond the bounds are left out of the fit.  Steps, step size and L2 penalty of the fit.
FIT_DOCUMENTS = 4_000
FIT_LINES, LONGEST = 200_000, 500
STEPS, RATE, PENALTY = 200, 0.1, 1e-3
THRESHOLD = 0.5
# Log-potential by which a document's label favours documents that are all of its kind.
PULL = 4.0

# Byte classes counted per line.
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".,;:", "mark": b"!?", "bar": b"|\t", "sign": b"#$%&*+-/<=>@\\^_`{}~[]()\"'"}
_LOOKUP = np.zeros(256, np.uint8)
for _k, _members in enumerate(_CLASSES.values(), 1):
    _LOOKUP[np.frombuffer(_members, np.uint8)] = _k
OWN_FEATURES = [*_CLASSES, "same_as_word_before", "repeated_words", "long_words", "short_words", "log_bytes", "few_words", "line_repeats"]
N_FEATURES = 3 * len(OWN_FEATURES) + 3


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights): a row per non-blank line, with the neighbours' features beside its own.

    A text without such lines is one empty line of weight 1.
    """
    lines = [x for x in text.split("\n") if x and not x.isspace()] or [""]
    coded = [x.encode("utf-8", "replace") for x in lines]
    sizes = np.array([len(x) for x in coded], float)
    classes = _LOOKUP[np.frombuffer(b"".join(coded), np.uint8)]
    line_of = np.repeat(np.arange(len(lines)), sizes.astype(np.int64))
    counts = np.bincount(line_of * 8 + classes, minlength=8 * len(lines)).reshape(-1, 8)[:, 1 : len(_CLASSES) + 1]
    often = Counter(lines)
    rest = np.empty((len(lines), 7))
    for i, line in enumerate(lines):
        words = line.split()
        n = max(1, len(words))
        rest[i] = (
            sum(map(eq, words, words[1:])) / n, 1 - len(set(words)) / n if words else 0.0, min(2.0, len(line) / n / 10),
            sum(len(w) <= 3 for w in words) / n, np.log1p(sizes[i]) / 6, float(n <= 3), float(often[line] > 1),
        )
    own = np.concatenate([counts / np.maximum(sizes, 1)[:, None], rest], 1)
    edge = np.zeros((1, own.shape[1]))
    before, after = np.concatenate([edge, own[:-1]]), np.concatenate([own[1:], edge])
    ends = np.zeros((len(lines), 3))
    ends[:, 0], ends[0, 1], ends[-1, 2] = 1, 1, 1
    return np.concatenate([own, before, after, ends], 1), np.maximum(sizes, 1)


@dataclass
class Field:
    """Weights of the good state's emission, and the log-potentials of transitions [from, to]."""

    weights: np.ndarray
    transitions: np.ndarray


def chain(emission: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, float]:
    """P(good) of each line of one document by forward-backward in odds form, and the log of the sum over all labelings."""
    n = len(emission)
    highest = float(transitions.max())
    t = np.exp(transitions - highest)
    bb, bg, gb, gg = t[0, 0], t[0, 1], t[1, 0], t[1, 1]
    odds = np.exp(np.clip(emission, -30, 30)).tolist()
    forward = [0.0] * n
    scales = np.empty(n)
    at = odds[0]
    forward[0] = at
    for i in range(1, n):
        bad = bb + at * gb
        scales[i] = bad
        at = odds[i] * (bg + at * gg) / bad
        forward[i] = at
    scales[0] = 1 + at
    out = np.empty(n)
    back = 1.0
    for i in range(n - 1, -1, -1):
        joint = forward[i] * back
        out[i] = joint / (1 + joint)
        step = odds[i] * back
        back = (gb + step * gg) / (bb + step * bg)
    return out, float(np.log(scales).sum()) + highest * (n - 1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def marginals(emission: np.ndarray, transitions: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """P(good) of each line of one document, over both labels of the document and all labelings of its lines."""
    pull = 2 * PULL * weight / weight.sum()
    if_good, log_good = chain(emission + pull, transitions)
    if_bad, log_bad = chain(emission - pull, transitions)
    good = _sigmoid(log_good - log_bad - 2 * PULL)
    return good * if_good + (1 - good) * if_bad


class _Chains:
    """Lines of many documents, worked on together, position by position; documents come longest first."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.n, self.longest = len(lengths), int(lengths.max())
        self.starts = np.concatenate([[0], np.cumsum(lengths[:-1])])
        self.alive = [int((lengths > t).sum()) for t in range(self.longest)]

    def forward(self, e: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Normalised log forward values per line, and the log sum over all labelings per document."""
        alpha, log_z = np.zeros((len(e), 2)), np.zeros(self.n)
        a = np.zeros((self.n, 2))
        for t in range(self.longest):
            rows = self.starts[: self.alive[t]] + t
            if t:
                p = a[: self.alive[t]]
                a = np.stack([np.logaddexp(p[:, 0] + trans[0, y], p[:, 1] + trans[1, y]) for y in (0, 1)], 1)
            a[:, 1] += e[rows]
            total = np.logaddexp(a[:, 0], a[:, 1])
            a -= total[:, None]
            log_z[: self.alive[t]] += total
            alpha[rows] = a
        return alpha, log_z

    def backward(self, e: np.ndarray, trans: np.ndarray, alpha: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) per line, and the expected transitions [from, to], documents weighing ``share``."""
        beta, pairs = np.zeros((len(e), 2)), np.zeros((2, 2))
        for t in range(self.longest - 2, -1, -1):
            rows = self.starts[: self.alive[t + 1]] + t
            after = beta[rows + 1].copy()
            after[:, 1] += e[rows + 1]
            joint = alpha[rows][:, :, None] + trans[None] + after[:, None, :]
            flat = joint.reshape(-1, 4)
            total = flat.max(1) + np.log(np.exp(flat - flat.max(1, keepdims=True)).sum(1))
            pairs += (np.exp(joint - total[:, None, None]) * share[: self.alive[t + 1], None, None]).sum(0)
            b = np.stack([np.logaddexp(trans[y, 0] + after[:, 0], trans[y, 1] + after[:, 1]) for y in (0, 1)], 1)
            beta[rows] = b - np.logaddexp(b[:, :1], b[:, 1:])
        both = alpha + beta
        return _sigmoid(both[:, 1] - both[:, 0]), pairs


def likelihood(theta: np.ndarray, x: np.ndarray, pull: np.ndarray, lengths: np.ndarray, good: np.ndarray, share: np.ndarray) -> tuple[float, np.ndarray]:
    """Log-likelihood of the documents' labels, weighing ``share``, and its gradient.

    ``theta`` ends in the four transitions; ``pull`` is a line's part in its
    document's label; ``lengths`` descend.
    """
    chains = _Chains(lengths)
    e, trans = x @ theta[:-4], theta[-4:].reshape(2, 2)
    alphas, logs = zip(*(chains.forward(e + sign * pull, trans) for sign in (1, -1)))
    margin = np.where(good == 1, 1, -1) * (logs[0] - logs[1] - 2 * PULL)
    # the label's own expectations less those over both labels
    coefficient = share * np.where(good == 1, 1, -1) * _sigmoid(-margin)
    of_line = np.repeat(coefficient, lengths)
    gradient = np.zeros(len(theta))
    for sign, alpha in zip((1, -1), alphas):
        p_good, pairs = chains.backward(e + sign * pull, trans, alpha, coefficient)
        gradient += sign * np.concatenate([x.T @ (of_line * p_good), pairs.ravel()])
    return float(-(share * np.logaddexp(0, -margin)).sum()), gradient


def fit_field(documents: list[np.ndarray], weights: list[np.ndarray], good: np.ndarray) -> Field:
    """Maximum penalised likelihood of the documents' labels, lines being latent.

    ``documents`` holds the features of each one's lines, ``weights`` their lengths.
    Both labels weigh alike, so that the commoner one does not decide alone.
    """
    order = np.argsort([-len(d) for d in documents], kind="stable")
    good = good[order]
    lengths = np.array([len(documents[i]) for i in order])
    x = np.concatenate([documents[i] for i in order])
    pull = 2 * PULL * np.concatenate([weights[i] / weights[i].sum() for i in order])
    centre, spread = x.mean(0), x.std(0) + 1e-6
    centre[-3:], spread[-3:] = 0, 1
    x = (x - centre) / spread
    share = np.where(good == 1, 0.5 / max(1, good.sum()), 0.5 / max(1, (1 - good).sum()))
    theta, m, v = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
    for step in range(1, STEPS + 1):
        gradient = likelihood(theta, x, pull, lengths, good, share)[1] - PENALTY * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    found = theta[:-4] / spread
    found[-3] -= (centre * found).sum()  # the constant feature takes up the centring
    return Field(found, theta[-4:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, bound: int = FIT_DOCUMENTS) -> Field:
    """Fit on at most ``bound`` labelled documents, chosen by a hash of their ids.

    ``labels`` holds doc_id and quality (0/1); of rows that repeat a doc_id the least
    label and text count.  Only the sample's line features reach the driver, at most
    ``FIT_LINES`` lines.  Without both kinds of labels every text scores 0.5.
    """
    ship_package(docs.sparkSession)
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("doc_id IS NOT NULL AND quality IS NOT NULL")
    rows = rows.where(usable) if usable is not None else rows
    rows = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = rows.withColumn("h", F.xxhash64("doc_id", F.lit(5))).orderBy("h", "doc_id").limit(bound)
    texts = documents_of(docs).join(F.broadcast(chosen), "doc_id").groupBy("h", "quality").agg(F.min("text").alias("text"))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [line_features(t) for t in frame["text"]]
            yield pd.DataFrame({
                "h": frame["h"].astype("int64"), "quality": frame["quality"].astype("int32"), "n": [len(w) for _, w in made],
                "lines": [x.astype("f4").tobytes() for x, _ in made], "weights": [w.astype("f8").tobytes() for _, w in made],
            })

    featured = stage(texts.mapInPandas(work, "h long, quality int, n long, lines binary, weights binary"), "lines").where(F.col("n") <= LONGEST)
    sizes = featured.select("h", "n").toPandas().sort_values("h")
    within = sizes["h"][sizes["n"].cumsum() <= FIT_LINES]
    found = featured.where(F.col("h") <= int(within.max())).toPandas().sort_values("h") if len(within) else sizes.assign(quality=0)
    good = found["quality"].to_numpy()
    if not len(good) or good.min() == good.max():
        return Field(np.zeros(N_FEATURES), np.zeros((2, 2)))
    documents = [np.frombuffer(b, "f4").reshape(-1, N_FEATURES).astype(float) for b in found["lines"]]
    return fit_field(documents, [np.frombuffer(b, "f8") for b in found["weights"]], good)


def score(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, score, predicted, n_lines and n_bad_lines for every row of ``docs``.

    Null counts as empty; an empty or blank text is scored as one empty line.
    Repeated rows and rows without id are scored like any other.
    """
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for frame in frames:
            scores, lines, bad = [], [], []
            for text in frame["text"]:
                x, weight = line_features(text)
                p = marginals(x @ own.weights, own.transitions, weight)
                scores.append(float(p @ weight / weight.sum()))
                lines.append(len(p))
                bad.append(int((p < 0.5).sum()))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": np.array(scores, float), "n_lines": np.array(lines, np.int64), "n_bad_lines": np.array(bad, np.int64)})

    scored = documents_of(docs).mapInPandas(work, "doc_id long, score double, n_lines long, n_bad_lines long")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def line_labels(docs: DataFrame, field: Field) -> DataFrame:
    """One row per non-blank line: doc_id, line (from 0), p_good and good."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for frame in frames:
            out = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                x, weight = line_features(text)
                p = marginals(x @ own.weights, own.transitions, weight)
                out += [(doc_id, i, q, q >= 0.5) for i, q in enumerate(p.tolist())]
            result = pd.DataFrame(out, columns=["doc_id", "line", "p_good", "good"])
            result["doc_id"] = result["doc_id"].astype("Int64")
            yield result

    return documents_of(docs).mapInPandas(work, "doc_id long, line int, p_good double, good boolean")
