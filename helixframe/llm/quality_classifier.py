"""Document quality from a linear-chain conditional random field over lines.

The field labels each line good or bad. A line's evidence is its own features and those of the lines before and after it
(zero beyond the document's ends), and neighbouring labels are tied by a transition matrix. It is trained like the field of
line_quality.py, on the same bounded sample of labelled rows (TRAIN_DOCS documents, TRAIN_CHAINS chains of their lines), of
those documents alone whose crc32(doc_id as text) mod FOLDS is not 0. Only text and the label are inputs of the training, and only text
of a score.

Every text is scored whole: forward and backward sums give each line's probability of being good, and the mean of these,
weighted by the lines' code points (and one for the line's end), is the document's share of good text. Since a bad document
may have many good lines, that share is not yet the probability of label 1: a logistic curve of two numbers, fitted to the shares of
the same labelled documents, turns it into the score. It rises with the share and keeps the order of documents.

Lines of an Arrow batch are scored together; a document of more than TOGETHER lines goes by itself, in time and memory that
grow with its lines.

Defined cases: null and empty texts are one empty line and get a score as well. Without labels every score is 0.5, and with labels
of one kind only it is (good + 1) / (labelled + 2). Repeated rows each get a row; a row without doc_id is not held out.
Columns other than doc_id and text (labels: doc_id, quality) are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .line_quality import TOGETHER, TRAIN_DOCS, _Chains, _marginals, batch_features, labelled_lines, line_lengths, train

FOLDS = 5
LEAST = 0.3
#: Texts whose lines are scored together.
BATCH = 256
#: Weight of the pull of the curve to the share itself.
STIFF = 1.0


@dataclass
class Classifier:
    """Feature weights (own, before, after), transitions, and the curve from shares to scores; without `weight` a constant."""

    weight: np.ndarray | None
    move: np.ndarray
    slope: float
    shift: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _neighbours(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows before and after each row inside its text; zero at the ends."""
    before, after = np.zeros_like(values), np.zeros_like(values)
    before[1:], after[:-1] = values[:-1], values[1:]
    ends = np.cumsum(counts)
    before[(ends - counts)[counts > 0]] = 0
    after[ends[counts > 0] - 1] = 0
    return before, after


def _evidence(features: np.ndarray, counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Scores (lines x 2) of own and neighbouring features."""
    own, before, after = np.split(weight, 3)
    return features @ own + _neighbours(features @ before, counts)[0] + _neighbours(features @ after, counts)[1]


def _long(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(good) of each line of one text: forward and backward sums, scaled line by line."""
    e = np.exp(scores - scores.max(1, keepdims=True)).tolist()
    (bb, bc), (cb, cc) = np.exp(move - move.max()).tolist()
    forward, (x, y) = [], e[0]
    x, y = x / (x + y), y / (x + y)
    forward.append((x, y))
    for eb, ec in e[1:]:
        x, y = (x * bb + y * cb) * eb, (x * bc + y * cc) * ec
        z = x + y
        x, y = x / z, y / z
        forward.append((x, y))
    out, u, v = [0.0] * len(e), 1.0, 1.0
    for k in range(len(e) - 1, -1, -1):
        x, y = forward[k][0] * u, forward[k][1] * v
        out[k] = y / (x + y)
        u, v = u * e[k][0], v * e[k][1]
        u, v = bb * u + bc * v, cb * u + cc * v
        z = u + v
        u, v = u / z, v / z
    return np.array(out)


def good_lines(scores: np.ndarray, counts: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(good) of every line of texts with `counts` lines each, from its scores."""
    out = np.empty(len(scores))
    starts = np.cumsum(counts) - counts
    for k in np.flatnonzero(counts > TOGETHER).tolist():
        out[starts[k] : starts[k] + counts[k]] = _long(scores[starts[k] : starts[k] + counts[k]], move)
    short = np.flatnonzero((counts <= TOGETHER) & (counts > 0))
    if len(short):
        sizes = counts[short]
        begins = np.cumsum(sizes) - sizes
        rows = np.repeat(starts[short] - begins, sizes) + np.arange(sizes.sum())
        chains = _Chains(begins, sizes)
        seq = np.empty(len(rows), np.int64)
        seq[np.concatenate(chains.at)] = np.concatenate([np.arange(len(a)) for a in chains.at])
        out[rows] = _marginals(scores[rows], move, chains, seq)[0][:, 1]
    return np.clip(out, 0, 1)


def shares(good: np.ndarray, chars: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each text's mean of its lines' probabilities, by their lengths."""
    of = np.repeat(np.arange(len(counts)), counts)
    return np.bincount(of, (chars + 1) * good, len(counts)) / np.maximum(np.bincount(of, chars + 1, len(counts)), 1)


def _logit(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.log(share / (1 - share))


def _curve(share: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve by Newton steps; pulled towards the identity, so that it ends on separable labels too."""
    x = np.stack([_logit(share), np.ones(len(share))], 1)
    at, home = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    loss = lambda w: np.logaddexp(0, (1 - 2 * label) * (x @ w)).sum() + STIFF / 2 * ((w - home) ** 2).sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + STIFF * np.eye(2), x.T @ (p - label) + STIFF * (at - home))
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(at[0], 1e-3)), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Classifier:
    """The classifier of at most `train_docs` labelled documents that are not held out."""
    features, n_words, chars, counts, y = labelled_lines(docs, labels.where(~held_out(F.col("doc_id"))), train_docs)
    if len(set(y.tolist())) < 2:
        rate = (y.sum() + 1) / (len(y) + 2)
        return Classifier(None, np.zeros((2, 2)), 1.0, float(np.log(rate / (1 - rate))))
    weight, move = train(np.hstack([features, *_neighbours(features, counts)]), n_words, counts, y)
    share = shares(good_lines(_evidence(features, counts, weight), counts, move), chars, counts)
    return Classifier(weight, move, *_curve(share, y))


def line_probabilities(texts: list[str | None], model: Classifier) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line of all texts, and the number of lines of each."""
    features, _, counts = batch_features(texts)
    if model.weight is None:
        return np.full(len(features), 0.5), counts
    return good_lines(_evidence(features, counts, model.weight), counts, model.move), counts


def text_scores(texts: list[str | None], model: Classifier) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, number of lines, and number of lines that are rather good than bad, of each text."""
    good, counts = line_probabilities(texts, model)
    share = shares(good, line_lengths(texts), counts)
    many = np.bincount(np.repeat(np.arange(len(counts)), counts), good >= 0.5, len(counts)).astype(np.int64)
    return 1 / (1 + np.exp(-np.clip(model.slope * _logit(share) + model.shift, -500, 500))), counts, many


def classify(docs: DataFrame, model: Classifier, least: float = LEAST) -> DataFrame:
    """doc_id, held_out, score, predicted, n_lines, n_good_lines; a row for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                score, lines, good = text_scores(batch.column(0).to_pylist(), model)
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(score), pa.array(lines), pa.array(good)], ["doc_id", "score", "n_lines", "n_good_lines"])

    fields = (("score", T.DoubleType()), ("n_lines", T.LongType()), ("n_good_lines", T.LongType()))
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, t) for n, t in fields)])
    scored = docs.select(F.col("text").cast("string"), "doc_id").mapInArrow(run, schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"), "n_lines", "n_good_lines")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, fit(docs, table(spark, sf_dir, "labels")))
