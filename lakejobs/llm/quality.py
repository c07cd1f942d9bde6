"""Quality scores by positive-unlabelled learning.

Trusted positives (texts labelled good) and unlabelled texts of the corpus are all that
is learned from; texts labelled bad are not used. The share of good texts among the
unlabelled ones is estimated first, and an additive model of binned text measures
then minimises the non-negative unbiased risk, so its score is the probability that
a text is good.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import without
from lakejobs.llm.toxicity import learns

#: Bounds of the samples the model is fitted on; everything else reads all rows.
SAMPLE_POSITIVE, SAMPLE_UNLABELLED = 6000, 12_000
#: Ridge of the fits that only estimate the prior: they need no sharp scores.
SEPARATE_L2 = 2e-4
#: Rows of each side in a step of the fit.
BATCH = 2000
#: Bins of a measure, words of a window, and the score from which a text is good.
BINS, WINDOW, GOOD = 12, 50, 0.3

#: Classes of characters; the marks of ASCII have one each.
CLASSES = ["lower", "upper", "letter", "digit", "blank", "line", "other", *"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]
#: Classes by which neighbours are counted: letters small, large and without case, digits, blanks, line ends, all else.
GROUPS = 7


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    marks = {c: 7 + i for i, c in enumerate(CLASSES[7:])}
    table = np.full(0x10000, 6, dtype=np.uint8)
    for code in range(0x10000):
        c = chr(code)
        kind = unicodedata.category(c)
        if c in marks:
            table[code] = marks[c]
        elif c in "\n\r\x0b\x0c":
            table[code] = 5
        elif c == "\t" or kind == "Zs":
            table[code] = 4
        elif kind == "Nd":
            table[code] = 3
        elif kind[0] == "L" or kind[0] == "M":
            table[code] = {"Ll": 0, "Lu": 1}.get(kind, 2)
    return table


NAMES = [*CLASSES, *(f"{a}>{b}" for a in range(GROUPS) for b in range(GROUPS)), "chars", "words", "word length", "same as before",
         "distinct in a window", "distinct", "distinct pairs", "distinct lines", "line length", "most frequent word", "words without a letter"]


def measures(text: str | None) -> np.ndarray:
    """Measures of a whole text, in the order of ``NAMES``; a text without a character has zeros."""
    out = np.zeros(len(NAMES))
    if not text:
        return out
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _class_table()[np.minimum(codes, 0xFFFF)]
    out[:len(CLASSES)] = np.bincount(kinds, minlength=len(CLASSES)) / len(kinds)
    group = np.minimum(kinds, GROUPS - 1).astype(np.int64)
    at = len(CLASSES)
    if len(group) > 1:
        out[at:at + GROUPS * GROUPS] = np.bincount(group[:-1] * GROUPS + group[1:], minlength=GROUPS * GROUPS) / (len(group) - 1)
    at += GROUPS * GROUPS
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n = len(words)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    windows = [len(set(words[i:i + WINDOW])) / len(words[i:i + WINDOW]) for i in range(0, n, WINDOW)]
    # The last window may be short: it counts by its words.
    weights = [min(WINDOW, n - i) for i in range(0, n, WINDOW)]
    out[at:] = (
        np.log1p(len(text)), np.log1p(n), len(text) / (n + 1), sum(map(eq, words, words[1:])) / max(1, n - 1),
        np.average(windows, weights=weights) if n else 0, len(counts) / n if n else 0,
        len(set(zip(words, words[1:]))) / (n - 1) if n > 1 else 1, len(set(lines)) / len(lines) if lines else 0,
        np.log1p(len(text) / (len(lines) + 1)), max(counts.values()) / n if n else 0,
        sum(not any(map(str.isalpha, w)) for w in counts) / max(1, len(counts)))
    return out


@dataclass
class Model:
    """Additive model: bin borders and a weight for each bin of each measure."""

    edges: np.ndarray
    weights: np.ndarray
    constant: float
    prior: float
    #: Shares of the corpus by which ``prior`` was found, for reports.
    found: dict = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Bin numbers of rows of measures: the borders a value has reached."""
        return np.stack([np.searchsorted(self.edges[j], x[:, j], side="right") for j in range(x.shape[1])], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.constant + _sum(self.weights, self.bins(x)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sum(weights: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return weights[np.arange(bins.shape[1]), bins].sum(axis=1)


def _borders(x: np.ndarray) -> np.ndarray:
    """Quantiles of each measure as borders; equal ones are moved to infinity, so their bins stay empty."""
    edges = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T.copy()
    # Rare values at both ends are where bad texts are: finer there.
    ends = np.quantile(x, [0.005, 0.02, 0.98, 0.995], axis=0).T
    edges = np.sort(np.concatenate((edges, ends), axis=1), axis=1)
    for row in edges:
        row[1:][row[1:] == row[:-1]] = np.inf
    return np.sort(edges, axis=1)


def _adam(gradient, shape: tuple[int, int], steps: int, rate: float) -> tuple[np.ndarray, float]:
    """Minimise by Adam with a falling rate; ``gradient`` maps (weights, constant) to the slopes of both."""
    theta = np.zeros(shape[0] * shape[1] + 1)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, steps + 1):
        slope, of_constant = gradient(theta[:-1].reshape(shape), theta[-1])
        g = np.append(slope.ravel(), of_constant)
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        theta -= rate * (1 - (turn - 1) / steps) * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    return theta[:-1].reshape(shape), float(theta[-1])


def _slope(bins: np.ndarray, pull: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Sum of ``pull`` over the rows of each bin of each measure."""
    flat = (bins + np.arange(shape[0]) * shape[1]).ravel()
    return np.bincount(flat, np.repeat(pull, shape[0]), shape[0] * shape[1]).reshape(shape)


def _separate(p: np.ndarray, u: np.ndarray, shape: tuple[int, int], l2: float, steps: int, rate: float):
    """Plain logistic fit of positives against unlabelled rows, each side with half of the weight."""
    def gradient(w, b):
        pull_p = (_sigmoid(b + _sum(w, p)) - 1) / (2 * len(p))
        pull_u = _sigmoid(b + _sum(w, u)) / (2 * len(u))
        return _slope(p, pull_p, shape) + _slope(u, pull_u, shape) + l2 * w, pull_p.sum() + pull_u.sum()

    return _adam(gradient, shape, steps, rate)


def estimate_prior(of_positive: np.ndarray, of_unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """Share of positives among unlabelled rows from scores of rows the scorer was not fitted on.

    Above any threshold the unlabelled share is at least the prior times the positive
    share, with equality where no bad row scores that high; the threshold is chosen where
    the ratio with its sampling error is smallest.
    """
    p, u = np.sort(of_positive), np.sort(of_unlabelled)
    at = np.unique(np.concatenate((p, u)))
    above_p = 1 - np.searchsorted(p, at, side="left") / len(p)
    above_u = 1 - np.searchsorted(u, at, side="left") / len(u)
    # Hardly any positive lies above: nothing can be said there.
    some = above_p >= min(0.5, 10 / len(p))
    error = np.sqrt(np.log(4 / confidence) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = np.argmin((above_u[some] + error) / above_p[some])
    return float(np.clip(above_u[some][best] / above_p[some][best], 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 800, rate: float = 0.1, l2: float = 3e-5, prior: float | None = None,
          seed: int = 0) -> Model:
    """Fit the additive model on measures of trusted positives and of unlabelled texts.

    Risk: ``prior * E_p[loss(+)] + max(0, E_u[loss(-)] - prior * E_p[loss(-)])`` with the
    logistic loss, in seeded batches. Where the second part of a batch falls below zero its
    gradient is followed upwards, so that the model doesn't fit the sample by it.
    """
    both = np.concatenate((positive, unlabelled))
    if not len(positive) or not len(unlabelled):
        edges = np.full((len(NAMES), BINS + 3), np.inf)
        return Model(edges, np.zeros((len(NAMES), BINS + 4)), 0.0, 0.5)
    edges = _borders(both)
    shape = (edges.shape[0], edges.shape[1] + 1)
    model = Model(edges, np.zeros(shape), 0.0, 0.5)
    p, u = model.bins(positive), model.bins(unlabelled)
    if prior is None:
        # Scores of each half by the fit of the other.
        parts = []
        for half in (0, 1):
            w, b = _separate(p[half::2], u[half::2], shape, SEPARATE_L2, 150, 0.05) if len(p) > 1 and len(u) > 1 else (model.weights, 0.0)
            parts.append((_sum(w, p[1 - half::2]) + b, _sum(w, u[1 - half::2]) + b))
        shares = [estimate_prior(a, b) for a, b in parts if len(a) and len(b)]
        prior = float(np.mean(shares)) if shares else 0.5
    model.prior = prior

    drawn = np.random.default_rng(seed)

    def gradient(w, b):
        some_p, some_u = (x[drawn.integers(0, len(x), min(BATCH, len(x)))] for x in (p, u))
        z_p, z_u = b + _sum(w, some_p), b + _sum(w, some_u)
        negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        less_p, more_u = -prior * _sigmoid(z_p) / len(some_p), _sigmoid(z_u) / len(some_u)
        if negative < 0:
            pull_p, pull_u = -less_p, -more_u
        else:
            pull_p, pull_u = prior * (_sigmoid(z_p) - 1) / len(some_p) + less_p, more_u
        return _slope(some_p, pull_p, shape) + _slope(some_u, pull_u, shape) + l2 * w, pull_p.sum() + pull_u.sum()

    model.weights, model.constant = _adam(gradient, shape, steps, rate)
    model.found = {"positive": len(positive), "unlabelled": len(unlabelled)}
    return model


def _measured(rows: DataFrame) -> DataFrame:
    """(text_hash, positive, measures) of (text_hash, positive, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measures(t.as_py()).tolist() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))], names=["text_hash", "positive", "measures"])

    return rows.select("text_hash", "positive", "text").mapInArrow(run, "text_hash long, positive boolean, measures array<double>")


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        sample_positive: int = SAMPLE_POSITIVE, sample_unlabelled: int = SAMPLE_UNLABELLED, seed: int = 0) -> Model:
    """Train on samples of about these sizes, picked by seeded hashes: labelled keys, and texts of the corpus.

    Equal texts are drawn together and count once. Only rows that may be learned from
    (``toxicity.learns``) are read; a key with several labels is good if one of them is.
    Texts are measured in the tasks, so the driver gets a fixed number of figures
    for a text, however long it is.
    """
    good = labels.where((F.col(label) == 1) & F.col(key).isNotNull()).select(F.col(key).alias("label_key")).distinct().where(learns(F.col("label_key")))
    n_good = good.count()
    drawn = lambda c: F.pmod(F.xxhash64(F.lit(seed), c), F.lit(1_000_003)) / F.lit(1_000_003.0)
    picked = good.where(drawn(F.col("label_key")) < min(1.0, sample_positive / max(1, n_good)))
    rows = docs.select(F.col(key).alias("row_key"), F.col(text).alias("text")).where(learns(F.col("row_key"))).withColumn("text_hash", F.xxhash64("text"))
    distinct = rows.agg(F.approx_count_distinct("text_hash", 0.02)).first()[0]
    # The samples are bounded, so the keys can be sent to all tasks.
    marked = rows.join(F.broadcast(picked.withColumn("positive", F.lit(True))), F.col("row_key") == F.col("label_key"), "left")
    unlabelled = drawn(F.col("text_hash")) < min(1.0, sample_unlabelled / max(1, distinct))
    wanted = marked.withColumn("unlabelled", unlabelled).where("positive OR unlabelled").withColumn("positive", F.explode(
        F.filter(F.array(F.when(F.col("positive"), True), F.when(F.col("unlabelled"), False)), lambda x: x.isNotNull())))
    once = wanted.groupBy("text_hash", "positive").agg(F.min("text").alias("text"))
    found = _measured(once).orderBy("text_hash", "positive").toArrow()
    x = np.array(found["measures"].to_pylist(), dtype=float).reshape(-1, len(NAMES))
    positive = np.array(found["positive"].to_pylist(), dtype=bool)
    return train(x[positive], x[~positive])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (probability of a good text) and ``predicted`` (1 from 0.3).

    Null and empty texts get the score of a text without characters; columns named
    like the new ones are replaced; repeated rows get equal scores; very long texts
    are read whole; an empty table gives no rows.
    """
    docs = without(docs, "score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([measures(t.as_py()) for t in batch.column(names.index(text))])
            scores = shared.value.scores(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= GOOD).astype(np.int32))], names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, f"{columns}, score double, predicted int")
