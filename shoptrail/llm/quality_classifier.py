"""Quality classifier: random-indexing word vectors, pooled per text, and a two-layer network.

Terms (a word's letters, its symbols, its shape) have fixed sparse random index vectors. A term's
vector is its own index vector and, of unit length, the sum of those that stand around it in the
sample. A text's features are the mean of its words' vectors, that mean's length, the share of words that
repeat the one before, and the logarithm of its length. The network's logit is divided by a temperature fitted
on rows that the weights were not fitted on.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import cache
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import per_text, ship_code, stage

TERMS = 1 << 13
WIDTH = 64
#: Labelled rows used for fitting, at most. They are drawn by a hash of their id.
FIT_ROWS = 6000
FIT_PARTITIONS = 8
#: The network gives no weight to a fold of one in this many fit rows; the temperature is fitted there.
CALIBRATION_FOLD = 6
KNOWN = 250_000
_BLOCK = 1 << 15
_RUNS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def index_vectors(seed: int = 7) -> np.ndarray:
    """Four entries of +1 or -1 for each term."""
    rng = np.random.default_rng(seed)
    out = np.zeros((TERMS, WIDTH), np.float32)
    for column in range(4):
        out[np.arange(TERMS), rng.integers(0, WIDTH, TERMS)] += rng.choice([-0.5, 0.5], TERMS)
    return out


def terms_of(word: str) -> list[int]:
    """Hashed terms of a word: each run of letters, digits or symbols, and the word's shape."""
    if word.isalpha():
        found = [zlib.crc32(word.lower().encode()) % TERMS]
        rest = word[1:]
        shape = "a" if rest.islower() else "A" if rest.isupper() else "Aa" if rest else ""
    else:
        found = [zlib.crc32(run.lower().encode()) % TERMS for run in _RUNS.findall(word)]
        shape = "".join(sorted({"A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else "-" for c in word[1:]}))
    found.append(_shape_term(shape, min(len(word), 20) // 4))
    return found


@cache
def _shape_term(shape: str, length: int) -> int:
    return zlib.crc32(f"shape {shape} {length}".encode()) % TERMS


class WordVectors:
    """Rows of a matrix that holds the vectors of the words met so far; starts again when full."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.rows = np.zeros((KNOWN, vectors.shape[1]), np.float32)
        self.place: dict[str, int] = {}

    def _learn(self, words: list[str]) -> None:
        terms = [terms_of(w) for w in words]
        begins = np.cumsum([0, *map(len, terms[:-1])])
        at = len(self.place)
        self.rows[at : at + len(words)] = np.add.reduceat(self.vectors[list(chain.from_iterable(terms))], begins)
        self.place.update(zip(words, range(at, at + len(words)), strict=True))

    def mean(self, words: list[str]) -> np.ndarray:
        total = np.zeros(self.rows.shape[1], np.float64)
        for at in range(0, len(words), _BLOCK):
            part = words[at : at + _BLOCK]
            if new := list({*part}.difference(self.place)):
                if len(self.place) + len(new) > KNOWN:
                    self.place.clear()
                    new = list({*part})
                self._learn(new)
            total += self.rows[list(map(self.place.__getitem__, part))].sum(0)
        return total / max(1, len(words))

    def features(self, text: str) -> np.ndarray:
        words = text.split()
        mean = self.mean(words)
        again = sum(map(eq, words, words[1:])) / max(1, len(words))
        return np.concatenate([mean, [np.sqrt((mean**2).sum()), again, np.log1p(len(words))]])


@dataclass
class Model:
    """Vectors, standardisation, the two layers and the temperature."""

    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        inner = np.tanh((features - self.mean) / self.scale @ self.hidden + self.hidden_bias)
        return inner @ self.out + self.out_bias

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -50, 50)))


def fit_network(vectors: np.ndarray, features: np.ndarray, labels: np.ndarray, fold: np.ndarray, units: int = 24, rounds: int = 400, seed: int = 7) -> Model:
    """Adam on the logistic loss with weight decay; the temperature by search on ``fold``.

    With one class only (or no rows) the network is flat and gives that class's share, smoothed.
    """
    width = vectors.shape[1] + 3
    base = (labels.sum() + 1) / (len(labels) + 2)
    flat = Model(vectors, np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(base / (1 - base))), 1.0)
    train = ~fold if 0 < labels[~fold].sum() < (~fold).sum() else np.ones(len(labels), bool)
    if not 0 < labels.sum() < len(labels):
        return flat
    x, y = features[train], labels[train].astype(float)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z, rng = (x - mean) / scale, np.random.default_rng(seed)
    weights = [rng.normal(0, 1 / np.sqrt(width), (width, units)), np.zeros(units), rng.normal(0, 1 / np.sqrt(units), units), np.array(np.log(base / (1 - base)))]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, rounds + 1):
        inner = np.tanh(z @ weights[0] + weights[1])
        error = (1 / (1 + np.exp(-np.clip(inner @ weights[2] + weights[3], -50, 50))) - y) / len(y)
        back = np.outer(error, weights[2]) * (1 - inner**2)
        slopes = [z.T @ back + 1e-3 * weights[0] / width, back.sum(0), inner.T @ error + 1e-3 * weights[2] / units, error.sum()]
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope**2
            weights[i] = weights[i] - 0.02 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    model = Model(vectors, mean, scale, *weights[:3], float(weights[3]), 1.0)
    held = fold if fold.any() else train
    logits, truth = model.logits(features[held]), labels[held]

    def loss(temperature: float) -> float:
        signed = np.clip(logits / temperature * (2 * truth - 1), -500, 500)
        return float(np.log1p(np.exp(-signed)).mean())

    model.temperature = min(np.geomspace(0.25, 8, 61), key=loss)
    return model


def fold_of(id_column: str) -> Column:
    """The id's fold; rows of fold 0 are held out."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5


def _context_sums(sample: DataFrame, text: str) -> np.ndarray:
    """Sum over the sample of the index vectors that stand next to each term."""
    ship_code(sample.sparkSession)

    def run(batches):
        index = index_vectors()
        sums = np.zeros((TERMS, WIDTH), np.float32)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                before: list[int] = []
                for word in (value or "").split():
                    terms = terms_of(word)
                    if before:
                        sums[terms] += index[before].sum(0)
                        sums[before] += index[terms].sum(0)
                    before = terms
        yield pa.RecordBatch.from_pydict({"sums": [sums.tobytes()]})

    total = np.zeros((TERMS, WIDTH), np.float64)
    for row in sample.select(text).mapInArrow(run, "sums binary").collect():  # FIT_PARTITIONS rows
        total += np.frombuffer(row["sums"], np.float32).reshape(TERMS, WIDTH)
    return total


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text: str = "text", rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` labelled rows outside fold 0, drawn by a hash of their id.

    Labels other than 0 and 1 and null ids are left out; an id labelled twice counts as its largest label.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & (fold_of(id_column) != 0))
    drawn = known.groupBy(id_column).agg(F.max(label).cast("int").alias("__label")).orderBy(F.xxhash64(id_column), id_column).limit(rows)
    # at most ``rows`` small rows, so they may be broadcast
    sample = docs.select(id_column, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text")).join(F.broadcast(drawn), id_column)
    sample = sample.groupBy(id_column).agg(F.first("__label").alias("__label"), F.min("__text").alias("__text"))
    # few tasks, as each sends its sums to the driver
    sample = stage(sample, "quality-sample").coalesce(FIT_PARTITIONS)

    index = index_vectors()
    sums = _context_sums(sample, "__text")
    length = np.sqrt((sums**2).sum(1, keepdims=True))
    vectors = (index + sums / np.maximum(length, 1e-9)).astype(np.float32)

    def make():
        own = WordVectors(vectors)
        return lambda texts: {"features": [own.features(t) for t in texts]}

    found = per_text(sample, [id_column, "__label"], "__text", make, "features array<double>").collect()  # at most ``rows``
    found.sort(key=lambda r: r[id_column])
    features = np.array([r["features"] for r in found]).reshape(len(found), WIDTH + 3)
    truth = np.array([r["__label"] for r in found], int)
    fold = np.array([zlib.crc32(f"calibrate {r[id_column]}".encode()) % CALIBRATION_FOLD == 0 for r in found], bool)
    return fit_network(vectors, features, truth, fold)


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """``keep`` and the score as ``name``, the calibrated probability of label 1, for each row of ``docs``.

    Null and empty texts are scored as texts without words. Only the text is looked at. The model's
    size does not depend on the data; it is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def make():
        own = Model(**shared.value)
        words = WordVectors(own.vectors)
        return lambda texts: {name: own.probabilities(np.array([words.features(t) for t in texts]))}

    return per_text(docs, keep, text, make, f"{name} double")
