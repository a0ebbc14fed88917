"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, pairs of neighbouring words and pairs with one word
between, hashed to ``2**bits`` coordinates. Training keeps a learning rate for each coordinate
and sets most weights to zero (L1), so that the model is a short sorted table that goes to all
executors. Every text is scored as a whole.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelore.llm.storage import stage, temporaries
from pagelore.llm.texthash import (
    ALNUM,
    PART_BYTES,
    joined_hashes,
    mix,
    slices,
    span_hashes,
    text_bytes,
    words,
)

BITS = 22
#: Training takes about this many labelled texts at most, chosen by the hash of their id, and
#: all features of each. One task learns from them, as each step needs the one before. Scoring
#: has no such limit.
SAMPLE_ROWS = 20_000
#: Passes over the sample, whatever its size.
PASSES = 8
THRESHOLD = 0.3
#: Weights are worked out for so many coordinates at a time.
WEIGHT_BLOCK = 1 << 18


def features(column: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, coordinate) of all words, pairs and skip-pairs, repeats included."""
    data, offsets = text_bytes(pc.utf8_lower(pc.fill_null(column, "")))
    starts, ends, first = words(data, offsets, ALNUM)
    h = span_hashes(data, starts, ends)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at, of = [mix(h)], [text]
    for gap in (1, 2):
        if len(h) > gap:
            same = text[gap:] == text[:-gap]
            at.append(joined_hashes([h[:-gap], h[gap:]], gap)[same])
            of.append(text[gap:][same])
    return np.concatenate(of), (np.concatenate(at) >> np.uint64(64 - bits)).astype(np.int64)


def _distinct(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pair = np.unique((text << 32) | at)
    return pair >> 32, pair & 0xFFFFFFFF


class Ftrl:
    """FTRL-proximal for logistic regression on sets of coordinates; the last one is the bias."""

    def __init__(
        self, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 5.0, l2: float = 0.1
    ):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        steps = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / steps)

    def learn(self, at: np.ndarray, label: float) -> None:
        """One step of every coordinate in ``at``, each at its own rate."""
        w = self.weights(at)
        g = float(_sigmoid(w.sum())) - label
        n = self.n[at]
        grown = n + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[at] = grown


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Model:
    """The coordinates that have a weight, their weights, and the bias."""

    def __init__(self, at: np.ndarray, weights: np.ndarray, bias: float, bits: int = BITS):
        self.at, self.weights, self.bias, self.bits = at, weights, bias, bits

    @property
    def knows_nothing(self) -> bool:
        """Whether no weight was learned, so that every text scores 0.5."""
        return not len(self.at) and not self.bias

    def table(self) -> np.ndarray:
        """Weights of all coordinates, for quick lookups inside a task."""
        dense = np.zeros(1 << self.bits, dtype=np.float32)
        dense[self.at] = self.weights
        return dense

    def scores(self, column: pa.Array, table: np.ndarray) -> np.ndarray:
        """Probability that a text is toxic; texts without words, null ones too, have the bias
        alone."""
        text, at = features(column, self.bits)
        hit = table[at] != 0
        text, at = _distinct(text[hit], at[hit])
        added = np.bincount(text, weights=table[at].astype(np.float64), minlength=len(column))
        return _sigmoid(self.bias + added)


def learned(batches: Iterator[pa.RecordBatch], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """The coordinates that have a weight after all passes over (doc_id, label, at), and the weights.

    Rows stay in the batches that hold them; beside them there is the state only.
    """
    rows = []
    for batch in batches:
        edges = batch.column(2).offsets.to_numpy()
        at = batch.column(2).values.to_numpy()
        labels = batch.column(1).to_numpy()
        rows += [(at[edges[i] : edges[i + 1]], label) for i, label in enumerate(labels)]
    state = Ftrl((1 << bits) + 1)
    for _ in range(PASSES):
        for at, label in rows:
            state.learn(np.append(at, np.int32(1 << bits)), label)
    found, weights = [], []
    for start in range(0, len(state.z), WEIGHT_BLOCK):
        some = state.weights(slice(start, start + WEIGHT_BLOCK))
        hit = np.flatnonzero(some)
        found.append(start + hit)
        weights.append(some[hit])
    return np.concatenate(found), np.concatenate(weights)


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None,
    sample_rows: int = SAMPLE_ROWS, bits: int = BITS,
) -> Model:
    """Learn from the documents that ``labels`` (doc_id, toxic) marks.

    ``usable`` is a condition on doc_id that training rows must meet. Rows without an id or
    label are left out; a document with several labels is toxic if one says so. Without any
    labelled text the model scores everything 0.5.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and toxic is not null")
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max(F.col("toxic").cast("double")).alias("label")
    )
    n = known.count()
    share = min(1.0, sample_rows / max(n, 1))
    chosen = known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # The sample's labels are bounded by sample_rows, so they go to the documents.
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("label_id")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, PART_BYTES):
                text, at = _distinct(*features(part.column(1), bits))
                edges = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(edges, pa.array(at.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), lists], ["doc_id", "label", "at"]
                )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, weights = learned(batches, bits)
        yield pa.RecordBatch.from_pydict({"at": at, "weight": weights})

    rows = texts.select("doc_id", "text", "label").mapInArrow(
        extract, "doc_id long, label double, at array<int>"
    )
    order = F.xxhash64("doc_id", F.lit(1))
    with temporaries(spark):
        sampled = stage(rows, "toxicity-sample")
        ordered = sampled.repartition(1).sortWithinPartitions(order, F.xxhash64("at"))
        # At most one row for each coordinate; L1 leaves a few thousand.
        weights = ordered.mapInArrow(train, "at long, weight double").collect()
    bias = sum(r["weight"] for r in weights if r["at"] == 1 << bits)
    pairs = sorted((r["at"], r["weight"]) for r in weights if r["at"] != 1 << bits)
    at = np.array([a for a, _ in pairs], dtype=np.int64)
    return Model(at, np.array([w for _, w in pairs], dtype=np.float64), bias, bits)


def with_score(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    """The columns in ``keep`` and the score of each row's whole text, one row a row."""
    rest = [c for c in keep if c != name]
    kept = docs.select(*rest).schema
    needed = rest if "text" in rest else [*rest, "text"]
    at = needed.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.table()
        for batch in batches:
            for part in slices(batch, at, PART_BYTES):
                columns = [part.column(i) for i in range(len(rest))]
                values = pa.array(model.scores(part.column(at), table))
                yield pa.RecordBatch.from_arrays([*columns, values], [*rest, name])

    return docs.select(*needed).mapInArrow(score, kept.add(name, "double"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
