"""Logistic regression on hashed features: a bounded training sample, updates, and scores as sparse dot products."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.words import binary_rows, slices

# Features of texts: (feature ids below 2**BITS, text of each), one entry per occurrence.
FeatureFn = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
BITS = 20
# Features take many times the memory of a text, and training adds its counterfactual forms, so slices are small here.
TEXT_BYTES = 1 << 18

FOLDS = 5


@dataclass
class Features:
    """Sparse rows: ids[bounds[i]:bounds[i + 1]] with their values belong to text i."""

    ids: np.ndarray
    values: np.ndarray
    bounds: np.ndarray

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.bounds[i], self.bounds[i + 1]
        return self.ids[a:b], self.values[a:b]


def sparse_rows(ids: np.ndarray, text_of: np.ndarray, n_texts: int, binary: bool, used: np.ndarray | None = None) -> Features:
    """Distinct features per text with their values: 1, or the root of the feature's share of the text.

    `used` tells which ids have a weight; the others are left out of the rows, though they count in shares.
    """
    total = np.bincount(text_of, minlength=n_texts)
    if used is not None:
        keep = used[ids]
        ids, text_of = ids[keep], text_of[keep]
    key, count = np.unique((text_of.astype(np.int64) << BITS) | ids.astype(np.int64), return_counts=True)
    text = key >> BITS
    values = np.ones(len(key)) if binary else np.sqrt(count / total[text])
    return Features((key & ((1 << BITS) - 1)).astype(np.int32), values.astype(np.float32), np.searchsorted(text, np.arange(n_texts + 1)))


@dataclass
class Model:
    """A bias and the weights of 2**BITS hashed features (float32, so 4 MB whatever it was trained on)."""

    bias: float
    weights: np.ndarray
    binary: bool
    # Pairs of counterfactual forms that the training compared.
    n_pairs: int = 0


def held_out(key: str, remainder: int = 0):
    """True where crc32(key as text) mod 5 is `remainder`; false for null keys."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == remainder, F.lit(False))


def training_texts(
    docs: DataFrame, labels: DataFrame, label: str, sample_rows: int, key: str = "doc_id", text: str = "text", without: tuple[int, ...] = (0,)
) -> DataFrame:
    """(doc_id, label, text) of at most `sample_rows` labelled documents outside the held-out folds `without`.

    The sample is the documents with the smallest seeded hashes, so it is the same on each run. A document
    with several labels has the largest; of several texts with one id, the first in order counts.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    for remainder in without:
        usable = usable.where(~held_out(key, remainder))
    chosen = (
        usable.groupBy(F.col(key).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64("_id", F.lit(17)), "_id").limit(sample_rows)
    )
    # `chosen` holds at most sample_rows pairs of numbers, so it is sent to all tasks.
    found = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return found.groupBy("doc_id").agg(F.first("_label").alias("label"), F.min("text").alias("text"))


class FollowTheLeader:
    """Per-coordinate follow-the-regularised-leader updates with L1 and L2 penalties.

    The state of a feature is z (gradients so far, less the pull of earlier weights) and n (squared
    gradients); its weight follows from both in closed form and is 0 while |z| <= l1.
    """

    def __init__(self, alpha: float, beta: float, l1: float, l2: float) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)
        self.bias_z = self.bias_n = 0.0

    def weights(self, ids: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    @property
    def bias(self) -> float:
        return -self.bias_z / ((self.beta + self.bias_n**0.5) / self.alpha)

    def update(self, ids: np.ndarray, weights: np.ndarray, gradient: np.ndarray) -> None:
        n = self.n[ids]
        self.z[ids] += gradient - (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.alpha * weights
        self.n[ids] = n + gradient**2

    def update_bias(self, gradient: float) -> None:
        bias, n = self.bias, self.bias_n
        self.bias_z += gradient - ((n + gradient**2) ** 0.5 - n**0.5) / self.alpha * bias
        self.bias_n = n + gradient**2


Row = tuple[np.ndarray, np.ndarray]


def learn(
    rows: list[Row], labels: np.ndarray, changes: dict[int, list[Row]] | None = None, *,
    epochs: int, alpha: float, beta: float = 1.0, l1: float, l2: float = 1.0, penalty: float = 0.0, seed: int = 0,
) -> FollowTheLeader:
    """Logistic loss over the rows, plus `penalty` times the squared raw score of each change that belongs to a row.

    A change is the difference of the features of two counterfactual forms, so its raw score is the gap between theirs.
    """
    leader = FollowTheLeader(alpha, beta, l1, l2)
    changes = changes or {}
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            ids, values = rows[i]
            weights = leader.weights(ids)
            raw = float(weights @ values) + leader.bias
            error = 1.0 / (1.0 + np.exp(-np.clip(raw, -35, 35))) - labels[i]
            leader.update(ids, weights, error * values)
            leader.update_bias(error)
            for ids, change in changes.get(i, ()):
                weights = leader.weights(ids)
                leader.update(ids, weights, 2 * penalty * float(weights @ change) * change)
    return leader


def difference(one: Row, other: Row) -> Row:
    """The features in which two rows differ, and by how much."""
    ids = np.union1d(one[0], other[0])
    change = np.zeros(len(ids), np.float32)
    change[np.searchsorted(ids, one[0])] += one[1]
    change[np.searchsorted(ids, other[0])] -= other[1]
    return ids[change != 0].astype(np.int32), change[change != 0]


def _binary_lists(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """Each value of a binary column as an array over the column's own memory."""
    whole = column.combine_chunks()
    whole = whole.cast(pa.large_binary()) if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks).cast(pa.large_binary())
    _, offsets, data = whole.buffers()
    edges = np.frombuffer(offsets, np.int64)[whole.offset:whole.offset + len(whole) + 1].tolist()
    size = np.dtype(kind).itemsize
    return [np.frombuffer(data, kind, (b - a) // size, a) if b > a else np.zeros(0, kind) for a, b in zip(edges, edges[1:])]


def train(texts: DataFrame, features: FeatureFn, binary: bool, counterfactuals: Callable[[object, str], list[tuple[str | None, str]]] | None = None, **settings) -> Model:
    """A model of (doc_id, label, text); `counterfactuals` gives pairs of forms of a text, where None is the text itself.

    Features are worked out where the texts are; one task then runs the updates over the bounded sample and
    hands over nothing but the weights. That task holds sparse rows: 8 bytes for each distinct feature of a text, of
    which there are 2**BITS at most however long the text is, and the few features in which the forms of a pair differ.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=TEXT_BYTES):
                n, texts = part.num_rows, part.column(2)
                owner, place, sides, forms = list(range(n)), [0] * n, [], []
                if counterfactuals is not None:
                    for i, (key, text) in enumerate(zip(part.column(0).to_pylist(), texts.to_pylist(), strict=True)):
                        for k, pair in enumerate(counterfactuals(key, text), 1):
                            owner.append(i)
                            place.append(k)
                            sides.append([i if form is None else n + len(forms) + sum(f is not None for f in pair[:side]) for side, form in enumerate(pair)])
                            forms += [f for f in pair if f is not None]
                    texts = pa.concat_arrays([texts, pa.array(forms, pa.large_string())])
                f = sparse_rows(*features(texts), len(texts), binary)
                rows = [f.row(i) for i in range(n)] + [difference(f.row(a), f.row(b)) for a, b in sides]
                bounds = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in rows])])
                ids = np.concatenate([np.zeros(0, np.int32), *[r[0] for r in rows]])
                values = np.concatenate([np.zeros(0, np.float32), *[r[1] for r in rows]])
                at = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(place, pa.int32()), binary_rows(ids, bounds).cast(pa.binary()), binary_rows(values, bounds).cast(pa.binary())],
                    names=["doc_id", "label", "place", "ids", "values"],
                )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        order = np.asarray(pc.sort_indices(table.select(["doc_id", "place"]), sort_keys=[("doc_id", "ascending"), ("place", "ascending")]))
        all_ids, all_values = _binary_lists(table.column("ids"), np.int32), _binary_lists(table.column("values"), np.float32)
        places, found = table.column("place").to_numpy()[order], table.column("label").to_numpy()[order]
        rows, changes = [], {}
        for at, place in zip(order.tolist(), places.tolist(), strict=True):
            if place:
                changes.setdefault(len(rows) - 1, []).append((all_ids[at], all_values[at]))
            else:
                rows.append((all_ids[at], all_values[at]))
        leader = learn(rows, found[places == 0].astype(float), changes, **settings)
        weights = leader.weights().astype(np.float32)
        ids = np.flatnonzero(weights).astype(np.int32)
        yield pa.RecordBatch.from_pydict({"bias": [leader.bias], "ids": [ids.tobytes()], "values": [weights[ids].tobytes()], "n_pairs": [len(order) - len(rows)]})

    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, label int, place int, ids binary, values binary"
    sparse = texts.select("doc_id", "label", "text").mapInArrow(gather, schema)
    learned = sparse.repartition(1).mapInArrow(fit, "bias double, ids binary, values binary, n_pairs bigint").collect()
    model = Model(0.0, np.zeros(1 << BITS, np.float32), binary)
    for row in learned:  # one, or none if there is nothing to learn from
        model.bias, model.n_pairs = row.bias, row.n_pairs
        model.weights[np.frombuffer(row.ids, np.int32)] = np.frombuffer(row["values"], np.float32)
    return model


def raw_scores(texts: pa.Array, features: FeatureFn, model: Model) -> np.ndarray:
    used = model.weights != 0
    f = sparse_rows(*features(texts), len(texts), model.binary, used)
    text_of = np.repeat(np.arange(len(texts)), np.diff(f.bounds))
    return np.bincount(text_of, weights=model.weights[f.ids] * f.values, minlength=len(texts)) + model.bias


def scorer(spark: SparkSession, features: FeatureFn, model: Model) -> Callable[[Column], Column]:
    """The probability of label 1 as a function of a text column. Nothing but the text goes to Python.

    Null and empty texts get the score of the bias alone.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        whole = pa.RecordBatch.from_arrays([texts], names=["text"])
        raw = [raw_scores(part.column(0), features, shared.value) for part in slices(whole, most=TEXT_BYTES)]
        return pa.array(1.0 / (1.0 + np.exp(-np.concatenate([np.zeros(0), *raw]))))

    return scored


def score(docs: DataFrame, features: FeatureFn, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for each row; only these two columns are read."""
    rows = docs.select(F.col(key), F.col(text).alias("_body"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_body", TEXT_BYTES):
                raw = raw_scores(part.column(1), features, shared.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1.0 / (1.0 + np.exp(-raw)))], names=[key, "score"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, score double")
