"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the presence of hashed words, word pairs, and pairs with one word between. Per-coordinate rates let
rare words learn fast, L1 leaves few weights, which go to the tasks as a short sorted list. The model is
fitted on a sample of labelled rows that is bounded per class (``sample_per_class``, chosen by a
hash of the id); slope and bias of the score are then set on rows held back from the fit, each counted
as often as its class was thinned out. Every whole text is scored.

Defined cases: a null or empty text has no feature and gets the score of the bias; a null label is not learned;
several labels of one id count as toxic if any is; without labels all scores are 0; equal rows get equal
scores; texts of any length are scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.ftrl import Ftrl, sigmoid
from stagewise.llm.language import fold_of
from stagewise.llm.shared import Words, byte_class, flat_text, free_names, in_chunks, mix, read_table

DIMS = 1 << 20
SAMPLE_PER_CLASS = 6000
EPOCHS = 4
#: Features of fewer sampled documents only memorise them.
LEAST_DOCUMENTS = 3
#: Of the sample, the part that sets slope and bias of the final score.
HELD_BACK = 4

# Everything in ASCII that is no letter or digit, after lower-casing.
SEPARATORS = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all texts (with repeats) and the text that each is of."""
    words = Words(*flat_text(texts), SEPARATORS)
    hashes, text = words.hash, words.text
    parts, owners = [hashes], [text]
    for gap, salt in ((1, 0x51ED270B), (2, 0x2545F491)):
        if len(hashes) > gap:
            same = text[gap:] == text[:-gap]
            pair = mix(hashes[:-gap] * np.uint64(5) + hashes[gap:] + np.uint64(salt))
            parts.append(pair[same])
            owners.append(text[:-gap][same])
    index = (np.concatenate(parts) & np.uint64(DIMS - 1)).astype(np.int64)
    return index, np.concatenate(owners)


def _sparse(batches):
    for batch in in_chunks(batches, "text"):
        index, owner = features(batch.column("text"))
        pairs = np.unique(owner * DIMS + index)
        ends = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * DIMS)
        rows = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pairs % DIMS, pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), rows], ["toxic", "index"])


class ToxicityModel:
    """The weights that L1 left, and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.index = np.flatnonzero(weights)
        self.weight = weights[self.index]
        self.bias = bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        held = np.zeros(DIMS, bool)
        held[self.index] = True
        index, owner = features(texts)
        some = held[index]
        pairs = np.unique(owner[some] * DIMS + index[some])
        weight = self.weight[np.searchsorted(self.index, pairs % DIMS)]
        total = np.bincount(pairs // DIMS, weights=weight, minlength=len(texts))
        return sigmoid(total + self.bias)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    sample_per_class: int = SAMPLE_PER_CLASS,
    epochs: int = EPOCHS,
) -> ToxicityModel | None:
    """Learns from the documents that have a label; None if there are none."""
    marks = (
        labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.max(F.col(toxic).cast("int")).alias("toxic"))
    )
    sizes = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}  # a row per class
    if not sizes:
        return None
    rate = {c: min(1.0, sample_per_class / n) for c, n in sizes.items()}
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("toxic")), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("toxic") == 1, F.lit(rate.get(1, 0.0))).otherwise(F.lit(rate.get(0, 0.0)))
    # Bounded by the two class bounds, so the labels travel and the texts stay where they are.
    drawn = F.broadcast(marks.where(draw < share))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sample = own.join(drawn, F.col("doc_id") == F.col("id")).select("text", "toxic")
    rows = sample.mapInArrow(_sparse, "toxic int, index array<int>").toArrow()
    if not len(rows):
        return None
    labels_ = rows["toxic"].to_numpy()
    index = rows["index"].combine_chunks()
    ends = np.concatenate([[0], np.cumsum(index.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
    index = index.flatten().to_numpy()
    # Collected rows come in no fixed order: learn in the order of their content.
    mark = [int(index[a:z].astype(np.int64).sum()) for a, z in zip(ends, ends[1:], strict=False)]
    order = np.random.default_rng(11).permutation(np.lexsort([labels_, np.diff(ends), mark]))
    few = np.bincount(index, minlength=DIMS) < min(LEAST_DOCUMENTS, len(order))

    def row(k: int) -> np.ndarray:
        own = index[ends[k] : ends[k + 1]]
        return np.append(own[~few[own]], DIMS)

    held = order[: len(order) // HELD_BACK] if len(order) >= 40 * HELD_BACK else order[:0]
    model = Ftrl(DIMS + 1, 1, alpha=2.0, beta=1.0, l1=4.0, l2=0.1)
    for _ in range(epochs):
        for k in order[len(held) :]:
            i = row(k)
            model.step(i, np.ones(len(i)), labels_[k])
    weights = model.weights()[:, 0]
    logits = np.array([weights[row(k)].sum() for k in held])
    times = np.array([1 / rate[int(labels_[k])] for k in held])
    slope, bias = scaled(logits, labels_[held], times)
    return ToxicityModel(weights[:-1] * slope, float(weights[-1] * slope + bias))


def scaled(logits: np.ndarray, labels: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Slope and bias under which the held-back labels are likeliest, drawn a little to (1, 0)."""
    at = np.array([1.0, 0.0])
    if not len(logits):
        return 1.0, 0.0
    rows = np.stack([logits, np.ones_like(logits)], axis=1)
    for _ in range(60):
        chance = sigmoid(rows @ at)
        slant = rows.T @ (times * (chance - labels)) + 0.1 * (at - [1, 0])
        curve = (rows * (times * chance * (1 - chance))[:, None]).T @ rows + 0.1 * np.eye(2)
        move = np.linalg.solve(curve, slant)
        at = at - move / max(1.0, np.abs(move).max())
    return float(max(at[0], 0.1)), float(at[1])


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, *, text: str = "text", column: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` and the score of the whole text."""
    (column,) = free_names(docs, column)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # the weights L1 left
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]

    def run(batches):
        model = shipped.value
        for batch in in_chunks(batches, text):
            n = batch.num_rows
            scores = np.zeros(n) if model is None else model.scores(batch.column(text))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, column]
            )

    return docs.mapInArrow(run, ", ".join([*names, f"`{column}` double"]))


def op2_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit_toxicity(docs, labels.where(fold_of("doc_id", 5) != 0))
    held_out = (fold_of("doc_id", 5) == 0).alias("held_out")
    scored = score_toxicity(docs, model, column="score")
    return scored.select("doc_id", held_out, "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
