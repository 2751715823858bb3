"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies of hashed 1- to 3-grams are counted over every training text. The classifier is
fitted by follow-the-regularised-leader with an elastic-net penalty on a sample of the training rows that
is bounded per language (``sample_per_language``, chosen by a hash of the id), then its temperature
is set on rows held back from the fit. Every whole text is scored; its logits are the mean over its
n-grams of IDF times weight, so no text is cut and memory per task is a few chunks.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any training
row all are ``und``; a null label is not learned; equal rows get equal results; texts of
any length are scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewise.llm.ftrl import Ftrl, softmax, temperature
from stagewise.llm.shared import flat_text, in_chunks, read_table

DIMS = 1 << 15
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 1500
EPOCHS = 3
#: Of the sample, the part that sets the temperature.
HELD_BACK = 5
UNKNOWN = "und"

_SEEDS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def _fold() -> np.ndarray:
    """Code points below 0x250: lower case, everything but letters as a space."""
    table = np.arange(0x250, dtype=np.uint32)
    for c in range(0x250):
        small = chr(c).lower()
        table[c] = ord(small) if chr(c).isalpha() and len(small) == 1 else c if chr(c).isalpha() else 32
    return table


FOLD = _fold()


def grams(data: np.ndarray, begins: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each order the features of all texts one after the other, and where each text begins."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=leads[1:])
    places = leads[begins]
    folded = np.where(points < 0x250, FOLD[np.minimum(points, 0x24F)], points)
    features, starts = [], []
    n = len(folded)
    doc_end = np.repeat(places[1:], np.diff(places))
    rolled = np.zeros(n, np.uint32)
    for order in ORDERS:
        seed = _SEEDS[(order - 1) % len(_SEEDS)]
        rolled = (rolled[: n - order + 1] * np.uint32(0x01000193)) ^ folded[order - 1 :]
        mixed = (rolled ^ (rolled >> np.uint32(15))) * seed
        inside = np.flatnonzero(np.arange(len(rolled)) + order <= doc_end[: len(rolled)]) if order > 1 else None
        feature = (mixed >> np.uint32(32 - 15)).astype(np.int32)
        if inside is None:
            features.append(feature)
            starts.append(places)
        else:
            features.append(feature[inside])
            starts.append(np.searchsorted(inside, places))
    return features, starts


def _frequencies(text: str):
    def run(batches):
        total = np.zeros(DIMS, np.int64)
        docs = 0
        for batch in in_chunks(batches, text):
            features, starts = grams(*flat_text(batch.column(text)))
            for k in range(batch.num_rows):
                seen = np.zeros(DIMS, bool)
                for f, s in zip(features, starts, strict=True):
                    seen[f[s[k] : s[k + 1]]] = True
                total += seen
            docs += batch.num_rows
        held = np.flatnonzero(total)
        index = np.append(held, -1)
        count = np.append(total[held], docs)
        yield pa.RecordBatch.from_arrays([pa.array(index, pa.int64()), pa.array(count, pa.int64())], ["feature", "n"])

    return run


def _sparse(text: str, label: str):
    """Counts of the features of each text, bounded by the number of features."""

    def run(batches):
        for batch in in_chunks(batches, text):
            features, starts = grams(*flat_text(batch.column(text)))
            index, value = [], []
            for k in range(batch.num_rows):
                own = np.concatenate([f[s[k] : s[k + 1]] for f, s in zip(features, starts, strict=True)])
                kinds, counts = np.unique(own, return_counts=True)
                index.append(kinds.astype(np.int32))
                value.append((counts / max(1, len(own))).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(label), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
                ["label", "index", "value"],
            )

    return run


class LanguageModel:
    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, heat: float):
        self.languages, self.heat = languages, heat
        # Weight times IDF, with a last row for the bias.
        self.table = (weights[:-1] * idf[:, None]).astype(np.float32)
        self.bias = weights[-1]

    def logits(self, texts: pa.Array) -> np.ndarray:
        features, starts = grams(*flat_text(texts))
        n, classes = len(texts), len(self.languages)
        total = np.zeros((n, classes))
        size = np.zeros(n)
        for f, s in zip(features, starts, strict=True):
            counts = np.diff(s)
            size += counts
            some = np.flatnonzero(counts)
            if not len(some):
                continue
            for c in range(classes):
                total[some, c] += np.add.reduceat(self.table[:, c][f], s[some])
        return total / np.maximum(size, 1)[:, None] * SCALE + self.bias


#: Brings the mean over n-grams to the size that the penalties are set for.
SCALE = 10.0


def fit_language(
    docs: DataFrame,
    *,
    text: str = "text",
    label: str = "lang",
    doc_id: str = "doc_id",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    epochs: int = EPOCHS,
) -> LanguageModel | None:
    """Learns from all rows of ``docs`` that have a label; None if there are none."""
    known = docs.where(F.col(label).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(label).count().collect()}  # a row per language
    if not sizes:
        return None
    counted = known.select(text).mapInArrow(_frequencies(text), "feature long, n long")
    counted = counted.groupBy("feature").agg(F.sum("n").alias("n")).collect()  # DIMS rows at most
    df = np.zeros(DIMS)
    total = 0
    for feature, n in counted:
        if feature < 0:
            total = n
        else:
            df[feature] = n
    idf = np.log((1 + total) / (1 + df)) + 1
    languages = sorted(sizes)
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col(label) == name, F.lit(min(1.0, sample_per_language / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit("lang")), F.lit(1 << 20)) / float(1 << 20)
    sample = known.where(draw < share).select(text, F.col(label).alias("label"))
    rows = sample.mapInArrow(_sparse(text, "label"), "label string, index array<int>, value array<float>").toArrow()
    labels = np.array([languages.index(x) for x in rows["label"].to_pylist()])
    index, value = rows["index"].combine_chunks(), rows["value"].combine_chunks()
    ends = np.concatenate([[0], np.cumsum(index.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
    index, value = index.flatten().to_numpy(), value.flatten().to_numpy()
    # Collected rows come in no fixed order: learn in the order of their content.
    order = np.lexsort([ends[1:] - ends[:-1], [float(value[a:z] @ (index[a:z] % 9973)) for a, z in zip(ends, ends[1:], strict=False)]])
    order = np.random.default_rng(7).permutation(order)
    held = order[: len(order) // HELD_BACK] if len(order) >= 10 * HELD_BACK else order[:0]
    taught = order[len(held) :]
    model = Ftrl(DIMS + 1, len(languages), alpha=0.3, l1=0.02, l2=0.01)

    def row(k: int):
        i, v = index[ends[k] : ends[k + 1]], value[ends[k] : ends[k + 1]]
        return np.append(i, DIMS), np.append(v * idf[i] * SCALE, 1.0)

    for _ in range(epochs):
        for k in taught:
            model.step(*row(k), labels[k])
    weights = model.weights()
    logits = np.array([v @ weights[i] for i, v in map(row, held)]).reshape(-1, len(languages))
    return LanguageModel(languages, idf, weights, temperature(logits, labels[held]))


def predict_language(docs: DataFrame, model: LanguageModel | None, *, text: str = "text", keys=("doc_id",)) -> DataFrame:
    """``keys``, ``lang_pred`` and ``score`` (calibrated probability) of every row."""
    readable = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*keys, F.when(readable, F.col(text)).alias("body"), readable.alias("readable"))
    types = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # DIMS weights per language

    def run(batches):
        model = shipped.value
        for batch in in_chunks(batches, "body"):
            n = batch.num_rows
            readable = batch.column("readable").to_numpy(zero_copy_only=False)
            if model is None:
                names, scores = [UNKNOWN] * n, np.zeros(n)
            else:
                chance = softmax(model.logits(batch.column("body")) / model.heat)
                best = chance.argmax(axis=1)
                names = [model.languages[b] if r else UNKNOWN for b, r in zip(best, readable, strict=True)]
                scores = np.where(readable, chance[np.arange(n), best], 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                [*keys, "lang_pred", "score"],
            )

    return rows.mapInArrow(run, f"{types}, lang_pred string, score double")


def fold_of(key: str, folds: int) -> Column:
    """Which fold a row is in: crc32 of the id as text. A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(0))


def op1_language(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_language(docs.where(F.col("text").isNotNull() & (fold_of("doc_id", 3) != 1)))
    predicted = predict_language(docs, model)
    return predicted.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
