"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.words import coded, hashes, mixed, over_slices, split_words

BITS = 18
SAMPLE = 5_000
EPOCHS = 4
_EDGES = re.compile(r"^(\W*)(.*?)(\W*)$", re.S)


def shape(word: bytes) -> bytes:
    """What kind of word it is: letter case, digits, and the symbols around it."""
    head, core, tail = _EDGES.match(word.decode("utf-8", "replace")).groups()
    if not core:
        kind = "-"
    elif core.isalpha():
        kind = "a" if core.islower() else "A" if core.isupper() and len(core) > 1 else "T" if core.istitle() else "m"
    else:
        kind = "9" if core.isdigit() else "x"
    return f"{head[-3:]}{kind}{tail[-3:]}".encode()


def features(texts: list, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each text, one after the other, and where each text's begin.

    Word unigrams and bigrams, and the same of word shapes; a bigram of two equal words
    counts as "repeated" whatever the word. All n-grams of a text count alike.
    """
    lists, starts = split_words(texts)
    total = int(starts[-1])
    kinds, codes = coded(lists, total)
    of_word = hashes(kinds, len(kinds))[codes] if total else np.zeros(0, np.uint64)
    of_shape = hashes(map(shape, kinds), len(kinds), seed=1)[codes] if total else np.zeros(0, np.uint64)
    inner = np.ones(total, dtype=bool)
    inner[starts[:-1][starts[:-1] < total]] = False  # first words have no bigram
    before = np.concatenate([np.zeros(1, np.uint64), of_word[:-1]]) if total else of_word
    shape_before = np.concatenate([np.zeros(1, np.uint64), of_shape[:-1]]) if total else of_shape
    first = np.uint64(3)
    pair = np.where(before == of_word, np.uint64(7), mixed(before * np.uint64(3) + of_word))
    pair = np.where(inner, pair, first)
    shapes = np.where(inner, mixed(shape_before * np.uint64(5) + of_shape + np.uint64(1)), first)
    keep = np.uint64((1 << bits) - 1)
    stacked = np.stack([mixed(of_word), pair, mixed(of_shape), shapes], axis=1) if total else np.zeros((0, 4), np.uint64)
    return (stacked.ravel() & keep).astype(np.int32), starts * 4


def _vectors(part: pa.RecordBatch, texts: list, bits: int) -> dict:
    """Of each text its distinct features and the share each has in all of them."""
    index, starts = features(texts, bits)
    names, shares = [], []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        u, c = np.unique(index[a:b], return_counts=True)
        names.append(u)
        shares.append((c * (4.0 / max(1, b - a))).astype(np.float32))
    return {
        "doc_id": part.column("doc_id"), "label": part.column("label"),
        "i": pa.array(names, pa.list_(pa.int32())), "x": pa.array(shares, pa.list_(pa.float32())),
    }


def ftrl(rows: list, bits: int, epochs: int = EPOCHS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05):
    """FTRL-proximal over sparse rows (label, indices, values); returns weights and the bias.

    The rows are only looked at, never copied, so memory stays at the sample's own size.
    """
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    z_bias = n_bias = 0.0

    def weights(zi, ni):
        return np.where(np.abs(zi) > l1, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for y, i, x in rows:
            zi, ni = z[i], n[i]
            wi, w_bias = weights(zi, ni), float(weights(z_bias, n_bias))
            p = 1.0 / (1.0 + np.exp(-np.clip(wi @ x + w_bias, -35, 35)))
            g = (p - y) * x
            grown = ni + g * g
            z[i] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * wi
            n[i] = grown
            grown = n_bias + (p - y) ** 2
            z_bias += (p - y) - (np.sqrt(grown) - np.sqrt(n_bias)) / alpha * w_bias
            n_bias = grown
    return weights(z, n).astype(np.float32), float(weights(z_bias, n_bias))


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether a row's labels are not to be learnt from; never so for a null id, which has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, most: int) -> DataFrame:
    """doc_id, text and label of at most ``most`` rows that may be learnt from, picked by a hash of the id.

    The picked ids are at most ``most`` rows, which bounds the broadcast.
    """
    picked = (
        labels.filter(may_learn & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, sample: int = SAMPLE, bits: int = BITS):
    """Weights and bias from a bounded sample of labelled rows (``sample``); texts are hashed on the executors."""
    rows = labelled_sample(docs, labels, "quality", may_learn, sample)
    vectors = over_slices(rows, _vectors, "doc_id long, label int, i array<int>, x array<float>", bits=bits)
    got = vectors.toArrow().sort_by([("doc_id", "ascending")])
    order = np.random.default_rng(7).permutation(got.num_rows)
    y, i, x = (got.column(c).combine_chunks() for c in ("label", "i", "x"))
    rows = [(y[int(k)].as_py(), i[int(k)].values.to_numpy(), x[int(k)].values.to_numpy()) for k in order]
    return ftrl(rows, bits) if rows else (np.zeros(1 << bits, np.float32), 0.0)


def _scores(part: pa.RecordBatch, texts: list, model, bits: int) -> dict:
    weights, bias = model.value
    index, starts = features(texts, bits)
    summed = np.concatenate([np.zeros(1), np.cumsum(weights[index], dtype=np.float64)])
    size = np.maximum(1, np.diff(starts))
    logit = bias + (summed[starts[1:]] - summed[starts[:-1]]) * 4.0 / size
    return {"doc_id": part.column("doc_id"), "score": 1.0 / (1.0 + np.exp(-np.clip(logit, -35, 35)))}


def score(docs: DataFrame, model: tuple, bits: int = BITS) -> DataFrame:
    """doc_id and score (0 to 1) of every text: the sparse dot product of its n-gram shares and the weights.

    Null and empty texts score the bias alone; equal texts score alike; an empty table
    gives no rows. The weights are broadcast; ``bits`` bounds their size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return over_slices(docs.select("doc_id", "text"), _scores, "doc_id long, score double", model=shared, bits=bits)


def classify(docs: DataFrame, labels: DataFrame, parts: int = 3, part: int = 1, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted for every document.

    Learns only from labels of rows that are not held out; without any, every score is 0.5.
    """
    model = fit(docs, labels, ~held_out(F.col("doc_id"), parts, part), sample)
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
