"""Quality classifier by compression: a zstandard dictionary for each class, compared on every text."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import labelled_sample, small_batches

SEGMENT = 4096
PIECE = 2048
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the calibration of their size difference."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]

    def scorer(self) -> "Scorer":
        return Scorer(self)


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if held:
        held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)


class Features:
    """What the two compressors say of a whole text, segment by segment."""

    names = ("difference", "least difference", "greatest difference", "rate", "least rate", "length")

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = _compressor(good), _compressor(bad)

    def of(self, text: str | None) -> list[float]:
        data = (text or "").encode("utf-8", "surrogatepass")
        good = bad = 0
        least, greatest, rate = 2.0, -2.0, 9.0
        for at in range(0, max(len(data), 1), SEGMENT):
            part = data[at : at + SEGMENT]
            g, b = len(self.good.compress(part)), len(self.bad.compress(part))
            good, bad = good + g, bad + b
            if at == 0 or len(part) > 200:  # a short rest says little by itself
                least, greatest = min(least, (b - g) / (b + g)), max(greatest, (b - g) / (b + g))
                rate = min(rate, min(g, b) / max(1, len(part)))
        size = len(data) + 1
        return [(bad - good) / (bad + good), least, greatest, float(np.log((min(good, bad) + 1) / size)), float(np.log(rate + 1e-3)), float(np.log(size))]


def _expand(x: np.ndarray) -> np.ndarray:
    """Constant and features, for the calibration: the size difference and its extremes, at like rates and lengths."""
    return np.column_stack([np.ones(len(x)), x])


class Scorer:
    def __init__(self, model: QualityModel):
        self.features = Features(model.good, model.bad)
        self.mean, self.scale, self.weights = (np.array(v) for v in (model.mean, model.scale, model.weights))

    def scores(self, texts: pd.Series) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        x = (np.array([self.features.of(t) for t in texts]) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(_expand(np.clip(x, -6, 6)) @ self.weights, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, rounds: int = 40) -> np.ndarray:
    """Newton steps for weighted logistic regression with a ridge penalty."""
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * b
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), gradient)
        b -= step
        if np.abs(step).max() < 1e-6:
            break
    return b


def _pieces(per_text: int, seed: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, label, text in zip(batch["doc_id"], batch["label"], batch["text"], strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                n = max(1, -(-len(data) // PIECE))
                picks = sorted(random.Random(f"{seed}:{doc_id}").sample(range(n), min(per_text, n)))
                rows += [(label, doc_id, k, data[k * PIECE : (k + 1) * PIECE]) for k in picks]
            yield pd.DataFrame(rows, columns=["label", "doc_id", "k", "piece"])

    return cut


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    learn: Column | None = None,
    per_class: int = 1500,
    pieces_per_text: int = 4,
    dictionary_bytes: int = 65536,
    ridge: float = 1e-2,
    seed: int = 11,
) -> QualityModel:
    """Builds both dictionaries and calibrates on labelled texts.

    The sample is bounded: at most per_class labelled ids of each class (smallest seeded hash), half of them for the
    dictionaries (pieces_per_text pieces of 2048 bytes each) and half, whole, for the calibration. Class weights
    restore the class shares of all labelled rows. The calibration is a logistic regression on the normalised size
    difference, its least and greatest over segments, compression rates and length. Without two classes of text the model scores everything 0.5.
    learn: which label rows may be used (a condition on doc_id).
    """
    spark = docs.sparkSession
    small_batches(spark)
    learn = F.lit(True) if learn is None else learn
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & learn)
    shares = {int(r["k"]): r["n"] for r in usable.groupBy(F.col(label).cast("int").alias("k")).agg(F.count("*").alias("n")).collect()}
    sample = labelled_sample(labels, label, learn, per_class, seed)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    first = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(2)) == 0
    cut = texts.filter(first).mapInPandas(_pieces(pieces_per_text, seed), "label int, doc_id long, k int, piece binary").collect()
    pieces = {k: [bytes(r["piece"]) for r in sorted(cut, key=lambda r: (r["doc_id"], r["k"], bytes(r["piece"]))) if r["label"] == k] for k in (0, 1)}
    made = {}
    for k, parts in pieces.items():
        try:
            made[k] = zstandard.train_dictionary(dictionary_bytes, parts).as_bytes() if parts else b""
        except zstandard.ZstdError:  # too little text: the text itself is the dictionary
            made[k] = b"".join(parts)[:dictionary_bytes]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features(made[1], made[0])
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": [features.of(t) for t in batch["text"]]})

    rows = sorted(texts.filter(~first).mapInPandas(measure, "doc_id long, label int, x array<double>").collect())
    y = np.array([r["label"] for r in rows], dtype=float)
    width = 1 + len(Features.names)
    if len(set(y)) < 2:
        return QualityModel(made[1], made[0], (0.0,) * 6, (1.0,) * 6, (0.0,) * width)
    x = np.array([r["x"] for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    total = sum(shares.values())
    weight = np.array([shares[int(k)] / total / (y == k).mean() for k in y])
    b = logistic(_expand(np.clip((x - mean) / scale, -6, 6)), y, weight, ridge)
    return QualityModel(made[1], made[0], tuple(mean), tuple(scale), tuple(b))


def _score_udf(docs: DataFrame, model: QualityModel):
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scorer()
        for batch in batches:
            yield pd.Series(scorer.scores(batch))

    return score


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """Adds score (0 to 1, higher: better) and predicted (1 from the threshold on) to every row of docs.

    Null texts score as empty ones; repeated rows score alike; an empty table gives an empty result. Columns of docs
    named score or predicted are replaced.
    """
    score = _score_udf(docs, model)
    return docs.withColumn("score", score(text)).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that the classifier does not reject, with the columns of docs."""
    model = fit_quality(docs, labels, learn=learn)
    return docs.filter(_score_udf(docs, model)("text") >= threshold)
