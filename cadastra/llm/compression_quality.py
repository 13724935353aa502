"""Quality score from compression with two dictionaries.

One zstandard dictionary is built from text labelled good, one from text labelled bad. Text of a
kind is smaller under the dictionary of its kind. The difference of the two sizes, divided by the
length, and the size under the good dictionary, divided by the length (text that repeats itself is
small under any dictionary), go through a logistic curve fitted on other labelled texts.

Cost: every text is compressed twice, in pieces of :data:`PIECE` bytes, so that a long text cannot
outgrow the dictionaries. No shuffle. The dictionaries and the curve are the only state, about
220 kB, whatever the size of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from cadastra.functions.cols import ColumnLike, as_col
from cadastra.llm.words import fold

PIECE = 4096
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Bytes of a piece of sampled text for a dictionary.
SAMPLE_PIECE = 1024
#: Added to the length, so that a text of a few bytes stays near the middle.
SMOOTHING = 32
#: Repetition only matters below this share of the length.
SIZE_CEILING = 0.25


@dataclass(frozen=True)
class CompressionModel:
    """Both dictionaries and the weights of difference, size and constant."""

    good: bytes
    bad: bytes
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def compressors(self):
        settings = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        return [
            zstandard.ZstdCompressor(compression_params=settings, dict_data=zstandard.ZstdCompressionDict(d) if d else None)
            for d in (self.good, self.bad)
        ]


def _sizes(text: str | None, compressors) -> tuple[float, float]:
    """(bad - good) and good size, both divided by the length; (0, ceiling) for an empty text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return 0.0, SIZE_CEILING
    pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
    good, bad = (sum(len(c.compress(piece)) for piece in pieces) for c in compressors)
    return (bad - good) / (len(data) + SMOOTHING), min(good / (len(data) + SMOOTHING), SIZE_CEILING)


def size_features(model: CompressionModel, text: ColumnLike) -> Column:
    """Struct of ``difference`` and ``size``."""

    @F.pandas_udf("difference double, size double")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressors = model.compressors()
        for texts in batches:
            yield pd.DataFrame([_sizes(t, compressors) for t in texts], columns=["difference", "size"])

    return features(as_col(text))


def quality_score(model: CompressionModel, text: ColumnLike) -> Column:
    """Score in 0..1, higher for text like the good one. Null and empty texts score the same."""
    difference, size, constant = model.weights

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = model.compressors()
        for texts in batches:
            pairs = (_sizes(t, compressors) for t in texts)
            yield pd.Series([_logistic(difference * d + size * s + constant) for d, s in pairs], dtype="float64")

    return score(as_col(text))


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def build_dictionary(samples: list[bytes]) -> bytes:
    """Dictionary of the samples; an empty one when there is too little text to train on."""
    samples = [s for s in samples if len(s) >= 8]
    if sum(map(len, samples)) < 4096 or len(samples) < 8:
        return b"".join(samples)[:DICTIONARY_BYTES] if samples else b""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 2)
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too uniform to train on: use the text itself
        return b"".join(samples)[:size]


def fit_curve(features: np.ndarray, labels: np.ndarray, good_share: float) -> tuple[float, float, float]:
    """Logistic weights, each class weighted to its share among all labels, lightly regularised."""
    if len(set(labels.tolist())) < 2:
        return 0.0, 0.0, math.log((good_share + 1e-3) / (1 - good_share + 1e-3))
    x = np.column_stack([features[:, 0] * 20, features[:, 1] * 10, np.ones(len(features))])
    weight = np.where(labels == 1, good_share / (labels == 1).mean(), (1 - good_share) / (labels == 0).mean())
    theta = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        theta += np.linalg.solve(hessian, x.T @ (weight * (labels - p)) - 1e-2 * theta)
    return float(theta[0] * 20), float(theta[1] * 10), float(theta[2])


def labelled_sample(
    documents: DataFrame, labels: DataFrame, per_class: int, id: str = "doc_id", text: str = "text", label: str = "quality",
) -> DataFrame:
    """At most ``per_class`` texts of either label, ids in the order of a hash: ``id, label, text``.

    Ids whose fold is 2 are held out. An id with several labels gets the majority, an id with as many
    good as bad labels or without a document is left out, several texts of one id count once.
    """
    votes = labels.where(F.col(id).isNotNull() & F.col(label).isin(0, 1) & (fold(id) != 2))
    votes = votes.groupBy(F.col(id).alias("__id")).agg(F.avg(label).alias("__mean")).where("__mean != 0.5")
    votes = votes.select("__id", (F.col("__mean") > 0.5).cast("int").alias("__label"))
    order = [F.xxhash64("__id"), F.col("__id")]
    chosen = [votes.where(F.col("__label") == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    # At most 2 * per_class ids.
    found = documents.select(F.col(id).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")
    return found.groupBy("__id", "__label").agg(F.min("__text").alias("__text"))


def chosen_pieces(text: ColumnLike, count: int) -> Column:
    """``count`` pieces of :data:`SAMPLE_PIECE` bytes from anywhere in a text: those with the smallest hashes."""
    data = F.coalesce(as_col(text), F.lit("")).cast("binary")
    starts = F.sequence(F.lit(0), F.floor((F.greatest(F.octet_length(data), F.lit(1)) - 1) / SAMPLE_PIECE).cast("int"))
    pieces = F.transform(starts, lambda i: F.substring(data, i * SAMPLE_PIECE + 1, F.lit(SAMPLE_PIECE)))
    ordered = F.array_sort(F.transform(pieces, lambda p: F.struct(F.xxhash64(p).alias("hash"), p.alias("piece"))))
    return F.slice(ordered, 1, count)["piece"]


def fit(
    documents: DataFrame, labels: DataFrame, per_class: int = 1200, pieces: int = 2, id: str = "doc_id",
    text: str = "text", label: str = "quality",
) -> CompressionModel:
    """Model from a bounded sample: ``per_class`` labelled texts of either label.

    Every other sampled text goes into the dictionaries: ``pieces`` of its pieces of :data:`SAMPLE_PIECE`
    bytes, chosen by hash over the whole text. The rest, whole, goes into the curve. At most ``per_class *
    pieces`` pieces come to the driver. Without labels the score is 0.5 for every text; with one label only it
    is near 1 or 0.
    """
    sample = labelled_sample(documents, labels, per_class, id, text, label)
    half = F.shiftright(F.xxhash64(F.col("__id"), F.lit("half")), 7) % 2 == 0
    rows = sample.where(half).select("__id", "__label", chosen_pieces("__text", pieces).alias("pieces")).collect()
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sorted(rows, key=lambda r: r["__id"]):
        samples[row["__label"]] += [bytes(p) for p in row["pieces"]]
    model = CompressionModel(build_dictionary(samples[1]), build_dictionary(samples[0]))
    share = labels.where((fold(id) != 2) & F.col(label).isin(0, 1)).agg(F.avg(label).alias("share")).collect()[0]["share"]
    rest = sample.where(~half).select("__id", "__label", size_features(model, "__text").alias("f")).select("__id", "__label", "f.*")
    scored = sorted(rest.collect())
    if share is None or not scored:
        return model
    features = np.array([(r["difference"], r["size"]) for r in scored])
    weights = fit_curve(features, np.array([r["__label"] for r in scored]), float(share))
    return CompressionModel(model.good, model.bad, weights)


def score_documents(documents: DataFrame, model: CompressionModel, id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` and ``predicted`` (score at or over the threshold).

    Repeated rows and rows with a null id are scored like all others; a null id is not held out.
    """
    scored = documents.select(
        F.col(id), F.coalesce(fold(id) == 2, F.lit(False)).alias("held_out"), quality_score(model, text).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
