"""Quality by votes of the nearest labelled documents in a latent-semantic space.

The terms of a text are pairs of neighbouring characters, by kind (letters, capitals,
digits, white space, single punctuation marks), and the shares of repeated words and lines.
A truncated singular value decomposition of the TF-IDF weights of a bounded labelled sample
gives the space. The labelled vectors, bounded too, are broadcast, and the cosines of each
document with all of them are computed exactly, block by block. Cosines count to PLACES
decimals; of equal ones the voter that was sampled earlier is the nearer.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, fold
from tessera.llm.labelled import sample

#: Labelled documents at most for the space, and of each label for the votes.
BOUND, VOTERS = 4000, 1024
#: Dimensions, neighbours that vote, power of their similarity, documents of a block.
DIMENSIONS, NEIGHBOURS, POWER, BLOCK = 32, 15, 8.0, 256
#: Decimals of a cosine, far fewer than what sums in another order change.
PLACES = 6
#: Bytes that are looked at together, which bounds the memory for a very long text.
PORTION = 1 << 20

KINDS = 40


def _kinds() -> np.ndarray:
    out = np.zeros(256, dtype=np.int32)
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    for b in range(256):
        c = chr(b)
        if b >= 128 or c.islower():
            out[b] = 1
        elif c.isupper():
            out[b] = 2
        elif c.isdigit():
            out[b] = 3
        elif c == " ":
            out[b] = 4
        elif c in "\r\n":
            out[b] = 5
        elif b in marks:
            out[b] = 6 + marks.index(b)
    return out


KIND = _kinds()
TERMS = KINDS * KINDS + 2


def counts(text: str) -> np.ndarray:
    """Term frequencies as square roots of shares; zeros for an empty text."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    out = np.zeros(TERMS)
    for i in range(0, len(raw) - 1, PORTION):
        kinds = KIND[raw[i : i + PORTION + 1]]
        out[: KINDS * KINDS] += np.bincount(kinds[:-1] * KINDS + kinds[1:], minlength=KINDS * KINDS)
    out[: KINDS * KINDS] /= max(1, len(raw) - 1)
    words = text.split()
    out[-2] = sum(map(operator.eq, words, words[1:])) / max(1, len(words))
    lines = [x for x in text.split("\n") if x]
    out[-1] = 1 - len(set(lines)) / max(1, len(lines)) if lines else 0
    return np.sqrt(out)


@dataclass
class NearestVotes:
    idf: np.ndarray
    space: np.ndarray
    voters: np.ndarray
    labels: np.ndarray
    prior: float

    def vectors(self, frequencies: np.ndarray) -> np.ndarray:
        x = (frequencies * self.idf) @ self.space
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        for i in range(0, len(texts) if len(self.voters) else 0, BLOCK):
            f = np.stack([counts(t) for t in texts[i : i + BLOCK]])
            cosines = np.round(self.vectors(f) @ self.voters.T, PLACES)
            k = min(NEIGHBOURS, len(self.voters))
            order = cosines - np.arange(len(self.voters)) * (0.1**PLACES / (2 * len(self.voters)))
            near = np.sort(np.argpartition(-order, k - 1, axis=1)[:, :k], axis=1)
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** POWER
            total = weight.sum(axis=1)
            votes = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
            out[i : i + BLOCK] = np.where((total > 1e-9) & f.any(axis=1), votes, self.prior)
        return np.clip(out, 0, 1)


def train(f: np.ndarray, y: np.ndarray) -> NearestVotes:
    """The space from all rows, the voters from the first VOTERS of each label."""
    n = len(y)
    prior = (y.sum() + 1.0) / (n + 2.0)
    if not n:
        return NearestVotes(np.ones(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1)), np.zeros(0), prior)
    idf = np.log((1 + n) / (1 + (f > 0).sum(axis=0))) + 1
    gram = np.zeros((f.shape[1], f.shape[1]))
    for i in range(0, n, BLOCK):  # a block at a time is held in double precision
        x = f[i : i + BLOCK] * idf
        gram += x.T @ x
    _, axes = np.linalg.eigh(gram)
    space = np.ascontiguousarray(axes[:, ::-1][:, : min(DIMENSIONS, n)])
    some = np.sort(np.r_[np.flatnonzero(y == 1)[:VOTERS], np.flatnonzero(y == 0)[:VOTERS]])
    model = NearestVotes(idf, space, np.zeros((0, 1)), y[some], prior)
    model.voters = np.concatenate([model.vectors(f[some[i : i + BLOCK]]) for i in range(0, len(some), BLOCK)])
    return model


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, label: str = "quality", bound: int = BOUND,
        key: str = "doc_id", text: str = "text") -> NearestVotes:
    """Fits on at most bound labelled documents, whose term frequencies go to the driver.

    allowed is a condition on the key. Without labelled documents the score is one half.
    """

    bounded_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def frequencies(texts):
        return texts.map(lambda t: counts(t).astype(np.float32).tobytes())

    rows = sample(docs, labels, label, bound, allowed, key, text).select("k", "y", frequencies("t").alias("f"), F.xxhash64("k").alias("h")).collect()
    rows.sort(key=lambda r: (r["h"], r["k"]))  # as they were sampled, so that the voters come from all ranges of the keys
    f = np.array([np.frombuffer(r["f"], dtype=np.float32) for r in rows], dtype=np.float32).reshape(-1, TERMS)
    y = np.array([r["y"] for r in rows], dtype=float)
    del rows
    return train(f, y)


def score_udf(spark: SparkSession, model: NearestVotes):
    """A column function: text to score; null texts count as empty. The model is a megabyte by its bounds."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        return pd.Series(sent.value.scores([t or "" for t in texts]))

    return score


def quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores every whole text; learns only from rows whose crc32(key) mod 3 isn't 1.

    Returns key, held_out boolean, score double, predicted int. Null texts count as empty
    and have the share of label 1 among the learnt rows. Equal cosines are ordered as the
    sample is, by the hash of the voters' keys. Null keys have a null held_out and aren't
    learnt from. Repeated rows give a row each, an empty table an empty one; of the
    texts' table only key and text are read.
    """
    model = fit(docs, labels, fold(key, 3) != 1, key=key, text=text)
    scored = docs.select(F.col(key).cast("long").alias(key), score_udf(docs.sparkSession, model)(F.coalesce(F.col(text), F.lit(""))).alias("score"))
    return scored.select(key, (fold(key, 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_poor(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose score is at least one half, with all their columns."""
    model = fit(docs, labels, key=key, text=text)
    return docs.where(score_udf(docs.sparkSession, model)(F.coalesce(F.col(text), F.lit(""))) >= 0.5)
