"""Toxicity by a factorization machine over hashed terms.

Terms are a text's distinct words and their beginnings, hashed. Besides a weight each term
has a short vector, and the products of these vectors score every pair of terms that stand
together, so that an insult next to the mention of a group can count more than the two
alone. The machine is fitted on a bounded sample of labelled documents over the terms that
tell the labels apart there; scoring looks at all words of every whole text.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, checkpointed, fold
from tessera.llm.labelled import sample

#: Labelled documents at most, hash space, terms kept, length of a term's vector.
BOUND, SPACE, TERMS, FACTORS = 20_000, 1 << 22, 4096, 8
#: Letters of the beginnings that are terms besides the word.
STEMS = (4, 5)
#: Least chi-square of a term, and least number of documents that have it.
LEAST, SUPPORT = 12.0, 3
CACHED = 100_000
#: Texts whose vectors are held together.
BLOCK = 128

EDGES = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")
WORDS = regex.compile(r"[\p{L}\p{N}]+")


def terms_of(token: str) -> list[int]:
    """The hashed terms of what stands between white space."""
    words = [token] if token.isalnum() else WORDS.findall(token)
    names = {n for w in words for n in (w, *(f"{w[:k]}*" for k in STEMS if len(w) >= k))}
    return [zlib.crc32(n.encode()) % SPACE for n in names]


def tokens_of(text: str) -> set[str]:
    return set(text.lower().split())


@dataclass
class FactorizationMachine:
    """p = sigmoid(bias + sum of weights + sum over pairs of vector products) over the terms present."""

    place: dict[int, int]
    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    cache: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def known(self, text: str) -> list[int]:
        cache, found = self.cache, set()
        for w in tokens_of(text):
            at = cache.get(w)
            if at is None:
                at = tuple(self.place[t] for t in terms_of(w) if t in self.place)
                if len(cache) > CACHED:
                    cache.clear()
                if len(w) <= 64:
                    cache[w] = at
            if at:
                found.update(at)
        return sorted(found)

    def margins(self, rows: list[list[int]]) -> np.ndarray:
        """Of many lists of terms together: bias, weights, and half of (sum of vectors) squared less the sum of squares."""
        n = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        out = np.full(len(rows), self.bias)
        some = np.flatnonzero(n)
        if len(some):
            flat = np.fromiter((t for r in rows for t in r), dtype=np.int64, count=int(n.sum()))
            starts = np.r_[0, np.cumsum(n[some])[:-1]]
            v = self.vectors[flat].astype(np.float64)
            total = np.add.reduceat(v, starts, axis=0)
            squares = np.add.reduceat((v * v).sum(axis=1), starts)
            out[some] += np.add.reduceat(self.weights[flat].astype(np.float64), starts) + 0.5 * ((total * total).sum(axis=1) - squares)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        margins = [self.margins([self.known(t) for t in texts[i : i + BLOCK]]) for i in range(0, len(texts), BLOCK)]
        return 1.0 / (1.0 + np.exp(-np.clip(np.concatenate([*margins, np.empty(0)]), -30, 30)))

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}


def train(rows: list[list[int]], y: np.ndarray, n_terms: int, place: dict[int, int], epochs: int = 12, batch: int = 256,
          rate: float = 0.05, decay: float = 1e-4, seed: int = 7) -> FactorizationMachine:
    """Adam on the log loss. With one class only, the share of that class with a smoothed bias."""
    rng = np.random.default_rng(seed)
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    bias = float(np.log(share / (1 - share)))
    w, v = np.zeros(n_terms + 1), rng.normal(0, 0.02, (n_terms + 1, FACTORS))
    if n_terms == 0 or y.min(initial=1) == y.max(initial=0):
        return FactorizationMachine(place, bias, w[:n_terms], np.zeros((n_terms, FACTORS)))
    lengths = np.array([len(r) for r in rows])
    ends, flat = np.cumsum(lengths), np.concatenate([np.asarray(r, dtype=np.int64) for r in rows])
    b = np.array([bias])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (b, w, v)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            some = order[i : i + batch]
            n = lengths[some]
            own = np.repeat(np.arange(len(some)), n)
            at = flat[np.repeat(ends[some] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            vv = v[at]
            s = np.zeros((len(some), FACTORS))
            np.add.at(s, own, vv)
            sq, lin = np.zeros(len(some)), np.zeros(len(some))
            np.add.at(sq, own, (vv * vv).sum(axis=1))
            np.add.at(lin, own, w[at])
            z = b[0] + lin + 0.5 * ((s * s).sum(axis=1) - sq)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) / len(some)
            gw, gv = decay * w, decay * v
            np.add.at(gw, at, g[own])
            np.add.at(gv, at, g[own, None] * (s[own] - vv))
            step += 1
            for p, grad, (m1, m2) in zip((b, w, v), (np.array([g.sum()]), gw, gv), state, strict=True):
                m1 += 0.1 * (grad - m1)
                m2 += 0.001 * (grad * grad - m2)
                p -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return FactorizationMachine(place, float(b[0]), w[:n_terms].astype(np.float32), v[:n_terms].astype(np.float32))


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, label: str = "toxic", bound: int = BOUND,
        key: str = "doc_id", text: str = "text") -> FactorizationMachine:
    """Fits the machine on at most bound labelled documents; allowed is a condition on the key.

    The driver gets TERMS terms and, for each sampled document, the places of the kept terms
    in it. Without labelled documents the score is one half everywhere.
    """

    bounded_batches(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def hashed(texts):
        return texts.map(lambda t: sorted({h for w in tokens_of(t) for h in terms_of(w)}))

    rows = checkpointed(sample(docs, labels, label, bound, allowed, key, text).select("k", "y", hashed("t").alias("terms")))
    size = rows.agg(F.sum("y").alias("pos"), F.count("*").alias("n")).first()
    n, pos = size["n"], size["pos"] or 0
    held = rows.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").alias("a"), F.count("*").alias("c"))
    a, c = F.col("a").cast("double"), F.col("c").cast("double")
    # Chi-square of the 2 x 2 table of term and label.
    top = n * (a * (n - pos - c + a) - (c - a) * (pos - a)) ** 2
    chi = top / (F.lit(float(max(1, pos) * max(1, n - pos))) * c * (n - c))
    kept = held.where((F.col("c") >= SUPPORT) & (F.col("c") < n)).select("term", chi.alias("chi")).where(F.col("chi") >= LEAST)
    kept = [r["term"] for r in kept.orderBy(F.desc("chi"), "term").limit(TERMS).collect()] if n else []
    place = {t: i for i, t in enumerate(kept)}
    sent = docs.sparkSession.sparkContext.broadcast(place)

    @F.pandas_udf("binary")
    def places(terms):
        return terms.map(lambda ts: np.array([sent.value[t] for t in ts.tolist() if t in sent.value], dtype=np.int32).tobytes())

    # Rows of one key stand by their terms, so that the machine doesn't depend on the order of the rows.
    found = rows.select("k", "y", places("terms").alias("terms")).collect() if n else []
    found.sort(key=lambda r: (r["k"], r["y"], bytes(r["terms"])))
    x = [np.frombuffer(r["terms"], dtype=np.int32) for r in found]
    return train(x, np.array([r["y"] for r in found], dtype=float), len(kept), place)


def score_udf(spark: SparkSession, model: FactorizationMachine):
    """A column function: text to score; null texts count as empty. The model has TERMS vectors at most."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        return pd.Series(sent.value.scores([t or "" for t in texts]))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores every whole text; learns only from rows whose crc32(key) mod 5 isn't 0.

    Returns key, held_out boolean, score double, predicted int. Null texts count as empty
    and have the score of a text without known terms. Null keys have a null held_out and
    aren't learnt from. Repeated rows give a row each and are learnt from as often, in an
    order of their own; an empty table gives an empty one; of the texts' table only key and
    text are read.
    """
    model = fit(docs, labels, fold(key, 5) != 0, key=key, text=text)
    scored = docs.select(F.col(key).cast("long").alias(key), score_udf(docs.sparkSession, model)(F.coalesce(F.col(text), F.lit(""))).alias("score"))
    return scored.select(key, (fold(key, 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose score is under one half, with all their columns."""
    model = fit(docs, labels, key=key, text=text)
    return docs.where(score_udf(docs.sparkSession, model)(F.coalesce(F.col(text), F.lit(""))) < 0.5)
