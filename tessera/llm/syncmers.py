"""Fingerprints of documents from closed syncmers.

A k-mer of bytes is a closed syncmer if the smallest of the hashes of its s-mers stands at
its first or last place. Whether it is depends on the k-mer alone, so an edit changes only
the anchors it touches, and the same passage gives the same anchors wherever it stands.
Two texts are as alike as the anchors that match in order: equal anchors are paired,
repeats by their number, and of the pairs the longest run counts whose places rise in both.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches

K, S, SKETCH = 20, 8, 128

A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * B
    x = (x ^ (x >> np.uint64(29))) * A
    return x ^ (x >> np.uint64(32))


def _words(raw: bytes) -> np.ndarray:
    """The 8 bytes from each place as a number."""
    n = len(raw) - 7
    out = np.empty(n, dtype=np.uint64)
    for i in range(min(8, n)):
        out[i::8] = np.frombuffer(raw, dtype="<u8", offset=i, count=(n - i + 7) // 8)
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    m, span = x, 1
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    rest = width - span
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places (in UTF-8 bytes) and 32-bit hashes of the closed syncmers, in order.

    A text shorter than a k-mer has one anchor for the whole; an empty one has none.
    """
    raw = text.encode()
    if len(raw) < K:
        whole = int.from_bytes(hashlib.blake2b(raw, digest_size=4).digest(), "big")
        return np.arange(min(1, len(raw))), np.full(min(1, len(raw)), whole, dtype=np.uint32)
    words = _words(raw)
    hashed = _mixed(words * A)
    width = K - S + 1
    least = _sliding_min(hashed, width)
    at = np.flatnonzero((hashed[: len(least)] == least) | (hashed[width - 1 :] == least))
    both = words[at] * A + words[at + (K - S) // 2] * B + words[at + K - S] * C
    return at, (_mixed(both) >> np.uint64(32)).astype(np.uint32)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The SKETCH smallest distinct hashes."""
    return np.unique(hashes)[:SKETCH]


def to_string(found: tuple[np.ndarray, np.ndarray]) -> str:
    """The smallest hashes, and a digest of all anchors with their places."""
    places, hashes = found
    whole = hashlib.blake2b(places.astype("<u8").tobytes() + hashes.astype("<u4").tobytes(), digest_size=8).hexdigest()
    return f"{sketch(hashes).astype('>u4').tobytes().hex()}-{whole}"


def numbered(hashes: np.ndarray) -> np.ndarray:
    """Each anchor's hash with the number of equal ones before it, as one distinct key."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    out = np.empty(len(hashes), dtype=np.uint64)
    out[order] = ordered.astype(np.uint64) << np.uint64(32) | (np.arange(len(hashes)) - np.repeat(first, np.diff(np.r_[first, len(hashes)]))).astype(np.uint64)
    return out


def rising(places: np.ndarray) -> np.ndarray:
    """Indices of a longest run of rising places."""
    if (places[1:] > places[:-1]).all():
        return np.arange(len(places))
    tops, at, before = [], [], np.full(len(places), -1)
    for i, p in enumerate(places.tolist()):
        j = bisect_left(tops, p)
        tops[j : j + 1], at[j : j + 1] = [p], [i]
        before[i] = at[j - 1] if j else -1
    out, i = [], at[-1]
    while i >= 0:
        out.append(i)
        i = int(before[i])
    return np.array(out[::-1])


Anchors = tuple[np.ndarray, np.ndarray]


def matched(a: Anchors, b: Anchors) -> np.ndarray:
    """The places (one row each for a and b) of the anchors that match in order."""
    _, x, y = np.intersect1d(numbered(a[1]), numbered(b[1]), assume_unique=True, return_indices=True)
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    keep = rising(y) if len(y) else np.empty(0, dtype=np.int64)
    return np.stack([a[0][x[keep]], b[0][y[keep]]])


def likeness(a: Anchors, b: Anchors) -> float:
    """The share of all anchors of both texts that match in order; two empty ones are alike."""
    n = len(a[1]) + len(b[1])
    return 2.0 * matched(a, b).shape[1] / n if n else 1.0


def positional_match(a: str, b: str) -> list[tuple[int, int]]:
    """The places in both texts of the anchors that match in order."""
    return [tuple(p) for p in matched(anchors(a), anchors(b)).T.tolist()]


def next_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """part, k, t, ghost: the rows dealt by ranges of the key, ranges whole and in order.

    In each part rows stand by descending key (nulls last, equal keys by text), and a copy
    of the row that comes next in the following part, marked as ghost, stands last; after
    the very last part that is the first row of all. Only range borders and the largest key
    of each part reach the driver, as many as there are parts.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    lowest = -(1 << 63)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("order", F.coalesce("k", F.lit(lowest)))
    shares = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("order", shares, 100 * parts).alias("x")).first()["x"] if shares else None
    borders = np.array(sorted(set(found or [])), dtype=np.int64)

    @F.pandas_udf("int")
    def part_of(order):
        import pandas as pd

        return pd.Series(len(borders) - np.searchsorted(borders, order.to_numpy(), side="right"))

    rows = rows.withColumn("part", part_of("order"))
    heads = sorted((r["part"], r["top"]) for r in rows.groupBy("part").agg(F.max("order").alias("top")).collect())
    if not heads:
        return rows.select("part", "k", "t", F.lit(False).alias("ghost"), "order")
    follow = [(heads[(i + 1) % len(heads)][1], part) for i, (part, _) in enumerate(heads)]
    wanted = spark.createDataFrame(follow, "top long, to int")
    ghosts = (
        rows.join(F.broadcast(wanted), F.col("order") == F.col("top"))
        .groupBy("to")
        .agg(F.min("t").alias("t"), F.min("order").alias("order"))
        .select(F.col("to").alias("part"), F.lit(None).cast("long").alias("k"), "t", F.lit(True).alias("ghost"), "order")
    )
    dealt = rows.select("part", "k", "t", F.lit(False).alias("ghost"), "order").unionByName(ghosts)
    return dealt.repartitionById(parts, "part").sortWithinPartitions("part", "ghost", F.desc("order"), "t")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    The edited form has its last third (rounded down, in code points) replaced by as many
    of the first code points of the next document, by descending key. Returns key, n_chars
    long, edited_sha256, fingerprint, edited_fingerprint string, near_edited, near_next
    double, n_anchors long. A fingerprint is the anchors of the whole text with their
    places, and the likenesses are of all of them; as a string it is written short, as the
    SKETCH or fewer smallest anchor hashes of 8 hexadecimal digits, then a dash and the
    digest of all anchors and places in 16. Null texts count as empty. Null keys come last; rows of equal key stand by
    text. A table of one row is its own next; other columns aren't read.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held = None  # the row that still lacks its next one
        for batch in batches:
            out = []
            for part, k, t, ghost in zip(*(batch.column(i) for i in range(4)), strict=True):
                row = (part.as_py(), k.as_py(), t.as_py(), ghost.as_py())
                row += (anchors(row[2]),)
                if held and not held[3]:
                    out.append(judged(held, row))
                held = row
            yield pa.RecordBatch.from_pylist(out, schema)

    import pyarrow as pa

    schema = pa.schema(
        [("k", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
         ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_anchors", pa.int64())]
    )
    rows = next_rows(docs, key, text).select("part", "k", "t", "ghost")
    out = rows.mapInArrow(run, "k long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_anchors long")
    return out.withColumnRenamed("k", key)


def judged(row: tuple, following: tuple) -> dict:
    text, own = row[2], row[4]
    n = len(text)
    edited = text[: n - n // 3] + following[2][: n // 3]
    changed = anchors(edited)
    return {
        "k": row[1], "n_chars": n, "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(), "fingerprint": to_string(own),
        "edited_fingerprint": to_string(changed), "near_edited": likeness(own, changed), "near_next": likeness(own, following[4]), "n_anchors": len(own[1]),
    }
