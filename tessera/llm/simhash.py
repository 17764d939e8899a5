"""SimHash fingerprints, their links by pivot distance tables, and near-duplicate removal.

A pivot table holds each fingerprint's Hamming distances to many reference fingerprints. By
the triangle inequality two fingerprints within a radius differ by no more than the radius
in every coordinate, so pairs whose largest coordinate difference is more are discarded
without looking at them; survivors are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, checkpointed
from tessera.llm.components import components

SEED, BITS, RADIUS, PIVOTS = 42, 64, 2, 16

#: Shingles hashed at a time, which bounds the memory for a very long text.
PORTION = 1 << 17

#: Distinct fingerprints of a bucket up to which its pairs are compared with each other.
SMALL = 32


def shingles(text: str, k: int) -> Iterator[np.ndarray]:
    """XXH64 of each k-word shingle of the A-Z lower-cased text, repeats included, in portions."""
    words = text.encode().lower().split()  # both as for ASCII letters and white space alone
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - k + 1)
    ends = ends[min(k, len(words)) - 1 :]
    digest = xxhash.xxh64_digest
    for i in range(0, n, PORTION):
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[i : min(n, i + PORTION)].tolist(), ends[i : i + PORTION].tolist(), strict=True)])
        yield np.frombuffer(raw, dtype=">u8")


def fingerprint(hashes: list[np.ndarray] | Iterator[np.ndarray]) -> int:
    """A bit is 1 if it is set in over half of the hashes; no hashes give zero."""
    ones, n = np.zeros(BITS, dtype=np.int64), 0
    for h in hashes:
        for i in range(0, len(h), 8192):
            some = h[i : i + 8192]
            ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big") if n else 0


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def references(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints from a rule: XXH64 of their numbers."""
    return [signed(xxhash.xxh64_intdigest(str(i), SEED)) for i in range(n)]


def pivot_table(df: DataFrame, fp: str = "fp", n: int = PIVOTS) -> DataFrame:
    """Adds the distances to the references as p0, p1, ..."""
    return df.withColumns({f"p{i}": F.bit_count(F.col(fp).bitwiseXOR(F.lit(r))).cast("tinyint") for i, r in enumerate(references(n))})


def passes_pivots(a: str, b: str, radius: int, n: int = PIVOTS) -> Column:
    """Whether the largest coordinate difference of rows a and b is within the radius."""
    return reduce(Column.__and__, (F.abs(F.col(f"{a}.p{i}") - F.col(f"{b}.p{i}")) <= radius for i in range(n)))


def block_keys(fp: str) -> Column:
    """Of four 16-bit blocks two at least are equal within the radius of 2; a key for each two."""
    block = [F.shiftrightunsigned(F.col(fp), 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    return F.array(
        *[F.shiftleft(F.lit(k).cast("long"), 32).bitwiseOR(F.shiftleft(block[i], 16)).bitwiseOR(block[j]) for k, (i, j) in enumerate(combinations(range(4), 2))]
    )


def links(fps: DataFrame) -> DataFrame:
    """Edges a, b that connect just those distinct fingerprints fp which links at RADIUS bits connect.

    Buckets of equal blocks hold all pairs within the radius. In buckets of up to SMALL
    fingerprints all pairs go through the pivot filter and the exact check, inside the join,
    so that only links become rows. Fingerprints of larger buckets are linked exactly in
    linear work: two are within 2 bits if and only if some 64-bit string is within 1 bit of
    both, so each goes to the 65 strings around it, and all that meet there (65 at most) are
    tied to the smallest. So no bucket, however large, is compared pair by pair.
    """
    table = pivot_table(fps.select("fp").distinct())
    rows = table.withColumn("key", F.explode(block_keys("fp")))
    # Written before it is joined: a join that stands on an aggregate can't be split where a key is hot.
    sizes = checkpointed(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"))
    shared = checkpointed(rows.join(sizes, "key"))
    small = shared.where(F.col("size") <= SMALL)
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= RADIUS
    pairs = (
        small.alias("x")
        .join(small.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp")) & passes_pivots("x", "y", RADIUS) & near)
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    large = shared.where(F.col("size") > SMALL).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << i)).cast("long") for i in range(BITS)])
    around = F.transform(flips, lambda flip: F.col("fp").bitwiseXOR(flip))
    balls = large.select("fp", F.explode(around).alias("centre"))
    least = balls.groupBy("centre").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = balls.join(least, "centre").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def simhash_components(docs: DataFrame, k: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's SimHash fingerprint and its group.

    Returns key, fingerprint string (16 hexadecimal digits) and component_id (the smallest
    key that links of RADIUS bits or fewer reach, itself included). Texts without words,
    nulls too, have fingerprint zero, which is linked like any other; texts of fewer words
    than k have one shingle. Repeated rows and null keys give a row each (null only if all
    keys of the group are null); an empty table gives an empty one; other columns aren't read.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            fps = [signed(fingerprint(shingles(t.as_py(), k))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["k", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    marked = checkpointed(rows.mapInArrow(run, "k long, fp long"))
    fps = marked.groupBy("fp").agg(F.min("k").alias("least"))
    groups = components(links(fps))
    rooted = fps.join(groups, fps.fp == groups.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = checkpointed(rooted)
    # Written before they are joined, so that the part of a large group or of a fingerprint that many rows have can be split.
    tops = checkpointed(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = checkpointed(rooted.join(tops, "root").select("fp", "component_id"))
    return marked.join(named, "fp").select(
        F.col("k").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
