"""Near-duplicate removal at a word-shingle similarity, by an exact prefix filter.

Candidates come from anchors. All shingles stand in one order for all texts, rare ones
first; the anchors of a text of n distinct shingles are its first floor(n / 5) + 1 for a
similarity of 0.8. Two texts that similar have an anchor in common, whatever was changed and
however short they are. The first common one leaves each of them as many shingles after it
as they must share, so pairs are compared only where lengths and places allow that (both
bounds are exact), and then the Jaccard similarity decides.

Before that, fingerprints are compared by pivot distance tables and by Hamming distance. A
bit of such a fingerprint is the parity of the text's distinct shingles that fall on it, so
two fingerprints differ in no more bits than there are shingles in only one of the texts;
the similarity bounds that number. So the radius, which grows with the texts' lengths, is
exact too. The majority bits of SimHash have no such bound, and no radius for them is safe.

Texts of an anchor are compared with each other up to SMALL of them. In larger groups each
is first compared with the anchor's chiefs, one for each class of lengths: the text with the
fewest rarer shingles, as each edit of a copy makes such shingles. What these links leave apart is then compared in full: all pairs of an anchor whose texts
aren't connected yet. So a large group of copies costs little more than its rows, and no
link is left out; SMALL and the chiefs decide about the work, never about the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, checkpointed
from tessera.llm.components import components
from tessera.llm.simhash import SEED, shingles, signed

K, SIMILARITY = 5, 0.8
#: Texts of an anchor up to which all pairs are candidates.
SMALL = 4
#: Counters of texts by the low bits of a shingle's hash, and the parts they are summed in.
COUNTERS, PARTS = 1 << 20, 64
#: Bits of a fingerprint, and the references of its pivot table, whose distances one long holds.
BITS, PIVOTS, WIDTH = 256, 7, 9
#: Room for rounding in the bounds, which may only let more pairs through.
ROOM = 1e-6


def distinct_shingles(text: str, k: int) -> np.ndarray:
    parts = list(shingles(text, k))
    return np.unique(np.concatenate(parts).astype(np.uint64)) if parts else np.empty(0, dtype=np.uint64)


def anchors(distinct: np.ndarray, rarity: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The first shingles in the order of (rarity class, hash), as many as can't all be missed by a similar text."""
    n = len(distinct)
    if not n:
        return distinct
    order = np.argsort(rarity[(distinct & np.uint64(COUNTERS - 1)).astype(np.int64)], kind="stable")
    return distinct[order[: n - int(np.ceil(similarity * n - ROOM)) + 1]]


def parities(distinct: np.ndarray) -> list[int]:
    """BITS bits as signed longs: of each the parity of the number of shingles on it."""
    odd = np.bincount(((distinct >> np.uint64(20)) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(">i8").astype(np.int64).tolist()


def _bits(side: str = "") -> list[Column]:
    return [F.col(f"{side}b{i}") for i in range(BITS // 64)]


def pivots() -> Column:
    """The distances of the fingerprint to the references, WIDTH bits each."""
    out = F.lit(0).cast("long")
    for k in range(PIVOTS):
        words = [signed(xxhash.xxh64_intdigest(f"{k}:{i}", SEED)) for i in range(BITS // 64)]
        distance = sum((F.bit_count(b.bitwiseXOR(F.lit(w))) for b, w in zip(_bits(), words, strict=True)), F.lit(0))
        out = out.bitwiseOR(F.shiftleft(distance.cast("long"), WIDTH * k))
    return out


def near_by_bits(x: str, y: str, similarity: float) -> Column:
    """Whether the fingerprints of x and y, by their pivots first, differ in no more bits than similar texts may in shingles."""
    radius = (F.col(f"{x}.n") + F.col(f"{y}.n")) * F.lit((1 - similarity) / (1 + similarity)) + ROOM
    part = lambda side, k: F.shiftrightunsigned(F.col(f"{side}.pivots"), WIDTH * k).bitwiseAND(F.lit((1 << WIDTH) - 1))
    apart = F.greatest(*[F.abs(part(x, k) - part(y, k)) for k in range(PIVOTS)])
    distance = sum((F.bit_count(a.bitwiseXOR(b)) for a, b in zip(_bits(f"{x}."), _bits(f"{y}."), strict=True)), F.lit(0))
    return (apart <= radius) & (distance <= radius)


def rarity_classes(docs: DataFrame, k: int) -> np.ndarray:
    """For each counter the binary logarithm of its number of texts; docs(id, dig, t).

    Any order of the shingles gives the same links; this one keeps the anchors of common
    passages few. The counters are a megabyte at the driver, whatever the number of texts.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            for t in batch.column(0):
                counts[(distinct_shingles(t.as_py(), k) & np.uint64(COUNTERS - 1)).astype(np.int64)] += 1
        if counts.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(PARTS), pa.int32()), pa.array([c.tobytes() for c in np.split(counts, PARTS)], pa.binary())], names=["part", "counts"]
            )

    def added(table):
        import pyarrow as pa

        total = np.zeros(COUNTERS // PARTS, dtype=np.uint64)
        for c in table.column("counts"):
            total += np.frombuffer(c.as_py(), dtype=np.uint32)
        classes = np.log2(total + 1.0).astype(np.uint8)
        return pa.table({"part": table.column("part")[:1], "classes": pa.array([classes.tobytes()], pa.binary())})

    parts = docs.select("t").mapInArrow(run, "part int, counts binary").groupBy("part").applyInArrow(added, "part int, classes binary")
    out = np.zeros((PARTS, COUNTERS // PARTS), dtype=np.uint8)
    for r in parts.collect():
        out[r.part] = np.frombuffer(bytes(r.classes), dtype=np.uint8)
    return out.reshape(-1)


def _sketches(docs: DataFrame, k: int, similarity: float) -> DataFrame:
    """id, dig, n (distinct shingles), anchors, bits (its fingerprint) of the rows of docs(id, dig, t)."""
    rarity = rarity_classes(docs, k)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes, found, bits = [], [], []
            for t in batch.column(2):
                h = distinct_shingles(t.as_py(), k)
                sizes.append(len(h))
                found.append(anchors(h, rarity, similarity).view(np.int64))
                bits.append(parities(h))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(found, longs), pa.array(bits, longs)],
                names=["id", "dig", "n", "anchors", "bits"],
            )

    return docs.mapInArrow(run, "id long, dig string, n int, anchors array<long>, bits array<long>")


def _shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """node, set (distinct 32-bit shingle hashes) of the rows of docs(node, t)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sets = []
            for t in batch.column(1):
                parts = [(h >> np.uint64(32)).astype(np.uint32) for h in shingles(t.as_py(), k)]
                sets.append(np.unique(np.concatenate(parts)).view(np.int32) if parts else np.empty(0, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int32()))], names=["node", "set"])

    return docs.mapInArrow(run, "node long, set array<int>")


def _possible(x: str, y: str, similarity: float) -> Column:
    """Whether lengths n and what is left from the common anchor on allow the similarity."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    common = F.least(F.col(f"{x}.left"), F.col(f"{y}.left")) >= similarity / (1 + similarity) * (n + m) - ROOM
    return common & (F.least(n, m) >= similarity * F.greatest(n, m) - ROOM)


def _met(x: DataFrame, y: DataFrame, similarity: float, more: Column | None = None) -> DataFrame:
    """a, b of the pairs of an anchor, the longer text from x, the shorter from the inner rows of y."""
    n, m = F.col("x.n"), F.col("y.n")
    fits = (F.col("x.anchor") == F.col("y.anchor")) & ((m < n) | ((m == n) & (F.col("y.node") < F.col("x.node")))) & _possible("x", "y", similarity)
    met = x.alias("x").join(y.where("inner").alias("y"), fits if more is None else fits & more)
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def anchored(nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """anchor, node, n, left, inner, size of the anchors that could give a pair.

    left counts the shingles from the anchor on; inner rows have enough of them for a partner
    of their own length, which the shorter text of a pair needs.
    """
    rows = nodes.select("node", "n", F.posexplode("anchors").alias("at", "anchor"))
    rows = rows.select("anchor", "node", "n", (F.col("n") - F.col("at")).alias("left"))
    inner = F.col("left") >= 2 * similarity / (1 + similarity) * F.col("n") - ROOM
    # Sums are written before they are joined: a join that stands on an aggregate can't be split where a key is hot.
    sizes = checkpointed(rows.groupBy("anchor").agg(F.count("*").alias("size"), F.count_if(inner).alias("inners")).where("size > 1 AND inners > 0"))
    return checkpointed(rows.join(sizes.drop("inners"), "anchor").withColumn("inner", inner))


def candidates(shared: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """a, b (a < b) of anchored(): all possible pairs of small anchors, and large ones' rows with their chiefs."""
    small = shared.where(F.col("size") <= SMALL)
    pairs = _met(small, small, similarity)
    large = shared.where(F.col("size") > SMALL).withColumn("class", F.floor(F.ln("n") / math.log(1 / similarity)).cast("int"))
    turned = F.col("node").bitwiseXOR(F.col("anchor"))
    # What stands before the anchor is rarer: mostly shingles of a copy's own, which its edits have made.
    order = F.struct((F.col("left") / F.col("n")).alias("clean"), turned.alias("t"), "n", "left")
    chiefs = checkpointed(large.where("inner").groupBy("anchor", "class").agg(F.max(order).alias("y")))
    near = F.explode(F.array(*[F.col("class") + i for i in (-1, 0, 1)]))
    led = large.select("anchor", near.alias("class"), F.struct("node", "n", "left").alias("x")).join(chiefs, ["anchor", "class"])
    led = led.where(_possible("x", "y", similarity)).select(F.col("x.node").alias("node"), F.col("y.t").bitwiseXOR(F.col("anchor")).alias("other"))
    stars = led.where("node <> other").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    return pairs.unionByName(stars).distinct()


def unlinked(shared: DataFrame, groups: DataFrame, marks: DataFrame, similarity: float = SIMILARITY) -> DataFrame | None:
    """a, b of the possible pairs of large anchors whose texts are in different groups(node, root); None if there can't be any.

    Of an anchor's largest group no two rows meet, so that it is never compared with itself.
    Fingerprints, from marks(node, ...), are compared where rows meet, so that of the many
    pairs of a group of texts that are nearly similar enough, few become rows.
    """
    large = shared.where(F.col("size") > SMALL)
    if large.isEmpty():
        return None
    rooted = large.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counts = rooted.groupBy("anchor", "root").agg(F.count("*").alias("rows"))
    tops = counts.groupBy("anchor").agg(F.max(F.struct("rows", "root"))["root"].alias("top"), F.count("*").alias("roots")).where("roots > 1")
    apart = rooted.join(checkpointed(tops), "anchor").withColumn("main", F.col("root") == F.col("top")).drop("top", "roots", "size")
    apart = checkpointed(apart.join(marks.drop("n"), "node"))
    near, differ = near_by_bits("x", "y", similarity), F.col("x.root") != F.col("y.root")
    rest = apart.where("NOT main")
    return _met(rest, apart, similarity, differ & near).unionByName(_met(apart.where("main"), rest, similarity, near)).distinct()


def verified(met: DataFrame, sets: DataFrame, marks: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs a, b whose fingerprints are near enough and whose sets have the similarity."""
    x, y = marks.withColumnRenamed("node", "a").alias("x"), marks.withColumnRenamed("node", "b").alias("y")
    pairs = checkpointed(met.join(x, "a").join(y, "b").where(near_by_bits("x", "y", similarity)).select("a", "b"))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b"
    )
    common = F.size(F.array_intersect("sa", "sb"))
    return checkpointed(both.where(common >= similarity * (F.size("sa") + F.size("sb") - common)).select("a", "b"))


def keepers(docs: DataFrame, k: int = K, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text", repeats: bool = True) -> DataFrame:
    """id, dig of the one row of each group of near copies that stays: that of the smallest key.

    dig is the md5 of the text. Equal texts are one node from the start. repeats: whether
    rows may repeat key and text.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("dig"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    sketched = _sketches(rows, k, similarity).groupBy("dig").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n", "anchors", "bits")])
    sketched = sketched.select("id", "dig", "n", "anchors", *[F.get("bits", F.lit(i)).alias(f"b{i}") for i in range(BITS // 64)])
    # Written once, so that the numbers stay as they are.
    nodes = checkpointed(sketched.withColumn("pivots", pivots()).withColumn("node", F.monotonically_increasing_id()))
    marks = nodes.select("node", "n", "pivots", *_bits())
    shared = anchored(nodes, similarity)
    # The sets of all texts that share an anchor: the texts are moved once, whatever is compared later.
    wanted = nodes.join(shared.select("node").distinct(), "node").select("node", F.col("dig").alias("d"), F.col("id").alias("i"))
    texts = rows.join(wanted, F.col("dig").eqNullSafe(F.col("d")) & F.col("id").eqNullSafe(F.col("i"))).select("node", "t")
    sets = checkpointed(_shingle_sets(texts.dropDuplicates(["node"]) if repeats else texts, k))
    groups = components(verified(candidates(shared, similarity), sets, marks, similarity))
    apart = unlinked(shared, groups, marks, similarity)
    if apart is not None:
        # What is found now links groups, so only their roots are grouped again.
        more = verified(apart, sets, marks, similarity)
        for side in "ab":
            named = groups.select(F.col("node").alias(side), F.col("root").alias("r"))
            more = more.join(named, side, "left").withColumn(side, F.coalesce("r", side)).drop("r")
        again = components(more).select(F.col("node").alias("root"), F.col("root").alias("top"))
        single = again.join(groups.select("root").distinct(), "root", "left_anti").select(F.col("root").alias("node"), F.col("top").alias("root"))
        groups = groups.join(again, "root", "left").select("node", F.coalesce("top", "root").alias("root")).unionByName(single)
    rooted = nodes.select("node", "id", "dig").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rooted.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "dig")).alias("m")).select("m.id", "m.dig")


def drop_near_copies(docs: DataFrame, k: int = K, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without near copies: one row of each group stays, that of the smallest key.

    Groups are what links of at least the similarity connect, on sets of k-word shingles of
    A-Z lower-cased texts. Texts without words are copies of each other only where they are
    equal; null texts count as empty. A null key stays only if the group has no other.
    Rows that repeat key and text are copies too. All columns are returned, whatever their
    names; an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    repeats = not docs.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    kept = checkpointed(keepers(docs, k, similarity, key, text, repeats)).toDF("__id", "__dig")
    names = docs.columns
    own = [f"c{i}" for i in range(len(names))]
    at = {n: own[names.index(n)] for n in (key, text)}
    marked = docs.toDF(*own).withColumn("dig", F.md5(F.coalesce(F.col(at[text]), F.lit(""))))
    out = marked.join(kept, (F.col("dig") == F.col("__dig")) & F.col(at[key]).cast("long").eqNullSafe(F.col("__id")), "left_semi")
    out = out.dropDuplicates([at[key], "dig"]) if repeats else out
    return out.select(*[F.col(c).alias(n) for c, n in zip(own, names, strict=True)])
