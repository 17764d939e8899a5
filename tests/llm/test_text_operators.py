"""Token counts, BPE, SimHash, syncmers and near copies against brute force and the library."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import types as T
from pyspark.sql.functions import col, get, lit, monotonically_increasing_id

from tessera.llm import bpe, components, near_dedup, simhash, syncmers, token_counts

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
ALPHABET = "abcdeéß中日。'stre0123!?<|endoftext|> 　 \x1c\x85👍́ABC  \n\t"


def library():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


def odd_texts(n, seed, size=60):
    rng = random.Random(seed)
    parts = lambda: rng.choice([rng.choice(ALPHABET), rng.choice(ALPHABET), "the ", "<|endoftext|>", " and", "'re", "  ", " onlythe", "xqzj"])
    return ["".join(parts() for _ in range(rng.randint(0, size))) for _ in range(n)]


def docs_of(spark, texts, extra=False):
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    if extra:  # columns whose names clash with the operators' own
        from pyspark.sql import functions as F

        for name in ("n_tokens", "k", "t", "fp", "part", "order", "score", "node", "key", "__of", "__id", "dig", "c0"):
            df = df.withColumn(name, F.lit("clash"))
    return df


EDGES = [None, "", " ", "a", "a", "\n\n", "word " * 3000, "x" * 5000, "the cat sat " * 2]


@pytest.fixture(scope="module")
def encoder():
    return bpe.ByteBPE(bpe.default_path())


def test_bpe_equals_the_library(encoder):
    t = library()
    for x in odd_texts(1200, 1) + [e or "" for e in EDGES]:
        want = t.encode(x, add_special_tokens=False).ids
        assert encoder.encode(x) == want, x
        assert encoder.decode(want) == t.decode(want, skip_special_tokens=False)
    assert 0 < encoder.stats["failed"] < encoder.stats["proposed"]


def test_verification_is_right_for_each_word(encoder):
    words = [w.encode() for x in odd_texts(300, 5) for w in encoder.word.findall(x) if w]
    tokens, owner = encoder.propose_all(words)
    good = encoder.verify(tokens, owner, len(words))
    for word, ok, ids in zip(words, good, bpe.per_word(tokens, owner, len(words)), strict=True):
        assert ids == encoder.propose(word)
        assert ok == (ids == encoder.merge(word))
    merged = list(bpe.per_word(*encoder.merge_all(words), len(words)))
    assert merged == [encoder.merge(w) for w in words]


def test_pieces_join_to_the_text():
    for x in odd_texts(500, 3):
        assert "".join(bpe.pieces(x)) == x


def test_bpe_query(spark):
    texts = EDGES + odd_texts(50, 2)
    rows = {r.doc_id: r for r in bpe.encode_decode(docs_of(spark, texts, True)).collect()}
    t = library()
    for i, x in enumerate(texts):
        ids = t.encode(x or "", add_special_tokens=False).ids
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_decode(docs_of(spark, [])).count() == 0


def test_cache_turns_over(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 20)
    b, t = bpe.ByteBPE(bpe.default_path()), library()
    for x in odd_texts(100, 9):
        assert b.encode(x) == t.encode(x, add_special_tokens=False).ids


def test_chunks_are_spliced_rightly():
    c, t = token_counts.Counter(bpe.default_path(), chunk=60, overlap=8), library()
    for x in odd_texts(900, 4, 150) + ["a" * 1000, "中" * 500, " " * 700, "\n" * 300 + "a b c d" * 50, "", "a b" * 40 + "<|endoftext|>" * 30, "it's they'll, 3.5'd " * 60, "a1²_-b\tc\nd!" * 90, "e\u0301x" * 200]:
        assert c.count(x) == len(t.encode(x, add_special_tokens=False).ids), x
    assert c.widened > 0 and c.spliced > 400


def test_most_texts_are_spliced_at_the_usual_sizes():
    rng = random.Random(14)
    c, t = token_counts.Counter(bpe.default_path()), library()
    texts = [prose(rng, n) for n in (150, 151, 300, 2000, 9000, 40_000)] + ["é" * 70_000, "x" * 70_000 + " end of it", "word  " * 20_000]
    texts += ["a " * k for k in (511, 512, 513, 32_768)] + ["".join(odd_texts(900, 15))]
    for x in texts:
        before = c.spliced
        assert c.count(x) == len(t.encode(x, add_special_tokens=False).ids)
        assert c.spliced > before or len(x) <= token_counts.CHUNK or "é" in x or "x" in x or "  " in x
    assert c.spliced > 300 and c.widened > 0
    before, widened = c.spliced, c.widened
    chinese = "".join(rng.choice("中文字符没有空格的文本") if rng.random() < 0.9 else rng.choice("，。") for _ in range(60_000))
    assert c.count(chinese) == len(t.encode(chinese, add_special_tokens=False).ids) and c.spliced - before > 60 and c.widened == widened


def test_other_vocabularies_are_refused(tmp_path):
    import json

    spec = json.load(open(bpe.default_path(), encoding="utf-8"))
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}):
        with pytest.raises(ValueError):
            bpe.check_splitting(spec | change)
    bpe.check_splitting(spec)


def test_token_count_query(spark):
    texts = EDGES + odd_texts(30, 6)
    t = library()
    for sizes in ({}, {"chunk": 100, "overlap": 10}):
        rows = {r.doc_id: r for r in token_counts.token_counts(docs_of(spark, texts, True), **sizes).collect()}
        for i, x in enumerate(texts):
            n = len(t.encode(x or "", add_special_tokens=False).ids)
            assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len((x or "").encode()), n, n > 512)
    assert token_counts.token_counts(docs_of(spark, [])).count() == 0


REPEATED = [(7, "same text twice"), (7, "same text twice"), (None, "no key"), (None, "no key"), (None, None)]


@pytest.mark.parametrize("apply", [token_counts.token_counts, bpe.encode_decode, simhash.simhash_components, syncmers.fingerprints])
def test_repeated_rows_and_null_keys_give_a_row_each(spark, apply):
    out = apply(spark.createDataFrame(REPEATED, DOCS)).collect()
    assert sorted(str(r.doc_id) for r in out) == ["7", "7", "None", "None", "None"]
    twice = [r for r in out if r.doc_id == 7]
    assert apply is syncmers.fingerprints or twice[0] == twice[1]  # a syncmer row has the next row's text in it


def brute_fingerprint(text, k):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(keys, linked):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta"]) + str(rng.randint(0, 60)) for _ in range(n))


def test_simhash_against_brute_force(spark):
    rng = random.Random(7)
    base = prose(rng, 400)
    texts = [None, "", "One", "one", "Two words", base, base.upper(), "a\x0bb\x0cc\td\u00a0e"]
    for _ in range(60):
        words = base.split()
        words[rng.randrange(400)] = "new" + str(rng.randint(0, 9))
        texts.append(" ".join(words))
    texts += [prose(rng, 30) for _ in range(40)]
    got = {r.doc_id: r for r in simhash.simhash_components(docs_of(spark, texts, True)).collect()}
    fps = {i: brute_fingerprint(t or "", 3) for i, t in enumerate(texts)}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    want = brute_groups(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(texts) and got[0].component_id == 0
    assert simhash.simhash_components(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("small", [1, 32])
def test_links_connect_as_brute_force_does(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(small)
    centre = rng.getrandbits(64)
    fps = {0, centre} | {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(80)} | {rng.getrandbits(64) for _ in range(30)}
    edges = simhash.links(spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long"))
    got = {r.node: r.root for r in components.components(edges).collect()}
    signed = sorted(map(simhash.signed, fps))
    want = brute_groups(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    assert {f: got.get(f, f) for f in signed} == want


def test_pivots_discard_most_of_what_is_not_linked(spark):
    rng = random.Random(41)
    fps = sorted({simhash.signed(rng.getrandbits(48) << 16 | 7) for _ in range(300)})  # one block in common, as in a bucket
    near = [simhash.signed((fps[i] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))) & (2**64 - 1)) for i in range(20)]
    table = simhash.pivot_table(spark.createDataFrame([(f,) for f in {*fps, *near}], "fp long"))
    both = table.alias("x").join(table.alias("y"), col("x.fp") < col("y.fp"))
    close = both.where("bit_count(x.fp ^ y.fp) <= 2").count()
    passed = both.where(simhash.passes_pivots("x", "y", simhash.RADIUS)).count()
    assert 15 <= close <= passed < 0.001 * both.count() + close


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 150)]
    df = spark.createDataFrame([*chain, *star, (5, 5), (3, 2), (None, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 150)}}
    assert components.components(df.limit(0)).count() == 0


def test_near_copies_against_brute_force(spark):
    rng = random.Random(11)
    common = prose(rng, 70)
    texts = [None, "", "", "short text", "short text", "Short  text"]
    for _ in range(12):
        base = prose(rng, rng.randint(60, 200)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 20)):
            words = list(base)
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = "edit" + str(rng.randint(0, 99))
            texts.append(" ".join(words))
    texts += [prose(rng, 100) + " " + common + " " + prose(rng, 100) for _ in range(30)]
    sets = {i: {" ".join(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for i, t in enumerate(texts)}
    close = lambda a, b: (texts[a] or "") == (texts[b] or "") or (sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    want = {i for i, r in brute_groups(list(sets), close).items() if i == r}
    df = docs_of(spark, texts, True)
    out = near_dedup.drop_near_copies(df)
    rows = out.collect()
    assert {r.doc_id for r in rows} == want and out.columns == df.columns and {(r["__of"], r.c0) for r in rows} == {("clash", "clash")}
    assert near_dedup.drop_near_copies(docs_of(spark, [])).count() == 0


def test_a_large_group_is_found_by_its_original(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    rng = random.Random(12)
    base = prose(rng, 300).split()
    texts = []
    for i in range(80):
        words = list(base)
        for _ in range(6 if i != 41 else 0):  # far from each other, close to the original
            words[rng.randrange(len(words))] = "edit" + str(rng.randint(0, 9999))
        texts.append(" ".join(words))
    assert [r.doc_id for r in near_dedup.drop_near_copies(docs_of(spark, texts)).collect()] == [0]


def test_fingerprints_bound_the_difference_of_shingles(spark):
    import numpy as np

    rng = random.Random(31)
    rows = []
    for i in range(40):
        words = prose(rng, rng.randint(1, 300)).split()
        for _ in range(2):
            for _ in range(rng.randint(0, 8)):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 99)}"
            h = near_dedup.distinct_shingles(" ".join(words), 5)
            rows.append((i, len(h), near_dedup.parities(h), h.view(np.int64).tolist()))
    df = spark.createDataFrame(rows, "i int, n int, bits array<long>, h array<long>").select("i", "n", "h", *[get("bits", lit(j)).alias(f"b{j}") for j in range(4)])
    df = df.withColumn("pivots", near_dedup.pivots()).withColumn("row", monotonically_increasing_id())
    both = df.alias("x").join(df.alias("y"), (col("x.row") < col("y.row")))
    got = both.select("x.h", col("y.h").alias("g"), near_dedup.near_by_bits("x", "y", 0.8).alias("near")).collect()
    similar = [len(set(r.h) & set(r.g)) >= 0.8 * len(set(r.h) | set(r.g)) for r in got]
    assert all(r.near for r, s in zip(got, similar, strict=True) if s) and 5 < sum(similar)
    assert sum(r.near for r in got) < 0.2 * len(got)


def near_copies_left(spark, texts):
    return {r.doc_id for r in near_dedup.drop_near_copies(docs_of(spark, texts)).collect()}


def test_edited_copies_are_found_beside_a_passage_many_share(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    rng = random.Random(21)
    common = " ".join(f"c{i}" for i in range(250))
    owns = [[f"o{rng.randrange(10**9)}" for _ in range(50)] for _ in range(120)]
    texts = [f"{common} {' '.join(o)}" for o in owns]
    for o in owns:
        words = list(o)
        words[rng.randrange(10, 40)] = "changed"
        texts.append(f"{common} {' '.join(words)}")
    assert near_copies_left(spark, texts) == set(range(120))


def test_a_chain_within_a_large_anchor_is_followed(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 4)
    rng = random.Random(22)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(60):  # a ring of steps, whose far ends are not alike
        base = list(base)
        at = rng.randrange(280)
        base[at : at + 12] = [f"e{rng.randrange(10**9)}" for _ in range(12)]
        texts.append(" ".join(base))
    rng.shuffle(texts)
    assert near_copies_left(spark, texts) == {0}


def test_copies_with_a_line_repeated_are_found(spark):
    rng = random.Random(23)
    texts = [" ".join(f"r{rng.randrange(10**9)}" for _ in range(300)) for _ in range(12)]
    texts += [t + 60 * (" " + " ".join(f"l{rng.randrange(10**9)}" for _ in range(20))) for t in texts]
    assert near_copies_left(spark, texts) == set(range(12))


def test_short_near_copies_against_brute_force(spark):
    rng = random.Random(24)
    word = lambda: f"s{rng.randrange(10**9)}"
    texts = []
    for n in (5, 8, 12, 14, 16, 20, 22, 24, 30, 44, 45, 46):
        for _ in range(25):
            words = [word() for _ in range(n)]
            texts.append(" ".join(words))
            texts.append(" ".join(rng.choice([[*words[:-1], word()], [*words, word()], words[: n // 2] + [word()] + words[n // 2 :], words[:-1]])))
    sets = [{tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for w in map(str.split, texts)]
    close = [len(a & b) >= 0.8 * len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]  # other pairs have no word in common
    assert 50 < sum(close) < len(close)
    assert near_copies_left(spark, texts) == set(range(len(texts))) - {2 * i + 1 for i, c in enumerate(close) if c}


def test_near_copies_of_repeated_rows_and_null_keys(spark):
    rows = [(1, "a b c"), (1, "a b c"), (1, "other text here"), (None, "a b c"), (None, "lonely"), (2, None), (3, None)]
    out = near_dedup.drop_near_copies(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in out) == [("1", "a b c"), ("1", "other text here"), ("2", "None"), ("None", "lonely")]


def brute_syncmers(text):
    raw = text.encode()
    words = syncmers._words(raw)
    h = [int(x) for x in syncmers._mixed(words * syncmers.A)]
    width = syncmers.K - syncmers.S + 1
    return [i for i in range(len(raw) - syncmers.K + 1) if min(h[i : i + width]) in (h[i], h[i + width - 1])]


def test_syncmers_are_closed_and_free_of_context():
    rng = random.Random(3)
    text, other = prose(rng, 200), prose(rng, 50)
    at, hashes = syncmers.anchors(text)
    assert at.tolist() == brute_syncmers(text)
    shifted, again = syncmers.anchors(other + text)
    n = len(other.encode())
    inside = shifted >= n
    assert (shifted[inside] - n).tolist() == at.tolist() and again[inside].tolist() == hashes.tolist()
    pairs = syncmers.positional_match(text, other + text)
    assert [a for a, _ in pairs] == at.tolist() and sum(b - a == n for a, b in pairs) > 0.9 * len(at)


def brute_likeness(a, b):
    """Longest common subsequence in order of anchors, paired by the number of their repeat."""
    import numpy as np

    def named(found):
        seen, out = {}, []
        for h in found[1].tolist():
            seen[h] = seen.get(h, -1) + 1
            out.append((h, seen[h]))
        return out

    x, y = named(a), named(b)
    if not x and not y:
        return 1.0
    table = np.zeros((len(x) + 1, len(y) + 1), dtype=int)
    for i, p in enumerate(x):
        for j, q in enumerate(y):
            table[i + 1, j + 1] = table[i, j] + 1 if p == q else max(table[i, j + 1], table[i + 1, j])
    return 2 * int(table[-1, -1]) / (len(x) + len(y))


def test_likeness():
    rng = random.Random(5)
    a, b = prose(rng, 400), prose(rng, 400)
    s = syncmers.anchors
    assert syncmers.likeness(s(a), s(a)) == 1 and syncmers.likeness(s(a), s(b)) < 0.1
    assert syncmers.likeness(s(""), s("")) == 1 and syncmers.likeness(s(""), s(a)) == 0
    half = len(a) // 2
    assert 0.4 < syncmers.likeness(s(a), s(a[:half] + b[half:])) < 0.6
    assert 0.4 < syncmers.likeness(s(a), s(a[half:] + a[:half])) < 0.6  # a moved block isn't in order
    line = "the same line stands here again and again, "
    for x, y in ((a[:900], a[300:600] + a[:300]), (line * 9, line * 5), (a[:500] + line * 3, line * 3 + a[:500]), ("é" * 80, "é" * 50)):
        assert syncmers.likeness(s(x), s(y)) == pytest.approx(brute_likeness(s(x), s(y)))


@pytest.mark.parametrize("parts", ["1", "8"])
def test_syncmer_query(spark, parts):
    rng = random.Random(8)
    texts = [None, "", "é", "ab", prose(rng, 3), prose(rng, 30_000), *[prose(rng, rng.randint(1, 120)) for _ in range(40)]]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame([(i * 37 % 1009, t) for i, t in enumerate(texts)], DOCS)
        for name in ("part", "order", "ghost", "k", "t", "fingerprint"):
            df = df.withColumn(name, lit("clash"))
        got = {r.doc_id: r for r in syncmers.fingerprints(df).collect()}
        rows = sorted(((i * 37 % 1009, t or "") for i, t in enumerate(texts)), reverse=True)
        for (k, t), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
            edited = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
            assert got[k].n_chars == len(t) and got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            own, changed, other = map(syncmers.anchors, (t, edited, following))
            assert (got[k].fingerprint, got[k].edited_fingerprint) == (syncmers.to_string(own), syncmers.to_string(changed))
            if len(t) < 2000:
                assert (got[k].near_edited, got[k].near_next) == pytest.approx((brute_likeness(own, changed), brute_likeness(own, other)))
        assert len(got) == len(texts)
        assert syncmers.fingerprints(df.limit(0)).count() == 0
        ties = spark.createDataFrame([(5, "b" * 30), (5, "a" * 30), (None, "c" * 30), (9, "d" * 30)], DOCS)
        out = {r.fingerprint: r.edited_sha256 for r in syncmers.fingerprints(ties).collect()}
        fp = lambda x: syncmers.to_string(syncmers.anchors(x * 30))
        sha = lambda x, y: hashlib.sha256((x * 20 + y * 10).encode()).hexdigest()
        assert out == {fp("d"): sha("d", "a"), fp("a"): sha("a", "b"), fp("b"): sha("b", "c"), fp("c"): sha("c", "d")}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
