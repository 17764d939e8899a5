"""Byte-level BPE by speculation and verification.

Greedy longest match proposes the tokens of each distinct piece; a vectorised check then
tests every adjacent pair of proposed tokens. A sequence in which each pair is what BPE
itself gives for the two joined is the BPE encoding of the whole, so passing pieces are
done; only failing ones are merged exactly.

A piece is what stands between single spaces, with the space before it. A space that
follows a character other than white space and precedes one always starts a new word of
the splitting pattern, whatever surrounds it; so pieces are encoded independently and kept
in a bounded cache. White-space runs stay inside one piece.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, no_cycles
from tessera.llm.hashing import KeyTable

# The word pattern and the byte alphabet of byte-level BPE vocabularies.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Pieces of more characters aren't kept; a cache that has more pieces becomes the older one.
LONG_PIECE, CACHED = 64, 300_000

#: Characters of text that are encoded together.
PORTION = 1 << 22

#: A single space that isn't between two characters other than white space.
ODD = regex.compile(r"\s | \s|^ | $")

#: Words of more bytes are proposed and merged one by one.
LONG_WORD = 32

NEVER = np.iinfo(np.int64).max
STEP = np.uint64(0x100000001B3)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(rest)}


def pieces(text: str) -> list[str]:
    """Cuts text before each single space between two characters that aren't white space."""
    parts = text.split(" ")
    if not ODD.search(text):
        return parts[:1] * bool(text) + [" " + p for p in parts[1:]]
    out, held = [], parts[0]
    for part in parts[1:]:
        if held and part and not (held[-1].isspace() or part[0].isspace()):
            out.append(held)
            held = " " + part
        else:
            held += " " + part
    if held:
        out.append(held)
    return out


def check_splitting(spec: dict) -> None:
    """ValueError unless a tokenizers file splits texts as this module does: WORD, no normaliser, no space put in front."""
    before = spec.get("pre_tokenizer") or {}
    wanted = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if spec.get("normalizer") or any(before.get(k, k == "use_regex") != v for k, v in wanted.items()):
        raise ValueError(f"byte-level BPE with its usual word pattern is expected, not {before} after {spec.get('normalizer')}")
    model = spec["model"]
    if model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
        raise ValueError("a plain BPE model is expected")
    for t in spec.get("added_tokens", []):
        if any(map(str.isspace, t["content"])) or any(t.get(k) for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError(f"the added token {t['content']!r} isn't a plain string without white space")


def per_word(tokens: np.ndarray, owner: np.ndarray, count: int) -> Iterator[list[int]]:
    flat, ends = tokens.tolist(), np.cumsum(np.bincount(owner, minlength=count)).tolist()
    return (flat[i:j] for i, j in zip([0, *ends], ends, strict=False))


def one_by_one(encode):
    def run(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        each = [encode(w) for w in words]
        n = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
        return np.fromiter((t for ids in each for t in ids), dtype=np.int64, count=int(n.sum())), np.repeat(np.arange(len(each)), n)

    return run


class ByteBPE:
    """A byte-level BPE vocabulary with the speculative encoder and the decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_splitting(spec)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.ids = {raw(k): v for k, v in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = {v: k for k, v in self.ids.items()} | {v: k.encode() for k, v in self.special.items()}
        self.splitter = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.word = regex.compile(WORD)
        self.longest = max(map(len, self.ids))
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        size = max(self.bytes) + 1
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        # How each token comes about: its two parts, and the rank of their merge; -1 for a byte.
        self.left, self.right = np.full(size, -1), np.full(size, -1)
        self.born = np.full(size, -1)
        for r, (a, b) in enumerate(merges):
            x, y = raw(a), raw(b)
            made = self.ids[x + y]
            self.rank[self.ids[x], self.ids[y]] = (r, made)
            if self.born[made] < 0:
                self.left[made], self.right[made], self.born[made] = self.ids[x], self.ids[y], r
        self.size = size
        found = np.array([(a * size + b, r, made) for (a, b), (r, made) in self.rank.items()], dtype=np.int64)
        self.pair_rank = KeyTable(found[:, 0], found[:, 1], NEVER)
        self.made = np.zeros(len(merges), dtype=np.int64)
        self.made[found[:, 1]] = found[:, 2]
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int64)
        short = [k for k in self.ids if len(k) <= LONG_WORD]
        self.by_hash = KeyTable(self._hashes(short), np.array([self.ids[k] for k in short]), -1)
        self.token_length = np.zeros(size, dtype=np.int64)
        for v, k in self.bytes.items():
            self.token_length[v] = len(k)
        self.names = list(map(str, range(size)))
        # What has been encoded of late, and before that.
        self.cache: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}
        self.stats = {"proposed": 0, "failed": 0}

    # -- proposing ---------------------------------------------------------------------

    @staticmethod
    def _hashes(words: list[bytes]) -> np.ndarray:
        out = []
        for w in words:
            h = 0
            for b in w:
                h = (h * int(STEP) + b + 1) & 0xFFFFFFFFFFFFFFFF
            out.append(h)
        return np.array(out, dtype=np.uint64)

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match over one word."""
        out, i, n, ids = [], 0, len(word), self.ids
        while i < n:
            end = min(n, i + self.longest)
            while (t := ids.get(word[i:end])) is None:
                end -= 1
            out.append(t)
            i = end
        return out

    def propose_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match over all words at once: the tokens, and the word of each.

        Prefixes are looked up by a 64-bit hash, and the bytes of what it finds are compared.
        """
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        buf = np.frombuffer(b"".join(words), dtype=np.uint8)
        ends = np.cumsum(lengths)
        room = np.repeat(ends, lengths) - np.arange(len(buf))
        best = self.single[buf]
        live, h = np.arange(len(buf)), buf.astype(np.uint64) + np.uint64(1)
        for n in range(2, int(lengths.max(initial=0)) + 1):
            keep = room[live] >= n
            live = live[keep]
            if not len(live):
                break
            h = h[keep] * STEP + (buf[live + n - 1].astype(np.uint64) + np.uint64(1))
            got = self.by_hash.get(h)
            hit = got >= 0
            best[live[hit]] = got[hit]
        step = self.token_length[best]
        at, owner = ends - lengths, np.arange(len(words))
        owners, starts = [], []
        keep = at < ends
        at, owner = at[keep], owner[keep]
        while len(at):
            owners.append(owner)
            starts.append(at)
            at = at + step[at]
            keep = at < ends[owner]
            at, owner = at[keep], owner[keep]
        if not starts:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        starts, owners = np.concatenate(starts), np.concatenate(owners)
        order = np.argsort(starts, kind="stable")
        tokens, owners = best[starts[order]], owners[order]
        if b"".join(map(self.bytes.__getitem__, tokens.tolist())) != buf.tobytes():
            return one_by_one(self.propose)(words)
        return tokens, owners

    # -- verifying ---------------------------------------------------------------------

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: does BPE of the joined bytes give just these two?

        The merges inside the two tokens are undone from the latest back. At each moment
        the tokens that touch the border must not have been able to merge before the next
        of the undone merges took place. Merges of the left token come first at equal rank,
        as merging goes from left to right.
        """
        good = np.ones(len(a), dtype=bool)
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        until = np.full(len(a), NEVER)  # the border pair was adjacent before this moment
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            moment = self.pair_rank.get(x * self.size + y)
            moment = np.where(moment == NEVER, NEVER, 2 * moment)
            bad = moment < until[live]
            good[live[bad]] = False
            bx, by = self.born[x], self.born[y]
            done = bad | ((bx < 0) & (by < 0))
            keep = ~done
            live, x, y, bx, by = live[keep], x[keep], y[keep], bx[keep], by[keep]
            undo_left = bx > by
            # At equal rank the right token's merge is the later one.
            until[live] = np.where(undo_left, 2 * bx, 2 * by + 1)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
        return good

    def verify(self, tokens: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
        """For each of count words, whether all adjacent pairs of its tokens are compatible."""
        good = np.ones(count, dtype=bool)
        inner = owner[1:] == owner[:-1]
        keys, back = np.unique(tokens[:-1][inner] * self.size + tokens[1:][inner], return_inverse=True)
        fine = self.compatible(keys // self.size, keys % self.size)[back]
        good[owner[1:][inner][~fine]] = False
        return good

    # -- merging exactly ---------------------------------------------------------------

    def merge(self, word: bytes) -> list[int]:
        """Exact BPE with a heap over a linked list: lowest rank first, then leftmost."""
        tokens = [self.ids[word[i : i + 1]] for i in range(len(word))]
        after, before = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1))
        rank, heap = self.rank, []
        for i in range(len(tokens) - 1):
            if found := rank.get((tokens[i], tokens[i + 1])):
                heap.append((found[0], i, tokens[i], tokens[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, x, y = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != x or j >= len(tokens) or tokens[j] != y:
                continue
            tokens[i] = rank[x, y][1]
            tokens[j] = -1
            after[i] = k = after[j]
            if k < len(tokens):
                before[k] = i
                if found := rank.get((tokens[i], tokens[k])):
                    heapq.heappush(heap, (found[0], i, tokens[i], tokens[k]))
            if (h := before[i]) >= 0 and (found := rank.get((tokens[h], tokens[i]))):
                heapq.heappush(heap, (found[0], h, tokens[h], tokens[i]))
        return [t for t in tokens if t >= 0]

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact BPE of all words in step: in each round each word's lowest, leftmost pair merges."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        tokens = self.single[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        out_tokens, out_owner = [], []
        rank = np.full(len(tokens), NEVER)
        fresh = np.arange(len(tokens))
        while len(tokens):
            # rank[i] is that of tokens i and i + 1; only pairs that changed are looked up.
            fresh = fresh[fresh < len(tokens) - 1]
            inner = owner[fresh] == owner[fresh + 1]
            rank[fresh] = NEVER
            fresh = fresh[inner]
            rank[fresh] = self.pair_rank.get(tokens[fresh] * self.size + tokens[fresh + 1])
            rank[-1] = NEVER
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.r_[first, len(tokens)])
            busy = np.repeat(lowest < NEVER, sizes)
            if not busy.all():
                out_tokens.append(tokens[~busy])
                out_owner.append(owner[~busy])
                tokens, owner, rank = tokens[busy], owner[busy], rank[busy]
                if not len(tokens):
                    break
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                lowest, sizes = lowest[lowest < NEVER], np.diff(np.r_[first, len(tokens)])
            hits = np.flatnonzero(rank == np.repeat(lowest, sizes))
            hits = hits[np.r_[True, owner[hits][1:] != owner[hits][:-1]]]
            tokens[hits] = self.made[rank[hits]]
            keep = np.ones(len(tokens), dtype=bool)
            keep[hits + 1] = False
            place = np.cumsum(keep) - 1
            fresh = place[hits]
            tokens, owner, rank = tokens[keep], owner[keep], rank[keep]
            before = fresh[fresh > 0] - 1
            fresh = np.union1d(fresh, before)
        if not out_tokens:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        tokens, owner = np.concatenate(out_tokens), np.concatenate(out_owner)
        order = np.argsort(owner, kind="stable")
        return tokens[order], owner[order]

    # -- texts -------------------------------------------------------------------------

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        out: list[list[int]] = [[]] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
        self._settle(out, short, [words[i] for i in short], self.propose_all, self.merge_all)
        long = [i for i, w in enumerate(words) if len(w) > LONG_WORD]
        self._settle(out, long, [words[i] for i in long], one_by_one(self.propose), one_by_one(self.merge))
        return out

    def _settle(self, out: list, places: list[int], words: list[bytes], propose, merge) -> None:
        if not words:
            return
        tokens, owner = propose(words)
        good = self.verify(tokens, owner, len(words))
        failed = []
        for i, (ok, ids) in enumerate(zip(good.tolist(), per_word(tokens, owner, len(words)), strict=True)):
            if ok:
                out[places[i]] = ids
            else:
                failed.append(i)
        self.stats["proposed"] += len(words)
        self.stats["failed"] += len(failed)
        if failed:
            tokens, owner = merge([words[i] for i in failed])
            for i, ids in zip(failed, per_word(tokens, owner, len(failed)), strict=True):
                out[places[i]] = ids

    def encode_pieces(self, new: list[str]) -> dict[str, tuple[int, str, str]]:
        """For each piece: number of ids, ids joined by commas, decoded text."""
        special, findall = self.special, self.word.findall
        whole = [p for p in new if p[0] == " " and p.isascii() and p[1:].isalpha() or p in special]
        split = {p: findall(p) for p in set(new).difference(whole)}
        distinct = list({w for ws in split.values() for w in ws}.union(whole))
        coded = [w.encode() for w in distinct]
        each = self.encode_words(coded)
        for i in [i for i, w in enumerate(distinct) if w in special] if special else ():
            each[i] = [special[distinct[i]]]
        name = self.names.__getitem__
        of = {w: (len(ids), ",".join(map(name, ids)), back) for w, ids, back in zip(distinct, each, self.decoded(distinct, coded, each), strict=True)}
        out = {p: of[p] for p in whole}
        for p, ws in split.items():
            if len(ws) == 1:
                out[p] = of[ws[0]]
            else:
                parts = [of[w] for w in ws]
                back = "".join([e[2] for e in parts])
                out[p] = (sum(e[0] for e in parts), ",".join([e[1] for e in parts]), p if back == p else back)
        return out

    def decoded(self, words: list[str], coded: list[bytes], each: list[list[int]]) -> list[str]:
        """What the ids of each word decode to. All are decoded together; if all bytes and lengths are the words' own, so is each."""
        flat = np.fromiter(chain.from_iterable(each), dtype=np.int64, count=sum(map(len, each)))
        ends = np.cumsum(self.token_length[flat])[np.cumsum([len(ids) for ids in each]) - 1] if len(flat) else np.empty(0, dtype=np.int64)
        raw = self.bytes.__getitem__
        if all(each) and np.array_equal(ends, np.cumsum([len(c) for c in coded])) and b"".join(map(raw, flat.tolist())) == b"".join(coded):
            return words
        return [w if (back := b"".join(map(raw, ids))) == c else back.decode("utf-8", "replace") for w, c, ids in zip(words, coded, each, strict=True)]

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens' bytes, joined, as UTF-8 with replacement; special tokens as their strings."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def encode(self, text: str) -> list[int]:
        return [int(t) for part in self.encoded([text])[0] if part[1] for t in part[1].split(",")]

    def cut(self, text: str) -> list[str]:
        """The pieces of a text; special strings stand alone."""
        if not self.splitter or not any(map(text.__contains__, self.special)):
            return pieces(text)
        out, at = [], 0
        for m in self.splitter.finditer(text):
            out += pieces(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + pieces(text[at:])

    def encoded(self, texts: list[str]) -> list[list[tuple[int, str, str]]]:
        """What encode_pieces() gives for each piece of each text, in order.

        The new pieces of all texts are proposed and verified together. A piece that is a
        special string can only come from cut(), as it would have been cut out elsewhere.
        """
        cuts, cache = list(map(self.cut, texts)), self.cache
        if len(cache) > CACHED:
            self.older, self.cache = cache, {}
            cache = self.cache
        new = {p for c in cuts for p in c}.difference(cache)
        known = new & self.older.keys() if self.older else set()
        cache.update((p, self.older[p]) for p in known)
        new = list(new - known)
        cache.update(self.encode_pieces(new))
        out = [list(map(cache.__getitem__, c)) for c in cuts]
        for p in new:
            if len(p) > LONG_PIECE:
                del cache[p]
        return out


_LOADED: dict[str, ByteBPE] = {}


def vocabulary(path: str) -> ByteBPE:
    """One copy for each Python worker; path is a local file every executor has, as part of its installation."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digest(parts: list[tuple[int, str, str]]) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids joined by commas, SHA-256 of the decoded text."""
    count, ids, back = zip(*parts, strict=True) if parts else ((), (), ())
    return (
        sum(count),
        hashlib.sha256(",".join(ids).encode()).hexdigest(),
        hashlib.sha256("".join(back).encode()).hexdigest(),
    )


def portions(texts: Iterable[str], limit: int = PORTION) -> Iterator[list[str]]:
    """Runs of texts of about limit characters; a longer text makes a run of its own."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > limit:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def encode_decode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token count and digests of the ids and of the decoded text, for each row.

    Returns key, n_tokens long, ids_sha256 string, decoded_sha256 string. Null texts count
    as empty: no tokens, the digests of nothing. Repeated rows and null keys give a row
    each; an empty table gives an empty table; other columns aren't read. Texts are encoded
    whole, however long.
    """
    path = path or default_path()
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = vocabulary(path)
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            with no_cycles():
                got = [digest(parts) for some in portions(texts) for parts in bpe.encoded(some)]
            n, ids, back = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                names=["k", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return rows.mapInArrow(run, "k long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("k", key)
