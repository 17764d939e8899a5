"""Token counts of whole texts by overlap resynchronisation.

Each text is encoded by the library in overlapping chunks with offsets; only a text that
fits one chunk has no overlap. In the overlap of two chunks both encodings are right up to
some distance from their cut ends; they are spliced at a token boundary which both have and
which is proven stable: one before a single space or break between two characters other
than white space, or between a letter or digit and a mark. The splitting pattern starts a
new word there whatever surrounds it, so tokens on either side don't depend on the other.
Where an overlap has no such boundary it is widened, up to one encoding of all that isn't
spliced yet.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import check_splitting, default_path
from tessera.llm.common import bounded_batches

#: Characters of a chunk and of the first overlap: the texts of a corpus are mostly longer, and an
#: encoding of this size holds little memory.
CHUNK, OVERLAP = 1024, 64

#: Proven boundaries, outside of special strings: before lone white space, and before a mark after a letter or digit.
BORDER = re.compile(r"(?<=\S)[ \n\t\r](?=\S)|(?<=[^\W_])(?=[^\w\s])")


class Counter:
    """Counts the tokens that a byte-level tokenizers file gives, without added special tokens."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            check_splitting(json.load(f))
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if [a for a, _ in self.tokenizer.encode("a b", add_special_tokens=False).offsets] != [0, 1]:
            raise ValueError("the offsets of this file's tokens leave out spaces")
        self.chunk, self.overlap = chunk, overlap
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spliced = self.widened = 0

    def encode(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def stable(self, text: str, left, at: int, right, low: int, high: int) -> tuple[int, int, int] | None:
        """The first proven boundary from the middle of low and high on, else from low on, that both encodings have: its place, and its token in each.

        left begins at the place at of the text, right at low.
        """
        middle = (low + high) // 2
        for m in chain(BORDER.finditer(text, middle, high), BORDER.finditer(text, low, middle)):
            p = m.start()
            x, y = left.char_to_token(p - at), right.char_to_token(p - low)
            if p > low and x is not None and y is not None and left.token_to_chars(x)[0] == p - at and right.token_to_chars(y)[0] == p - low and not self.within(text, p):
                return p, x, y
        return None

    def within(self, text: str, p: int) -> bool:
        """Whether a special string of the whole text may begin before the place p and end after it."""
        return any(text.find(s, max(0, p - len(s) + 1), p + len(s) - 1) >= 0 for s in self.special)

    def count(self, text: str) -> int:
        """The count of a text of any length, chunk by chunk."""
        size, total = len(text), 0
        base, end = 0, min(size, self.chunk)  # what stands before base is counted, left reaches up to end
        left, at, first = self.encode(text[:end]), 0, 0  # it begins at the place at, its token first is that at base
        while end < size:
            overlap = self.overlap
            while True:
                low = end - overlap
                if low <= base:  # the overlap would be all that isn't counted, which grows instead
                    end = min(size, base + 2 * (end - base))
                    left, at, first = self.encode(text[base:end]), base, 0
                    break
                stop = min(size, low + max(self.chunk, 2 * overlap))
                right = self.encode(text[low:stop])
                if found := self.stable(text, left, at, right, low, end):
                    total += found[1] - first
                    base, left, at, first, end = found[0], right, low, found[2], stop
                    self.spliced += 1
                    break
                overlap *= 2
                self.widened += 1
        return total + len(left) - first


_LOADED: dict[tuple, Counter] = {}


def counter(path: str, chunk: int, overlap: int) -> Counter:
    """One for each Python worker; path is a local file that is part of every executor's installation."""
    key = (path, chunk, overlap)
    if key not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        _LOADED[key] = Counter(*key)
    return _LOADED[key]


def token_counts(docs: DataFrame, limit: int = 512, path: str | None = None, key: str = "doc_id", text: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The token count of each whole text and whether it is over a limit.

    Returns key, n_bytes long (UTF-8), n_tokens long, over_limit boolean (n_tokens > limit).
    Null texts count as empty (0 bytes, 0 tokens). Repeated rows and null keys give a row
    each, an empty table an empty table; other columns aren't read.
    """
    path = path or default_path()
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count = counter(path, chunk, overlap).count
        for batch in batches:
            n = [count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], names=["k", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("n_bytes", F.octet_length("t").cast("long"))
    out = rows.mapInArrow(run, "k long, n_bytes long, n_tokens long")
    return out.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
