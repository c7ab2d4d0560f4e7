"""Operator 5: token counts by overlap resynchronisation.

A huge text is encoded in chunks that overlap, with offsets. Two neighbouring
chunks are spliced at a boundary that both have and that is *proven stable*:
a letter or digit of the overlap followed by a space, a line break or a
punctuation mark, or such a mark followed by white space. The pre-tokenizer's
only look-ahead concerns runs of white space, no pre-token holds white space
or a mark after a letter, none holds white space after a mark, and the special
token has no such place, so what stands before the boundary is cut up without
regard to what follows, and the other way round. Where an overlap has no such boundary it is
widened, at last to the whole rest.

An ordinary text is one chunk. The same proof lets the library see each
distinct piece between stable boundaries once per worker: pieces repeat, and a
memo of bounded size holds their counts.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read_table
from .maptext import map_text, texts_of

CHUNK = 32 * 1024       # characters of a chunk; a longer text is huge
OVERLAP = 256           # characters, doubled where no boundary is proven
LIMIT = 1024            # over_limit: more tokens than this
MEMO = 400_000          # pieces remembered by a worker
_ALNUM = "A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_MARK = ".,;:!?*$%&#\"=()"     # none of them occurs in the special token
_STABLE = re.compile(f"(?<=[{_ALNUM}])(?=[ \n{_MARK}])|(?<=[{_MARK}|])(?=[ \n])")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def stable_boundaries(text: str, first: int, last: int) -> list[int]:
    """Positions in [first, last] at which the tokens on both sides do not
    depend on the text of the other side."""
    return [m.start() for m in _STABLE.finditer(text, max(first, 1), last) if first <= m.start() <= last]


class Counter:
    """Token counts of one worker; ``path`` names the tokenizer's file."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.chunk, self.overlap = chunk, overlap
        self.memo: dict[str, int] = {}

    def starts(self, text: str) -> list[int]:
        """First character of each token, as the library's offsets say."""
        return [a for a, _ in self.tok.encode(text, add_special_tokens=False).offsets]

    def huge(self, text: str) -> int:
        """Tokens of a text of any length from overlapping chunks."""
        total, at = 0, 0                       # tokens before the stable position ``at``
        left_end = min(self.chunk, len(text))
        left = self.starts(text[:left_end])
        while left_end < len(text):
            overlap = self.overlap
            while True:
                # the next chunk starts ``overlap`` before this one ends
                begin = max(at, left_end - overlap)
                end = min(begin + self.chunk + overlap, len(text))
                right = self.starts(text[begin:end])
                in_left, in_right = {at + s for s in left}, {begin + s for s in right}
                # begin itself may cut a word: only a position after it, at which both have a token
                common = [p for p in stable_boundaries(text, begin + 1, left_end - 1) if p in in_left and p in in_right]
                if common:
                    p = common[len(common) // 2]
                    total += sum(1 for s in left if at + s < p)
                    left = [begin + s - p for s in right if begin + s >= p]
                    at, left_end = p, end
                    break
                if begin == at:                # the whole left chunk overlaps: make it longer
                    left_end = min(at + 2 * (left_end - at), len(text))
                    left = self.starts(text[at:left_end])
                    if left_end == len(text):
                        break
                overlap *= 2
        return total + len(left)

    def counts(self, texts: list[str]) -> list[int]:
        pieces = [None if len(t) > self.chunk else _STABLE.split(t) for t in texts]
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        new = list({p for ps in pieces if ps for p in ps if p not in memo})
        for i in range(0, len(new), 4096):
            part = new[i:i + 4096]
            for p, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False), strict=True):
                memo[p] = len(e)
        get = memo.__getitem__
        return [self.huge(t) if ps is None else sum(map(get, ps)) for t, ps in zip(texts, pieces, strict=True)]


_COUNTERS: dict[tuple, Counter] = {}


def _counter(path: str, chunk: int, overlap: int) -> Counter:
    key = (path, chunk, overlap)
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(path, chunk, overlap)
    return _COUNTERS[key]


def count_tokens(docs: DataFrame, keep: list[str], tokenizer: str | None = None, text_col: str = "text",
                 limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``keep`` columns, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``
    of every row's whole text, as the library counts it without added special
    tokens. A null or empty text has 0 of each. ``tokenizer`` is a path on the
    workers of a byte-level BPE with the usual word pattern; None takes the
    installed ``byte_bpe_50k.json``."""
    def fn(data, offsets):
        n = _counter(tokenizer or default_tokenizer(), chunk, overlap).counts(texts_of(data, offsets))
        return [pa.array(np.diff(offsets), pa.int64()), pa.array(n, pa.int64()),
                pa.array([x > limit for x in n], pa.bool_())]
    return map_text(docs, keep, fn, "n_bytes long, n_tokens long, over_limit boolean", text_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), ["doc_id"])
