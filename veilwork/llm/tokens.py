"""Problem 6: encode the whole corpus with a public byte-level BPE tokenizer.

Method: monoid tree reduction.  A text is halved down to leaves; leaves are encoded on
their own; two encoded neighbours join by re-encoding a window around their border that
grows until it starts and ends at a certain token border.  A place between a character
that is no white space and a white-space character is always a border of pre-tokens,
whatever surrounds it: no alternative of the pre-token pattern holds white space after
anything else, and the pattern scans from left to right without memory and looks ahead
by at most one character.  Tokens before the first and after the last such place of the
window are therefore the same in the joined text as in the halves.  Decoding
concatenates the bytes of the tokens up the same tree.

Empty and null texts give an empty list.  Strings that spell a special token are
ordinary text.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.sources.tables import spread, table

TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
LEAF = 8192
#: Pre-token pattern of the byte-level vocabulary (fixed value, published with it).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space as the pattern sees it (fixed value).
_SPACE = frozenset("\t\n\x0b\x0c\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B))))
_LONG_RUN = re.compile("[" + re.escape("".join(sorted(_SPACE))) + "]{2048,}")


class TreeEncoder:
    """Encode and decode by tree reduction over a byte-level BPE vocabulary of ranks."""

    def __init__(self, path: str, leaf: int = LEAF):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.leaf = leaf
        self.encoding = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.length = np.fromiter((len(b) for b in self.bytes), np.int64)

    def _piece(self, text: str) -> np.ndarray:
        """Encode without cutting.  The library's pattern engine overflows on endless white space, so a very
        long run is encoded as what the pattern makes of it: one pre-token, less the last character where
        anything follows."""
        out, at = [], 0
        for m in _LONG_RUN.finditer(text):
            run_end = m.end() - (m.end() < len(text))
            out += self.encoding.encode_ordinary(text[at : m.start()])
            out += self.encoding._core_bpe.encode_single_piece(text[m.start() : run_end].encode())
            at = run_end
        return np.asarray(out + self.encoding.encode_ordinary(text[at:]) if at else self.encoding.encode_ordinary(text), np.int32)

    def encode(self, text: str | None) -> np.ndarray:
        return self._tree(text, 0, len(text)) if text else np.empty(0, np.int32)

    def _tree(self, text: str, a: int, b: int) -> np.ndarray:
        if b - a <= self.leaf:
            return self._piece(text[a:b])
        middle = (a + b) // 2
        return self._join(text, a, middle, b, self._tree(text, a, middle), self._tree(text, middle, b))

    def _join(self, text: str, a: int, m: int, b: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        s, e = self._border_before(text, a, m), self._border_after(text, m, b)
        keep = len(left) - self._count(left[::-1], len(text[s:m].encode()))
        skip = self._count(right, len(text[m:e].encode()))
        return np.concatenate((left[:keep], self._piece(text[s:e]), right[skip:]))

    @staticmethod
    def _border_before(text: str, a: int, m: int) -> int:
        """The last certain border strictly before m, or a; the searched window doubles."""
        hi, step = m - 1, 64
        while hi > a:
            lo = max(a, hi - step)
            for p in range(hi, lo, -1):
                if text[p] in _SPACE and text[p - 1] not in _SPACE:
                    return p
            hi, step = lo, step * 2
        return a

    @staticmethod
    def _border_after(text: str, m: int, b: int) -> int:
        """The first certain border strictly after m, or b."""
        lo, step = m + 1, 64
        while lo < b:
            hi = min(b, lo + step)
            for p in range(lo, hi):
                if text[p] in _SPACE and text[p - 1] not in _SPACE:
                    return p
            lo, step = hi, step * 2
        return b

    def _count(self, ids: np.ndarray, size: int) -> int:
        """How many leading tokens hold exactly the first ``size`` bytes; the inspected head doubles."""
        if size == 0:
            return 0
        step = 64
        while True:
            head = np.cumsum(self.length[ids[:step]])
            if head[-1] >= size or step >= len(ids):
                break
            step *= 2
        n = int(np.searchsorted(head, size))
        if n == len(head) or head[n] != size:
            raise AssertionError("a certain border lies inside a token")
        return n + 1

    def decode(self, ids) -> str:
        def up(a: int, b: int) -> bytes:
            if b - a <= 4096:
                return b"".join(self.bytes[i] for i in ids[a:b])
            m = (a + b) // 2
            return up(a, m) + up(m, b)

        return up(0, len(ids)).decode("utf-8", "replace")


@lru_cache(2)
def encoder(path: str, leaf: int = LEAF) -> TreeEncoder:
    """One encoder a worker."""
    return TreeEncoder(path, leaf)


def encode_udf(path: str, leaf: int = LEAF):
    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def run(texts: pa.Array) -> pa.Array:
        enc = encoder(path, leaf)
        parts = [enc.encode(t) for t in texts.to_pylist()]
        offsets = np.zeros(len(parts) + 1, np.int32)
        np.cumsum([len(p) for p in parts], out=offsets[1:])
        flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))

    return run


def decode_udf(path: str):
    @F.arrow_udf(T.StringType())
    def run(ids: pa.Array) -> pa.Array:
        enc = encoder(path)
        return pa.array([None if x is None else enc.decode(x) for x in ids.to_pylist()], pa.string())

    return run


def encode_corpus(df: DataFrame, column: str = "text", to: str = "ids", vocabulary: str | None = None, leaf: int = LEAF) -> DataFrame:
    """Add ``to``, the token ids of ``column``; no shuffle beyond a spread of small inputs."""
    path = vocabulary or os.path.join(TOKENIZER_DIR, VOCABULARY)
    return df.withColumn(to, encode_udf(path, leaf)(F.coalesce(F.col(column), F.lit(""))))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_corpus(spread(docs, "doc_id")).select("doc_id", "ids")


def p6_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of each text decoded from its ids (null texts as empty ones)."""
    ids = p6_ids(spark, sf_dir)
    back = decode_udf(os.path.join(TOKENIZER_DIR, VOCABULARY))("ids")
    return ids.select("doc_id", F.md5(back).alias("digest"))


QUERIES = {"p6_ids": p6_ids, "p6_roundtrip": p6_roundtrip}

ORACLE = {"p6_roundtrip": "SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents"}
