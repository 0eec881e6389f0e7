"""Problem 4: cut oversized texts at natural boundaries, with overlap.

Method: each position after which a piece may end has a strength (3 section end, 2
sentence or line end, 1 word end, 0 anywhere).  A sparse-table range-maximum index over
(strength, position) gives the strongest cut of a length window in constant time, the
rightmost among equals.  The window of a piece that starts at s is first
[s + limit/2, s + limit]; where that holds no boundary at all it widens to every length
that makes progress, so a piece ends inside a word only where no boundary is in reach.
The next piece starts ``overlap`` characters before the cut.

Lengths are in code points.  A text within the limit is one piece, an empty text one
empty piece, a null text one null piece with length 0.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.sources.tables import table

LIMIT = 10_000
OVERLAP = 200

_SECTION = re.compile(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)\s*")
_SENTENCE = re.compile(r"[.!?…][\"'”’»)\]]*\s+|[。！？]+|(?:\r\n|\r|\n)+")
_WORD = re.compile(r"\s+")


class RangeMax:
    """Sparse table: level k holds the maximum of each window of 2**k values; levels are built when asked for."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]

    def query(self, lo: int, hi: int) -> int:
        """Maximum of values[lo..hi], both inclusive."""
        k = (hi - lo + 1).bit_length() - 1
        while len(self.levels) <= k:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.maximum(last[:-half], last[half:]))
        level = self.levels[k]
        return int(max(level[lo], level[hi - (1 << k) + 1]))


def strengths(text: str) -> np.ndarray:
    """strength[p] for a piece that ends before position p (0 <= p <= len)."""
    out = np.zeros(len(text) + 1, np.int64)
    for pattern, value in ((_WORD, 1), (_SENTENCE, 2), (_SECTION, 3)):
        ends = [m.end() for m in pattern.finditer(text)]
        out[ends] = value
    return out


def cut(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Half-open piece bounds."""
    n = len(text)
    if n <= limit:
        return [(0, n)]
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be smaller than limit")
    base = n + 1
    index = RangeMax(strengths(text) * base + np.arange(n + 1))
    out, start = [], 0
    while n - start > limit:
        hi = start + limit
        best = index.query(max(start + limit // 2, start + overlap + 1), hi)
        if best < base:
            best = index.query(start + overlap + 1, hi)
        end = best % base if best >= base else hi
        out.append((start, end))
        start = end - overlap
    out.append((start, n))
    return out


_BOUNDS = T.ArrayType(T.StructType([T.StructField("from", T.IntegerType()), T.StructField("to", T.IntegerType())]))


def _cut_udf(limit: int, overlap: int):
    kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))

    @F.arrow_udf(_BOUNDS)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(
            [None if t is None else [{"from": a, "to": b} for a, b in cut(t, limit, overlap)] for t in texts.to_pylist()], kind
        )

    return run


def split_pieces(df: DataFrame, column: str = "text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row a piece: the other columns, ``piece_no`` from 0, ``n_pieces``, ``start``, ``end`` and ``piece``.

    Only texts over the limit are sent to Python; the rest are single pieces by
    expression.  No shuffle.
    """
    text = F.col(column)
    whole = F.array(F.struct(F.lit(0).alias("from"), F.coalesce(F.char_length(text), F.lit(0)).alias("to")))
    bounds = F.coalesce(_cut_udf(limit, overlap).asNondeterministic()(F.when(F.char_length(text) > limit, text)), whole)
    rest = [c for c in df.columns if c not in (column, "piece_no", "n_pieces", "start", "end", "piece", "_bounds", "_b")]
    return (
        df.select(*rest, text.alias(column), bounds.alias("_bounds"))
        .select(*rest, column, F.size("_bounds").alias("n_pieces"), F.posexplode("_bounds").alias("piece_no", "_b"))
        .select(
            *rest, "piece_no", "n_pieces", F.col("_b.from").alias("start"), F.col("_b.to").alias("end"),
            F.substring(text, F.col("_b.from") + 1, F.col("_b.to") - F.col("_b.from")).alias("piece"),
        )
    )


def _pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_pieces(table(spark, sf_dir, "test").select("id", "text"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the splitter cut: the second piece exists exactly for texts over the limit."""
    return _pieces(spark, sf_dir).where("piece_no = 1").select("id")


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces(spark, sf_dir)


def p4_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text put together again from its pieces without the overlaps, as a digest."""
    pieces = _pieces(spark, sf_dir).where("piece IS NOT NULL")
    fresh = F.when(F.col("piece_no") == 0, F.col("piece")).otherwise(F.expr(f"substr(piece, {OVERLAP + 1})"))
    longest = F.max(F.char_length("piece")).alias("longest")
    parts = F.array_sort(F.collect_list(F.struct("piece_no", fresh.alias("fresh"))))
    return (
        pieces.groupBy("id")
        .agg(longest, parts.alias("parts"))
        .select("id", (F.col("longest") <= LIMIT).alias("within"), F.md5(F.array_join("parts.fresh", "")).alias("digest"))
    )


QUERIES = {"p4_found": p4_found, "p4_pieces": p4_pieces, "p4_rebuilt": p4_rebuilt}

ORACLE = {
    "p4_found": f"SELECT id FROM test WHERE length(text) > {LIMIT}",
    "p4_rebuilt": "SELECT id, true AS within, md5(text) AS digest FROM test WHERE text IS NOT NULL",
}
