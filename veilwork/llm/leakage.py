"""Problem 7: passages of held-out items that reappear in corpus documents.

Method: winnowing.  Items and documents become word sequences in one normal form (case,
punctuation, spacing, line breaks, mark-up and page lines vanish; every redaction tag is
one word).  Each k-gram of words is hashed and the minimum of every window of
consecutive hashes is a fingerprint, so any shared stretch of k + window - 1 words
shares one.  Fingerprints of documents are joined with those of the items, and every hit
is extended to both sides by banded alignment in which a matching word earns 1 and a
changed, added or missing word costs 7: a stretch of balance 0 or more differs in at
most one word of eight.  A document holds an item where a stretch covers 25 words of it
or more.

With k = 5 and window = 2 a stretch of 25 words with three changes always holds six
unchanged words in a row, hence a shared fingerprint.

Items are prepared in the executors and their words counted.  A held-out set of up to
``INDEX_FINGERPRINTS`` is broadcast as an index of sorted hashes, so documents are never
shuffled; only found pairs are.  A larger one is joined as a table of fingerprints.

An opening sentence that several items share is not part of them.  Null and empty
documents or items match nothing.  Repeated ids yield one row a pair.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.functions.durable import durable
from veilwork.functions.join import SALTS
from veilwork.sources.tables import spread, table

K = 5
WINDOW = 2
MIN_WORDS = 25
ONE_IN = 8
BAND = 6
#: Most words of all items for a broadcast index (24 bytes a fingerprint, and the words).
INDEX_FINGERPRINTS = 1_000_000

# Forms that redaction tags, mark-up and page lines take.
TAG = "zzredactedzz"
_TAGS = re.compile(
    r"\[[A-Z*_ -]{2,}\]|\[[A-Za-z*_][A-Za-z0-9*_-]+(?: [A-Za-z0-9*_-]+){0,2}\]|<(?!BR\b|P\b|DIV\b)[A-Z_]{2,}>|\{\{?[A-Z_]{2,}\}?\}|\[\*+[^\]\n]{0,40}\*+\]|\*{3,}|_{3,}|█+|\bX{3,}\b"
)
_MARKUP = re.compile(r"</?[A-Za-z][^<>\n]{0,200}>|\\[nrt]|&(?:[a-z]+|#[0-9]+);")
_PAGE = re.compile(r"(?i)[-–—=|*\[(]+\s?page\s+[0-9]+\s+(?:of|/)\s+[0-9]+\s?[-–—=|*\])]+")
_HYPHENATED = re.compile("(?<=[^\\W\\d_])-\\s*\\n\\s*(?=[^\\W\\d_])|[­​-‍⁠﻿]")
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """The normal form of a text; the dearer passes run only where a character calls for them."""
    t = text if text.isascii() else unicodedata.normalize("NFC", text)
    if "[" in t or "<" in t or "{" in t or "***" in t or "___" in t or "XXX" in t or "█" in t:
        t = _TAGS.sub(f" {TAG} ", t)
    if "<" in t or "\\" in t or "&" in t:
        t = _MARKUP.sub(" ", t)
    if "age " in t or "AGE " in t:
        t = _PAGE.sub(" ", t)
    if "-\n" in t or "- \n" in t or "-\r" in t or not t.isascii():
        t = _HYPHENATED.sub("", t)
    return _WORD.findall(t.replace("'", "").replace("’", "").lower())


class _Hashes(dict):
    """64-bit hash of a word, kept for the words of a worker."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASH = _Hashes()
_BASE = [pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j in range(64)]


def fingerprints(seq: list[str], k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions): the winnowed k-grams of a word sequence."""
    n = len(seq) - k + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    ids = np.fromiter(map(_HASH.__getitem__, seq), np.uint64, len(seq))
    grams = np.zeros(n, np.uint64)
    for j in range(k):
        grams += ids[j : j + n] * np.uint64(_BASE[j])
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    if n < window:
        at = np.array([int(grams.argmin())])
    elif window == 2:
        keep = np.zeros(n, bool)
        first = grams[:-1] < grams[1:]
        keep[:-1] |= first
        keep[1:] |= ~first
        at = np.flatnonzero(keep)
    else:
        at = np.unique(np.lib.stride_tricks.sliding_window_view(grams, window).argmin(1) + np.arange(n - window + 1))
    return grams[at], at


class ItemIndex:
    """Sorted fingerprints of items, with the places where each occurs."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.items = dict(items)
        hashes, places = [], []
        for key, seq in items:
            h, at = fingerprints(seq)
            hashes.append(h)
            places += [(key, int(p)) for p in at]
        flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.hashes = flat[order]
        self.places = [places[i] for i in order]

    def hits(self, seq: list[str]) -> list[tuple[int, int, int]]:
        """(item, position in the document, position in the item) of every shared fingerprint."""
        h, at = fingerprints(seq)
        if not len(h) or not len(self.hashes):
            return []
        lo = np.searchsorted(self.hashes, h)
        found = np.flatnonzero(self.hashes[np.minimum(lo, len(self.hashes) - 1)] == h)
        out = []
        for f in found:
            j = int(lo[f])
            while j < len(self.hashes) and self.hashes[j] == h[f]:
                key, p = self.places[j]
                out.append((key, int(at[f]), p))
                j += 1
        return out


def opening(text: str) -> str:
    m = re.match(r"\s*[^.!?:]*[.!?:]+(?=\s)", text)
    return m.group() if m else ""


def _side(doc: list[str], item: list[str], d: int, i: int, step: int) -> list[int]:
    """best[n]: highest balance of aligning the next n item words from (d, i) in direction ``step``.

    Banded alignment; it ends once the balance has fallen three changes below its best.
    """
    cost = ONE_IN - 1
    end_i = len(item) if step > 0 else -1
    best, top, none = [0], 0, -(10**6)
    row = {o: -cost * o for o in range(BAND + 1)}  # document words minus item words -> balance
    n = 0
    while i + n * step != end_i and max(row.values()) >= top - 3 * cost:
        word, new = item[i + n * step], {}
        for o in range(-BAND, BAND + 1):
            at = d + (n + o) * step
            value = row.get(o + 1, none) - cost  # item word left out
            if o + n >= 0 and 0 <= at < len(doc):
                value = max(value, row.get(o, none) + (1 if doc[at] == word else -cost))
                value = max(value, new.get(o - 1, none) - cost)  # document word added
            if value > top - 4 * cost:
                new[o] = value
        if not new:
            break
        row = new
        n += 1
        best.append(max(row.values()))
        top = max(top, best[-1])
    return best


def extend(doc: list[str], item: list[str], d: int, i: int, k: int = K) -> tuple[int, int, int]:
    """(first, last, d_last): item words [first, last) covered by the longest stretch around a seed."""
    right = _side(doc, item, d + k, i + k, 1)
    left = _side(doc, item, d - 1, i - 1, -1)
    size, pick = 0, (0, 0)
    for a, x in enumerate(left):
        for b in range(len(right) - 1, -1, -1):
            if a + b <= size:
                break
            if x + right[b] + k >= 0:
                size, pick = a + b, (a, b)
    return i - pick[0], i + k + pick[1], d + k + pick[1]


def _promising(doc: list[str], item: list[str], d: int, i: int, least: int) -> bool:
    """False only where no stretch through the seed can reach ``least`` words.

    Such a stretch covers ``least`` words of the item near the seed; the alignment stands
    at most five changes a side there, so all but ten of them stand near it in the document.
    """
    near = set(doc[max(0, d - least - BAND) : d + least + K + BAND])
    return sum(w in near for w in item[max(0, i + K - least) : i + least]) >= least - 10


def leaked_items(doc: list[str], index: ItemIndex, least: int = MIN_WORDS) -> list[int]:
    """Items of which ``doc`` holds a stretch of ``least`` words or more."""
    out: set[int] = set()
    for key, d, i in index.hits(doc):
        item = index.items[key]
        if key in out or not _promising(doc, item, d, i, least) or doc[d : d + K] != item[i : i + K]:
            continue
        # A seed inside a stretch that was too short may belong to a longer one.
        a, b, _ = extend(doc, item, d, i)
        if b - a >= least:
            out.add(key)
    return sorted(out)


@F.arrow_udf(T.StringType())
def _opening(texts: pa.Array) -> pa.Array:
    return pa.array([opening(t) for t in texts.to_pylist()], pa.string())


@F.arrow_udf(T.ArrayType(T.StringType()))
def _words(texts: pa.Array) -> pa.Array:
    return pa.array([words(t) for t in texts.to_pylist()], pa.list_(pa.string()))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _prints(texts: pa.Array) -> pa.Array:
    """Distinct fingerprints of texts, as signed numbers."""
    return pa.array([np.unique(fingerprints(words(t))[0]).view(np.int64).tolist() for t in texts.to_pylist()], pa.list_(pa.int64()))


def item_table(items: DataFrame) -> DataFrame:
    """(item_id, text, words, n) without the opening sentences that several items share; nothing reaches the driver."""
    base = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    opened = base.withColumn("opening", _opening.asNondeterministic()("text"))
    users = opened.groupBy("opening").agg(F.countDistinct("item_id").alias("users")).where("users > 1 AND opening <> ''")
    cut = opened.join(users, "opening", "left")
    own = F.when(F.col("users").isNotNull(), F.expr("substr(text, char_length(opening) + 1)")).otherwise(F.col("text"))
    cut = cut.select("item_id", own.alias("text"))
    out = cut.withColumn("words", _words.asNondeterministic()("text"))
    return durable(out.withColumn("n", F.size("words")))


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(doc_id, item_id): each document with each item that leaked into it.

    The words of all items are counted.  Up to ``INDEX_FINGERPRINTS`` (no item has more
    fingerprints than words) their index is broadcast.  Beyond that fingerprints are joined
    as tables, spread by a salt, and texts meet only for the pairs that share one; no item
    reaches the driver then.
    """
    known = item_table(items)
    base = docs.where(F.col(column).isNotNull()).select(F.col(key).alias("doc_id"), F.col(column).alias("text"))
    base = spread(base, "doc_id")
    if (known.agg(F.sum("n")).first()[0] or 0) > INDEX_FINGERPRINTS:
        return _joined_leaks(base, known).withColumnRenamed("doc_id", key)
    rows = known.select("item_id", "words").collect()
    merged: dict[int, list[str]] = {}
    for n, r in enumerate(sorted(rows, key=lambda r: (r.item_id, r.words))):
        merged[n] = r.words
    ids = [r.item_id for r in sorted(rows, key=lambda r: (r.item_id, r.words))]
    shared = docs.sparkSession.sparkContext.broadcast((ItemIndex(list(merged.items())), ids))

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def check(texts: pa.Array) -> pa.Array:
        index, names = shared.value
        return pa.array([sorted({names[n] for n in leaked_items(words(t), index)}) for t in texts.to_pylist()], pa.list_(pa.int64()))

    found = base.select(F.col("doc_id").alias(key), check.asNondeterministic()("text").alias("items"))
    return found.select(key, F.explode("items").alias("item_id")).distinct()


def _joined_leaks(base: DataFrame, known: DataFrame) -> DataFrame:
    """The same pairs by a join of fingerprint tables.

    A document is told by its key and a digest of its text, so repeated and null keys
    keep their own texts.
    """
    at = ["_null", "_key", "_digest"]
    base = base.withColumns({"_null": F.col("doc_id").isNull(), "_key": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_digest": F.xxhash64("text")})
    hashed = base.select(*at, _prints.asNondeterministic()("text").alias("h")).select(*at, F.explode("h").alias("h"))
    hashed = hashed.withColumn("salt", F.pmod(F.col("_digest"), F.lit(SALTS)))
    item = known.select("item_id", F.xxhash64("text").alias("item_digest"), _prints.asNondeterministic()("text").alias("h"))
    item = item.select("item_id", "item_digest", F.explode("h").alias("h"))
    item = item.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    pairs = hashed.join(item, ["h", "salt"]).select(*at, "item_id", "item_digest").distinct()
    whole = known.select("item_id", F.xxhash64("text").alias("item_digest"), F.col("words").alias("item_words"))
    both = pairs.join(whole, ["item_id", "item_digest"]).join(base.select(*at, "doc_id", "text"), at)

    @F.arrow_udf(T.BooleanType())
    def holds(texts: pa.Array, item_words: pa.Array) -> pa.Array:
        return pa.array([bool(leaked_items(words(t), ItemIndex([(0, w)]))) for t, w in zip(texts.to_pylist(), item_words.to_pylist())], pa.bool_())

    checked = both.select("doc_id", "item_id", holds.asNondeterministic()("text", "item_words").alias("holds"))
    return checked.where("holds").select("doc_id", "item_id").distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"p7_found": p7_found}
ORACLE: dict[str, str] = {}
