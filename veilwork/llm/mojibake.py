"""Problem 1: text that was decoded with another encoding than it was written in.

Method: every distinct word of the corpus that holds a character beyond ASCII, and every
run of such characters, is a unit.  For each unit its garbled forms under all encoding
chains are generated (written as UTF-8 and read by a single-byte or East Asian decoder,
once or twice, also re-cased or stripped of its non-breaking space; written by one
single-byte encoder and read by another, or read as UTF-8 with replacement characters).
That table is hash-joined with the units that occur; a match that passes verification
marks the unit as garbled and names its original.  Rows holding such a unit are found;
restoration substitutes the verified originals, longest unit first.

Verification:
- a UTF-8 chain makes text longer, so a match needs two characters or more, or a word
  that mixes ASCII letters with the garbled ones; a form of two characters may also be
  ordinary text, so its original must occur in at least as many rows;
- a form with U+FFFD is garbled wherever it stands;
- a chain that keeps the length (between single-byte encodings, or to an East Asian one)
  is reversible, so only whole words count and the original must occur in at least three
  times as many rows as the garbled form, and in three or more.

Statistics cover all rows.  Null, empty and ASCII texts hold no unit.  Repeated rows are
judged alike; a null key stays a key; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.functions.durable import durable
from veilwork.functions.join import BROADCAST_ROWS, sized_join
from veilwork.functions.text import has_non_ascii
from veilwork.llm.lookalike import CYRILLIC, GREEK
from veilwork.sources.tables import spread, table

# Names of encodings.
UTF8_READ_AS = (
    "cp1252", "latin_1", "iso8859_15", "cp1250", "cp1251", "cp1253", "cp1254", "cp1257", "iso8859_2", "iso8859_5",
    "iso8859_7", "iso8859_9", "cp437", "cp850", "cp852", "cp866", "mac_roman", "mac_cyrillic", "koi8_r", "gbk", "big5",
    "shift_jis", "euc_jp", "euc_kr",
)
READ_TWICE = ("cp1252", "latin_1", "cp850", "mac_roman")
WRITTEN_AS = (
    "cp1252", "iso8859_15", "cp1250", "cp1251", "koi8_r", "cp866", "iso8859_5", "cp1253", "iso8859_7", "mac_roman",
    "mac_cyrillic", "cp437", "cp850", "shift_jis", "euc_jp", "gbk",
)
READ_AS = (
    "cp1252", "latin_1", "cp1250", "cp1251", "koi8_r", "cp866", "cp1253", "mac_roman", "mac_cyrillic", "cp437", "cp850",
    "gbk", "shift_jis", "utf_8",
)

_ASCII_BREAK = r"[\x00-/:-@\[-`{-\x7f]+"
_BEYOND_ASCII = r"[^\x00-\x7f]+"


@lru_cache(None)
def _passing(encoding: str) -> dict[int, str]:
    """A single-byte decoder that lets undefined bytes pass as controls, as a table over Latin-1."""
    return {b: bytes((b,)).decode(encoding, "ignore") or chr(b) for b in range(256)}


def _read(raw: bytes, encoding: str) -> set[str]:
    """What common decoders make of ``raw``: undefined bytes pass as controls, are replaced, or vanish."""
    try:
        return {raw.decode(encoding)}
    except UnicodeDecodeError:
        out = {raw.decode(encoding, "replace")}
        if encoding != "utf_8":
            out.add(raw.decode(encoding, "ignore"))
            if encoding.startswith("cp125"):
                out.add(raw.decode("latin_1").translate(_passing(encoding)))
        return out


#: Single-byte encodings, of which a byte tells whether its character may occur.
_SINGLE_BYTE = frozenset({*UTF8_READ_AS, *READ_AS} - {"gbk", "big5", "shift_jis", "euc_jp", "euc_kr", "utf_8"})


@lru_cache(8)
def _allowed(known: frozenset[str]) -> dict[str, bytes]:
    """By single-byte encoding the bytes that are undefined or read as a character (in either case) of ``known``."""
    either = known | {c.lower() for c in known} | {c.upper() for c in known}
    out = {}
    for e in _SINGLE_BYTE:
        read = {b: bytes((b,)).decode(e, "ignore") for b in range(256)}
        out[e] = bytes(b for b, c in read.items() if not c or c in either or c == "\xa0")
    return out


def garbled_forms(unit: str, known: frozenset[str] | None = None, swaps: bool = True) -> dict[str, str]:
    """Garbled form to chain class: ``utf8`` or ``swap``.

    ``known``: the characters of the corpus; other forms cannot occur, and where a byte
    reads as a character beyond them the chain is left at once.  ``swaps`` False leaves
    out reversible chains, of which a unit in fewer than three rows is no original.
    """
    out: dict[str, str] = {}
    raw = unit.encode("utf-8")
    allowed = _allowed(known) if known is not None else {}
    cannot = lambda data, e: e in allowed and data.translate(None, allowed[e])
    for encoding in UTF8_READ_AS:
        if encoding not in READ_TWICE and cannot(raw, encoding):
            continue
        once = _read(raw, encoding)
        twice: set[str] = set()
        if encoding in READ_TWICE:
            for form in once:
                data = form.encode("utf-8")
                for again in READ_TWICE:
                    if not cannot(data, again):
                        twice |= _read(data, again)
        for form in once | twice:
            if known is not None and not known.issuperset(form):
                continue
            # Re-casing and trimming happen to texts that were misread once.
            for variant in (form, form.lower(), form.upper(), form.strip("\xa0")) if form in once else (form,):
                if len(variant) > len(unit):
                    out[variant] = "utf8"
                elif swaps or "\ufffd" in variant:
                    out.setdefault(variant, "swap")
    for source in WRITTEN_AS:
        try:
            raw = unit.encode(source)
        except UnicodeEncodeError:
            continue
        for target in READ_AS if swaps else ("utf_8",):
            if target != source and not cannot(raw, target):
                for form in _read(raw, target):
                    out.setdefault(form, "swap")
    out.pop(unit, None)
    return {g: c for g, c in out.items() if g and not g.isascii()}


_FORM_ROWS = "kind string, original string, n_original long, h long, chain string"
_STEP = 256


def _form_rows(inventory):
    """Map distinct units to their garbled forms, a few units at a time; a form travels as a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = inventory.value
        for batch in batches:
            for at in range(0, batch.num_rows, _STEP):
                rows: tuple[list, ...] = ([], [], [], [], [])
                part = batch.slice(at, _STEP).to_pydict()
                for kind, unit, n in zip(part["kind"], part["unit"], part["n"]):
                    for form, chain in garbled_forms(unit, known, n >= 3).items():
                        if known.issuperset(form):
                            for column, value in zip(rows, (kind, unit, n, form_hash(form), chain)):
                                column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(rows, (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                    names=["kind", "original", "n_original", "h", "chain"],
                )

    return run


def form_hash(form: str) -> int:
    """The value of Spark's ``xxhash64`` (seed 42) for a string."""
    h = xxhash.xxh64_intdigest(form.encode(), 42)
    return h - (1 << 64) if h >= 1 << 63 else h


def _units(text: Column) -> Column:
    """Distinct words (kind w) and runs (kind n) beyond ASCII of one text."""
    words = F.filter(F.split(text, _ASCII_BREAK), has_non_ascii)
    runs = F.regexp_extract_all(text, F.lit(_BEYOND_ASCII), 0)
    tag = lambda kind: lambda u: F.struct(F.lit(kind).alias("kind"), u.alias("unit"))
    return F.concat(
        F.transform(F.array_distinct(words), tag("w")), F.transform(F.array_distinct(runs), tag("n"))
    )


def row_units(df: DataFrame, key: str, column: str) -> DataFrame:
    """(id, kind, unit): the units of each row; the text itself goes no further."""
    text = F.col(column)
    return (
        df.where(has_non_ascii(text))
        .select(F.col(key).alias("id"), F.explode(_units(text)).alias("u"))
        .select("id", "u.kind", "u.unit")
    )


def _verified(kind: Column, form: Column, chain: Column, n_original: Column, n_form: Column) -> Column:
    size = F.char_length(form)
    mixed = form.rlike("[A-Za-z0-9]")
    # Runs of look-alike letters and odd spaces are disguised ASCII, not garbled text.
    disguise = (size <= 3) & form.rlike(f"\\A[{CYRILLIC}{GREEK}\\p{{Z}}]+\\z")
    growth = F.when(kind == "n", (size >= 2) & ~disguise).otherwise(((size >= 2) | mixed) & ~disguise)
    growth = growth & ((size > 2) | (n_original >= n_form))
    east_asian = form.rlike("[\u3000-\u9fff\uac00-\ud7a3\uff61-\uff9f]")
    long_enough = (mixed & ((size >= 3) | ((size >= 2) & east_asian))) | (size >= 4)
    swap = (kind == "w") & long_enough & (n_original >= 3) & (n_original >= 3 * n_form)
    return form.contains("�") | F.when(chain == "utf8", growth).otherwise(swap)


def garbled_dictionary(units: DataFrame) -> DataFrame:
    """(kind, unit, original): the garbled units of a corpus; ``original`` is null where it cannot be told.

    One row a distinct unit is shuffled for the counts, then the generated table, as
    64-bit hashes and without forms that use a character the corpus lacks, meets the
    distinct units in a hash join.
    """
    counts = durable(units.groupBy("kind", "unit").agg(F.count(F.lit(1)).alias("n")))
    # Every character that occurs; there are no more than Unicode has.
    rows = counts.select(F.explode(F.array_distinct(F.split("unit", ""))).alias("c")).distinct().collect()
    inventory = frozenset(r.c for r in rows) | frozenset(map(chr, range(128)))
    shared = counts.sparkSession.sparkContext.broadcast(inventory)
    table_ = spread(counts, "unit").mapInArrow(_form_rows(shared), _FORM_ROWS)
    seen = counts.select("kind", F.col("unit").alias("form"), F.xxhash64("unit").alias("h"), F.col("n").alias("n_form"))
    hits = table_.join(seen, ["kind", "h"]).where(
        _verified(F.col("kind"), F.col("form"), F.col("chain"), F.col("n_original"), F.col("n_form"))
    )
    lost = (F.col("kind") == "n") & F.col("form").contains("�")
    ranked = F.struct("n_original", "original")
    return (
        hits.groupBy("kind", F.col("form").alias("unit"))
        .agg(F.max(F.when(~lost, ranked)).alias("best"))
        .select("kind", "unit", F.col("best.original").alias("original"))
    )


def find_garbled(df: DataFrame, key: str = "id", column: str = "text") -> DataFrame:
    """(key) of the rows with at least one garbled stretch."""
    units = row_units(df, key, column)
    bad = garbled_dictionary(units).select("kind", "unit")
    return sized_join(units, durable(bad), ["kind", "unit"], "left_semi").select(F.col("id").alias(key)).distinct()


_WORD = re.compile(r"[^\x00-/:-@\[-`{-\x7f]+")
_RUN = re.compile(_BEYOND_ASCII)


def repaired(text: str, words: dict[str, str], runs: dict[str, str]) -> str:
    """Every unit that is known to be garbled replaced by its original: whole words, and runs inside other words."""

    def word(m: re.Match) -> str:
        w = m.group()
        if w.isascii():
            return w
        own = words.get(w)
        return own if own is not None else _RUN.sub(lambda r: runs.get(r.group(), r.group()), w)

    return _WORD.sub(word, text)


@F.arrow_udf(T.StringType())
def _repaired_by_row(texts: pa.Array, fixes: pa.Array) -> pa.Array:
    out = []
    for t, own in zip(texts.to_pylist(), fixes.to_pylist()):
        by_kind = [{f["unit"]: f["original"] for f in own or () if f["kind"] == kind and f["original"] is not None} for kind in "wn"]
        out.append(None if t is None else repaired(t, *by_kind))
    return pa.array(out, pa.string())


def restore(df: DataFrame, key: str = "id", column: str = "text") -> DataFrame:
    """(key, text) of the found rows with every garbled unit of known original replaced.

    The garbled units are counted.  Up to ``BROADCAST_ROWS`` they are shipped as a
    dictionary and looked up word by word where the text stands: no text is shuffled.
    Beyond that the units of each row are joined with them and the fixes brought to the
    text by key and digest.  A null key is a key of its own either way.
    """
    bad = durable(garbled_dictionary(row_units(df, key, column)))
    text = df.where(has_non_ascii(F.col(column))).select(F.col(key).alias("id"), F.col(column).alias("text"))
    few = bad.limit(BROADCAST_ROWS + 1).collect()
    if len(few) <= BROADCAST_ROWS:
        found = [{r.unit: r.original for r in few if r.kind == kind} for kind in "wn"]
        known = df.sparkSession.sparkContext.broadcast([{u: o for u, o in d.items() if o is not None} for d in found] + [frozenset(d) for d in found])

        @F.arrow_udf(T.StringType())
        def run(texts: pa.Array) -> pa.Array:
            words, runs, bad_words, bad_runs = known.value
            out = []
            for t in texts.to_pylist():
                hit = t is not None and not (bad_words.isdisjoint(_WORD.findall(t)) and bad_runs.isdisjoint(_RUN.findall(t)))
                out.append(repaired(t, words, runs) if hit else None)
            return pa.array(out, pa.string())

        fixed = spread(text, "id").select("id", run.asNondeterministic()("text").alias("text")).where("text IS NOT NULL")
        return fixed.select(F.col("id").alias(key), F.col("text").alias(column))
    row = lambda d: d.withColumns({"_null": F.col("id").isNull(), "_key": F.coalesce(F.col("id").cast("string"), F.lit(""))})
    at = ["_null", "_key", "_digest"]
    text = row(text).withColumn("_digest", F.xxhash64("text"))
    units = text.select(*at, F.explode(_units(F.col("text"))).alias("u")).select(*at, "u.kind", "u.unit")
    fixes = sized_join(units, bad, ["kind", "unit"]).groupBy(*at).agg(F.collect_set(F.struct("kind", "unit", "original")).alias("fixes"))
    fixed = text.join(fixes, at).select("id", _repaired_by_row.asNondeterministic()("text", "fixes").alias("text"))
    return fixed.select(F.col("id").alias(key), F.col("text").alias(column))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_garbled(table(spark, sf_dir, "test"))


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore(table(spark, sf_dir, "test"))


QUERIES = {"p1_found": p1_found, "p1_restored": p1_restored}
ORACLE: dict[str, str] = {}
