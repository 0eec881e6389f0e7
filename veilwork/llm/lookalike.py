"""Problem 3: one consistent form for text that looks the same but is stored differently.

Method: every character is stable or unstable by a quick check (a precomputed class: it
decomposes, composes with its neighbour, is a width variant, a space variant, has no
width, or is a look-alike letter).  Only the unstable segments, with the character
before them and the marks after them as boundary context, are normalised; the canonical
segments are spliced back between the untouched stretches.  ASCII text is stable as a
whole and never leaves the JVM.

Canonical form: characters without width vanish; space variants become U+0020 (line
breaks and tabs stay); full- and half-width forms take their ordinary form; micro sign
becomes mu; letters of one shape become one letter per word: Latin, unless the word
holds a letter that only Cyrillic (or Greek) has and none that only Latin has; the
result is in composed form.  Accents, case, raised and lowered digits, fractions,
ligatures and sharp s stay distinct.

Null stays null, empty stays empty; repeated rows are kept; other columns pass through.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.functions.durable import durable
from veilwork.functions.join import SALTS, sized_join
from veilwork.functions.text import has_non_ascii, is_blank
from veilwork.sources.tables import spread, table

# Letters of the same shape, aligned one to one.
CYRILLIC = "аеорсухіјѕһԁԛԝӏАВЕКМНОРСТУХІЈЅԚԜҮӕӔ"
CYRILLIC_AS_LATIN = "aeopcyxijshdqwlABEKMHOPCTYXIJSQWYæÆ"
GREEK = "ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧϳͿ"
GREEK_AS_LATIN = "ovABEZHIKMNOPTYXjJ"
# Characters without width, as ranges of code points.
WIDTHLESS = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F),
    (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF),
    (0xFFA0, 0xFFA0), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
)

_TO_LATIN = {ord(a): b for a, b in zip(CYRILLIC + GREEK, CYRILLIC_AS_LATIN + GREEK_AS_LATIN)}


def _back(own: str, latin: str) -> dict[int, str]:
    out: dict[int, str] = {}
    for a, b in zip(own, latin):
        out.setdefault(ord(b), a)
    return out


_TO_CYRILLIC = _back(CYRILLIC, CYRILLIC_AS_LATIN)
_TO_GREEK = _back(GREEK, GREEK_AS_LATIN)


def _widthless(cp: int) -> bool:
    return any(a <= cp <= b for a, b in WIDTHLESS)


def _single(cp: int) -> str | None:
    """The replacement of one character by itself, or None where it stays."""
    ch = chr(cp)
    if _widthless(cp):
        return ""
    if unicodedata.category(ch) == "Zs":
        return " "
    if cp == 0x00B5:
        return "μ"
    if 0xFF01 <= cp <= 0xFFEF or cp == 0x3000:
        return unicodedata.normalize("NFKC", ch)
    return None


@lru_cache(1)
def _tables() -> tuple[dict[int, str], re.Pattern, re.Pattern]:
    """Replacements of single characters; patterns of an unstable run and of a word.

    Built by rule from the Unicode database.
    """
    single: dict[int, str] = {}
    unstable: list[int] = []
    marks: list[int] = []
    # Ideographs, syllables, surrogates and private use are stable by block.
    blocks = ((0x80, 0x3400), (0xA000, 0xAC00), (0xD7B0, 0xD800), (0xF900, 0x20000), (0x2F800, 0x2FA20), (0xE0000, 0xE1000))
    for cp in (c for a, b in blocks for c in range(a, b)):
        ch = chr(cp)
        if (to := _single(cp)) is not None and to != ch:
            single[cp] = to
            unstable.append(cp)
        elif unicodedata.combining(ch) or 0x1160 <= cp <= 0x11FF:
            marks.append(cp)
        elif not unicodedata.is_normalized("NFC", ch) or cp in _TO_LATIN:
            unstable.append(cp)
        elif ord(unicodedata.normalize("NFD", ch)[0]) in _TO_LATIN:
            unstable.append(cp)
    def body(cps: list[int]) -> str:
        out, i = [], 0
        while i < len(cps):
            j = i
            while j + 1 < len(cps) and cps[j + 1] == cps[j] + 1:
                j += 1
            out.append(f"\\U{cps[i]:08x}-\\U{cps[j]:08x}" if j > i else f"\\U{cps[i]:08x}")
            i = j + 1
        return "".join(out)

    # An unstable run with the marks that follow it.
    segment = re.compile(f"[{body(sorted(unstable + marks))}]+")
    return single, segment, re.compile(r"[^\W\d_]+(?:[\u0300-\u036f]+[^\W\d_]*)*")


_OTHER_SCRIPT = re.compile("[\u0370-\u03ff\u0400-\u052f\u1f00-\u1fff]")


def _script(word: str) -> str | None:
    own: set[str] = set()
    for ch in word:
        if ch.isascii():
            if ch in _ONLY_LATIN:
                own.add("L")
            continue
        base = unicodedata.normalize("NFD", ch)[0]
        cp = ord(base)
        if base.isascii():
            if base in _ONLY_LATIN:
                own.add("L")
        elif 0x0400 <= cp <= 0x052F:
            own.add("C")
        elif 0x0370 <= cp <= 0x03FF or 0x1F00 <= cp <= 0x1FFF:
            own.add("G")
        else:
            own.add("L")
    return own.pop() if len(own) == 1 else None


_ONLY_LATIN = {
    c for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" if c not in CYRILLIC_AS_LATIN + GREEK_AS_LATIN
}


def _word(m: re.Match) -> str:
    word = m.group()
    return word if word.isascii() else _in_one_script(word)


@lru_cache(65536)
def _in_one_script(word: str) -> str:
    script = _script(word)
    if script == "C":
        return unicodedata.normalize("NFC", unicodedata.normalize("NFD", word).translate(_TO_CYRILLIC))
    if script == "G":
        return unicodedata.normalize("NFC", unicodedata.normalize("NFD", word).translate(_TO_GREEK))
    return word


_known: dict[str, str] = {}  # forms of short segments


def canonical(text: str) -> str:
    """The canonical form of one text."""
    if text.isascii():
        return text
    single, segment, words = _tables()
    if segment.search(text) is None:
        return words.sub(_word, text) if _OTHER_SCRIPT.search(text) else text

    parts, done = [], 0
    for m in segment.finditer(text):
        at, to = m.span()
        at = max(done, at - 1)  # one character of context
        part = text[at:to]
        form = _known.get(part)
        if form is None:
            form = unicodedata.normalize("NFC", unicodedata.normalize("NFD", part.translate(single)).translate(_TO_LATIN))
            if len(_known) > 65536:
                _known.clear()
            if len(part) < 16:
                _known[part] = form
        parts += (text[done:at], form)
        done = to
    out = "".join((*parts, text[done:]))
    if out.isascii():
        return out
    # A removed character may have stood between a base and the mark spliced after it.
    if not unicodedata.is_normalized("NFC", out):
        out = unicodedata.normalize("NFC", out)
    return words.sub(_word, out) if _OTHER_SCRIPT.search(out) else out


@F.arrow_udf(T.StringType())
def _canonical_udf(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else canonical(t) for t in texts.to_pylist()], pa.string())


def canonicalize(df: DataFrame, column: str = "text", to: str = "canonical") -> DataFrame:
    """Add ``to``, the canonical form of ``column``; ASCII rows bypass Python."""
    text = F.col(column)
    return df.withColumn(to, F.coalesce(_canonical_udf.asNondeterministic()(F.when(has_non_ascii(text), text)), text))


def _forms(df: DataFrame, key: str, column: str) -> DataFrame:
    """(id, c1, c2, r1, r2): 128-bit digests of the canonical and the stored form of each row, checkpointed."""
    base = df.select(F.col(key).alias("id"), F.col(column).alias("text"))
    base = base.where(F.col("id").isNotNull() & ~is_blank(F.col("text")))
    digest = lambda c, n: (F.xxhash64(c).alias(f"{n}1"), F.xxhash64(F.lit(1), c).alias(f"{n}2"))
    return durable(canonicalize(spread(base, "id")).select("id", *digest("canonical", "c"), *digest("text", "r")))


def equal_pairs(df: DataFrame, key: str = "id", column: str = "text") -> DataFrame:
    """Pairs of rows with equal canonical form and different code points (``id_a`` < ``id_b``).

    Rows are reduced to digests before any shuffle, and a map-side aggregate leaves one row
    a stored form.  Forms are paired first, so each joined pair is a result; then their
    rows are looked up, with a salt, so a form with a third of all rows is spread.  Groups
    of exact copies end at the aggregate.  Rows with a null key or a null or blank text
    form no pair; a key that repeats pairs only with greater and smaller ones.
    """
    forms = _forms(df, key, column)
    distinct = forms.groupBy("c1", "c2", "r1", "r2").agg(F.lit(1).alias("one"))
    mixed = durable(distinct.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c1", "c2"))
    members = sized_join(forms, mixed, ["c1", "c2"], "left_semi")
    reps = members.select("c1", "c2", "r1", "r2").distinct()
    other = reps.select("c1", "c2", F.col("r1").alias("q1"), F.col("r2").alias("q2"))
    pairs = reps.join(other, ["c1", "c2"]).where("r1 < q1 OR r1 = q1 AND r2 < q2").drop("c1", "c2")
    salted = members.select("r1", "r2", F.col("id").alias("id_a"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    spread_ = lambda p: p.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    left = spread_(pairs).join(salted, ["r1", "r2", "salt"]).select("q1", "q2", "id_a")
    right = salted.select(F.col("r1").alias("q1"), F.col("r2").alias("q2"), F.col("id_a").alias("id_b"), "salt")
    both = spread_(left).join(right, ["q1", "q2", "salt"]).where("id_a <> id_b")
    return both.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


def equal_classes(df: DataFrame, key: str = "id", column: str = "text") -> DataFrame:
    """(key, class_id, n_forms, n_links): each row with the least key of its class and the number of rows it pairs with.

    For tables whose classes are too large to write all pairs.
    """
    forms = _forms(df, key, column)
    form = forms.groupBy("c1", "c2", "r1", "r2").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    whole = form.groupBy("c1", "c2").agg(F.min("least").alias("class_id"), F.count(F.lit(1)).alias("n_forms"), F.sum("n").alias("total"))
    known = durable(form.join(whole, ["c1", "c2"]).select("c1", "c2", "r1", "r2", "class_id", "n_forms", (F.col("total") - F.col("n")).alias("n_links")))
    found = sized_join(forms, known, ["c1", "c2", "r1", "r2"])
    return found.select(F.col("id").alias(key), "class_id", "n_forms", "n_links")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equal_pairs(table(spark, sf_dir, "test"))


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equal_classes(table(spark, sf_dir, "test"))


def p3_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonicalize(spread(table(spark, sf_dir, "test").select("id", "text"), "id")).select("id", "canonical")


QUERIES = {"p3_found": p3_found, "p3_classes": p3_classes, "p3_canonical": p3_canonical}


def _sql_chars(cps: list[int]) -> str:
    return " || ".join(f"chr({c})" for c in cps)


def _oracle() -> str:
    """Canonical forms by plain character translation of whole texts."""
    accents = [c for c in range(0x00C0, 0x0530) if len(d := unicodedata.normalize("NFD", chr(c))) > 1 and ord(d[0]) in _TO_LATIN]
    composed = [(c, unicodedata.normalize("NFC", unicodedata.normalize("NFD", chr(c)).translate(_TO_LATIN))) for c in accents]
    composed = [(c, d) for c, d in composed if len(d) == 1]
    wide = [(c, _single(c)) for c in range(0xFF01, 0xFF5F)]
    spaces = [(c, " ") for c in range(0x80, 0x3001) if unicodedata.category(chr(c)) == "Zs"]
    pairs = [*_TO_LATIN.items(), *composed, *wide, *spaces, (0xB5, "μ")]
    src, dst = _sql_chars([p[0] for p in pairs]), _sql_chars([ord(p[1]) for p in pairs])
    zw = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in WIDTHLESS)
    return f"""WITH k AS (
  SELECT id, text, nfc_normalize(translate(nfc_normalize(regexp_replace(text, '[{zw}]', '', 'g')), {src}, {dst})) AS ck
  FROM test WHERE text IS NOT NULL AND NOT regexp_full_match(text, '(?s)[\\s\\x1c-\\x1f\\x85\\xa0\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]*'))"""


ORACLE = {
    "p3_found": f"{_oracle()} SELECT a.id AS id_a, b.id AS id_b FROM k a JOIN k b ON a.ck = b.ck AND a.id < b.id AND a.text <> b.text",
    "p3_classes": f"""{_oracle()}, f AS (SELECT ck, text, count(*) AS n, min(id) AS least FROM k GROUP BY ck, text),
      w AS (SELECT ck, min(least) AS class_id, count(*) AS n_forms, sum(n) AS total FROM f GROUP BY ck)
      SELECT k.id, w.class_id, w.n_forms, CAST(w.total - f.n AS BIGINT) AS n_links FROM k JOIN f ON f.ck = k.ck AND f.text = k.text JOIN w ON w.ck = k.ck""",
}
