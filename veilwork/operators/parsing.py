"""Problem 5: separate records that fail to parse, with the reason, from the loadable rows.

Method: each record is parsed into cells, the cells are exploded into (row, column,
value), joined with a rule table, every rule is evaluated, the errors are aggregated to
the first reason of a row, and the valid rows are what an anti-join leaves.

Quoting is judged without a cell-by-cell automaton: cut at the double quotes, a record
alternates between stretches outside and inside quotes.  It is well formed iff the
number of quotes is even, the first outside stretch is empty or ends with a comma, the
last is empty or starts with one, and each one between is empty (a doubled quote) or
starts and ends with a comma.  All of it is JVM expressions, linear in the record.

Reasons in order: ``quoting``, ``column_count``, ``bad_value``.  A null or empty record
has one field, so it fails with ``column_count``.  Nothing is trimmed.  Records that
repeat are judged alike; a null key is a key of its own.  Columns of the input that the
operator does not name are ignored, so clashing names cannot disturb it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilwork.functions.durable import durable
from veilwork.functions.join import sized_join
from veilwork.functions.text import is_blank

COLUMNS = ("id", "text", "facility", "note_type", "age", "written_at")
NOTE_TYPES = ("progress", "discharge", "referral", "radiology", "nursing", "triage", "consult", "phone_call")
REASONS = ("quoting", "column_count", "bad_value")

#: (column, rule): the rule table; columns without a rule are free.
RULES = (("id", "positive_bigint"), ("text", "not_blank"), ("note_type", "one_of_types"), ("age", "age"), ("written_at", "timestamp"))

# Delimiters of the intermediate form; occurrences in the data are escaped first.
_ESC, _SEP = "\x01", "\x02"
_MAX_BIGINT = "9223372036854775807"


def _well_quoted(parts: Column) -> Column:
    """``parts``: the record split at its double quotes."""
    n = F.size(parts)
    first, last = F.element_at(parts, 1), F.element_at(parts, -1)
    inner_ok = F.forall(
        F.transform(parts, lambda s, i: F.struct(s.alias("s"), i.alias("i"))),
        lambda p: (p["i"] % 2 == 1)
        | (p["i"] == 0)
        | (p["i"] == n - 1)
        | (p["s"] == "")
        | (p["s"].startswith(",") & p["s"].endswith(",")),
    )
    return (n == 1) | (
        (n % 2 == 1) & ((first == "") | first.endswith(",")) & ((last == "") | last.startswith(",")) & inner_ok
    )


def _cells(parts: Column) -> Column:
    """Cells of a well-quoted record."""

    def stretch(s: Column, i: Column) -> Column:
        s = F.replace(F.replace(s, F.lit(_ESC), F.lit(_ESC + "1")), F.lit(_SEP), F.lit(_ESC + "2"))
        doubled = (s == "") & (i > 0) & (i < F.size(parts) - 1)
        return F.when(i % 2 == 1, s).when(doubled, F.lit('"')).otherwise(F.replace(s, F.lit(","), F.lit(_SEP)))

    joined = F.array_join(F.transform(parts, stretch), "")
    undo = lambda s: F.replace(F.replace(s, F.lit(_ESC + "2"), F.lit(_SEP)), F.lit(_ESC + "1"), F.lit(_ESC))
    return F.transform(F.split(joined, _SEP, -1), undo)


def parse_records(df: DataFrame, key: str = "raw_id", raw: str = "raw") -> DataFrame:
    """(key, raw_digest, well_quoted, cells): ``cells`` is null where the quoting is broken."""
    parts = F.split(F.coalesce(F.col(raw), F.lit("")), '"', -1)
    return (
        df.select(F.col(key).alias("key"), F.xxhash64(raw).alias("digest"), parts.alias("parts"))
        .select("key", "digest", "parts", _well_quoted(F.col("parts")).alias("well_quoted"))
        .select("key", "digest", "well_quoted", F.when(F.col("well_quoted"), _cells(F.col("parts"))).alias("cells"))
    )


def _valid(rule: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, r"\A0+", "")
    bigint = value.rlike(r"\A[0-9]+\z") & (
        F.length(digits).between(1, 18) | ((F.length(digits) == 19) & (digits <= F.lit(_MAX_BIGINT)))
    )
    age = (value == "") | value.rlike(r"\A0*(?:[0-9]{1,2}|1[01][0-9]|120)\z")
    part = lambda a, n: F.substring(value, a, n).cast("int")
    year, month, day = part(1, 4), part(6, 2), part(9, 2)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    days = (
        F.when(month.isin(4, 6, 9, 11), 30).when((month == 2) & leap, 29).when(month == 2, 28).otherwise(31)
    )
    stamp = F.when(
        value.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z"),
        (year >= 1) & month.between(1, 12) & (day >= 1) & (day <= days),
    ).otherwise(False)
    return (
        F.when(rule == "positive_bigint", bigint)
        .when(rule == "not_blank", ~is_blank(value))
        .when(rule == "one_of_types", value.isin(*NOTE_TYPES))
        .when(rule == "age", age)
        .when(rule == "timestamp", stamp)
    )


def record_errors(parsed: DataFrame) -> DataFrame:
    """(key, digest, reason) of each record that is not valid, by the rule table.

    Only the outcome of each rule, never a text, is shuffled, and the outcomes of one
    record combine before the shuffle.
    """
    spark = parsed.sparkSession
    rules = spark.createDataFrame([(COLUMNS.index(c), r) for c, r in RULES], "pos int, rule string")
    arity = F.size("cells")
    shape = F.when(~F.col("well_quoted"), 0).when(arity != len(COLUMNS), 1)
    cells = parsed.select(
        "key", "digest", shape.alias("shape"), F.posexplode(F.coalesce("cells", F.array(F.lit("")))).alias("pos", "value")
    )
    # The rule table has one row a rule, a constant of this module.
    judged = cells.join(F.broadcast(rules), "pos", "left").select(
        "key",
        "digest",
        F.coalesce("shape", F.when(~_valid(F.col("rule"), F.col("value")), 2)).alias("code"),
    )
    codes = judged.groupBy("key", "digest").agg(F.min("code").alias("code")).where("code IS NOT NULL")
    return codes.select("key", "digest", F.element_at(F.array(*map(F.lit, REASONS)), F.col("code") + 1).alias("reason"))


def failed_records(df: DataFrame, key: str = "raw_id", raw: str = "raw") -> DataFrame:
    """(key, reason) of the records that are not valid."""
    return record_errors(parse_records(df, key, raw)).select(F.col("key").alias(key), "reason")


def load_valid(df: DataFrame, key: str = "raw_id", raw: str = "raw") -> DataFrame:
    """Typed rows of the valid records: the anti-join of all records with the failed ones.

    The failed ones are counted: while few, they are broadcast and no record is shuffled.
    """
    parsed = parse_records(df, key, raw)
    # A null key is a key of its own, and equal digests make equal records.
    known = lambda d: d.withColumns({"_null": F.col("key").isNull(), "_key": F.coalesce(F.col("key").cast("string"), F.lit(""))})
    errors = durable(known(record_errors(parsed)).select("_null", "_key", "digest").distinct())
    clean = sized_join(known(parsed), errors, ["_null", "_key", "digest"], "left_anti")
    cell = {c: F.element_at("cells", i + 1) for i, c in enumerate(COLUMNS)}
    return clean.select(
        F.col("key").alias(key),
        cell["id"].cast("bigint").alias("id"),
        cell["text"].alias("text"),
        cell["facility"].alias("facility"),
        cell["note_type"].alias("note_type"),
        F.nullif(cell["age"], F.lit("")).cast("int").alias("age"),
        F.to_timestamp_ntz(cell["written_at"], F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("written_at"),
    )
