"""Known names as a table: the part of a list that occurs in each text."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.functions.durable import durable
from veilwork.functions.join import sized_join

#: Most known names that are shipped to the workers as a set (some 20 bytes each on the way).
NAMES_IN_MEMORY = 1_000_000

_TITLE = re.compile("[A-Z][a-z]+")


@F.arrow_udf(T.ArrayType(T.StringType()))
def _title_tokens(texts: pa.Array) -> pa.Array:
    """Distinct stretches of a capital and small letters in the compatibility form; every token a person rule may validate is one."""
    form = lambda t: t if t.isascii() else unicodedata.normalize("NFKC", t)
    return pa.array([None if t is None else sorted(set(_TITLE.findall(form(t)))) for t in texts.to_pylist()], pa.list_(pa.string()))


def listed_names(df: DataFrame, names: DataFrame, text: Column, key: str | None) -> DataFrame:
    """Add ``__listed``: the tokens of each text that ``names`` (name, distinct) holds.

    For lists of any length.  The distinct tokens of all texts, combined before the
    shuffle, meet the names; those listed are joined with (key, token) by ``sized_join``,
    so a token common to a third of all rows makes no hot task.  The texts are shuffled
    once, for the join back.  ``key`` must be unique; without one it is a ``ValueError``.
    """
    if key is None:
        raise ValueError("names beyond the bound need the key of the rows")
    tokens = df.where(F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.explode(_title_tokens.asNondeterministic()(text)).alias("name"))
    listed = durable(tokens.select("name").distinct().join(names, "name", "left_semi"))
    found = sized_join(tokens, listed, ["name"], "left_semi").groupBy("__key").agg(F.collect_set("name").alias("__listed"))
    return df.join(found, F.col(f"`{key}`") == F.col("__key"), "left").drop("__key")
