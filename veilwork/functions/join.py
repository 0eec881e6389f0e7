"""Joins whose small side is measured before it is broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rows of a side that is broadcast; rows here are a few short strings.
BROADCAST_ROWS = 300_000
SALTS = 32


def sized_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``left`` with the key-unique ``right``, whatever the skew of the keys in ``left``.

    ``right`` should be cheap to count (checkpointed).  Up to ``BROADCAST_ROWS`` rows it is
    broadcast and ``left`` stays where it is.  Beyond that both sides are shuffled on the
    keys and a salt, so that a key on a third of all rows is spread over ``SALTS`` tasks.
    """
    keys = list(keys)
    if right.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), keys, how)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
