"""Statistics of a redaction: label counts, totals, review rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilwork.functions import spans as S


def label_counts(df: DataFrame, spans: str = "spans") -> DataFrame:
    """(label, cnt), combined before the shuffle on the few labels."""
    return df.select(F.explode(spans).alias("s")).groupBy(F.col("s.label").alias("label")).agg(F.count(F.lit(1)).alias("cnt"))


def totals(df: DataFrame, spans: str = "spans") -> DataFrame:
    """One row: processed texts (neither null nor blank) and entities."""
    return df.agg(
        F.count_if(f"{spans}_counted").alias("total_processed"),
        F.coalesce(F.sum(F.size(spans)), F.lit(0)).cast("bigint").alias("total_entities"),
    )


def contexts(df: DataFrame, key: str, column: str = "text", spans: str = "spans", chars: int = 30) -> DataFrame:
    """One row a span: ordinal, label, stretch, up to ``chars`` characters before and after."""
    rows = df.select(key, S.context_rows(F.col(spans), F.col(column), chars).alias("_rows"))
    return rows.select(key, F.explode("_rows").alias("c")).select(key, "c.*")
