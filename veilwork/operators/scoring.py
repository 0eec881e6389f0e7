"""Scoring of redacted texts against expected ones, and ranking of configurations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilwork.functions.durable import durable
from veilwork.functions.spans import tag_count
from veilwork.functions.text import strip_space

METRICS = ("accuracy", "precision", "exact_matches", "f1", "over_redaction_ratio", "over_redaction_pct")


def paired(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """(actual, expected) by an explicit row key; rows without a partner or without text do not count."""
    a = actual.select(key, F.col("text").alias("actual"))
    e = expected.select(key, F.col("text").alias("expected"))
    return a.join(e, key).where("actual IS NOT NULL AND expected IS NOT NULL")


def score(pairs: DataFrame) -> DataFrame:
    """One row of metrics over (actual, expected).  Accuracy counts tags, not positions; no rows, all 0."""
    e, a = tag_count(F.col("expected")), tag_count(F.col("actual"))
    sums = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(e), F.lit(0)).alias("e"),
        F.coalesce(F.sum(a), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.least(a, e)), F.lit(0)).alias("c"),
        F.count_if(strip_space(F.col("actual")) == strip_space(F.col("expected"))).alias("exact_matches"),
    )
    none = F.col("n") == 0
    rates = sums.select(
        "*",
        F.when(none, 0.0).when(F.col("e") > 0, F.col("c") / F.nullif("e", F.lit(0)) * 100).otherwise(100.0).alias("accuracy"),
        F.when(F.col("a") > 0, F.col("c") / F.nullif("a", F.lit(0)) * 100).otherwise(0.0).alias("precision"),
        F.when(F.col("e") > 0, F.col("a") / F.nullif("e", F.lit(0))).otherwise(0.0).alias("over_redaction_ratio"),
    )
    both = F.col("accuracy") + F.col("precision")
    return rates.select(
        "accuracy",
        "precision",
        "exact_matches",
        F.when(both > 0, 2 * F.col("accuracy") * F.col("precision") / F.nullif(both, F.lit(0.0))).otherwise(0.0).alias("f1"),
        "over_redaction_ratio",
        (F.greatest(F.col("over_redaction_ratio") - 1, F.lit(0.0)) * 100).alias("over_redaction_pct"),
    )


RANKED_BY = {"speed": "texts_per_second", "accuracy": "correctness_score", "f1": "privacy_score", "balanced": "balanced"}


def rankings(results: DataFrame, order: str = "run_id") -> DataFrame:
    """(metric, rank, run_id, name, value) of the successful runs, four descending rankings.

    Ties keep the order of ``order``; missing values come last; a repeated run counts once.
    There are four metrics for any number of runs, so no window by metric: the rows are
    sorted by range, and a rank is the place in its partition plus the rows of the metric
    in earlier ones, a table of (partition, metric) counts.
    """
    ok = results.where("success").dropDuplicates([order])
    ok = ok.withColumn("balanced", F.col("texts_per_second") * F.col("correctness_score") / 100)
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in RANKED_BY.items()])
    long = ok.select(order, "name", F.explode(values).alias("x")).select(order, "name", "x.metric", "x.value")
    placed = durable(long.orderBy("metric", F.desc_nulls_last("value"), order)).withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("_part", "metric").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("metric").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    ranked = placed.join(parts, ["_part", "metric"])
    return ranked.select(order, "name", "metric", "value", (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias("rank"))


def best(results: DataFrame, order: str = "run_id") -> DataFrame:
    """The winner of each ranking by a map-side aggregate; the first wins ties."""
    ok = results.where("success").withColumn("balanced", F.col("texts_per_second") * F.col("correctness_score") / 100)
    picks = [
        F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("value"), (-F.col(order)).alias("o"), F.col("name").alias("name")))).alias(m)
        for m, c in RANKED_BY.items()
    ]
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}.name").alias("name"), F.col(f"{m}.value").alias("value")) for m in RANKED_BY])
    return ok.agg(*picks).select(F.explode(rows).alias("r")).select("r.*")
