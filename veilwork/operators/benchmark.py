"""Compare redaction configurations: run, time, save, score, rank, report."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from veilwork.operators import scoring
from veilwork.operators.engine import RedactConfig, redact
from veilwork.sources.io import report, write_csv

RESULT = (
    "run_id bigint, name string, success boolean, processing_time double, initialization_time double, total_time double, "
    "texts_per_second double, correctness_score double, privacy_score double, exact_matches bigint, total_texts bigint, "
    "output_file string, error_message string, redaction_coverage double, over_redaction double, balanced_score double"
)


def run_configuration(notes: DataFrame, expected: DataFrame, run_id: int, name: str, cfg: RedactConfig, key: str = "id", out: str | None = None) -> dict:
    """One result row.  A configuration that fails gives a failed result, not an error."""
    result: dict = {c.split()[0]: None for c in RESULT.split(", ")} | {"run_id": run_id, "name": name, "success": False}
    began = time.perf_counter()
    try:
        redacted = redact(notes, "text", cfg)
        ready = time.perf_counter()
        redacted.write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - ready
        texts = notes.count()
        if out:
            result["output_file"] = f"{out}/redacted_{name.lower().replace(' ', '_')}.csv"
            write_csv(redacted, result["output_file"])
        m = scoring.score(scoring.paired(redacted, expected, key)).first()
        rate = texts / took if took > 0 else 0.0
        result |= {
            "success": True, "processing_time": took, "initialization_time": ready - began, "total_time": took + ready - began,
            "texts_per_second": rate, "correctness_score": m.accuracy, "privacy_score": m.f1, "exact_matches": m.exact_matches,
            "total_texts": texts, "redaction_coverage": m.accuracy, "over_redaction": m.over_redaction_pct, "balanced_score": rate * m.accuracy / 100,
        }
    except Exception as error:
        result["error_message"] = str(error).splitlines()[0][:300]
    return result


def compare(spark: SparkSession, notes: DataFrame, expected: DataFrame, configurations: Mapping[str, RedactConfig], out: str | None = None) -> tuple[DataFrame, str]:
    """(results, Markdown report) of all configurations, in order."""
    rows = [run_configuration(notes, expected, n, name, cfg, out=out) for n, (name, cfg) in enumerate(configurations.items())]
    results = spark.createDataFrame([tuple(r.values()) for r in rows], RESULT)
    ranked = [r.asDict() for r in scoring.rankings(results).orderBy("metric", "rank").collect()]
    return results, report(rows, ranked)
