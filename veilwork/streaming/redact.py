"""The same redaction over streams: row-independent, so no state and no watermark is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from veilwork.operators.engine import RedactConfig, redact


def redact_stream(stream: DataFrame, column: str = "text", cfg: RedactConfig | None = None, spans_to: str | None = None) -> DataFrame:
    """Redact a streaming DataFrame; the plan is that of the batch engine."""
    return redact(stream, column, cfg, spans_to)


def label_counts_stream(stream: DataFrame, column: str = "text", cfg: RedactConfig | None = None) -> DataFrame:
    """Running counts per label (few groups, output mode ``complete`` or ``update``)."""
    spans = redact(stream, column, cfg, "spans")
    return spans.select(F.explode("spans").alias("s")).groupBy(F.col("s.label").alias("label")).agg(F.count(F.lit(1)).alias("cnt"))


def write_parquet_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet with exactly-once file output, over what has arrived."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
