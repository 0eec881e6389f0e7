"""Files in and out: CSV, name lists, mask dictionaries, text and Markdown."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, required: str | None = None, optional: bool = False) -> DataFrame | None:
    """CSV with a header; every column a string, so no value is rewritten on the way through.

    A missing file raises ``FileNotFoundError`` (or gives None where ``optional``), a
    missing ``required`` column ``ValueError``.
    """
    try:
        df = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            if optional:
                return None
            raise FileNotFoundError(path) from error
        raise
    if required is not None and required not in df.columns:
        raise ValueError(f"{path} has no column {required!r}; there are {df.columns}")
    return df


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """All columns in order, with a header.  ``single_file`` is for small results only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def names_of(df: DataFrame, column: str = "names") -> DataFrame:
    """(name): the distinct non-null names of all lists (men, women, last); missing or null lists are empty."""
    lists = F.concat(*[F.coalesce(F.col(f"{column}.{f}"), F.expr("CAST(array() AS array<string>)")) for f in ("men", "women", "last")])
    return df.where(F.col(column).isNotNull()).select(F.explode(lists).alias("name")).where("name IS NOT NULL").distinct()


def read_names(path: str) -> set[str]:
    """Names of a JSON file with ``men``, ``women`` and ``last``; a missing or broken file is an empty set."""
    try:
        with open(path, encoding="utf-8") as f:
            lists = json.load(f)
        return {n for key in ("women", "men", "last") for n in lists.get(key) or ()}
    except (OSError, ValueError, AttributeError, TypeError):
        return set()


def read_masks(source: str | None) -> Mapping[str, str]:
    """A JSON object, given directly or as a path; anything unreadable is no custom mask."""
    if not source:
        return {}
    try:
        text = source
        if not source.lstrip().startswith("{"):
            with open(source, encoding="utf-8") as f:
                text = f.read()
        masks = json.loads(text)
        return {str(k): str(v) for k, v in masks.items()} if isinstance(masks, dict) else {}
    except (OSError, ValueError):
        return {}


def write_text(text: str, path: str) -> bool:
    """Write one text; a failure is reported, not raised."""
    try:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        return True
    except OSError as error:
        print(f"Cannot write {os.path.basename(path)}: {error}")
        return False


def report(results: list[Mapping], rankings: list[Mapping]) -> str:
    """Markdown comparison of benchmark runs: summary, rankings, details, recommendations."""
    ok = [r for r in results if r.get("success")]
    num = lambda v, d=1: "-" if v is None else f"{v:.{d}f}"
    out = ["# Redaction comparison", "", "## Summary", "", "| Configuration | Texts/s | Accuracy % | F1 % | Over-redaction | Exact |", "|---|---|---|---|---|---|"]
    for r in results:
        over = 1 + (r.get("over_redaction") or 0) / 100
        exact = f"{r.get('exact_matches')}/{r.get('total_texts')}"
        row = [r.get("name"), num(r.get("texts_per_second")), num(r.get("correctness_score")), num(r.get("privacy_score")), f"{over:.2f}x", exact]
        out.append("| " + " | ".join(map(str, row)) + " |" if r.get("success") else f"| {r.get('name')} | failed: {r.get('error_message')} | | | | |")
    out += ["", "## Rankings"]
    for metric in dict.fromkeys(r["metric"] for r in rankings):
        out += ["", f"### {metric}", ""]
        out += [f"{r['rank']}. {r['name']}: {num(r['value'], 2)}" for r in rankings if r["metric"] == metric]
    out += ["", "Accuracy is the share of expected tags that are present, not their positions.", "", "## Details"]
    for r in ok:
        out += ["", f"### {r.get('name')}", ""] + [f"- {k}: {v}" for k, v in r.items() if k not in ("name", "success") and v is not None]
    out += ["", "## Recommendations", ""]
    out += [f"- Best by {r['metric']}: {r['name']}" for r in rankings if r["rank"] == 1]
    files = [r["output_file"] for r in ok if r.get("output_file")]
    return "\n".join([*out, "", "## Files", "", *[f"- {f}" for f in files], ""])
