"""Command line: redact one text or one column of a CSV.

    python -m veilwork.cli --text "Call 555-123-4567"
    python -m veilwork.cli --input_csv notes.csv --output_csv out --column_name text --show_stats
"""

from __future__ import annotations

import argparse
import importlib.util
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from veilwork.functions import spans as S
from veilwork.operators import stats
from veilwork.operators.engine import RedactConfig, redact
from veilwork.operators.maskers import ModelMasker, RuleMasker, best_device, pipeline_device, spans_of
from veilwork.sources.io import read_csv, read_masks, read_names, write_csv, write_text


MASKERS = ("regex", "spacy", "huggingface")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="veilwork", description="Redact sensitive text.")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--text", help="one text")
    source.add_argument("--input_csv", help="a CSV with a header")
    source.add_argument("--test_device", "--doctor", dest="doctor", action="store_true", help="report packages and the device that models would use")
    p.add_argument("--column_name")
    p.add_argument("--output_csv")
    p.add_argument("--output_text_file")
    p.add_argument("--chunk_size", type=int, default=None, help="megabytes a partition of the CSV; unset, as the session has it")
    p.add_argument("--n_jobs", type=int, default=None, help="partitions of a CSV; unset, as the input splits")
    p.add_argument("--maskers", nargs="+", choices=MASKERS, default=list(MASKERS))
    p.add_argument("--spacy_model", default="en_core_web_trf")
    p.add_argument("--spacy_device", choices=("auto", "cpu", "gpu"), default="auto")
    p.add_argument("--hf_models", nargs="+", default=["StanfordAIMI/stanford-deidentifier-only-i2b2"])
    p.add_argument("--hf_cache_dir")
    p.add_argument("--hf_device", help="cpu, mps, cuda:N or N; unset, what the worker has")
    p.add_argument("--hf_batch_size", type=int, default=32)
    p.add_argument("--regex_debug", action="store_true", help="print what the rules match before any filter")
    p.add_argument("--names_file", default="./data/names.json")
    p.add_argument("--entity_types", nargs="*", default=[])
    p.add_argument("--default_mask", default="[REDACTED]")
    p.add_argument("--custom_masks", help="a JSON object or the path of one")
    p.add_argument("--num_passes", type=int, default=2)
    p.add_argument("--dry_run", action="store_true")
    p.add_argument("--show_stats", action="store_true")
    p.add_argument("--verbose", "-v", action="store_true")
    return p


def config(args: argparse.Namespace) -> RedactConfig:
    """The configuration asked for; a model whose package is missing is a ``SystemExit`` that says what to do."""
    for name, package in (("spacy", "spacy"), ("huggingface", "transformers")):
        if name in args.maskers and importlib.util.find_spec(package) is None:
            raise SystemExit(f"the masker {name!r} needs the package {package!r}; install it or choose --maskers regex")
    maskers: list = []
    if "regex" in args.maskers:
        maskers.append(RuleMasker(tuple(sorted(read_names(args.names_file)))))
    if "spacy" in args.maskers:
        maskers.append(ModelMasker(args.spacy_model, "spacy", device=args.spacy_device))
    if "huggingface" in args.maskers:
        maskers += [ModelMasker(m, "transformers", batch_size=args.hf_batch_size, device=args.hf_device, cache_dir=args.hf_cache_dir) for m in args.hf_models]
    return RedactConfig(
        maskers=maskers, types=args.entity_types, default_mask=args.default_mask, custom_masks=read_masks(args.custom_masks),
        num_passes=max(1, args.num_passes), dry_run=args.dry_run,
    )


def print_stats(df) -> None:
    total = stats.totals(df).first()
    print(f"Texts: {total.total_processed}  Entities: {total.total_entities}")
    for r in stats.label_counts(df).orderBy("label").collect():
        print(f"  {r.label}: {r.cnt}")


def print_contexts(df, key: str, column: str, cfg: RedactConfig) -> None:
    """What a first pass would mask, with its surroundings."""
    from veilwork.operators.engine import detect

    for r in stats.contexts(detect(df, column, cfg), key, column).toLocalIterator():
        print(f"  {r.nr}. {r.label} at {r.start}-{r.end}: ...{r.before}[{r.entity}]{r.after}...")


def print_matches(df, column: str, cfg: RedactConfig) -> None:
    """What the rules match in a first pass, before filters and merging."""
    for m in cfg.maskers:
        if isinstance(m, RuleMasker):
            text = F.coalesce(F.col(f"`{column}`"), F.lit(""))
            rows = df.select(S.context_rows(spans_of(m, text, cfg.types), text, 0).alias("m"))
            for r in rows.select(F.explode("m").alias("m")).select("m.*").toLocalIterator():
                print(f"  {r.label}: {r.entity!r} at {r.start}-{r.end}")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = parser()
    args = p.parse_args(argv)
    if args.input_csv and not (args.output_csv and args.column_name):
        p.error("--input_csv needs --output_csv and --column_name")
    if args.doctor:
        for name in ("pyspark", "pyarrow", "spacy", "transformers", "torch"):
            print(f"{name}: {'installed' if importlib.util.find_spec(name) else 'missing'}")
        device = best_device()
        print(f"device: {device}, as a pipeline takes it: {pipeline_device(device)}")
        return 0
    cfg = config(args)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.environ["PYTHONPATH"] = os.pathsep.join([root, os.environ.get("PYTHONPATH", "")])
    spark = spark or SparkSession.builder.appName("veilwork").getOrCreate()
    if args.chunk_size:
        spark.conf.set("spark.sql.files.maxPartitionBytes", args.chunk_size << 20)
    if args.text is not None:
        df = spark.createDataFrame([(0, args.text)], "id int, text string")
        out = redact(df, "text", cfg, "spans")
        if args.verbose:
            print(f'Original: "{args.text}"')
            print_contexts(df, "id", "text", cfg)
        if args.regex_debug:
            print_matches(df, "text", cfg)
        result = out.first().text
        print(f'Masked: "{result}"')
        if args.output_text_file and not args.dry_run:
            write_text(result, args.output_text_file)
    else:
        df = read_csv(spark, args.input_csv, args.column_name)
        if args.n_jobs:
            df = df.repartition(args.n_jobs)
        if args.verbose:
            print_contexts(df.withColumn("__row", F.monotonically_increasing_id()), "__row", args.column_name, cfg)
        if args.regex_debug:
            print_matches(df, args.column_name, cfg)
        out = redact(df, args.column_name, cfg, "spans")
        if not args.dry_run:
            write_csv(out.drop("spans", "spans_counted"), args.output_csv)
    if args.show_stats:
        print_stats(out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
