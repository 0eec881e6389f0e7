"""The redaction engine: passes of detect, filter, merge, mask and collapse over a column.

All passes over a batch of texts run in one Arrow function: a text crosses to Python once,
is scanned forward once for each rule and pass, and comes back with its spans.  A pass
that changes nothing ends the work on a text, because all later ones would find the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.functions import scan
from veilwork.functions import spans as S
from veilwork.functions.rules import TAG
from veilwork.functions.text import is_blank
from veilwork.operators.maskers import Masker, RuleMasker
from veilwork.operators.names import NAMES_IN_MEMORY, listed_names


@dataclass(frozen=True)
class RedactConfig:
    """What to detect and how to mask.

    ``normalize``: rules detect on the compatibility form of a text and their spans are
    mapped back to the stored text; ``nfkc_compat`` applies them unmapped instead.
    ``strict_email`` False also finds mail addresses that end a sentence or stand in
    capitals.  ``protect_masks``: no later pass touches a mask that an earlier one put in.
    ``null_mode`` ``nan`` treats a missing value as the text ``nan``.  ``keep_labels`` are
    spared by the filter of spans in capitals.  ``dry_run`` detects and counts but leaves
    the text.
    """

    maskers: Sequence[Masker] = field(default_factory=lambda: (RuleMasker(),))
    types: Sequence[str] = ()
    default_mask: str = TAG
    custom_masks: Mapping[str, str] = field(default_factory=dict)
    num_passes: int = 2
    dry_run: bool = False
    normalize: bool = True
    nfkc_compat: bool = False
    protect_masks: bool = True
    strict_email: bool = True
    null_mode: str = "null"
    keep_labels: Sequence[str] = ()


class Passes:
    """The passes over a batch of texts, with what they need on a worker."""

    def __init__(self, cfg: RedactConfig):
        self.cfg = cfg
        self.num_passes = max(1, cfg.num_passes)
        self.keep = (*cfg.keep_labels, *(() if cfg.strict_email else ("EMAIL",)))
        self.maskers = [m.configured(cfg) if hasattr(m, "configured") else m for m in cfg.maskers]

    def found(self, texts: list[str], listed: list | None = None) -> list[list[scan.Span]]:
        """Spans of all maskers by text, in masker order (bag union)."""
        out: list[list[scan.Span]] = [[] for _ in texts]
        for m in self.maskers:
            spans = m.detect(texts, self.cfg.types, listed) if getattr(m, "takes_listed", False) else m.detect(texts, self.cfg.types)
            for all_, own in zip(out, spans):
                all_ += own
        return out

    def run(self, texts: list[str | None], listed: list | None = None) -> list[tuple[str | None, list[scan.Span]] | None]:
        """(text, merged spans of all passes) of each text; null for a null one."""
        cfg = self.cfg
        now = list(texts)
        spans: list[list[scan.Span]] = [[] for _ in texts]
        places: list[list[scan.Range]] = [[] for _ in texts]
        open_ = [n for n, t in enumerate(texts) if t is not None]
        for _ in range(1 if cfg.dry_run else self.num_passes):
            found = self.found([now[n] for n in open_], listed and [listed[n] for n in open_]) if open_ else []
            changed = []
            for n, own in zip(open_, found):
                if cfg.protect_masks:
                    own = scan.outside(own, places[n])
                own = scan.merged(scan.without_capitals(own, now[n], self.keep)) if own else own
                if not own:
                    continue
                spans[n] += own
                if not cfg.dry_run:
                    text, places[n] = scan.spliced(now[n], own, cfg.default_mask, cfg.custom_masks or None, places[n])
                    now[n], places[n] = scan.collapsed(text, cfg.default_mask, places[n])
                    changed.append(n)
            open_ = changed
        if cfg.dry_run:  # every pass sees the same text
            spans = [s * self.num_passes for s in spans]
        return [None if texts[n] is None else (now[n], spans[n]) for n in range(len(texts))]


_RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("spans", T.ArrayType(S.SPAN_TYPE))])


def _passes_udf(df: DataFrame, passes: Passes, with_listed: bool):
    shared = df.sparkSession.sparkContext.broadcast(passes)

    def rows(texts: pa.Array, listed: pa.Array | None) -> pa.Array:
        names = [frozenset(x or ()) for x in listed.to_pylist()] if listed is not None else None
        out = shared.value.run(texts.to_pylist(), names)
        columns = [pa.array([r and r[0] for r in out], pa.string()), S.span_array([r and r[1] for r in out])]
        return pa.StructArray.from_arrays(columns, names=["text", "spans"], mask=pa.array([r is None for r in out], pa.bool_()))

    def plain(texts: pa.Array) -> pa.Array:
        return rows(texts, None)

    def joined(texts: pa.Array, listed: pa.Array) -> pa.Array:
        return rows(texts, listed)

    return F.arrow_udf(joined if with_listed else plain, _RESULT).asNondeterministic()


def redact(
    df: DataFrame, column: str = "text", cfg: RedactConfig | None = None, spans_to: str | None = None,
    names: DataFrame | None = None, key: str | None = None,
) -> DataFrame:
    """Rewrite ``column``; every other column passes through.  No shuffle.

    Null, empty and blank values stay as they are and count for nothing.  ``spans_to``
    adds the merged spans of all passes and ``{spans_to}_counted``, in place of columns of
    these names.  A missing column is a ``ValueError``.

    ``names``: a table (``name``) of known names in place of a list in the rule masker.
    It is counted: up to ``NAMES_IN_MEMORY`` it is shipped with the rules, beyond that the
    tokens of each text are joined with it by ``key`` (see ``names.listed_names``); rows
    with a null key then know no listed name.
    """
    cfg = cfg or RedactConfig()
    if column not in df.columns:
        raise ValueError(f"no column {column!r}; there are {df.columns}")
    keep = [c for c in df.columns if spans_to is None or c not in (spans_to, f"{spans_to}_counted")]
    source = F.col(f"`{column}`")
    if cfg.null_mode == "nan":
        source = F.coalesce(source.cast("string"), F.lit("nan"))
    given = F.when(~is_blank(source), source)
    joined = False
    if names is not None:
        known = names.select("name").where("name IS NOT NULL").distinct()
        few = known.limit(NAMES_IN_MEMORY + 1).collect()
        if len(few) <= NAMES_IN_MEMORY:
            cfg = _with_names(cfg, frozenset(r.name for r in few))
        else:
            df, joined = listed_names(df, known, given, key), True
            cfg = _with_names(cfg, None)
    passes = _passes_udf(df, Passes(cfg), joined)
    done = passes(given, F.col("__listed")) if joined else passes(given)
    out = df.select(*[F.col(f"`{c}`") for c in keep], done.alias("__done"))
    result = F.coalesce(F.col("__done.text"), source).alias(column)
    columns = [result if c == column else F.col(f"`{c}`") for c in keep]
    if spans_to:
        columns += [F.coalesce("__done.spans", F.expr(S.NO_SPANS)).alias(spans_to), F.col("__done").isNotNull().alias(f"{spans_to}_counted")]
    return out.select(*columns)


def _with_names(cfg: RedactConfig, names: frozenset[str] | None) -> RedactConfig:
    """The configuration with the known names of its rule maskers replaced; None: they come with each row."""
    swap = {"known_names": names} if names is not None else {"known_names": (), "takes_listed": True}
    return replace(cfg, maskers=tuple(replace(m, **swap) if isinstance(m, RuleMasker) else m for m in cfg.maskers))


def redact_text(spark: SparkSession, text: str | None, cfg: RedactConfig | None = None) -> str | None:
    """One text."""
    return redact_texts(spark, [text], cfg)[0]


def redact_texts(spark: SparkSession, texts: Sequence[str | None], cfg: RedactConfig | None = None) -> list[str | None]:
    """A driver-side list, in order; an empty list gives an empty list."""
    if not texts:
        return []
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    return [r.text for r in redact(df, "text", cfg).orderBy("n").collect()]


def detect(
    df: DataFrame, column: str = "text", cfg: RedactConfig | None = None, to: str = "spans", names: DataFrame | None = None, key: str | None = None
) -> DataFrame:
    """Add the merged spans of a single pass; none for null and blank texts."""
    return redact(df, column, replace(cfg or RedactConfig(), dry_run=True, num_passes=1), to, names, key).drop(f"{to}_counted")
