"""Span arrays as columns: detect, filter, sort, merge, mask.

A span is ``struct<start int, end int, label string>``: half-open code-point bounds; an
array is in order of emission, which breaks ties between equal starts.  Filters by label
are column expressions.  What needs positions in the text runs as an Arrow function, one
forward scan a row (see ``scan``): the array functions of the JVM copy the array for
every element they append and count characters from the start of the text for every
slice, which is quadratic in the number of spans.

The Arrow functions are declared nondeterministic, so that the optimizer neither
repeats them for every use of their result nor moves them into a filter or a lambda.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilwork.functions import scan
from veilwork.functions.rules import TAG, Rule

SPAN = "struct<start:int,end:int,label:string>"
NO_SPANS = f"CAST(array() AS array<{SPAN}>)"
SPAN_TYPE = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("label", T.StringType())])
_ARROW_SPAN = {"start": pa.int32(), "end": pa.int32(), "label": pa.string()}


def literal(text: str) -> str:
    """A Java pattern for ``text`` itself."""
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", text)


def list_array(lists: Sequence[Sequence[tuple] | None], fields: Mapping[str, pa.DataType]) -> pa.Array:
    """Lists of tuples as an Arrow array of structs, built by column; None is null."""
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x or ()) for x in lists], out=offsets[1:])
    columns = list(zip(*(t for x in lists if x for t in x))) or [()] * len(fields)
    values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, fields.values())], names=list(fields))
    nulls = pa.array([x is None for x in lists])
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=nulls if any(x is None for x in lists) else None)


def span_array(lists: Sequence[Sequence[scan.Span] | None]) -> pa.Array:
    return list_array(lists, _ARROW_SPAN)


def span_lists(spans: pa.Array) -> list[list[scan.Span] | None]:
    """The lists of an Arrow array of spans; null spans and spans without bounds vanish."""
    if isinstance(spans, pa.ChunkedArray):
        spans = spans.combine_chunks()
    flat = spans.flatten()
    parts = [flat.field(k).to_pylist() for k in range(3)] if len(flat) else [[], [], []]
    valid = flat.is_valid().to_pylist()
    out, at = [], 0
    for n in spans.value_lengths().to_pylist():
        if n is None:
            out.append(None)
            continue
        out.append([(parts[0][k], parts[1][k], parts[2][k]) for k in range(at, at + n) if valid[k] and parts[0][k] is not None and parts[1][k] is not None])
        at += n
    return out


def per_text(function: Callable, kind: T.DataType, build: Callable = pa.array) -> Callable[..., Column]:
    """An Arrow function over texts (and spans); a null in any of them gives null."""

    def run(*columns: pa.Array) -> pa.Array:
        lists = [span_lists(c) if pa.types.is_list(c.type) else c.to_pylist() for c in columns]
        return build([None if any(v is None for v in row) else function(*row) for row in zip(*lists)])

    if kind == T.StringType():
        build = lambda rows: pa.array(rows, pa.string())

    def one(a: pa.Array) -> pa.Array:
        return run(a)

    def two(a: pa.Array, b: pa.Array) -> pa.Array:
        return run(a, b)

    return lambda *columns: F.arrow_udf(one if len(columns) == 1 else two, kind).asNondeterministic()(*columns)


def _spans_of(function: Callable) -> Callable[..., Column]:
    return per_text(function, T.ArrayType(SPAN_TYPE), span_array)


def rule_spans(text: Column, rule: Rule, names: Collection[str] | None = None) -> Column:
    """Spans of one rule.  ``names`` (known names) restricts persons: one token must be listed."""
    listed = frozenset(names) if names else None
    return _spans_of(lambda t: [(a, b, rule.label) for a, b in scan.rule_matches(t, rule, listed)])(text)


def tag_ranges(text: Column, tags: Sequence[str] = (TAG,)) -> Column:
    """Ranges of existing tags in a text, as spans labelled ``TAG``."""
    return _spans_of(lambda t: [(a, b, "TAG") for a, b in scan.occurrences(t, tags)])(text)


def without_capitals(spans: Column, text: Column, keep: Sequence[str] = ()) -> Column:
    """Drop spans in capitals unless their label speaks of a person or an address, or is in ``keep``."""
    return _spans_of(lambda ss, t: scan.without_capitals(ss, t, keep))(spans, text)


def merged(spans: Column) -> Column:
    """Merge spans that overlap strictly; the first label stays, touching spans stay apart, null spans vanish."""
    return _spans_of(scan.merged)(spans)


def masked(text: Column, spans: Column, mask: str = TAG, custom: Mapping[str, str] | None = None) -> Column:
    """Splice masks over sorted spans; one that starts before the last end is skipped.

    ``custom`` maps labels to masks; labels it lacks take ``mask``.
    """
    return per_text(lambda t, ss: scan.spliced(t, ss, mask, custom)[0], T.StringType())(text, spans)


_MASKED = {"mask_set": pa.string(), "masked": pa.string()}


def masked_by_sets(text: Column, spans: Column, sets: Sequence[tuple[str, Mapping[str, str] | None]]) -> Column:
    """Array of (mask_set, masked): the text under each dictionary of masks; a null dictionary has no mask of its own."""
    rows = lambda t, ss: [(name, scan.spliced(t, ss, TAG, masks)[0]) for name, masks in sets]
    kind = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in _MASKED]))
    return per_text(rows, kind, lambda x: list_array(x, _MASKED))(text, spans)


def of_types_exact(spans: Column, types: Sequence[str]) -> Column:
    """Label filter of the rule detector: exact and case-sensitive; no types, no filter."""
    return F.filter(spans, lambda s: s["label"].isin(*types)) if types else spans


def of_types_within(spans: Column, types: Sequence[str]) -> Column:
    """Label filter of entity models: a requested type occurs in the label, in any case."""
    if not types:
        return spans
    return F.filter(
        spans, lambda s: F.exists(F.array(*[F.lit(t.lower()) for t in types]), lambda t: F.lower(s["label"]).contains(t))
    )


def collapsed(text: Column, mask: str = TAG) -> Column:
    """Runs of one mask with white space between become one mask; an empty mask has no runs."""
    if not mask:
        return text
    m = literal(mask)
    return F.when(text.contains(mask), F.regexp_replace(text, rf"(?U){m}(?:[\s\x1c-\x1f]*+{m})++", mask.replace("\\", "\\\\").replace("$", "\\$"))).otherwise(text)


_CONTEXT = {"nr": pa.int32(), "label": pa.string(), "entity": pa.string(), "before": pa.string(), "after": pa.string(), "start": pa.int32(), "end": pa.int32()}
_CONTEXT_TYPE = T.StructType([T.StructField(n, T.IntegerType() if t == pa.int32() else T.StringType()) for n, t in _CONTEXT.items()])


def context_rows(spans: Column, text: Column, chars: int = 30) -> Column:
    """Array of (nr, label, entity, before, after, start, end) for review."""

    def rows(ss: list[scan.Span], t: str) -> list[tuple]:
        return [(n, label, t[a:b], t[max(0, a - chars) : a], t[b : b + chars], a, b) for n, (a, b, label) in enumerate(ss, 1)]

    return per_text(rows, T.ArrayType(_CONTEXT_TYPE), lambda x: list_array(x, _CONTEXT))(spans, text)


def preview(text: Column, chars: int = 100) -> Column:
    return F.concat(F.left(text, F.lit(chars)), F.when(F.char_length(text) > chars, "...").otherwise(""))


def tag_count(text: Column, tag: str = TAG) -> Column:
    return F.regexp_count(text, F.lit(literal(tag)))
