"""Span lists of one text: detect, filter, merge, splice and collapse, each a single forward scan.

A span is (start, end, label), half-open over code points; a list is in order of emission.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Collection, Mapping, Sequence
from functools import lru_cache
from operator import itemgetter

from veilwork.functions.rules import TAG, Rule

Span = tuple[int, int, str]
Range = tuple[int, int]
_TOKEN = re.compile("[A-Za-z]+")
#: Most characters a number before an address can reach back from its last digit.
_REACH = 4


def rule_matches(text: str, rule: Rule, names: Collection[str] | None = None) -> list[Range]:
    """Bounds of all matches of one rule, leftmost and not overlapping.

    ``names``: of a person's name one token must be listed; None does not restrict.
    """
    if rule.stretch:
        return _in_stretches(text, rule)
    if not rule.passes(text):
        return []
    if rule.label == "PERSON" and names is not None:
        return [m.span(rule.group) for m in rule.search(text) if any(t in names for t in _TOKEN.findall(m.group(rule.group)))]
    return [m.span(rule.group) for m in rule.search(text)]


def _in_stretches(text: str, rule: Rule) -> list[Range]:
    out: list[Range] = []
    for s in rule.stretches(text):
        if rule.fits(s.group()):
            at = max(s.start() - _REACH, out[-1][1] if out else 0)
            out += [m.span() for m in rule.search(text, at, s.end())]
    return out


def occurrences(text: str, tags: Sequence[str] = (TAG,)) -> list[Range]:
    """Ranges of existing tags, leftmost and not overlapping, longer ones first."""
    found = [t for t in tags if t and t in text]
    if not found:
        return []
    return [m.span() for m in _any_of(tuple(sorted(found, key=len, reverse=True)))(text)]


@lru_cache(256)
def _any_of(tags: tuple[str, ...]):
    return re.compile("|".join(map(re.escape, tags))).finditer


def outside(spans: list[Span], ranges: list[Range]) -> list[Span]:
    """Drop every span that overlaps a range; touching is allowed.  Ranges are sorted and disjoint."""
    if not ranges or not spans:
        return spans
    out, at = set(), 0
    for n in sorted(range(len(spans)), key=lambda n: spans[n][0]):
        start, end = spans[n][:2]
        while at < len(ranges) and ranges[at][1] <= start:
            at += 1
        if at < len(ranges) and ranges[at][0] < end:
            out.add(n)
    return [s for n, s in enumerate(spans) if n not in out]


def is_upper(text: str) -> bool:
    """At least one cased character and none of lower case."""
    return text.upper() == text and text.lower() != text


def without_capitals(spans: list[Span], text: str, keep: Collection[str] = ()) -> list[Span]:
    """Drop spans in capitals unless their label speaks of a person or an address, or is in ``keep``."""

    def spared(label: str | None) -> bool:
        low = (label or "").lower()
        return "person" in low or "address" in low or label in keep

    return [s for s in spans if spared(s[2]) or not is_upper(text[s[0] : s[1]])]


def merged(spans: list[Span]) -> list[Span]:
    """Sorted by start, ties by emission; strictly overlapping ones are one, under the first label."""
    out: list[Span] = []
    for span in sorted(spans, key=itemgetter(0)):
        if not out or span[0] >= out[-1][1]:
            out.append(span)
        elif span[1] > out[-1][1]:
            out[-1] = (out[-1][0], span[1], out[-1][2])
    return out


def spliced(
    text: str, spans: list[Span], mask: str = TAG, custom: Mapping[str, str] | None = None, places: Sequence[Range] = ()
) -> tuple[str, list[Range]]:
    """The text with masks over sorted spans, and where masks stand.

    A span that starts before the last end is skipped; labels without a mask of their own
    take ``mask``.  ``places`` of earlier masks, which no span touches, move along.
    """
    parts, moved, done, shift, at = [], [], 0, 0, 0
    for start, end, label in spans:
        if start < done:
            continue
        own = mask if custom is None else custom.get(label)
        own = mask if own is None else own
        while at < len(places) and places[at][1] <= start:
            moved.append((places[at][0] + shift, places[at][1] + shift))
            at += 1
        if own:
            moved.append((start + shift, start + shift + len(own)))
        parts += (text[done:start], own)
        shift += len(own) - (end - start)
        done = end
    moved += [(a + shift, b + shift) for a, b in places[at:]]
    return "".join((*parts, text[done:])), moved


@lru_cache(64)
def _runs(mask: str):
    return re.compile(rf"{re.escape(mask)}(?:\s*{re.escape(mask)})+").finditer


def collapsed(text: str, mask: str = TAG, places: list[Range] = ()) -> tuple[str, list[Range]]:
    """Runs of one mask with white space between become one mask; ``places`` move along.  An empty mask has no runs."""
    if not mask or text.find(mask, text.find(mask) + 1) <= 0:
        return text, list(places)
    parts, moved, done, shift, at = [], [], 0, 0, 0
    for run in _runs(mask)(text):
        while at < len(places) and places[at][1] <= run.start():
            moved.append((places[at][0] - shift, places[at][1] - shift))
            at += 1
        inside = at
        while at < len(places) and places[at][0] < run.end():
            at += 1
        if at > inside:
            moved.append((run.start() - shift, run.start() - shift + len(mask)))
        parts += (text[done : run.start()], mask)
        shift += run.end() - run.start() - len(mask)
        done = run.end()
    moved += [(a - shift, b - shift) for a, b in places[at:]]
    return "".join((*parts, text[done:])), moved


def compatibility_form(text: str) -> tuple[str, list[int], list[int]] | None:
    """NFKC of a text; for each of its characters where the stored stretch it comes from begins and ends.

    None where nothing changes.
    """
    if text.isascii() or unicodedata.is_normalized("NFKC", text):
        return None
    norm: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    for at, to in _clusters(text):
        part = text[at:to]
        new = unicodedata.normalize("NFKC", part)
        norm.append(new)
        if new == part:
            starts += range(at, to)
            ends += range(at + 1, to + 1)
        else:
            starts += [at] * len(new)
            ends += [to] * len(new)
    return "".join(norm), starts, ends


_BASES = re.compile(r"[^\x00-\x7f]|[\x00-\x7f](?=[^\x00-\x7f])|[\x00-\x7f]+?(?=[\x00-\x7f][^\x00-\x7f]|\Z)", re.S)


@lru_cache(65536)
def _compose(a: str, b: str) -> bool:
    """Whether two neighbours normalise to something else than each on its own."""
    form = lambda x: unicodedata.normalize("NFKC", x)
    return form(a + b) != form(a) + form(b)


def _clusters(text: str):
    """Bounds of stretches that normalise on their own: a character with what may compose with it; plain runs stay whole."""
    pending: Range | None = None
    for m in _BASES.finditer(text):
        at, to = m.span()
        if pending is not None:
            if to - at == 1 and not text[at].isascii() and (unicodedata.combining(text[at]) or _compose(text[pending[1] - 1], text[at])):
                pending = (pending[0], to)
                continue
            yield pending
        pending = (at, to)
    if pending is not None:
        yield pending


def stored(spans: list[Span], starts: list[int], ends: list[int]) -> list[Span]:
    """Spans of the compatibility form as spans of the stored text, grown to whole stored characters."""
    return [(starts[a], ends[b - 1], label) for a, b, label in spans if b > a]
