"""Detectors.  A masker is anything with ``detect(texts, types)`` that returns the spans of each text.

The engine calls it in its Arrow function with a batch of texts, none of them null or
blank.  Rule-based and list-based maskers scan; model-based ones load their model once a
Python worker, and their packages are optional.  A masker with ``configured(cfg)`` adapts
to the configuration of the engine before it is shipped.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import types as T

from veilwork.functions import scan
from veilwork.functions import spans as S
from veilwork.functions.rules import EMAIL, LENIENT_EMAIL, RULES, TAG, Rule


class Masker(Protocol):
    def detect(self, texts: list[str], types: Sequence[str]) -> list[list[scan.Span]]: ...


def spans_of(masker: Masker, text: Column, types: Sequence[str] = ()) -> Column:
    """The spans of one masker as a column, in order of emission."""
    return S.per_text(lambda t: masker.detect([t], types)[0], T.ArrayType(S.SPAN_TYPE), S.span_array)(text)


@dataclass(frozen=True)
class RuleMasker:
    """The rule detector: every rule on its own, persons checked against known names, existing tags kept.

    Types filter by exact label, so an excluded rule costs nothing.  No known names, no
    check.  ``takes_listed``: the known names of each text come with it.
    """

    known_names: Collection[str] = ()
    rules: Sequence[Rule] = RULES
    tags: Sequence[str] = (TAG,)
    normalize: bool = True
    nfkc_compat: bool = False
    takes_listed: bool = False

    def configured(self, cfg) -> RuleMasker:
        rules = self.rules if cfg.strict_email else tuple(LENIENT_EMAIL if r is EMAIL else r for r in self.rules)
        return replace(self, rules=rules, normalize=cfg.normalize, nfkc_compat=cfg.nfkc_compat, known_names=frozenset(self.known_names))

    def detect(self, texts: list[str], types: Sequence[str] = (), listed: list | None = None) -> list[list[scan.Span]]:
        chosen = [r for r in self.rules if not types or r.label in types]
        names = frozenset(self.known_names) or None
        return [self._one(t, chosen, listed[n] if listed is not None else names) for n, t in enumerate(texts)]

    def _one(self, text: str, rules: Sequence[Rule], names: frozenset[str] | None) -> list[scan.Span]:
        form = scan.compatibility_form(text) if self.normalize else None
        on = form[0] if form else text
        found = [(a, b, r.label) for r in rules for a, b in scan.rule_matches(on, r, names)]
        if not found:
            return found
        found = scan.outside(found, scan.occurrences(on, self.tags))
        return scan.stored(found, *form[1:]) if form and not self.nfkc_compat else found


@dataclass(frozen=True)
class ListMasker:
    """Whole-word matches of listed terms under one label, longest first."""

    terms: Sequence[str]
    label: str = "TERM"

    @cached_property
    def _search(self):
        terms = sorted({t.strip() for t in self.terms if t and t.strip()}, key=lambda t: (-len(t), t))
        return re.compile(r"\b(?:" + "|".join(map(re.escape, terms)) + r")\b").finditer if terms else None

    def __getstate__(self):
        return {"terms": self.terms, "label": self.label}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def detect(self, texts: list[str], types: Sequence[str] = ()) -> list[list[scan.Span]]:
        if self._search is None or types and not _within(self.label, types):
            return [[] for _ in texts]
        return [[(*m.span(), self.label) for m in self._search(t)] for t in texts]


def _within(label: str, types: Sequence[str]) -> bool:
    """Type filter of entity models: a requested type occurs in the label, in any case."""
    return any(t.lower() in label.lower() for t in types)


_MODELS: dict = {}  # one a Python worker
#: Characters of a text that a transformers model sees at once, and that neighbouring pieces have in common.
PIECE, OVERLAP = 10_000, 400
#: Tokens that a transformers model takes at once; longer pieces are seen in overlapping windows of so many.
MAX_TOKENS, STRIDE = 512, 64
#: Pipeline parts that entity recognition does not need, first choice and fallback.
DISABLED = (("parser", "tagger", "lemmatizer", "attribute_ruler"), ("parser", "tagger", "lemmatizer"))


def _pieces(text: str) -> list[tuple[int, str]]:
    """(offset, piece) of a whole text, cut at white space where there is some."""
    out, start = [], 0
    while len(text) - start > PIECE:
        hi = start + PIECE
        gaps = [text.rfind(c, start + PIECE // 2, hi) for c in " \n\t"]
        end = max(gaps) + 1 or hi
        out.append((start, text[start:end]))
        gap = text.find(" ", end - OVERLAP, end - OVERLAP // 2)
        start = gap + 1 if gap >= 0 else end - OVERLAP
    return [*out, (start, text[start:])]


def best_device() -> str:
    """``mps``, ``cuda:0`` or ``cpu``: the first that works on this worker."""
    try:
        import torch
    except ImportError:
        return "cpu"
    for name, there in (("mps", lambda: torch.backends.mps.is_available()), ("cuda:0", torch.cuda.is_available)):
        try:
            if there():
                torch.zeros(1, device=name)
                return name
        except Exception as error:  # a device that is reported but does not work is passed over
            print(f"{name} does not work: {error}")
    return "cpu"


def pipeline_device(device: str | int | None) -> str | int:
    """A device as transformers pipelines take it: -1 (CPU), ``mps`` or the number of a CUDA device.

    None and ``auto`` choose the best; a number is that CUDA device, a negative one the
    CPU; ``gpu`` and ``cuda`` are the first CUDA device; anything unknown is the CPU.
    """
    if device is None or device == "auto":
        device = best_device()
    if isinstance(device, int) or str(device).lstrip("-").isdigit():
        return max(-1, int(device))
    kind, _, number = str(device).partition(":")
    if kind == "mps":
        return "mps"
    if kind in ("cuda", "gpu"):
        return int(number) if number.isdigit() else 0
    return -1


@dataclass(frozen=True)
class ModelMasker:
    """A named-entity model.  ``backend`` is ``spacy`` or ``transformers``.

    Texts of a batch go to the model together; transformers models see long ones in
    overlapping pieces.  ``max_chars`` cuts what the model sees (10,000 is the older
    behaviour with transformers); without it whole texts are masked.  ``device`` None or
    ``auto`` takes what the worker has; a device that fails falls back to the CPU.
    Errors fail the job unless ``on_error`` is ``skip``.
    """

    model: str
    backend: str = "spacy"
    max_chars: int | None = field(default=None)
    batch_size: int = 32
    device: str | int | None = None
    cache_dir: str | None = None
    on_error: str = "fail"

    def detect(self, texts: list[str], types: Sequence[str] = ()) -> list[list[scan.Span]]:
        try:
            found = self.entities(texts)
        except Exception as error:
            if self.on_error != "skip":
                raise
            print(f"{self.model}: skipped, {error}")
            return [[] for _ in texts]
        return [[s for s in spans if not types or _within(s[2], types)] for spans in found]

    def entities(self, texts: list[str]) -> list[list[scan.Span]]:
        cut = [t[: self.max_chars or None] for t in texts]
        model = self._load()
        if self.backend == "spacy":
            return [[(e.start_char, e.end_char, e.label_) for e in d.ents] for d in model.pipe(cut, batch_size=self.batch_size)]
        parts = [(n, at, part) for n, t in enumerate(cut) for at, part in _pieces(t)]
        out: list[dict[scan.Span, None]] = [{} for _ in cut]  # what two pieces find counts once
        for (n, at, _), found in zip(parts, model([part for _, _, part in parts], batch_size=self.batch_size)):
            out[n].update(dict.fromkeys((e["start"] + at, e["end"] + at, e["entity_group"]) for e in found))
        return [sorted(f) for f in out]

    def _load(self):
        key = (self.backend, self.model, str(self.device), self.cache_dir)
        if key not in _MODELS:
            _MODELS[key] = self._spacy() if self.backend == "spacy" else self._transformers()
        return _MODELS[key]

    def _spacy(self):
        import spacy

        if pipeline_device(self.device) in (-1, "mps"):  # entity models do not run reliably on mps
            spacy.require_cpu()
        else:
            spacy.prefer_gpu()
        try:
            return spacy.load(self.model, disable=list(DISABLED[0]))
        except Exception:  # a part that this model lacks or needs
            return spacy.load(self.model, disable=list(DISABLED[1]))

    def _transformers(self):
        from transformers import AutoModelForTokenClassification, AutoTokenizer, pipeline

        tokenizer = AutoTokenizer.from_pretrained(self.model, cache_dir=self.cache_dir, use_fast=True, model_max_length=MAX_TOKENS)
        model = AutoModelForTokenClassification.from_pretrained(self.model, cache_dir=self.cache_dir)
        options = {"model": model, "tokenizer": tokenizer, "aggregation_strategy": "simple", "stride": STRIDE, "batch_size": self.batch_size}
        device = pipeline_device(self.device)
        try:
            return pipeline("token-classification", device=device, **options)
        except Exception as error:
            if device == -1:
                raise
            print(f"{device} does not work with {self.model}: {error}; on the CPU")
            return pipeline("token-classification", device=-1, **options)
