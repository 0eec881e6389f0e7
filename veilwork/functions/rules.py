"""The eight detection rules as data.

Fixed values: the patterns state what must match; digits, white space and word borders
have their Unicode meaning.  A gate is a necessary condition that is cheap to test, so a
text that fails it is not scanned for the rule.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

TAG = "[REDACTED]"


@dataclass(frozen=True)
class Rule:
    """``group`` 1 emits the captured name only; ``stretch`` finds the only stretches in which a match can lie."""

    id: str
    label: str
    pattern: str
    gate: str | None = None
    group: int = 0
    stretch: str | None = None
    needs: str | None = None  # what such a stretch must hold

    @cached_property
    def search(self):
        return re.compile(self.pattern).finditer

    @cached_property
    def passes(self):
        return re.compile(self.gate).search if self.gate else lambda text: True

    @cached_property
    def stretches(self):
        return re.compile(self.stretch).finditer

    @cached_property
    def fits(self):
        return re.compile(self.needs).search

    def __getstate__(self):  # compiled patterns stay behind
        return {f: self.__dict__[f] for f in self.__dataclass_fields__}

    def __setstate__(self, state):
        self.__dict__.update(state)


PERSON = Rule("R1", "PERSON", r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,2}\b")
DATE = Rule("R2", "DATE", r"(?:0?[1-9]|1[0-2])[-/](?:0?[1-9]|[12]\d|3[01])[-/](?:(?:19|20)\d{2}|\d{2})", r"\d[-/]\d")
SSN = Rule("R3", "SSN", r"\d{3}-\d{2}-\d{4}", r"\d\d\d-\d\d-")
PHONE = Rule(
    "R4", "PHONE", r"(?:\+?1[-.\s]?)?(?:\(\d{3}\)|\d{3})[-.\s]?\d{3}[-.\s]?\d{4}(?![0-9])", r"\d\d\d[-.\s]?\d\d\d\d(?![0-9])"
)
# The look-behind only spares starts inside a run that has failed from its first character.
EMAIL = Rule("R5", "EMAIL", r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}(?![A-Za-z0-9._%+\-])", "@")
# Option: a mail address may also end a sentence.
LENIENT_EMAIL = Rule(
    "R5", "EMAIL", r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}(?![A-Za-z0-9_%+\-]|\.[A-Za-z0-9_%+\-])", "@"
)
MRN = Rule("R6", "MRN", r"MRN\s*\d{5,}|\d{7,}", r"\d\d\d\d\d")
# Written without nested repetition: one word of two characters or more, or up to eight words.  Number, white space
# and the rest stand in one stretch without other characters, which must hold two capitals in a row.
ADDRESS = Rule(
    "R7", "ADDRESS",
    r"\d{1,5}\s+(?:[A-Za-z0-9]+(?:\s[A-Za-z0-9]+){1,7}|[A-Za-z0-9]{2,})\s?"
    r"(?:,\s?)?[A-Za-z]+(?:[ -][A-Za-z]+)*(?:,\s?)?[A-Z]{2}(?:,?\s?\d{5})?",
    stretch=r"\d\s[\dA-Za-z\s,\-]*", needs=r"[A-Z][A-Z]",
)
SIGNATURE = Rule(
    "R8", "PERSON", r"\b(?:DWR|DWA|MD|Dr\.?)\s+([A-Z][a-z]+)\s+(?:DWR|DWA|MD|Dr\.?|[A-Z]{2,4})\b", r"D[WR]|MD", 1
)

#: Emission order.
RULES = (PERSON, DATE, SSN, PHONE, EMAIL, MRN, ADDRESS, SIGNATURE)
LABELS = tuple(dict.fromkeys(r.label for r in RULES))
