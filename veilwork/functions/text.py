"""JVM-side text predicates shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space plus the four separators \x1c-\x1f, as a Java character class body.
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\xa0  -     　"

BLANK = rf"\A[{SPACE_CLASS}]*\z"


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return text.isNull() | text.rlike(BLANK)


def has_non_ascii(text: Column) -> Column:
    """True where the text holds a character beyond ASCII (bytes and characters differ in number)."""
    return F.octet_length(text) != F.char_length(text)


def strip_space(text: Column) -> Column:
    """Remove leading and trailing Unicode white space; linear in the length of the text."""
    return F.regexp_replace(text, rf"\A[{SPACE_CLASS}]+|(?<![{SPACE_CLASS}])[{SPACE_CLASS}]+\z", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    An expression used inside a lambda is evaluated for every element, and the optimizer
    may move a selected column into one; a lambda variable is bound once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def let2(a: Column, b: Column, body: Callable[[Column, Column], Column]) -> Column:
    """As ``let`` for two values.  A Python function may stand in a value, never in a body."""
    return let(F.struct(a.alias("a"), b.alias("b")), lambda p: body(p["a"], p["b"]))
